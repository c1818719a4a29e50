"""Continuous landing of channel files."""
