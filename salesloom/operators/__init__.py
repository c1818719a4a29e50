"""Relational operators: quality, delta, merge, returns, KPIs, audit."""
