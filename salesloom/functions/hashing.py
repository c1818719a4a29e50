"""Content hashes for change detection, and cheap signatures for grouping."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ZERO_HASH = "0" * 64
_ZERO_TEXT = r"^\s*[+-]?(0+\.?0*|\.0+)([eE][+-]?\d+)?\s*\z"


def payload_hash(columns) -> Column:
    """SHA-256 of a raw row: sorted fields; blank promo and zero discount count as absent."""
    parts = []
    for name in sorted(columns):
        value = F.coalesce(F.col(name), F.lit(""))
        if name == "promo_code":
            value = F.when(F.trim(value) != "", value)
        elif name == "discount_amount":
            value = F.when((F.trim(value) != "") & ~value.rlike(_ZERO_TEXT), value)
        parts.append(value.alias(name))
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def record_hash(columns) -> Column:
    """SHA-256 of a typed canonical row; zero discount and empty promo count as absent."""
    parts = []
    for name in sorted(columns):
        value = F.col(name)
        if name == "discount_amount":
            value = F.when(value != 0, value)
        elif name == "promo_code":
            value = F.when(value != "", value)
        parts.append(value.cast("string").alias(name))
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def signature_columns(columns) -> list[str]:
    """SQL of two independent 64-bit hashes of a row, nulls distinct from every text.

    Versions of one key are compared by them: fixed-width buffers keep the
    per-key min/max in hash aggregation.
    """
    parts = [f"coalesce(CAST(`{c}` AS STRING), '\\u0000null')" for c in columns]
    backwards = ", ".join(reversed(parts))
    return [f"xxhash64({', '.join(parts)}) AS _sig_a", f"xxhash64('second', {backwards}) AS _sig_b"]
