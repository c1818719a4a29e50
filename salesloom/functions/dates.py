"""Per-channel date parsing and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Month abbreviations.
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


_ISO = r"r'^\d{4}-\d{1,2}-\d{1,2}\z'"
_ISO_STRICT = r"r'^\d{4}-\d{2}-\d{2}\z'"
_SLASH = r"r'^(\d{1,2})/(\d{1,2})/(\d{4})\z'"
_STAMP = r"r'^(\d{4}-\d{1,2}-\d{1,2})[T ]([01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d\z'"
_WEB = r"r'^[A-Za-z]{3} \d{1,2}, \d{4}\z'"
_TILL = r"r'^\d{1,2}-[A-Za-z]{3}-\d{4}\z'"


def _month_sql(name: str) -> str:
    return f"CASE lower({name}) " + " ".join(f"WHEN '{m}' THEN '{i}'" for i, m in enumerate(_MONTHS, 1)) + " END"


def _as_iso_sql(x: str, source: str) -> str:
    """The date text of a channel turned into year-month-day; other texts stay as they are."""
    web_day = f"split_part(split_part({x}, ' ', 2), ',', 1)"
    web = f"concat_ws('-', right({x}, 4), {_month_sql(f'left({x}, 3)')}, {web_day})"
    till_month = _month_sql(f"split_part({x}, '-', 2)")
    till = f"concat_ws('-', right({x}, 4), {till_month}, split_part({x}, '-', 1))"
    return (
        f"CASE {source} WHEN 'website' THEN CASE WHEN {x} RLIKE {_WEB} THEN {web} ELSE regexp_replace({x}, {_STAMP}, '$1') END "
        f"WHEN 'offline' THEN CASE WHEN {x} RLIKE {_TILL} THEN {till} ELSE {x} END "
        f"WHEN 'shopee' THEN regexp_replace({x}, {_SLASH}, '$3-$2-$1') "
        f"WHEN 'tokopedia' THEN regexp_replace({x}, {_SLASH}, '$3-$2-$1') ELSE {x} END"
    )


def _value_sql(iso: str, pattern: str) -> str:
    return f"CASE WHEN {iso} RLIKE {pattern} AND NOT startswith({iso}, '0000') THEN try_cast({iso} AS DATE) END"


def iso_date(cleaned: str) -> Column:
    """Strict ``yyyy-MM-dd``; null otherwise."""
    return F.expr(_value_sql(cleaned, _ISO_STRICT))


def date_sql(cleaned: str, source: str) -> str:
    """Date of a cleaned text under the formats of its channel; null when there is no such day."""
    return _value_sql(_as_iso_sql(cleaned, source), _ISO)


def parse_date(cleaned: str, source: str) -> Column:
    """``source`` is the SQL text of the channel key: a column name or a quoted literal."""
    return F.expr(date_sql(cleaned, source))


def date_error_sql(cleaned: str, value: str) -> str:
    return f"CASE WHEN {cleaned} IS NULL THEN 'MISSING_REQUIRED' WHEN {value} IS NULL THEN 'INVALID_DATE' END"


def date_error(cleaned: str, value: str) -> Column:
    return F.expr(date_error_sql(cleaned, value))


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of the date dimension."""
    return {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter_number": F.quarter(day),
        "year_number": F.year(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
    }


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")
