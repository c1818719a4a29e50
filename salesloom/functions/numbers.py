"""Exact number rules: cleaned text in, struct(raw, error) out.

Range and precision are judged on the digits of the text, so a value with more
decimals than a Spark decimal can hold is refused instead of rounded. The
common plain notation takes one pattern and one cast; signs, exponents, ``_``
and extra zeros take the general rules in the other branch.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from salesloom.contracts import INT_MAX, MONEY_MAX

_PLAIN_MONEY = r"r'^\d{1,9}(\.\d{1,2})?\z'"
_PLAIN_INTEGER = r"r'^\d{1,9}\z'"


def _decimal_digits() -> tuple[str, str]:
    """All decimal digits outside ASCII and the ASCII ones of equal value."""
    digits = [chr(c) for c in range(128, 0x10000) if unicodedata.category(chr(c)) == "Nd"]
    return "".join(digits), "".join(str(unicodedata.decimal(c)) for c in digits)


_DIGITS, _VALUES = _decimal_digits()


def ascii_digits_sql(x: str) -> str:
    return rf"CASE WHEN {x} RLIKE r'[^\x00-\x7F]' THEN translate({x}, '{_DIGITS}', '{_VALUES}') ELSE {x} END"


class _General:
    """SQL tests on the parts ``g`` of a cleaned text in any accepted notation, as ``_apart`` takes it apart.

    The value is 0.core times ten to the power of point, core being the digits without zeros at either end: range and
    precision are counted on them as text, exactly at any exponent.
    """

    is_number = r"g.text RLIKE r'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z'"
    is_zero = "g.zero"
    is_negative = "(startswith(g.text, '-') AND NOT g.zero)"
    two_decimals = "coalesce(g.zero OR length(g.core) - g.point <= 2, false)"
    whole = "coalesce(g.zero OR length(g.core) - g.point <= 0, false)"
    _whole = "CASE WHEN g.point > 0 THEN rpad(substring(g.core, 1, CAST(g.point AS INT)), CAST(g.point AS INT), '0') ELSE '0' END"
    _part = "CASE WHEN g.point >= 0 THEN substring(g.core, CAST(g.point AS INT) + 1) ELSE repeat('0', CAST(-g.point AS INT)) || g.core END"
    wide = f"CASE WHEN g.point BETWEEN -2 AND 20 AND length(g.core) - g.point <= 2 THEN try_cast({_whole} || '.' || {_part} AS DECIMAL(38,18)) END"

    @classmethod
    def within(cls, limit) -> str:
        return f"({cls.is_zero} OR coalesce({cls.wide} <= CAST('{limit}' AS DECIMAL(38,18)), false))"


# what each step adds to the parts of a text; later steps read those before them
_PARTS = (
    {"text": f"replace({ascii_digits_sql('g.raw')}, '_', '')"},
    {
        "zero": r"g.text RLIKE r'^[+-]?[0.]+([eE][+-]?\d+)?\z'", "mantissa": "regexp_replace(g.text, '[eE].*$|[+-]', '')",
        "exponent": r"CASE WHEN g.text RLIKE '[eE]' THEN try_cast(regexp_extract(g.text, r'[eE]([+-]?\d+)$', 1) AS INT) ELSE 0 END",
    },
    {"digits": "trim(TRAILING '0' FROM replace(g.mantissa, '.', ''))", "lead": "CAST(length(substring_index(g.mantissa, '.', 1)) AS BIGINT) + g.exponent"},
    {"core": "trim(LEADING '0' FROM g.digits)"},
    {"point": "g.lead - length(g.digits) + length(g.core)"},
)


def _struct(raw: str, error: str) -> str:
    return f"named_struct('raw', {raw}, 'error', {error})"


def _apart(x: str, rule: str) -> str:
    """``rule`` on the parts ``g`` of one value, as lambdas: Spark evaluates them without generated code, so the many steps of the general rules do
    not swell the code that every row runs through beyond what the JVM compiles. Each part is made once and read by its name."""
    taken, known = f"array(named_struct('raw', {x}))", ["raw"]
    for step in _PARTS:
        fields = [f"'{k}', g.{k}" for k in known] + [f"'{k}', {v}" for k, v in step.items()]
        taken, known = f"transform({taken}, g -> named_struct({', '.join(fields)}))", [*known, *step]
    return f"transform({taken}, g -> {rule})[0]"


def _positive(x: str, plain: str, kind: str, shape_error: str, limit, shape: str) -> str:
    g = _General
    value = f"try_cast({x} AS {kind})"
    error = (
        f"CASE WHEN {x} IS NULL THEN 'MISSING_REQUIRED' "
        f"WHEN {x} RLIKE {plain} THEN CASE WHEN {value} = 0 THEN 'NON_POSITIVE' END ELSE "
    )
    general = (
        f"CASE WHEN NOT {g.is_number} THEN 'INVALID_NUMBER' WHEN {g.is_zero} OR {g.is_negative} THEN 'NON_POSITIVE' "
        f"WHEN NOT {g.within(limit)} OR NOT ({shape}) THEN '{shape_error}' END"
    )
    error = f"{error}{_apart(x, general)} END"
    raw = f"CASE WHEN {x} RLIKE {plain} THEN {value} ELSE {_apart(x, f'try_cast({g.wide} AS {kind})')} END"
    return _struct(raw, error)


def money_sql(x: str) -> str:
    """Required positive money with two exact decimals, up to the money limit (D3)."""
    return _positive(x, _PLAIN_MONEY, "DECIMAL(14,2)", "INVALID_MONEY_PRECISION_OR_RANGE", MONEY_MAX, _General.two_decimals)


def integer_sql(x: str) -> str:
    """Required positive integer (``2.0`` is accepted) up to 2147483647 (D3)."""
    return _positive(x, _PLAIN_INTEGER, "INT", "INVALID_INTEGER", INT_MAX, _General.whole)


def nonnegative_sql(x: str, limit: str = MONEY_MAX, kind: str = "DECIMAL(16,2)") -> str:
    """Optional money: missing counts as 0.00, negatives are refused."""
    g = _General
    general = (
        f"CASE WHEN NOT {g.is_number} THEN 'INVALID_NUMBER' WHEN {g.is_negative} THEN 'NEGATIVE_AMOUNT' "
        f"WHEN NOT {g.within(limit)} OR NOT ({g.two_decimals}) THEN 'INVALID_MONEY_PRECISION_OR_RANGE' END"
    )
    error = f"CASE WHEN {x} IS NULL OR {x} RLIKE {_PLAIN_MONEY} THEN CAST(NULL AS STRING) ELSE {_apart(x, general)} END"
    value = f"CASE WHEN {g.is_zero} THEN CAST(0 AS {kind}) ELSE try_cast({g.wide} AS {kind}) END"
    raw = (
        f"CASE WHEN {x} IS NULL THEN CAST(0 AS {kind}) WHEN {x} RLIKE {_PLAIN_MONEY} THEN try_cast({x} AS {kind}) "
        f"ELSE {_apart(x, value)} END"
    )
    return _struct(raw, error)


def accepted_sql(parsed: str) -> str:
    """Value of a parsed number, null where its rule failed."""
    return f"CASE WHEN {parsed}.error IS NULL THEN {parsed}.raw END"


def line_sql(x: str) -> str:
    """Decimal digits only, 1 to 2147483647; null otherwise."""
    d = ascii_digits_sql(x)
    return rf"CASE WHEN {d} RLIKE r'^\d+\z' AND try_cast({d} AS INT) > 0 THEN try_cast({d} AS INT) END"


def positive_money(cleaned: str) -> Column:
    return F.expr(money_sql(cleaned))


def positive_integer(cleaned: str) -> Column:
    return F.expr(integer_sql(cleaned))


def nonnegative_money(cleaned: str, limit: str = MONEY_MAX, kind: str = "DECIMAL(16,2)") -> Column:
    return F.expr(nonnegative_sql(cleaned, limit, kind))


def accepted(parsed: str) -> Column:
    return F.expr(accepted_sql(parsed))


def line_number(cleaned: str) -> Column:
    return F.expr(line_sql(cleaned))


def ratio_pct(part: Column, whole: Column) -> Column:
    """``ROUND(100 * part / NULLIF(whole, 0), 2)``; null when there is no whole."""
    exact = 100 * part.cast("decimal(24,2)") / F.nullif(whole.cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    return F.round(exact, 2)


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null when there is no whole."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def promo_discount(kind: Column, value: Column, gross: Column) -> Column:
    """Percentage of gross (half-up cents) or a fixed amount, never above gross."""
    percentage = F.round(gross * value / 100, 2).cast("decimal(16,2)")
    granted = F.least(F.when(kind == "percentage", percentage).otherwise(value.cast("decimal(16,2)")), gross)
    return F.when(kind.isNotNull(), granted)  # least() skips nulls
