"""Text standardisation as JVM-side SQL expressions.

The builders ending in ``_sql`` take and return SQL text, so rules over many
columns reach Spark as one parsed expression each; the other functions wrap
them as columns. Unicode work (compatibility composition and case folding)
goes through the ICU library that ships with Spark, called with the SQL
function ``reflect`` and only for values holding a non-ASCII character, so no
Python worker is started for text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.contracts import CHANNEL_ALIASES, CITIES, MISSING_MARKERS, PAYMENTS

_MARKERS = ", ".join(f"'{m}'" for m in MISSING_MARKERS)
_LONGEST_MARKER = max(map(len, MISSING_MARKERS))
_NON_ASCII = r"r'[^\x00-\x7F]'"
_BLANKS = r"r'(?U)[\s\x1c-\x1f]+'"
# anything but printable ASCII with single blanks needs the full treatment
_UNUSUAL = r"r'[^\x20-\x7E]|  '"


def _composed_sql(x: str) -> str:
    return f"CASE WHEN {x} RLIKE {_NON_ASCII} THEN reflect('com.ibm.icu.text.Normalizer', 'compose', {x}, true) ELSE {x} END"


def _folded_sql(x: str) -> str:
    return f"CASE WHEN {x} RLIKE {_NON_ASCII} THEN reflect('com.ibm.icu.lang.UCharacter', 'foldCase', {x}, true) ELSE lower({x}) END"


def tidy_sql(x: str, unicode: bool = True) -> str:
    """Composed, whitespace-collapsed, trimmed text; plain cells only pay one scan."""
    full = f"regexp_replace({_composed_sql(x) if unicode else x}, {_BLANKS}, ' ')"
    return f"trim(CASE WHEN {x} RLIKE {_UNUSUAL} THEN {full} ELSE {x} END)"


def unmarked_sql(tidy: str) -> str:
    """Null for the missing markers."""
    return f"CASE WHEN NOT (length({tidy}) <= {_LONGEST_MARKER} AND lower({tidy}) IN ({_MARKERS})) THEN {tidy} END"


def missing_sql(x: str) -> str:
    return f"lower(trim(coalesce({x}, ''))) IN ({_MARKERS})"


def match_key_sql(cleaned: str, unicode: bool = True) -> str:
    """Case-folded text without blanks, ``_`` and ``-``; cleaned text holds no blank but the space."""
    folded = _folded_sql(cleaned) if unicode else f"lower({cleaned})"
    return f"translate(coalesce({folded}, ''), ' _-', '')"


def _plain_key(member: str) -> str:
    return member.lower().replace(" ", "").replace("-", "").replace("_", "")


def _canonical_sql(cleaned: str, members, unicode: bool) -> str:
    cases = " ".join(f"WHEN '{_plain_key(m)}' THEN '{m}'" for m in members)
    return f"CASE {match_key_sql(cleaned, unicode)} {cases} END"


def city_sql(cleaned: str, unicode: bool = True) -> str:
    return f"coalesce({_canonical_sql(cleaned, CITIES, unicode)}, {cleaned})"


def known_payment_sql(cleaned: str, unicode: bool = True) -> str:
    return _canonical_sql(cleaned, PAYMENTS, unicode)


def email_sql(cleaned: str) -> str:
    return rf"{cleaned} RLIKE r'(?U)^[^\s@]+@[^\s@]+\.[^\s@]+\z'"


def channel_sql(cleaned: str) -> str:
    cases = " ".join(f"WHEN '{alias}' THEN '{code}'" for alias, code in CHANNEL_ALIASES.items())
    return f"CASE upper({cleaned}) {cases} END"


# ------------------------------------------------------------------ columns


def is_missing(x: str) -> Column:
    """True for null, blank and the spelled-out missing markers."""
    return F.expr(missing_sql(x))


def usable_text(x: str) -> Column:
    return F.expr(f"NOT ({missing_sql(x)})")


def clean_text(x: str, unicode: bool = True) -> Column:
    """Compose (NFKC), collapse whitespace, trim; missing markers become null.

    ``unicode=False`` skips the composition for columns known to be ASCII.
    """
    return F.expr(unmarked_sql(tidy_sql(x, unicode)))


def with_clean_text(df: DataFrame, columns: dict[str, str], unicode: bool = True) -> DataFrame:
    """Add cleaned versions of many columns (output name -> input name).

    Two projections: the tidied text is computed once and then tested.
    """
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    tidied = df.selectExpr(*kept, *[f"{tidy_sql(f'CAST(`{source}` AS STRING)', unicode)} AS `{out}`" for out, source in columns.items()])
    return tidied.selectExpr(*kept, *[f"{unmarked_sql(f'`{out}`')} AS `{out}`" for out in columns])


def match_key(x: str, cleaned: bool = False, unicode: bool = True) -> Column:
    """Matching form of a text; '' when missing."""
    return F.expr(match_key_sql(x if cleaned else unmarked_sql(tidy_sql(x, unicode)), unicode))


def canonical_city(cleaned: str, unicode: bool = True) -> Column:
    """Known cities get their standard spelling; unknown ones are kept."""
    return F.expr(city_sql(cleaned, unicode))


def canonical_payment(cleaned: str, unicode: bool = True) -> tuple[Column, Column]:
    """(standard or original payment, flag for an unknown one)."""
    known = known_payment_sql(cleaned, unicode)
    return F.expr(f"coalesce({known}, {cleaned})"), F.expr(f"{cleaned} IS NOT NULL AND {known} IS NULL")


def valid_email(cleaned: str) -> Column:
    return F.expr(email_sql(cleaned))


def known_channel(cleaned: str) -> Column:
    """Channel code of a cleaned name, aliases resolved; null when unknown."""
    return F.expr(channel_sql(cleaned))


def channel_code(x: str, unicode: bool = True) -> Column:
    """Channel code of a raw name."""
    return F.expr(channel_sql(unmarked_sql(tidy_sql(x, unicode))))


def blank_default(x: str, default: str) -> Column:
    """Trimmed text, or ``default`` when null or blank (C14)."""
    return F.expr(f"coalesce(nullif(trim({x}), ''), '{default}')")


def contains_any(columns, query: str) -> Column:
    """Case-insensitive 'any of the columns contains the query'."""
    needle = query.strip().lower()
    tests = [F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).contains(needle) for c in columns]
    return reduce(lambda a, b: a | b, tests) if needle else F.lit(True)
