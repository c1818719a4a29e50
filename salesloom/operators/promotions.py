"""Promotion catalogue, per-line promotion checks and discount allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C
from salesloom.functions import dates, numbers, text
from salesloom.operators.intervals import interval_join
from salesloom.operators.skew import HOT_ROWS, annotate_keys, lookup_left_join, running_sum


def read_catalogue(rows: DataFrame, unicode: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Typed catalogue rows with the first broken rule in ``reason``.

    Codes with differing content get reason ``conflicting_code`` on every
    version; ``is_first`` marks the version kept of identical duplicates.
    """
    staged = text.with_clean_text(rows.select("source_row_number", *C.PROMO_COLUMNS), {f"_c_{c}": c for c in C.PROMO_COLUMNS}, unicode)
    staged = staged.withColumns(
        {
            "promo_code": F.upper("_c_promo_code"),
            "promo_name": F.col("_c_promo_name"),
            "discount_type": F.lower("_c_discount_type"),
            "_value": numbers.positive_money("_c_discount_value"),
            "start_date": dates.parse_date("_c_start_date", "'shopee'"),
            "end_date": dates.parse_date("_c_end_date", "'shopee'"),
            "status": F.lower("_c_status"),
        }
    )
    staged = staged.withColumn("discount_value", numbers.accepted("_value").cast("decimal(16,2)"))
    present = F.col("promo_code").isNotNull() & F.col("promo_name").isNotNull()
    reason = (
        F.when(~present | ~F.coalesce(F.col("discount_type").isin(*C.PROMO_KINDS), F.lit(False)), "code_name_or_type")
        .when(~F.coalesce(F.col("status").isin(*C.PROMO_STATUSES), F.lit(False)), "status")
        .when(~F.coalesce(F.col("start_date") <= F.col("end_date"), F.lit(False)), "date_range")
        .when(F.col("discount_value").isNull(), "discount_value")
        .when((F.col("discount_type") == "percentage") & (F.col("discount_value") > 100), "percentage")
    )
    ruled = staged.select("source_row_number", *C.PROMO_COLUMNS, reason.alias("reason"))
    content = F.struct(*[c for c in C.PROMO_COLUMNS if c != "promo_code"])
    stats = {"_low": F.min(content), "_high": F.max(content), "_first": F.min("source_row_number")}
    joined = annotate_keys(ruled, ["promo_code"], stats, ["source_row_number"], F.col("reason").isNull(), hot_rows)
    conflict = F.coalesce(F.col("_low") != F.col("_high"), F.lit(False))
    return joined.select(
        "source_row_number", *C.PROMO_COLUMNS,
        F.coalesce("reason", F.when(conflict, "conflicting_code")).alias("reason"),
        (F.col("_first").isNull() | (F.col("source_row_number") == F.col("_first"))).alias("is_first"),
    )


def valid_catalogue(catalogue: DataFrame, strict: bool = True) -> DataFrame:
    """One row per promo code; a broken row fails the job when strict."""
    if strict:
        broken = catalogue.where("reason IS NOT NULL").orderBy("source_row_number").limit(1).collect()
        if broken:
            raise ValueError(f"{C.PROMO_FILE} line {broken[0]['source_row_number'] + 1}: {broken[0]['reason']}")
    return catalogue.where("reason IS NULL AND is_first").select(*C.PROMO_COLUMNS)


def check_line_promotions(lines: DataFrame, catalogue: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """First promotion violation per channel line in ``promo_reason``.

    ``lines`` carries typed ``promo_code``, ``discount_amount``, ``order_date``,
    ``quantity``, ``unit_price``, ``source`` and ``source_row_number``; a null
    discount counts as zero. The code joins as an equi-key, the date interval
    and status are flags on the matched row.
    """
    master = catalogue.select(
        "promo_code", F.col("start_date").alias("_start"), F.col("end_date").alias("_end"),
        F.col("status").alias("_promo_status"),
    )
    joined = lookup_left_join(lines, master, ["promo_code"], ["source", "source_row_number"], hot_rows)
    discount = F.coalesce("discount_amount", F.lit(0).cast("decimal(16,2)"))
    coded = F.col("promo_code").isNotNull()
    in_range = F.coalesce(F.col("order_date").between(F.col("_start"), F.col("_end")), F.lit(False))
    gross = F.col("quantity") * F.col("unit_price")
    reason = (
        F.when(~coded & (discount > 0), "discount_without_code")
        .when(coded & F.col("_start").isNull(), "unknown_code")
        .when(coded & ~in_range, "outside_dates")
        .when(coded & (F.col("_promo_status") != "active"), "not_active")
        .when(coded & F.coalesce(discount > gross, F.lit(True)), "discount_exceeds_gross")
    )
    return joined.select(*lines.columns, reason.alias("promo_reason"))


def require_valid_promotions(checked: DataFrame) -> None:
    """Strict mode: raise with the first violation by source and row."""
    first = checked.where("promo_reason IS NOT NULL").orderBy("source", "source_row_number").limit(1).collect()
    if first:
        row = first[0]
        raise ValueError(f"promotion {row['promo_reason']} on {row['source']} row {row['source_row_number']}")


def promotion_metrics(catalogue: DataFrame, checked: DataFrame) -> DataFrame:
    """Catalogue and code counters in one row each side."""
    codes = lambda column: checked.agg(column).scalar()
    return catalogue.agg(
        F.count(F.lit(1)).alias("catalog_checked"),
        F.count_if(F.col("reason").isNull() & F.col("is_first")).alias("catalog_validated"),
        F.count_if(F.col("reason").isNull() & ~F.col("is_first")).alias("catalog_duplicates"),
    ).select(
        "*", codes(F.count("promo_code")).alias("promo_codes_checked"),
        codes(F.count_if(F.col("promo_code").isNotNull() & F.col("promo_reason").isNull())).alias("promo_codes_matched"),
    )


def active_promotions(days: DataFrame, catalogue: DataFrame, day: str = "order_date") -> DataFrame:
    """Interval join: promotions active on each day (F4); a null start or end date is open."""
    active = catalogue.where("status = 'active'").select("promo_code", "discount_type", "discount_value", "start_date", "end_date")
    return interval_join(days, active, day, "start_date", "end_date").drop("start_date", "end_date")


def promotion_versions(lines: DataFrame, versions: DataFrame, day: str = "order_date") -> DataFrame:
    """``lines`` with the version of their promotion code that holds on their day (F3, E32); lines without one have nulls.

    A code may have any number of versions with dates of their own; those that overlap each give a row.
    """
    held = interval_join(lines.select("promo_code", day).distinct(), versions, day, "start_date", "end_date", ["promo_code"])
    return lines.join(held, ["promo_code", day], "left").select(*lines.columns, *[c for c in held.columns if c not in ("promo_code", day)])


def line_discount(lines: DataFrame, catalogue: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Discount the promotion rule grants a line."""
    master = catalogue.select("promo_code", "discount_type", "discount_value")
    joined = lookup_left_join(lines, master, ["promo_code"], ["source", "source_row_number"], hot_rows)
    rule = numbers.promo_discount(F.col("discount_type"), F.col("discount_value"), F.col("gross_amount"))
    return joined.select(*lines.columns, rule.cast("decimal(16,2)").alias("rule_discount"))


def allocate_discount(
    lines: DataFrame, order_keys: list[str], line: str, gross: str, discount: str,
    hot_rows: int = HOT_ROWS, block: int | None = None,
) -> DataFrame:
    """Order discount split over its lines in proportion to gross (H4).

    Each line gets its half-up cent share, capped by its gross and by what is
    left; the last line takes the rest. As a share is only ever cut by the
    remaining amount, the allocation is the difference of two capped prefix
    sums, so no ordered fold over the order is needed.
    """
    money = "decimal(16,2)"
    totals = {"_total": F.sum(gross), "_last": F.max(line)}
    marked = annotate_keys(lines, order_keys, totals, [line], hot_rows=hot_rows)
    total = F.coalesce("_total", gross)
    is_last = F.coalesce("_last", line) == F.col(line)
    share = F.round(F.col(discount) * F.col(gross) / F.nullif(total, F.lit(0).cast("decimal(16,2)")), 2).cast(money)
    share = F.when(is_last, F.lit(0).cast(money)).otherwise(F.least(share, F.col(gross)))
    marked = marked.select(*lines.columns, share.alias("_share"), is_last.alias("_is_last"))
    extra = {} if block is None else {"block": block}
    summed = running_sum(marked, order_keys, line, {"_through": "_share"}, **extra)
    # the last line adds nothing to the prefix sum, so its sum is that of the lines before it
    through = F.least(F.col("_through"), F.col(discount))
    before = F.least(F.col("_through") - F.col("_share"), F.col(discount))
    amount = F.when(F.col("_is_last"), F.col(discount) - through).otherwise(through - before)
    return summed.select(*lines.columns, amount.cast(money).alias("allocated_discount"))


def promotion_reason_text(reason: Column) -> Column:
    """Stable upper-case rule name for audit rows."""
    return F.concat(F.lit("PROMO_"), F.upper(reason))
