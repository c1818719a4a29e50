"""Declared constraints as queries that return their violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C

AMOUNT_RULES = {
    "gross_is_quantity_times_price": "gross_amount = CAST(quantity * unit_price AS DECIMAL(16,2))",
    "discount_within_gross": "discount_amount <= gross_amount",
    "net_is_gross_minus_discount": "net_amount = gross_amount - discount_amount",
}
SALE_DOMAINS = {
    "line_positive": "source_line_number > 0", "quantity_positive": "quantity > 0",
    "price_not_negative": "unit_price >= 0", "discount_not_negative": "discount_amount >= 0",
    "net_not_negative": "net_amount >= 0",
    "status_known": f"sale_status IN {C.SALE_STATUSES}", "source_known": f"source_name IN {C.CHANNEL_CODES}",
}
RETURN_RULES = {
    "refund_matches_status": (
        "(refund_status = 'PROCESSED' AND refund_amount IS NOT NULL AND refund_amount >= 0) "
        "OR (refund_status <> 'PROCESSED' AND refund_amount IS NULL)"
    ),
    "no_refund_on_open_return": "return_status NOT IN ('PENDING', 'REJECTED') OR refund_status <> 'PROCESSED'",
    "units_positive": "quantity_returned > 0",
    "return_status_known": f"return_status IN {C.RETURN_STATUSES}",
    "refund_status_known": f"refund_status IN {C.REFUND_STATUSES}",
}
DIMENSION_RULES = {
    "dim_date": {
        "date_key_range": "date_key BETWEEN 20000101 AND 21001231", "day_range": "day_of_month BETWEEN 1 AND 31",
        "month_range": "month_number BETWEEN 1 AND 12", "quarter_range": "quarter_number BETWEEN 1 AND 4",
        "year_range": "year_number BETWEEN 2000 AND 2100",
    },
    "dim_channel": {
        "code_known": f"channel_code IN {C.CHANNEL_CODES}", "type_known": "channel_type IN ('MARKETPLACE', 'DIRECT', 'OFFLINE')",
    },
    "dim_product": {"price_not_negative": "standard_price >= 0"},
    "dim_promotion": {
        "value_positive": "discount_value > 0", "dates_ordered": "end_date >= start_date",
        "kind_known": f"discount_type IN {C.PROMO_KINDS}", "status_known": f"status IN {C.PROMO_STATUSES}",
    },
}
AUDIT_RULES = {
    "runs": {"end_after_start": "ended_at IS NULL OR ended_at >= started_at"},
    "stages": {"end_after_start": "ended_at >= started_at"},
    "stale": {"resolved_pair": "(resolved_at IS NULL) = (resolved_run_id IS NULL)"},
}


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by several rows (L1)."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def orphans(child: DataFrame, parent: DataFrame, on: list[str] | dict[str, str]) -> DataFrame:
    """Child rows whose reference has no parent (L2); null references are allowed.

    Only distinct references meet the parent, so a popular reference is joined once.
    """
    pairs = on if isinstance(on, dict) else {c: c for c in on}
    used = child.select(*pairs).groupBy(*pairs).agg(F.count(F.lit(1)).alias("child_rows"))
    for column in pairs:
        used = used.where(F.col(column).isNotNull())
    target = parent.select(*[F.col(p).alias(c) for c, p in pairs.items()])
    return used.join(target, list(pairs), "left_anti")


def violations(table: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Rows per broken rule in one pass (L3-L7); as in SQL, a null test passes."""
    counts = table.agg(*[F.count_if(~_passes(test)).alias(name) for name, test in rules.items()])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]))
    )


def _passes(test: str) -> Column:
    return F.coalesce(F.expr(test), F.lit(True))


def broken_rows(table: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The rows breaking any rule, with the names of the rules."""
    names = F.array_compact(F.array(*[F.when(~_passes(t), F.lit(n)) for n, t in rules.items()]))
    return table.withColumn("broken_rules", names).where(F.size("broken_rules") > 0)


def warehouse_check(facts: DataFrame, detail: DataFrame, loaded_records: int | None = None) -> DataFrame:
    """Active fact count, view count and duplicate keys in one row."""
    key = ["source_name", "source_order_id", "source_line_number"]
    one = F.lit(1).alias("_one")
    active = facts.agg(F.count_if("is_source_active").alias("active_facts"), F.count(F.lit(1)).alias("all_facts"))
    viewed = detail.agg(F.count(F.lit(1)).alias("view_rows"))
    doubled = duplicate_keys(facts, key).agg(F.count(F.lit(1)).alias("duplicate_keys"))
    joined = active.select("*", one).join(viewed.select("*", one), "_one").join(doubled.select("*", one), "_one").drop("_one")
    ok = (F.col("active_facts") == F.col("view_rows")) & (F.col("duplicate_keys") == 0)
    if loaded_records is not None:
        ok = ok & (F.lit(loaded_records) <= F.col("all_facts"))
    return joined.withColumn("passes", ok)


def require_warehouse(check: DataFrame) -> None:
    row = check.first()
    if not row["passes"]:
        raise RuntimeError(f"warehouse check failed: {row.asDict()}")


def any_multi_line_order(*tables: DataFrame) -> bool:
    """Whether any table holds an order with several lines."""
    key = ["source_name", "source_order_id"]
    for table in tables:
        per_order = table.groupBy(*key).agg((F.min("source_line_number") < F.max("source_line_number")).alias("_multi"))
        if not per_order.where("_multi").isEmpty():
            return True
    return False


def blocks_removal(*tables: tuple[DataFrame, str]) -> bool:
    """Guard before a destructive change: does any table hold a row that still needs it (J6)?"""
    return any(not table.where(condition).isEmpty() for table, condition in tables)
