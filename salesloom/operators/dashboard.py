"""Filters, charts, rankings, paging and period comparison over the sales detail."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.contracts import REFUND_STATUSES, RETURN_STATUSES
from salesloom.functions import numbers, text
from salesloom.functions.dates import month_label
from salesloom.operators import kpi


@dataclass(frozen=True)
class SalesFilter:
    """Date range plus optional multi-selects (C7); an empty list selects all."""

    start: str
    end: str
    channels: tuple = ()
    statuses: tuple = ()
    categories: tuple = ()
    brands: tuple = ()
    products: tuple = ()

    def condition(self, day: str = "order_date") -> Column:
        test = F.col(day).between(F.lit(self.start).cast("date"), F.lit(self.end).cast("date"))
        for column, chosen in (
            ("channel_name", self.channels), ("sale_status", self.statuses), ("category", self.categories),
            ("brand", self.brands), ("product_id", self.products),
        ):
            if chosen:
                test = test & F.col(column).isin(*chosen)
        return test

    def previous(self) -> "SalesFilter":
        """Range of the same length that ends the day before."""
        start, end = date.fromisoformat(self.start), date.fromisoformat(self.end)
        days = (end - start).days + 1
        before = start - timedelta(days=1)
        return SalesFilter(
            (before - timedelta(days=days - 1)).isoformat(), before.isoformat(),
            self.channels, self.statuses, self.categories, self.brands, self.products,
        )


def apply_filter(detail: DataFrame, chosen: SalesFilter) -> DataFrame:
    return detail.where(chosen.condition())


def default_range(detail: DataFrame, today: str) -> DataFrame:
    """First order date (or today) to today."""
    return detail.agg(
        F.coalesce(F.min("order_date"), F.lit(today).cast("date")).alias("start_date"),
        F.lit(today).cast("date").alias("end_date"),
    )


def eligible(detail: DataFrame) -> DataFrame:
    """Sales that count."""
    return detail.where(F.col("sale_status").isin("COMPLETED", "RETURNED"))


def _net() -> Column:
    return F.coalesce(F.sum(F.col("net_amount") - F.col("processed_refund_amount")), F.lit(0).cast("decimal(26,2)"))


def dashboard_metrics(detail: DataFrame) -> DataFrame:
    """The 18 filtered measures (G12); pass the filtered detail."""
    m = kpi.measures(detail, [], {"unresolved_city_records": text.missing_sql("city")})
    rate = lambda part, whole: F.coalesce(numbers.ratio_pct(F.col(part), F.col(whole)), F.lit(0))
    return m.select(
        "gross_order_value_all_statuses", F.col("gross_sales_eligible").alias("gross_sales"),
        F.col("sales_after_discount_eligible").alias("sales_after_discount"),
        F.col("net_sales_after_refunds").alias("net_sales"), F.col("discounts_eligible").alias("discount_total"),
        "eligible_orders", "completed_orders", "eligible_units", F.col("total_orders_all_statuses").alias("total_orders"),
        "returned_orders", "returned_order_lines", "returned_units", "processed_refund_amount",
        rate("returned_orders", "eligible_orders").alias("order_return_rate"),
        rate("returned_order_lines", "eligible_lines").alias("line_return_rate"),
        rate("returned_units", "eligible_units").alias("return_rate"),
        "unresolved_city_records", F.col("total_lines").alias("total_records"),
    )


def derived_metrics(metrics: DataFrame, previous: DataFrame) -> DataFrame:
    """AOV, change against the previous period and city coverage."""
    joined = metrics.withColumn("_one", F.lit(1)).join(
        previous.select(F.col("net_sales").alias("previous_net"), F.lit(1).alias("_one")), "_one"
    )
    net, before = F.col("net_sales").cast("double"), F.col("previous_net").cast("double")
    known = F.col("total_records") - F.col("unresolved_city_records")
    return joined.select(
        F.coalesce(numbers.safe_ratio(net, F.col("eligible_orders")), F.lit(0.0)).alias("average_order_value"),
        F.when(before != 0, (net - before) / before * 100).alias("net_change_percent"),
        F.coalesce(numbers.safe_ratio(known, F.col("total_records")) * 100, F.lit(0.0)).alias("known_city_coverage_rate"),
    )


def run_rates(latest_run: DataFrame) -> DataFrame:
    """Rejected, duplicate and fact-load rates of a run."""
    pct = lambda a, b: F.coalesce(numbers.safe_ratio(F.col(a), F.col(b)) * 100, F.lit(0.0))
    return latest_run.select(
        "run_id", pct("rejected_records", "extracted_records").alias("rejected_record_rate"),
        pct("duplicate_records", "extracted_records").alias("duplicate_rate"),
        pct("fact_inserted_records", "incremental_records").alias("fact_load_rate"),
    )


# ------------------------------------------------------------------- charts


def chart_month(detail: DataFrame) -> DataFrame:
    """Net and gross per month label."""
    ok = F.col("sale_status").isin("COMPLETED", "RETURNED")
    net = F.sum(F.when(ok, F.col("net_amount") - F.col("processed_refund_amount")))
    zero = F.lit(0).cast("decimal(26,2)")
    return (
        detail.groupBy(month_label(F.col("order_date")).alias("label"))
        .agg(F.coalesce(net, zero).alias("net"), F.coalesce(F.sum(F.when(ok, F.col("gross_amount"))), zero).alias("gross"))
        .orderBy("label")
    )


def chart_channel(detail: DataFrame) -> DataFrame:
    """Net per channel."""
    grouped = eligible(detail).groupBy(F.col("channel_name").alias("label")).agg(_net().alias("value"))
    return grouped.orderBy(F.desc("value"), "label")


def chart_status(detail: DataFrame) -> DataFrame:
    """Lines and net per status."""
    ok = F.col("sale_status").isin("COMPLETED", "RETURNED")
    net = F.sum(F.when(ok, F.col("net_amount") - F.col("processed_refund_amount")))
    return (
        detail.groupBy(F.col("sale_status").alias("label"))
        .agg(F.count(F.lit(1)).alias("orders"), F.coalesce(net, F.lit(0).cast("decimal(26,2)")).alias("net_sales"))
        .orderBy("label")
    )


def _ranked(detail: DataFrame, label: Column, limit: int | None) -> DataFrame:
    grouped = eligible(detail).groupBy(label.alias("label")).agg(_net().alias("value"))
    ordered = grouped.orderBy(F.desc("value"), "label")
    return ordered if limit is None else ordered.limit(limit)


def chart_category(detail: DataFrame) -> DataFrame:
    """Net per category, blank ones named."""
    return _ranked(detail, text.blank_default("category", "Uncategorized"), None)


def top_products(detail: DataFrame, limit: int = 10) -> DataFrame:
    """Best products by units."""
    return (
        eligible(detail)
        .groupBy(F.col("product_name").alias("label"))
        .agg(F.sum("quantity").alias("quantity"), _net().alias("net_sales"))
        .orderBy(F.desc("quantity"), "label")
        .limit(limit)
    )


def top_cities(detail: DataFrame, limit: int = 6) -> DataFrame:
    """Best usable cities by net."""
    return _ranked(detail.where(text.usable_text("city")), F.col("city"), limit)


def top_brands(detail: DataFrame, limit: int = 7) -> DataFrame:
    return _ranked(detail, text.blank_default("brand", "Unknown brand"), limit)


def top_skus(detail: DataFrame, limit: int = 7) -> DataFrame:
    return _ranked(detail, text.blank_default("product_id", "Unknown SKU"), limit)


def top_promotions(detail: DataFrame, limit: int = 10) -> DataFrame:
    """Promo codes by discount given, with distinct orders by a two-step count."""
    used = eligible(detail).where(F.col("promo_code").isNotNull() & text.usable_text("promo_code"))
    per_order = used.groupBy(F.col("promo_code").alias("label"), *kpi.ORDER).agg(F.sum("discount_amount").alias("_d"))
    return (
        per_order.groupBy("label")
        .agg(F.sum("_d").alias("value"), F.count(F.lit(1)).alias("orders"))
        .orderBy(F.desc("value"), "label")
        .limit(limit)
    )


DETAIL_COLUMNS = (
    "source_name", "source_order_id", "source_line_number", "order_date", "product_id", "product_name", "category",
    "brand", "channel_name", "sale_status", "city", "quantity", "gross_amount", "discount_amount", "net_amount",
    "returned_units", "processed_refund_amount", "promo_code",
)


def detail_rows(detail: DataFrame) -> DataFrame:
    """Filtered lines, newest first, ties by business key."""
    return detail.select(*DETAIL_COLUMNS).orderBy(
        F.desc("order_date"), F.desc("source_name"), F.desc("source_order_id"), F.desc("source_line_number")
    )


SEARCH_COLUMNS = ("source_order_id", "product_name", "product_id", "channel_name", "category", "sale_status", "promo_code")


def search_lines(detail: DataFrame, query: str) -> DataFrame:
    """Case-insensitive search over seven columns."""
    return detail.where(text.contains_any(SEARCH_COLUMNS, query))


def page(ordered: DataFrame, number: int, size: int) -> DataFrame:
    """One page of an ordered DataFrame, the page number clamped to the pages there are."""
    pages = max(1, -(-ordered.count() // size))
    number = max(1, min(number, pages))
    return ordered.offset((number - 1) * size).limit(size)


def filter_options(detail: DataFrame) -> DataFrame:
    """Sorted distinct values per filter (I9): values are combined before they are collected per filter."""
    pairs = detail.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("option"), F.col(column).alias("value"))
                    for name, column in (
                        ("channels", "channel_name"), ("categories", "category"), ("statuses", "sale_status"),
                        ("brands", "brand"), ("products", "product_id"),
                    )
                ]
            )
        )
    )
    return pairs.distinct().where("value IS NOT NULL").orderBy("option", "value")


def distinct_choices(detail: DataFrame) -> DataFrame:
    """Distinct filter combinations."""
    return detail.select("channel_name", "category", "sale_status", "brand", "product_id").distinct()


def previous_period(detail: DataFrame, chosen: SalesFilter) -> DataFrame:
    """Net, gross and orders of the previous comparable period (G21); pass the unfiltered detail."""
    m = kpi.measures(eligible(detail).where(chosen.previous().condition()), [])
    return m.select(
        F.col("net_sales_after_refunds").alias("net_sales"), F.col("gross_sales_eligible").alias("gross_sales"),
        F.col("eligible_orders").alias("orders"),
    )


def export_rows(detail: DataFrame) -> DataFrame:
    """Detail rows as text for a fully quoted export."""
    rows = detail_rows(detail)
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("None")).alias(c) for c in rows.columns])


def display_types(rows: DataFrame) -> DataFrame:
    """Decimals as double and dates as ISO text."""
    columns = []
    for name, kind in rows.dtypes:
        if kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        elif kind == "date":
            columns.append(F.date_format(name, "yyyy-MM-dd").alias(name))
        else:
            columns.append(F.col(name))
    return rows.select(*columns)


# ------------------------------------------------------------------ returns


def return_rows(return_facts: DataFrame, lines: DataFrame, chosen: SalesFilter | None = None) -> DataFrame:
    """Return events with channel and product of their sale (F6), filtered on the return date."""
    sale = lines.select(
        "source_name", "source_order_id", "source_line_number", "channel_name", "sale_status", "product_id",
        "product_name", "brand", "category",
    )
    joined = return_facts.join(sale, ["source_name", "source_order_id", "source_line_number"], "inner")
    return joined if chosen is None else joined.where(chosen.condition("return_date"))


def _refund() -> Column:
    paid = F.sum(F.when(F.col("refund_status") == "PROCESSED", F.col("refund_amount")))
    return F.coalesce(paid, F.lit(0).cast("decimal(26,2)")).alias("processed_refund_amount")


def _position(column: str, members) -> Column:
    table = F.create_map(*[F.lit(x) for i, m in enumerate(members, 1) for x in (m, i)])
    return F.coalesce(table[F.col(column)], F.lit(len(members) + 1))


_EVENTS, _UNITS = (lambda: F.count(F.lit(1)).alias("events")), (lambda: F.sum("quantity_returned").alias("units"))
REFUND_ORDER = ("PENDING", "PROCESSED", "FAILED", "NOT_APPLICABLE")


def returns_by_status(rows: DataFrame) -> DataFrame:
    """Events, units and refunds per return status in workflow order."""
    refunded = F.count_if(F.col("refund_status") == "PROCESSED").alias("refunded_events")
    return (
        rows.groupBy(F.col("return_status").alias("label")).agg(_EVENTS(), _UNITS(), refunded, _refund())
        .orderBy(_position("label", RETURN_STATUSES))
    )


def returns_by_refund_status(rows: DataFrame) -> DataFrame:
    """Per refund status."""
    grouped = rows.groupBy(F.col("refund_status").alias("label")).agg(_EVENTS(), _refund())
    return grouped.orderBy(_position("label", REFUND_ORDER))


def returns_by_channel(rows: DataFrame) -> DataFrame:
    """Per channel with open and refused events."""
    count = lambda s: F.count_if(F.col("return_status") == s)
    return (
        rows.groupBy(F.col("channel_name").alias("label"))
        .agg(_EVENTS(), _UNITS(), count("PENDING").alias("pending_events"), count("REJECTED").alias("rejected_events"), _refund())
        .orderBy(F.desc("events"), "label")
    )


def top_return_reasons(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent reasons."""
    grouped = rows.groupBy(F.col("return_reason").alias("label")).agg(_EVENTS(), _UNITS(), _refund())
    return grouped.orderBy(F.desc("events"), "label").limit(limit)


def returns_monthly(rows: DataFrame) -> DataFrame:
    """Per month of return."""
    return rows.groupBy(month_label(F.col("return_date")).alias("label")).agg(_EVENTS(), _UNITS(), _refund()).orderBy("label")


RETURN_ROW_COLUMNS = (
    "return_date", "return_id", "return_line_number", "channel_name", "source_order_id", "source_line_number",
    "product_id", "product_name", "return_status", "return_reason", "quantity_returned", "refund_status", "refund_amount",
)


def return_listing(rows: DataFrame) -> DataFrame:
    """Newest return events first (I8)."""
    return rows.select(*RETURN_ROW_COLUMNS).orderBy(F.desc("return_date"), "return_id", "return_line_number")


def return_cards(rows: DataFrame) -> DataFrame:
    """Totals shown above the return tables."""
    count = lambda s: F.count_if(F.col("return_status") == s).alias(f"{s.lower()}_events")
    return rows.agg(F.count(F.lit(1)).alias("total_events"), *[count(s) for s in RETURN_STATUSES], _refund())


assert set(REFUND_ORDER) == set(REFUND_STATUSES)
