"""Return-adjusted sales KPIs over the sales detail.

Order counts need no ``COUNT(DISTINCT)``: rows are first combined to one row
per (group, order) with flags and partial sums, then the flags are counted.
That keeps the plan at two hash aggregations, without the Expand that several
filtered distinct counts would multiply the rows by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom.functions.dates import month_start
from salesloom.functions.numbers import ratio_pct

ORDER = ["source_name", "source_order_id"]
MEASURES = ("gross_amount", "net_amount", "discount_amount", "quantity", "returned_units", "processed_refund_amount")


def order_grain(detail: DataFrame, by: list[str], counts: dict[str, str] | None = None) -> DataFrame:
    """One row per (group, order): flags, line counts and sums, split by eligibility.

    ``counts`` adds conditional line counts: name -> SQL condition.
    """
    flagged = detail.selectExpr(
        "*", "sale_status IN ('COMPLETED', 'RETURNED') AS _ok", "sale_status = 'COMPLETED' AS _done",
        "sale_status = 'RETURNED' AS _back", "sale_status IN ('COMPLETED', 'RETURNED') AND returned_units > 0 AS _ret",
    )
    measured = [
        "max(_ok) AS has_eligible", "max(_done) AS has_completed", "max(_back) AS has_returned_status",
        "max(_ret) AS has_returned_units", "count(1) AS lines", "count_if(_ok) AS eligible_lines",
        "count_if(_ret) AS returned_lines", *[f"sum({m}) AS all_{m}" for m in MEASURES],
        *[f"sum(CASE WHEN _ok THEN {m} END) AS ok_{m}" for m in MEASURES],
        *[f"sum(CASE WHEN _done THEN {m} END) AS done_{m}" for m in ("net_amount", "quantity")],
        *[f"count_if({test}) AS {name}" for name, test in (counts or {}).items()],
    ]
    return flagged.groupBy(*by, *ORDER).agg(*[F.expr(m) for m in measured])


def _sum(column: str, decimal: bool = True) -> str:
    return f"coalesce(sum({column}), CAST(0 AS {'DECIMAL(26,2)' if decimal else 'BIGINT'}))"


def measures(detail: DataFrame, by: list[str], counts: dict[str, str] | None = None) -> DataFrame:
    """All building-block measures per group; the ones not selected later are pruned from the plan."""
    money = {
        "gross_order_value_all_statuses": "all_gross_amount", "gross_sales_eligible": "ok_gross_amount",
        "sales_after_discount_eligible": "ok_net_amount", "discounts_eligible": "ok_discount_amount",
        "processed_refund_amount": "ok_processed_refund_amount", "net_all": "all_net_amount",
        "refund_all": "all_processed_refund_amount", "net_sales_completed": "done_net_amount",
    }
    whole = {
        "eligible_units": "ok_quantity", "returned_order_lines": "returned_lines", "returned_units": "ok_returned_units",
        "eligible_lines": "eligible_lines", "total_lines": "lines", "units_all": "all_quantity",
        "returned_units_all": "all_returned_units", "completed_units": "done_quantity", **{n: n for n in counts or {}},
    }
    flags = {
        "eligible_orders": "has_eligible", "completed_orders": "has_completed",
        "returned_status_orders": "has_returned_status", "returned_orders": "has_returned_units",
    }
    columns = [
        "count(1) AS total_orders_all_statuses", *[f"count_if({c}) AS {n}" for n, c in flags.items()],
        *[f"{_sum(c)} AS {n}" for n, c in money.items()], *[f"{_sum(c, False)} AS {n}" for n, c in whole.items()],
        f"{_sum('ok_net_amount')} - {_sum('ok_processed_refund_amount')} AS net_sales_after_refunds",
    ]
    return order_grain(detail, by, counts).groupBy(*by).agg(*[F.expr(c) for c in columns])


def _aov(net: str, orders: str) -> Column:
    wide = F.col(net).cast("decimal(24,2)")
    return F.round(wide / F.nullif(F.col(orders).cast("decimal(18,0)"), F.lit(0).cast("decimal(18,0)")), 2)


UNIT_RATE = ("unit_return_rate_pct", "returned_units", "eligible_units")


def _rate(name: str, part: str, whole: str) -> Column:
    return ratio_pct(F.col(part), F.col(whole)).alias(name)


def overall_kpi(detail: DataFrame) -> DataFrame:
    """Overall KPI, one row."""
    m = measures(detail, [])
    return m.select(
        "gross_order_value_all_statuses", "gross_sales_eligible", "sales_after_discount_eligible",
        "net_sales_after_refunds", "discounts_eligible", "total_orders_all_statuses", "eligible_orders",
        "completed_orders", "returned_status_orders", "eligible_units", "returned_orders", "returned_order_lines",
        "returned_units", "processed_refund_amount",
        _rate("order_return_rate_pct", "returned_orders", "eligible_orders"),
        _rate("line_return_rate_pct", "returned_order_lines", "eligible_lines"), _rate(*UNIT_RATE),
        _aov("net_sales_after_refunds", "eligible_orders").alias("average_order_value_after_refunds"),
    )


def _grouped_kpi(detail: DataFrame, by: list[str]) -> DataFrame:
    return measures(detail, by).select(
        *by, "gross_sales_eligible", "sales_after_discount_eligible", "net_sales_after_refunds", "eligible_orders",
        "eligible_units", "returned_orders", "returned_order_lines", "returned_units", "processed_refund_amount",
        _rate(*UNIT_RATE),
    )


def monthly_kpi(detail: DataFrame) -> DataFrame:
    """KPI per order month."""
    return _grouped_kpi(detail.withColumn("month_start", month_start(F.col("order_date"))), ["month_start"])


def channel_kpi(detail: DataFrame) -> DataFrame:
    """KPI per channel."""
    return _grouped_kpi(detail, ["channel_code", "channel_name", "channel_type"])


PRODUCT = ["product_id", "product_name", "brand", "category"]


def product_kpi(detail: DataFrame) -> DataFrame:
    """KPI per product."""
    return measures(detail, PRODUCT).select(
        *PRODUCT, "gross_sales_eligible", "sales_after_discount_eligible", "net_sales_after_refunds",
        "eligible_units", "returned_units", "processed_refund_amount", "eligible_orders",
    )


def status_kpi(detail: DataFrame) -> DataFrame:
    """KPI per sale status."""
    return measures(detail, ["sale_status"]).select(
        "sale_status", F.col("total_orders_all_statuses").alias("orders"), F.col("units_all").alias("units"),
        F.col("gross_order_value_all_statuses").alias("gross_order_value"), F.col("net_all").alias("sales_after_discount"),
        F.col("returned_units_all").alias("returned_units"), F.col("refund_all").alias("processed_refund_amount"),
        "net_sales_after_refunds",
    )


def sales_by(detail: DataFrame, by: list[str]) -> DataFrame:
    """Line totals per group and status (G7-G9); dimension columns come with the detail, no self-join."""
    eligible = F.col("sale_status").isin("COMPLETED", "RETURNED")
    net = F.col("net_amount") - F.col("processed_refund_amount")
    return detail.groupBy(*by, F.col("sale_status").alias("status")).agg(
        F.count(F.lit(1)).alias("order_lines"), F.sum("quantity").alias("quantity_sold"),
        F.sum("gross_amount").alias("gross_sales"), F.sum("net_amount").alias("sales_after_discount"),
        F.sum("returned_units").alias("returned_units"),
        F.sum("processed_refund_amount").alias("processed_refund_amount"),
        F.sum(F.when(eligible, net)).alias("net_sales_after_refunds"),
    )


def sales_by_month(detail: DataFrame) -> DataFrame:
    day = F.col("order_date")
    dated = detail.withColumns(
        {"year_number": F.year(day), "month_number": F.month(day), "month_name": F.date_format(day, "MMMM")}
    )
    return sales_by(dated, ["year_number", "month_number", "month_name"])


def sales_by_channel(detail: DataFrame) -> DataFrame:
    return sales_by(detail, ["channel_code", "channel_name", "channel_type"])


def sales_by_product(detail: DataFrame) -> DataFrame:
    return sales_by(detail, PRODUCT)


def return_refund_kpi(return_facts: DataFrame) -> DataFrame:
    """Return KPI per month and source (G10); distinct ids by a two-step count."""
    approved = F.col("return_status").isin("APPROVED", "PROCESSED")
    refunded = F.when(F.col("refund_status") == "PROCESSED", F.col("refund_amount"))
    by = ["return_month", "source_name"]
    per_id = (
        return_facts.withColumn("return_month", month_start(F.col("return_date")))
        .groupBy(*by, "return_id")
        .agg(
            F.count(F.lit(1)).alias("_lines"), F.count_if(approved).alias("_approved"),
            F.sum(F.when(approved, F.col("quantity_returned"))).alias("_units"), F.sum(refunded).alias("_refund"),
        )
    )
    return per_id.groupBy(*by).agg(
        F.count(F.lit(1)).alias("return_requests"), F.sum("_lines").alias("return_line_events"),
        F.sum("_approved").alias("approved_return_lines"),
        F.expr(f"{_sum('_units', False)} AS approved_return_units"), F.expr(f"{_sum('_refund')} AS processed_refund_amount"),
    )


# ------------------------------------------------- COMPLETED-only definitions


def _completed(detail: DataFrame, by: list[str]) -> DataFrame:
    m = measures(detail, by)
    return m.select(
        *by, F.col("gross_order_value_all_statuses").alias("gross_sales_all_statuses"), "net_sales_completed",
        "total_orders_all_statuses", "completed_orders", F.col("returned_status_orders").alias("returned_orders"),
        "completed_units", _rate("return_rate_pct", "returned_status_orders", "total_orders_all_statuses"),
        F.when(F.col("completed_orders") > 0, _aov("net_sales_completed", "completed_orders")).alias("average_order_value"),
    )


def completed_overall(detail: DataFrame) -> DataFrame:
    """The KPI family before returns were booked."""
    return _completed(detail, [])


def completed_monthly(detail: DataFrame) -> DataFrame:
    dated = detail.withColumn("month_start", month_start(F.col("order_date")))
    return _completed(dated, ["month_start"]).drop("completed_units")


def completed_channel(detail: DataFrame) -> DataFrame:
    return _completed(detail, ["channel_code", "channel_name", "channel_type"]).drop("completed_units")


def completed_product(detail: DataFrame) -> DataFrame:
    return _completed(detail, PRODUCT).select(
        *PRODUCT, "gross_sales_all_statuses", "net_sales_completed", "completed_units", "completed_orders"
    )


def completed_status(detail: DataFrame) -> DataFrame:
    return measures(detail, ["sale_status"]).select(
        "sale_status", F.col("total_orders_all_statuses").alias("orders"), F.col("units_all").alias("units"),
        F.col("gross_order_value_all_statuses").alias("gross_sales"), F.col("net_all").alias("net_sales"),
    )


def completed_lines(detail: DataFrame, by: list[str]) -> DataFrame:
    """Pre-return line totals per group and status (base views of G11)."""
    return detail.groupBy(*by, F.col("sale_status").alias("status")).agg(
        F.sum("quantity").alias("quantity_sold"), F.count(F.lit(1)).alias("order_lines"),
        F.sum("gross_amount").alias("gross_sales"), F.sum("net_amount").alias("net_sales"),
    )


def register_views(detail: DataFrame, return_facts: DataFrame) -> None:
    """Temporary views under the warehouse names, for SQL users."""
    detail.createOrReplaceTempView("v_sales_detail")
    for name, view in {
        "v_sales_kpi": overall_kpi(detail), "v_sales_monthly_kpi": monthly_kpi(detail),
        "v_sales_channel_kpi": channel_kpi(detail), "v_top_product_kpi": product_kpi(detail),
        "v_sales_status_kpi": status_kpi(detail), "v_sales_by_month": sales_by_month(detail),
        "v_sales_by_channel": sales_by_channel(detail), "v_sales_by_product": sales_by_product(detail),
        "v_return_refund_kpi": return_refund_kpi(return_facts),
    }.items():
        view.createOrReplaceTempView(name)
