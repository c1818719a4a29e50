"""Registered queries over the reporting view: KPIs, charts, rankings, filters, returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom.functions import dates, numbers, text
from salesloom.operators import constraints, dashboard as D, kpi, promotions, warehouse
from salesloom.plans import testdata as T
from salesloom.plans.testdata import FULL_SQL, RETURN_SQL, SALES_SQL, present

ORDER_ID = "order_identity"
OK = "FILTER (WHERE is_eligible_sale)"
RET = "FILTER (WHERE is_eligible_sale AND returned_units > 0)"


def dbl(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def _pct(part: str, whole: str) -> str:
    return f"CAST(round(100.0 * {part} / nullif({whole}, 0), 2) AS DOUBLE)"


_GROSS = dbl(f"coalesce(sum(gross_amount) {OK}, 0)", "gross_sales_eligible")
_AFTER = dbl(f"coalesce(sum(net_amount) {OK}, 0)", "sales_after_discount_eligible")
_NET = dbl(f"coalesce(sum(net_amount - processed_refund_amount) {OK}, 0)", "net_sales_after_refunds")
_ORDERS = f"count(DISTINCT {ORDER_ID}) {OK} AS eligible_orders"
_UNITS = big(f"coalesce(sum(quantity) {OK}, 0)", "eligible_units")
_RORDERS = f"count(DISTINCT {ORDER_ID}) {RET} AS returned_orders"
_RLINES = f"count(*) {RET} AS returned_order_lines"
_RUNITS = big(f"coalesce(sum(returned_units) {OK}, 0)", "returned_units")
_REFUND = dbl(f"coalesce(sum(processed_refund_amount) {OK}, 0)", "processed_refund_amount")
_URATE = _pct(f"sum(returned_units) {OK}", f"sum(quantity) {OK}")
_GROUPED = ", ".join([_GROSS, _AFTER, _NET, _ORDERS, _UNITS, _RORDERS, _RLINES, _RUNITS, _REFUND, _URATE + " AS unit_return_rate_pct"])
_MONTH = "strftime(date_trunc('month', order_date), '%Y-%m-01')"
_LINE_SUMS = ", ".join(
    [
        "count(*) AS order_lines", big("sum(quantity)", "quantity_sold"), dbl("sum(gross_amount)", "gross_sales"),
        dbl("sum(net_amount)", "sales_after_discount"), big("sum(returned_units)", "returned_units"),
        dbl("sum(processed_refund_amount)", "processed_refund_amount"),
        dbl(f"sum(net_amount - processed_refund_amount) {OK}", "net_sales_after_refunds"),
    ]
)
_OLD_SUMS = ", ".join(
    [big("sum(quantity)", "quantity_sold"), "count(*) AS order_lines", dbl("sum(gross_amount)", "gross_sales"), dbl("sum(net_amount)", "net_sales")]
)
DONE = "FILTER (WHERE sale_status = 'COMPLETED')"
BACK = "FILTER (WHERE sale_status = 'RETURNED')"
_OLD = ", ".join(
    [
        dbl("coalesce(sum(gross_amount), 0)", "gross_sales_all_statuses"), dbl(f"coalesce(sum(net_amount) {DONE}, 0)", "net_sales_completed"),
        f"count(DISTINCT {ORDER_ID}) AS total_orders_all_statuses", f"count(DISTINCT {ORDER_ID}) {DONE} AS completed_orders",
        f"count(DISTINCT {ORDER_ID}) {BACK} AS returned_orders",
        _pct(f"count(DISTINCT {ORDER_ID}) {BACK}", f"count(DISTINCT {ORDER_ID})") + " AS return_rate_pct",
        f"CAST(round(CAST(sum(net_amount) {DONE} AS DOUBLE) / nullif(count(DISTINCT {ORDER_ID}) {DONE}, 0), 2) AS DOUBLE) AS average_order_value",
    ]
)
PRODUCT = "product_id, product_name, brand, category"

CHOSEN = D.SalesFilter(
    "1996-01-01", "1998-12-31", channels=("Shopee", "Website"), statuses=("COMPLETED", "RETURNED"), brands=("Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5")
)
CHOSEN_SQL = (
    "order_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31' AND channel_name IN ('Shopee', 'Website') "
    "AND sale_status IN ('COMPLETED', 'RETURNED') AND brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5')"
)
YEARS = D.SalesFilter("1996-01-01", "1997-12-31")
YEARS_SQL = "order_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'"
NET = "sum(net_amount - processed_refund_amount)"
MARKERS = "('', 'nan', 'none', 'null', 'n/a', 'na')"
USABLE_CITY = f"lower(trim(coalesce(city, ''))) NOT IN {MARKERS}"

QUERIES: dict = {}


def add(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (lambda spark, sf: present(fn(spark, sf)), sql)
        return fn

    return register


def _on_detail(name: str, operator, select: str) -> None:
    add(name, f"{FULL_SQL} {select}")(lambda spark, sf: operator(T.detail(spark, sf)))


# --------------------------------------------------------------------- KPIs

add("g1_line_returns", f"{FULL_SQL} SELECT source_name, source_order_id, source_line_number, {big('returned_units', 'returned_units')}, "
    f"{dbl('processed_refund_amount', 'processed_refund_amount')} FROM line_returns")(
    lambda spark, sf: warehouse.line_returns(T.returns(spark, sf)))
_overall = ", ".join(
    [
        dbl("coalesce(sum(gross_amount), 0)", "gross_order_value_all_statuses"), _GROSS, _AFTER, _NET,
        dbl(f"coalesce(sum(discount_amount) {OK}, 0)", "discounts_eligible"),
        f"count(DISTINCT {ORDER_ID}) AS total_orders_all_statuses", _ORDERS, f"count(DISTINCT {ORDER_ID}) {DONE} AS completed_orders",
        f"count(DISTINCT {ORDER_ID}) {BACK} AS returned_status_orders", _UNITS, _RORDERS, _RLINES, _RUNITS, _REFUND,
        _pct(f"count(DISTINCT {ORDER_ID}) {RET}", f"count(DISTINCT {ORDER_ID}) {OK}") + " AS order_return_rate_pct",
        _pct(f"count(*) {RET}", f"count(*) {OK}") + " AS line_return_rate_pct", _URATE + " AS unit_return_rate_pct",
        f"CAST(round(CAST({NET} {OK} AS DOUBLE) / nullif(count(DISTINCT {ORDER_ID}) {OK}, 0), 2) AS DOUBLE) AS average_order_value_after_refunds",
    ]
)
_on_detail("g2_overall_kpi", kpi.overall_kpi, f"SELECT {_overall} FROM detail")
_on_detail("g3_monthly_kpi", kpi.monthly_kpi, f"SELECT {_MONTH} AS month_start, {_GROUPED} FROM detail GROUP BY 1")
_on_detail("g4_channel_kpi", kpi.channel_kpi, f"SELECT channel_code, channel_name, channel_type, {_GROUPED} FROM detail GROUP BY 1, 2, 3")
_on_detail("g5_product_kpi", kpi.product_kpi, f"SELECT {PRODUCT}, {_GROSS}, {_AFTER}, {_NET}, {_UNITS}, {_RUNITS}, {_REFUND}, {_ORDERS} FROM detail GROUP BY {PRODUCT}")
_on_detail("g6_status_kpi", kpi.status_kpi,
           f"SELECT sale_status, count(DISTINCT {ORDER_ID}) AS orders, {big('sum(quantity)', 'units')}, {dbl('sum(gross_amount)', 'gross_order_value')}, "
           f"{dbl('sum(net_amount)', 'sales_after_discount')}, {big('sum(returned_units)', 'returned_units')}, "
           f"{dbl('sum(processed_refund_amount)', 'processed_refund_amount')}, {_NET} FROM detail GROUP BY 1")
_on_detail("g7_sales_by_month", kpi.sales_by_month,
           "SELECT CAST(year(order_date) AS INTEGER) AS year_number, CAST(month(order_date) AS INTEGER) AS month_number, "
           f"strftime(order_date, '%B') AS month_name, sale_status AS status, {_LINE_SUMS} FROM detail GROUP BY 1, 2, 3, 4")
_on_detail("g8_sales_by_channel", kpi.sales_by_channel,
           f"SELECT channel_code, channel_name, channel_type, sale_status AS status, {_LINE_SUMS} FROM detail GROUP BY 1, 2, 3, 4")
_on_detail("g9_sales_by_product", kpi.sales_by_product, f"SELECT {PRODUCT}, sale_status AS status, {_LINE_SUMS} FROM detail GROUP BY {PRODUCT}, sale_status")
add("g10_return_refund_kpi", f"""{RETURN_SQL} SELECT strftime(date_trunc('month', return_date), '%Y-%m-01') AS return_month, source_name,
  count(DISTINCT return_id) AS return_requests, count(*) AS return_line_events,
  count(*) FILTER (WHERE return_status IN ('APPROVED', 'PROCESSED')) AS approved_return_lines,
  {big("coalesce(sum(quantity_returned) FILTER (WHERE return_status IN ('APPROVED', 'PROCESSED')), 0)", 'approved_return_units')},
  {dbl("coalesce(sum(refund_amount) FILTER (WHERE refund_status = 'PROCESSED'), 0)", 'processed_refund_amount')}
  FROM return_facts GROUP BY 1, 2""")(lambda spark, sf: kpi.return_refund_kpi(T.returns(spark, sf)))
_on_detail("g11_completed_overall", kpi.completed_overall, f"SELECT {_OLD}, {big(f'coalesce(sum(quantity) {DONE}, 0)', 'completed_units')} FROM detail")
_on_detail("g11_completed_monthly", kpi.completed_monthly, f"SELECT {_MONTH} AS month_start, {_OLD} FROM detail GROUP BY 1")
_on_detail("g11_completed_channel", kpi.completed_channel, f"SELECT channel_code, channel_name, channel_type, {_OLD} FROM detail GROUP BY 1, 2, 3")
_on_detail("g11_completed_product", kpi.completed_product,
           f"SELECT {PRODUCT}, {dbl('sum(gross_amount)', 'gross_sales_all_statuses')}, {dbl(f'coalesce(sum(net_amount) {DONE}, 0)', 'net_sales_completed')}, "
           f"{big(f'coalesce(sum(quantity) {DONE}, 0)', 'completed_units')}, count(DISTINCT {ORDER_ID}) {DONE} AS completed_orders FROM detail GROUP BY {PRODUCT}")
_on_detail("g11_completed_status", kpi.completed_status,
           f"SELECT sale_status, count(DISTINCT {ORDER_ID}) AS orders, {big('sum(quantity)', 'units')}, {dbl('sum(gross_amount)', 'gross_sales')}, {dbl('sum(net_amount)', 'net_sales')} FROM detail GROUP BY 1")
_on_detail("g11_base_by_channel", lambda d: kpi.completed_lines(d, ["channel_code", "channel_name", "channel_type"]),
           f"SELECT channel_code, channel_name, channel_type, sale_status AS status, {_OLD_SUMS} FROM detail GROUP BY 1, 2, 3, 4")
_dash = f"""SELECT {dbl("coalesce(sum(gross_amount), 0)", "gross_order_value_all_statuses")}, {dbl(f"coalesce(sum(gross_amount) {OK}, 0)", "gross_sales")},
  {dbl(f"coalesce(sum(net_amount) {OK}, 0)", "sales_after_discount")}, {dbl(f"coalesce({NET} {OK}, 0)", "net_sales")},
  {dbl(f"coalesce(sum(discount_amount) {OK}, 0)", "discount_total")}, {_ORDERS}, count(DISTINCT {ORDER_ID}) {DONE} AS completed_orders, {_UNITS},
  count(DISTINCT {ORDER_ID}) AS total_orders, {_RORDERS}, {_RLINES}, {_RUNITS}, {_REFUND},
  coalesce({_pct(f"count(DISTINCT {ORDER_ID}) {RET}", f"count(DISTINCT {ORDER_ID}) {OK}")}, 0) AS order_return_rate,
  coalesce({_pct(f"count(*) {RET}", f"count(*) {OK}")}, 0) AS line_return_rate, coalesce({_URATE}, 0) AS return_rate,
  count(*) FILTER (WHERE NOT ({USABLE_CITY})) AS unresolved_city_records, count(*) AS total_records FROM detail WHERE """
_on_detail("g12_dashboard_metrics", lambda d: D.dashboard_metrics(D.apply_filter(d, CHOSEN)), _dash + CHOSEN_SQL)

# ------------------------------------------------------------ charts, top-k

_on_detail("g13_chart_month", D.chart_month,
           f"SELECT strftime(order_date, '%Y-%m') AS label, {dbl(f'coalesce({NET} {OK}, 0)', 'net')}, {dbl(f'coalesce(sum(gross_amount) {OK}, 0)', 'gross')} FROM detail GROUP BY 1")
_on_detail("g14_chart_channel", D.chart_channel, f"SELECT channel_name AS label, {dbl(NET, 'value')} FROM detail WHERE is_eligible_sale GROUP BY 1")
_on_detail("g15_chart_status", D.chart_status, f"SELECT sale_status AS label, count(*) AS orders, {dbl(f'coalesce({NET} {OK}, 0)', 'net_sales')} FROM detail GROUP BY 1")
_on_detail("g16_chart_category", D.chart_category,
           f"SELECT coalesce(nullif(trim(category), ''), 'Uncategorized') AS label, {dbl(NET, 'value')} FROM detail WHERE is_eligible_sale GROUP BY 1")


def _top(label: str, where: str, limit: int) -> str:
    return f"SELECT label, CAST(v AS DOUBLE) AS value FROM (SELECT {label} AS label, {NET} AS v FROM detail WHERE is_eligible_sale{where} GROUP BY 1) ORDER BY v DESC, label LIMIT {limit}"


_on_detail("i1_top_products", D.top_products,
           f"SELECT label, {big('q', 'quantity')}, CAST(v AS DOUBLE) AS net_sales FROM (SELECT product_name AS label, sum(quantity) AS q, {NET} AS v FROM detail WHERE is_eligible_sale GROUP BY 1) ORDER BY q DESC, label LIMIT 10")
_on_detail("i2_top_cities", D.top_cities, _top("city", f" AND {USABLE_CITY}", 6))
_on_detail("i3_top_brands", D.top_brands, _top("coalesce(nullif(trim(brand), ''), 'Unknown brand')", "", 7))
_on_detail("i4_top_skus", D.top_skus, _top("coalesce(nullif(trim(product_id), ''), 'Unknown SKU')", "", 7))
_on_detail("i5_top_promotions", D.top_promotions,
           f"SELECT label, CAST(v AS DOUBLE) AS value, orders FROM (SELECT promo_code AS label, sum(discount_amount) AS v, count(DISTINCT {ORDER_ID}) AS orders FROM detail "
           f"WHERE is_eligible_sale AND promo_code IS NOT NULL AND lower(trim(promo_code)) NOT IN {MARKERS} GROUP BY 1) ORDER BY v DESC, label LIMIT 10")
_DETAIL_COLS = (
    "source_name, source_order_id, source_line_number, strftime(order_date, '%Y-%m-%d') AS order_date, product_id, product_name, category, brand, channel_name, "
    "sale_status, city, quantity, CAST(gross_amount AS DOUBLE) AS gross_amount, CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(net_amount AS DOUBLE) AS net_amount, "
    "CAST(returned_units AS BIGINT) AS returned_units, CAST(processed_refund_amount AS DOUBLE) AS processed_refund_amount, promo_code"
)
_on_detail("i7_detail_rows", lambda d: D.detail_rows(D.apply_filter(d, CHOSEN)), f"SELECT {_DETAIL_COLS} FROM detail WHERE {CHOSEN_SQL}")
_on_detail("i9_filter_options", D.filter_options,
           "SELECT DISTINCT * FROM (SELECT 'channels' AS option, channel_name AS value FROM detail UNION ALL SELECT 'categories', category FROM detail "
           "UNION ALL SELECT 'statuses', sale_status FROM detail UNION ALL SELECT 'brands', brand FROM detail UNION ALL SELECT 'products', product_id FROM detail)")
_on_detail("i12_page", lambda d: D.page(D.detail_rows(D.apply_filter(d, CHOSEN)), 3, 25),
           f"SELECT {_DETAIL_COLS} FROM detail WHERE {CHOSEN_SQL} ORDER BY detail.order_date DESC, source_name DESC, source_order_id DESC, source_line_number DESC LIMIT 25 OFFSET 50")
add("i13_top_price", "SELECT p_partkey, p_name, CAST(p_retailprice AS DOUBLE) AS price FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10")(
    lambda spark, sf: T.table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_retailprice").alias("price")).orderBy(F.desc("price"), "p_partkey").limit(10))
_on_detail("i18_top_product_net", lambda d: kpi.product_kpi(d).select("product_id", "net_sales_after_refunds").orderBy(F.desc("net_sales_after_refunds"), "product_id").limit(10),
           f"SELECT product_id, CAST(v AS DOUBLE) AS net_sales_after_refunds FROM (SELECT product_id, coalesce({NET} {OK}, 0) AS v FROM detail GROUP BY 1) ORDER BY v DESC, product_id LIMIT 10")

# ------------------------------------------------- filters and projections

add("a17_warehouse_scan", f"{SALES_SQL} SELECT source_name, source_order_id, source_line_number, strftime(order_date, '%Y-%m-%d') AS order_date, sale_status, quantity, {dbl('net_amount', 'net_amount')} FROM sales")(
    lambda spark, sf: T.sales(spark, sf).select("source_name", "source_order_id", "source_line_number", "order_date", "sale_status", "quantity", "net_amount"))
_on_detail("c6_amounts", lambda d: d.select("source_name", "source_order_id", "source_line_number", "gross_amount", "discount_amount", "net_amount"),
           f"SELECT source_name, source_order_id, source_line_number, {dbl('gross_amount', 'gross_amount')}, {dbl('discount_amount', 'discount_amount')}, {dbl('net_amount', 'net_amount')} FROM detail")
_on_detail("c7_filtered_sales", lambda d: D.apply_filter(d, CHOSEN).groupBy("channel_name", "brand").agg(F.count(F.lit(1)).alias("lines"), F.sum("net_amount").alias("net")),
           f"SELECT channel_name, brand, count(*) AS lines, {dbl('sum(net_amount)', 'net')} FROM detail WHERE {CHOSEN_SQL} GROUP BY 1, 2")
_on_detail("c9_default_range", lambda d: D.default_range(d, "2002-01-01"),
           "SELECT strftime(coalesce(min(order_date), DATE '2002-01-01'), '%Y-%m-%d') AS start_date, '2002-01-01' AS end_date FROM detail")
_on_detail("c10_eligible", lambda d: D.eligible(d).groupBy("sale_status").agg(F.count(F.lit(1)).alias("lines")),
           "SELECT sale_status, count(*) AS lines FROM detail WHERE is_eligible_sale GROUP BY 1")
_on_detail("c12_usable_city", lambda d: d.groupBy(text.usable_text("city").alias("usable")).agg(F.count(F.lit(1)).alias("lines")),
           f"SELECT {USABLE_CITY} AS usable, count(*) AS lines FROM detail GROUP BY 1")
_on_detail("c13_usable_promo", lambda d: d.where(text.usable_text("promo_code")).groupBy("promo_code").agg(F.count(F.lit(1)).alias("lines")),
           f"SELECT promo_code, count(*) AS lines FROM detail WHERE lower(trim(coalesce(promo_code, ''))) NOT IN {MARKERS} GROUP BY 1")
_on_detail("c14_labels", lambda d: d.groupBy(text.blank_default("category", "Uncategorized").alias("label")).agg(F.count(F.lit(1)).alias("lines")),
           "SELECT coalesce(nullif(trim(category), ''), 'Uncategorized') AS label, count(*) AS lines FROM detail GROUP BY 1")
_on_detail("c15_search", lambda d: D.search_lines(d, " Blue "). select("source_name", "source_order_id", "source_line_number", "product_name"),
           "SELECT source_name, source_order_id, source_line_number, product_name FROM detail WHERE "
           + " OR ".join(f"lower(coalesce({c}, '')) LIKE '%blue%'" for c in D.SEARCH_COLUMNS))
_on_detail("c22_display_rows", lambda d: D.display_types(d.select("source_order_id", "source_line_number", "order_date", "net_amount")),
           f"SELECT source_order_id, source_line_number, strftime(order_date, '%Y-%m-%d') AS order_date, {dbl('net_amount', 'net_amount')} FROM detail")
_on_detail("b21_export_rows", lambda d: D.export_rows(D.apply_filter(d, CHOSEN)).select("source_order_id", "order_date", "quantity", "net_amount", "promo_code"),
           f"SELECT source_order_id, strftime(order_date, '%Y-%m-%d') AS order_date, CAST(quantity AS VARCHAR) AS quantity, CAST(net_amount AS VARCHAR) AS net_amount, coalesce(promo_code, 'None') AS promo_code FROM detail WHERE {CHOSEN_SQL}")
_on_detail("f5_sales_detail", lambda d: d.select("source_name", "source_order_id", "source_line_number", "channel_name", "is_eligible_sale", "returned_units", "processed_refund_amount"),
           f"SELECT source_name, source_order_id, source_line_number, channel_name, is_eligible_sale, {big('returned_units', 'returned_units')}, {dbl('processed_refund_amount', 'processed_refund_amount')} FROM detail")
_on_detail("j5_distinct_choices", D.distinct_choices, "SELECT DISTINCT channel_name, category, sale_status, brand, product_id FROM detail")
_on_detail("d17_months", lambda d: d.groupBy(dates.month_start(F.col("order_date")).alias("month_start"), dates.month_label(F.col("order_date")).alias("label")).agg(F.count(F.lit(1)).alias("lines")),
           f"SELECT {_MONTH} AS month_start, strftime(order_date, '%Y-%m') AS label, count(*) AS lines FROM detail GROUP BY 1, 2")
_on_detail("d18_order_identity", lambda d: d.groupBy("source_name").agg(F.countDistinct("source_order_id").alias("orders")),
           f"SELECT source_name, count(DISTINCT {ORDER_ID}) AS orders FROM detail GROUP BY 1")
_on_detail("d23_rates", lambda d: d.groupBy("brand").agg(numbers.ratio_pct(F.sum("returned_units"), F.sum("quantity")).alias("unit_rate"), numbers.ratio_pct(F.sum("discount_amount"), F.sum("gross_amount")).alias("discount_rate")),
           f"SELECT brand, {_pct('sum(returned_units)', 'sum(quantity)')} AS unit_rate, CAST(round(100.0 * CAST(sum(discount_amount) AS DOUBLE) / nullif(CAST(sum(gross_amount) AS DOUBLE), 0), 2) AS DOUBLE) AS discount_rate FROM detail GROUP BY 1")


def _previous(spark, sf):
    return D.previous_period(T.detail(spark, sf), YEARS)


_PREV = "order_date BETWEEN DATE '1994-01-01' AND DATE '1995-12-31'"
add("g21_previous_period", f"{FULL_SQL} SELECT {dbl(f'coalesce({NET}, 0)', 'net_sales')}, {dbl('coalesce(sum(gross_amount), 0)', 'gross_sales')}, count(DISTINCT {ORDER_ID}) AS orders FROM detail WHERE is_eligible_sale AND {_PREV}")(_previous)


def _derived(spark, sf):
    d = T.detail(spark, sf)
    return D.derived_metrics(D.dashboard_metrics(D.apply_filter(d, YEARS)), D.previous_period(d, YEARS))


_derived_sql = f"""{FULL_SQL}, cur AS (SELECT CAST(coalesce({NET} {OK}, 0) AS DOUBLE) AS net, count(DISTINCT {ORDER_ID}) {OK} AS orders, count(*) AS total,
  count(*) FILTER (WHERE NOT ({USABLE_CITY})) AS unresolved FROM detail WHERE {YEARS_SQL}),
prev AS (SELECT CAST(coalesce({NET}, 0) AS DOUBLE) AS net FROM detail WHERE is_eligible_sale AND {_PREV})
SELECT coalesce(cur.net / nullif(orders, 0), 0) AS average_order_value,
  CASE WHEN prev.net <> 0 THEN (cur.net - prev.net) / prev.net * 100 END AS net_change_percent,
  coalesce(CAST(total - unresolved AS DOUBLE) / nullif(total, 0) * 100, 0) AS known_city_coverage_rate FROM cur, prev"""
add("g22_derived_metrics", _derived_sql)(lambda spark, sf: _derived(spark, sf).select(*[F.round(c, 6).alias(c) for c in ("average_order_value", "net_change_percent", "known_city_coverage_rate")]))
QUERIES["g22_derived_metrics"] = (QUERIES["g22_derived_metrics"][0], f"SELECT round(average_order_value, 6) AS average_order_value, round(net_change_percent, 6) AS net_change_percent, round(known_city_coverage_rate, 6) AS known_city_coverage_rate FROM ({_derived_sql})")

# ------------------------------------------------------------------ returns

R_FILTER = D.SalesFilter("1996-01-01", "1998-12-31", channels=("Shopee", "Offline Store"))
R_SQL = f"""{FULL_SQL}, rows AS (SELECT r.*, d.channel_name, d.sale_status, d.product_id, d.product_name FROM return_facts r
  JOIN detail d USING (source_name, source_order_id, source_line_number) WHERE r.return_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
  AND d.channel_name IN ('Shopee', 'Offline Store'))"""
_PAID = dbl("coalesce(sum(refund_amount) FILTER (WHERE refund_status = 'PROCESSED'), 0)", "processed_refund_amount")
_RU = big("sum(quantity_returned)", "units")


def _return_rows(spark, sf):
    return D.return_rows(T.returns(spark, sf), T.with_channel(T.sales(spark, sf)), R_FILTER)


def _on_returns(name: str, operator, select: str) -> None:
    add(name, f"{R_SQL} {select}")(lambda spark, sf: operator(_return_rows(spark, sf)))


_LIST = ("strftime(return_date, '%Y-%m-%d') AS return_date, return_id, return_line_number, channel_name, source_order_id, source_line_number, product_id, product_name, "
         "return_status, return_reason, quantity_returned, refund_status, CAST(refund_amount AS DOUBLE) AS refund_amount")
_on_returns("f6_return_rows", lambda r: r.select(*D.RETURN_ROW_COLUMNS), f"SELECT {_LIST} FROM rows")
_on_returns("c8_return_filter", lambda r: r.groupBy("channel_name", "sale_status").agg(F.count(F.lit(1)).alias("events")),
            "SELECT channel_name, sale_status, count(*) AS events FROM rows GROUP BY 1, 2")
_on_returns("g17_returns_by_status", D.returns_by_status,
            f"SELECT return_status AS label, count(*) AS events, {_RU}, count(*) FILTER (WHERE refund_status = 'PROCESSED') AS refunded_events, {_PAID} FROM rows GROUP BY 1")
_on_returns("g18_returns_by_refund", D.returns_by_refund_status, f"SELECT refund_status AS label, count(*) AS events, {_PAID} FROM rows GROUP BY 1")
_on_returns("g19_returns_by_channel", D.returns_by_channel,
            f"SELECT channel_name AS label, count(*) AS events, {_RU}, count(*) FILTER (WHERE return_status = 'PENDING') AS pending_events, count(*) FILTER (WHERE return_status = 'REJECTED') AS rejected_events, {_PAID} FROM rows GROUP BY 1")
_on_returns("i6_top_return_reasons", D.top_return_reasons,
            f"SELECT return_reason AS label, count(*) AS events, {_RU}, {_PAID} FROM rows GROUP BY 1 ORDER BY events DESC, label LIMIT 10")
_on_returns("g20_returns_monthly", D.returns_monthly, f"SELECT strftime(return_date, '%Y-%m') AS label, count(*) AS events, {_RU}, {_PAID} FROM rows GROUP BY 1")
_on_returns("i8_return_listing", D.return_listing, f"SELECT {_LIST} FROM rows")
_on_returns("g42_return_cards", D.return_cards,
            "SELECT count(*) AS total_events, " + ", ".join(f"count(*) FILTER (WHERE return_status = '{s}') AS {s.lower()}_events" for s in ("PENDING", "APPROVED", "REJECTED", "PROCESSED")) + f", {_PAID} FROM rows")
_on_returns("d24_status_order", lambda r: D.returns_by_status(r).select("label", D._position("label", ("PENDING", "APPROVED", "REJECTED", "PROCESSED")).alias("position")),
            "SELECT return_status AS label, CASE return_status WHEN 'PENDING' THEN 1 WHEN 'APPROVED' THEN 2 WHEN 'REJECTED' THEN 3 WHEN 'PROCESSED' THEN 4 ELSE 5 END AS position FROM rows GROUP BY 1")

# --------------------------------------------------- promotions, allocation

PROMO_SALES_SQL = f"{SALES_SQL},{T.PROMOTIONS_SQL}"
add("f4_active_promotions", f"{PROMO_SALES_SQL} SELECT promo_code, count(*) AS days FROM (SELECT DISTINCT order_date FROM sales) JOIN promotions ON status = 'active' AND order_date BETWEEN start_date AND end_date GROUP BY 1")(
    lambda spark, sf: promotions.active_promotions(T.sales(spark, sf).select("order_date").distinct(), T.promotions(spark, sf)).groupBy("promo_code").agg(F.count(F.lit(1)).alias("days")))


def open_promotions(spark, sf):
    """The catalogue with open starts and ends, intervals of a hundred years and more, and one that is empty."""
    i = F.substring("promo_code", 6, 9).cast("int")
    wide = F.when(i % 5 == 2, 18_262).otherwise(0)
    start, end = F.date_sub("start_date", wide), F.date_add("end_date", wide)
    return T.promotions(spark, sf).withColumns({"start_date": F.when(i % 3 != 0, start), "end_date": F.when(i == 11, F.date_sub("start_date", 1)).when(i % 4 != 1, end)})


_OPEN_SQL = """, open_promotions AS (SELECT promo_code, status, CASE WHEN i % 3 <> 0 THEN start_date - CASE WHEN i % 5 = 2 THEN 18262 ELSE 0 END END AS start_date,
  CASE WHEN i = 11 THEN start_date - 1 WHEN i % 4 <> 1 THEN end_date + CASE WHEN i % 5 = 2 THEN 18262 ELSE 0 END END AS end_date FROM (SELECT *, CAST(substr(promo_code, 6) AS INTEGER) AS i FROM promotions))"""
add("f4_open_promotions", f"""{PROMO_SALES_SQL}{_OPEN_SQL} SELECT promo_code, count(*) AS orders, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders
  JOIN open_promotions ON status = 'active' AND CAST(o_orderdate AS DATE) BETWEEN coalesce(start_date, DATE '0001-01-01') AND coalesce(end_date, DATE '9999-12-31') GROUP BY 1""")(
    lambda spark, sf: promotions.active_promotions(T.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("order_date")), open_promotions(spark, sf).withColumns({"discount_type": F.lit(""), "discount_value": F.lit(0)}))
    .groupBy("promo_code").agg(F.count(F.lit(1)).alias("orders"), F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")))


def promotion_versions(spark, sf):
    """Three versions of every code, one after the other; the last has no end."""
    v = F.col("version")
    start = F.date_add("start_date", 300 * v)
    dated = T.promotions(spark, sf).withColumn("version", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return dated.select("promo_code", "version", start.alias("start_date"), F.when(v < 2, F.date_add(start, 299)).alias("end_date"))


add("f3_dated_versions", f"""{PROMO_SALES_SQL} SELECT source_name, source_order_id, source_line_number, coalesce(version, -1) AS version FROM sales s
  LEFT JOIN (SELECT promo_code, v AS version, start_date + 300 * v AS start_date, CASE WHEN v < 2 THEN start_date + 300 * v + 299 ELSE DATE '9999-12-31' END AS end_date FROM promotions, (VALUES (0), (1), (2)) AS t(v)) p
  ON p.promo_code = s.promo_code AND order_date BETWEEN p.start_date AND p.end_date""")(
    lambda spark, sf: promotions.promotion_versions(T.sales(spark, sf).select("source_name", "source_order_id", "source_line_number", "promo_code", "order_date"), promotion_versions(spark, sf))
    .select("source_name", "source_order_id", "source_line_number", F.coalesce("version", F.lit(-1)).alias("version")))


def _promo_lines(spark, sf):
    return T.sales(spark, sf).withColumns({"source": F.col("source_name"), "source_row_number": F.xxhash64("source_order_id", "source_line_number")})


def _line_promos(spark, sf):
    checked = promotions.check_line_promotions(_promo_lines(spark, sf), T.promotions(spark, sf))
    return checked.select("source_name", "source_order_id", "source_line_number", F.coalesce("promo_reason", F.lit("")).alias("promo_reason"))


LINE_PROMO_SQL = """CASE WHEN s.promo_code IS NULL AND discount_amount > 0 THEN 'discount_without_code'
  WHEN s.promo_code IS NOT NULL AND p.promo_code IS NULL THEN 'unknown_code'
  WHEN s.promo_code IS NOT NULL AND NOT order_date BETWEEN start_date AND end_date THEN 'outside_dates'
  WHEN s.promo_code IS NOT NULL AND status <> 'active' THEN 'not_active'
  WHEN s.promo_code IS NOT NULL AND discount_amount > quantity * unit_price THEN 'discount_exceeds_gross' ELSE '' END"""
_LP_SQL = f"{PROMO_SALES_SQL} SELECT source_name, source_order_id, source_line_number, {LINE_PROMO_SQL} AS promo_reason FROM sales s LEFT JOIN promotions p ON p.promo_code = s.promo_code"
add("f3_promo_lookup", _LP_SQL)(_line_promos)
for _id, _reason in (("e31_unknown_code", "unknown_code"), ("e32_outside_dates", "outside_dates"), ("e33_not_active", "not_active")):
    add(_id, f"SELECT * FROM ({_LP_SQL}) WHERE promo_reason = '{_reason}'")(
        lambda spark, sf, _reason=_reason: _line_promos(spark, sf).where(F.col("promo_reason") == _reason))


def _blanked(spark, sf):
    """Lines whose code is blanked and whose discount is raised on fixed residues."""
    lines = _promo_lines(spark, sf)
    return lines.withColumns(
        {
            "promo_code": F.when(F.col("l_orderkey") % 4 != 0, F.col("promo_code")),
            "discount_amount": F.when(F.col("l_orderkey") % 6 == 1, F.col("gross_amount") + 1).otherwise(F.col("discount_amount")).cast("decimal(16,2)"),
        }
    )


_BLANK_SQL = f"""{PROMO_SALES_SQL}, b AS (SELECT source_name, source_order_id, source_line_number, order_date, quantity, unit_price,
  CASE WHEN l_orderkey % 4 <> 0 THEN promo_code END AS promo_code,
  CASE WHEN l_orderkey % 6 = 1 THEN gross_amount + 1 ELSE discount_amount END AS discount_amount FROM sales)
SELECT source_name, source_order_id, source_line_number, {LINE_PROMO_SQL} AS promo_reason FROM b s LEFT JOIN promotions p ON p.promo_code = s.promo_code"""
for _id, _reason in (("e30_discount_without_code", "discount_without_code"), ("e34_discount_exceeds_gross", "discount_exceeds_gross")):
    add(_id, f"SELECT * FROM ({_BLANK_SQL}) WHERE promo_reason = '{_reason}'")(
        lambda spark, sf, _reason=_reason: promotions.check_line_promotions(_blanked(spark, sf), T.promotions(spark, sf))
        .select("source_name", "source_order_id", "source_line_number", "promo_reason").where(F.col("promo_reason") == _reason))
add("d28_promo_discount", f"""{PROMO_SALES_SQL} SELECT source_name, source_order_id, source_line_number,
  CAST(least(CASE WHEN discount_type = 'percentage' THEN CAST(round(CAST(gross_amount * discount_value AS DECIMAL(34,4)) / 100, 2) AS DECIMAL(16,2)) ELSE discount_value END, gross_amount) AS DOUBLE) AS rule_discount
  FROM sales s JOIN promotions p ON p.promo_code = s.promo_code""")(
    lambda spark, sf: promotions.line_discount(_promo_lines(spark, sf), T.promotions(spark, sf)).where("rule_discount IS NOT NULL")
    .select("source_name", "source_order_id", "source_line_number", "rule_discount"))
ALLOC_SQL = f"""{SALES_SQL}, o AS (SELECT source_name, source_order_id, source_line_number, gross_amount,
   CAST(100.01 + l_orderkey % 977 AS DECIMAL(16,2)) AS order_discount,
   sum(gross_amount) OVER (PARTITION BY source_name, source_order_id) AS total,
   max(source_line_number) OVER (PARTITION BY source_name, source_order_id) AS last_line FROM sales),
 a AS (SELECT *, CASE WHEN source_line_number = last_line THEN 0 ELSE least(CAST(round(CAST(order_discount * gross_amount AS DOUBLE) / CAST(total AS DOUBLE), 2) AS DECIMAL(16,2)), gross_amount) END AS share FROM o),
 c AS (SELECT *, sum(share) OVER (PARTITION BY source_name, source_order_id ORDER BY source_line_number) AS through FROM a)
 SELECT source_name, source_order_id, source_line_number, CAST(CASE WHEN source_line_number = last_line THEN order_discount - least(through, order_discount)
   ELSE least(through, order_discount) - least(through - share, order_discount) END AS DOUBLE) AS allocated_discount FROM c"""


def _allocation(spark, sf):
    lines = T.sales(spark, sf).withColumn("order_discount", (F.lit("100.01").cast("decimal(16,2)") + F.col("l_orderkey") % 977).cast("decimal(16,2)"))
    split = promotions.allocate_discount(lines, ["source_name", "source_order_id"], "source_line_number", "gross_amount", "order_discount")
    return split.select("source_name", "source_order_id", "source_line_number", "allocated_discount")


add("h4_discount_allocation", ALLOC_SQL)(_allocation)

# -------------------------------------------------------------- constraints


def _violations(name, df_of, rules, sql_tests, cte):
    union = " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) FILTER (WHERE NOT ({t})) AS violations FROM {cte[1]}" for r, t in sql_tests.items())
    add(name, f"{cte[0]} {union}")(lambda spark, sf: constraints.violations(df_of(spark, sf), rules))


def _bent(spark, sf):
    """Sale lines with amounts bent on fixed residues, so that every rule is broken somewhere."""
    d = T.sales(spark, sf)
    k = F.col("l_orderkey") % 10
    return d.withColumns(
        {
            "net_amount": F.when(k == 1, F.col("net_amount") + 1).otherwise(F.col("net_amount")),
            "discount_amount": F.when(k == 2, F.col("gross_amount") + 5).otherwise(F.col("discount_amount")),
            "quantity": F.when(k == 3, -F.col("quantity")).otherwise(F.col("quantity")),
            "sale_status": F.when(k == 4, "SHIPPED").otherwise(F.col("sale_status")),
        }
    )


_BENT_SQL = f"""{SALES_SQL}, bent AS (SELECT source_name, source_line_number, unit_price, gross_amount,
  CASE WHEN l_orderkey % 10 = 1 THEN net_amount + 1 ELSE net_amount END AS net_amount,
  CASE WHEN l_orderkey % 10 = 2 THEN gross_amount + 5 ELSE discount_amount END AS discount_amount,
  CASE WHEN l_orderkey % 10 = 3 THEN -quantity ELSE quantity END AS quantity,
  CASE WHEN l_orderkey % 10 = 4 THEN 'SHIPPED' ELSE sale_status END AS sale_status FROM sales)"""
_violations("l3_amount_identity", _bent, constraints.AMOUNT_RULES, constraints.AMOUNT_RULES, (_BENT_SQL, "bent"))
_violations("l4_domains", _bent, constraints.SALE_DOMAINS, constraints.SALE_DOMAINS, (_BENT_SQL, "bent"))


def _bent_returns(spark, sf):
    r = T.returns(spark, sf)
    k = F.col("source_order_id").cast("bigint") % 5
    return r.withColumns(
        {
            "refund_amount": F.when(k == 1, F.lit(None)).when(k == 2, F.lit(1)).otherwise(F.col("refund_amount")).cast("decimal(16,2)"),
            "return_status": F.when(k == 3, "PENDING").otherwise(F.col("return_status")),
        }
    )


_violations("l5_refund_coherence", _bent_returns, constraints.RETURN_RULES, constraints.RETURN_RULES,
            (f"""{RETURN_SQL}, bent AS (SELECT quantity_returned, refund_status,
  CASE CAST(source_order_id AS BIGINT) % 5 WHEN 1 THEN NULL WHEN 2 THEN 1 ELSE refund_amount END AS refund_amount,
  CASE WHEN CAST(source_order_id AS BIGINT) % 5 = 3 THEN 'PENDING' ELSE return_status END AS return_status FROM return_facts)""", "bent"))
add("l1_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")(
    lambda spark, sf: constraints.duplicate_keys(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]))
add("l2_orphans", "SELECT l_orderkey, count(*) AS child_rows FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'O') GROUP BY 1")(
    lambda spark, sf: constraints.orphans(T.table(spark, sf, "lineitem"), T.table(spark, sf, "orders").where("o_orderstatus <> 'O'"), {"l_orderkey": "o_orderkey"}))
add("l6_dimension_domains", f"""{SALES_SQL}, d AS (SELECT DISTINCT order_date AS f FROM sales) SELECT 'date_key_range' AS rule, count(*) FILTER (WHERE NOT (CAST(strftime(f, '%Y%m%d') AS INTEGER) BETWEEN 20000101 AND 21001231)) AS violations FROM d
  UNION ALL SELECT 'day_range', 0 UNION ALL SELECT 'month_range', 0 UNION ALL SELECT 'quarter_range', 0
  UNION ALL SELECT 'year_range', count(*) FILTER (WHERE year(f) < 2000) FROM d""")(
    lambda spark, sf: constraints.violations(warehouse.calendar(T.sales(spark, sf)), constraints.DIMENSION_RULES["dim_date"]))
add("e42_warehouse_check", f"{FULL_SQL} SELECT count(*) AS active_facts, count(*) AS all_facts, (SELECT count(*) FROM detail) AS view_rows, CAST(0 AS BIGINT) AS duplicate_keys, true AS passes FROM sales")(
    lambda spark, sf: constraints.warehouse_check(T.sales(spark, sf).withColumn("is_source_active", F.lit(True)), T.detail(spark, sf)))
add("j4_multi_line_orders", f"{SALES_SQL} SELECT source_name, source_order_id, count(*) AS n FROM sales GROUP BY 1, 2 HAVING min(source_line_number) < max(source_line_number)")(
    lambda spark, sf: T.sales(spark, sf).groupBy("source_name", "source_order_id").agg(F.count(F.lit(1)).alias("n"), F.min("source_line_number").alias("lo"), F.max("source_line_number").alias("hi")).where("lo < hi").drop("lo", "hi"))

# the detail carries the dimension columns, so these joins need no plan of their own
QUERIES["f7_detail_without_self_join"] = QUERIES["g8_sales_by_channel"]
QUERIES["f8_channel_join"] = QUERIES["g4_channel_kpi"]
