"""The retail contract derived from the given TPC-H style tables.

Each table is stated twice, as DataFrame code and as a SQL CTE, so registered
queries and their SQL work on identical input. Every row of the tables takes
part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom import contracts as C
from salesloom.operators import warehouse
from salesloom.session import spread_small


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table; its footer is read for the schema once."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def lines(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Columns of lineitem, spread when the file has fewer splits than there are cores."""
    return spread_small(table(spark, sf, "lineitem").select(*columns), *columns)


def _by_remainder(column: str, divisor: int, values) -> Column:
    result = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        result = F.when(F.col(column) % divisor == i, value).otherwise(result)
    return result


SOURCE_SQL = (
    "CASE o_custkey % 4 WHEN 0 THEN 'SHOPEE' WHEN 1 THEN 'TOKOPEDIA' WHEN 2 THEN 'WEBSITE' ELSE 'OFFLINE_STORE' END"
)


# ------------------------------------------------------------ sales and returns


def line_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Every order line, numbered within its order; rows that share a line number stay apart.

    Null order keys or line numbers name no line. The number follows from all columns used, and the order key deals
    the rows as the join with the orders needs them.
    """
    keyed = table(spark, sf, "lineitem").where("l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL")
    return keyed.selectExpr(
        "l_orderkey", "CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_discount, l_returnflag) AS INT) AS l_linenumber",
        "l_partkey", "CAST(l_quantity AS INT) AS quantity", "CAST(l_discount AS DECIMAL(4,2)) AS rate",
        "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 0 END AS flag",
    )


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


def _order_lines(spark: SparkSession, sf: str, orders: DataFrame) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    joined = line_facts(spark, sf).join(orders, F.expr("l_orderkey = o_orderkey")).join(part, F.expr("l_partkey = p_partkey"))
    priced = joined.selectExpr("*", "CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price")
    gross = priced.selectExpr("*", "CAST(quantity * unit_price AS DECIMAL(16,2)) AS gross_amount")
    return gross.selectExpr("*", "CAST(gross_amount * rate AS DECIMAL(16,2)) AS discount_amount")


_LINE_COLUMNS = (
    f"{SOURCE_SQL} AS source_name", "CAST(l_orderkey AS STRING) AS source_order_id", "l_linenumber AS source_line_number",
    "CAST(o_orderdate AS DATE) AS order_date", "CAST(p_partkey AS STRING) AS product_id", "p_name AS product_name", "p_brand AS brand",
    "CASE WHEN p_partkey % 20 = 3 THEN '  ' ELSE p_type END AS category",
    "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'RETURNED' ELSE 'CANCELLED' END AS sale_status",
    "o_orderpriority AS payment_method", "quantity", "unit_price", "gross_amount", "discount_amount",
    "CAST(gross_amount - discount_amount AS DECIMAL(16,2)) AS net_amount",
    "CASE WHEN l_orderkey % 25 = 0 THEN 'n/a' WHEN rate > 0 THEN 'PROMO' || (l_partkey % 12) END AS promo_code",
    "l_orderkey", "l_partkey", "flag", "o_custkey",
)


LINES_SQL = """
line_facts AS (
  SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_discount, l_returnflag) AS INTEGER) AS l_linenumber,
         l_partkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_discount AS DECIMAL(4,2)) AS rate, l_returnflag AS flag
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
),
order_lines AS (
  SELECT *, CAST(p_retailprice AS DECIMAL(14,2)) AS unit_price,
         CAST(quantity * CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(16,2)) AS gross_amount,
         CAST(CAST(quantity * CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(16,2)) * rate AS DECIMAL(16,2)) AS discount_amount
  FROM line_facts JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
sales AS (
  SELECT """ + SOURCE_SQL + """ AS source_name,
         CAST(l_orderkey AS VARCHAR) AS source_order_id, l_linenumber AS source_line_number,
         CAST(o_orderdate AS DATE) AS order_date, CAST(p_partkey AS VARCHAR) AS product_id,
         p_name AS product_name, p_brand AS brand, CASE WHEN p_partkey % 20 = 3 THEN '  ' ELSE p_type END AS category,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'RETURNED' ELSE 'CANCELLED' END AS sale_status,
         o_orderpriority AS payment_method, quantity, unit_price, gross_amount, discount_amount,
         CAST(gross_amount - discount_amount AS DECIMAL(16,2)) AS net_amount,
         CASE WHEN l_orderkey % 25 = 0 THEN 'n/a' WHEN rate > 0 THEN 'PROMO' || (l_partkey % 12) END AS promo_code,
         c_name AS customer_name,
         CASE o_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'N/A' ELSE n_name END AS city,
         l_orderkey, l_partkey, flag, o_custkey
  FROM order_lines JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

RETURNS_SQL = """
return_facts AS (
  SELECT source_name, 'R' || source_order_id AS return_id, source_line_number AS return_line_number,
         source_order_id, source_line_number, order_date + 3 * source_line_number AS return_date,
         'reason ' || (l_partkey % 13) AS return_reason,
         CASE WHEN l_orderkey % 11 = 0 THEN 'REJECTED' WHEN flag = 'R' THEN 'PROCESSED'
              WHEN l_orderkey % 2 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS return_status,
         (quantity + 1) // 2 AS quantity_returned,
         CASE WHEN l_orderkey % 11 <> 0 AND flag = 'R'
              THEN least(CAST(((quantity + 1) // 2) * unit_price AS DECIMAL(16,2)), net_amount) END AS refund_amount,
         CASE WHEN l_orderkey % 11 = 0 THEN 'NOT_APPLICABLE' WHEN flag = 'R' THEN 'PROCESSED'
              WHEN l_orderkey % 3 = 0 THEN 'FAILED' ELSE 'PENDING' END AS refund_status
  FROM sales WHERE flag IN ('A', 'R') AND sale_status <> 'CANCELLED'
)"""

DETAIL_SQL = """
line_returns AS (
  SELECT source_name, source_order_id, source_line_number,
         sum(quantity_returned) FILTER (WHERE return_status IN ('APPROVED', 'PROCESSED')) AS returned_units,
         sum(refund_amount) FILTER (WHERE refund_status = 'PROCESSED') AS processed_refund_amount
  FROM return_facts GROUP BY source_name, source_order_id, source_line_number
),
detail AS (
  SELECT s.*, coalesce(r.returned_units, 0) AS returned_units,
         coalesce(r.processed_refund_amount, 0) AS processed_refund_amount,
         s.sale_status IN ('COMPLETED', 'RETURNED') AS is_eligible_sale,
         s.source_name AS channel_code,
         CASE s.source_name WHEN 'SHOPEE' THEN 'Shopee' WHEN 'TOKOPEDIA' THEN 'Tokopedia' WHEN 'WEBSITE' THEN 'Website'
              ELSE 'Offline Store' END AS channel_name,
         CASE s.source_name WHEN 'WEBSITE' THEN 'DIRECT' WHEN 'OFFLINE_STORE' THEN 'OFFLINE' ELSE 'MARKETPLACE' END AS channel_type,
         s.source_name || '|' || s.source_order_id AS order_identity
  FROM sales s LEFT JOIN line_returns r USING (source_name, source_order_id, source_line_number)
)"""

SALES_SQL = f"WITH {LINES_SQL}"
RETURN_SQL = f"WITH {LINES_SQL},{RETURNS_SQL}"
FULL_SQL = f"WITH {LINES_SQL},{RETURNS_SQL},{DETAIL_SQL}"


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sale lines with customer and city; customers meet the orders, which are fewer than the lines."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    orders = _orders(spark, sf).join(customer.join(nation, F.expr("c_nationkey = n_nationkey")), F.expr("o_custkey = c_custkey"))
    joined = _order_lines(spark, sf, orders)
    city = "CASE o_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'N/A' ELSE n_name END AS city"
    return joined.selectExpr(*_LINE_COLUMNS, "c_name AS customer_name", city).drop("flag")


def returns(spark: SparkSession, sf: str) -> DataFrame:
    """Return events of completed and returned sales."""
    base = _order_lines(spark, sf, _orders(spark, sf)).where("flag > 0 AND o_orderstatus IN ('F', 'P')").selectExpr(*_LINE_COLUMNS)
    counted = base.selectExpr("*", "CAST((quantity + 1) DIV 2 AS INT) AS quantity_returned")
    return counted.selectExpr(
        "source_name", "'R' || source_order_id AS return_id", "source_line_number AS return_line_number", "source_order_id", "source_line_number",
        "date_add(order_date, 3 * source_line_number) AS return_date", "'reason ' || (l_partkey % 13) AS return_reason",
        "CASE WHEN l_orderkey % 11 = 0 THEN 'REJECTED' WHEN flag = 2 THEN 'PROCESSED' WHEN l_orderkey % 2 = 0 THEN 'APPROVED' ELSE 'PENDING' END AS return_status",
        "quantity_returned",
        "CASE WHEN l_orderkey % 11 <> 0 AND flag = 2 THEN least(CAST(quantity_returned * unit_price AS DECIMAL(16,2)), net_amount) END AS refund_amount",
        "CASE WHEN l_orderkey % 11 = 0 THEN 'NOT_APPLICABLE' WHEN flag = 2 THEN 'PROCESSED' WHEN l_orderkey % 3 = 0 THEN 'FAILED' ELSE 'PENDING' END AS refund_status",
    )


def with_channel(lines: DataFrame) -> DataFrame:
    members = warehouse.channel_members(lines.sparkSession)
    return lines.join(F.broadcast(members.withColumn("source_name", F.col("channel_code"))), "source_name")


def detail(spark: SparkSession, sf: str) -> DataFrame:
    """The reporting view over the test tables."""
    return warehouse.with_returns(with_channel(sales(spark, sf)), returns(spark, sf))


# --------------------------------------------------------------- dirty rows

# Damage is placed by integer residues so that both engines place it alike.
DIRTY_SQL = """
dirty_base AS (
  SELECT *, (l_orderkey * 7 + l_linenumber) % 40 AS m,
         CASE o_custkey % 4 WHEN 0 THEN 'shopee' WHEN 1 THEN 'tokopedia' WHEN 2 THEN 'website' ELSE 'offline' END AS source,
         CAST(p_retailprice AS DECIMAL(14,2)) AS price, CAST(l_quantity AS INTEGER) AS qty,
         CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(16,2)) AS gross,
         CAST(CAST(CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS DECIMAL(14,2)) AS DECIMAL(16,2))
              * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS disc,
         CAST(o_orderdate AS DATE) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
dirty_copies AS (
  SELECT *, 0 AS copy FROM dirty_base
  UNION ALL SELECT *, 1 AS copy FROM dirty_base WHERE (l_orderkey + l_linenumber) % 9 = 0
),
dirty AS (
  SELECT source, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey * 2 + copy) * 64 + qty AS source_row_number, m, copy,
    CASE WHEN m = 8 THEN '' ELSE CASE WHEN copy = 1 THEN ' ' ELSE '' END || 'ORD-' || l_orderkey END AS order_id,
    CASE WHEN m = 6 THEN '0' WHEN m = 7 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS line_number,
    CASE WHEN m = 9 THEN '31/02/1998' WHEN m = 10 THEN 'N/A'
         WHEN source = 'shopee' THEN strftime(day, '%Y-%m-%d') WHEN source = 'tokopedia' THEN strftime(day, '%d/%m/%Y')
         WHEN source = 'website' THEN strftime(day, '%Y-%m-%dT00:00:00') ELSE strftime(day, '%d-%b-%Y') END AS order_date,
    CASE WHEN m = 17 THEN 'Unknown thing' WHEN m = 18 THEN 'none' WHEN source = 'website' THEN 'sku-' || p_partkey
         WHEN copy = 1 THEN upper(replace(p_name, ' ', '-')) || ' ' || p_partkey ELSE p_name || '_' || p_partkey END AS product_input,
    CASE WHEN m = 0 THEN '' WHEN m = 1 THEN 'abc' WHEN m = 2 THEN '-1' WHEN m = 3 THEN '1.5' WHEN m = 4 THEN '2147483648'
         WHEN m = 5 THEN qty || '.0' ELSE CAST(qty AS VARCHAR) END AS quantity,
    CASE WHEN m = 11 THEN '0' WHEN m = 12 THEN 'NaN' WHEN m = 13 THEN '10.123' WHEN m = 14 THEN CAST(price + 1 AS VARCHAR)
         ELSE CAST(price AS VARCHAR) END AS unit_price,
    CASE WHEN source = 'website' THEN CASE WHEN m = 22 THEN CAST(gross + 0.01 AS VARCHAR) WHEN m = 23 THEN ''
         WHEN m % 2 = 0 THEN CAST(gross - disc AS VARCHAR) ELSE CAST(gross AS VARCHAR) END END AS source_total_amount,
    CASE WHEN source IN ('shopee', 'tokopedia') THEN CASE WHEN m = 24 THEN '' ELSE 'Customer ' || o_custkey END END AS customer_name,
    CASE WHEN source = 'website' THEN CASE WHEN m = 28 THEN 'a@b' WHEN m = 29 THEN '' ELSE 'c' || o_custkey || '@mail.example' END END AS customer_email,
    CASE WHEN source IN ('shopee', 'tokopedia') THEN CASE WHEN m = 25 THEN 'n/a' WHEN o_custkey % 3 = 0 THEN ' jakarta '
         WHEN o_custkey % 3 = 1 THEN 'SURA-BAYA' ELSE 'Town ' || o_custkey % 50 END END AS customer_city,
    CASE WHEN source = 'offline' THEN 'Store ' || o_custkey % 7 END AS store_name,
    CASE WHEN source = 'offline' THEN CASE WHEN m = 25 THEN 'null' WHEN o_custkey % 2 = 0 THEN 'DEN pasar' ELSE 'Medan' END END AS store_city,
    CASE WHEN source <> 'website' THEN CASE WHEN m = 26 THEN 'Barter' WHEN m = 27 THEN '' WHEN o_custkey % 5 = 0 THEN 'e wallet'
         WHEN o_custkey % 5 = 1 THEN 'COD ' WHEN o_custkey % 5 = 2 THEN 'credit_card' WHEN o_custkey % 5 = 3 THEN 'cash'
         ELSE 'Transfer  Bank' END END AS payment_method,
    CASE WHEN m = 15 THEN 'IN_TRANSIT' WHEN m = 16 THEN ' ' WHEN o_orderstatus = 'F' THEN 'completed'
         WHEN o_orderstatus = 'P' THEN ' Returned' ELSE 'CANCELLED' END AS status,
    CASE WHEN m = 19 THEN '-5' WHEN m = 20 THEN '999999999' WHEN m = 21 THEN 'x1' WHEN disc = 0 THEN '' ELSE CAST(disc AS VARCHAR) END AS discount_amount,
    CASE WHEN disc > 0 THEN 'promo' || l_partkey % 12 ELSE '' END AS promo_code
  FROM dirty_copies
)"""


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """Channel rows as text with damaged cells, conflicting versions and exact copies."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice")
    rows = lines(spark, sf, "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
    base = rows.join(orders, F.expr("l_orderkey = o_orderkey")).join(part, F.expr("l_partkey = p_partkey")).selectExpr(
        "*", "(l_orderkey * 7 + l_linenumber) % 40 AS m", "CASE o_custkey % 4 WHEN 0 THEN 'shopee' WHEN 1 THEN 'tokopedia' WHEN 2 THEN 'website' ELSE 'offline' END AS source",
        "CAST(p_retailprice AS DECIMAL(14,2)) AS price", "CAST(l_quantity AS INT) AS qty", "CAST(o_orderdate AS DATE) AS day",
        "explode(CASE WHEN (l_orderkey + l_linenumber) % 9 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    base = base.selectExpr("*", "CAST(qty * price AS DECIMAL(16,2)) AS gross").selectExpr("*", "CAST(gross * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,2)) AS disc")
    market, web = "source IN ('shopee', 'tokopedia')", "source = 'website'"
    cells = {
        "order_id": "CASE WHEN m = 8 THEN '' ELSE CASE WHEN copy = 1 THEN ' ' ELSE '' END || 'ORD-' || l_orderkey END",
        "line_number": "CASE m WHEN 6 THEN '0' WHEN 7 THEN 'x' ELSE CAST(l_linenumber AS STRING) END",
        "order_date": """CASE WHEN m = 9 THEN '31/02/1998' WHEN m = 10 THEN 'N/A' WHEN source = 'shopee' THEN date_format(day, 'yyyy-MM-dd')
            WHEN source = 'tokopedia' THEN date_format(day, 'dd/MM/yyyy') WHEN source = 'website' THEN date_format(day, 'yyyy-MM-dd') || 'T00:00:00' ELSE date_format(day, 'dd-MMM-yyyy') END""",
        "product_input": f"""CASE WHEN m = 17 THEN 'Unknown thing' WHEN m = 18 THEN 'none' WHEN {web} THEN 'sku-' || p_partkey
            WHEN copy = 1 THEN upper(replace(p_name, ' ', '-')) || ' ' || p_partkey ELSE p_name || '_' || p_partkey END""",
        "quantity": "CASE m WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '-1' WHEN 3 THEN '1.5' WHEN 4 THEN '2147483648' WHEN 5 THEN qty || '.0' ELSE CAST(qty AS STRING) END",
        "unit_price": "CASE m WHEN 11 THEN '0' WHEN 12 THEN 'NaN' WHEN 13 THEN '10.123' WHEN 14 THEN CAST(CAST(price + 1 AS DECIMAL(14,2)) AS STRING) ELSE CAST(price AS STRING) END",
        "source_total_amount": f"""CASE WHEN {web} THEN CASE WHEN m = 22 THEN CAST(CAST(gross + 0.01 AS DECIMAL(16,2)) AS STRING) WHEN m = 23 THEN ''
            WHEN m % 2 = 0 THEN CAST(CAST(gross - disc AS DECIMAL(16,2)) AS STRING) ELSE CAST(gross AS STRING) END END""",
        "customer_name": f"CASE WHEN {market} THEN CASE WHEN m = 24 THEN '' ELSE 'Customer ' || o_custkey END END",
        "customer_email": f"CASE WHEN {web} THEN CASE WHEN m = 28 THEN 'a@b' WHEN m = 29 THEN '' ELSE 'c' || o_custkey || '@mail.example' END END",
        "customer_city": f"CASE WHEN {market} THEN CASE WHEN m = 25 THEN 'n/a' WHEN o_custkey % 3 = 0 THEN ' jakarta ' WHEN o_custkey % 3 = 1 THEN 'SURA-BAYA' ELSE 'Town ' || (o_custkey % 50) END END",
        "store_name": "CASE WHEN source = 'offline' THEN 'Store ' || (o_custkey % 7) END",
        "store_city": "CASE WHEN source = 'offline' THEN CASE WHEN m = 25 THEN 'null' WHEN o_custkey % 2 = 0 THEN 'DEN pasar' ELSE 'Medan' END END",
        "payment_method": f"""CASE WHEN NOT ({web}) THEN CASE WHEN m = 26 THEN 'Barter' WHEN m = 27 THEN '' WHEN o_custkey % 5 = 0 THEN 'e wallet' WHEN o_custkey % 5 = 1 THEN 'COD '
            WHEN o_custkey % 5 = 2 THEN 'credit_card' WHEN o_custkey % 5 = 3 THEN 'cash' ELSE 'Transfer  Bank' END END""",
        "status": "CASE WHEN m = 15 THEN 'IN_TRANSIT' WHEN m = 16 THEN ' ' WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN ' Returned' ELSE 'CANCELLED' END",
        "discount_amount": "CASE WHEN m = 19 THEN '-5' WHEN m = 20 THEN '999999999' WHEN m = 21 THEN 'x1' WHEN disc = 0 THEN '' ELSE CAST(disc AS STRING) END",
        "promo_code": "CASE WHEN disc > 0 THEN 'promo' || (l_partkey % 12) ELSE '' END",
    }
    out = base.selectExpr(
        "source", "source || '.csv' AS source_file", "((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey * 2 + copy) * 64 + qty AS source_row_number",
        f"'{'0' * 64}' AS source_sha256", *[f"{v} AS {k}" for k, v in cells.items()],
    )
    return out.selectExpr("*", "to_json(struct(order_id, line_number, quantity)) AS raw_payload")


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Clean product master: unique SKUs and names."""
    return table(spark, sf, "part").select(
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(14,2)").alias("price"),
    )


PRODUCTS_SQL = """
products AS (
  SELECT 'SKU-' || p_partkey AS sku, p_name || ' ' || p_partkey AS product_name, p_brand AS brand, p_type AS category,
         CAST(p_retailprice AS DECIMAL(14,2)) AS price FROM part
)"""


# ------------------------------------------------------------- promotions


def promotions(spark: SparkSession, sf: str) -> DataFrame:
    """Promotion catalogue with one code per part residue, its dates from the orders' range."""
    span = table(spark, sf, "orders").agg(F.min(F.col("o_orderdate").cast("date"))).scalar()
    codes = table(spark, sf, "part").select((F.col("p_partkey") % 12).alias("i")).distinct()
    return codes.withColumn("d0", span).select(
        F.concat(F.lit("PROMO"), F.col("i").cast("string")).alias("promo_code"),
        F.concat(F.lit("Promo "), F.col("i").cast("string")).alias("promo_name"),
        F.when(F.col("i") % 2 == 0, "percentage").otherwise("fixed").alias("discount_type"),
        F.when(F.col("i") % 2 == 0, F.col("i") + 5).otherwise(F.col("i") * 1000).cast("decimal(16,2)").alias("discount_value"),
        F.date_add("d0", (F.col("i") * 100).cast("int")).alias("start_date"),
        F.date_add("d0", (F.col("i") * 100 + 900).cast("int")).alias("end_date"),
        F.when(F.col("i") == 5, "paused").when(F.col("i") == 7, "expired").otherwise("active").alias("status"),
    )


PROMOTIONS_SQL = """
promotions AS (
  SELECT 'PROMO' || i AS promo_code, 'Promo ' || i AS promo_name,
         CASE WHEN i % 2 = 0 THEN 'percentage' ELSE 'fixed' END AS discount_type,
         CAST(CASE WHEN i % 2 = 0 THEN i + 5 ELSE i * 1000 END AS DECIMAL(16,2)) AS discount_value,
         d0 + CAST(i * 100 AS INTEGER) AS start_date, d0 + CAST(i * 100 + 900 AS INTEGER) AS end_date,
         CASE i WHEN 5 THEN 'paused' WHEN 7 THEN 'expired' ELSE 'active' END AS status
  FROM (SELECT DISTINCT p_partkey % 12 AS i FROM part), (SELECT min(CAST(o_orderdate AS DATE)) AS d0 FROM orders)
)"""


# ------------------------------------------------------------------ audit


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Pipeline runs read from the event log: one run per event."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = spread_small(table(spark, sf, "events")).withColumn("k", k)  # seven structs an event are made of it
    names = list(C.CHANNEL_CODES) + ["PRODUCT_MASTER", "PROMO_MASTER", "RETURN_EVENTS"]
    metric = [
        F.struct(
            F.lit(n).alias("source_name"), (F.col("k") * (i + 2)).alias("source_records"),
            (F.col("k") * i).alias("skipped_unchanged_records"), (F.col("k") * 2).alias("extracted_records"),
            F.col("k").alias("validated_records"), (F.col("k") % 5).alias("rejected_records"), (F.col("k") % 3).alias("duplicate_records"),
        )
        for i, n in enumerate(names)
    ]
    return e.select(
        F.col("event_id").cast("string").alias("run_id"), F.lit(C.PIPELINE_NAME).alias("pipeline_name"),
        F.col("ts").alias("started_at"),
        F.when(F.col("user_id") % 10 != 0, F.timestamp_add("SECOND", F.col("k").cast("int"), F.col("ts"))).alias("ended_at"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        (F.col("k") * 8).alias("extracted_records"), (F.col("k") * 4).alias("validated_records"),
        (F.col("k") % 5 * 4).alias("rejected_records"), (F.col("k") % 3 * 4).alias("duplicate_records"),
        (F.col("k") * 3).alias("incremental_records"), (F.col("k") * 2).alias("fact_inserted_records"),
        (F.col("k") * 3).alias("loaded_records"), (F.col("k") * 14).alias("source_records"),
        (F.col("k") * 6).alias("skipped_unchanged_records"), F.col("k").alias("fact_skipped_records"),
        F.col("value").cast("decimal(12,3)").alias("duration_seconds"), F.array(*metric).alias("source_metrics"),
        F.col("user_id"),
    )


RUNS_SQL = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, 'retail_sales' AS pipeline_name, ts AS started_at,
         CASE WHEN user_id % 10 <> 0 THEN ts + to_seconds(CAST(props->>'k' AS INTEGER)) END AS ended_at,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CAST(props->>'k' AS BIGINT) AS k, CAST(value AS DECIMAL(12,3)) AS duration_seconds, user_id
  FROM events
),
run_metrics AS (
  SELECT run_id, pipeline_name, started_at, status AS pipeline_status, k, source_name, i FROM runs,
    (VALUES ('SHOPEE', 0), ('TOKOPEDIA', 1), ('WEBSITE', 2), ('OFFLINE_STORE', 3), ('PRODUCT_MASTER', 4),
            ('PROMO_MASTER', 5), ('RETURN_EVENTS', 6)) AS n(source_name, i)
)"""


def quality_results(spark: SparkSession, sf: str) -> DataFrame:
    """Findings per run read from the event log: two per event."""
    e = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    rules = ["MISSING_REQUIRED", "DUPLICATE_BUSINESS_KEY", "INVALID_DATE", "INVALID_STATUS", "UNMAPPED_PRODUCT", "NON_POSITIVE"]
    fields = ["qty", "unit_price", "discount_amount", "status"]
    from salesloom.functions.classify import audit_category

    two = e.withColumn("j", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("r", F.col("event_id") + F.col("j") * 3)
    out = two.select(
        F.col("event_id").cast("string").alias("run_id"), _by_remainder("user_id", 4, C.CHANNEL_CODES).alias("source_name"),
        _by_remainder("r", 6, rules).alias("rule_name"),
        F.when(F.col("r") % 5 == 0, "WARNING").when(F.col("r") % 5 == 1, "INFO").otherwise("ERROR").alias("severity"),
        _by_remainder("r", 4, fields).alias("field"), (F.col("k") + F.col("j")).alias("failed_records"), F.col("ts").alias("evaluated_at"),
    )
    return out.withColumn("category", audit_category(F.col("rule_name"), F.col("field")))


QUALITY_SQL = """
quality0 AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id,
         CASE user_id % 4 WHEN 0 THEN 'SHOPEE' WHEN 1 THEN 'TOKOPEDIA' WHEN 2 THEN 'WEBSITE' ELSE 'OFFLINE_STORE' END AS source_name,
         CASE r % 6 WHEN 0 THEN 'MISSING_REQUIRED' WHEN 1 THEN 'DUPLICATE_BUSINESS_KEY' WHEN 2 THEN 'INVALID_DATE'
              WHEN 3 THEN 'INVALID_STATUS' WHEN 4 THEN 'UNMAPPED_PRODUCT' ELSE 'NON_POSITIVE' END AS rule_name,
         CASE r % 5 WHEN 0 THEN 'WARNING' WHEN 1 THEN 'INFO' ELSE 'ERROR' END AS severity,
         CASE r % 4 WHEN 0 THEN 'qty' WHEN 1 THEN 'unit_price' WHEN 2 THEN 'discount_amount' ELSE 'status' END AS field,
         CAST(props->>'k' AS BIGINT) + j AS failed_records, ts AS evaluated_at
  FROM (SELECT *, event_id + j * 3 AS r FROM events, (VALUES (0), (1)) AS t(j))
),
quality AS (
  SELECT *, CASE WHEN rule_name = 'MISSING_REQUIRED' THEN 'missing_value' WHEN rule_name = 'DUPLICATE_BUSINESS_KEY' THEN 'duplicate'
      WHEN rule_name = 'INVALID_DATE' THEN 'invalid_date' WHEN rule_name = 'INVALID_STATUS' THEN 'invalid_status'
      WHEN rule_name = 'UNMAPPED_PRODUCT' THEN 'unmapped_product' WHEN field = 'qty' THEN 'invalid_quantity'
      WHEN field = 'unit_price' THEN 'invalid_price_or_amount' ELSE 'other' END AS category
  FROM quality0
)"""


def present(df: DataFrame) -> DataFrame:
    """Compared form of a result: decimals as double, dates and timestamps as text."""
    columns = []
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            columns.append(F.col(name).cast("double").alias(name))
        elif kind == "date":
            columns.append(F.date_format(name, "yyyy-MM-dd").alias(name))
        elif kind.startswith("timestamp"):
            columns.append(F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)
