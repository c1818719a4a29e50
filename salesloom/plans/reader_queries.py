"""Registered queries of the file readers and raw writers.

Records are read from files whose lines are made from `documents`: every source is a file: a header, then one quoted record per document in order of doc_id, with blank lines between, cut into lines at
each line end of its texts. Splits end in the middle of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom import contracts as C
from salesloom.operators import records as X
from salesloom.plans import quality_queries as Q, testdata as T
from salesloom.plans.sales_queries import SALES_SQL
from salesloom.sources import files, sinks

QUERIES: dict = {}
HEADER = ["doc_id", "text", "lang"]


def add(name: str, sql: str):
    def put(fn):
        QUERIES[name] = (fn, sql)
        return fn

    return put


def _quoted(column: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))


def document_lines(spark: SparkSession, sf_dir: str, splits: int = 64, damaged: bool = False) -> DataFrame:
    """(source_file, split, at, value): physical lines in about ``splits`` splits a file, every split's last record cut in two.

    damaged: records of every eleventh document lack a cell, those of every thirteenth have one more.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"))
    step = F.greatest(F.ceil((F.col("last") + 1) / splits), F.lit(1))
    last = docs.agg(F.max("doc_id").alias("last"))
    placed = docs.join(F.broadcast(last)).withColumn("step", step.cast("bigint"))  # one row
    cells = [F.col("doc_id").cast("string"), _quoted(F.col("text")), F.col("lang")]
    record = F.concat_ws(",", *cells)
    if damaged:
        record = F.when(F.col("doc_id") % 11 == 3, F.concat_ws(",", *cells[:2])).when(F.col("doc_id") % 13 == 5, F.concat_ws(",", *cells, F.lit("more"))).otherwise(record)
    lines = F.split(F.concat(record, F.when(F.col("doc_id") % 3 == 0, "\r").otherwise("")), "\n")
    lines = F.when(F.col("doc_id") % 5 == 0, F.concat(F.array(F.lit(""), F.lit("  ")), lines)).otherwise(lines)
    exploded = placed.select("source", "doc_id", "step", F.size(lines).alias("n"), F.posexplode(lines).alias("k", "value"))
    ends = (F.col("doc_id") % F.col("step") == F.col("step") - 1) & (F.col("k") >= F.floor(F.col("n") / 2))
    split = F.floor(F.col("doc_id") / F.col("step")) + F.when(ends, 1).otherwise(0)
    body = exploded.select(F.concat("source", F.lit(".csv")).alias("source_file"), split.cast("bigint").alias("split"), F.struct(F.col("doc_id").alias("doc"), F.col("k").alias("line")).alias("at"), "value")
    heads = docs.select("source").distinct().select(
        F.concat("source", F.lit(".csv")).alias("source_file"), F.lit(0).cast("bigint").alias("split"),
        F.struct(F.lit(-1).cast("bigint").alias("doc"), F.lit(0).alias("line")).alias("at"), F.lit("﻿" + ",".join(HEADER)).alias("value"),
    )
    return heads.unionByName(body)


_DOCS_SQL = """SELECT coalesce(source, '') || '.csv' AS source_file, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) AS source_row_number, doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang FROM documents"""


@add("a1_quoted_records", f"SELECT source_file, source_row_number, CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM ({_DOCS_SQL})")
def quoted_records(spark: SparkSession, sf_dir: str, splits: int = 64) -> DataFrame:
    """Cells of all records, with their row numbers, put together from lines over many splits."""
    return X.cells(X.records(document_lines(spark, sf_dir, splits)), HEADER).drop("_corrupt")


@add("a3_record_widths", f"SELECT source_file, source_row_number, doc_id % 11 = 3 OR doc_id % 13 = 5 AS is_broken FROM ({_DOCS_SQL})")
def record_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which records are narrower or wider than the header, by row number (A3)."""
    rows = X.cells(X.records(document_lines(spark, sf_dir, damaged=True)), HEADER)
    return rows.select("source_file", "source_row_number", F.col("_corrupt").isNotNull().alias("is_broken"))


# ------------------------------------------------------- columns and freshness


@add("a16_optional_columns", f"{SALES_SQL} SELECT source_name, source_order_id, source_line_number, CASE WHEN l_orderkey % 3 = 0 THEN '0' ELSE CAST(quantity AS VARCHAR) END AS discount_amount, '' AS promo_code FROM sales")
def optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent cells of one optional column, and the other column absent, are filled."""
    discount = F.when(F.col("l_orderkey") % 3 != 0, F.col("quantity").cast("string"))
    return files.back_fill_optional(T.sales(spark, sf_dir).select("source_name", "source_order_id", "source_line_number", discount.alias("discount_amount")))


@add("a19_legacy_columns", f"{SALES_SQL} SELECT source_name, source_order_id, sale_status AS status, CAST(order_date AS VARCHAR) AS order_date, CAST(quantity AS VARCHAR) AS price FROM sales")
def legacy_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel frames with their older column names, read under the current ones."""
    parts = []
    for key, contract in C.CHANNELS.items():
        date_column = "transaction_date" if key == "tokopedia" else "order_date"
        rows = T.sales(spark, sf_dir).where(F.col("source_name") == contract.code)
        frame = rows.select("source_name", "source_order_id", F.col("sale_status").alias("status"), F.col("order_date").cast("string").alias(date_column), F.col("quantity").cast("string").alias("price"))
        for channel, old, new in C.LEGACY_COLUMNS:
            if channel == key:
                frame = frame.withColumnRenamed(new, old)
        parts.append(files.rename_legacy(frame, key).select("source_name", "source_order_id", "status", F.col(date_column).alias("order_date"), "price"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_SEEN = "SELECT CAST(user_id AS VARCHAR) AS file, max(ts) AS t FROM events WHERE user_id % 3 <> 0 GROUP BY 1"


@add("a18_file_freshness", f"""WITH e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS file FROM events), f AS ({_SEEN}), n AS (SELECT max(ts) AS now FROM events)
SELECT file, CASE WHEN t IS NULL THEN 'missing' ELSE 'stale' END AS reason FROM e LEFT JOIN f USING (file), n WHERE t IS NULL OR round(date_diff('second', t, now) / 3600.0, 2) > 48""")
def file_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by users whose last event is their age: those that are overdue at the last event of all, a third are missing."""
    events = T.table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("file"), (F.col("user_id") % 3 != 0).alias("there"), F.col("ts").cast("timestamp").alias("ts"))
    seen = events.where("there").groupBy("file").agg(F.max("ts").alias("modificationTime"))
    now = events.agg(F.max("ts")).scalar()
    return files.overdue(events.select("file").distinct(), seen, now).select("file", "reason")


# ------------------------------------------------------------------ raw rows


def _landed(rows: DataFrame, columns, name: str) -> DataFrame:
    lined = rows.withColumns({"source_file": F.lit(name), "source_sha256": F.lit("0" * 64)})
    return sinks.raw_rows(lined, list(columns), "r1", F.lit("2026-01-02 00:00:00").cast("timestamp"))


@add("b2_raw_promotions", f"{SALES_SQL},{T.PROMOTIONS_SQL} SELECT 'r1/promo_master.csv/' || (CAST(substr(promo_code, 6) AS BIGINT) + 1) AS raw_record_id, promo_code, promo_code AS payload_code, CAST(start_date AS VARCHAR) AS start_date, status FROM promotions")
def raw_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the promotion catalogue with their payload (B2)."""
    catalogue = T.promotions(spark, sf_dir)
    cells = catalogue.select((F.substring("promo_code", 6, 9).cast("bigint") + 1).alias("source_row_number"), *[F.col(c).cast("string").alias(c) for c in C.PROMO_COLUMNS])
    rows = _landed(cells, C.PROMO_COLUMNS, C.PROMO_FILE)
    return rows.select("raw_record_id", "promo_code", F.get_json_object("source_payload", "$.promo_code").alias("payload_code"), "start_date", "status")


@add("b3_raw_returns", f"{Q.RETURN_CTE} SELECT 'r1/{C.RETURN_FILE}/' || source_row_number AS raw_record_id, return_id, r_order AS order_id, r_order AS payload_order FROM raw_returns")
def raw_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows of the return events with their payload."""
    rows = _landed(Q.return_rows(spark, sf_dir).select("source_row_number", *C.RETURN_COLUMNS), C.RETURN_COLUMNS, C.RETURN_FILE)
    return rows.select("raw_record_id", "return_id", "order_id", F.get_json_object("source_payload", "$.order_id").alias("payload_order"))


@add("b22_landing_append", f"{SALES_SQL} SELECT source_order_id AS order_id, CAST(source_line_number AS VARCHAR) AS order_line_id, CASE WHEN l_orderkey % 2 = 0 THEN coalesce(promo_code, '') ELSE '' END AS promo_code FROM sales WHERE source_name = 'SHOPEE'")
def landing_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch under the full contract appended to a source that still has the older header."""
    contract = C.CHANNELS["shopee"]
    sales = T.sales(spark, sf_dir).where("source_name = 'SHOPEE'")
    known = {contract.order_column: F.col("source_order_id"), contract.line_column: F.col("source_line_number").cast("string"), "promo_code": F.coalesce("promo_code", F.lit(""))}
    full = sales.select("l_orderkey", *[known.get(c, F.lit("")).alias(c) for c in contract.all_columns])
    old, batch = full.where("l_orderkey % 2 = 1").select(*contract.required_columns), full.where("l_orderkey % 2 = 0").select(*contract.all_columns)
    return sinks.landing_batch(old, batch, "shopee").select(F.col(contract.order_column).alias("order_id"), F.col(contract.line_column).alias("order_line_id"), "promo_code")
