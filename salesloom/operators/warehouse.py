"""Staging rows, dimensions, facts and the sales detail view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom import contracts as C
from salesloom.functions import dates, text
from salesloom.functions.hashing import ZERO_HASH, record_hash
from salesloom.operators.merge import insert_missing, merge_upsert
from salesloom.operators.quality import channel_code_of
from salesloom.operators.skew import HOT_ROWS, lookup_left_join

SALE_KEY = ["source_name", "source_order_id", "source_line_number"]
RETURN_KEY = ["source_name", "return_id", "return_line_number"]

# Table schemas of the star schema.
DIM_SCHEMAS = {
    "dim_date": (
        "date_key int, full_date date, day_of_month int, month_number int, month_name string, "
        "quarter_number int, year_number int, day_name string, is_weekend boolean"
    ),
    "dim_product": (
        "product_key bigint, sku string, product_name string, brand string, category string, "
        "standard_price decimal(14,2), is_active boolean"
    ),
    "dim_customer": "customer_key bigint, customer_nk string, customer_name string, city string",
    "dim_channel": "channel_key bigint, channel_code string, channel_name string, channel_type string",
    "dim_payment": "payment_key bigint, payment_method string",
    "dim_promotion": (
        "promo_code string, promo_name string, discount_type string, discount_value decimal(16,2), "
        "start_date date, end_date date, status string, is_active boolean"
    ),
}
FACT_SCHEMAS = {
    "fact_sales": (
        "sales_key bigint, source_name string, source_order_id string, source_line_number int, date_key int, "
        "product_key bigint, customer_key bigint, channel_key bigint, payment_key bigint, sale_status string, "
        "quantity int, unit_price decimal(14,2), gross_amount decimal(16,2), discount_amount decimal(16,2), "
        "net_amount decimal(16,2), promo_code string, source_record_hash string, is_source_active boolean, "
        "loaded_at timestamp"
    ),
    "fact_returns": (
        "return_key bigint, source_name string, return_id string, return_line_number int, source_order_id string, "
        "source_line_number int, return_date date, return_reason string, return_status string, "
        "quantity_returned int, refund_amount decimal(16,2), refund_status string, source_row_number bigint, "
        "source_record_hash string, ingestion_run_id string, updated_at timestamp"
    ),
}
STAGING_SCHEMAS = {
    "stg_sales": (
        "ingestion_run_id string, source_name string, source_raw_record_id string, source_row_number bigint, "
        "source_order_id string, source_line_number int, order_date date, product_input string, mapped_sku string, "
        "customer_nk string, customer_name string, city string, payment_method string, sale_status string, "
        "quantity int, unit_price decimal(14,2), gross_amount decimal(16,2), discount_amount decimal(16,2), "
        "net_amount decimal(16,2), promo_code string, source_total_amount decimal(16,2), "
        "source_record_hash string, transformed_at timestamp"
    ),
    "stg_returns": (
        "ingestion_run_id string, source_name string, return_id string, return_line_number int, "
        "source_order_id string, source_line_number int, return_date date, return_reason string, "
        "return_status string, quantity_returned int, refund_amount decimal(16,2), refund_status string, "
        "source_row_number bigint, source_record_hash string, transformed_at timestamp"
    ),
}


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def surrogate(*natural: str) -> Column:
    """Deterministic surrogate key of a natural key; retries and re-runs agree on it."""
    return F.xxhash64(*natural)


# ------------------------------------------------------------------ staging


def customer_key_text(source_code: Column, email: Column, name: Column, city: Column) -> Column:
    """Customer natural key: channel plus e-mail, else name and city (C4)."""
    has = lambda c: c.isNotNull() & (c != "")
    return F.when(has(email), F.concat(source_code, F.lit(":EMAIL:"), email)).when(
        has(name), F.concat(source_code, F.lit(":NAME:"), name, F.lit(":"), F.coalesce(city, F.lit("")))
    )


def to_staging(clean: DataFrame) -> DataFrame:
    """Clean channel rows in staging form."""
    code = channel_code_of("source")
    hashed = [c for c in C.SALES_COLUMNS if c not in C.LINEAGE[1:] + ("net_amount",)]
    money = lambda c: F.col(c).cast("decimal(16,2)")
    return clean.select(
        code.alias("source_name"), F.col("source_row_number").cast("bigint").alias("source_row_number"),
        F.col("order_id").alias("source_order_id"), F.col("line_number").alias("source_line_number"), "order_date",
        F.col("product_name").alias("product_input"), F.col("sku").alias("mapped_sku"),
        customer_key_text(code, F.col("customer_email"), F.col("customer_name"), F.col("customer_city")).alias("customer_nk"),
        "customer_name",
        F.when(F.col("source") == "offline", F.col("store_city")).otherwise(F.col("customer_city")).alias("city"),
        "payment_method", F.col("status").alias("sale_status"), "quantity", "unit_price",
        money("gross_amount").alias("gross_amount"), money("discount_amount").alias("discount_amount"),
        money("net_amount").alias("net_amount"), "promo_code", "source_total_amount",
        record_hash(hashed).alias("source_record_hash"),
    )


def latest_raw(raw_index: DataFrame) -> DataFrame:
    """The newest raw record of each source row (H5)."""
    newest = F.max(F.struct("loaded_at", "raw_record_id", "ingestion_run_id")).alias("_n")
    return raw_index.groupBy("source_name", "source_row_number").agg(newest).select(
        "source_name", "source_row_number", "_n.ingestion_run_id", "_n.loaded_at", "_n.raw_record_id"
    )


def advance_raw_index(old: DataFrame, new: DataFrame) -> DataFrame:
    """The index of latest raw records after a run's rows (F16): only the rows of its buckets meet."""
    return latest_raw(old.unionByName(new.select(*old.columns)))


def with_raw_lineage(staged: DataFrame, raw_index: DataFrame, run_id: str) -> DataFrame:
    """Raw record of each staged row: this run's, else the newest of that source row (F16, H5).

    ``raw_index`` has source_name, source_row_number, ingestion_run_id,
    loaded_at, raw_record_id.
    """
    rank = F.struct((F.col("ingestion_run_id") == run_id).alias("here"), "loaded_at", "raw_record_id")
    newest = raw_index.groupBy("source_name", "source_row_number").agg(F.max(rank).alias("_newest"))
    joined = staged.join(newest, ["source_name", "source_row_number"], "left")
    return joined.select(*staged.columns, F.col("_newest.raw_record_id").alias("source_raw_record_id"))


def merge_staging(old: DataFrame, new: DataFrame, run_id: str, now: Column, keys=SALE_KEY, with_run: bool = True) -> DataFrame:
    """Staging upsert when content or run differs (B4), or content alone."""
    changed = ~F.col("o.source_record_hash").eqNullSafe(F.col("n.source_record_hash"))
    if with_run:
        changed = changed | (F.col("o.ingestion_run_id") != run_id)
    stamp = {"ingestion_run_id": F.lit(run_id), "transformed_at": now}
    return merge_upsert(old, new, keys, changed, on_insert=stamp, on_update=stamp)


# --------------------------------------------------------------- dimensions


def channel_members(spark: SparkSession, names: dict[str, str] | None = None) -> DataFrame:
    """The four channels (B6); ``names`` overrides display names by code."""
    names = names or {}
    rows = [(c.code, names.get(c.code, c.label), c.kind) for c in C.CHANNELS.values()]
    return spark.createDataFrame(rows, "channel_code string, channel_name string, channel_type string")


def merge_channels(old: DataFrame, members: DataFrame) -> DataFrame:
    key = {"channel_key": F.xxhash64("n.channel_code")}
    return merge_upsert(old, members, ["channel_code"], on_insert=key)


def merge_products(old: DataFrame, products: DataFrame) -> DataFrame:
    """SCD type 1."""
    new = products.select("sku", "product_name", "brand", "category", F.col("price").alias("standard_price"))
    insert = {"product_key": F.xxhash64("n.sku"), "is_active": F.lit(True)}
    return merge_upsert(old, new, ["sku"], on_insert=insert)


def calendar(staged: DataFrame, day: str = "order_date") -> DataFrame:
    """Calendar rows of the days present."""
    days = staged.select(F.col(day).alias("_d")).distinct()
    return days.select(*[v.alias(k) for k, v in dates.calendar_columns(F.col("_d")).items()])


def merge_dates(old: DataFrame, staged: DataFrame) -> DataFrame:
    return insert_missing(old, calendar(staged), ["date_key"])


def batch_customers(staged: DataFrame) -> DataFrame:
    """One row per customer: the last non-empty name and city of the batch."""
    position = F.struct("source_name", "source_row_number")
    last = lambda c: F.max_by(F.col(c), F.when(F.coalesce(F.col(c), F.lit("")) != "", position))
    return (
        staged.where("customer_nk IS NOT NULL")
        .groupBy("customer_nk")
        .agg(last("customer_name").alias("customer_name"), last("city").alias("city"))
    )


def merge_customers(old: DataFrame, staged: DataFrame) -> DataFrame:
    """A missing new name or city never erases a known one."""
    assign = {
        "customer_name": F.coalesce("n.customer_name", "o.customer_name"),
        "city": F.when(text.is_missing("n.city"), F.col("o.city")).otherwise(F.col("n.city")),
    }
    return merge_upsert(
        old, batch_customers(staged), ["customer_nk"], assign=assign,
        on_insert={"customer_key": F.xxhash64("n.customer_nk")},
    )


def merge_payments(old: DataFrame, staged: DataFrame) -> DataFrame:
    """Insert-if-absent."""
    new = staged.where(F.coalesce("payment_method", F.lit("")) != "").select("payment_method").distinct()
    return insert_missing(old, new.withColumn("payment_key", F.xxhash64("payment_method")), ["payment_method"])


def merge_promotions(old: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue rows are active, all others are switched off."""
    merged = merge_upsert(
        old, catalogue.withColumn("is_active", F.lit(True)), ["promo_code"]
    )
    return merged.withColumn("is_active", F.when(F.col("merge_action") == "keep", F.lit(False)).otherwise(F.col("is_active")))


def clean_city_markers(customers: DataFrame) -> DataFrame:
    """Missing-marker cities of an existing dimension become null."""
    return customers.withColumn("city", F.when(text.usable_text("city"), F.col("city")))


def backfill_hash(table: DataFrame) -> DataFrame:
    """Rows without a content hash get 64 zeros, so the next run sees them as changed."""
    return table.withColumn("source_record_hash", F.coalesce("source_record_hash", F.lit(ZERO_HASH)))


# -------------------------------------------------------------------- facts


def resolve_dimensions(staged: DataFrame, dims: dict[str, DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Star lookup of staged rows (F1): date, product, channel required; customer, payment optional."""
    spread = ["source_name", "source_row_number"]
    day = dims["dim_date"].select("date_key", F.col("full_date").alias("order_date"))
    channel = dims["dim_channel"].select("channel_key", F.col("channel_code").alias("source_name"))
    product = dims["dim_product"].select("product_key", F.col("sku").alias("mapped_sku"))
    payment = dims["dim_payment"].select("payment_key", "payment_method")
    customer = dims["dim_customer"].select("customer_key", "customer_nk")
    # dim_channel has 4 members, dim_date at most the days of 2000-2100
    joined = staged.join(F.broadcast(day), "order_date").join(F.broadcast(channel), "source_name")
    joined = lookup_left_join(joined, product, ["mapped_sku"], spread, hot_rows).where("product_key IS NOT NULL")
    joined = lookup_left_join(joined, payment, ["payment_method"], spread, hot_rows)
    return lookup_left_join(joined, customer, ["customer_nk"], spread, hot_rows)


def merge_sales_facts(old: DataFrame, staged: DataFrame, dims: dict[str, DataFrame], now: Column) -> DataFrame:
    """Fact upsert (B12, K7): new, changed or switched-off keys are written; others keep ``loaded_at``."""
    new = resolve_dimensions(staged, dims).withColumns(
        {"sales_key": surrogate(*SALE_KEY), "is_source_active": F.lit(True), "loaded_at": now}
    )
    columns = [c for c in old.columns if c in new.columns]
    changed = ~F.col("o.source_record_hash").eqNullSafe(F.col("n.source_record_hash")) | ~F.coalesce(
        F.col("o.is_source_active"), F.lit(False)
    )
    return merge_upsert(old, new.select(*columns), SALE_KEY, changed)


def merge_return_facts(old: DataFrame, accepted: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Return fact upsert when the content differs."""
    new = accepted.withColumns(
        {"return_key": surrogate(*RETURN_KEY), "ingestion_run_id": F.lit(run_id), "updated_at": now}
    )
    columns = [c for c in old.columns if c in new.columns]
    changed = ~F.col("o.source_record_hash").eqNullSafe(F.col("n.source_record_hash"))
    return merge_upsert(old, new.select(*columns), RETURN_KEY, changed)


# -------------------------------------------------------------- detail view


def line_returns(return_facts: DataFrame) -> DataFrame:
    """Approved or processed units and processed refunds per sale line (G1)."""
    returned = F.when(F.col("return_status").isin("APPROVED", "PROCESSED"), F.col("quantity_returned"))
    refunded = F.when(F.col("refund_status") == "PROCESSED", F.col("refund_amount"))
    return return_facts.groupBy(*SALE_KEY).agg(
        F.sum(returned).alias("returned_units"), F.sum(refunded).alias("processed_refund_amount")
    )


def with_returns(lines: DataFrame, return_facts: DataFrame) -> DataFrame:
    """Sale lines with their return totals; returns are aggregated before the join."""
    joined = lines.join(line_returns(return_facts), SALE_KEY, "left")
    return joined.withColumns(
        {
            "returned_units": F.coalesce("returned_units", F.lit(0).cast("bigint")),
            "processed_refund_amount": F.coalesce("processed_refund_amount", F.lit(0).cast("decimal(26,2)")),
            "is_eligible_sale": F.col("sale_status").isin(*C.ELIGIBLE_STATUSES),
        }
    )


def denormalize(facts: DataFrame, dims: dict[str, DataFrame], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Active facts joined to their dimensions."""
    active = facts.where("is_source_active")
    spread = ["sales_key"]
    joined = active.join(F.broadcast(dims["dim_date"].select("date_key", F.col("full_date").alias("order_date"))), "date_key")
    joined = joined.join(F.broadcast(dims["dim_channel"]), "channel_key")
    product = dims["dim_product"].select("product_key", F.col("sku").alias("product_id"), "product_name", "brand", "category")
    joined = lookup_left_join(joined, product, ["product_key"], spread, hot_rows).where("product_id IS NOT NULL")
    joined = lookup_left_join(joined, dims["dim_payment"], ["payment_key"], spread, hot_rows)
    return lookup_left_join(joined, dims["dim_customer"].select("customer_key", "customer_name", "city"), ["customer_key"], spread, hot_rows)


def sales_detail(facts: DataFrame, dims: dict[str, DataFrame], return_facts: DataFrame) -> DataFrame:
    """The reporting view: active facts, dimensions and return totals per line."""
    return with_returns(denormalize(facts, dims), return_facts)
