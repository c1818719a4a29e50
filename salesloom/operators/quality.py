"""Row rules, dispositions and quality evidence as one lazy plan.

All channels run through the same plan: their rows carry the canonical text
fields plus a ``source`` column, and every rule is a native column expression.
Each row ends with its typed canonical values, an ``issues`` array, its
``reasons`` text and a ``disposition``: clean, duplicate or rejected.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C
from salesloom.functions import dates, numbers, text
from salesloom.functions.hashing import signature_columns
from salesloom.operators.skew import HOT_ROWS, annotate_keys, lookup_left_join
from salesloom.session import stored

EVIDENCE_COLUMNS = C.LINEAGE + ("business_key", "source_line_number", "reasons", "raw_payload")


def canonical_rows(native: DataFrame, channel: str) -> DataFrame:
    """Rename a channel's native columns to canonical text fields.

    Needs the required native columns plus lineage and ``raw_payload``; absent
    optional columns and fields the channel does not have become null.
    """
    contract = C.CHANNELS[channel]
    missing = sorted(set(contract.required_columns) - set(native.columns))
    if missing:
        raise ValueError(f"{contract.file_name}: missing columns {missing}")
    fields = dict(contract.fields)
    fields.update({c: c for c in C.OPTIONAL_FIELDS if c in native.columns})
    picked = [
        (F.col(fields[f]) if f in fields else F.lit(None)).cast("string").alias(f) for f in C.CANONICAL_FIELDS
    ]
    extra = [c for c in ("raw_payload", "payload_hash") if c in native.columns]
    lineage = [F.lit(channel).alias("source")] + [F.col(c) for c in C.LINEAGE[1:]]
    return native.select(*lineage, *extra, *picked)


def native_name_sql(canonical: str) -> str:
    """Native column name of a canonical field in the row's channel."""
    if canonical in C.OPTIONAL_FIELDS:
        return f"'{canonical}'"
    cases = " ".join(f"WHEN '{k}' THEN '{c.fields[canonical]}'" for k, c in C.CHANNELS.items() if canonical in c.fields)
    return f"CASE source {cases} ELSE '{canonical}' END"


def _has_field_sql(canonical: str) -> str:
    return "source IN (" + ", ".join(f"'{k}'" for k, c in C.CHANNELS.items() if canonical in c.fields) + ")"


def _issue_sql(condition: str, rule: str, field: str, raw: str, severity: str = "ERROR") -> str:
    """Findings of one rule, one or none; ``rule`` and ``field`` are SQL text."""
    entry = f"named_struct('severity', '{severity}', 'rule', {rule}, 'field', {field}, 'raw_value', CAST({raw} AS STRING))"
    return f"CASE WHEN {condition} THEN array({entry}) ELSE array() END"


def _issues_sql(checks) -> str:
    """Findings of all rules. A filter on the array would evaluate every rule under it without generated code."""
    return "flatten(array(" + ", ".join(checks) + "))"


_ERRORS_SQL = "transform(filter(issues, i -> i.severity = 'ERROR'), i -> concat(i.field, ':', i.rule))"


# --------------------------------------------------------------- product map


def product_keys(products: DataFrame) -> DataFrame:
    """One row per match key of a product: normalised SKU and normalised name."""
    return products.select(
        F.explode(F.array(text.match_key("sku"), text.match_key("product_name"))).alias("product_match"),
        F.struct("sku", "product_name", "brand", "category", F.col("price").alias("master_price")).alias("product"),
    )


def ambiguous_product_keys(products: DataFrame) -> DataFrame:
    """Match keys that point at more than one SKU."""
    return (
        product_keys(products)
        .groupBy("product_match")
        .agg(F.min("product.sku").alias("first_sku"), F.max("product.sku").alias("last_sku"))
        .where(F.col("first_sku") != F.col("last_sku"))
    )


def product_lookup(products: DataFrame, strict: bool = True) -> DataFrame:
    """Lookup by match key; an ambiguous key fails the job (or stays unmapped when not strict)."""
    if strict:
        clash = ambiguous_product_keys(products).limit(1).collect()
        if clash:
            raise ValueError(f"product key {clash[0]['product_match']!r} stands for several products")
    return (
        product_keys(products)
        .groupBy("product_match")
        .agg(F.min("product").alias("product"), F.max("product.sku").alias("_last_sku"))
        .where(F.col("product.sku") == F.col("_last_sku"))
        .select("product_match", "product.*")
    )


def map_products(
    rows: DataFrame, lookup: DataFrame, raw: str, spread_on: list[str], hot_rows: int = HOT_ROWS, unicode: bool = True, whole: bool = False
) -> DataFrame:
    """Left join of a raw product text, cleaned, to the lookup (F2); unmapped rows keep nulls."""
    cleaned = text.with_clean_text(rows, {"_cleaned": raw}, unicode)
    match = F.when(F.col("_cleaned").isNotNull(), text.match_key("_cleaned", cleaned=True))
    keyed = cleaned.withColumn("product_match", match).drop("_cleaned")
    return lookup_left_join(keyed, lookup, ["product_match"], spread_on, hot_rows, whole=whole).drop("product_match")


# ------------------------------------------------------------------- rules


def apply_sales_rules(
    rows: DataFrame, lookup: DataFrame, unicode: bool = True, hot_rows: int = HOT_ROWS, whole: bool = False
) -> DataFrame:
    """Typed canonical columns and the row-level issues.

    The product is joined to the raw cells, before other forms of them stand beside them. ``whole`` tells that all
    columns or all issues are read, so that the rows may travel as one text.
    """
    keep = [*C.LINEAGE, *[c for c in ("raw_payload", "payload_hash") if c in rows.columns]]
    staged = rows.selectExpr(*keep, *[f"CAST(`{f}` AS STRING) AS _r_{f}" for f in C.CANONICAL_FIELDS])
    staged = map_products(staged, lookup, "_r_product_input", ["source", "source_row_number"], hot_rows, unicode, whole)
    staged = text.with_clean_text(staged, {f"_c_{f}": f"_r_{f}" for f in C.CANONICAL_FIELDS}, unicode)
    has_total = _has_field_sql("source_total_amount")
    staged = staged.selectExpr(
        "*",
        f"{numbers.line_sql('_c_line_number')} AS line_number",
        f"{dates.date_sql('_c_order_date', 'source')} AS order_date",
        f"{numbers.integer_sql('_c_quantity')} AS _qty",
        f"{numbers.money_sql('_c_unit_price')} AS _price",
        f"{numbers.nonnegative_sql('_c_discount_amount')} AS _disc",
        f"CASE WHEN {has_total} THEN {numbers.money_sql('_c_source_total_amount')} END AS _total",
        f"{text.email_sql('_c_customer_email')} AS _email_ok",
        f"{text.known_payment_sql('_c_payment_method', unicode)} AS _known_payment",
    )
    staged = staged.selectExpr(
        "*", f"{numbers.accepted_sql('_qty')} AS quantity", f"{numbers.accepted_sql('_price')} AS unit_price",
        f"{numbers.accepted_sql('_disc')} AS discount_amount",
        f"CAST({numbers.accepted_sql('_total')} AS DECIMAL(16,2)) AS source_total_amount",
    ).selectExpr("*", "CAST(quantity * unit_price AS DECIMAL(24,2)) AS gross_amount")
    typed = staged.selectExpr(
        "*",
        "_c_order_id AS order_id", "_c_customer_name AS customer_name", "_c_store_name AS store_name",
        "CASE WHEN discount_amount <= gross_amount THEN CAST(gross_amount - discount_amount AS DECIMAL(24,2)) END AS net_amount",
        "upper(_c_promo_code) AS promo_code", "CASE WHEN _email_ok THEN _c_customer_email END AS customer_email",
        f"{text.city_sql('_c_customer_city', unicode)} AS customer_city", f"{text.city_sql('_c_store_city', unicode)} AS store_city",
        "coalesce(_known_payment, _c_payment_method) AS payment_method", "upper(coalesce(_c_status, '')) AS status",
    )
    statuses = ", ".join(f"'{s}'" for s in C.SALE_STATUSES)
    date_error = dates.date_error_sql("_c_order_date", "order_date")
    rules = [
        ("line_number IS NULL", "'INVALID_LINE_NUMBER'", "line_number"),
        ("order_id IS NULL", "'MISSING_REQUIRED'", "order_id"),
        ("order_date IS NULL", date_error, "order_date"),
        ("_qty.error IS NOT NULL", "_qty.error", "quantity"),
        ("_price.error IS NOT NULL", "_price.error", "unit_price"),
        ("status = ''", "'MISSING_REQUIRED'", "status"),
        (f"status <> '' AND status NOT IN ({statuses})", "'INVALID_STATUS'", "status"),
        ("_c_product_input IS NULL", "'MISSING_REQUIRED'", "product_input"),
        ("_c_product_input IS NOT NULL AND sku IS NULL", "'UNMAPPED_PRODUCT'", "product_input"),
        ("sku IS NOT NULL AND unit_price <> master_price", "'PRICE_DIFFERS_FROM_MASTER'", "unit_price", "WARNING"),
        ("_disc.error IS NOT NULL", "_disc.error", "discount_amount"),
        ("discount_amount > gross_amount", "'DISCOUNT_EXCEEDS_GROSS'", "discount_amount"),
        ("_total.error IS NOT NULL", "_total.error", "source_total_amount"),
        (
            "source_total_amount <> gross_amount AND NOT (source_total_amount <=> net_amount)",
            "'AMOUNT_MISMATCH'", "source_total_amount",
        ),
        *[(f"{_has_field_sql(f)} AND _c_{f} IS NULL", "'MISSING_OPTIONAL'", f, "WARNING") for f in C.OPTIONAL_WARNED_FIELDS],
        ("_c_payment_method IS NOT NULL AND _known_payment IS NULL", "'UNKNOWN_PAYMENT'", "payment_method", "WARNING"),
        ("NOT _email_ok", "'INVALID_EMAIL'", "customer_email", "WARNING"),
    ]
    checks = [_issue_sql(test, rule, native_name_sql(f), f"_r_{f}", *severity) for test, rule, f, *severity in rules]
    extra = [c for c in keep if c not in C.LINEAGE]
    return typed.selectExpr(*C.SALES_COLUMNS, *extra, f"{_issues_sql(checks)} AS issues")


def apply_product_rules(rows: DataFrame, unicode: bool = True) -> DataFrame:
    """Typed product master rows and their issues."""
    required = C.PRODUCT_COLUMNS[:-1]
    extra = [c for c in ("raw_payload", "payload_hash") if c in rows.columns]
    staged = rows.selectExpr("'product' AS source", *C.LINEAGE[1:], *extra, *[f"`{c}` AS _r_{c}" for c in C.PRODUCT_COLUMNS])
    staged = text.with_clean_text(staged, {c: f"_r_{c}" for c in C.PRODUCT_COLUMNS}, unicode)
    staged = staged.selectExpr("*", f"{numbers.money_sql('price')} AS _price")
    checks = [_issue_sql(f"{c} IS NULL", "'MISSING_REQUIRED'", f"'{c}'", f"_r_{c}") for c in required]
    checks.append(_issue_sql("_price.error IS NOT NULL", "_price.error", "'price'", "_r_price"))
    return staged.selectExpr(
        "upper(sku) AS sku", *required[1:], f"{numbers.accepted_sql('_price')} AS price", *C.LINEAGE, *extra,
        f"{_issues_sql(checks)} AS issues",
    )


# ------------------------------------------------------- versions of one key


def resolve_versions(
    ruled: DataFrame, keys: list[str], signature_of: list[str], hot_rows: int = HOT_ROWS, key_text: Column | None = None,
    sieve: bool = False,
) -> DataFrame:
    """Conflicts, duplicates and dispositions per business key.

    All versions of a key with differing content are rejected. Otherwise the
    first valid row stays and later valid rows are duplicates. Per-key facts
    come from one map-side combined aggregate, not from a window.
    """
    signed = ruled.selectExpr("*", *signature_columns(signature_of), f"{_ERRORS_SQL} AS _errors")
    stats = {
        "_min_a": F.min("_sig_a"), "_max_a": F.max("_sig_a"), "_min_b": F.min("_sig_b"), "_max_b": F.max("_sig_b"),
        "_first": F.expr("min(CASE WHEN size(_errors) = 0 THEN source_row_number END)"),
    }
    spread = ["source_row_number"]
    joined = annotate_keys(signed, keys, stats, spread, hot_rows=hot_rows, sieve=sieve)
    joined = joined.withColumn("_key_text", F.concat_ws("|", *keys) if key_text is None else key_text)
    joined = joined.selectExpr("*", "coalesce(_min_a <> _max_a OR _min_b <> _max_b, false) AS _conflict")
    flagged = joined.selectExpr(
        "*",
        "CASE WHEN size(_errors) > 0 OR _conflict THEN 'rejected' WHEN source_row_number > _first THEN 'duplicate' "
        "ELSE 'clean' END AS disposition",
    )
    note = lambda severity, rule: (
        f"array(named_struct('severity', '{severity}', 'rule', '{rule}', 'field', 'business_key', 'raw_value', _key_text))"
    )
    return flagged.selectExpr(
        *[f"`{c}`" for c in ruled.columns if c != "issues"],
        f"CASE WHEN _conflict THEN concat(issues, {note('ERROR', 'CONFLICTING_DUPLICATE')}) "
        f"WHEN disposition = 'duplicate' THEN concat(issues, {note('INFO', 'DUPLICATE_BUSINESS_KEY')}) ELSE issues END AS issues",
        "CASE WHEN disposition = 'duplicate' THEN 'DUPLICATE_BUSINESS_KEY' ELSE "
        "concat_ws('|', _errors, CASE WHEN _conflict THEN 'business_key:CONFLICTING_DUPLICATE' END) END AS reasons",
        "disposition",
    )


def analyze_sales(
    rows: DataFrame, lookup: DataFrame, unicode: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Whole quality job of the channel rows (E43/E44): rules, then versions.

    The ruled rows feed the per-key aggregate and the join back, so they are
    stored: every rule runs once per row, and each use reads its columns only.
    """
    ruled = stored(apply_sales_rules(rows, lookup, unicode, hot_rows, whole=True))
    content = [c for c in C.SALES_COLUMNS if c not in C.LINEAGE]
    key_text = F.concat_ws("|", channel_code_of("source"), F.col("order_id"), F.col("line_number").cast("string"))
    return resolve_versions(ruled, ["source", "order_id", "line_number"], content, hot_rows, key_text, sieve=True)


def analyze_products(rows: DataFrame, unicode: bool = True, hot_rows: int = HOT_ROWS) -> DataFrame:
    ruled = apply_product_rules(rows, unicode)
    return resolve_versions(ruled, ["sku"], list(C.PRODUCT_COLUMNS), hot_rows, F.col("sku"))


def channel_code_of(source) -> Column:
    """Channel code of a source key."""
    table = F.create_map(*[F.lit(x) for k, c in C.CHANNELS.items() for x in (k, c.code)])
    return table[F.col(source) if isinstance(source, str) else source]


# ---------------------------------------------------------------- evidence


@dataclass
class QualityResult:
    """Views over one annotated DataFrame (checkpoint it once to share the work)."""

    annotated: DataFrame
    raw: DataFrame

    def _is_product(self) -> bool:
        return "price" in self.annotated.columns

    @property
    def clean(self) -> DataFrame:
        columns = list(C.PRODUCT_COLUMNS + C.LINEAGE) if self._is_product() else list(C.SALES_COLUMNS)
        return self.annotated.where("disposition = 'clean'").select(*columns)

    def _evidence(self, disposition: str) -> DataFrame:
        key, line = ("sku", F.lit(None).cast("int")) if self._is_product() else ("order_id", F.col("line_number"))
        has_key = F.col(key).isNotNull() & (F.lit(True) if self._is_product() else F.col("line_number").isNotNull())
        return self.annotated.where(F.col("disposition") == disposition).select(
            *C.LINEAGE, F.when(has_key, F.col(key)).alias("business_key"),
            line.alias("source_line_number"), "reasons", "raw_payload",
        )

    @property
    def rejected(self) -> DataFrame:
        return self._evidence("rejected")

    @property
    def duplicates(self) -> DataFrame:
        return self._evidence("duplicate")

    @property
    def issues(self) -> DataFrame:
        return issue_rows(self.annotated)

    @property
    def summary(self) -> DataFrame:
        return quality_summary(self.annotated)

    @property
    def profile(self) -> DataFrame:
        columns = C.PRODUCT_COLUMNS if self._is_product() else C.CANONICAL_FIELDS
        return column_profile(self.raw, [c for c in columns if c in self.raw.columns])


def issue_rows(annotated: DataFrame) -> DataFrame:
    """One row per finding.

    The outer form keeps Spark from putting a filter on the size of ``issues`` before it, which evaluates all rules a second time.
    """
    return annotated.select(*C.LINEAGE, F.inline_outer("issues")).where("severity IS NOT NULL")


def quality_summary(annotated: DataFrame) -> DataFrame:
    """Counts per source; extracted = valid + duplicate + invalid by construction."""
    is_a = lambda d: F.count_if(F.col("disposition") == d)
    warnings = F.sum(F.size(F.filter("issues", lambda i: i["severity"] == "WARNING")))
    return annotated.groupBy("source").agg(
        F.count(F.lit(1)).alias("extracted_records"), is_a("clean").alias("valid_records"),
        is_a("duplicate").alias("duplicate_records"), is_a("rejected").alias("invalid_records"),
        warnings.alias("warning_count"),
    )


def column_profile(rows: DataFrame, columns: list[str], by: list[str] = [], unicode: bool = True) -> DataFrame:
    """Missing and distinct counts per column.

    One pass: values are unpivoted, combined map-side per (column, value), and
    counted per column; no Expand over several distinct aggregates.
    """
    cells = rows.select(*by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("_raw")) for c in columns])))
    cells = text.with_clean_text(cells, {"value": "_raw"}, unicode)
    per_value = cells.groupBy(*by, "column", "value").agg(F.count(F.lit(1)).alias("_n"))
    return per_value.groupBy(*by, "column").agg(
        F.lit("string").alias("raw_dtype"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("missing_count"),
        F.count("value").alias("distinct_nonmissing"),
    )


def issues_by_check(annotated: DataFrame, check: str | None = None) -> DataFrame:
    """Findings under display names, optionally of one check group."""
    found = issue_rows(annotated)
    if check is not None:
        found = found.where(F.col("rule").isin(*C.CHECK_GROUPS[check]))
    found = found.where(F.coalesce(F.lower("field") != "customer_id", F.lit(True)))
    return found.select(
        F.col("source").alias("sumber"), F.col("source_row_number").alias("baris"), F.col("severity").alias("tingkat"),
        F.col("field").alias("kolom"), F.col("rule").alias("masalah"), F.col("raw_value").alias("nilai_asli"),
    )


def issue_evidence(issues: DataFrame, rejected: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Findings with the raw payload of their row where it was set aside."""
    payloads = rejected.unionByName(duplicates).select("source", "source_row_number", "raw_payload")
    return issues.join(payloads, ["source", "source_row_number"], "left")


def missing_values(profile: DataFrame, total: int | Column | None = None) -> DataFrame:
    """Missing counts under display names, with the share when a row total is given."""
    out = profile.where(F.lower("column") != "customer_id").select(
        *(["source"] if "source" in profile.columns else []),
        F.col("column").alias("kolom"), F.col("missing_count").alias("jumlah_kosong"),
    )
    if total is None:
        return out
    total = F.lit(total) if isinstance(total, int) else total
    return out.withColumn("persentase", F.round(100.0 * F.col("jumlah_kosong") / F.nullif(total.cast("double"), F.lit(0.0)), 2))


# ------------------------------------------------------- clean presentation


def standard_sales(clean: DataFrame) -> DataFrame:
    """Clean sales in display columns."""
    labels = F.create_map(*[F.lit(x) for k, c in C.CHANNELS.items() for x in (k, c.label)])
    columns = {
        "product_id": F.col("sku"), "kategori": F.col("category"), "total_harga": F.col("gross_amount"),
        "tanggal_order": F.col("order_date"), "harga_satuan": F.col("unit_price"),
        "kota": F.when(F.col("source") == "offline", F.col("store_city")).otherwise(F.col("customer_city")),
        "channel": labels[F.col("source")], "status": F.initcap("status"),
    }
    return clean.select(*[columns.get(c, F.col(c)).alias(c) for c in C.CLEAN_SALES_COLUMNS])


def standard_products(clean: DataFrame) -> DataFrame:
    return clean.select(
        F.col("sku").alias("product_id"), "product_name", "brand", F.col("category").alias("kategori"),
        F.col("price").alias("harga_satuan"),
    )


_CLEAN_TYPES = {"line_number": "int", "quantity": "int", "tanggal_order": "date"}


def sales_contract_violations(data: DataFrame, statuses: bool = False) -> DataFrame:
    """Rows breaking the clean sales contract, counted per rule."""
    rules = {
        "null_order_id": F.col("order_id").isNull(),
        "null_product_id": F.col("product_id").isNull(),
        "null_line_number": F.col("line_number").isNull(),
        "line_number_not_positive": F.coalesce(F.col("line_number") <= 0, F.lit(False)),
    }
    if statuses:
        rules["unknown_status"] = ~F.upper(F.coalesce("status", F.lit(""))).isin(*C.SALE_STATUSES)
    counts = data.agg(*[F.count_if(test).alias(name) for name, test in rules.items()])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]))
    )


def validate_sales_contract(data: DataFrame) -> DataFrame:
    """Fail when an export drifts from its contract; returns the data otherwise."""
    if list(data.columns) != list(C.CLEAN_SALES_COLUMNS):
        raise ValueError(f"clean sales need the columns {list(C.CLEAN_SALES_COLUMNS)}, in this order")
    types = dict(data.dtypes)
    for column, wanted in _CLEAN_TYPES.items():
        if types[column] != wanted:
            raise TypeError(f"{column} must be {wanted}, found {types[column]}")
    broken = sales_contract_violations(data).where("violations > 0").collect()  # at most four rows
    if broken:
        raise ValueError("clean sales break rules: " + ", ".join(r["rule"] for r in broken))
    return data


def type_report(data: DataFrame) -> DataFrame:
    """Declared type and type of the non-null values per column, `kosong` without any."""
    types = dict(data.dtypes)
    held = data.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in types])
    each = [F.struct(F.lit(c).alias("kolom"), F.lit(t).alias("dtype"), F.when(F.col(f"`{c}`") > 0, t.split("(")[0]).otherwise("kosong").alias("tipe_nilai")) for c, t in types.items()]
    return held.select(F.inline(F.array(*each)))


# ------------------------------------------------------------ notebook views


def blank_to_null(data: DataFrame) -> DataFrame:
    """Blank text cells become null in every string column (C17)."""
    return data.select(
        *[
            (F.when(~F.col(c).rlike(r"^\s*\z"), F.col(c)) if t == "string" else F.col(c)).alias(c)
            for c, t in data.dtypes
        ]
    )


def rows_with_missing(data: DataFrame) -> DataFrame:
    """Rows holding any null."""
    return data.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in data.columns]))


def exact_duplicates(data: DataFrame) -> DataFrame:
    """All rows that occur more than once in every column (C16), whole, by map-side counting."""
    counted = data.groupBy(*data.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return _repeat(counted, data.columns)


def _repeat(counted: DataFrame, columns) -> DataFrame:
    """Each row ``_n`` times, in chunks so that one hot row does not build a huge array."""
    chunk = 10_000
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / chunk).cast("bigint"))
    split = counted.select("*", F.explode(chunks).alias("_chunk"))
    size = F.least(F.lit(chunk).cast("bigint"), F.col("_n") - F.col("_chunk") * chunk)
    split = split.withColumn("_size", size).repartition(F.xxhash64(*columns, "_chunk"))
    return split.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_size"))).alias("_copy")).drop("_copy")


def key_duplicates(data: DataFrame, keys: list[str], spread_on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """All members of a business key with several rows (E41); rows with a null key are left out."""
    marked = annotate_keys(data, keys, {}, spread_on, hot_rows=hot_rows)
    return marked.where("_n > 1").select(*data.columns)
