"""Registered queries of the quality job: scalar rules, findings, dispositions, return rules and caps."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom import contracts as C
from salesloom.functions import classify, dates, numbers, text
from salesloom.operators import audit, promotions, quality as Q, returns as R, warehouse
from salesloom.plans import testdata as T
from salesloom.plans.testdata import DIRTY_SQL, PRODUCTS_SQL, present
from salesloom.session import stored

QUERIES: dict = {}
MARKERS = "('', 'null', 'none', 'nan', 'n/a', 'na')"


def add(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (lambda spark, sf: present(fn(spark, sf)), sql)
        return fn

    return register


def clean(expression: str) -> str:
    flat = f"trim(regexp_replace({expression}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN lower({flat}) NOT IN {MARKERS} THEN {flat} END"


def key_of(cleaned: str) -> str:
    return f"regexp_replace(lower(coalesce({cleaned}, '')), '[\\s_\\-]+', '', 'g')"


def number_error(column: str, integer: bool = False) -> str:
    wide = f"TRY_CAST({column} AS DECIMAL(30, 8))"
    tail = f"WHEN {wide} <> floor({wide}) OR {wide} > 2147483647 THEN 'INVALID_INTEGER'" if integer else (
        f"WHEN {wide} > 999999999999.99 OR {wide} <> round({wide}, 2) THEN 'INVALID_MONEY_PRECISION_OR_RANGE'")
    return f"CASE WHEN {column} IS NULL THEN 'MISSING_REQUIRED' WHEN {wide} IS NULL THEN 'INVALID_NUMBER' WHEN {wide} <= 0 THEN 'NON_POSITIVE' {tail} END"


def known(column: str, members) -> str:
    cases = " ".join(f"WHEN '{Q.text._plain_key(m)}' THEN '{m}'" for m in members)
    return f"CASE {key_of(column)} {cases} END"


_FIELDS = ", ".join(f"{clean(f)} AS c_{f}" for f in C.CANONICAL_FIELDS)
CLEANED_SQL = f"cleaned AS (SELECT *, {_FIELDS} FROM dirty)"
PARSED_SQL = f"""parsed AS (
  SELECT *, CASE WHEN regexp_full_match(c_line_number, '[0-9]+') AND TRY_CAST(c_line_number AS INTEGER) > 0 THEN TRY_CAST(c_line_number AS INTEGER) END AS t_line,
    CAST(coalesce(CASE WHEN source = 'website' THEN TRY_STRPTIME(c_order_date, '%Y-%m-%dT%H:%M:%S') WHEN source = 'offline' THEN TRY_STRPTIME(c_order_date, '%d-%b-%Y')
      ELSE TRY_STRPTIME(c_order_date, '%d/%m/%Y') END, TRY_STRPTIME(c_order_date, '%Y-%m-%d')) AS DATE) AS t_date,
    {number_error('c_quantity', True)} AS e_quantity, {number_error('c_unit_price')} AS e_unit_price,
    CASE WHEN source = 'website' THEN {number_error('c_source_total_amount')} END AS e_total,
    CASE WHEN c_discount_amount IS NULL THEN NULL WHEN TRY_CAST(c_discount_amount AS DECIMAL(30, 8)) IS NULL THEN 'INVALID_NUMBER'
      WHEN TRY_CAST(c_discount_amount AS DECIMAL(30, 8)) < 0 THEN 'NEGATIVE_AMOUNT' END AS e_discount,
    upper(coalesce(c_status, '')) AS t_status, {key_of('c_product_input')} AS product_match FROM cleaned
)"""
TYPED_SQL = f"""product_map AS (
  SELECT DISTINCT unnest([{key_of('sku')}, {key_of('product_name')}]) AS product_match, sku, product_name, brand, category, price FROM products
),
valued AS (
  SELECT p.*, m.sku, m.product_name, m.brand, m.category, m.price AS master_price,
    CASE WHEN e_quantity IS NULL THEN CAST(TRY_CAST(c_quantity AS DECIMAL(30, 8)) AS INTEGER) END AS t_quantity,
    CASE WHEN e_unit_price IS NULL THEN TRY_CAST(c_unit_price AS DECIMAL(14, 2)) END AS t_price,
    CASE WHEN e_total IS NULL THEN TRY_CAST(c_source_total_amount AS DECIMAL(16, 2)) END AS t_total,
    CASE WHEN c_discount_amount IS NULL THEN 0 WHEN e_discount IS NULL THEN TRY_CAST(c_discount_amount AS DECIMAL(16, 2)) END AS t_discount
  FROM parsed p LEFT JOIN product_map m ON p.c_product_input IS NOT NULL AND m.product_match = p.product_match
),
typed AS (
  SELECT *, CAST(t_quantity * t_price AS DECIMAL(24, 2)) AS t_gross,
    CASE WHEN t_discount <= CAST(t_quantity * t_price AS DECIMAL(24, 2)) THEN CAST(t_quantity * t_price - t_discount AS DECIMAL(24, 2)) END AS t_net,
    upper(c_promo_code) AS t_promo,
    CASE WHEN regexp_full_match(c_customer_email, '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') THEN c_customer_email END AS t_email,
    coalesce({known('c_customer_city', C.CITIES)}, c_customer_city) AS t_city,
    coalesce({known('c_store_city', C.CITIES)}, c_store_city) AS t_store_city,
    {known('c_payment_method', C.PAYMENTS)} AS known_payment, coalesce({known('c_payment_method', C.PAYMENTS)}, c_payment_method) AS t_payment,
    CASE source WHEN 'shopee' THEN 'SHOPEE' WHEN 'tokopedia' THEN 'TOKOPEDIA' WHEN 'website' THEN 'WEBSITE' ELSE 'OFFLINE_STORE' END AS source_name
  FROM valued
)"""


def native(canonical: str) -> str:
    if canonical in C.OPTIONAL_FIELDS:
        return f"'{canonical}'"
    return "CASE source " + " ".join(f"WHEN '{k}' THEN '{c.fields[canonical]}'" for k, c in C.CHANNELS.items() if canonical in c.fields) + " END"


def _has(canonical: str) -> str:
    return "source IN (" + ", ".join(f"'{k}'" for k, c in C.CHANNELS.items() if canonical in c.fields) + ")"


# (severity, rule expression, canonical field, condition) in rule order
_RULES = [
    ("ERROR", "'INVALID_LINE_NUMBER'", "line_number", "t_line IS NULL"),
    ("ERROR", "'MISSING_REQUIRED'", "order_id", "c_order_id IS NULL"),
    ("ERROR", "CASE WHEN c_order_date IS NULL THEN 'MISSING_REQUIRED' ELSE 'INVALID_DATE' END", "order_date", "t_date IS NULL"),
    ("ERROR", "e_quantity", "quantity", "e_quantity IS NOT NULL"),
    ("ERROR", "e_unit_price", "unit_price", "e_unit_price IS NOT NULL"),
    ("ERROR", "CASE WHEN t_status = '' THEN 'MISSING_REQUIRED' ELSE 'INVALID_STATUS' END", "status", "t_status NOT IN ('COMPLETED', 'CANCELLED', 'RETURNED')"),
    ("ERROR", "'MISSING_REQUIRED'", "product_input", "c_product_input IS NULL"),
    ("ERROR", "'UNMAPPED_PRODUCT'", "product_input", "c_product_input IS NOT NULL AND sku IS NULL"),
    ("WARNING", "'PRICE_DIFFERS_FROM_MASTER'", "unit_price", "sku IS NOT NULL AND t_price <> master_price"),
    ("ERROR", "e_discount", "discount_amount", "e_discount IS NOT NULL"),
    ("ERROR", "'DISCOUNT_EXCEEDS_GROSS'", "discount_amount", "t_discount > t_gross"),
    ("ERROR", "e_total", "source_total_amount", "e_total IS NOT NULL"),
    ("ERROR", "'AMOUNT_MISMATCH'", "source_total_amount", "t_total IS NOT NULL AND t_gross IS NOT NULL AND t_total <> t_gross AND t_total IS DISTINCT FROM t_net"),
    *[("WARNING", "'MISSING_OPTIONAL'", f, f"{_has(f)} AND c_{f} IS NULL") for f in C.OPTIONAL_WARNED_FIELDS],
    ("WARNING", "'UNKNOWN_PAYMENT'", "payment_method", "c_payment_method IS NOT NULL AND known_payment IS NULL"),
    ("WARNING", "'INVALID_EMAIL'", "customer_email", "c_customer_email IS NOT NULL AND t_email IS NULL"),
]
ISSUES_SQL = "rule_issues AS (" + " UNION ALL ".join(
    f"SELECT source, source_row_number, {i} AS ord, '{severity}' AS severity, {rule} AS rule, {native(field)} AS field, {field} AS raw_value FROM typed WHERE {test}"
    for i, (severity, rule, field, test) in enumerate(_RULES)
) + ")"
_CONTENT = ("c_order_id, t_line, t_date, sku, product_name, brand, category, t_quantity, t_price, t_gross, t_discount, t_net, t_promo, "
            "t_total, c_customer_name, t_email, t_city, c_store_name, t_store_city, t_payment, t_status")
FINAL_SQL = f"""row_errors AS (
  SELECT source, source_row_number, string_agg(field || ':' || rule, '|' ORDER BY ord) AS errors
  FROM rule_issues WHERE severity = 'ERROR' GROUP BY 1, 2
),
joined AS (SELECT t.*, e.errors FROM typed t LEFT JOIN row_errors e USING (source, source_row_number)),
key_stats AS (
  SELECT source, c_order_id, t_line, count(DISTINCT to_json([CAST(x AS VARCHAR) FOR x IN [{', '.join(f'CAST({c.strip()} AS VARCHAR)' for c in _CONTENT.split(','))}]])) AS versions,
    min(source_row_number) FILTER (WHERE errors IS NULL) AS first_row
  FROM joined WHERE c_order_id IS NOT NULL AND t_line IS NOT NULL GROUP BY 1, 2, 3
),
final AS (
  SELECT j.*, coalesce(versions > 1, false) AS conflict,
    CASE WHEN errors IS NOT NULL OR coalesce(versions > 1, false) THEN 'rejected' WHEN j.source_row_number > first_row THEN 'duplicate' ELSE 'clean' END AS disposition,
    CASE WHEN errors IS NOT NULL OR coalesce(versions > 1, false)
      THEN concat_ws('|', errors, CASE WHEN versions > 1 THEN 'business_key:CONFLICTING_DUPLICATE' END)
      WHEN j.source_row_number > first_row THEN 'DUPLICATE_BUSINESS_KEY' ELSE '' END AS reasons,
    source_name || '|' || j.c_order_id || '|' || j.t_line AS key_text
  FROM joined j LEFT JOIN key_stats k ON k.source = j.source AND k.c_order_id = j.c_order_id AND k.t_line = j.t_line
),
issues AS (
  SELECT source, source_row_number, severity, rule, field, raw_value FROM rule_issues
  UNION ALL SELECT source, source_row_number, 'ERROR', 'CONFLICTING_DUPLICATE', 'business_key', key_text FROM final WHERE conflict
  UNION ALL SELECT source, source_row_number, 'INFO', 'DUPLICATE_BUSINESS_KEY', 'business_key', key_text FROM final WHERE disposition = 'duplicate'
)"""
TYPED_CTE = f"WITH {DIRTY_SQL},{PRODUCTS_SQL},{CLEANED_SQL},{PARSED_SQL},{TYPED_SQL}"
ISSUE_CTE = f"{TYPED_CTE},{ISSUES_SQL}"
FULL_CTE = f"{ISSUE_CTE},{FINAL_SQL}"


# ------------------------------------------------------------ Spark side


def lookup(spark, sf):
    return Q.product_lookup(T.products(spark, sf))


def ruled(spark, sf):
    return Q.apply_sales_rules(T.dirty(spark, sf), lookup(spark, sf))


def found_issues(spark, sf):
    """Findings of all row rules, for which every cell but the payload is read."""
    return Q.issue_rows(Q.apply_sales_rules(T.dirty(spark, sf).drop("raw_payload"), lookup(spark, sf), whole=True))


def analyzed(spark, sf, payload=False):
    """Judged rows, without their payloads unless they are asked for."""
    rows = T.dirty(spark, sf)
    return Q.analyze_sales(rows if payload else rows.drop("raw_payload"), lookup(spark, sf))


ROW = ["source", "source_row_number"]
ISSUE = ["source", "source_row_number", "severity", "rule", "field", "raw_value"]
_ISSUE_SELECT = "source, source_row_number, severity, rule, field, raw_value"


def _rule(name: str, *rules: str, fields: tuple = ()) -> None:
    chosen = ", ".join(f"'{r}'" for r in rules)
    where = f"rule IN ({chosen})" + (" AND field IN (" + ", ".join(f"'{f}'" for f in fields) + ")" if fields else "")
    add(name, f"{ISSUE_CTE} SELECT {_ISSUE_SELECT} FROM rule_issues WHERE {where}")(
        lambda spark, sf: found_issues(spark, sf).where(where).select(*ISSUE))


_rule("e1_missing_required", "MISSING_REQUIRED")
_rule("e2_missing_optional", "MISSING_OPTIONAL")
_rule("e3_invalid_line_number", "INVALID_LINE_NUMBER")
_rule("e4_invalid_date", "INVALID_DATE")
_rule("e5_invalid_numbers", "INVALID_NUMBER", "NON_POSITIVE", "INVALID_INTEGER", "INVALID_MONEY_PRECISION_OR_RANGE")
_rule("e6_invalid_status", "INVALID_STATUS")
_rule("e7_unmapped_product", "UNMAPPED_PRODUCT")
_rule("e8_price_differs", "PRICE_DIFFERS_FROM_MASTER")
_rule("e9_discount_errors", "NEGATIVE_AMOUNT", "INVALID_NUMBER", fields=("discount_amount",))
_rule("e10_discount_exceeds_gross", "DISCOUNT_EXCEEDS_GROSS")
_rule("e11_amount_mismatch", "AMOUNT_MISMATCH")
_rule("e12_unknown_payment", "UNKNOWN_PAYMENT")
_rule("e13_invalid_email", "INVALID_EMAIL")
_final = lambda name, columns, where, fn: add(name, f"{FULL_CTE} SELECT {columns} FROM final{where}")(fn)
_final("e14_conflicts", "source, source_row_number, key_text", " WHERE conflict",
       lambda spark, sf: Q.issue_rows(analyzed(spark, sf)).where("rule = 'CONFLICTING_DUPLICATE'").select(*ROW, F.col("raw_value").alias("key_text")))
_final("e15_duplicates", "source, source_row_number, key_text", " WHERE disposition = 'duplicate'",
       lambda spark, sf: Q.issue_rows(analyzed(spark, sf)).where("rule = 'DUPLICATE_BUSINESS_KEY'").select(*ROW, F.col("raw_value").alias("key_text")))
_final("e16_dispositions", "source, source_row_number, disposition, reasons", "",
       lambda spark, sf: analyzed(spark, sf).select(*ROW, "disposition", "reasons"))
_final("h1_first_valid", "source, source_row_number", " WHERE disposition = 'clean'",
       lambda spark, sf: analyzed(spark, sf).where("disposition = 'clean'").select(*ROW))
add("h2_key_versions", f"{FULL_CTE} SELECT conflict AS has_conflict, count(*) AS rows FROM final GROUP BY 1")(
    lambda spark, sf: analyzed(spark, sf).groupBy(F.exists("issues", lambda i: i["rule"] == "CONFLICTING_DUPLICATE").alias("has_conflict")).agg(F.count(F.lit(1)).alias("rows")))
_SALES_OUT = {
    "order_id": "c_order_id", "line_number": "t_line", "order_date": "strftime(t_date, '%Y-%m-%d')", "sku": "sku", "quantity": "t_quantity",
    "unit_price": "CAST(t_price AS DOUBLE)", "gross_amount": "CAST(t_gross AS DOUBLE)", "discount_amount": "CAST(t_discount AS DOUBLE)",
    "net_amount": "CAST(t_net AS DOUBLE)", "promo_code": "t_promo", "source_total_amount": "CAST(t_total AS DOUBLE)", "customer_name": "c_customer_name",
    "customer_email": "t_email", "customer_city": "t_city", "store_name": "c_store_name", "store_city": "t_store_city", "payment_method": "t_payment", "status": "t_status",
}
_final("e43_clean_sales", "source, source_row_number, " + ", ".join(f"{v} AS {k}" for k, v in _SALES_OUT.items()), " WHERE disposition = 'clean'",
       lambda spark, sf: analyzed(spark, sf).where("disposition = 'clean'").select(*ROW, *_SALES_OUT))
_SUMMARY = ("SELECT source, count(*) AS extracted_records, count(*) FILTER (WHERE disposition = 'clean') AS valid_records, "
            "count(*) FILTER (WHERE disposition = 'duplicate') AS duplicate_records, count(*) FILTER (WHERE disposition = 'rejected') AS invalid_records")
add("e44_summary", f"{FULL_CTE} {_SUMMARY}, (SELECT count(*) FROM issues i WHERE i.source = final.source AND severity = 'WARNING') AS warning_count FROM final GROUP BY source")(
    lambda spark, sf: Q.quality_summary(analyzed(spark, sf)))
add("e45_single_source", f"{FULL_CTE} {_SUMMARY} FROM final WHERE source = 'website' GROUP BY source")(
    lambda spark, sf: Q.quality_summary(Q.analyze_sales(T.dirty(spark, sf).where("source = 'website'"), lookup(spark, sf))).drop("warning_count"))
add("g39_disposition_counts", f"{FULL_CTE} SELECT source, disposition, count(*) AS rows FROM final GROUP BY 1, 2")(
    lambda spark, sf: analyzed(spark, sf).groupBy("source", "disposition").agg(F.count(F.lit(1)).alias("rows")))

# cleaning, mapping, projections
_CLEAN_DISPLAY = """c_order_id AS order_id, t_line AS line_number, sku AS product_id, product_name, category AS kategori, t_quantity AS quantity,
  CAST(t_gross AS DOUBLE) AS total_harga, strftime(t_date, '%Y-%m-%d') AS tanggal_order, CASE WHEN source = 'offline' THEN t_store_city ELSE t_city END AS kota,
  CASE source WHEN 'shopee' THEN 'Shopee' WHEN 'tokopedia' THEN 'Tokopedia' WHEN 'website' THEN 'Website' ELSE 'Offline Store' END AS channel,
  upper(left(t_status, 1)) || lower(substr(t_status, 2)) AS status, t_email AS customer_email, CAST(t_price AS DOUBLE) AS harga_satuan,
  CAST(t_discount AS DOUBLE) AS discount_amount, CAST(t_net AS DOUBLE) AS net_amount, t_promo AS promo_code"""
_final("c5_clean_sales_display", _CLEAN_DISPLAY, " WHERE disposition = 'clean'",
       lambda spark, sf: Q.standard_sales(Q.QualityResult(analyzed(spark, sf), T.dirty(spark, sf)).clean))
add("c5_clean_products_display", f"WITH {PRODUCTS_SQL} SELECT sku AS product_id, product_name, brand, category AS kategori, CAST(price AS DOUBLE) AS harga_satuan FROM products")(
    lambda spark, sf: Q.standard_products(T.products(spark, sf)))
_NK = ("CASE WHEN coalesce(t_email, '') <> '' THEN source_name || ':EMAIL:' || t_email WHEN coalesce(c_customer_name, '') <> '' "
       "THEN source_name || ':NAME:' || c_customer_name || ':' || coalesce(t_city, '') END")
_STAGE = (f"source_name, source_row_number, c_order_id AS source_order_id, t_line AS source_line_number, strftime(t_date, '%Y-%m-%d') AS order_date, sku AS mapped_sku, {_NK} AS customer_nk, "
          "CASE WHEN source = 'offline' THEN t_store_city ELSE t_city END AS city, t_payment AS payment_method, t_status AS sale_status, t_quantity AS quantity, CAST(t_net AS DOUBLE) AS net_amount")
STAGE_COLUMNS = ["source_name", "source_row_number", "source_order_id", "source_line_number", "order_date", "mapped_sku", "customer_nk", "city", "payment_method", "sale_status", "quantity", "net_amount"]


def staged(spark, sf):
    return warehouse.to_staging(Q.QualityResult(analyzed(spark, sf), T.dirty(spark, sf)).clean)


_final("c2_staging_rows", _STAGE, " WHERE disposition = 'clean'", lambda spark, sf: staged(spark, sf).select(*STAGE_COLUMNS))
_final("c3_city_choice", "source_name, source_row_number, CASE WHEN source = 'offline' THEN t_store_city ELSE t_city END AS city", " WHERE disposition = 'clean'",
       lambda spark, sf: staged(spark, sf).select("source_name", "source_row_number", "city"))
_final("c4_customer_keys", f"source_name, source_row_number, {_NK} AS customer_nk", " WHERE disposition = 'clean'",
       lambda spark, sf: staged(spark, sf).select("source_name", "source_row_number", "customer_nk"))
add("f2_product_mapping", f"{TYPED_CTE} SELECT source, source_row_number, sku, brand FROM typed")(lambda spark, sf: ruled(spark, sf).select(*ROW, "sku", "brand"))
add("f2_ambiguous_products", f"""SELECT product_match, min(sku) AS first_sku, max(sku) AS last_sku FROM (SELECT DISTINCT unnest([{key_of("'SKU-' || p_partkey")}, {key_of('p_name')}]) AS product_match,
  'SKU-' || p_partkey AS sku FROM part) GROUP BY 1 HAVING min(sku) <> max(sku)""")(
    lambda spark, sf: Q.ambiguous_product_keys(T.products(spark, sf).withColumn("product_name", F.regexp_replace("product_name", r" \d+$", ""))))
add("c19_selected_rows", f"{FULL_CTE} {_SUMMARY}, (SELECT count(*) FROM issues i JOIN dirty d USING (source, source_row_number) WHERE i.source = final.source AND severity = 'WARNING' AND d.copy = 0) AS warning_count FROM final WHERE copy = 0 GROUP BY source")(
    lambda spark, sf: audit.scoped_counts(analyzed(spark, sf), T.dirty(spark, sf).where("floor(source_row_number / 64) % 2 = 0").select(*ROW)))
QUERIES["g33_scoped_counts"] = QUERIES["c19_selected_rows"]
for _check, _members in C.CHECK_GROUPS.items():
    _in = ", ".join(f"'{m}'" for m in _members)
    add(f"c18_issues_{_check}", f"{FULL_CTE} SELECT source AS sumber, source_row_number AS baris, severity AS tingkat, field AS kolom, rule AS masalah, raw_value AS nilai_asli FROM issues WHERE rule IN ({_in})")(
        lambda spark, sf, _check=_check: Q.issues_by_check(analyzed(spark, sf), _check))
add("f17_issue_evidence", f"{FULL_CTE} SELECT i.source, i.source_row_number, i.rule, i.field, f.disposition IS NOT NULL AS has_payload FROM issues i LEFT JOIN (SELECT * FROM final WHERE disposition <> 'clean') f USING (source, source_row_number)")(
    lambda spark, sf: _evidence(spark, sf))


def _evidence(spark, sf):
    result = Q.QualityResult(analyzed(spark, sf, payload=True), T.dirty(spark, sf))
    joined = Q.issue_evidence(result.issues, result.rejected, result.duplicates)
    return joined.select("source", "source_row_number", "rule", "field", F.col("raw_payload").isNotNull().alias("has_payload"))


# scalar functions


def cells(spark, sf, *columns):
    """Cleaned cells of the dirty rows."""
    return text.with_clean_text(T.dirty(spark, sf).select(*ROW, *columns), {c: c for c in columns})


_cells = "SELECT source, source_row_number, "
add("d1_clean_text", f"WITH {DIRTY_SQL},{CLEANED_SQL} {_cells} c_product_input AS product, c_customer_city AS city, c_status AS status FROM cleaned")(
    lambda spark, sf: T.dirty(spark, sf).select(*ROW, text.clean_text("product_input").alias("product"), text.clean_text("customer_city").alias("city"), text.clean_text("status").alias("status")))
_composed = "trim(regexp_replace(nfc_normalize(text), '[\\s\\x1c-\\x1f\\x{85}\\p{Z}]+', ' ', 'g'))"  # the texts hold no compatibility character
_document = f"CASE WHEN lower({_composed}) NOT IN {MARKERS} THEN {_composed} END"
add("d1_clean_documents", f"SELECT doc_id, length({_document}) AS chars, md5({_document}) AS digest FROM documents")(
    lambda spark, sf: T.table(spark, sf, "documents").select("doc_id", F.length(text.clean_text("text")).cast("bigint").alias("chars"), F.md5(text.clean_text("text")).alias("digest")))
add("d2_match_keys", f"WITH {DIRTY_SQL},{CLEANED_SQL} {_cells} {key_of('c_product_input')} AS product_key, {key_of('c_payment_method')} AS payment_key FROM cleaned")(
    lambda spark, sf: T.dirty(spark, sf).select(*ROW, text.match_key("product_input").alias("product_key"), text.match_key("payment_method").alias("payment_key")))
add("d3_numbers", f"{TYPED_CTE} {_cells} t_quantity AS quantity, e_quantity AS quantity_error, CAST(t_price AS DOUBLE) AS price, e_unit_price AS price_error FROM typed")(
    lambda spark, sf: cells(spark, sf, "quantity", "unit_price").select(*ROW, numbers.positive_integer("quantity").alias("q"), numbers.positive_money("unit_price").alias("p"))
    .select(*ROW, numbers.accepted("q").alias("quantity"), F.col("q.error").alias("quantity_error"), numbers.accepted("p").alias("price"), F.col("p.error").alias("price_error")))
add("d4_nonnegative_money", f"{TYPED_CTE} {_cells} CAST(t_discount AS DOUBLE) AS discount, e_discount AS discount_error FROM typed")(
    lambda spark, sf: cells(spark, sf, "discount_amount").select(*ROW, numbers.nonnegative_money("discount_amount").alias("d"))
    .select(*ROW, numbers.accepted("d").alias("discount"), F.col("d.error").alias("discount_error")))
add("d5_dates", f"{TYPED_CTE} {_cells} strftime(t_date, '%Y-%m-%d') AS order_date, CASE WHEN c_order_date IS NULL THEN 'MISSING_REQUIRED' WHEN t_date IS NULL THEN 'INVALID_DATE' END AS date_error FROM typed")(
    lambda spark, sf: cells(spark, sf, "order_date").select(*ROW, "order_date", dates.parse_date("order_date", "source").alias("d"))
    .select(*ROW, F.col("d").alias("order_date"), dates.date_error("order_date", "d").alias("date_error")))
add("d6_line_numbers", f"{TYPED_CTE} {_cells} t_line AS line FROM typed")(
    lambda spark, sf: T.dirty(spark, sf).select(*ROW, numbers.line_number(text.unmarked_sql(text.tidy_sql("line_number"))).alias("line")))
add("d8_cities", f"{TYPED_CTE} {_cells} t_city AS city, t_store_city AS store_city FROM typed")(
    lambda spark, sf: cells(spark, sf, "customer_city", "store_city").select(*ROW, text.canonical_city("customer_city").alias("city"), text.canonical_city("store_city").alias("store_city")))
add("d9_payments", f"{TYPED_CTE} {_cells} t_payment AS payment, c_payment_method IS NOT NULL AND known_payment IS NULL AS is_unknown FROM typed")(
    lambda spark, sf: _payments(spark, sf))


def _payments(spark, sf):
    cleaned = T.dirty(spark, sf).withColumn("c", text.clean_text("payment_method"))
    payment, unknown = text.canonical_payment("c")
    return cleaned.select(*ROW, payment.alias("payment"), unknown.alias("is_unknown"))


add("d10_emails", f"{TYPED_CTE} {_cells} t_email AS email FROM typed")(
    lambda spark, sf: ruled(spark, sf).select(*ROW, F.col("customer_email").alias("email")))
add("d16_calendar", """SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, strftime(d, '%Y-%m-%d') AS full_date, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(month(d) AS INTEGER) AS month_number, strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number, CAST(year(d) AS INTEGER) AS year_number,
  strftime(d, '%A') AS day_name, isodow(d) >= 6 AS is_weekend FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""")(
    lambda spark, sf: warehouse.calendar(T.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))))
_CATEGORY = """CASE WHEN rule IN ('MISSING_REQUIRED', 'MISSING_OPTIONAL') THEN 'missing_value' WHEN rule IN ('DUPLICATE_BUSINESS_KEY', 'CONFLICTING_DUPLICATE') THEN '{dup}'
  WHEN rule = 'INVALID_DATE' THEN 'invalid_date' WHEN rule = 'INVALID_STATUS' THEN 'invalid_status' WHEN rule = 'UNMAPPED_PRODUCT' THEN 'unmapped_product'
  WHEN field IN ('qty', 'quantity', 'units') THEN 'invalid_quantity' WHEN field IN ({price}) THEN '{amount}' ELSE '{other}' END"""
CATEGORY_SQL = _CATEGORY.format(dup="duplicate", price="'price', 'unit_price', 'item_price', 'total_amount'", amount="invalid_price_or_amount", other="other")
SECTION_SQL = _CATEGORY.format(dup="duplicate_business_key", price="'price', 'unit_price', 'item_price', 'total_amount', 'discount_amount'", amount="invalid_price", other="type_cast_failure")
add("d19_audit_categories", f"{FULL_CTE} SELECT rule, field, {CATEGORY_SQL} AS category, count(*) AS findings FROM issues GROUP BY 1, 2, 3")(
    lambda spark, sf: Q.issue_rows(analyzed(spark, sf)).groupBy("rule", "field", classify.audit_category(F.col("rule"), F.col("field")).alias("category")).agg(F.count(F.lit(1)).alias("findings")))
add("d20_report_sections", f"{FULL_CTE} SELECT rule, field, {SECTION_SQL} AS section, count(*) AS findings FROM issues GROUP BY 1, 2, 3")(
    lambda spark, sf: Q.issue_rows(analyzed(spark, sf)).groupBy("rule", "field", classify.report_section(F.col("rule"), F.col("field")).alias("section")).agg(F.count(F.lit(1)).alias("findings")))
_NAMED = f"{FULL_CTE}, named AS (SELECT CASE source WHEN 'offline' THEN 'OFFLINE_STORE' ELSE upper(source) END AS source_name, * EXCLUDE (source) FROM issues)"
add("g27_rule_counts", f"{_NAMED} SELECT source_name, rule AS rule_name, severity, field, {CATEGORY_SQL} AS category, count(*) AS failed_records FROM named GROUP BY 1, 2, 3, 4, 5")(
    lambda spark, sf: audit.rule_counts(Q.issue_rows(analyzed(spark, sf))))
add("g31_section_counts", f"{_NAMED}, s AS (SELECT source_name, {SECTION_SQL} AS section, field, count(*) AS findings FROM named GROUP BY 1, 2, 3) SELECT * FROM s UNION ALL SELECT 'ALL', section, field, CAST(sum(findings) AS BIGINT) FROM s GROUP BY 2, 3")(
    lambda spark, sf: audit.section_counts(Q.issue_rows(analyzed(spark, sf))))
_final("b17_rejected_rows", "source_name, CASE WHEN t_line IS NOT NULL THEN c_order_id END AS source_order_id, t_line AS source_line_number, source_row_number, reasons AS rejection_reason", " WHERE disposition = 'rejected'",
       lambda spark, sf: audit.rejected_audit(Q.QualityResult(analyzed(spark, sf, payload=True), T.dirty(spark, sf)).rejected).drop("source_payload"))

# profiles and notebook checks
_PROFILE = " UNION ALL ".join(
    f"SELECT source, '{f}' AS \"column\", 'string' AS raw_dtype, count(*) - count(c_{f}) AS missing_count, count(DISTINCT c_{f}) AS distinct_nonmissing FROM cleaned GROUP BY source" for f in C.CANONICAL_FIELDS)
add("e38_column_profile", f"WITH {DIRTY_SQL},{CLEANED_SQL} {_PROFILE}")(lambda spark, sf: Q.column_profile(T.dirty(spark, sf), list(C.CANONICAL_FIELDS), ["source"]))
add("e39_missing_values", f"WITH {DIRTY_SQL},{CLEANED_SQL}, p AS ({_PROFILE}), n AS (SELECT source, count(*) AS total FROM dirty GROUP BY 1) SELECT source, \"column\" AS kolom, missing_count AS jumlah_kosong, round(100.0 * missing_count / total, 2) AS persentase FROM p JOIN n USING (source)")(
    lambda spark, sf: _missing(spark, sf))


def _missing(spark, sf):
    rows = T.dirty(spark, sf)
    total = rows.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    profile = Q.column_profile(rows, list(C.CANONICAL_FIELDS), ["source"]).join(F.broadcast(total), "source")  # one row per channel
    return Q.missing_values(profile.select("source", "column", "missing_count")).join(F.broadcast(total), "source").select(
        "source", "kolom", "jumlah_kosong", F.round(100.0 * F.col("jumlah_kosong") / F.col("total"), 2).alias("persentase"))


TYPED = {"o_orderkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_late_status": "string"}
_LATE = "CASE WHEN o_totalprice < 0 THEN o_orderstatus END AS o_late_status"
_TYPED_SQL = " UNION ALL ".join(f"SELECT '{c}' AS kolom, '{t}' AS dtype, CASE WHEN count({c}) > 0 THEN '{t}' ELSE 'kosong' END AS tipe_nilai FROM o" for c, t in TYPED.items())
add("e40_type_report", f"WITH o AS (SELECT *, {_LATE} FROM orders) {_TYPED_SQL}")(
    lambda spark, sf: Q.type_report(T.table(spark, sf, "orders").selectExpr("*", _LATE).selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in TYPED.items()])))
add("e36_contract_violations", f"{FULL_CTE} SELECT unnest(['null_order_id', 'null_product_id', 'null_line_number', 'line_number_not_positive']) AS rule, unnest([count(*) FILTER (WHERE c_order_id IS NULL), count(*) FILTER (WHERE sku IS NULL), count(*) FILTER (WHERE t_line IS NULL), 0]) AS violations FROM final")(
    lambda spark, sf: Q.sales_contract_violations(Q.standard_sales(analyzed(spark, sf).select(*C.SALES_COLUMNS))))
add("e37_file_contract", f"{FULL_CTE} SELECT unnest(['null_order_id', 'null_product_id', 'null_line_number', 'line_number_not_positive', 'unknown_status']) AS rule, unnest([count(*) FILTER (WHERE c_order_id IS NULL), count(*) FILTER (WHERE sku IS NULL), count(*) FILTER (WHERE t_line IS NULL), 0, count(*) FILTER (WHERE t_status NOT IN ('COMPLETED', 'CANCELLED', 'RETURNED'))]) AS violations FROM final")(
    lambda spark, sf: Q.sales_contract_violations(Q.standard_sales(analyzed(spark, sf).select(*C.SALES_COLUMNS)), statuses=True))
add("e41_key_duplicates", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1")(
    lambda spark, sf: Q.key_duplicates(T.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
add("c16_exact_duplicates", "SELECT l_returnflag, l_linestatus, l_discount, l_tax, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_returnflag, l_linestatus, l_discount, l_tax, l_quantity) > 1")(
    lambda spark, sf: Q.exact_duplicates(T.table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity")))
_BLANKED = ", ".join(f"CASE WHEN NOT regexp_full_match({c}, '\\s*') THEN {c} END AS {c}" for c in ("order_id", "quantity", "customer_name", "status"))
add("c17_blank_to_null", f"WITH {DIRTY_SQL} SELECT source, source_row_number, {_BLANKED} FROM dirty")(
    lambda spark, sf: Q.blank_to_null(T.dirty(spark, sf).select(*ROW, "order_id", "quantity", "customer_name", "status")))
add("c16_missing_rows", f"WITH {DIRTY_SQL}, b AS (SELECT source, source_row_number, {_BLANKED} FROM dirty) SELECT * FROM b WHERE order_id IS NULL OR quantity IS NULL OR customer_name IS NULL OR status IS NULL")(
    lambda spark, sf: Q.rows_with_missing(Q.blank_to_null(T.dirty(spark, sf).select(*ROW, "order_id", "quantity", "customer_name", "status"))))
add("g41_products_per_category", "SELECT p_type AS category, count(*) AS products FROM part GROUP BY 1")(
    lambda spark, sf: T.table(spark, sf, "part").groupBy(F.col("p_type").alias("category")).agg(F.count(F.lit(1)).alias("products")).orderBy(F.desc("products"), "category"))
add("g43_rows_per_source", f"WITH {DIRTY_SQL} SELECT source, count(*) AS rows, {len(C.CANONICAL_FIELDS)} AS columns FROM dirty GROUP BY 1")(
    lambda spark, sf: T.dirty(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.lit(len(C.CANONICAL_FIELDS)).alias("columns")))

# ------------------------------------------------- promotion master

_MASTER_SQL = """raw AS (SELECT p_partkey + 1 AS source_row_number, 'code' || p_partkey % 400 AS promo_code, CASE WHEN p_partkey % 50 = 1 THEN '' ELSE 'Promo ' || p_partkey % 400 END AS promo_name,
  CASE WHEN p_partkey % 50 = 2 THEN 'gift' WHEN p_partkey % 2 = 0 THEN 'Percentage' ELSE 'fixed' END AS discount_type,
  CASE WHEN p_partkey % 50 = 3 THEN '0' WHEN p_partkey % 50 = 4 THEN '150' WHEN p_partkey % 50 = 5 THEN '1.234' ELSE CAST(5 + p_partkey % 400 // 5 AS VARCHAR) END AS discount_value,
  CASE WHEN p_partkey % 50 = 6 THEN '2026-13-01' ELSE '2026-01-01' END AS start_date,
  CASE WHEN p_partkey % 50 = 7 THEN '2025-01-01' WHEN p_partkey >= 1200 THEN '2026-12-31' ELSE '31/12/2026' END AS end_date,
  CASE WHEN p_partkey % 50 = 8 THEN 'gone' WHEN p_partkey % 3 = 0 AND p_partkey >= 1600 THEN 'PAUSED' ELSE 'active' END AS status FROM part),
ruled AS (SELECT *, CASE WHEN promo_name = '' OR discount_type = 'gift' THEN 'code_name_or_type' WHEN status = 'gone' THEN 'status'
   WHEN start_date = '2026-13-01' OR end_date = '2025-01-01' THEN 'date_range' WHEN discount_value IN ('0', '1.234') THEN 'discount_value'
   WHEN discount_type = 'Percentage' AND CAST(discount_value AS DECIMAL(16,2)) > 100 THEN 'percentage' END AS reason FROM raw),
stats AS (SELECT promo_code, count(DISTINCT promo_name || '|' || lower(discount_type) || '|' || discount_value || '|' || lower(status)) AS versions, min(source_row_number) AS first_row FROM ruled WHERE reason IS NULL GROUP BY 1),
checked AS (SELECT r.source_row_number, upper(r.promo_code) AS promo_code, CASE WHEN r.reason IS NOT NULL THEN r.reason WHEN versions > 1 THEN 'conflicting_code' END AS reason,
  r.reason IS NULL AND first_row = r.source_row_number AS is_first FROM ruled r LEFT JOIN stats USING (promo_code))"""


def promo_rows(spark, sf):
    p, k = F.col("p_partkey"), F.col("p_partkey") % 50
    code = (p % 400).cast("string")
    return T.table(spark, sf, "part").select(
        (p + 1).alias("source_row_number"), F.concat(F.lit("code"), code).alias("promo_code"),
        F.when(k == 1, "").otherwise(F.concat(F.lit("Promo "), code)).alias("promo_name"),
        F.when(k == 2, "gift").when(p % 2 == 0, "Percentage").otherwise("fixed").alias("discount_type"),
        F.when(k == 3, "0").when(k == 4, "150").when(k == 5, "1.234").otherwise((5 + F.floor((p % 400) / 5)).cast("string")).alias("discount_value"),
        F.when(k == 6, "2026-13-01").otherwise("2026-01-01").alias("start_date"),
        F.when(k == 7, "2025-01-01").when(p >= 1200, "2026-12-31").otherwise("31/12/2026").alias("end_date"),
        F.when(k == 8, "gone").when((p % 3 == 0) & (p >= 1600), "PAUSED").otherwise("active").alias("status"),
    )


def catalogue_rows(spark, sf):
    return promotions.read_catalogue(promo_rows(spark, sf))


add("e28_promo_master_rules", f"WITH {_MASTER_SQL} SELECT source_row_number, promo_code, reason FROM checked WHERE reason IS NOT NULL AND reason <> 'conflicting_code'")(
    lambda spark, sf: catalogue_rows(spark, sf).where("reason <> 'conflicting_code'").select("source_row_number", "promo_code", "reason"))
add("e29_promo_master_versions", f"WITH {_MASTER_SQL} SELECT source_row_number, promo_code, coalesce(reason, '') AS reason, is_first FROM checked WHERE reason IS NULL OR reason = 'conflicting_code'")(
    lambda spark, sf: catalogue_rows(spark, sf).where("reason IS NULL OR reason = 'conflicting_code'").select("source_row_number", "promo_code", F.coalesce("reason", F.lit("")).alias("reason"), "is_first"))
add("e35_promo_metrics", f"WITH {_MASTER_SQL},{T.LINES_SQL},{T.PROMOTIONS_SQL}" + """, c AS (SELECT s.promo_code, p.promo_code IS NOT NULL AND order_date BETWEEN start_date AND end_date AND status = 'active' AND discount_amount <= gross_amount AS ok
  FROM sales s LEFT JOIN promotions p ON p.promo_code = s.promo_code)
SELECT count(*) AS catalog_checked, count(*) FILTER (WHERE reason IS NULL AND is_first) AS catalog_validated, count(*) FILTER (WHERE reason IS NULL AND NOT is_first) AS catalog_duplicates,
 (SELECT count(promo_code) FROM c) AS promo_codes_checked, (SELECT count(*) FROM c WHERE promo_code IS NOT NULL AND ok) AS promo_codes_matched FROM checked""")(
    lambda spark, sf: promotions.promotion_metrics(catalogue_rows(spark, sf), _checked_sales(spark, sf)))


def _checked_sales(spark, sf):
    from salesloom.plans.sales_queries import _promo_lines

    return promotions.check_line_promotions(_promo_lines(spark, sf), T.promotions(spark, sf))


# --------------------------------------------------------- return rows, caps

# Return files: up to three events per sale line, damaged on fixed residues.
_R = C.RETURN_REASONS
RETURN_ROWS_SQL = """raw_returns AS (
  SELECT (l_orderkey * 1000 + source_line_number) * 10 + e AS source_row_number, (l_orderkey * 7 + source_line_number * 3 + e) % 60 AS m, s.*, e,
    CASE WHEN (l_orderkey * 7 + source_line_number * 3 + e) % 60 = 0 THEN 'LAZADA' WHEN source_name = 'OFFLINE_STORE' AND e = 2 THEN 'offline' ELSE lower(source_name) END AS r_source,
    CASE WHEN m60 = 1 THEN '' ELSE 'RET-' || source_order_id || '-' || e END AS return_id,
    CASE WHEN m60 = 2 THEN '0' ELSE CAST(source_line_number AS VARCHAR) END AS return_line,
    CASE WHEN m60 = 3 THEN source_order_id || 'X' ELSE source_order_id END AS r_order,
    CASE WHEN m60 = 4 THEN '1.5' ELSE CAST(source_line_number AS VARCHAR) END AS r_order_line,
    CASE WHEN m60 = 5 THEN '2026/01/01' ELSE strftime(order_date + e, '%Y-%m-%d') END AS return_date,
    CASE WHEN m60 = 6 THEN 'null' ELSE 'damaged' END AS return_reason,
    CASE WHEN m60 = 7 THEN 'LOST' WHEN m60 % 7 = 3 THEN 'REJECTED' WHEN m60 % 7 = 4 THEN 'pending' WHEN m60 % 7 = 5 THEN 'APPROVED' ELSE 'Processed' END AS return_status,
    CASE WHEN m60 = 8 THEN '-1' ELSE CAST((quantity + e) // 2 AS VARCHAR) END AS units,
    CASE WHEN m60 = 9 THEN 'PROCESSED' WHEN m60 = 10 THEN 'DONE' WHEN m60 % 7 IN (3, 4) THEN 'NOT_APPLICABLE' WHEN m60 % 7 = 5 THEN 'PENDING' ELSE 'PROCESSED' END AS refund_status,
    CASE WHEN m60 = 11 THEN '' WHEN m60 = 12 THEN 'abc' WHEN m60 = 13 THEN '-3' WHEN m60 = 14 THEN '1.001' WHEN m60 = 15 THEN '999999999999999.00'
         WHEN m60 = 9 OR m60 % 7 NOT IN (3, 4, 5) THEN CAST(CAST(net_amount / 2 AS DECIMAL(16,2)) AS VARCHAR) WHEN m60 = 17 THEN '5' ELSE '' END AS refund
  FROM (SELECT s.*, e, (l_orderkey * 7 + source_line_number * 3 + e) % 60 AS m60 FROM sales s, (VALUES (1), (2), (3)) AS t(e)) s
)"""
_refund_num = "TRY_CAST(refund AS DECIMAL(30, 8))"
NORMAL_SQL = f"""normal AS (
  SELECT *, upper(return_status) AS st, upper(refund_status) AS rst,
    CASE WHEN r_source = 'LAZADA' THEN '{_R["channel"]}' WHEN return_id = '' OR return_reason = 'null' THEN '{_R["required"]}'
      WHEN return_date = '2026/01/01' THEN '{_R["date"]}' WHEN upper(return_status) = 'LOST' THEN '{_R["return_status"]}'
      WHEN refund_status = 'DONE' THEN '{_R["refund_status"]}' WHEN refund_status = 'PROCESSED' AND refund = '' THEN '{_R["refund_required"]}'
      WHEN refund_status = 'PROCESSED' AND refund = 'abc' THEN '{_R["refund_number"]}' WHEN refund_status = 'PROCESSED' AND {_refund_num} < 0 THEN '{_R["refund_negative"]}'
      WHEN refund_status = 'PROCESSED' AND {_refund_num} > 99999999999999.99 THEN '{_R["refund_range"]}' WHEN refund_status = 'PROCESSED' AND {_refund_num} <> round({_refund_num}, 2) THEN '{_R["refund_precision"]}'
      WHEN refund_status <> 'PROCESSED' AND refund <> '' THEN '{_R["refund_early"]}'
      WHEN upper(return_status) IN ('PENDING', 'REJECTED') AND refund_status = 'PROCESSED' THEN '{_R["refund_open"]}'
      WHEN return_line = '0' THEN '{_R["return_line_number"]}' WHEN r_order_line = '1.5' THEN '{_R["order_line_number"]}'
      WHEN units = '-1' OR units = '0' THEN '{_R["quantity_returned"]}' END AS rule_reason
  FROM raw_returns
)"""
CAPS_SQL = f"""events AS (SELECT n.*, CAST(units AS BIGINT) AS q, CASE WHEN rst = 'PROCESSED' THEN CAST(refund AS DECIMAL(16,2)) ELSE 0 END AS r FROM normal n WHERE rule_reason IS NULL),
paired AS (SELECT source_name, source_order_id, source_line_number, any_value(quantity) AS sold, any_value(net_amount) AS net, any_value(sale_status) AS sale_status,
   {', '.join(f"max(CASE WHEN e = {i} THEN q END) AS q{i}, max(CASE WHEN e = {i} THEN r END) AS r{i}, max(CASE WHEN e = {i} THEN st END) AS s{i}" for i in (1, 2, 3))} FROM events GROUP BY 1, 2, 3),
f1 AS (SELECT *, CASE WHEN s1 <> 'REJECTED' AND q1 > sold THEN 'q' WHEN r1 > net THEN 'r' END AS v1 FROM paired),
f2 AS (SELECT *, CASE WHEN s1 IS NOT NULL AND v1 IS NULL AND s1 <> 'REJECTED' THEN q1 ELSE 0 END AS uq1, CASE WHEN s1 IS NOT NULL AND v1 IS NULL AND s1 <> 'REJECTED' THEN r1 ELSE 0 END AS ur1 FROM f1),
f3 AS (SELECT *, CASE WHEN s2 <> 'REJECTED' AND uq1 + q2 > sold THEN 'q' WHEN ur1 + r2 > net THEN 'r' END AS v2 FROM f2),
f4 AS (SELECT *, uq1 + CASE WHEN s2 IS NOT NULL AND v2 IS NULL AND s2 <> 'REJECTED' THEN q2 ELSE 0 END AS uq2, ur1 + CASE WHEN s2 IS NOT NULL AND v2 IS NULL AND s2 <> 'REJECTED' THEN r2 ELSE 0 END AS ur2 FROM f3),
f5 AS (SELECT *, CASE WHEN s3 <> 'REJECTED' AND uq2 + q3 > sold THEN 'q' WHEN ur2 + r3 > net THEN 'r' END AS v3 FROM f4),
caps AS (SELECT e.source_row_number, e.r_order, e.source_order_id, f.sale_status, CASE e.e WHEN 1 THEN v1 WHEN 2 THEN v2 ELSE v3 END AS v
  FROM events e JOIN f5 f USING (source_name, source_order_id, source_line_number)),
judged AS (SELECT n.source_row_number, coalesce(rule_reason, CASE WHEN n.r_order <> n.source_order_id THEN '{_R["no_sale"]}' WHEN c.sale_status = 'CANCELLED' THEN '{_R["cancelled"]}'
  WHEN v = 'q' THEN '{_R["quantity_cap"]}' WHEN v = 'r' THEN '{_R["refund_cap"]}' END) AS reason FROM normal n LEFT JOIN caps c USING (source_row_number))"""
# events with a changed order id stand on a line of their own and use nothing up
CAPS_SQL = CAPS_SQL.replace("FROM events GROUP BY 1, 2, 3)", "FROM events WHERE r_order = source_order_id GROUP BY 1, 2, 3)", 1).replace(
    "FROM events e JOIN f5 f USING", "FROM events e LEFT JOIN f5 f USING", 1)
RETURN_CTE = f"WITH {T.LINES_SQL},{RETURN_ROWS_SQL},{NORMAL_SQL}"
JUDGED_CTE = f"{RETURN_CTE},{CAPS_SQL}"
# Booked before, on every fourth order: an earlier version of the second event, on every eighth another event, and a rejected one.
_BOOKED_SQL = (
    ("any_value(sale_status) AS sale_status,", """any_value(sale_status) AS sale_status, any_value(CASE WHEN l_orderkey % 4 = 0 THEN quantity // 3 + 1 ELSE 0 END) AS oq, any_value(CASE WHEN l_orderkey % 8 = 0 THEN 1 ELSE 0 END) AS xq,
   any_value(CASE WHEN l_orderkey % 4 = 0 THEN CAST(quantity * 100.25 AS DECIMAL(16,2)) ELSE 0 END) AS obr,"""),
    ("q1 > sold", "q1 + oq + xq > sold"), ("WHEN r1 > net", "WHEN r1 + obr > net"), ("uq1 + q2 > sold", "uq1 + q2 + xq > sold"), ("uq2 + q3 > sold", "uq2 + q3 + oq + xq > sold"), ("ur2 + r3 > net", "ur2 + r3 + obr > net"),
)
BOOKED_CTE = JUDGED_CTE
for _old, _new in _BOOKED_SQL:
    BOOKED_CTE = BOOKED_CTE.replace(_old, _new)


def sold_lines(spark, sf):
    """What return rows, sales and booked returns are made of, stored once for the three."""
    return stored(T.sales(spark, sf).select("source_name", "source_order_id", "source_line_number", "order_date", "quantity", "net_amount", "sale_status", "l_orderkey"))


def return_rows(spark, sf, sold=None):
    """Return file rows as text, three events per sale line, damaged on fixed residues."""
    s = (T.sales(spark, sf) if sold is None else sold).withColumn("e", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    order, line, e = F.col("source_order_id"), F.col("source_line_number"), F.col("e")
    m = (F.col("l_orderkey") * 7 + line * 3 + e) % 60
    half = F.round(F.col("net_amount") / 2, 2).cast("decimal(16,2)").cast("string")
    paid = (m == 9) | ~(m % 7).isin(3, 4, 5)
    cells = {
        "source_name": F.when(m == 0, "LAZADA").when((F.col("source_name") == "OFFLINE_STORE") & (e == 2), "offline").otherwise(F.lower("source_name")),
        "return_id": F.when(m == 1, "").otherwise(F.concat(F.lit("RET-"), order, F.lit("-"), e.cast("string"))),
        "return_line_number": F.when(m == 2, "0").otherwise(line.cast("string")),
        "order_id": F.when(m == 3, F.concat(order, F.lit("X"))).otherwise(order),
        "order_line_number": F.when(m == 4, "1.5").otherwise(line.cast("string")),
        "return_date": F.when(m == 5, "2026/01/01").otherwise(F.date_format(F.date_add("order_date", e), "yyyy-MM-dd")),
        "return_reason": F.when(m == 6, "null").otherwise("damaged"),
        "return_status": F.when(m == 7, "LOST").when(m % 7 == 3, "REJECTED").when(m % 7 == 4, "pending").when(m % 7 == 5, "APPROVED").otherwise("Processed"),
        "quantity_returned": F.when(m == 8, "-1").otherwise(F.floor((F.col("quantity") + e) / 2).cast("string")),
        "refund_status": F.when(m == 9, "PROCESSED").when(m == 10, "DONE").when((m % 7).isin(3, 4), "NOT_APPLICABLE").when(m % 7 == 5, "PENDING").otherwise("PROCESSED"),
        "refund_amount": F.when(m == 11, "").when(m == 12, "abc").when(m == 13, "-3").when(m == 14, "1.001").when(m == 15, "999999999999999.00")
        .when(paid, half).when(m == 17, "5").otherwise(""),
    }
    row = ((F.col("l_orderkey") * 1000 + line) * 10 + e).alias("source_row_number")
    return s.select(row, F.to_json(F.struct(*[v.alias(k) for k, v in cells.items()])).alias("raw_payload"), *[cells[c].alias(c) for c in C.RETURN_COLUMNS])


def judged(spark, sf, booked=None, payload=False):
    """Verdicts, by row number alone unless the payloads are asked for; beside what ``booked`` makes of the sold lines."""
    sold = sold_lines(spark, sf)
    rows = return_rows(spark, sf, sold)
    sales = sold.select("source_name", "source_order_id", "source_line_number", "quantity", "net_amount", "sale_status")
    return R.judge_returns(rows if payload else rows.drop("raw_payload"), sales, booked and booked(sold), columns=None if payload else ["source_row_number"])


_by_rule = f"{RETURN_CTE} SELECT source_row_number, coalesce(rule_reason, '') AS reason FROM normal"
_normal = lambda spark, sf: R.normalize_returns(return_rows(spark, sf)).select("source_row_number", F.coalesce("reason", F.lit("")).alias("reason"))
add("d26_return_rules", _by_rule)(_normal)
for _id, _keys in (
    ("e17_return_channel", ("channel",)), ("e18_return_required", ("required",)), ("e19_return_date", ("date",)), ("e20_return_status", ("return_status", "refund_status")),
    ("e21_refund_amount", ("refund_required", "refund_number", "refund_negative", "refund_range", "refund_precision")), ("e22_refund_timing", ("refund_early", "refund_open")),
    ("e23_return_integers", ("return_line_number", "order_line_number", "quantity_returned")),
):
    _texts = [_R[k] for k in _keys]
    add(_id, f"SELECT * FROM ({_by_rule}) WHERE reason IN (" + ", ".join(f"'{t}'" for t in _texts) + ")")(
        lambda spark, sf, _texts=_texts: _normal(spark, sf).where(F.col("reason").isin(*_texts)))
add("d11_return_channels", f"{RETURN_CTE} SELECT source_row_number, CASE WHEN r_source = 'LAZADA' THEN NULL ELSE source_name END AS channel FROM raw_returns")(
    lambda spark, sf: return_rows(spark, sf).select("source_row_number", text.channel_code("source_name").alias("channel")))
add("e25_return_reference", f"{JUDGED_CTE} SELECT * FROM judged WHERE reason IN ('{_R['no_sale']}', '{_R['cancelled']}')")(
    lambda spark, sf: judged(spark, sf).where(F.col("reason").isin(_R["no_sale"], _R["cancelled"])).select("source_row_number", "reason"))
add("e26_return_caps", f"{JUDGED_CTE} SELECT source_row_number, coalesce(reason, '') AS reason, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS disposition FROM judged")(
    lambda spark, sf: judged(spark, sf).select("source_row_number", F.coalesce("reason", F.lit("")).alias("reason"), "disposition"))
def booked_returns(sold):
    """Return facts of an earlier run on the same lines."""
    s = sold.where("l_orderkey % 4 = 0").withColumn("v", F.explode(F.array(F.lit("RET"), F.lit("OLD"), F.lit("NO")))).where("v <> 'OLD' OR l_orderkey % 8 = 0")
    kind, order, units = F.col("v"), F.col("source_order_id"), F.col("quantity")
    return s.select(
        "source_name", F.concat(kind, F.lit("-"), order, F.when(kind == "RET", "-2").otherwise("")).alias("return_id"), F.col("source_line_number").alias("return_line_number"), "source_order_id", "source_line_number",
        F.when(kind == "RET", "PROCESSED").when(kind == "OLD", "APPROVED").otherwise("REJECTED").alias("return_status"),
        F.when(kind == "RET", F.floor(units / 3) + 1).when(kind == "OLD", 1).otherwise(units).cast("int").alias("quantity_returned"),
        F.when(kind == "RET", (units * F.lit("100.25").cast("decimal(5,2)")).cast("decimal(16,2)")).alias("refund_amount"), F.when(kind == "RET", "PROCESSED").otherwise("PENDING").alias("refund_status"),
    )


add("e26_caps_beside_booked_returns", f"{BOOKED_CTE} SELECT source_row_number, coalesce(reason, '') AS reason FROM judged")(
    lambda spark, sf: judged(spark, sf, booked_returns).select("source_row_number", F.coalesce("reason", F.lit("")).alias("reason")))
add("e27_refund_caps", f"{JUDGED_CTE} SELECT source_row_number FROM judged WHERE reason = '{_R['refund_cap']}'")(
    lambda spark, sf: judged(spark, sf).where(F.col("reason") == _R["refund_cap"]).select("source_row_number"))
add("g40_rejection_reasons", f"{JUDGED_CTE} SELECT reason, count(*) AS events FROM judged WHERE reason IS NOT NULL GROUP BY 1")(lambda spark, sf: R.rejection_reasons(judged(spark, sf)))
_CLASS = {"channel": "required", "required": "required", "date": "date", "return_status": "status", "refund_status": "status"}


def _class_of(reason: str) -> str:
    for name, words in classify.RETURN_CLASSES:
        if any(w in reason.lower() for w in words):
            return name
    return "required"


_CLASS_SQL = "CASE reason " + " ".join(f"WHEN '{r}' THEN '{_class_of(r)}'" for r in _R.values()) + " END"
add("g44_rejection_classes", f"{JUDGED_CTE} SELECT {_CLASS_SQL} AS class, count(*) AS events FROM judged WHERE reason IS NOT NULL GROUP BY 1")(
    lambda spark, sf: audit.rejection_classes(R.rejection_reasons(judged(spark, sf))).withColumn("events", F.col("events").cast("bigint")))
QUERIES["d21_rejection_classes"] = (QUERIES["g44_rejection_classes"][0], QUERIES["g44_rejection_classes"][1])
add("b18_return_rejected_rows", f"""{JUDGED_CTE} SELECT j.source_row_number, 'RETURN_EVENTS' AS source_name, nullif(r_order, '') AS source_order_id,
  CASE WHEN r_order_line <> '1.5' THEN CAST(r_order_line AS INTEGER) END AS source_line_number, reason AS rejection_reason FROM judged j JOIN normal USING (source_row_number) WHERE reason IS NOT NULL""")(
    lambda spark, sf: audit.return_rejected_audit(judged(spark, sf, payload=True).where("disposition = 'rejected'")).drop("source_payload"))


def _versions(spark, sf):
    """Return rows where some events are sent again, alike or with other units."""
    rows = return_rows(spark, sf)
    again = rows.where("source_row_number % 5 = 0").withColumn("source_row_number", F.col("source_row_number") + 5_000_000_000)
    altered = again.withColumn("quantity_returned", F.when(F.col("source_row_number") % 2 == 0, F.lit("1")).otherwise(F.col("quantity_returned")))
    return rows.unionByName(altered)


_VERSIONS_SQL = f"""{RETURN_CTE}, copies AS (SELECT source_row_number, units, * EXCLUDE (source_row_number, units) FROM raw_returns
  UNION ALL SELECT source_row_number + 5000000000, CASE WHEN (source_row_number + 5000000000) % 2 = 0 THEN '1' ELSE units END, * EXCLUDE (source_row_number, units) FROM raw_returns WHERE source_row_number % 5 = 0),
{NORMAL_SQL.replace('normal AS', 'normal2 AS').replace('FROM raw_returns', 'FROM copies')},
vs AS (SELECT source_name, return_id, source_line_number, count(DISTINCT units) AS versions, min(source_row_number) AS first_row FROM normal2 WHERE rule_reason IS NULL GROUP BY 1, 2, 3)
SELECT n.source_row_number, coalesce(rule_reason, CASE WHEN versions > 1 THEN '{_R["conflict"]}' END, '') AS reason,
  rule_reason IS NULL AND versions = 1 AND n.source_row_number > first_row AS is_duplicate FROM normal2 n LEFT JOIN vs USING (source_name, return_id, source_line_number)"""
add("e24_return_versions", f"SELECT source_row_number, reason, coalesce(is_duplicate, false) AS is_duplicate FROM ({_VERSIONS_SQL})")(
    lambda spark, sf: R.resolve_return_versions(R.normalize_returns(_versions(spark, sf).drop("raw_payload"))).select("source_row_number", F.coalesce("reason", F.lit("")).alias("reason"), "is_duplicate"))


# ------------------------------------------------------ remaining projections


def _native(spark, sf, channel):
    """A channel's rows back under their native column names, as its file would hold them."""
    fields = C.CHANNELS[channel].fields
    rows = T.dirty(spark, sf).where(F.col("source") == channel)
    return rows.selectExpr("source_file", "source_row_number", "source_sha256", "raw_payload", *[f"{f} AS `{native}`" for f, native in fields.items()], "discount_amount", "promo_code")


def _canonical(spark, sf):
    parts = [Q.canonical_rows(_native(spark, sf, channel), channel).select("source", "source_row_number", *C.CANONICAL_FIELDS) for channel in C.CHANNELS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_CANONICAL = ", ".join(f"CASE WHEN source IN ({', '.join(repr(k) for k, c in C.CHANNELS.items() if f in c.fields or f in C.OPTIONAL_FIELDS)}) THEN {f} END AS {f}" for f in C.CANONICAL_FIELDS)
add("c1_canonical_names", f"WITH {DIRTY_SQL} SELECT source, source_row_number, {_CANONICAL} FROM dirty")(_canonical)
add("c23_typed_columns", f"{TYPED_CTE} SELECT source, source_row_number, t_line AS line_number, t_quantity AS quantity, strftime(t_date, '%Y-%m-%d') AS order_date, CAST(t_price AS DOUBLE) AS unit_price FROM typed")(
    lambda spark, sf: ruled(spark, sf).select(*ROW, "line_number", "quantity", "order_date", "unit_price"))
add("d7_promo_values", f"WITH {_MASTER_SQL} SELECT source_row_number, CASE WHEN discount_value NOT IN ('0', '1.234') THEN CAST(discount_value AS DOUBLE) END AS discount_value FROM raw")(
    lambda spark, sf: catalogue_rows(spark, sf).select("source_row_number", "discount_value"))
add("d15_business_keys", f"{TYPED_CTE} SELECT DISTINCT source, c_order_id AS order_id, t_line AS line_number FROM typed WHERE c_order_id IS NOT NULL AND t_line IS NOT NULL")(
    lambda spark, sf: ruled(spark, sf).where("order_id IS NOT NULL AND line_number IS NOT NULL").select("source", "order_id", "line_number").distinct())
add("d27_not_a_number", f"{TYPED_CTE} SELECT source, source_row_number, c_quantity AS raw_value FROM typed WHERE e_quantity = 'INVALID_NUMBER'")(
    lambda spark, sf: cells(spark, sf, "quantity").select(*ROW, F.col("quantity").alias("raw_value"), numbers.positive_integer("quantity").alias("p")).where("p.error = 'INVALID_NUMBER'").drop("p"))
QUERIES["h3_running_caps"] = QUERIES["e26_return_caps"]
add("g34_auxiliary_metrics", f"{JUDGED_CTE} SELECT 'RETURN_EVENTS' AS source_name, count(*) AS processed, count(*) FILTER (WHERE reason IS NULL) AS validated, CAST(0 AS BIGINT) AS duplicates, count(reason) AS rejected FROM judged")(
    lambda spark, sf: audit.return_metrics(judged(spark, sf)))
