"""Registered queries of the load: deltas, merges, dimensions, facts, reconciliation, corrections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from salesloom import contracts as C
from salesloom.functions.hashing import payload_hash, record_hash
from salesloom.operators import delta, merge, returns as R, warehouse as W
from salesloom.plans import testdata as T
from salesloom.plans.sales_queries import big, dbl
from salesloom.plans.testdata import RETURN_SQL, SALES_SQL, present
from salesloom.session import cut_lineage, ensure_checkpoint_dir, stored
from salesloom.sources.tables import Tables

QUERIES: dict = {}
KEY = W.SALE_KEY
KEYS = ", ".join(KEY)
RKEY = W.RETURN_KEY
RKEYS = ", ".join(RKEY)


def now():
    return F.lit("2026-01-02 00:00:00").cast("timestamp")


def before():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")


def order_no():
    return F.col("source_order_id").cast("bigint")


def add(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (lambda spark, sf: present(fn(spark, sf)), sql)
        return fn

    return register


# ------------------------------------------------ two states of the sale lines

CONTENT = ["quantity", "net_amount", "sale_status", "product_id", "promo_code"]


def new_sales(spark, sf, sold=None):
    """Staged rows of this run: two thirds of the orders and those that the facts lack."""
    s = (T.sales(spark, sf) if sold is None else sold).where("l_orderkey % 3 <> 0 OR l_orderkey % 5 = 0")
    return s.withColumns({"source_record_hash": record_hash(CONTENT), "source_row_number": F.col("l_orderkey") * 1000 + F.col("source_line_number")})


def old_sales(spark, sf, sold=None):
    """Facts before this run: four fifths of the orders, some with other content, some inactive."""
    s = (T.sales(spark, sf) if sold is None else sold).where("l_orderkey % 5 <> 0")
    s = s.withColumn("quantity", F.col("quantity") + F.when(F.col("l_orderkey") % 7 == 0, 1).otherwise(0))
    return s.withColumns({"source_record_hash": record_hash(CONTENT), "is_source_active": F.col("l_orderkey") % 13 != 0})


STATES_SQL = f"""{SALES_SQL}, new_sales AS (SELECT * FROM sales WHERE l_orderkey % 3 <> 0 OR l_orderkey % 5 = 0),
old_sales AS (SELECT * EXCLUDE (quantity), quantity + CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS quantity, l_orderkey % 13 <> 0 AS active FROM sales WHERE l_orderkey % 5 <> 0),
merged AS (SELECT {KEYS}, o.quantity AS oq, n.quantity AS nq, o.active, o.source_order_id IS NOT NULL AND o.quantity IS NOT NULL AS in_old, n.quantity IS NOT NULL AS in_new
  FROM old_sales o FULL OUTER JOIN new_sales n USING ({KEYS}))"""


def _staging(spark, sf):
    old = old_sales(spark, sf).select(*KEY, "quantity", "source_record_hash", F.lit("r0").alias("ingestion_run_id"), before().alias("transformed_at"))
    new = new_sales(spark, sf).select(*KEY, "quantity", "source_record_hash")
    return old, new


add("b4_staging_merge", f"{STATES_SQL} SELECT {KEYS}, CASE WHEN in_new THEN nq ELSE oq END AS quantity, CASE WHEN in_new THEN 'r1' ELSE 'r0' END AS ingestion_run_id, CASE WHEN in_new AND NOT in_old THEN 'insert' WHEN in_new THEN 'update' ELSE 'keep' END AS merge_action FROM merged")(
    lambda spark, sf: W.merge_staging(*_staging(spark, sf), "r1", now()).select(*KEY, "quantity", "ingestion_run_id", "merge_action"))


def _facts(spark, sf):
    old = old_sales(spark, sf).select(*KEY, "quantity", "source_record_hash", "is_source_active", before().alias("loaded_at"))
    new = new_sales(spark, sf).select(*KEY, "quantity", "source_record_hash", F.lit(True).alias("is_source_active"), now().alias("loaded_at"))
    changed = ~F.col("o.source_record_hash").eqNullSafe(F.col("n.source_record_hash")) | ~F.col("o.is_source_active")
    return merge.merge_upsert(old, new, KEY, changed)


_FACT = """CASE WHEN in_new AND NOT in_old THEN 'insert' WHEN in_new AND (oq <> nq OR NOT active) THEN 'update' ELSE 'keep' END"""
add("b12_fact_merge", f"{STATES_SQL}, a AS (SELECT *, {_FACT} AS merge_action FROM merged) SELECT {KEYS}, CASE merge_action WHEN 'keep' THEN oq ELSE nq END AS quantity, CASE merge_action WHEN 'keep' THEN active ELSE true END AS is_source_active, CASE merge_action WHEN 'keep' THEN '2026-01-01 00:00:00' ELSE '2026-01-02 00:00:00' END AS loaded_at, merge_action FROM a")(
    lambda spark, sf: _facts(spark, sf).drop("source_record_hash"))
_B12_SQL = QUERIES["b12_fact_merge"][1]


def _bucket_merge(spark, sf):
    """The same merge on stored tables: the buckets of a hundredth of the orders are changed first, then those of all staged keys.

    Record hashes are kept as their 32 bytes, half of their text, which no codec makes much shorter.
    """
    schema = "source_name string, source_order_id string, source_line_number int, quantity int, source_record_hash binary, is_source_active boolean, loaded_at timestamp, merge_action string"
    tables = Tables(spark, f"{ensure_checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}", {"facts": schema}, {"facts": ("source_name", KEY)})
    columns = [*KEY, "quantity", F.unhex("source_record_hash").alias("source_record_hash"), "is_source_active"]
    changed = ~F.col("o.source_record_hash").eqNullSafe(F.col("n.source_record_hash")) | ~F.col("o.is_source_active")

    def merged(old, new):
        """A key that an earlier change of this load inserted or updated keeps that action. It is joined to the old rows, where their keys deal them anyway."""
        was = old.select(*KEY, F.col("merge_action").alias("_was"))
        out = merge.merge_upsert(old.drop("merge_action").join(was, KEY, "left"), new, KEY, changed)
        action = F.when(F.col("merge_action") == "keep", F.coalesce("_was", F.lit("keep"))).otherwise(F.col("merge_action"))
        return out.withColumn("merge_action", action).drop("_was")

    sold = stored(T.sales(spark, sf).select(*KEY, *CONTENT, "l_orderkey"))  # both states are made of it, and each step reads one of them
    old = old_sales(spark, sf, sold).select(*columns, before().alias("loaded_at"), F.lit("keep").alias("merge_action"))
    new = new_sales(spark, sf, sold).withColumn("is_source_active", F.lit(True)).select(*columns, now().alias("loaded_at"))
    tables.write("facts", old, tables.places("facts", old))
    tables.change("facts", new.where(order_no() % 100 == 1), merged)
    tables.change("facts", new, merged)
    return tables.read("facts").drop("source_record_hash")


add("b12_bucket_merge", _B12_SQL)(_bucket_merge)
add("k7_reactivated", f"{STATES_SQL} SELECT {KEYS} FROM merged WHERE in_new AND in_old AND NOT active")(
    lambda spark, sf: new_sales(spark, sf).select(*KEY).join(old_sales(spark, sf).where("NOT is_source_active").select(*KEY), KEY, "left_semi"))
add("k13_insert_update_split", f"{STATES_SQL} SELECT {_FACT} AS merge_action, count(*) AS records FROM merged GROUP BY 1")(
    lambda spark, sf: _facts(spark, sf).groupBy("merge_action").agg(F.count(F.lit(1)).alias("records")))
add("k4_record_delta", f"{STATES_SQL} SELECT {KEYS}, NOT in_old AS is_new FROM merged WHERE in_new AND (NOT in_old OR oq <> nq OR NOT active)")(
    lambda spark, sf: delta.changed_records(new_sales(spark, sf), old_sales(spark, sf)).select(*KEY, "is_new"))
add("k4_new_keys_only", f"{STATES_SQL} SELECT {KEYS} FROM merged WHERE in_new AND NOT in_old")(
    lambda spark, sf: delta.changed_records(new_sales(spark, sf), old_sales(spark, sf), compare_hash=False).select(*KEY))


def stale_sales(spark, sf):
    """Open and settled corrections on fixed residues of the sale lines."""
    s = T.sales(spark, sf).where("l_orderkey % 17 = 2 AND source_line_number < 4")
    resolved = F.col("l_orderkey") % 2 == 0
    return s.select(
        *KEY, F.lit("r0").alias("rejected_run_id"), (F.col("l_orderkey") * 10).alias("source_row_number"), F.lit("before").alias("rejection_reason"),
        before().alias("rejected_at"), F.when(resolved, before()).alias("resolved_at"), F.when(resolved, "r0").alias("resolved_run_id"), before().alias("updated_at"),
    )


STALE_SQL = f"{STATES_SQL}, stale AS (SELECT {KEYS}, l_orderkey % 2 = 0 AS resolved FROM sales WHERE l_orderkey % 17 = 2 AND source_line_number < 4)"
add("f9_candidate_hashes", f"{STALE_SQL} SELECT m.source_name, m.source_order_id, m.source_line_number, NOT in_old AS is_new FROM merged m LEFT JOIN (SELECT * FROM stale WHERE NOT resolved) s USING ({KEYS}) WHERE in_new AND (NOT in_old OR oq <> nq OR NOT active OR s.resolved IS NOT NULL)")(
    lambda spark, sf: delta.changed_records(new_sales(spark, sf), old_sales(spark, sf), stale_sales(spark, sf)).select(*KEY, "is_new"))


def rejected_sales(spark, sf):
    s = T.sales(spark, sf).where("l_orderkey % 4 = 1").withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
    return s.select(*KEY, (F.col("l_orderkey") * 10 + F.col("v")).alias("source_row_number"), F.concat(F.lit("bad "), F.col("v").cast("string")).alias("rejection_reason"))


_FOUND = f"found AS (SELECT r.source_name, r.source_order_id, r.source_line_number, r.l_orderkey * 10 + 2 AS source_row_number, 'bad 2' AS rejection_reason FROM sales r JOIN old_sales USING ({KEYS}) WHERE r.l_orderkey % 4 = 1)"
add("f12_sales_corrections", f"{STATES_SQL}, {_FOUND} SELECT * FROM found")(lambda spark, sf: delta.sales_corrections(rejected_sales(spark, sf), old_sales(spark, sf)))
add("k8_open_corrections", f"""{STALE_SQL}, {_FOUND} SELECT {KEYS}, coalesce(f.rejection_reason, 'before') AS rejection_reason, CASE WHEN f.rejection_reason IS NOT NULL THEN 'r1' ELSE 'r0' END AS rejected_run_id,
  coalesce(f.rejection_reason IS NULL AND s.resolved, false) AS is_resolved FROM stale s FULL OUTER JOIN found f USING ({KEYS})""")(
    lambda spark, sf: delta.open_corrections(stale_sales(spark, sf), delta.sales_corrections(rejected_sales(spark, sf), old_sales(spark, sf)), "r1", now())
    .select(*KEY, "rejection_reason", "rejected_run_id", F.col("resolved_at").isNotNull().alias("is_resolved")))
add("f14_resolve_corrections", f"{STALE_SQL} SELECT {KEYS}, CASE WHEN resolved THEN 'r0' WHEN n.quantity IS NOT NULL THEN 'r1' ELSE '' END AS resolved_run_id FROM stale LEFT JOIN new_sales n USING ({KEYS})")(
    lambda spark, sf: delta.resolve_corrections(stale_sales(spark, sf), new_sales(spark, sf), "r1", now()).select(*KEY, F.coalesce("resolved_run_id", F.lit("")).alias("resolved_run_id")))
QUERIES["k10_resolved"] = QUERIES["f14_resolve_corrections"]
add("l7_audit_coherence", f"{STALE_SQL} SELECT 'resolved_pair' AS rule, count(*) FILTER (WHERE l_bad) AS violations FROM (SELECT resolved AND source_line_number = 1 AS l_bad FROM stale)")(
    lambda spark, sf: _bad_pairs(spark, sf))


def _bad_pairs(spark, sf):
    from salesloom.operators import constraints

    bent = stale_sales(spark, sf).withColumn("resolved_run_id", F.when(F.col("source_line_number") != 1, F.col("resolved_run_id")))
    return constraints.violations(bent, constraints.AUDIT_RULES["stale"])


# --------------------------------------------------------------- returns merge


def old_returns(spark, sf):
    r = T.returns(spark, sf).where(order_no() % 5 != 0)
    r = r.withColumn("quantity_returned", F.col("quantity_returned") + F.when(order_no() % 7 == 0, 1).otherwise(0))
    return r.withColumn("source_record_hash", record_hash(R.EVENT_FIELDS))


def new_returns(spark, sf):
    return T.returns(spark, sf).where((order_no() % 3 != 0) | (order_no() % 5 == 0)).withColumn("source_record_hash", record_hash(R.EVENT_FIELDS))


RSTATES_SQL = f"""{RETURN_SQL}, new_r AS (SELECT * FROM return_facts WHERE CAST(source_order_id AS BIGINT) % 3 <> 0 OR CAST(source_order_id AS BIGINT) % 5 = 0),
old_r AS (SELECT * EXCLUDE (quantity_returned), quantity_returned + CASE WHEN CAST(source_order_id AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS quantity_returned FROM return_facts WHERE CAST(source_order_id AS BIGINT) % 5 <> 0),
rm AS (SELECT {RKEYS}, o.quantity_returned AS oq, n.quantity_returned AS nq FROM old_r o FULL OUTER JOIN new_r n USING ({RKEYS}))"""
_RACT = "CASE WHEN oq IS NULL THEN 'insert' WHEN nq IS NOT NULL AND oq <> nq THEN 'update' ELSE 'keep' END"


def _return_merge(spark, sf):
    old = old_returns(spark, sf).select(*R.EVENT_FIELDS, "source_record_hash", F.lit("r0").alias("ingestion_run_id"), before().alias("updated_at"))
    return W.merge_return_facts(old, new_returns(spark, sf), "r1", now())


add("b13_return_fact_merge", f"{RSTATES_SQL} SELECT {RKEYS}, CASE {_RACT} WHEN 'keep' THEN oq ELSE nq END AS quantity_returned, CASE {_RACT} WHEN 'keep' THEN 'r0' ELSE 'r1' END AS ingestion_run_id, {_RACT} AS merge_action FROM rm")(
    lambda spark, sf: _return_merge(spark, sf).select(*RKEY, "quantity_returned", "ingestion_run_id", "merge_action"))
add("f10_existing_return_keys", f"{RSTATES_SQL} SELECT {RKEYS} FROM rm WHERE oq IS NOT NULL AND nq IS NOT NULL")(
    lambda spark, sf: new_returns(spark, sf).select(*RKEY).join(old_returns(spark, sf).select(*RKEY), RKEY, "left_semi"))
add("d14_return_changed", f"{RSTATES_SQL} SELECT {RKEYS}, oq <> nq AS changed FROM rm WHERE oq IS NOT NULL AND nq IS NOT NULL")(
    lambda spark, sf: new_returns(spark, sf).select(*RKEY, F.col("source_record_hash").alias("n")).join(old_returns(spark, sf).select(*RKEY, F.col("source_record_hash").alias("o")), RKEY).select(*RKEY, (F.col("n") != F.col("o")).alias("changed")))
add("b5_return_staging_merge", f"{RSTATES_SQL} SELECT {RKEYS}, CASE {_RACT} WHEN 'keep' THEN 'r0' ELSE 'r1' END AS ingestion_run_id, {_RACT} AS merge_action FROM rm")(
    lambda spark, sf: W.merge_staging(
        old_returns(spark, sf).select(*RKEY, "quantity_returned", "source_record_hash", F.lit("r0").alias("ingestion_run_id"), before().alias("transformed_at")),
        new_returns(spark, sf).select(*RKEY, "quantity_returned", "source_record_hash"), "r1", now(), RKEY, with_run=False).select(*RKEY, "ingestion_run_id", "merge_action"))


def rejected_returns(spark, sf):
    """Rejected raw return rows: known and unknown channels, usable and unusable line numbers."""
    r = T.returns(spark, sf).where(order_no() % 3 == 1)
    return r.select(
        F.when(order_no() % 4 == 0, "nowhere").when(F.col("source_name") == "OFFLINE_STORE", " offline ").otherwise(F.lower("source_name")).alias("source_name"),
        F.concat(F.lit(" "), F.col("return_id")).alias("return_id"), F.when(order_no() % 2 == 0, "x").otherwise(F.col("return_line_number").cast("string")).alias("return_line_number"),
        (order_no() * 1000 + F.col("return_line_number")).alias("source_row_number"), F.lit("bad").alias("rejection_reason"),
    )


add("f13_return_corrections", f"""{RSTATES_SQL}, p AS (SELECT CASE WHEN CAST(source_order_id AS BIGINT) % 4 <> 0 THEN source_name END AS ps, return_id AS pid,
   CASE WHEN CAST(source_order_id AS BIGINT) % 2 <> 0 THEN return_line_number END AS pl, CAST(source_order_id AS BIGINT) * 1000 + return_line_number AS rn FROM return_facts WHERE CAST(source_order_id AS BIGINT) % 3 = 1)
SELECT 'RETURN_EVENTS' AS source_name, f.source_name || ':' || f.return_id AS source_order_id, f.return_line_number AS source_line_number, max(rn) AS source_row_number, 'bad' AS rejection_reason
FROM old_r f JOIN p ON p.pid = f.return_id AND coalesce(ps, f.source_name) = f.source_name AND coalesce(pl, f.return_line_number) = f.return_line_number GROUP BY 1, 2, 3""")(
    lambda spark, sf: delta.return_corrections(rejected_returns(spark, sf), old_returns(spark, sf)))


def stale_returns(spark, sf):
    r = T.returns(spark, sf).where(order_no() % 6 == 1)
    return r.select(
        F.lit("RETURN_EVENTS").alias("source_name"), F.concat_ws(":", "source_name", "return_id").alias("source_order_id"), F.col("return_line_number").alias("source_line_number"),
        F.lit("r0").alias("rejected_run_id"), order_no().alias("source_row_number"), F.lit("bad").alias("rejection_reason"),
        F.timestamp_add("SECOND", (order_no() % 86400).cast("int"), before()).alias("rejected_at"), F.when(order_no() % 4 == 1, before()).alias("resolved_at"),
        F.when(order_no() % 4 == 1, "r0").alias("resolved_run_id"), before().alias("updated_at"),
    )


_SR = "SELECT source_name, return_id, return_line_number, CAST(source_order_id AS BIGINT) AS o FROM return_facts WHERE CAST(source_order_id AS BIGINT) % 6 = 1"
_FOUND_SQL = QUERIES["f13_return_corrections"][1]
add("k9_open_return_corrections", f"""WITH sr AS (SELECT source_name || ':' || return_id AS source_order_id, return_line_number AS source_line_number, o FROM ({RETURN_SQL} {_SR})), found AS ({_FOUND_SQL})
SELECT coalesce(f.source_order_id, sr.source_order_id) AS source_order_id, coalesce(f.source_line_number, sr.source_line_number) AS source_line_number,
  CASE WHEN f.source_name IS NOT NULL THEN 'r1' ELSE 'r0' END AS rejected_run_id, coalesce(f.source_name IS NULL AND o % 4 = 1, false) AS is_resolved
FROM sr FULL OUTER JOIN found f ON f.source_order_id = sr.source_order_id AND f.source_line_number = sr.source_line_number""")(
    lambda spark, sf: delta.open_corrections(stale_returns(spark, sf), delta.return_corrections(rejected_returns(spark, sf), old_returns(spark, sf)), "r1", now())
    .select("source_order_id", "source_line_number", "rejected_run_id", F.col("resolved_at").isNotNull().alias("is_resolved")))
add("f15_resolve_return_corrections", f"{RSTATES_SQL}, sr AS ({_SR}) SELECT sr.source_name || ':' || sr.return_id AS source_order_id, sr.return_line_number AS source_line_number, CASE WHEN o % 4 = 1 THEN 'r0' WHEN n.quantity_returned IS NOT NULL THEN 'r1' ELSE '' END AS resolved_run_id FROM sr LEFT JOIN new_r n USING ({RKEYS})")(
    lambda spark, sf: delta.resolve_corrections(stale_returns(spark, sf), delta.resolved_by_returns(new_returns(spark, sf)), "r1", now())
    .select("source_order_id", "source_line_number", F.coalesce("resolved_run_id", F.lit("")).alias("resolved_run_id")))
add("c21_stale_return_keys", f"{RETURN_SQL}, sr AS ({_SR}) SELECT {RKEYS} FROM sr WHERE o % 4 <> 1")(lambda spark, sf: delta.stale_return_keys(stale_returns(spark, sf)))
add("c20_stale_listing", f"{RETURN_SQL}, sr AS ({_SR}) SELECT 'Return / ' || source_name AS source_name, return_id AS source_order_id, 'RETURN' AS record_type, return_line_number AS source_line_number, o AS source_row_number FROM sr WHERE o % 4 <> 1")(
    lambda spark, sf: delta.stale_listing(stale_returns(spark, sf), None).select("source_name", "source_order_id", "record_type", "source_line_number", "source_row_number"))
add("i17_unresolved_corrections", f"{STALE_SQL} SELECT source_name, count(*) AS open_corrections FROM stale WHERE NOT resolved GROUP BY 1")(
    lambda spark, sf: stale_sales(spark, sf).where("resolved_at IS NULL").groupBy("source_name").agg(F.count(F.lit(1)).alias("open_corrections")).orderBy("source_name"))

# --------------------------------------------------------------- payload delta

PAYLOAD = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def raw_lines(spark, sf):
    """Raw payloads: every version of every order line."""
    rows = T.lines(spark, sf, *PAYLOAD).selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in PAYLOAD])
    return rows.withColumns({"payload_hash": payload_hash(PAYLOAD), "source_row_number": F.xxhash64(*PAYLOAD)})


def known_hashes(spark, sf):
    return raw_lines(spark, sf).where("CAST(l_partkey AS BIGINT) % 6 <> 0").select("payload_hash")


_K1 = "x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_partkey % 6 = 0 AS changed FROM lineitem)"
_CAST = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PAYLOAD[:-1])
add("k1_payload_delta", f"WITH {_K1} SELECT {_CAST}, CAST(l_quantity AS VARCHAR) AS l_quantity, changed AS is_changed FROM x QUALIFY max(changed) OVER (PARTITION BY l_orderkey, l_linenumber)")(
    lambda spark, sf: delta.mark_changed(raw_lines(spark, sf), known_hashes(spark, sf), ["l_orderkey", "l_linenumber"], ["source_row_number"])
    .where("is_selected").select(*PAYLOAD, "is_changed"))
add("h7_siblings", f"WITH {_K1} SELECT {_CAST}, CAST(l_quantity AS VARCHAR) AS l_quantity FROM x QUALIFY NOT changed AND max(changed) OVER (PARTITION BY l_orderkey, l_linenumber)")(
    lambda spark, sf: delta.mark_changed(raw_lines(spark, sf), known_hashes(spark, sf), ["l_orderkey", "l_linenumber"], ["source_row_number"])
    .where("is_selected AND NOT is_changed").select(*PAYLOAD))
add("k3_known_hashes", "SELECT count(*) AS hashes FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_partkey % 6 <> 0)")(
    lambda spark, sf: known_hashes(spark, sf).distinct().agg(F.count(F.lit(1)).alias("hashes")))
add("d12_payload_changed", "SELECT count(*) AS rows, count(DISTINCT (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)) AS payloads FROM lineitem")(
    lambda spark, sf: raw_lines(spark, sf).groupBy("payload_hash").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("payloads")))
add("d13_record_changed", f"{STATES_SQL} SELECT {KEYS}, oq <> nq AS changed FROM merged WHERE in_old AND in_new")(
    lambda spark, sf: new_sales(spark, sf).select(*KEY, F.col("source_record_hash").alias("n")).join(old_sales(spark, sf).select(*KEY, F.col("source_record_hash").alias("o")), KEY).select(*KEY, (F.col("n") != F.col("o")).alias("changed")))
add("b14_snapshot_hashes", "SELECT l_returnflag AS source_name, count(DISTINCT (l_orderkey, l_linenumber, l_partkey)) AS hashes, count(*) AS source_records FROM lineitem GROUP BY 1")(
    lambda spark, sf: _snapshot(spark, sf))


def _snapshot(spark, sf):
    rows = T.table(spark, sf, "lineitem").select("l_returnflag", *[F.col(c).cast("string").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey")])
    hashed = rows.select(F.col("l_returnflag").alias("source_name"), payload_hash(["l_orderkey", "l_linenumber", "l_partkey"]).alias("h"))
    per_hash = hashed.groupBy("source_name", "h").agg(F.count(F.lit(1)).alias("n"))
    return per_hash.groupBy("source_name").agg(F.count(F.lit(1)).alias("hashes"), F.sum("n").alias("source_records"))


add("k2_return_delta", f"""{RSTATES_SQL}, sr AS ({_SR}), raw AS (SELECT *, CAST(source_order_id AS BIGINT) AS o FROM return_facts)
SELECT {RKEYS} FROM raw LEFT JOIN (SELECT {RKEYS}, true AS stale FROM sr WHERE o % 4 <> 1) s USING ({RKEYS}) WHERE o % 5 = 0 OR s.stale""")(
    lambda spark, sf: _return_delta(spark, sf))


def _return_delta(spark, sf):
    rows = T.returns(spark, sf).select(
        F.lower("source_name").alias("source_name"), "return_id", F.col("return_line_number").cast("string").alias("return_line_number"), F.col("source_order_id").alias("order_id"),
        order_no().alias("o"), F.col("source_name").alias("code"),
    )
    rows = rows.withColumns({"payload_hash": payload_hash(["source_name", "return_id", "return_line_number", "order_id"]), "source_row_number": F.xxhash64("return_id", "return_line_number")})
    known = rows.where("o % 5 <> 0").select("payload_hash")
    fixed = rows.withColumn("source_name", F.when(F.col("code") == "OFFLINE_STORE", "offline").otherwise(F.col("source_name")))
    picked = delta.changed_returns(fixed, known, delta.stale_return_keys(stale_returns(spark, sf)))
    return picked.select(F.col("code").alias("source_name"), "return_id", F.col("return_line_number").cast("int").alias("return_line_number"))


add("k12_promo_rescan", f"{SALES_SQL},{T.PROMOTIONS_SQL} SELECT {KEYS}, s.promo_code FROM sales s WHERE s.promo_code IN (SELECT promo_code FROM promotions WHERE status <> 'active')")(
    lambda spark, sf: T.sales(spark, sf).join(T.promotions(spark, sf).where("status <> 'active'").select("promo_code"), "promo_code", "left_semi").select(*KEY, "promo_code"))
add("k11_product_delta", "SELECT 'SKU-' || p_partkey AS sku FROM part WHERE p_partkey % 4 = 1 OR p_partkey % 6 = 0")(
    lambda spark, sf: _product_delta(spark, sf))


def _product_rows(spark, sf):
    rows = T.products(spark, sf)
    return rows.select(*[F.col(c).cast("string").alias(c) for c in C.PRODUCT_COLUMNS])


def _product_delta(spark, sf):
    n = F.regexp_replace("sku", "SKU-", "").cast("bigint")
    now = _product_rows(spark, sf).withColumns({"payload_hash": payload_hash(C.PRODUCT_COLUMNS), "source_row_number": n})
    before = _product_rows(spark, sf).where(n % 4 != 1).withColumn("price", F.when(n % 6 == 0, "1.00").otherwise(F.col("price")))
    return delta.mark_changed(now, before.select(payload_hash(C.PRODUCT_COLUMNS).alias("payload_hash")), None, ["source_row_number"]).where("is_selected").select("sku")


# ---------------------------------------------------------------- dimensions

add("b6_channel_members", f"{SALES_SQL} SELECT source_name AS channel_code, CASE source_name WHEN 'SHOPEE' THEN 'Shopee' WHEN 'TOKOPEDIA' THEN 'Tokopedia' WHEN 'WEBSITE' THEN 'Website' ELSE 'Offline Store' END AS channel_name, count(*) AS lines FROM sales GROUP BY 1, 2")(
    lambda spark, sf: T.sales(spark, sf).groupBy(F.col("source_name").alias("channel_code")).agg(F.count(F.lit(1)).alias("lines"))
    .join(W.merge_channels(W.empty(spark, W.DIM_SCHEMAS["dim_channel"]), W.channel_members(spark)), "channel_code").select("channel_code", "channel_name", "lines"))


def _dim_product(spark, sf):
    p = T.products(spark, sf).withColumn("i", F.regexp_replace("sku", "SKU-", "").cast("bigint"))
    old = p.where("i % 4 <> 0").select(
        F.xxhash64("sku").alias("product_key"), "sku", "product_name", "brand", "category",
        F.when(F.col("i") % 6 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(14,2)").alias("standard_price"), F.lit(True).alias("is_active"))
    return W.merge_products(old, p.where("i % 9 <> 0"))


add("b7_dim_product_merge", """SELECT 'SKU-' || p_partkey AS sku, CAST(CASE WHEN p_partkey % 9 = 0 AND p_partkey % 6 = 0 THEN CAST(p_retailprice AS DECIMAL(14,2)) + 1 ELSE CAST(p_retailprice AS DECIMAL(14,2)) END AS DOUBLE) AS standard_price,
  CASE WHEN p_partkey % 4 = 0 THEN 'insert' WHEN p_partkey % 9 <> 0 THEN 'update' ELSE 'keep' END AS merge_action FROM part WHERE p_partkey % 4 <> 0 OR p_partkey % 9 <> 0""")(
    lambda spark, sf: _dim_product(spark, sf).select("sku", "standard_price", "merge_action"))
add("b8_dim_date_merge", f"{SALES_SQL} SELECT DISTINCT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, strftime(order_date, '%B') AS month_name, strftime(order_date, '%A') AS day_name, isodow(order_date) >= 6 AS is_weekend FROM sales")(
    lambda spark, sf: W.merge_dates(W.calendar(T.sales(spark, sf).where("day(order_date) > 15")), T.sales(spark, sf)).select("date_key", "month_name", "day_name", "is_weekend"))


def _customers(spark, sf):
    s = T.sales(spark, sf)
    staged = s.select(
        F.concat(F.lit("NK-"), F.col("o_custkey").cast("string")).alias("customer_nk"), "source_name",
        (F.col("l_orderkey") * 1000 + F.col("source_line_number")).alias("source_row_number"),
        F.when(F.col("l_orderkey") % 3 != 0, F.col("customer_name")).alias("customer_name"), F.when(F.col("l_orderkey") % 2 == 0, F.col("city")).alias("city"),
    )
    c = T.table(spark, sf, "customer").where("c_custkey % 3 <> 0")
    nk = F.concat(F.lit("NK-"), F.col("c_custkey").cast("string"))
    old = c.select(F.xxhash64(nk).alias("customer_key"), nk.alias("customer_nk"), F.lit("Old name").alias("customer_name"), F.lit("Old town").alias("city"))
    return old, staged


add("b9_dim_customer_merge", f"""{SALES_SQL}, b AS (SELECT 'NK-' || o_custkey AS customer_nk, arg_max(customer_name, l_orderkey * 1000 + source_line_number) FILTER (WHERE l_orderkey % 3 <> 0 AND customer_name <> '') AS n,
  arg_max(city, l_orderkey * 1000 + source_line_number) FILTER (WHERE l_orderkey % 2 = 0 AND city <> '') AS c FROM sales GROUP BY 1),
o AS (SELECT 'NK-' || c_custkey AS customer_nk, 'Old name' AS on_, 'Old town' AS oc FROM customer WHERE c_custkey % 3 <> 0)
SELECT customer_nk, CASE WHEN on_ IS NULL THEN n ELSE coalesce(n, on_) END AS customer_name,
  CASE WHEN on_ IS NULL THEN c WHEN c IS NULL OR lower(trim(c)) IN ('', 'nan', 'none', 'null', 'n/a', 'na') THEN oc ELSE c END AS city FROM o FULL OUTER JOIN b USING (customer_nk)""")(
    lambda spark, sf: W.merge_customers(*_customers(spark, sf)).select("customer_nk", "customer_name", "city"))
add("h6_last_known", f"""{SALES_SQL} SELECT 'NK-' || o_custkey AS customer_nk, arg_max(customer_name, l_orderkey * 1000 + source_line_number) FILTER (WHERE l_orderkey % 3 <> 0 AND customer_name <> '') AS customer_name,
  arg_max(city, l_orderkey * 1000 + source_line_number) FILTER (WHERE l_orderkey % 2 = 0 AND city <> '') AS city FROM sales GROUP BY 1""")(
    lambda spark, sf: W.batch_customers(_customers(spark, sf)[1]))
add("b10_dim_payment_merge", f"{SALES_SQL} SELECT DISTINCT payment_method FROM sales")(
    lambda spark, sf: W.merge_payments(T.sales(spark, sf).where("l_orderkey % 100 = 1").select("payment_method").distinct().withColumn("payment_key", F.xxhash64("payment_method")), T.sales(spark, sf)).select("payment_method"))
add("b11_dim_promotion_sync", f"WITH {T.PROMOTIONS_SQL} SELECT promo_code, CAST(replace(promo_code, 'PROMO', '') AS INTEGER) >= 4 AS is_active FROM promotions")(
    lambda spark, sf: _promo_sync(spark, sf))


def _promo_sync(spark, sf):
    p = T.promotions(spark, sf)
    n = F.regexp_replace("promo_code", "PROMO", "").cast("int")
    old = p.where(n < 8).withColumn("is_active", F.lit(True))
    return W.merge_promotions(old, p.where(n >= 4)).select("promo_code", "is_active")


add("d25_city_cleanup", "SELECT c_custkey AS customer_key, CASE WHEN c_custkey % 10 > 1 THEN n_name END AS city FROM customer JOIN nation ON c_nationkey = n_nationkey")(
    lambda spark, sf: W.clean_city_markers(T.table(spark, sf, "customer").join(T.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    .select(F.col("c_custkey").alias("customer_key"), F.when(F.col("c_custkey") % 10 == 0, " ").when(F.col("c_custkey") % 10 == 1, "N/A").otherwise(F.col("n_name")).alias("city"))))
add("d29_hash_backfill", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN repeat('0', 64) ELSE sha256(CAST(o_orderkey AS VARCHAR)) END AS source_record_hash FROM orders")(
    lambda spark, sf: W.backfill_hash(T.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.sha2(F.col("o_orderkey").cast("string"), 256)).alias("source_record_hash"))))


def dims(spark, sf, sold=None):
    """Dimensions merged from nothing out of the sale lines."""
    s = T.sales(spark, sf) if sold is None else sold
    staged = s.select("order_date", "payment_method", F.concat(F.lit("NK-"), F.col("o_custkey").cast("string")).alias("customer_nk"), "customer_name", "city", "source_name",
                      (F.col("l_orderkey") * 1000 + F.col("source_line_number")).alias("source_row_number"))
    products = T.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("sku"), F.col("p_name").alias("product_name"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(14,2)").alias("price"))
    empty = lambda n: W.empty(spark, W.DIM_SCHEMAS[n])
    return {
        "dim_date": W.merge_dates(empty("dim_date"), staged), "dim_channel": W.merge_channels(empty("dim_channel"), W.channel_members(spark)).drop("merge_action"),
        "dim_product": W.merge_products(empty("dim_product"), products).drop("merge_action"), "dim_payment": W.merge_payments(empty("dim_payment"), staged),
        "dim_customer": W.merge_customers(empty("dim_customer"), staged).drop("merge_action"),
    }


def star_facts(spark, sf):
    """Facts and dimensions; the sale lines that both are made of and the dimensions, which are counted and joined, are stored."""
    sold = stored(T.sales(spark, sf).drop("product_name", "brand", "category", "l_partkey"))
    staged = sold.withColumns(
        {
            "mapped_sku": F.col("product_id"), "source_row_number": F.col("l_orderkey") * 1000 + F.col("source_line_number"), "source_record_hash": record_hash(CONTENT),
            "customer_nk": F.when(F.col("o_custkey") % 6 != 0, F.concat(F.lit("NK-"), F.col("o_custkey").cast("string"))),
            "payment_method": F.when(F.col("o_custkey") % 8 != 0, F.col("payment_method")),
        }
    )
    d = {name: stored(rows) for name, rows in dims(spark, sf, sold).items()}
    return W.merge_sales_facts(W.empty(spark, W.FACT_SCHEMAS["fact_sales"]), staged, d, now()).drop("merge_action"), d


add("f1_star_lookup", f"{SALES_SQL} SELECT {KEYS}, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, o_custkey % 6 <> 0 AS has_customer, o_custkey % 8 <> 0 AS has_payment, {dbl('net_amount', 'net_amount')} FROM sales")(
    lambda spark, sf: star_facts(spark, sf)[0].select(*KEY, "date_key", F.col("customer_key").isNotNull().alias("has_customer"), F.col("payment_key").isNotNull().alias("has_payment"), "net_amount"))


def _star_detail(spark, sf):
    facts, d = star_facts(spark, sf)
    return W.sales_detail(stored(facts), d, T.returns(spark, sf))


add("f5_star_detail", f"{T.FULL_SQL} SELECT {KEYS}, strftime(order_date, '%Y-%m-%d') AS order_date, product_id, channel_name, CASE WHEN o_custkey % 6 <> 0 THEN customer_name END AS customer_name, {big('returned_units', 'returned_units')}, {dbl('processed_refund_amount', 'processed_refund_amount')} FROM detail")(
    lambda spark, sf: _star_detail(spark, sf).select(*KEY, "order_date", "product_id", "channel_name", "customer_name", "returned_units", "processed_refund_amount"))

# ----------------------------------------------------- raw rows and sinks

add("b1_raw_rows", f"{SALES_SQL} SELECT {KEYS}, CAST(quantity AS VARCHAR) AS quantity, promo_code FROM sales")(
    lambda spark, sf: _raw(spark, sf))


def _raw(spark, sf):
    from salesloom.sources.sinks import with_payload

    rows = T.sales(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in (*KEY, "quantity", "promo_code")])
    landed = with_payload(rows, rows.columns)
    get = lambda c: F.get_json_object("source_payload", f"$.{c}")
    return landed.select(get("source_name").alias("source_name"), get("source_order_id").alias("source_order_id"), get("source_line_number").cast("int").alias("source_line_number"), get("quantity").alias("quantity"), get("promo_code").alias("promo_code"))


add("b15_watermarks", f"{SALES_SQL} SELECT source_name, CAST(count(*) AS VARCHAR) AS last_business_key, 'r1' AS last_successful_run_id FROM sales GROUP BY 1")(
    lambda spark, sf: _watermarks(spark, sf))


def _watermarks(spark, sf):
    key = ["pipeline_name", "source_name"]
    counts = T.sales(spark, sf).groupBy("source_name").agg(F.count(F.lit(1)).cast("string").alias("last_business_key"))
    new = counts.select(F.lit(C.PIPELINE_NAME).alias("pipeline_name"), "source_name", F.lit("r1").alias("last_successful_run_id"), now().alias("last_processed_at"), "last_business_key")
    old = new.where("source_name < 'SHOPEE'").withColumn("last_successful_run_id", F.lit("r0"))
    return merge.merge_upsert(old, new, key).select("source_name", "last_business_key", "last_successful_run_id")


add("b23_replace_keys", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 8 <> 0 UNION ALL SELECT l_orderkey, l_linenumber, min(l_partkey), -1.0 FROM lineitem WHERE l_orderkey % 8 = 0 GROUP BY 1, 2")(
    lambda spark, sf: _replaced(spark, sf))


def _replaced(spark, sf):
    rows = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    updates = rows.where("l_orderkey % 8 = 0").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"), F.lit(-1.0).alias("l_quantity"))
    return merge.replace_keys(rows, updates, ["l_orderkey", "l_linenumber"])


add("b24_header_upgrade", f"{SALES_SQL} SELECT {KEYS}, CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE CAST(discount_amount AS VARCHAR) END AS discount_amount, CASE WHEN l_orderkey % 2 = 0 THEN '' ELSE coalesce(promo_code, '') END AS promo_code FROM sales")(
    lambda spark, sf: _upgraded(spark, sf))


def _upgraded(spark, sf):
    from salesloom.sources.sinks import union_contracts

    s = T.sales(spark, sf).withColumn("discount_amount", F.col("discount_amount").cast("string"))
    old, new = s.where("l_orderkey % 2 = 0").select(*KEY), s.where("l_orderkey % 2 <> 0").select(*KEY, "discount_amount", "promo_code")
    return union_contracts(old, new, [*KEY, "discount_amount", "promo_code"])


def raw_index(spark, sf):
    """Raw records of three runs per source row."""
    s = T.sales(spark, sf).select("source_name", (F.col("l_orderkey") * 1000 + F.col("source_line_number")).alias("source_row_number"), "l_orderkey")
    s = s.withColumn("r", F.explode(F.when(F.col("l_orderkey") % 4 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))))
    return s.select("source_name", "source_row_number", F.concat(F.lit("r"), F.col("r").cast("string")).alias("ingestion_run_id"), F.timestamp_add("DAY", F.col("r"), before()).alias("loaded_at"),
                    F.concat_ws("/", F.concat(F.lit("r"), F.col("r").cast("string")), F.col("source_row_number").cast("string")).alias("raw_record_id"))


add("f16_raw_lineage", f"{STATES_SQL} SELECT {KEYS}, CASE WHEN l_orderkey % 4 = 0 THEN 'r2/' ELSE 'r1/' END || (l_orderkey * 1000 + source_line_number) AS source_raw_record_id FROM new_sales")(
    lambda spark, sf: W.with_raw_lineage(new_sales(spark, sf).select(*KEY, "source_row_number"), raw_index(spark, sf), "r2").select(*KEY, "source_raw_record_id"))
add("h5_latest_raw", f"{STATES_SQL} SELECT source_name, l_orderkey * 1000 + source_line_number AS source_row_number, CASE WHEN l_orderkey % 4 = 0 THEN 'r2' ELSE 'r1' END AS ingestion_run_id FROM sales")(
    lambda spark, sf: raw_index(spark, sf).groupBy("source_name", "source_row_number").agg(F.max_by("ingestion_run_id", "loaded_at").alias("ingestion_run_id")))
add("i16_newest_raw", f"{SALES_SQL} SELECT source_name, l_orderkey * 1000 + source_line_number AS source_row_number FROM sales WHERE l_orderkey % 4 = 0 ORDER BY 2 DESC LIMIT 20")(
    lambda spark, sf: _newest(spark, sf))


def _newest(spark, sf):
    from salesloom.operators.audit import newest_raw_rows

    return newest_raw_rows(raw_index(spark, sf)).select("source_name", "source_row_number")


# ------------------------------------------------------------ reconciliation


def _declarations(spark, sf):
    """One declaration per source found in the sale lines; two of them complete."""
    s = T.sales(spark, sf).groupBy("source_name").agg(F.count(F.lit(1)).alias("n"))
    full = F.col("source_name").isin("SHOPEE", "WEBSITE", "TOKOPEDIA")
    stamp = F.when(full, before()).alias("snapshot_timestamp")
    return s.select("source_name", F.when(full, "FULL_SNAPSHOT").otherwise("INCREMENTAL_BATCH").alias("ingestion_mode"), F.when(full, "ALL_HISTORY").alias("snapshot_scope"), stamp,
                    F.when(full, "COMPLETE").otherwise("UNKNOWN").alias("snapshot_completeness"))


def _snapshot_rows(spark, sf):
    """Snapshot of this run; the second channel holds a row that cannot be identified."""
    s = T.sales(spark, sf).where("l_orderkey % 3 <> 0 OR l_orderkey % 5 = 0")
    keys = F.create_map(*[F.lit(x) for k, c in C.CHANNELS.items() for x in (c.code, k)])
    bad = (F.col("source_name") == "TOKOPEDIA") & (F.col("l_orderkey") % 50 == 1)
    return s.select(keys[F.col("source_name")].alias("source"), F.concat(F.lit(" "), F.col("source_order_id")).alias("order_id"),
                    F.when(bad, "?").otherwise(F.col("source_line_number").cast("string")).alias("line_number"))


def _reconciled(spark, sf):
    keys = delta.snapshot_keys(_snapshot_rows(spark, sf))
    expected = T.sales(spark, sf).where("l_orderkey % 3 <> 0 OR l_orderkey % 5 = 0").groupBy("source_name").agg(F.count(F.lit(1)).alias("source_records"))
    status = delta.snapshot_status(keys, _declarations(spark, sf), expected)
    facts = old_sales(spark, sf).select(*KEY, "quantity", "is_source_active")
    return status, delta.reconcile_facts(facts, keys, status)


_GONE = f"""{STATES_SQL}, rec AS (SELECT o.source_name, o.source_order_id, o.source_line_number, o.active, o.active AND o.source_name IN ('SHOPEE', 'WEBSITE') AND n.quantity IS NULL AS gone
  FROM old_sales o LEFT JOIN new_sales n USING ({KEYS}))"""
add("k6_reconciled_facts", f"{_GONE} SELECT {KEYS}, active AND NOT gone AS is_source_active, gone AS deactivated FROM rec")(
    lambda spark, sf: _reconciled(spark, sf)[1].select(*KEY, "is_source_active", F.col("_deactivated").alias("deactivated")))


def _reconciled_by_digest(spark, sf):
    keys = cut_lineage(delta.snapshot_keys(_snapshot_rows(spark, sf)))
    expected = T.sales(spark, sf).where("l_orderkey % 3 <> 0 OR l_orderkey % 5 = 0").groupBy("source_name").agg(F.count(F.lit(1)).alias("source_records"))
    status = cut_lineage(delta.snapshot_status(keys, _declarations(spark, sf), expected))
    facts = cut_lineage(old_sales(spark, sf).select(*KEY, "is_source_active"))
    return delta.reconcile_differing(facts, keys, status, 4096).select(*KEY, "is_source_active", F.col("_deactivated").alias("deactivated"))


add("k6_reconciled_by_digest", QUERIES["k6_reconciled_facts"][1])(_reconciled_by_digest)


def _hash_states(spark, sf):
    mark = lambda df: df.select("source_name", F.concat_ws("-", "source_order_id", "source_line_number", "quantity").alias("payload_hash"))
    return mark(old_sales(spark, sf)), mark(new_sales(spark, sf))


_HASHES_SQL = f"""{STATES_SQL}, o AS (SELECT DISTINCT source_name, source_order_id || '-' || source_line_number || '-' || quantity AS payload_hash FROM old_sales),
n AS (SELECT DISTINCT source_name, source_order_id || '-' || source_line_number || '-' || quantity AS payload_hash FROM new_sales)"""
add("b14_hash_changes", f"{_HASHES_SQL} SELECT source_name, payload_hash, n.source_name IS NULL AS gone FROM (SELECT *, 1 AS a FROM o) o FULL JOIN (SELECT *, 1 AS b FROM n) n USING (source_name, payload_hash) WHERE a IS NULL OR b IS NULL".replace("n.source_name IS NULL", "b IS NULL"))(
    lambda spark, sf: delta.hash_changes(*_hash_states(spark, sf)))
add("b14_hash_state", f"{_HASHES_SQL} SELECT * FROM n")(
    lambda spark, sf: (lambda known, current: delta.apply_hash_changes(known, delta.hash_changes(known, current)))(*_hash_states(spark, sf)))
add("f11_missing_facts", f"{_GONE} SELECT {KEYS} FROM rec WHERE gone")(lambda spark, sf: _reconciled(spark, sf)[1].where("_deactivated").select(*KEY))
add("k5_snapshot_keys", f"{STATES_SQL} SELECT source_name, count(*) AS observed, count(*) FILTER (WHERE source_name = 'TOKOPEDIA' AND l_orderkey % 50 = 1) AS unidentified FROM new_sales GROUP BY 1")(
    lambda spark, sf: delta.snapshot_keys(_snapshot_rows(spark, sf)).groupBy(_code("source").alias("source_name")).agg(F.count(F.lit(1)).alias("observed"), F.count("key_problem").alias("unidentified")))


def _code(column):
    from salesloom.operators.quality import channel_code_of

    return channel_code_of(column)


add("k6_reconciliation_audit", f"""{_GONE}, n AS (SELECT source_name, count(*) AS total FROM new_sales GROUP BY 1), g AS (SELECT source_name, count(*) FILTER (WHERE gone) AS gone FROM rec GROUP BY 1)
SELECT source_name, CASE WHEN source_name IN ('SHOPEE', 'WEBSITE') THEN 'SUCCESS' ELSE 'SKIPPED' END AS status, total AS source_records, CASE WHEN source_name IN ('SHOPEE', 'WEBSITE') THEN total ELSE 0 END AS observed_business_keys,
  CASE source_name WHEN 'OFFLINE_STORE' THEN '{C.RECONCILE_SKIPS["declaration"]}' WHEN 'TOKOPEDIA' THEN '{C.RECONCILE_SKIPS["key"]}' ELSE '' END AS detail, gone AS deactivated_records FROM n JOIN g USING (source_name)""")(
    lambda spark, sf: delta.reconciliation_audit(*_reconciled(spark, sf)).select("source_name", "status", "source_records", "observed_business_keys", F.coalesce("detail", F.lit("")).alias("detail"), "deactivated_records"))
add("k14_reconcilable", f"{SALES_SQL} SELECT DISTINCT source_name, source_name <> 'OFFLINE_STORE' AS reconcilable FROM sales")(
    lambda spark, sf: _declarations(spark, sf).select("source_name", delta.is_reconcilable(F.col("ingestion_mode"), F.col("snapshot_scope"), F.col("snapshot_timestamp"), F.col("snapshot_completeness")).alias("reconcilable")))

# ------------------------------------------------------------------ set work

add("j1_union_channels", f"{SALES_SQL} SELECT source_name, count(*) AS lines FROM sales GROUP BY 1")(
    lambda spark, sf: _union(spark, sf))


def _union(spark, sf):
    s = T.sales(spark, sf)
    parts = [s.where(F.col("source_name") == code) for code in C.CHANNEL_CODES]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("source_name").agg(F.count(F.lit(1)).alias("lines"))


add("j3_unknown_corrections", f"{STATES_SQL} SELECT {KEYS} FROM new_sales ANTI JOIN old_sales USING ({KEYS})")(
    lambda spark, sf: new_sales(spark, sf).select(*KEY).join(old_sales(spark, sf).select(*KEY), KEY, "left_anti"))
add("j6_removal_guard", f"{SALES_SQL} SELECT count(*) > 0 AS blocked FROM sales WHERE promo_code IS NOT NULL OR discount_amount > 0")(
    lambda spark, sf: _guard(spark, sf))


def _guard(spark, sf):
    s = T.sales(spark, sf)
    needs = s.where("promo_code IS NOT NULL").select("source_name").unionAll(s.where("discount_amount > 0").select("source_name"))
    return needs.agg((F.count(F.lit(1)) > 0).alias("blocked"))


add("c11_active_facts", f"{STATES_SQL} SELECT {KEYS}, quantity FROM old_sales WHERE active")(
    lambda spark, sf: old_sales(spark, sf).where("is_source_active").select(*KEY, "quantity"))
