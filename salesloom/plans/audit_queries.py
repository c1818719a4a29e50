"""Registered queries over runs, findings and their reports (read from the event log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from salesloom import contracts as C
from salesloom.operators import audit as A, constraints, dashboard as D
from salesloom.plans import testdata as T
from salesloom.plans.sales_queries import big
from salesloom.plans.testdata import QUALITY_SQL, RUNS_SQL, present

QUERIES: dict = {}
RUN_CTE = f"WITH {RUNS_SQL}"
BOTH_CTE = f"WITH {RUNS_SQL},{QUALITY_SQL}"
TS = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def add(name: str, sql: str | None):
    def register(fn):
        QUERIES[name] = (lambda spark, sf: present(fn(spark, sf)), sql)
        return fn

    return register


def _runs(name: str, select: str, operator) -> None:
    add(name, f"{RUN_CTE} {select}")(lambda spark, sf: operator(T.runs(spark, sf)))


_SUMS = ", ".join(f"CAST(coalesce(sum(failed_records) FILTER (WHERE category = '{k}'), 0) AS BIGINT) AS {v}" for k, v in A.CATEGORY_COLUMNS.items())
_SUMMARY = f"SELECT run_id, source_name, {_SUMS}, CAST(coalesce(sum(failed_records) FILTER (WHERE severity = 'WARNING'), 0) AS BIGINT) AS warning_issue_records FROM quality GROUP BY 1, 2"
_COUNTED = [*A.CATEGORY_COLUMNS.values(), "warning_issue_records"]
_REPORT = f"""SELECT m.run_id, pipeline_name, pipeline_status, m.source_name, k * (i + 2) AS source_records, k * 2 AS candidate_records, k * i AS skipped_unchanged_records, k AS valid_records,
  k % 5 AS rejected_records, k % 3 AS duplicate_records, {", ".join(f"coalesce(q.{c}, 0) AS {c}" for c in _COUNTED)} FROM run_metrics m LEFT JOIN ({_SUMMARY}) q ON q.run_id = m.run_id AND q.source_name = m.source_name"""
add("f18_quality_report", f"{BOTH_CTE} {_REPORT}")(lambda spark, sf: A.quality_report(T.runs(spark, sf), T.quality_results(spark, sf)).drop("started_at"))
add("g28_category_summary", f"{BOTH_CTE} {_SUMMARY}")(lambda spark, sf: A.category_summary(T.quality_results(spark, sf)))
_P = """SELECT r.run_id, status, k * 8 AS extracted_records, CAST(coalesce(sum(CASE WHEN severity = 'ERROR' THEN failed_records ELSE 0 END), 0) AS BIGINT) AS error_records,
  CAST(coalesce(sum(CASE WHEN severity = 'WARNING' THEN failed_records ELSE 0 END), 0) AS BIGINT) AS warning_records FROM runs r LEFT JOIN quality q USING (run_id) GROUP BY ALL"""
add("f19_pipeline_quality", f"{BOTH_CTE} {_P}")(lambda spark, sf: A.pipeline_quality(T.runs(spark, sf), T.quality_results(spark, sf)).select("run_id", "status", "extracted_records", "error_records", "warning_records"))
QUERIES["g29_error_warning_sums"] = QUERIES["f19_pipeline_quality"]
add("f20_quality_by_rule", f"{BOTH_CTE} SELECT q.run_id, source_name, rule_name, severity, field, category, {big('sum(failed_records)', 'failed_records')}, strftime(max(evaluated_at), '%Y-%m-%d %H:%M:%S') AS evaluated_at, any_value(r.status) AS pipeline_status FROM quality q JOIN runs r USING (run_id) GROUP BY 1, 2, 3, 4, 5, 6")(
    lambda spark, sf: A.quality_by_rule(T.runs(spark, sf), T.quality_results(spark, sf)).drop("pipeline_name", "started_at"))
QUERIES["g30_rule_view"] = QUERIES["f20_quality_by_rule"]
_runs("f21_exploded_metrics", "SELECT run_id, source_name, k * (i + 2) AS source_records, k * 2 AS extracted_records FROM run_metrics", lambda r: A.explode_metrics(r).select("run_id", "source_name", "source_records", "extracted_records"))
add("d22_json_fields", "SELECT event_id, CAST(props->>'k' AS BIGINT) AS k FROM events")(
    lambda spark, sf: T.table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")))
_runs("d30_run_durations", "SELECT run_id, coalesce(epoch(ended_at) - epoch(started_at), CAST(duration_seconds AS DOUBLE)) AS seconds FROM runs",
      lambda r: A.run_durations(r).select("run_id", F.round("seconds", 3).alias("seconds")))
QUERIES["d30_run_durations"] = (QUERIES["d30_run_durations"][0], f"{RUN_CTE} SELECT run_id, round(coalesce(epoch(ended_at) - epoch(started_at), CAST(duration_seconds AS DOUBLE)), 3) AS seconds FROM runs")
_runs("g24_success_rate", "SELECT round(100 * avg(CASE WHEN status = 'SUCCESS' THEN 1.0 ELSE 0.0 END), 9) AS success_rate FROM runs", lambda r: A.success_rate(r).select(F.round("success_rate", 9).alias("success_rate")))
_ING = "ing AS (SELECT source_name, started_at AS extracted_at FROM run_metrics)"


def _ingestions(spark, sf):
    return A.explode_metrics(T.runs(spark, sf)).select("source_name", F.col("started_at").alias("extracted_at"), "run_id", "extracted_records")


add("g25_source_freshness", f"{RUN_CTE},{_ING} SELECT source_name, strftime(max(extracted_at), '%Y-%m-%d %H:%M:%S') AS last_ingested_at FROM ing GROUP BY 1")(lambda spark, sf: A.source_freshness(_ingestions(spark, sf)))
add("g26_failed_runs", f"{RUN_CTE} SELECT count(*) FILTER (WHERE status = 'FAILED' AND started_at >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 7 DAYS) AS failed_runs FROM runs")(
    lambda spark, sf: A.failed_since(T.runs(spark, sf), F.lit("2024-01-10 00:00:00").cast("timestamp")))
_LAST = "ORDER BY started_at DESC, run_id DESC LIMIT"
_runs("i10_latest_run", f"SELECT run_id, status, {TS('started_at')} FROM (SELECT * FROM runs {_LAST} 1)", lambda r: A.latest_run(r).select("run_id", "status", "started_at"))
_runs("i11_recent_runs", f"SELECT run_id, status, k * 8 AS extracted_records FROM (SELECT * FROM runs {_LAST} 10)", lambda r: A.recent_runs(r).select("run_id", "status", "extracted_records"))
_runs("i19_run_comparison", f"SELECT run_id, {TS('started_at')}, k * 14 AS source_records, k * 6 AS skipped_unchanged_records, k * 8 AS extracted_records, k * 4 AS validated_records, k * 3 AS loaded_records FROM runs", A.run_comparison)
_runs("g23_run_rates", "SELECT run_id, coalesce(round(CAST(k % 5 * 4 AS DOUBLE) / nullif(k * 8, 0) * 100, 6), 0) AS rejected_record_rate, coalesce(round(CAST(k % 3 * 4 AS DOUBLE) / nullif(k * 8, 0) * 100, 6), 0) AS duplicate_rate, coalesce(round(CAST(k * 2 AS DOUBLE) / nullif(k * 3, 0) * 100, 6), 0) AS fact_load_rate FROM runs",
      lambda r: D.run_rates(r).select("run_id", *[F.round(c, 6).alias(c) for c in ("rejected_record_rate", "duplicate_rate", "fact_load_rate")]))
_runs("k15_outcome_override", "SELECT run_id, CASE WHEN status = 'SUCCESS' AND user_id % 3 = 0 THEN 'FAILED' ELSE status END AS status FROM runs",
      lambda r: A.override_outcomes(r, r.where("user_id % 3 <> 0")).select("run_id", "status"))
_runs("g45_candidate_totals", "SELECT run_id, k * 8 AS channel_candidates, k * 2 AS product_candidates, k * 2 AS promo_candidates, k * 2 AS return_candidates, k * 14 AS total_candidates FROM runs", A.candidate_totals)


def _stages(spark, sf):
    """Stage rows of the runs: one per event of the same user and hour."""
    e = T.table(spark, sf, "events")
    return e.select((F.col("user_id") % 50).cast("string").alias("run_id"), F.col("event_type").alias("stage_name"), F.col("ts").alias("started_at"), F.col("value").cast("decimal(12,3)").alias("duration_seconds"), F.col("event_id").alias("records_processed"))


def _stage_run(spark, sf):
    return T.table(spark, sf, "events").select((F.max("user_id") % 50).cast("string").alias("run_id"))


add("h8_run_stages", "SELECT CAST(user_id % 50 AS VARCHAR) AS run_id, event_type AS stage_name, event_id AS records_processed, CAST(CAST(value AS DECIMAL(12,3)) AS DOUBLE) AS duration_seconds FROM events WHERE user_id % 50 = (SELECT max(user_id) % 50 FROM events)")(
    lambda spark, sf: A.run_stages(_stages(spark, sf), _stage_run(spark, sf)).drop("started_at"))
add("i14_run_findings", f"{BOTH_CTE} SELECT run_id, source_name, rule_name, severity, field, category, failed_records FROM quality WHERE run_id = (SELECT run_id FROM runs {_LAST} 1)")(
    lambda spark, sf: A.performance_bundle(T.runs(spark, sf), _stages(spark, sf), T.quality_results(spark, sf), _ingestions(spark, sf))["quality_issues"].drop("evaluated_at"))
add("i15_run_report", f"{BOTH_CTE} SELECT * FROM ({_REPORT}) WHERE run_id = (SELECT run_id FROM runs {_LAST} 1)")(
    lambda spark, sf: A.quality_bundle(T.runs(spark, sf), T.quality_results(spark, sf))["sources"].drop("started_at"))
add("l7_run_coherence", f"{RUN_CTE} SELECT 'end_after_start' AS rule, count(*) FILTER (WHERE ended_at < started_at) AS violations FROM (SELECT started_at, CASE WHEN k % 7 = 1 THEN started_at - INTERVAL 1 SECOND ELSE ended_at END AS ended_at FROM runs)")(
    lambda spark, sf: constraints.violations(_shifted(spark, sf), constraints.AUDIT_RULES["runs"]))


def _shifted(spark, sf):
    r = T.runs(spark, sf)
    early = F.timestamp_add("SECOND", F.lit(-1), F.col("started_at"))
    return r.withColumn("ended_at", F.when(F.col("fact_skipped_records") % 7 == 1, early).otherwise(F.col("ended_at")))


# ---------------------------------------------------------- source metrics

_PER = "CASE o_custkey % 4 WHEN 0 THEN 'SHOPEE' WHEN 1 THEN 'TOKOPEDIA' WHEN 2 THEN 'WEBSITE' ELSE 'PRODUCT_MASTER' END"


def _scan_counts(spark, sf):
    code = T._by_remainder("o_custkey", 4, ["SHOPEE", "TOKOPEDIA", "WEBSITE", "PRODUCT_MASTER"]).alias("source_name")
    o = T.table(spark, sf, "orders")
    return (o.groupBy(code).agg(F.count(F.lit(1)).alias("source_records")), o.where("o_orderkey % 9 = 0 AND o_custkey % 4 <> 1").groupBy(code).agg(F.count(F.lit(1)).alias("extracted_records")))


_METRICS = f"m AS (SELECT {_PER} AS source_name, count(*) AS source_records, count(*) FILTER (WHERE o_orderkey % 9 = 0 AND o_custkey % 4 <> 1) AS extracted_records FROM orders GROUP BY 1)"
add("g32_source_metrics", f"WITH {_METRICS} SELECT source_name, source_records, source_records - extracted_records AS skipped_unchanged_records, extracted_records FROM m")(lambda spark, sf: A.source_metrics(*_scan_counts(spark, sf)))
add("g32_metric_totals", f"WITH {_METRICS} SELECT {big('sum(source_records)', 'source_records')}, {big('sum(source_records - extracted_records)', 'skipped_unchanged_records')} FROM m WHERE source_name <> 'PRODUCT_MASTER'")(
    lambda spark, sf: A.metric_totals(A.source_metrics(*_scan_counts(spark, sf))))
_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
add("g36_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS records FROM {t}" for t in _TABLES))(lambda spark, sf: A.table_counts({t: T.table(spark, sf, t) for t in _TABLES}))
add("g37_raw_totals", "SELECT count(*) FILTER (WHERE o_custkey % 4 < 3) AS transactions, count(*) FILTER (WHERE o_custkey % 4 = 3) AS products FROM orders")(
    lambda spark, sf: T.table(spark, sf, "orders").agg(F.count_if(F.col("o_custkey") % 4 < 3).alias("transactions"), F.count_if(F.col("o_custkey") % 4 == 3).alias("products")))
add("g38_run_counters", f"{RUN_CTE} SELECT status, {big('sum(k * 4)', 'validated')}, {big('sum(k % 3 * 4)', 'duplicates')}, {big('sum(k % 5 * 4)', 'rejected')}, {big('sum(k * 2)', 'inserted')}, {big('sum(greatest(k * 4 - k * 3, 0))', 'skipped')} FROM runs GROUP BY 1")(
    lambda spark, sf: T.runs(spark, sf).groupBy("status").agg(
        F.sum("validated_records").alias("validated"), F.sum("duplicate_records").alias("duplicates"), F.sum("rejected_records").alias("rejected"),
        F.sum("fact_inserted_records").alias("inserted"), F.sum(F.greatest(F.col("validated_records") - F.col("incremental_records"), F.lit(0))).alias("skipped")))
add("c22_run_display", f"{RUN_CTE} SELECT run_id, source_name, k * 2 AS extracted_records, k AS validated_records FROM run_metrics")(
    lambda spark, sf: T.runs(spark, sf).select("run_id", F.transform("source_metrics", lambda m: F.struct(m["source_name"].alias("source_name"), m["extracted_records"].alias("extracted_records"), m["validated_records"].alias("validated_records"))).alias("m")).select("run_id", F.inline("m")))


def _reconciliations(spark, sf):
    return T.runs(spark, sf).select("run_id", F.when(F.col("status") == "SUCCESS", "SUCCESS").otherwise("SKIPPED").alias("status"), F.col("fact_skipped_records").alias("deactivated_records"))


add("g35_reconciliation_totals", f"{RUN_CTE} SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS sources_checked, count(*) FILTER (WHERE status <> 'SUCCESS') AS sources_skipped, {big('sum(k)', 'deactivated_records')} FROM runs")(
    lambda spark, sf: A.reconciliation_totals(_reconciliations(spark, sf)))
add("j2_union_findings", f"WITH {QUALITY_SQL} SELECT severity, count(*) AS findings FROM quality GROUP BY 1")(
    lambda spark, sf: _union_findings(spark, sf))


def _union_findings(spark, sf):
    q = T.quality_results(spark, sf)
    parts = [q.where(F.col("severity") == s) for s in C.SEVERITIES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("severity").agg(F.count(F.lit(1)).alias("findings"))
