"""Audit tables, run reports and operations queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C
from salesloom.functions.classify import audit_category, report_section, return_rejection_class
from salesloom.operators.quality import channel_code_of

AUDIT_SCHEMAS = {
    "pipeline_runs": (
        "run_id string, pipeline_name string, started_at timestamp, ended_at timestamp, status string, "
        "extracted_records bigint, valid_records bigint, duplicate_records bigint, invalid_records bigint, "
        "loaded_records bigint, validated_records bigint, rejected_records bigint, incremental_records bigint, "
        "staged_records bigint, dimension_records bigint, fact_inserted_records bigint, fact_skipped_records bigint, "
        "source_records bigint, skipped_unchanged_records bigint, duration_seconds decimal(12,3), error_message string, "
        "source_metrics array<struct<source_name:string,source_records:bigint,skipped_unchanged_records:bigint,"
        "extracted_records:bigint,validated_records:bigint,rejected_records:bigint,duplicate_records:bigint>>, "
        "report_summary string"
    ),
    "stage_runs": (
        "run_id string, stage_name string, status string, started_at timestamp, ended_at timestamp, "
        "duration_seconds decimal(12,3), records_processed bigint, error_message string"
    ),
    "quality_results": (
        "run_id string, source_name string, rule_name string, severity string, field string, category string, "
        "failed_records bigint, evaluated_at timestamp"
    ),
    "rejected_records": (
        "run_id string, source_name string, source_order_id string, source_line_number int, source_row_number bigint, "
        "rejection_reason string, source_payload string, rejected_at timestamp"
    ),
    "watermarks": (
        "pipeline_name string, source_name string, last_successful_run_id string, last_processed_at timestamp, "
        "last_business_key string"
    ),
    "source_ingestions": (
        "run_id string, source_name string, source_file_name string, source_file_path string, "
        "file_checksum_sha256 string, source_format string, extracted_records bigint, extracted_at timestamp"
    ),
    "source_snapshots": (
        "source_name string, file_checksum_sha256 string, source_records bigint, run_id string, updated_at timestamp"
    ),
    "snapshot_hashes": "source_name string, payload_hash string",
    "stale_corrections": (
        "source_name string, source_order_id string, source_line_number int, rejected_run_id string, "
        "source_row_number bigint, rejection_reason string, rejected_at timestamp, resolved_at timestamp, "
        "resolved_run_id string, updated_at timestamp"
    ),
    "reconciliations": (
        "run_id string, source_name string, status string, source_records bigint, observed_business_keys bigint, "
        "deactivated_records bigint, detail string, ingestion_mode string, snapshot_scope string, "
        "snapshot_timestamp timestamp, snapshot_completeness string, reconciled_at timestamp"
    ),
}


def result_source_name(source="source") -> Column:
    return F.coalesce(channel_code_of(source), F.when(F.col(source) == "product", "PRODUCT_MASTER"), F.col(source))


def rule_counts(issues: DataFrame) -> DataFrame:
    """Findings per source, rule, severity and field with their category."""
    grouped = issues.groupBy("source", "rule", "severity", "field").agg(F.count(F.lit(1)).alias("failed_records"))
    return grouped.select(
        result_source_name().alias("source_name"), F.col("rule").alias("rule_name"), "severity", "field",
        audit_category(F.col("rule"), F.col("field")).alias("category"), "failed_records",
    )


def section_counts(issues: DataFrame) -> DataFrame:
    """Findings per report section and field, per source and in total without the product master."""
    per_source = issues.groupBy(
        result_source_name().alias("source_name"), report_section(F.col("rule"), F.col("field")).alias("section"),
        F.coalesce("field", F.lit("tidak diketahui")).alias("field"),
    ).agg(F.count(F.lit(1)).alias("findings"))
    total = (
        per_source.where("source_name <> 'PRODUCT_MASTER'")
        .groupBy(F.lit("ALL").alias("source_name"), "section", "field")
        .agg(F.sum("findings").alias("findings"))
    )
    return per_source.unionByName(total)


def rejected_audit(evidence: DataFrame) -> DataFrame:
    """Rejected rows in audit form."""
    return evidence.select(
        result_source_name().alias("source_name"), F.col("business_key").alias("source_order_id"), "source_line_number",
        F.col("source_row_number").cast("bigint").alias("source_row_number"),
        F.when(F.col("reasons") != "", F.col("reasons")).otherwise("REJECTED").alias("rejection_reason"),
        F.col("raw_payload").alias("source_payload"),
    )


def return_rejected_audit(rejected: DataFrame) -> DataFrame:
    """Rejected return rows in audit form, the line taken over when it is a number."""
    raw = F.col("raw_payload")
    line = F.get_json_object(raw, "$.order_line_number")
    order = F.get_json_object(raw, "$.order_id")
    return rejected.select(
        F.lit("RETURN_EVENTS").alias("source_name"), F.when(order != "", order).alias("source_order_id"),
        F.when(line.rlike(r"^\d+\z"), line.try_cast("int")).alias("source_line_number"),
        F.col("source_row_number").cast("bigint").alias("source_row_number"), F.col("reason").alias("rejection_reason"),
        raw.alias("source_payload"),
    )


def source_metrics(scanned: DataFrame, candidates: DataFrame) -> DataFrame:
    """Total, skipped and candidate rows per source."""
    joined = scanned.join(candidates, "source_name", "left")
    candidate = F.coalesce("extracted_records", F.lit(0).cast("bigint"))
    return joined.select(
        "source_name", "source_records", (F.col("source_records") - candidate).alias("skipped_unchanged_records"),
        candidate.alias("extracted_records"),
    )


def metric_totals(metrics: DataFrame) -> DataFrame:
    """Totals over the channels, the product master left out."""
    sales = metrics.where("source_name <> 'PRODUCT_MASTER'")
    return sales.agg(
        F.coalesce(F.sum("source_records"), F.lit(0).cast("bigint")).alias("source_records"),
        F.coalesce(F.sum("skipped_unchanged_records"), F.lit(0).cast("bigint")).alias("skipped_unchanged_records"),
    )


def scoped_counts(annotated: DataFrame, selected: DataFrame) -> DataFrame:
    """Quality counts of the selected rows only."""
    from salesloom.operators.quality import quality_summary

    severities = F.transform("issues", lambda i: F.struct(i["severity"].alias("severity"))).alias("issues")  # all that is counted of the findings
    counted = annotated.select("source", "source_row_number", "disposition", severities)
    chosen = counted.join(selected.select("source", "source_row_number").distinct(), ["source", "source_row_number"], "left_semi")
    return quality_summary(chosen)


# -------------------------------------------------------------------- views


def explode_metrics(runs: DataFrame) -> DataFrame:
    """One row per run and source."""
    return runs.select(
        "run_id", "pipeline_name", "started_at", F.col("status").alias("pipeline_status"), F.inline("source_metrics")
    )


CATEGORY_COLUMNS = {
    "missing_value": "missing_value_records", "duplicate": "duplicate_issue_records",
    "invalid_quantity": "invalid_quantity_records", "invalid_price_or_amount": "invalid_price_or_amount_records",
    "invalid_date": "invalid_date_records", "invalid_status": "invalid_status_records",
    "unmapped_product": "unmapped_product_records", "other": "other_issue_records",
}


def category_summary(quality: DataFrame) -> DataFrame:
    """Finding counts by category per run and source."""
    sums = [
        F.coalesce(F.sum(F.when(F.col("category") == k, F.col("failed_records"))), F.lit(0).cast("bigint")).alias(v)
        for k, v in CATEGORY_COLUMNS.items()
    ]
    warnings = F.sum(F.when(F.col("severity") == "WARNING", F.col("failed_records")))
    return quality.groupBy("run_id", "source_name").agg(
        *sums, F.coalesce(warnings, F.lit(0).cast("bigint")).alias("warning_issue_records")
    )


def quality_report(runs: DataFrame, quality: DataFrame) -> DataFrame:
    """Run metrics with their category counts."""
    zero = F.lit(0).cast("bigint")
    metrics = explode_metrics(runs).select(
        "run_id", "pipeline_name", "started_at", "pipeline_status", "source_name",
        F.coalesce("source_records", zero).alias("source_records"),
        F.coalesce("extracted_records", zero).alias("candidate_records"),
        F.coalesce("skipped_unchanged_records", zero).alias("skipped_unchanged_records"),
        F.coalesce("validated_records", zero).alias("valid_records"),
        F.coalesce("rejected_records", zero).alias("rejected_records"),
        F.coalesce("duplicate_records", zero).alias("duplicate_records"),
    )
    joined = metrics.join(category_summary(quality), ["run_id", "source_name"], "left")
    counted = [*CATEGORY_COLUMNS.values(), "warning_issue_records"]
    return joined.select(*metrics.columns, *[F.coalesce(c, zero).alias(c) for c in counted])


def quality_by_rule(runs: DataFrame, quality: DataFrame) -> DataFrame:
    """Failed records per run, source, rule, severity and field."""
    run = runs.select("run_id", "pipeline_name", "started_at", F.col("status").alias("pipeline_status"))
    keys = ["run_id", "source_name", "rule_name", "severity", "field", "category"]
    per_rule = quality.groupBy(*keys).agg(
        F.sum("failed_records").alias("failed_records"), F.max("evaluated_at").alias("evaluated_at")
    )
    return per_rule.join(run, "run_id", "inner")


def pipeline_quality(runs: DataFrame, quality: DataFrame) -> DataFrame:
    """Runs with their error and warning sums, aggregated before the join."""
    by = lambda s: F.sum(F.when(F.col("severity") == s, F.col("failed_records")))
    sums = quality.groupBy("run_id").agg(by("ERROR").alias("error_records"), by("WARNING").alias("warning_records"))
    joined = runs.join(sums, "run_id", "left")
    zero = F.lit(0).cast("bigint")
    kept = [c for c in runs.columns if c not in ("source_metrics", "report_summary", "error_message")]
    return joined.select(
        *kept, F.coalesce("error_records", zero).alias("error_records"),
        F.coalesce("warning_records", zero).alias("warning_records"),
    )


# --------------------------------------------------------------- operations


def success_rate(runs: DataFrame) -> DataFrame:
    """Share of successful runs in percent."""
    share = 100 * F.avg((F.col("status") == "SUCCESS").cast("double"))
    return runs.agg(F.coalesce(share, F.lit(0.0)).alias("success_rate"))


def source_freshness(ingestions: DataFrame) -> DataFrame:
    """Last ingestion per source."""
    return ingestions.groupBy("source_name").agg(F.max("extracted_at").alias("last_ingested_at")).orderBy("source_name")


def failed_since(runs: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Failed runs of the last days."""
    recent = F.col("started_at") >= now - F.make_dt_interval(F.lit(days))
    return runs.agg(F.count_if((F.col("status") == "FAILED") & recent).alias("failed_runs"))


def unresolved_count(stale: DataFrame) -> DataFrame:
    return stale.agg(F.count_if(F.col("resolved_at").isNull()).alias("stale_corrections"))


def latest_run(runs: DataFrame, running_first: bool = False) -> DataFrame:
    """Newest run, or the running one."""
    order = [F.desc("started_at"), F.desc("run_id")]
    if running_first:
        order.insert(0, (F.col("status") == "RUNNING").desc())
    return runs.orderBy(*order).limit(1)


def recent_runs(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Newest runs for display (I11); snapshot-only metrics are left out."""
    hidden = ("source_records", "skipped_unchanged_records", "fact_skipped_records")
    return runs.orderBy(F.desc("started_at"), F.desc("run_id")).limit(limit).drop(*hidden)


def run_stages(stages: DataFrame, run: DataFrame) -> DataFrame:
    """Stages of the given run in start order (H8)."""
    chosen = stages.join(F.broadcast(run.select("run_id").limit(1)), "run_id", "left_semi")
    return chosen.orderBy("started_at")


def run_rules(quality: DataFrame, run: DataFrame) -> DataFrame:
    """Findings of a run, largest first."""
    chosen = quality.join(F.broadcast(run.select("run_id").limit(1)), "run_id", "left_semi")
    return chosen.orderBy(F.desc("failed_records"), "source_name", "rule_name")


def performance_bundle(runs, stages, quality, ingestions, run_id: str | None = None) -> dict[str, DataFrame]:
    """Run, stages, findings and files of one run."""
    run = runs.where(F.col("run_id") == run_id) if run_id else latest_run(runs)
    one = F.broadcast(run.select("run_id").limit(1))
    return {
        "run": run, "stages": run_stages(stages, run), "quality_issues": run_rules(quality, run),
        "source_freshness": ingestions.join(one, "run_id", "left_semi").orderBy("source_name"),
    }


def quality_bundle(runs, quality, run_id: str | None = None) -> dict[str, DataFrame]:
    """Run, per-source report and per-rule report of one run."""
    run = runs.where(F.col("run_id") == run_id) if run_id else latest_run(runs)
    one = F.broadcast(run.select("run_id").limit(1))
    return {
        "run": run,
        "sources": quality_report(runs, quality).join(one, "run_id", "left_semi").orderBy("source_name"),
        "rules": quality_by_rule(runs, quality).join(one, "run_id", "left_semi").orderBy("source_name", F.desc("severity"), "rule_name"),
    }


def run_comparison(runs: DataFrame) -> DataFrame:
    """Skipped, extracted, validated and loaded rows run by run."""
    return runs.select(
        "run_id", "started_at", "source_records", "skipped_unchanged_records", "extracted_records",
        "validated_records", "loaded_records",
    ).orderBy("started_at", "run_id")


def run_durations(runs: DataFrame) -> DataFrame:
    """Seconds from start to end, else the recorded value."""
    measured = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / 1e6
    return runs.select("run_id", F.coalesce(measured, F.col("duration_seconds").cast("double")).alias("seconds"))


def override_outcomes(runs: DataFrame, validated: DataFrame) -> DataFrame:
    """A successful run the warehouse check did not confirm counts as failed."""
    marks = validated.select("run_id").distinct().withColumn("_confirmed", F.lit(True))
    joined = runs.join(marks, "run_id", "left")
    failed = (F.col("status") == "SUCCESS") & F.col("_confirmed").isNull()
    return joined.withColumn("status", F.when(failed, "FAILED").otherwise(F.col("status"))).drop("_confirmed")


def candidate_totals(runs: DataFrame) -> DataFrame:
    """Candidates per run: channels, product master, promotions, returns, all."""
    metrics = explode_metrics(runs)
    amount = F.coalesce("extracted_records", F.lit(0).cast("bigint"))
    part = lambda *names: F.coalesce(
        F.sum(F.when(F.col("source_name").isin(*names), amount)), F.lit(0).cast("bigint")
    )
    totals = metrics.groupBy("run_id").agg(
        part(*C.CHANNEL_CODES).alias("channel_candidates"), part("PRODUCT_MASTER").alias("product_candidates"),
        part("PROMO_MASTER").alias("promo_candidates"), part("RETURN_EVENTS").alias("return_candidates"),
    )
    parts = ["channel_candidates", "product_candidates", "promo_candidates", "return_candidates"]
    return totals.withColumn("total_candidates", sum((F.col(c) for c in parts[1:]), F.col(parts[0])))


def rejection_classes(reasons: DataFrame, count: str = "events") -> DataFrame:
    """Return rejections per class."""
    return reasons.groupBy(return_rejection_class(F.col("reason")).alias("class")).agg(F.sum(count).alias("events"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(n).alias("table_name"), "records") for n, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def return_metrics(judged: DataFrame) -> DataFrame:
    """Processed, valid, duplicate and rejected return rows of a delta."""
    is_a = lambda d: F.count_if(F.col("disposition") == d)
    return judged.agg(
        F.count(F.lit(1)).alias("processed"), is_a("accepted").alias("validated"), is_a("duplicate").alias("duplicates"),
        is_a("rejected").alias("rejected"),
    ).withColumn("source_name", F.lit("RETURN_EVENTS"))


def reconciliation_totals(audit: DataFrame) -> DataFrame:
    """Checked and skipped sources and switched-off rows."""
    return audit.agg(
        F.count_if(F.col("status") == "SUCCESS").alias("sources_checked"),
        F.count_if(F.col("status") == "SKIPPED").alias("sources_skipped"),
        F.coalesce(F.sum("deactivated_records"), F.lit(0).cast("bigint")).alias("deactivated_records"),
    )


def newest_raw_rows(raw: DataFrame, limit: int = 20) -> DataFrame:
    """Latest raw rows with their lineage (I16)."""
    return raw.orderBy(F.desc("loaded_at"), F.desc("source_row_number")).limit(limit)
