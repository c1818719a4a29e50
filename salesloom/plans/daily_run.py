"""The incremental load of one landing folder into the warehouse.

Order of work: promotion and return scans, raw promotion rows, channel scans,
delta, promotion check, raw rows, quality, record delta, staging, dimensions,
facts, reconciliation, returns, audit, watermarks, and last the snapshots the
next run starts from. A run that failed is run again under its own id: raw and audit rows
are partitions of the run's steps and are replaced, upserts leave the same rows.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from salesloom import contracts as C
from salesloom.functions import dates, numbers, text
from salesloom.operators import audit, delta, merge, promotions, quality as Q, returns as R, warehouse as W
from salesloom.session import cut_lineage
from salesloom.sources import files, manifest, sinks
from salesloom.sources.tables import Tables

SCHEMAS = {
    **W.DIM_SCHEMAS, **W.FACT_SCHEMAS, **W.STAGING_SCHEMAS, **audit.AUDIT_SCHEMAS,
    "raw_index": "source_name string, source_row_number bigint, ingestion_run_id string, loaded_at timestamp, raw_record_id string",
    "fact_digests": "source_name string, bucket_no int, n bigint, digest string",
}
#: Tables in parts and key buckets: column of the part, key.
KEYED = {
    "fact_sales": ("source_name", W.SALE_KEY), "stg_sales": ("source_name", W.SALE_KEY), "fact_returns": ("source_name", W.RETURN_KEY), "stg_returns": ("source_name", W.RETURN_KEY),
    "snapshot_hashes": ("source_name", ["payload_hash"]), "raw_index": ("source_name", ["source_name", "source_row_number"]),
}
RAW_COLUMNS = ["source_file", "source_row_number"]


def open_store(spark: SparkSession, root: str, buckets: int = 16) -> Tables:
    return Tables(spark, root, SCHEMAS, KEYED, buckets)


@dataclass
class Run:
    """Identity and counters of one run; ``now`` is passed in so runs can be repeated."""

    spark: SparkSession
    store: Tables
    folder: str
    run_id: str
    started: datetime
    counters: dict = field(default_factory=dict)
    stages: list = field(default_factory=list)
    clock: float = field(default_factory=time.monotonic)

    @property
    def now(self):
        return F.lit(self.started).cast("timestamp")

    def elapsed(self) -> datetime:
        """The run's start and the seconds that passed since."""
        return self.started + timedelta(seconds=time.monotonic() - self.clock)

    def stage(self, name: str, records: int = 0) -> None:
        """A stage that ends now and began where the one before it ended."""
        began, ended = self.stages[-1][4] if self.stages else self.started, self.elapsed()
        self.stages.append((self.run_id, name, "SUCCESS", began, ended, round((ended - began).total_seconds()), int(records), None))


def run_batch(spark: SparkSession, folder: str, root: str, run_id: str, now: datetime, buckets: int = 16) -> dict:
    """Load what changed in ``folder`` since the last successful run; returns the run's counters."""
    run = Run(spark, open_store(spark, root, buckets), folder, run_id, now)
    try:
        _load(run)
    except Exception as error:
        _write_run(run, "FAILED", str(error))
        raise
    return run.counters


def _snapshots(run: Run) -> dict:
    rows = run.store.read("source_snapshots").collect()  # one row per source
    return {r["source_name"]: r.asDict() for r in rows}


def _hashes(run: Run, name: str) -> DataFrame:
    return run.store.read("snapshot_hashes", name).select("payload_hash")


def _load(run: Run) -> None:
    spark, store = run.spark, run.store
    snapshots = _snapshots(run)
    declared = manifest.load_manifest(spark, run.folder)
    promo = files.scan_promotions(spark, run.folder)
    old_promo = snapshots.get("PROMO_MASTER") or {}
    promo_changed = old_promo.get("file_checksum_sha256") != promo.checksum
    stale_keys = delta.stale_return_keys(store.read("stale_corrections"))
    has_stale = not stale_keys.isEmpty()
    returns = files.scan_returns(spark, run.folder, None if has_stale else snapshots.get("RETURN_EVENTS"))
    promo_delta = _changed(promo, _hashes(run, "PROMO_MASTER")) if promo_changed else None
    if promo_delta is not None:
        _append_raw(run, promo, promo_delta)
    run.stage("promotion_scan")

    force = promo_changed or any(d.is_reconcilable for d in declared.values())
    channels = files.scan_channels(spark, run.folder, snapshots, force)
    product = files.scan_products(spark, run.folder)
    deltas, counts = {}, {}
    for key, source in channels.items():
        rows = _canonical(source, key)
        known = _hashes(run, source.name)
        deltas[key] = cut_lineage(delta.changed_rows(rows, known)) if not source.unchanged else rows
        counts[key] = deltas[key].count()
    product_delta = cut_lineage(_changed(product, _hashes(run, "PRODUCT_MASTER")))
    counts["product"] = product_delta.count()
    return_delta = cut_lineage(delta.changed_returns(returns.frame, _hashes(run, "RETURN_EVENTS"), stale_keys if has_stale else None))
    return_count = return_delta.count()
    run.stage("incremental_extract", sum(counts.values()))
    channel_count = sum(n for k, n in counts.items() if k != "product")
    run.counters.update(
        source_records=sum(s.records for s in channels.values()), extracted_records=channel_count,
        skipped_unchanged_records=sum(s.records for s in channels.values()) - channel_count,
        product_candidates=counts["product"], return_candidates=return_count,
    )
    sources = [*channels.values(), product, promo, returns]
    reconcilable = {code for code, d in declared.items() if d.is_reconcilable}
    if not sum(counts.values()) and not promo_changed and not return_count:
        deactivated = _reconcile(run, channels, declared) if reconcilable else 0
        _finish(run, sources, snapshots, deactivated_records=deactivated, outcome="no change")
        return

    catalogue = promotions.valid_catalogue(promotions.read_catalogue(promo.frame))
    if promo_changed or channel_count:
        scanned = [_canonical(s, k) for k, s in channels.items() if not s.unchanged]
        if scanned:
            checked = promotions.check_line_promotions(_typed_lines(_union(scanned)), catalogue)
            promotions.require_valid_promotions(checked)
        run.stage("promotion_validation")

    raw_written = 0
    for key, source in channels.items():
        if counts[key]:
            raw_written += counts[key]
            native = source.frame.join(deltas[key].select(*RAW_COLUMNS), RAW_COLUMNS, "left_semi")
            _append_raw(run, source, native)
    if counts["product"]:
        _append_raw(run, product, product_delta)
    if return_count:
        _append_raw(run, returns, return_delta)
    run.stage("raw_load", raw_written)

    products = cut_lineage(Q.analyze_products(product.frame))
    clean_products = Q.QualityResult(products, product.frame).clean
    lookup = Q.product_lookup(clean_products)
    analyzed = cut_lineage(Q.analyze_sales(_union(list(deltas.values())), lookup))
    totals = analyzed.agg(
        *[F.count_if(F.col("disposition") == d).alias(d) for d in ("clean", "duplicate", "rejected")]
    ).first()
    run.counters.update(valid_records=totals["clean"], duplicate_records=totals["duplicate"], invalid_records=totals["rejected"])
    run.stage("validate", totals["clean"])

    result = Q.QualityResult(analyzed, analyzed)
    staged = W.to_staging(result.clean)
    staged = cut_lineage(staged)
    facts = store.read("fact_sales", places=store.places("fact_sales", staged))
    staged = delta.changed_records(staged, facts, store.read("stale_corrections"))
    index = store.read("raw_index", places=store.places("raw_index", staged))
    staged = cut_lineage(W.with_raw_lineage(staged, index, run.run_id))
    split = staged.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_new").alias("new")).first()
    run.counters.update(incremental_records=split["n"], fact_inserted_records=split["new"], fact_skipped_records=max(totals["clean"] - split["n"], 0))
    staging_rows = staged.drop("is_new")
    store.change("stg_sales", staging_rows, lambda old, new: W.merge_staging(old, new, run.run_id, run.now))
    run.counters["staged_records"] = split["n"]

    dims = _load_dimensions(run, clean_products, product_delta, staging_rows, catalogue if promo_changed else None)
    run.counters["loaded_records"] = _load_facts(run, staging_rows, dims)
    store.replace("stale_corrections", delta.resolve_corrections(store.read("stale_corrections"), staging_rows, run.run_id, run.now))
    deactivated = _reconcile(run, channels, declared)
    returned = _load_returns(run, return_delta) if return_count else {}
    _quality_audit(run, [products, analyzed], result)
    _watermarks(run, [products, analyzed])
    _finish(run, sources, snapshots, deactivated_records=deactivated, outcome="loaded", **returned)


def _canonical(source: files.LandedSource, key: str) -> DataFrame:
    frame = source.frame
    for column in C.CHANNELS[key].required_columns:
        if column not in frame.columns:
            frame = frame.withColumn(column, F.lit(""))
    return Q.canonical_rows(frame, key)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _changed(source: files.LandedSource, known: DataFrame) -> DataFrame:
    marked = delta.mark_changed(source.frame, known, None, ["source_row_number"])
    return marked.where("is_changed").select(*source.frame.columns)


def _typed_lines(rows: DataFrame) -> DataFrame:
    """Channel rows with the typed fields the promotion check needs."""
    wanted = ("promo_code", "discount_amount", "order_date", "quantity", "unit_price")
    cleaned = text.with_clean_text(rows.select("source", "source_row_number", *wanted), {c: c for c in wanted})
    return cleaned.selectExpr(
        "source", "source_row_number", "upper(promo_code) AS promo_code",
        f"{numbers.nonnegative_sql('discount_amount')}.raw AS discount_amount",
        f"{dates.date_sql('order_date', 'source')} AS order_date",
        f"{numbers.integer_sql('quantity')}.raw AS quantity", f"{numbers.money_sql('unit_price')}.raw AS unit_price",
    )


def _append_raw(run: Run, source: files.LandedSource, rows: DataFrame) -> None:
    """Raw rows of a source (B1-B3) and their entry; channel rows advance the index of latest records (F16, H5)."""
    seen = Observation()
    landed = sinks.raw_rows(rows, list(source.columns), run.run_id, run.now)
    run.store.log(source.raw_table, landed.observe(seen, F.count(F.lit(1)).alias("n")), run.run_id, source.key)
    entry = [(run.run_id, source.name, source.path.split("/")[-1], source.path, source.checksum, source.file_format, int(seen.get["n"]), run.started)]
    run.store.log("source_ingestions", run.spark.createDataFrame(entry, SCHEMAS["source_ingestions"]), run.run_id, source.key)
    if source.key in C.CHANNELS:
        written = run.store.read_log(source.raw_table, run.run_id)
        fresh = written.select(F.lit(source.name).alias("source_name"), "source_row_number", "ingestion_run_id", "loaded_at", "raw_record_id")
        run.store.change("raw_index", W.latest_raw(fresh), W.advance_raw_index)


def _load_dimensions(run, clean_products, product_delta, staged, catalogue) -> dict[str, DataFrame]:
    store = run.store
    changed = clean_products.join(product_delta.select("source_row_number"), "source_row_number", "left_semi")
    merged = {
        "dim_channel": W.merge_channels(store.read("dim_channel"), W.channel_members(run.spark)),
        "dim_product": W.merge_products(store.read("dim_product"), changed),
        "dim_date": W.merge_dates(store.read("dim_date"), staged),
        "dim_customer": W.merge_customers(store.read("dim_customer"), staged),
        "dim_payment": W.merge_payments(store.read("dim_payment"), staged),
    }
    if catalogue is not None:
        merged["dim_promotion"] = W.merge_promotions(store.read("dim_promotion"), catalogue)
    tables = {name: store.replace(name, df) for name, df in merged.items()}
    run.stage("dimension_load")
    return tables


def _load_facts(run: Run, staged: DataFrame, dims: dict[str, DataFrame]) -> int:
    """Merge the buckets of the staged keys, and no others."""
    seen = Observation()
    places = run.store.change("fact_sales", staged, lambda old, new: W.merge_sales_facts(old, new, dims, run.now).observe(seen, F.count_if(F.col("merge_action") != "keep").alias("n")))
    written = int(seen.get["n"]) if places else 0
    _digest_facts(run, places)
    run.stage("fact_load", written)
    return written


def _digest_facts(run: Run, places: list) -> None:
    """Digests of the active keys of fact buckets that were written, read back by key."""
    if not places:
        return
    store = run.store
    fresh = delta.key_digests(store.read("fact_sales", places=places).where("is_source_active"), store.buckets).withColumnRenamed("bucket", "bucket_no")
    touched = run.spark.createDataFrame(places, "source_name string, bucket_no int")
    others = store.read("fact_digests").join(F.broadcast(touched), ["source_name", "bucket_no"], "left_anti")
    store.replace("fact_digests", others.unionByName(fresh))


def _reconcile(run: Run, channels: dict, declared: dict) -> int:
    """Switch off facts that complete snapshots lack (K5, K6, F11): digests first, then only the buckets that differ."""
    spark, store = run.spark, run.store
    keys = delta.snapshot_keys(_union([_canonical(s, k) for k, s in channels.items() if declared[s.name].is_reconcilable] or [_canonical(next(iter(channels.values())), next(iter(channels))).limit(0)]))
    expected = spark.createDataFrame([(s.name, s.records) for s in channels.values()], "source_name string, source_records bigint")
    status = cut_lineage(delta.snapshot_status(keys, manifest.declaration_rows(spark, declared), expected))
    complete = status.where("status = 'SUCCESS'").select("source_name")
    ours = store.read("fact_digests").withColumnRenamed("bucket_no", "bucket")
    differ = delta.differing_buckets(ours, delta.key_digests(delta.present_keys(keys), store.buckets)).join(F.broadcast(complete), "source_name", "left_semi")
    places = [(r["source_name"], r["bucket"]) for r in differ.collect()]  # at most channels times buckets
    gone = cut_lineage(delta.missing_facts(store.read("fact_sales", places=places), keys, status))
    counts = gone.groupBy("source_name").agg(F.count(F.lit(1)).alias("deactivated_records"))
    audited = status.join(F.broadcast(counts), "source_name", "left").withColumn("deactivated_records", F.coalesce("deactivated_records", F.lit(0)))
    store.log("reconciliations", audited.withColumns({"run_id": F.lit(run.run_id), "reconciled_at": run.now}), run.run_id, "all")
    total = gone.count()
    if total:
        _digest_facts(run, store.change("fact_sales", gone, delta.deactivate))
    run.stage("source_reconciliation", total)
    return total


def _load_returns(run: Run, rows: DataFrame) -> dict:
    store = run.store
    judged = cut_lineage(R.judge_returns(rows, store.read("fact_sales"), store.read("fact_returns")))
    accepted = judged.where("disposition = 'accepted'")
    rejected = judged.where("disposition = 'rejected'")
    counts = {r["disposition"]: r["count"] for r in judged.groupBy("disposition").count().collect()}
    store.change("stg_returns", accepted, lambda old, new: W.merge_staging(old, new, run.run_id, run.now, W.RETURN_KEY, with_run=False))
    places = store.places("fact_returns", accepted)
    merged = cut_lineage(W.merge_return_facts(store.read("fact_returns", places=places), accepted, run.run_id, run.now))
    actions = merge.merge_counts(merged)
    raw = rows.join(rejected.select("source_row_number", F.col("reason").alias("rejection_reason")), "source_row_number")
    found = delta.return_corrections(raw, store.read("fact_returns"))
    stale = delta.open_corrections(store.read("stale_corrections"), found, run.run_id, run.now)
    stale = delta.resolve_corrections(stale, delta.resolved_by_returns(accepted), run.run_id, run.now)
    store.replace("stale_corrections", cut_lineage(stale))
    store.write("fact_returns", merged, places)
    store.log("rejected_records", audit.return_rejected_audit(rejected).withColumns({"run_id": F.lit(run.run_id), "rejected_at": run.now}), run.run_id, "returns")
    n_rejected = counts.get("rejected", 0)
    if n_rejected:
        finding = [(run.run_id, "RETURN_EVENTS", "INVALID_RETURN_EVENT", "ERROR", None, "return_event", n_rejected, run.started)]
        store.log("quality_results", run.spark.createDataFrame(finding, SCHEMAS["quality_results"]), run.run_id, "returns")
    run.stage("return_fact_load", actions["inserted"] + actions["updated"])
    return {
        "return_valid": counts.get("accepted", 0), "return_rejected": n_rejected, "return_duplicates": counts.get("duplicate", 0),
        "return_inserted": actions["inserted"], "return_updated": actions["updated"],
    }


def _save_snapshots(run: Run, sources: list, previous: dict) -> None:
    """Checksum, row count and distinct payload hashes (B14); of the hashes only what came or went is written."""
    store, rows = run.store, []
    for source in sources:
        rows.append((source.name, source.checksum, source.records, run.run_id, run.started))
        old = previous.get(source.name) or {}
        if old.get("file_checksum_sha256") != source.checksum:
            current = source.frame.select(F.lit(source.name).alias("source_name"), "payload_hash")
            store.change("snapshot_hashes", delta.hash_changes(store.read("snapshot_hashes", source.name), current), delta.apply_hash_changes)
    store.replace("source_snapshots", run.spark.createDataFrame(rows, SCHEMAS["source_snapshots"]))


def _quality_audit(run: Run, annotated: list[DataFrame], sales: Q.QualityResult) -> None:
    store, stamp = run.store, {"run_id": F.lit(run.run_id)}
    for step, frame in zip(("product", "sales"), annotated):
        findings = audit.rule_counts(Q.issue_rows(frame))
        store.log("quality_results", findings.withColumns({**stamp, "evaluated_at": run.now}), run.run_id, step)
        rejected = audit.rejected_audit(Q.QualityResult(frame, frame).rejected)
        store.log("rejected_records", rejected.withColumns({**stamp, "rejected_at": run.now}), run.run_id, step)
    refused = cut_lineage(audit.rejected_audit(sales.rejected))
    known = store.read("fact_sales", places=store.places("fact_sales", refused.where("source_order_id IS NOT NULL AND source_line_number IS NOT NULL")))
    found = delta.sales_corrections(refused, known)
    store.replace("stale_corrections", delta.open_corrections(store.read("stale_corrections"), found, run.run_id, run.now))


def _watermarks(run: Run, annotated: list[DataFrame]) -> None:
    """Valid record count per source, as the last processed key."""
    counts = _union([Q.quality_summary(f).select(audit.result_source_name().alias("source_name"), "valid_records") for f in annotated])
    new = counts.select(
        F.lit(C.PIPELINE_NAME).alias("pipeline_name"), "source_name", F.lit(run.run_id).alias("last_successful_run_id"),
        run.now.alias("last_processed_at"), F.col("valid_records").cast("string").alias("last_business_key"),
    )
    merged = merge.merge_upsert(run.store.read("watermarks"), new, ["pipeline_name", "source_name"])
    run.store.replace("watermarks", merged)


def _finish(run: Run, sources: list, previous: dict, **extra) -> None:
    """Last the snapshots: until then the next run starts where this one did."""
    run.counters.update(extra)
    _save_snapshots(run, sources, previous)
    run.store.log("stage_runs", run.spark.createDataFrame(run.stages, SCHEMAS["stage_runs"].replace("decimal(12,3)", "int")), run.run_id, "all")
    _write_run(run, "SUCCESS", None)


def _write_run(run: Run, status: str, error: str | None) -> None:
    c = run.counters
    names = [f.name for f in run.spark.createDataFrame([], SCHEMAS["pipeline_runs"]).schema.fields]
    values = {
        **{n: int(c[n]) for n in names if n in c}, "run_id": run.run_id, "pipeline_name": C.PIPELINE_NAME, "started_at": run.started,
        "ended_at": run.elapsed(), "status": status, "error_message": error, "report_summary": json.dumps(c, default=str),
        "validated_records": c.get("valid_records"), "rejected_records": c.get("invalid_records"),
    }
    row = [tuple(values.get(n) for n in names)]
    run.store.log("pipeline_runs", run.spark.createDataFrame(row, SCHEMAS["pipeline_runs"]), run.run_id, "all")


def warehouse_detail(store: Tables) -> DataFrame:
    """The reporting view of a store, in the column names the KPI builders take."""
    dims = {n: store.read(n) for n in W.DIM_SCHEMAS}
    return W.sales_detail(store.read("fact_sales"), dims, store.read("fact_returns"))
