"""What changed since the last successful snapshot, and snapshot reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesloom import contracts as C
from salesloom.functions import numbers, text
from salesloom.operators.skew import HOT_ROWS, annotate_keys, lookup_left_join
from salesloom.session import cut_lineage


def mark_changed(
    rows: DataFrame, known_hashes: DataFrame, key: list[str] | None, spread_on: list[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Flags ``is_changed`` (payload not in the last snapshot) and ``is_selected``.

    Rows that share a business key with a changed row are selected too, so a
    conflict with an unchanged version is seen (K1, H7). ``known_hashes`` has
    one row per hash and, when present, the same ``source`` column.
    """
    on = [c for c in ("source", "payload_hash") if c in known_hashes.columns]
    known = known_hashes.select(*on).distinct().withColumn("_known", F.lit(True))
    marked = lookup_left_join(rows, known, on, spread_on, hot_rows)
    marked = marked.withColumn("is_changed", F.col("_known").isNull()).drop("_known")
    if not key:
        return marked.withColumn("is_selected", F.col("is_changed"))
    marked = cut_lineage(marked)  # read by the per-key aggregate and by the join back
    keyed = annotate_keys(marked, key, {"_sibling": F.max("is_changed")}, spread_on, hot_rows=hot_rows)
    selected = F.col("is_changed") | F.coalesce("_sibling", F.lit(False))
    return keyed.select(*marked.columns, selected.alias("is_selected"))


def raw_key_columns(rows: DataFrame) -> DataFrame:
    """Cleaned key texts used to find siblings of a changed row."""
    return rows.withColumns({"_key_order": text.clean_text("order_id"), "_key_line": text.clean_text("line_number")})


def changed_rows(rows: DataFrame, known_hashes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Delta of canonical channel rows with their siblings (K1, H7): the changed rows, and the others that share a key with one.

    Only the changed rows are stored; the others meet their keys in a semi join.
    """
    keyed = raw_key_columns(rows)
    key = ["source", "_key_order", "_key_line"]
    marked = mark_changed(keyed, known_hashes, None, ["source", "source_row_number"], hot_rows)
    changed = cut_lineage(marked.where("is_changed").select(*keyed.columns))
    keys = changed.select(*key).dropna().distinct()
    siblings = marked.where("NOT is_changed").join(keys, key, "left_semi")
    return changed.select(*rows.columns).unionByName(siblings.select(*rows.columns))


def hash_changes(known: DataFrame, current: DataFrame) -> DataFrame:
    """Hashes that came or went since the last snapshot, with ``gone`` (B14): what its state has to be changed by."""
    both = known.select("source_name", "payload_hash", F.lit(True).alias("_old")).join(
        current.select("source_name", "payload_hash").distinct().withColumn("_new", F.lit(True)), ["source_name", "payload_hash"], "full_outer"
    )
    return both.where("_old IS NULL OR _new IS NULL").select("source_name", "payload_hash", F.col("_new").isNull().alias("gone"))


def apply_hash_changes(known: DataFrame, changes: DataFrame) -> DataFrame:
    gone = changes.where("gone").select("source_name", "payload_hash")
    return known.join(gone, ["source_name", "payload_hash"], "left_anti").unionByName(changes.where("NOT gone").select("source_name", "payload_hash"))


def changed_returns(
    rows: DataFrame, known_hashes: DataFrame, stale_keys: DataFrame | None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Changed return rows plus unchanged ones whose correction is unresolved (K2)."""
    marked = mark_changed(rows, known_hashes, None, ["source_row_number"], hot_rows)
    if stale_keys is None:
        return marked.where("is_changed").select(*rows.columns)
    keyed = marked.withColumns(
        {
            "_s": text.channel_code("source_name"), "_i": text.clean_text("return_id"),
            "_l": numbers.line_number(text.unmarked_sql(text.tidy_sql("return_line_number"))),
        }
    )
    stale = stale_keys.select(
        F.col("source_name").alias("_s"), F.col("return_id").alias("_i"),
        F.col("return_line_number").alias("_l"), F.lit(True).alias("_stale"),
    ).distinct()
    joined = lookup_left_join(keyed, stale, ["_s", "_i", "_l"], ["source_row_number"], hot_rows)
    return joined.where(F.col("is_changed") | F.col("_stale").isNotNull()).select(*rows.columns)


def changed_records(
    staged: DataFrame, facts: DataFrame, stale: DataFrame | None = None, compare_hash: bool = True
) -> DataFrame:
    """Valid rows to load (K4, F9): unknown key, different hash, inactive fact or open stale correction.

    ``is_new`` tells inserts from corrections (K13). With ``compare_hash=False``
    only unknown keys pass.
    """
    key = ["source_name", "source_order_id", "source_line_number"]
    current = facts.select(
        *key, F.lit(True).alias("_exists"),
        F.when(F.col("is_source_active"), F.col("source_record_hash")).alias("_old_hash"),
    )
    if stale is not None:
        open_keys = stale.where("resolved_at IS NULL").select(*key).distinct()
        current = current.join(open_keys.withColumn("_open", F.lit(True)), key, "left")
        current = current.withColumn("_old_hash", F.when(F.col("_open").isNull(), F.col("_old_hash"))).drop("_open")
    joined = staged.join(current, key, "left").withColumn("is_new", F.col("_exists").isNull())
    different = ~F.col("source_record_hash").eqNullSafe(F.col("_old_hash"))
    wanted = F.col("is_new") | (different if compare_hash else F.lit(False))
    return joined.where(wanted).select(*staged.columns, "is_new")


# ----------------------------------------------------------- reconciliation


def is_reconcilable(mode: Column, scope: Column, timestamp: Column, completeness: Column) -> Column:
    """A declared complete snapshot of all history."""
    return (
        mode.eqNullSafe(F.lit("FULL_SNAPSHOT")) & scope.eqNullSafe(F.lit("ALL_HISTORY"))
        & timestamp.isNotNull() & completeness.eqNullSafe(F.lit("COMPLETE"))
    )


def snapshot_keys(rows: DataFrame) -> DataFrame:
    """Business keys of canonical rows with ``key_problem`` where a row cannot be identified (K5)."""
    order, line = text.clean_text("order_id"), text.clean_text("line_number")
    keyed = rows.select("source", order.alias("source_order_id"), line.alias("_line"))
    digits = F.coalesce(F.col("_line").rlike(r"^\d+\z"), F.lit(False))
    number = numbers.line_number("_line")
    problem = F.when(F.col("source_order_id").isNull() | ~digits, "key").when(number.isNull(), "range")
    return keyed.select(
        "source", "source_order_id", number.alias("source_line_number"), problem.alias("key_problem")
    )


def snapshot_status(keys: DataFrame, declarations: DataFrame, expected: DataFrame) -> DataFrame:
    """One row per source: reconcile or skip, why, and how many keys were seen.

    ``declarations`` has source_name and the four declaration columns,
    ``expected`` source_name and source_records (rows the file holds).
    """
    per_key = keys.groupBy("source", "source_order_id", "source_line_number", "key_problem").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    seen = per_key.groupBy("source").agg(
        F.sum("_rows").alias("_scanned"), F.count_if(F.col("key_problem").isNull()).alias("_keys"),
        F.max(F.col("key_problem") == "key").alias("_bad_key"), F.max(F.col("key_problem") == "range").alias("_bad_range"),
    )
    codes = F.create_map(*[F.lit(x) for k, c in C.CHANNELS.items() for x in (k, c.code)])
    seen = seen.withColumn("source_name", codes[F.col("source")]).drop("source")
    joined = declarations.join(expected, "source_name", "left").join(seen, "source_name", "left")
    declared = is_reconcilable(
        F.col("ingestion_mode"), F.col("snapshot_scope"), F.col("snapshot_timestamp"), F.col("snapshot_completeness")
    )
    scanned = F.coalesce("_scanned", F.lit(0))
    records = F.coalesce("source_records", scanned)
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    skip = (
        F.when(~declared, C.RECONCILE_SKIPS["declaration"])
        .when(scanned != records, C.RECONCILE_SKIPS["partial"])
        .when(flag("_bad_key"), C.RECONCILE_SKIPS["key"])
        .when(flag("_bad_range"), C.RECONCILE_SKIPS["range"])
    )
    return joined.select(
        "source_name", "ingestion_mode", "snapshot_scope", "snapshot_timestamp", "snapshot_completeness",
        F.when(skip.isNull(), "SUCCESS").otherwise("SKIPPED").alias("status"),
        records.cast("bigint").alias("source_records"),
        F.when(skip.isNull(), F.coalesce("_keys", F.lit(0))).otherwise(F.lit(0)).cast("bigint").alias("observed_business_keys"),
        skip.alias("detail"),
    )


def present_keys(keys: DataFrame) -> DataFrame:
    """Distinct identified keys of a snapshot, under the channel's name."""
    codes = F.create_map(*[F.lit(x) for k, c in C.CHANNELS.items() for x in (k, c.code)])
    found = keys.where("key_problem IS NULL").select(codes[F.col("source")].alias("source_name"), "source_order_id", "source_line_number")
    return found.distinct()


def key_digests(rows: DataFrame, buckets: int) -> DataFrame:
    """(source_name, bucket, n, digest): an order-free digest of the distinct keys of each bucket, two sums of 64-bit hashes and their count.

    Sums are combined before the shuffle; at most channels times buckets rows come out.
    """
    key = ["source_name", "source_order_id", "source_line_number"]
    sums = [F.sum(F.xxhash64(*extra, *key).cast("decimal(38,0)")) for extra in ([], [F.lit(7)])]
    grouped = rows.select(*key, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")).groupBy("source_name", "bucket")
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.concat_ws(":", *[s.cast("string") for s in sums]).alias("digest"))


def differing_buckets(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(source_name, bucket) of the buckets whose keys are not the same in both."""
    on = ["source_name", "bucket"]
    both = ours.select(*on, F.col("digest").alias("_a"), F.col("n").alias("_n")).join(theirs.select(*on, F.col("digest").alias("_b"), F.col("n").alias("_m")), on, "full_outer")
    same = (F.coalesce("_n", F.lit(0)) == F.coalesce("_m", F.lit(0))) & (F.coalesce("_a", F.lit("")) == F.coalesce("_b", F.lit("")))
    return both.where(~same).select(*on)


def missing_facts(facts: DataFrame, keys: DataFrame, status: DataFrame) -> DataFrame:
    """Keys of active facts that a complete snapshot no longer holds."""
    key = ["source_name", "source_order_id", "source_line_number"]
    complete = status.where("status = 'SUCCESS'").select("source_name")
    active = facts.where("is_source_active").select(*key).join(F.broadcast(complete), "source_name", "left_semi")  # one row per channel
    return active.join(present_keys(keys), key, "left_anti")


def deactivate(facts: DataFrame, gone: DataFrame) -> DataFrame:
    """Facts with ``is_source_active`` cleared for the keys that are gone (K6); ``_deactivated`` marks them."""
    key = ["source_name", "source_order_id", "source_line_number"]
    joined = facts.join(gone.select(*key, F.lit(True).alias("_gone")), key, "left").withColumn("_deactivated", F.col("_gone").isNotNull() & F.col("is_source_active"))
    columns = [(F.col(c) & ~F.col("_deactivated")).alias(c) if c == "is_source_active" else F.col(c) for c in facts.columns]
    return joined.select(*columns, "_deactivated")


def reconcile_facts(facts: DataFrame, keys: DataFrame, status: DataFrame) -> DataFrame:
    """Facts with ``is_source_active`` cleared where a complete snapshot no longer holds them.

    ``_deactivated`` marks the rows this run switched off.
    """
    return deactivate(facts, missing_facts(facts, keys, status))


def reconcile_differing(facts: DataFrame, keys: DataFrame, status: DataFrame, buckets: int) -> DataFrame:
    """reconcile_facts() by digests: only buckets whose active facts differ from the snapshot are joined, the others pass."""
    place = F.pmod(F.xxhash64("source_name", "source_order_id", "source_line_number"), F.lit(buckets)).cast("int")
    differ = differing_buckets(key_digests(facts.where("is_source_active"), buckets), key_digests(present_keys(keys), buckets))
    differ = cut_lineage(differ.join(F.broadcast(status.where("status = 'SUCCESS'").select("source_name")), "source_name", "left_semi"))
    places = F.broadcast(differ.withColumn("_differs", F.lit(True)))  # at most channels times buckets rows
    split = facts.withColumn("bucket", place).join(places, ["source_name", "bucket"], "left")
    same = split.where("_differs IS NULL").select(*facts.columns, F.lit(False).alias("_deactivated"))
    return same.unionByName(reconcile_facts(split.where("_differs").select(*facts.columns), keys, status))


def reconciliation_audit(status: DataFrame, reconciled: DataFrame) -> DataFrame:
    """Audit row per source with the number of facts switched off."""
    counts = reconciled.where("_deactivated").groupBy("source_name").agg(F.count(F.lit(1)).alias("deactivated_records"))
    return status.join(counts, "source_name", "left").withColumn(
        "deactivated_records", F.coalesce("deactivated_records", F.lit(0).cast("bigint"))
    )


# --------------------------------------------------------- stale corrections


def sales_corrections(rejected: DataFrame, facts: DataFrame) -> DataFrame:
    """Rejected corrections of an existing fact (F12, K8), one row per key: the last rejected version.

    ``rejected`` carries source_name, source_order_id, source_line_number,
    source_row_number, rejection_reason.
    """
    key = ["source_name", "source_order_id", "source_line_number"]
    latest = (
        rejected.where("source_order_id IS NOT NULL AND source_line_number IS NOT NULL")
        .groupBy(*key)
        .agg(F.max(F.struct("source_row_number", "rejection_reason")).alias("_last"))
    )
    return latest.join(facts.select(*key), key, "left_semi").select(*key, "_last.*")


def return_corrections(rejected: DataFrame, return_facts: DataFrame) -> DataFrame:
    """Rejected return rows that correct a booked event.

    A row with an unknown channel or an unusable line number matches any. The
    rows are first combined per (id, channel, line), so a heavily repeated id
    meets its facts once; each pattern joins on its known columns only.
    """
    source = F.upper(F.trim(F.coalesce("source_name", F.lit(""))))
    source = F.when(source == "OFFLINE", "OFFLINE_STORE").otherwise(source)
    patterns = rejected.select(
        F.when(source.isin(*C.CHANNEL_CODES), source).alias("_p_source"),
        F.trim("return_id").alias("_p_id"),
        numbers.line_number("trim(return_line_number)").alias("_p_line"),
        "source_row_number", "rejection_reason",
    ).where(F.col("_p_id") != "")
    combined = patterns.groupBy("_p_source", "_p_id", "_p_line").agg(
        F.max(F.struct("source_row_number", "rejection_reason")).alias("_last")
    )
    fact = return_facts.select("source_name", "return_id", "return_line_number")
    key = ["source_name", "return_id", "return_line_number"]
    matches = None
    for by_source in (True, False):
        for by_line in (True, False):
            part = combined.where(
                (F.col("_p_source").isNotNull() if by_source else F.col("_p_source").isNull())
                & (F.col("_p_line").isNotNull() if by_line else F.col("_p_line").isNull())
            )
            on = [F.col("_p_id") == F.col("return_id")]
            on += [F.col("_p_source") == F.col("source_name")] if by_source else []
            on += [F.col("_p_line") == F.col("return_line_number")] if by_line else []
            found = fact.join(part, on, "inner").select(*key, "_last")
            matches = found if matches is None else matches.unionByName(found)
    last = matches.groupBy(*key).agg(F.max("_last").alias("_last"))
    return last.select(
        F.lit("RETURN_EVENTS").alias("source_name"),
        F.concat_ws(":", "source_name", "return_id").alias("source_order_id"),
        F.col("return_line_number").alias("source_line_number"), "_last.*",
    )


def resolved_by_returns(accepted: DataFrame) -> DataFrame:
    """Stale keys an accepted return event settles."""
    return accepted.select(
        F.lit("RETURN_EVENTS").alias("source_name"), F.concat_ws(":", "source_name", "return_id").alias("source_order_id"),
        F.col("return_line_number").alias("source_line_number"),
    ).distinct()


def open_corrections(stale: DataFrame, found: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Upsert of new findings into the stale table: they are (re)opened."""
    from salesloom.operators.merge import merge_upsert

    key = ["source_name", "source_order_id", "source_line_number"]
    reopened = {
        "rejected_run_id": F.lit(run_id), "rejected_at": now, "updated_at": now,
        "resolved_at": F.lit(None), "resolved_run_id": F.lit(None),
    }
    merged = merge_upsert(stale, found, key, on_insert=reopened, on_update=reopened)
    return merged.drop("merge_action")


def resolve_corrections(stale: DataFrame, settled: DataFrame, run_id: str, now: Column) -> DataFrame:
    """Close open corrections whose key was validly submitted again."""
    key = ["source_name", "source_order_id", "source_line_number"]
    marks = settled.select(*key).distinct().withColumn("_settled", F.lit(True))
    joined = stale.join(marks, key, "left")
    closes = F.col("_settled").isNotNull() & F.col("resolved_at").isNull()
    values = {"resolved_at": now, "resolved_run_id": F.lit(run_id), "updated_at": now}
    return joined.select(
        *[
            (F.when(closes, values[f.name]).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name) if f.name in values else F.col(f.name))
            for f in stale.schema.fields
        ]
    )


def stale_return_keys(stale: DataFrame) -> DataFrame:
    """Open stale return keys, ``CHANNEL:id`` taken apart at the first colon."""
    key = F.col("source_order_id")
    at = F.instr(key, ":")
    return stale.where("source_name = 'RETURN_EVENTS' AND resolved_at IS NULL").where((at > 0) & (F.length(key) > at)).select(
        F.substring_index(key, ":", 1).alias("source_name"), F.expr("substring(source_order_id, instr(source_order_id, ':') + 1)").alias("return_id"),
        F.col("source_line_number").alias("return_line_number"),
    )


def stale_listing(stale: DataFrame, limit: int | None = 100) -> DataFrame:
    """Unresolved corrections for display (C20): the newest, or all of them, unordered, without a limit."""
    is_return = F.col("source_name") == "RETURN_EVENTS"
    rows = (
        stale.where("resolved_at IS NULL")
        .select(
            F.when(is_return, F.concat(F.lit("Return / "), F.substring_index("source_order_id", ":", 1))).otherwise(F.col("source_name")).alias("source_name"),
            F.when(is_return, F.expr("substring(source_order_id, instr(source_order_id, ':') + 1)")).otherwise(F.col("source_order_id")).alias("source_order_id"),
            F.when(is_return, "RETURN").otherwise("SALES").alias("record_type"),
            "source_line_number", "rejected_run_id", "source_row_number", "rejection_reason", "rejected_at",
        )
    )
    return rows if limit is None else rows.orderBy(F.col("rejected_at").desc()).limit(limit)
