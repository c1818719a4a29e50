"""Writers: raw landing, CSV bundles and landing-file batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from salesloom import contracts as C
from salesloom.operators import quality as Q
from salesloom.operators.merge import replace_keys


def with_payload(rows: DataFrame, columns) -> DataFrame:
    """Raw rows with their original cells as a JSON payload; empty cells stay ''."""
    return rows.withColumn("source_payload", F.to_json(F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) if c not in C.OPTIONAL_FIELDS else F.col(c) for c in columns])))


def raw_rows(rows: DataFrame, columns, run_id: str, now) -> DataFrame:
    """Append form of a raw table (B1-B3): run, file, row number, cells, payload."""
    landed = with_payload(rows, columns).withColumns({"ingestion_run_id": F.lit(run_id), "loaded_at": now})
    return landed.select(
        "ingestion_run_id", "source_file", "source_row_number", "source_sha256", *columns, "source_payload",
        F.concat_ws("/", "ingestion_run_id", "source_file", F.col("source_row_number").cast("string")).alias("raw_record_id"),
        "loaded_at",
    )


def write_csv(df: DataFrame, path: str, quote_all: bool = False, compression: str = "none") -> None:
    """CSV folder with header, ISO dates, doubled quotes, cells as they are; one part file per partition."""
    flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
    writer = flat.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", compression)
    writer.option("quote", '"').option("escape", '"').option("quoteAll", quote_all).option("emptyValue", "").csv(path)


def write_quality_bundle(results: dict[str, Q.QualityResult], target: str, source_dir: str) -> None:
    """Per source the five evidence frames, plus the combined summary, sales and manifest."""
    _refuse_overlap(target, source_dir)
    for source, result in results.items():
        for label in ("clean", "rejected", "duplicates", "issues", "profile"):
            write_csv(getattr(result, label), f"{target}/{source}_{label}")
    summaries = reduce(DataFrame.unionByName, [r.summary for r in results.values()])
    write_csv(summaries, f"{target}/summary")
    sales = [r.clean for s, r in results.items() if s != "product"]
    if sales:
        write_csv(reduce(DataFrame.unionByName, sales), f"{target}/sales_clean")
    manifest = summaries.select(
        F.lit("1.0").alias("policy_version"), "source", "extracted_records", "valid_records", "duplicate_records",
        "invalid_records", F.lit("decimal, two places").alias("money"), F.lit("YYYY-MM-DD").alias("date"),
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{target}/manifest")  # one row per source


def export_clean(results: dict[str, Q.QualityResult], target: str, source_dir: str) -> None:
    """Clean export after the contract check: per source, combined, summary and evidence."""
    _refuse_overlap(target, source_dir)
    exports = {}
    for source, result in results.items():
        if source == "product":
            exports[source] = Q.standard_products(result.clean)
        else:
            exports[source] = Q.validate_sales_contract(Q.standard_sales(result.clean))
    for source, data in exports.items():
        write_csv(data, f"{target}/{source}")
    if set(results) == {"product", *C.CHANNELS}:
        combined = reduce(DataFrame.unionByName, [d for s, d in exports.items() if s != "product"])
        write_csv(combined, f"{target}/sales")
        write_csv(reduce(DataFrame.unionByName, [r.summary for r in results.values()]), f"{target}/summary")
        evidence = [Q.issue_evidence(r.issues, r.rejected, r.duplicates) for r in results.values()]
        write_csv(reduce(DataFrame.unionByName, evidence), f"{target}/quality_issues")


def _refuse_overlap(target: str, source_dir: str) -> None:
    t, s = target.rstrip("/") + "/", source_dir.rstrip("/") + "/"
    if t.startswith(s) or s.startswith(t):
        raise ValueError("results cannot be written into the landing folder")


# --------------------------------------------------------- landing batches


def union_contracts(old: DataFrame, new: DataFrame, columns) -> DataFrame:
    """Rows of an older and a newer header under the full contract; absent cells become '' (B24)."""
    both = old.unionByName(new, allowMissingColumns=True)
    for column in columns:
        if column not in both.columns:
            both = both.withColumn(column, F.lit(""))
    return both.select(*[F.coalesce(c, F.lit("")).alias(c) if dict(both.dtypes)[c] == "string" else F.col(c) for c in columns])


LANDING_KEYS = {
    "product": ("sku",), "promo_master": ("promo_code",), "returns": ("source_name", "return_id", "return_line_number"),
}


def landing_columns(source: str) -> tuple[list[str], list[list[str]]]:
    """(full contract, accepted headers) of a landing source."""
    if source in C.CHANNELS:
        contract = C.CHANNELS[source]
        return contract.all_columns, [contract.required_columns, contract.all_columns]
    full = list({"product": C.PRODUCT_COLUMNS, "promo_master": C.PROMO_COLUMNS, "returns": C.RETURN_COLUMNS}[source])
    return full, [full]


def landing_key(rows: DataFrame, source: str) -> DataFrame:
    """Rows with their normalised correction key in ``_k0..`` and ``_bad_line`` for an unusable line number."""
    if source in C.CHANNELS:
        columns, line = (C.CHANNELS[source].order_column, C.CHANNELS[source].line_column), C.CHANNELS[source].line_column
    else:
        columns, line = LANDING_KEYS[source], "return_line_number"
    out = rows.withColumn("_bad_line", F.lit(False))
    for i, column in enumerate(columns):
        value = F.trim(column)
        if column in ("source_name", "promo_code"):
            value = F.upper(value)
        if column == "source_name":
            value = F.when(value == "OFFLINE", "OFFLINE_STORE").otherwise(value)
        if column == line:
            number = F.regexp_replace(value, r"^0+(?=\d)", "")
            usable = value.rlike(r"^\d+\z") & (number != "0")
            out = out.withColumn("_bad_line", ~usable)
            value = F.when(usable, number).otherwise(value)
        out = out.withColumn(f"_k{i}", value)
    return out


def key_columns(source: str) -> list[str]:
    return [f"_k{i}" for i in range(2 if source in C.CHANNELS else len(LANDING_KEYS[source]))]


def landing_batch(existing: DataFrame, batch: DataFrame, source: str, mode: str = "append") -> DataFrame:
    """Landing rows after a batch: appended, or corrected by key.

    A correction needs usable keys, one content per key, and keys the source
    already holds; it replaces every row of its keys.
    """
    if mode not in ("append", "correct"):
        raise ValueError("mode must be append or correct")
    full, headers = landing_columns(source)
    for name, df in (("batch", batch), ("source", existing)):
        if list(df.columns) not in headers:
            raise ValueError(f"{name} header of {source} must be one of {headers}")
    if batch.isEmpty():
        raise ValueError("batch has no rows")
    existing, batch = (union_contracts(df, df.limit(0), full) for df in (existing, batch))
    if mode == "append":
        return existing.unionByName(batch)
    keys = key_columns(source)
    updates = landing_key(batch, source).distinct()
    empty_key = reduce(lambda a, b: a | b, [F.col(k) == "" for k in keys])
    checks = updates.agg(F.max("_bad_line").alias("line"), F.max(empty_key).alias("empty")).first()
    if checks["line"]:
        raise ValueError("line number of a correction key must be a positive integer")
    if checks["empty"]:
        raise ValueError("correction key must not be empty")
    if not updates.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError("batch holds one key with different content")
    keyed = landing_key(existing, source)
    if not updates.join(keyed, keys, "left_anti").isEmpty():
        raise ValueError("correction key is not in the source; append new data instead")
    return replace_keys(keyed, updates, keys).select(*full)


def write_landing(rows: DataFrame, path: str) -> None:
    """Write the full contract as a new landing folder."""
    rows.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


