"""What the channels declare about their files (A14): a small JSON document, judged by a table of rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from salesloom import contracts as C
from salesloom.operators import delta
from salesloom.sources.files import exists

FIELDS = "ingestion_mode string, snapshot_scope string, snapshot_timestamp string, snapshot_completeness string"
_ZONED = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"

#: What must hold for a declared channel, and what to say where it does not. The first broken rule is reported.
RULES = (
    (f"source_name IN ({', '.join(repr(c) for c in C.CHANNEL_CODES)})", "is no channel"),
    ("startswith(ltrim(declared), '{')", "has no object of declarations"),
    ("ingestion_mode IN ('FULL_SNAPSHOT', 'INCREMENTAL_BATCH')", "has an unknown ingestion_mode"),
    ("snapshot_completeness IN ('COMPLETE', 'PARTIAL', 'UNKNOWN')", "has an unknown snapshot_completeness"),
    (rf"stamp IS NULL OR (stamp RLIKE r'{_ZONED}' AND snapshot_timestamp IS NOT NULL)", "has a snapshot_timestamp that is not an ISO time with its zone"),
    ("ingestion_mode <> 'FULL_SNAPSHOT' OR is_reconcilable", "declares a full snapshot that is not the complete, dated history"),
)


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """(source_name, declared): the members of the document's only field `sources`, each as JSON text."""
    top = spark.read.option("wholetext", True).text(path).select(F.from_json("value", "map<string,string>").alias("top"))
    sources = F.from_json(F.element_at("top", "sources"), "map<string,string>")
    read = top.select(F.array_sort(F.map_keys("top")).alias("keys"), F.startswith(F.ltrim(F.element_at("top", "sources")), F.lit("{")).alias("nested"), sources.alias("sources"))
    shape = read.select(F.coalesce((F.size("keys") == 1) & F.col("nested") & F.col("sources").isNotNull(), F.lit(False)).alias("good")).first()
    if not shape or not shape["good"]:
        raise ValueError(f"{path}: one JSON object with the single member 'sources' is expected")
    return read.select(F.explode("sources").alias("source_name", "declared"))


def _typed(entries: DataFrame) -> DataFrame:
    d = entries.withColumn("d", F.from_json("declared", FIELDS)).select(
        "source_name", "declared", F.upper("d.ingestion_mode").alias("ingestion_mode"), F.nullif("d.snapshot_scope", F.lit("")).alias("snapshot_scope"),
        F.nullif("d.snapshot_timestamp", F.lit("")).alias("stamp"), F.upper(F.coalesce("d.snapshot_completeness", F.lit("UNKNOWN"))).alias("snapshot_completeness"),
    )
    d = d.withColumn("snapshot_timestamp", F.expr("try_cast(stamp AS TIMESTAMP)"))
    return d.withColumn("is_reconcilable", delta.is_reconcilable(*[F.col(c) for c in ("ingestion_mode", "snapshot_scope", "snapshot_timestamp", "snapshot_completeness")]))


def load_manifest(spark: SparkSession, folder: str) -> dict[str, Row]:
    """A row of declarations by channel code; a channel that declares nothing sends incomplete batches."""
    silent = spark.createDataFrame([(c, '{"ingestion_mode": "INCREMENTAL_BATCH"}') for c in C.CHANNEL_CODES], "source_name string, declared string")
    path = f"{folder}/{C.MANIFEST_FILE}"
    entries = silent
    if exists(spark, path):
        said = _entries(spark, path)
        entries = said.unionByName(silent.join(said, "source_name", "left_anti"))
    broken = F.coalesce(*[F.when(~F.coalesce(F.expr(test), F.lit(False)), F.lit(message)) for test, message in RULES])
    rows = _typed(entries).withColumn("broken", broken).drop("declared", "stamp").collect()  # one row a channel
    for row in rows:
        if row["broken"]:
            raise ValueError(f"{path}: {row['source_name']} {row['broken']}")
    return {row["source_name"]: row for row in rows}


def declaration_rows(spark: SparkSession, declarations: dict[str, Row]) -> DataFrame:
    names = ("source_name", "ingestion_mode", "snapshot_scope", "snapshot_timestamp", "snapshot_completeness")
    kinds = "source_name string, ingestion_mode string, snapshot_scope string, snapshot_timestamp timestamp, snapshot_completeness string"
    return spark.createDataFrame([tuple(d[n] for n in names) for d in declarations.values()], kinds)
