"""Warehouse tables as partitioned Parquet: by part (a channel or source) and key bucket, changed with dynamic partition overwrite.

A row's bucket follows from its key, so a change names the partitions it belongs to: only those are read, joined and written again.
Every step leaves the same rows when it runs again, and what a run starts from (the snapshots) is written last: a run that failed
is made good by running it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesloom.session import stored

WHOLE = "all"
#: Layout columns; a row with a mark keeps a bucket whose rows are all gone.
LAYOUT = "part string, bucket int, marked boolean"
Place = tuple[str, int]


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Tables:
    """The tables under one shared root folder.

    ``keyed`` names the tables that have parts and buckets: column of the part and key columns. Others are one partition.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str], keyed: dict[str, tuple[str, list[str]]], buckets: int = 16):
        self.spark, self.root, self.schemas, self.keyed = spark, root.rstrip("/"), schemas, keyed
        self.buckets = self._layout(buckets)

    def _layout(self, buckets: int) -> int:
        """The number of buckets the tables were made with, else this one from now on."""
        path = f"{self.root}/_layout"
        try:
            return self.spark.read.schema("buckets int").parquet(path).first()["buckets"]
        except AnalysisException:
            self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(path)
            return buckets

    def fields(self, name: str) -> list:
        return self.spark.createDataFrame([], self.schemas[name]).schema.fields

    def placed(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows with the part and bucket they belong to."""
        if name not in self.keyed:
            return rows.withColumns({"part": F.lit(WHOLE), "bucket": F.lit(0)})
        part, keys = self.keyed[name]
        return rows.withColumns({"part": F.col(part).cast("string"), "bucket": bucket_of(keys, self.buckets)})

    def places(self, name: str, rows: DataFrame) -> list[Place]:
        """Distinct places of the rows: at most parts times buckets."""
        if name not in self.keyed:
            return [(WHOLE, 0)]
        return sorted((r["part"], r["bucket"]) for r in self.placed(name, rows).select("part", "bucket").distinct().collect())

    def read(self, name: str, part: str | None = None, places: list[Place] | None = None) -> DataFrame:
        """The table, one part of it, or the partitions of these places."""
        columns = [f.name for f in self.fields(name)]
        try:
            found = self.spark.read.schema(f"{self.schemas[name]}, {LAYOUT}").parquet(f"{self.root}/{name}/rows")
        except AnalysisException:
            return self.spark.createDataFrame([], self.schemas[name])
        if part is not None:
            found = found.where(F.col("part") == part)
        if places is not None:
            by_part: dict[str, list[int]] = {}
            for p, b in places:
                by_part.setdefault(p, []).append(b)
            here = F.lit(False)
            for p, b in by_part.items():
                here = here | ((F.col("part") == p) & F.col("bucket").isin(b))
            found = found.where(here)
        return found.where("marked IS NULL").select(*columns)

    def write(self, name: str, rows: DataFrame, places: list[Place]) -> DataFrame:
        """Replace the partitions of these places by the rows, all of which belong there; others are not touched."""
        if not places:
            return self.read(name)
        typed = self.placed(name, rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.fields(name)])).withColumn("marked", F.lit(None).cast("boolean"))
        marks = self.spark.createDataFrame([(p, b, True) for p, b in places], "part string, bucket int, marked boolean").coalesce(1)
        whole = typed.unionByName(marks, allowMissingColumns=True)
        whole = whole.repartition("part", "bucket") if name in self.keyed else whole
        whole.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", "dynamic").partitionBy("part", "bucket").parquet(f"{self.root}/{name}/rows")
        return self.read(name)

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Replace a table that has no parts."""
        return self.write(name, rows, [(WHOLE, 0)])

    def change(self, name: str, rows: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[Place]:
        """Write merge(old rows of the places, rows) to the places of the rows; returns them. ``rows`` are stored first."""
        kept = stored(rows)
        places = self.places(name, kept)
        if places:
            self.write(name, merge(self.read(name, places=places), kept), places)
        return places

    def log(self, name: str, rows: DataFrame, run_id: str, step: str) -> None:
        """Rows of one step of a run in a log table; the step's own rows of an earlier try go."""
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.fields(name)]) if name in self.schemas else rows
        typed.write.mode("overwrite").parquet(f"{self.root}/{name}/log/run={run_id}/step={step}")

    def read_log(self, name: str, run_id: str | None = None) -> DataFrame | None:
        """A log table, or what one run wrote to it."""
        try:
            found = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/{name}/log")
        except AnalysisException:
            return self.spark.createDataFrame([], self.schemas[name]) if name in self.schemas else None
        return (found if run_id is None else found.where(F.col("run") == run_id)).drop("run", "step")
