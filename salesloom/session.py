"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, memory: str = "8g", partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench; a cluster submits with its own settings."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("salesloom")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(partitions or cpus))
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the one the cluster names, else a fallback on local masters only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(tempfile.gettempdir(), "salesloom-checkpoints")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages survive the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The rows as compressed columns in the shared folder: lineage ends there, later scans read the columns they need and know the size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/stored-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Spread an input with fewer splits than cores; one that has enough is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
