"""Structured Streaming landing: every payload enters the raw layer with the first file that brings it.

Two streams, one after the other. The first picks up new files, numbers their rows and stores them with one arrival per payload and
file. The second runs over the arrivals with keyed state, a payload's first file and how often it came, and writes the rows of
payloads to the raw layer with the file that owns them. Rows that stand several times in that file all stay, with their numbers; the
same payload in a later file does not land again. Nothing is dropped for being late: there is no watermark, rows keep the
date they carry, and the state is kept for good. Landed rows are never read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from salesloom import contracts as C
from salesloom.functions.hashing import payload_hash
from salesloom.sources.files import number_rows

ARRIVALS = "payload_hash string, file string, arrived timestamp, n bigint, batch_id bigint"
OWNERS = "payload_hash string, batch_id bigint, file string"
STATE = "batch_id bigint, file string, arrivals bigint"


def channel_stream(spark: SparkSession, folder: str, channel: str) -> DataFrame:
    """All-text stream of the CSV files of a channel folder, with file, split and payload hash."""
    columns = C.CHANNELS[channel].all_columns
    raw = (
        spark.readStream.schema(C.text_schema(columns)).option("header", True).option("escape", '"')
        .option("enforceSchema", False).csv(folder)
    )
    cells = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns]
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_modification_time").alias("arrived")]
    return raw.select(*place, *cells).withColumns({"source_payload": F.to_json(F.struct(*columns)), "payload_hash": payload_hash(columns)})


def overwrite_partitions(rows: DataFrame, path: str, *columns: str) -> None:
    """Replace the partitions that the rows belong to; a step that runs again leaves what it left before."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def receive(batch: DataFrame, root: str, batch_id: int) -> None:
    """Store a batch of new files: numbered rows, and one arrival per payload and file."""
    spark = batch.sparkSession
    rows = number_rows(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    rows = rows.withColumnRenamed("_file", "file").drop("_block")
    overwrite_partitions(rows, f"{root}/received", "batch_id")
    stored = spark.read.schema(rows.schema).parquet(f"{root}/received").where(F.col("batch_id") == batch_id)
    arrivals = stored.groupBy("payload_hash", "file", "batch_id").agg(F.min("arrived").alias("arrived"), F.count(F.lit(1)).alias("n"))
    overwrite_partitions(arrivals, f"{root}/arrivals", "batch_id")


def first_owner(key: tuple, arrivals: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The file that owns a payload: the first of the earliest batch, oldest file first, ties by path.

    The owner is given out with the arrival that made it so, again if that arrival comes again; later files only count.
    """
    found, n = None, 0
    owner = None
    if state.exists:
        batch_id, file, n = state.get
        owner = (batch_id, file)
    for frame in arrivals:
        n += int(frame["n"].sum())
        for row in frame.itertuples(index=False):
            place = (row.batch_id, row.arrived, row.file)
            if owner == (row.batch_id, row.file) or (owner is None and (found is None or place < found)):
                found = place
    if found is not None:
        owner = (found[0], found[2])
        yield pd.DataFrame({"payload_hash": [key[0]], "batch_id": [owner[0]], "file": [owner[1]]})
    state.update((int(owner[0]), owner[1], n))


def land_owned(owners: DataFrame, root: str, epoch: int) -> None:
    """Rows of the payloads that these owners bring, into the raw partitions of their batches."""
    spark = owners.sparkSession
    overwrite_partitions(owners.withColumn("epoch", F.lit(epoch).cast("bigint")), f"{root}/owners", "epoch")
    own = spark.read.schema(f"{OWNERS}, epoch bigint").parquet(f"{root}/owners").where(F.col("epoch") == epoch).drop("epoch")
    batches = [r["batch_id"] for r in own.select("batch_id").distinct().collect()]  # the batches received since the last run
    if not batches:
        return
    rows = spark.read.parquet(f"{root}/received").where(F.col("batch_id").isin(batches))
    landed = rows.join(own, ["payload_hash", "batch_id", "file"], "left_semi")
    landed = landed.withColumn("source_file", F.element_at(F.split("file", "/"), -1)).drop("file", "arrived")
    overwrite_partitions(landed, f"{root}/raw", "batch_id")


def land_channel(spark: SparkSession, folder: str, channel: str, root: str, checkpoint: str) -> None:
    """Land every new file of the folder under ``root``/raw and stop."""
    stream = channel_stream(spark, folder, channel)
    received = stream.writeStream.foreachBatch(lambda batch, batch_id: receive(batch, root, batch_id))
    received.option("checkpointLocation", f"{checkpoint}/received").trigger(availableNow=True).start().awaitTermination()
    arrivals = spark.readStream.schema(ARRIVALS).parquet(f"{root}/arrivals")
    owners = arrivals.groupBy("payload_hash").applyInPandasWithState(first_owner, OWNERS, STATE, "append", GroupStateTimeout.NoTimeout)
    settled = owners.writeStream.outputMode("append").foreachBatch(lambda batch, epoch: land_owned(batch, root, epoch))
    settled.option("checkpointLocation", f"{checkpoint}/owners").trigger(availableNow=True).start().awaitTermination()
