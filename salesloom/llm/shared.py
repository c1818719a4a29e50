"""Helpers of the operators here: stored intermediates, Arrow batches by size, word hashes, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.session import ensure_checkpoint_dir

BATCH_BYTES = 4 << 20
PIECE_BYTES = 1 << 18
#: Links of which neighbour minima may be broadcast.
PAIRS_BROADCAST = 100_000
BLANKS = b" \t\n\x0b\x0c\r"
MASK = (1 << 64) - 1


def stash(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder and read again: lineage ends there, later scans prune columns and know the size.

    compression: zstd makes whole texts smaller for a little time.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """A stored table of short rows, broadcast when it has at most that many rows; the join shuffles beyond."""
    return F.broadcast(df) if df.count() <= rows else df


def sorted_side(df: DataFrame, key: str, value: str, rows: int = 1_000_000) -> Broadcast | None:
    """Keys and values of a stored table of two longs as sorted arrays for the Python workers; None beyond that many rows.

    16 bytes a row on the driver; a broadcast join holds some 70 there, several times over while it is built.
    """
    if df.count() > rows:
        return None
    found = df.select(key, value).toArrow()
    keys, values = (np.asarray(found.column(c), np.int64) for c in (key, value))
    order = np.argsort(keys, kind="stable")
    return df.sparkSession.sparkContext.broadcast((keys[order], values[order]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


BYTE_VALUES = stream(11, 256)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i up to n at least."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        step, b = 1, base
        while step < size:
            have[step : 2 * step] = have[:step] * np.uint64(b)
            step, b = 2 * step, b * b & MASK
        _powers[base] = have
    return have


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


IS_BLANK = byte_class(BLANKS)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of a batch: bytes between ASCII white space, never across rows. bounds[i]:bounds[i+1] are row i's words."""

    def __init__(self, texts: pa.Array, fold: bool = True, blank: np.ndarray = IS_BLANK, hashed: bool = True):
        """fold: hashes see A-Z as a-z. blank: which bytes stand between words. Null rows have no words."""
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        raw = texts.buffers()[2]
        self.data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]]
        self.rows = offsets - offsets[0]
        starts, ends, hashes = [], [], []
        at, size = 0, len(self.data)
        values = BYTE_VALUES[LOWER] if fold else BYTE_VALUES
        while at < size:
            to = self._cut(at, size, blank)
            part = self.data[at:to]
            inside = ~blank[part]
            first = self.rows[np.searchsorted(self.rows, at) : np.searchsorted(self.rows, to)] - at
            first = first[first < len(part)]
            before = np.empty(len(part), bool)
            before[0] = False
            before[1:] = inside[:-1]
            before[first] = False
            s = np.flatnonzero(inside & ~before)
            after = np.empty(len(part), bool)
            after[-1] = False
            after[:-1] = inside[1:]
            after[first[first > 0] - 1] = False
            e = np.flatnonzero(inside & ~after) + 1
            if hashed:
                sums = np.zeros(len(part) + 1, np.uint64)
                np.cumsum(values[part] * powers(BASE, len(part))[: len(part)], out=sums[1:])
                hashes.append(mix((sums[e] - sums[s]) * powers(BASE_INVERSE, len(part) + 1)[s]))
            starts.append(s + at)
            ends.append(e + at)
            at = to
        none = np.zeros(0, np.int64)
        self.starts, self.ends = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.bounds = np.searchsorted(self.starts, self.rows)

    def _cut(self, at: int, size: int, blank: np.ndarray) -> int:
        """End of the next piece of some PIECE_BYTES, at a blank byte or a row's end."""
        p = at + PIECE_BYTES
        while p < size:
            found = np.flatnonzero(blank[self.data[p : p + 65536]])
            row = self.rows[min(np.searchsorted(self.rows, p), len(self.rows) - 1)]
            if len(found):
                return int(min(p + found[0], row)) if row >= p else int(p + found[0])
            if p <= row <= p + 65536:
                return int(row)
            p += 65536
        return size

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def by_size(batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about limit bytes of the column, one row at least."""
    for batch in batches:
        lengths = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), np.int64)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes laid end to end: each element's group and its place in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return group, np.arange(len(group)) - first[group]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of (a, b) rows: (node, component), the component being its smallest node.

    Alternating large-star and small-star rounds; each round's links are stored, so a lost executor
    costs one round. Neighbour minima are pre-aggregated, no node's neighbours meet in one task.
    """
    links = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), name)
    state = None
    # stored pairs are small by their files and many times larger in a broadcast
    shuffled = lambda df: df.hint("merge") if many else df
    many = links.count() > PAIRS_BROADCAST
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(shuffled(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(shuffled(least), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("x"))
        links = stash(small.select("x.u", "x.v").where("u <> v").distinct(), name)
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
