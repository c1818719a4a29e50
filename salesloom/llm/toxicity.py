"""Toxicity by a factorization machine over hashed terms, whose factors weigh pairs of terms of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesloom.llm.shared import Words, by_size, mix, spread, stash, stream, table

CELLS = 1 << 18
FACTORS = 8
#: The training sample: at most so many distinct labelled texts of each label and so many cells of their texts in all.
TEXTS_EACH, CELLS_ALL = 6000, 1 << 24
#: Cells in fewer texts of the sample have no weight.
LEAST_TEXTS = 4
#: Passes over the sample, and steps that are made at least.
EPOCHS, STEPS, MINIBATCH, RATE = 6, 600, 64, 0.1
SHRINK_WEIGHTS, SHRINK_FACTORS = 1e-4, 1e-3
#: A cell has a linear weight if the likelihood ratio of its counts under the labels lies beyond so many deviations of chance.
DEVIATIONS = 4.0
TOXIC = 0.7
#: A word's beginnings, some so many bytes, are terms too: compounds share them.
BEGINNINGS = (4, 5)
KINDS = stream(71, 1 + len(BEGINNINGS))
#: Bytes between words: ASCII other than letters.
NO_LETTER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # CELLS
    factors: np.ndarray  # CELLS x FACTORS


def cells_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bounds, cells): each row's distinct cells, of its words and their beginnings. Null rows have none."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    w = Words(lowered, fold=False, blank=NO_LETTER)
    size = w.ends - w.starts
    data, last = w.data.astype(np.uint64), max(len(w.data) - 1, 0)
    found = [mix(w.hashes + KINDS[0])]
    for kind, n in enumerate(BEGINNINGS, 1):
        value = np.zeros(len(size), np.uint64)
        for j in range(n):
            value = value << np.uint64(8) | (data[np.minimum(w.starts + j, last)] * (size > j) if len(size) else value)
        found.append(mix(value + KINDS[kind]))
    row = np.repeat(np.arange(len(w.bounds) - 1), np.diff(w.bounds)).astype(np.int64) * CELLS
    keys = np.concatenate([row + (h >> np.uint64(46)).astype(np.int64) for h in found])
    keys = np.unique(keys)
    return np.searchsorted(keys, np.arange(len(w.bounds)) * CELLS), keys & (CELLS - 1)


def _sums(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values between bounds; empty rows are 0."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values, bounds[full], axis=0)
    return out


def margins(machine: Machine, bounds: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's log odds, and its sums of factors.

    Pairs add half of (sum of factors)^2 less the sum of squares, over the number of cells: a mean over partners, so that long texts are not
    swamped by pairs of common words.
    """
    v = machine.factors[cells]
    sums = _sums(bounds, v)
    squares = _sums(bounds, v * v)
    n = np.maximum(np.diff(bounds), 1)
    return machine.bias + _sums(bounds, machine.weights[cells]) + 0.5 * (sums * sums - squares).sum(1) / n, sums


def evidence(bounds: np.ndarray, cells: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Each cell's log odds ratio between the labels' texts, less the share of it that chance explains.

    Chance is judged by the likelihood ratio of the cell's counts: words as common under either label, and those that few texts tell
    about, are zero, so that a long text's many words do not add up.
    """
    own = np.repeat(labels > 0.5, np.diff(bounds))
    toxic, clean = np.bincount(cells[own], minlength=CELLS).astype(float), np.bincount(cells[~own], minlength=CELLS).astype(float)
    n, m = (labels > 0.5).sum(), (labels <= 0.5).sum()
    ratio = np.log((toxic + 0.5) / (n + 1)) - np.log((clean + 0.5) / (m + 1))
    each = (toxic + clean) / (n + m)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9))

    deviation = np.sqrt(np.maximum(2 * (part(toxic, n * each) + part(clean, m * each) + part(n - toxic, n * (1 - each)) + part(m - clean, m * (1 - each))), 1e-9))
    return ratio * np.maximum(1 - DEVIATIONS / deviation, 0) * (toxic + clean >= LEAST_TEXTS)


def fit(bounds: np.ndarray, cells: np.ndarray, labels: np.ndarray, share: float) -> Machine:
    """The machine of these rows by adaptive gradient steps on the logistic loss, one small batch after another.

    A linear weight is a learned multiple of the cell's evidence; factors weigh every cell that LEAST_TEXTS texts have. share: the label's rate in all rows; the
    sample's own is corrected in the bias. Rows of one label alone give a constant.
    """
    machine = Machine(0.0, np.zeros(CELLS, np.float32), np.zeros((CELLS, FACTORS), np.float32))
    share = min(max(share, 1e-6), 1 - 1e-6)
    prior = np.log(share / (1 - share))
    if not len(labels) or labels.min() == labels.max():
        machine.bias = float(prior) if len(labels) else -20.0
        return machine
    rng = np.random.default_rng(7)
    often = np.bincount(cells, minlength=CELLS) >= LEAST_TEXTS
    scale = evidence(bounds, cells, labels)
    machine.factors[often] = rng.normal(0, 0.05, (int(often.sum()), FACTORS))
    keep = often[cells]
    cells, bounds = cells[keep], np.concatenate([[0], np.cumsum(keep)])[bounds]
    mean = labels.mean()
    machine.bias = float(np.log(mean / (1 - mean)))
    square_w, square_v, square_b = np.full(CELLS, 1e-2), np.full((CELLS, FACTORS), 1e-2), 1e-2
    for _ in range(max(EPOCHS, -(-STEPS * MINIBATCH // len(labels)))):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), MINIBATCH):
            rows = order[at : at + MINIBATCH]
            sizes = bounds[rows + 1] - bounds[rows]
            of, nth = spread(sizes)
            own = cells[bounds[rows][of] + nth]
            b = np.concatenate([[0], np.cumsum(sizes)])
            z, sums = margins(machine, b, own)
            slope = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]
            used, where = np.unique(own, return_inverse=True)
            n = np.maximum(sizes, 1)
            by = scale[used]
            g = (np.bincount(where, slope[of], len(used)) * by) / len(rows) + SHRINK_WEIGHTS * machine.weights[used] / np.where(by == 0, 1, by)
            square_w[used] += g * g
            machine.weights[used] -= RATE * by * g / np.sqrt(square_w[used])
            pull = (slope / n)[of]
            v = machine.factors[used]
            both = np.bincount(where, pull, len(used))[:, None] * v
            g = np.stack([np.bincount(where, pull * sums[of, k], len(used)) for k in range(FACTORS)], 1) - both
            g = g / len(rows) + SHRINK_FACTORS * v
            square_v[used] += g * g
            machine.factors[used] -= (RATE * g / np.sqrt(square_v[used])).astype(np.float32)
            g = slope.mean()
            square_b += g * g
            machine.bias -= RATE * g / np.sqrt(square_b)
    machine.bias = float(machine.bias + prior - np.log(mean / (1 - mean)))
    return machine


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "text", 1 << 20):
        bounds, cells = cells_of(batch.column("text"))
        raw = cells.astype("<u4")
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), pa.array([raw[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())], ["h", "toxic", "cells"])


def sample(docs: DataFrame, labels: DataFrame, learn: Column) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Bounds, cells and labels of the training sample, and the rate of label 1 among distinct labelled texts.

    Labelled rows are reduced to distinct texts (by hash, label 1 if any copy has it); of each label those with the smallest
    hashes are taken, TEXTS_EACH at most. Only narrow rows are joined and ranked; the chosen texts are read again for their cells.
    """
    h = F.xxhash64("text")
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn")).where("learn and text is not null")
    once = stash(plain.select("doc_id", h.alias("h")).join(marked, "doc_id").groupBy("h").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")), "labelled")
    counts = {r["toxic"]: r["count"] for r in once.groupBy("toxic").count().collect()}
    total = sum(counts.values())
    if not total:
        return np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), 0.0
    mixed = F.xxhash64("h")
    # twice the share that is wanted is ranked, so that a window never sees a whole label
    parts = [once.where(F.col("toxic") == k).where(F.pmod(mixed, F.lit(1 << 30)) <= int(min(1.0, 2 * TEXTS_EACH / n + 100 / n) * (1 << 30))) for k, n in counts.items()]
    near = parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]
    rank = F.row_number().over(Window.partitionBy("toxic").orderBy(mixed, "h"))
    chosen = near.withColumn("rank", rank).where(F.col("rank") <= TEXTS_EACH).select("doc_id", "h", "toxic")
    chosen = F.broadcast(stash(chosen, "chosen"))  # at most 2 * TEXTS_EACH short rows
    found = plain.withColumn("h", h).join(chosen, ["doc_id", "h"]).select("h", "toxic", "text").mapInArrow(_cells, "h long, toxic int, cells binary")
    found = stash(found.groupBy("h", "toxic").agg(F.first("cells").alias("cells")), "cells")
    so_far = F.sum("size").over(Window.orderBy(mixed, "h").rowsBetween(Window.unboundedPreceding, 0))
    within = found.select("h", F.octet_length("cells").alias("size")).withColumn("held", so_far).where(F.col("held") <= 4 * CELLS_ALL)
    rows = found.join(F.broadcast(within.select("h")), "h").select("h", "toxic", "cells").orderBy("h").collect()
    each = [np.frombuffer(bytes(r["cells"]), "<u4") for r in rows]
    return np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int64), np.concatenate([*each, np.zeros(0, "<u4")]).astype(np.int64), np.array([r["toxic"] for r in rows], float), counts.get(1, 0) / total


def learned(docs: DataFrame, labels: DataFrame, learn: Column) -> Machine:
    return fit(*sample(docs, labels, learn))


def score(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score): the probability of label 1 for every whole text.

    Null, empty and letterless texts have the score of a text without terms; repeated rows score alike and stay as many as they are. Other
    columns are not read; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = (model.value.weights != 0) | (model.value.factors != 0).any(1)
        for batch in by_size(batches, "text", 1 << 20):
            bounds, cells = cells_of(batch.column("text"))
            keep = known[cells]
            z, _ = margins(model.value, np.concatenate([[0], np.cumsum(keep)])[bounds], cells[keep])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType())]))


def op12_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all `documents`, learned from the labels of those whose crc32 remainder by 3 is not 1."""
    docs = table(spark, sf_dir, "documents")
    part = lambda c: F.crc32(c.cast("string")) % 3
    out = score(docs, learned(docs, table(spark, sf_dir, "labels"), part(F.col("doc_id")) != 1))
    return out.select("doc_id", F.coalesce(part(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))
