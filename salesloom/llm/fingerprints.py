"""Fingerprints by consistent weighted sampling: equal samples at the rate of the generalised Jaccard similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm.shared import Words, by_size, mix, spread, stash, stream, table

SLOTS = 40
GROUP = 8
CHUNK = 2048
SEEDS = stream(51, SLOTS)
PLACE = stream(52, 2)
EDGE = np.uint64(0x51ED)


def weighted_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight): a text's terms are its pairs of adjacent words, its ends counting as words; the weight is their count."""
    w = Words(texts, fold=False)
    n = np.diff(w.bounds)
    row, nth = spread(np.where(n > 0, n + 1, 0))
    at = w.bounds[:-1][row] + nth
    last = max(len(w.hashes) - 1, 0)
    left = np.where(nth > 0, w.hashes[np.clip(at - 1, 0, last)], EDGE) if len(row) else np.zeros(0, np.uint64)
    right = np.where(nth < n[row], w.hashes[np.minimum(at, last)], EDGE) if len(row) else np.zeros(0, np.uint64)
    term = mix(left * PLACE[0] + right * PLACE[1])
    order = np.lexsort((term, row))
    row, term = row[order], term[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (term[1:] != term[:-1])])) if len(row) else np.zeros(0, np.int64)
    return row[first], term[first], np.diff(np.append(first, len(row)))


def _uniform(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two numbers in (0, 1) from each 64-bit value."""
    scale = np.float32(2.0**-24)
    return ((x >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * scale, ((x & np.uint64(0xFFFFFF)).astype(np.float32) + np.float32(0.5)) * scale


def _samples(term: np.ndarray, log_weight: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each term and slot its hash value, above the sample's identity in the low 32 bits: the smallest one wins.

    r and c are gamma(2, 1), beta is uniform, all fixed by term and slot; t = floor(ln w / r + beta) changes with the weight
    only where it must, and ln a = ln c - r (t - beta + 1) is compared.
    """
    x = mix(term[:, None] + SEEDS[slots][None, :])
    u1, u2 = _uniform(x)
    x = mix(x)
    u3, u4 = _uniform(x)
    beta, _ = _uniform(mix(x))
    r = -np.log(u1 * u2)
    t = np.floor(log_weight[:, None] / r + beta)
    value = np.log(-np.log(u3 * u4)) - r * (t - beta + 1)
    bits = value.astype(np.float32).view(np.uint32)
    ordered = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(0x80000000)).astype(np.uint64)
    identity = mix(term[:, None] + t.astype(np.int64).view(np.uint64)) >> np.uint64(32)
    return ordered << np.uint64(32) | identity


def signatures(texts: pa.Array) -> np.ndarray:
    """Rows x SLOTS of 16-bit samples; zeros for a text without words."""
    row, term, weight = weighted_terms(texts)
    out = np.zeros((len(texts), SLOTS), np.uint16)
    if not len(row):
        return out
    pair, where = np.unique(term + weight.astype(np.uint64) * PLACE[1], return_inverse=True)
    some = np.zeros(len(pair), np.int64)
    some[where] = np.arange(len(term))
    distinct, log_weight = term[some], np.log(weight[some]).astype(np.float32)
    full, start = np.unique(row, return_index=True)
    value = np.empty((len(distinct), GROUP), np.uint64)
    for g in range(0, SLOTS, GROUP):
        slots = np.arange(g, g + GROUP)
        for k in range(0, len(distinct), CHUNK):  # pieces that stay in a core's cache
            value[k : k + CHUNK] = _samples(distinct[k : k + CHUNK], log_weight[k : k + CHUNK], slots)
        least = np.minimum.reduceat(value[where], start, axis=0)
        out[full, g : g + GROUP] = (least & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _text_of(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
NAMES = [x.split()[0] for x in RESULT.split(", ")]


def _compare(ids: list, texts: list[str]) -> list[pa.Array]:
    """Results of all texts but the last, each compared with the next one."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    s = signatures(pa.array([*texts, *changed], pa.large_string()))
    own, new = s[: len(texts)], s[len(texts) :]
    n = len(changed)
    return [
        pa.array(ids[:n], pa.int64()), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array([_text_of(x) for x in own[:n]], pa.string()), pa.array([_text_of(x) for x in new], pa.string()),
        pa.array((own[:n] == new).mean(1)), pa.array((own[:n] == own[1:]).mean(1)),
    ]


EDGES = "part long, first_id long, first_text string, last_id long, last_text string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of one range: results of all but the last row, then one row with the range's first and last text."""
    names = [*NAMES, *[x.split()[0] for x in EDGES.split(", ")]]
    none = [pa.int64(), pa.string(), pa.int64(), pa.string()]
    first = held = None
    for batch in by_size(batches, "text", 1 << 20):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        first = first or (ids[0], texts[0])
        if held:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = (ids[-1], texts[-1])
        if len(ids) > 1:
            rows = _compare(ids, texts)
            yield pa.RecordBatch.from_arrays([*rows, pa.nulls(len(ids) - 1, pa.int64()), *[pa.nulls(len(ids) - 1, t) for t in none]], names)
    if first:
        blank = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([*blank, pa.array([TaskContext.get().partitionId()], pa.int64()), *[pa.array([x], t) for x, t in zip([*first, *held], none)]], names)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, a, b in zip(batch.column("last_id").to_pylist(), batch.column("last_text").to_pylist(), batch.column("next_text").to_pylist()):
            yield pa.RecordBatch.from_arrays(_compare([i, None], [a, b]), NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row of RESULT per document: fingerprints of the text and of its edited text, and how alike they and the next text's are.

    Documents are dealt by ranges of doc_id and sorted there; where two ranges meet, the last text of one is compared with the
    first of the next, the last of all with the first of all. Null texts are empty; texts without words are alike with each other and
    with nothing else; null ids come first; equal ids are ordered by text. Other columns are not read; no rows give no rows.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    out = stash(plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(_walk, f"{RESULT}, {EDGES}"), "fingerprints")
    edges = out.where("part is not null")
    order = edges.select("part", F.lead("part").over(Window.orderBy("part")).alias("next"), F.min("part").over(Window.partitionBy()).alias("least"))  # one short row a range
    meet = edges.join(order, "part").select("last_id", "last_text", F.coalesce("next", "least").alias("next")).join(edges.select(F.col("part").alias("next"), F.col("first_text").alias("next_text")), "next")
    return out.where("part is null").select(*NAMES).unionByName(meet.mapInArrow(_meet, RESULT))


def op10_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all `documents`."""
    return fingerprints(table(spark, sf_dir, "documents"))
