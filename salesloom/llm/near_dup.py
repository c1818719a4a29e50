"""Near-duplicate groups by HyperMinHash registers, banding, corrected estimates and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import Words, by_size, components, mix, sorted_side, spread, stash, stream, table

BUCKETS = 128
ROWS = 4
BANDS = BUCKETS // ROWS
MANTISSA = 10
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 1 << 20
PLACE = stream(21, 64)


def _probes() -> np.ndarray:
    """For each bucket, the order in which it looks for a filled one: a fixed permutation."""
    return np.stack([np.argsort(stream(1000 + b, BUCKETS), kind="stable") for b in range(BUCKETS)])


PROBES = _probes()


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of each row's distinct k-word shingles, sorted by both; fewer than k words make one shingle."""
    n = np.diff(words.bounds)
    row, at = spread(np.where(n > 0, np.maximum(n - k + 1, 1), 0))
    first, left = words.bounds[:-1][row] + at, n[row] - at
    h = np.zeros(len(row), np.uint64)
    for j in range(k):
        i = np.minimum(first + j, max(len(words.hashes) - 1, 0))
        h += np.where(left > j, words.hashes[i] * PLACE[j], np.uint64(0))
    h = mix(h)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
    return row[fresh], h[fresh]


def registers(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """One HyperMinHash register per bucket: leading zeros of the smallest hash there and MANTISSA bits after them.

    A hash's top bits choose the bucket. An empty bucket copies a filled one, found by its own fixed probing order,
    so that short texts collide at the rate of their similarity too.
    """
    bits = BUCKETS.bit_length() - 1
    bucket = (h >> np.uint64(64 - bits)).astype(np.int64)
    cell = row * BUCKETS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    low = (h[first] << np.uint64(bits)) | np.uint64(1 << (bits - 1))
    zeros = (53 - np.frexp((low >> np.uint64(11)).astype(np.float64))[1]).astype(np.uint64)
    tail = (low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    out = np.zeros(rows * BUCKETS, np.uint16)
    out[cell[first]] = (zeros.astype(np.uint16) + 1) << np.uint16(MANTISSA) | tail.astype(np.uint16)
    out = out.reshape(rows, BUCKETS)
    filled = out > 0
    some = filled.any(1)
    full = out.copy()
    for a in range(BUCKETS):
        open_row, open_bucket = np.nonzero((full == 0) & some[:, None])
        if not len(open_row):
            break
        full[open_row, open_bucket] = out[open_row, PROBES[open_bucket, a]]
    return full


def band_keys(regs: np.ndarray) -> np.ndarray:
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        key = mix(key + parts[:, :, j] * PLACE[j])
    return key.view(np.int64)


def accidental(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Rate at which registers of unrelated sets of these sizes agree by chance."""
    zeros = np.arange(0, 40)
    rate = 0.0
    for lo, hi in ((2.0**-zeros, 2.0 ** -(zeros + 1)),):
        p = lambda s: (1 - hi[None, :]) ** np.maximum(s / BUCKETS, 1)[:, None] - (1 - lo[None, :]) ** np.maximum(s / BUCKETS, 1)[:, None]
        rate = (p(n) * p(m)).sum(1) / (1 << MANTISSA)
    return rate


def worth(same: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether the collision-corrected estimate is not six deviations below the similarity asked for."""
    chance = accidental(n, m)
    estimate = (same / BUCKETS - chance) / (1 - chance)
    return estimate >= similarity - 6 * np.sqrt(similarity * (1 - similarity) / np.minimum(np.minimum(n, m), BUCKETS))


class Forest:
    """Union-find over a block's rows; the smaller number becomes the root."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True

    def roots(self) -> np.ndarray:
        up = self.up
        while True:
            nxt = up[up]
            if (nxt == up).all():
                self.up = up
                return up
            up = nxt


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            row, h = shingle_sets(Words(batch.column("text"), fold=True), k)
            count = np.bincount(row, minlength=batch.num_rows)
            edge = np.concatenate([[0], np.cumsum(count)])
            a, b = np.concatenate([[0], np.cumsum(mix(h ^ PLACE[50]))]).astype(np.uint64), np.concatenate([[0], np.cumsum(mix(h ^ PLACE[51]))]).astype(np.uint64)
            regs = registers(row, h, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(count.astype(np.int64)),
                    pa.array((a[edge[1:]] - a[edge[:-1]]).view(np.int64)), pa.array((b[edge[1:]] - b[edge[:-1]]).view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                ["doc_id", "n", "sig_a", "sig_b", "regs"],
            )

    return run


def sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """One row per document: set size, 128-bit signature of the set, registers."""
    spec = "doc_id long, n long, sig_a long, sig_b long, regs binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_sketch(shingle), spec)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            keys = band_keys(np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(-1, BUCKETS))
            ids = np.repeat(np.asarray(batch.column("rep")), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], ["key", "rep"])


def _pairs_within(size: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i < j) of all groups laid end to end; left: rows of the group that stand on the first side (all if equal to size)."""
    group, at = spread(size)
    first = np.cumsum(size) - size
    same = left[group] == size[group]
    count = np.where(same, size[group] - at - 1, np.where(at < left[group], size[group] - left[group], 0))
    i, d = spread(count)
    start = np.where(same, np.arange(len(group)) + 1, first[group] + left[group])
    return i, start[i] + d


def _link_buckets(similarity: float):
    """Rows sorted by (key, part, side): within each bucket, a forest of pairs whose estimate is worth verifying."""

    def links(frame: pd.DataFrame) -> Iterator[pa.RecordBatch]:
        frame = frame.reset_index(drop=True)
        new = (frame["key"].diff() != 0) | (frame["part"].diff() != 0)
        group = (new.cumsum() - 1).to_numpy()
        size = np.bincount(group)
        right = np.bincount(group, weights=frame["side"]).astype(np.int64)
        left = np.where(right > 0, size - right, size)
        n, rep = frame["n"].to_numpy(), frame["rep"].to_numpy()
        regs = np.frombuffer(b"".join(frame["regs"]), np.uint16).reshape(-1, BUCKETS)
        forest, first, made = Forest(len(frame)), np.cumsum(size) - size, []
        at = 0
        while at < len(size):  # pieces of about a million pairs
            pairs = np.cumsum(np.where(left[at:] == size[at:], size[at:] * (size[at:] - 1) // 2, left[at:] * (size[at:] - left[at:])))
            to = at + max(1, int(np.searchsorted(pairs, 1 << 18, "right")))
            i, j = _pairs_within(size[at:to], left[at:to])
            i, j = i + first[at], j + first[at]
            for s in range(0, len(i), 1 << 16):
                a, b = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
                open_ = forest.roots()[a] != forest.up[b]
                a, b = a[open_], b[open_]
                good = worth((regs[a] == regs[b]).sum(1), n[a], n[b], similarity)
                for x, y in zip(a[good].tolist(), b[good].tolist()):
                    if forest.join(x, y):
                        made.append((x, y))
            at = to
        if made:
            x, y = np.array(made).T
            yield pa.RecordBatch.from_arrays([pa.array(rep[x]), pa.array(rep[y])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pd.DataFrame] = []
        rows = 0
        for batch in batches:
            frame = batch.to_pandas()
            if not len(frame):
                continue
            kept.append(frame)
            rows += len(frame)
            if rows >= 1 << 14:
                frame = pd.concat(kept, ignore_index=True)
                tail = (frame["key"] == frame["key"].iloc[-1]) & (frame["part"] == frame["part"].iloc[-1])
                if not tail.all():
                    yield from links(frame[~tail])
                    kept = [frame[tail]]
                    rows = int(tail.sum())
        if kept:
            yield from links(pd.concat(kept, ignore_index=True))

    return run


def _in_blocks(members: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """Each row once per pair of blocks of its group it takes part in: part is the pair, side 1 marks the second block.

    blocks has (key, n_blocks); a group of one block has the single part 0.
    """
    b = members.join(blocks, key).withColumn("block", F.when(F.col("n_blocks") > 1, F.pmod(F.xxhash64("rep"), F.col("n_blocks"))).otherwise(F.lit(0)).cast("long"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    b = b.withColumn("other", other)
    return b.withColumn("part", F.least("block", "other") * F.col("n_blocks") + F.greatest("block", "other")).withColumn("side", (F.col("block") > F.col("other")).cast("int")).drop("block", "other", "n_blocks")


def _members(side: Broadcast):
    """Rows whose rep is among the side's keys, with the super beside it; side: (sorted reps, their supers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reps, supers = side.value
        for batch in batches:
            rep = batch.column("rep").fill_null(0).to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(reps, rep), max(len(reps) - 1, 0))
            here = np.flatnonzero((reps[at] == rep) & batch.column("rep").is_valid().to_numpy(zero_copy_only=False)) if len(reps) else np.zeros(0, np.int64)
            if len(here):
                kept = batch.take(pa.array(here))
                yield pa.RecordBatch.from_arrays([kept.column("rep"), kept.column("text"), pa.array(supers[at[here]])], ["rep", "text", "super"])

    return run


def _sets(k: int, side: Broadcast | None = None):
    """Registers and sets of the rows; where a side is given, of those among its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches if side is None else _members(side)(batches), "text"):
            row, h = shingle_sets(Words(batch.column("text"), fold=True), k)
            edge = np.searchsorted(row, np.arange(batch.num_rows + 1))
            regs = registers(row, h, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("super"), pa.array([r.tobytes() for r in regs], pa.binary()), pa.array([h[edge[i] : edge[i + 1]].tobytes() for i in range(batch.num_rows)], pa.binary())],
                ["rep", "super", "regs", "shingles"],
            )

    return run


def _verify(per_cent: int):
    """Links of one pair of blocks, confirmed on full sets: each row with the smallest row it is connected to here."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "rep"], ignore_index=True)
        rep = frame["rep"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in frame["shingles"]]
        n = np.array([len(x) for x in sets])
        regs = np.frombuffer(b"".join(frame["regs"]), np.uint16).reshape(-1, BUCKETS)
        right = int(frame["side"].sum())
        left = len(frame) - right if right else len(frame)
        forest = Forest(len(frame))
        cand_a, cand_b, cand_s = [], [], []

        def settle() -> None:
            if not cand_a:
                return
            a, b, s = np.concatenate(cand_a), np.concatenate(cand_b), np.concatenate(cand_s)
            order = np.argsort(-s, kind="stable")
            for p in range(0, len(order), 4096):
                x, y = a[order[p : p + 4096]], b[order[p : p + 4096]]
                open_ = forest.roots()[x] != forest.up[y]
                for i, j in zip(x[open_].tolist(), y[open_].tolist()):
                    if forest.root(i) == forest.root(j):
                        continue
                    small, large = (sets[i], sets[j]) if n[i] <= n[j] else (sets[j], sets[i])
                    at = np.searchsorted(large, small)
                    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                    if 100 * both >= per_cent * (len(small) + len(large) - both):
                        forest.join(i, j)
            for x in (cand_a, cand_b, cand_s):
                x.clear()

        held = 0
        for i in range(left if right else len(frame) - 1):
            j = np.arange(left, len(frame)) if right else np.arange(i + 1, len(frame))
            fits = 100 * np.minimum(n[i], n[j]) >= per_cent * np.maximum(n[i], n[j])
            j = j[fits & (forest.up[j] != forest.up[i])]
            if not len(j):
                continue
            same = (regs[j] == regs[i]).sum(1)
            good = worth(same, np.full(len(j), n[i]), n[j], per_cent / 100)
            cand_a.append(np.full(int(good.sum()), i))
            cand_b.append(j[good])
            cand_s.append(same[good])
            held += int(good.sum())
            if held >= 1 << 19:
                settle()
                forest.roots()
                held = 0
        settle()
        roots = forest.roots()
        moved = np.flatnonzero(roots != np.arange(len(frame)))
        return pd.DataFrame({"a": rep[moved], "b": rep[roots[moved]]})

    return run


def _blocks(here: Column) -> Column:
    """Blocks that the rows under this condition need, by their number and their shingles."""
    rows, held = F.sum(F.when(here, 1).otherwise(0)), F.sum(F.when(here, F.col("n")).otherwise(0))
    return F.greatest(F.ceil(rows / BLOCK_ROWS), F.ceil(held / BLOCK_SHINGLES)).cast("long")


def _links(full: DataFrame, sized: DataFrame, per_cent: int) -> DataFrame:
    """Confirmed links (a, b) of all candidate groups. full: (rep, super, regs, shingles), sized: (node, super, n).

    First each row meets its own block and every block also meets the group's smallest row, so a group of mutual copies
    hangs together after one pass in which a row travels once. Then the rows that are not connected with the smallest
    one, and they alone, meet all blocks of their group.
    """
    verify = _verify(per_cent)
    blocks = stash(sized.groupBy("super").agg(_blocks(F.lit(True)).alias("n_blocks")).where("n_blocks > 1"), "blocks")  # rows / BLOCK_ROWS and shingles / BLOCK_SHINGLES groups at most
    n_blocks = F.coalesce("n_blocks", F.lit(1).cast("long"))
    block = F.pmod(F.xxhash64("rep"), F.col("n_blocks"))
    parts = F.when(F.col("rep") == F.col("super"), F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).otherwise(F.array(block))
    own = full.join(F.broadcast(blocks), "super", "left").withColumn("n_blocks", n_blocks).withColumn("part", F.explode(parts)).withColumn("side", F.lit(0)).drop("n_blocks")
    first = stash(own.groupBy("super", "part").applyInPandas(verify, "a long, b long"), "links")
    wide = F.broadcast(blocks.select("super"))
    if blocks.isEmpty():
        return first
    joined = components(first, "joined").withColumnRenamed("component", "least")
    state = sized.join(wide, "super").join(joined.hint("merge"), "node", "left").select(F.col("node").alias("rep"), "super", "n", (F.coalesce("least", "node") != F.col("super")).alias("rest"))
    state = stash(state, "state")
    need = state.groupBy("super").agg(_blocks(F.col("rest")).alias("r"), _blocks(~F.col("rest")).alias("m")).where("r > 0")
    hashed, zero, every = F.xxhash64("rep"), F.lit(0).cast("long"), F.col("r") + F.col("m")
    block = F.when(F.col("rest"), F.pmod(hashed, F.col("r"))).otherwise(F.col("r") + F.pmod(hashed, F.col("m")))
    others = F.sequence(zero, F.when(F.col("rest"), every).otherwise(F.col("r")) - 1)
    dealt = state.join(need, "super").withColumn("block", block).withColumn("other", F.explode(others))
    dealt = dealt.select("rep", (F.least("block", "other") * every + F.greatest("block", "other")).alias("part"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    second = full.join(dealt, "rep").groupBy("super", "part").applyInPandas(verify, "a long, b long")
    return first.unionByName(stash(second, "links"))


def near_duplicates(docs: DataFrame, shingle: int = 5, per_cent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of documents linked at a Jaccard similarity of per_cent or more.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; a document's set holds its distinct
    shingles of `shingle` words, a shorter text is one shingle, a text without words (or null) has an empty set
    and links with nothing. 128 registers in bands of 4 miss a pair at 0.8 with a chance of 5e-8. Equal sets are
    one representative. Buckets and groups are compared in blocks of at most BLOCK_ROWS rows, and only forests
    leave a block, so no group's pairs become rows. component_id is the smallest doc_id of the group, kept marks
    it. Rows that repeat a doc_id all count. Rows without doc_id stay alone: component_id null, kept true.
    Other columns are not read.
    """
    sketch = stash(sketches(docs, shingle), "sketch")
    known = sketch.where("doc_id is not null and n > 0")
    reps = stash(known.groupBy("n", "sig_a", "sig_b").agg(F.min(F.struct("doc_id", "regs")).alias("x")).select("n", "sig_a", "sig_b", F.col("x.doc_id").alias("rep"), F.col("x.regs").alias("regs")), "reps")
    keys = stash(reps.select("rep", "regs").mapInArrow(_bands, "key long, rep long"), "bands")
    buckets = keys.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key", F.ceil(F.col("size") / BLOCK_ROWS).cast("long").alias("n_blocks"))
    members = _in_blocks(keys, "key", buckets).join(reps.select("rep", "n", "regs"), "rep").select("key", "part", "side", "rep", "n", "regs")
    dealt = members.repartition("key", "part").sortWithinPartitions("key", "part", "side")
    near = stash(dealt.mapInArrow(_link_buckets(per_cent / 100), "a long, b long"), "near")
    supers = stash(components(near.distinct(), "supers").withColumnRenamed("component", "super"), "super")
    sized = stash(supers.hint("merge").join(reps.select(F.col("rep").alias("node"), "n"), "node"), "sized")
    text = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string").alias("text"))
    side = sorted_side(supers, "node", "super")
    text = text if side else text.join(supers.withColumnRenamed("node", "rep").hint("merge"), "rep")
    full = stash(text.mapInArrow(_sets(shingle, side), "rep long, super long, regs binary, shingles binary"), "sets")
    links = _links(full, sized, per_cent)
    group = stash(components(links, "groups"), "group")
    classes = reps.select("n", "sig_a", "sig_b", "rep").join(group.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").select("n", "sig_a", "sig_b", F.coalesce("component", "rep").alias("component_id"))
    linked = known.join(classes, ["n", "sig_a", "sig_b"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = sketch.where("doc_id is null or n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_hyperminhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of `documents` by 4-word shingles at 80 per cent."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, per_cent=80)
