"""Packing of token pieces into sequences: cutting stock by column generation, patterns dealt to ranked pieces."""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesloom.llm.shared import Words, by_size, small_side, spread, stash, table

CAPACITY = 4096
END = 2
CHUNK_ROWS = 50_000
#: Basis changes for each size at most.
PIVOTS = 3
GAP = 0.004
#: Words and parts of words of which a worker keeps the ids.
CACHE_WORDS, KNOWN_PARTS = 1_500_000, 150_000
#: Words of these characters alone are split here; any other goes through the tokenizer as a whole.
PLAIN = regex.compile(r"[!-~À-ÖØ-öø-ɏ]+")
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")


def _byte_chars() -> list[str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in names):
        names[b] = chr(256 + n)
    return [names[b] for b in range(256)]


class Encoder:
    """Token ids of texts, each distinct word encoded once: white space always separates tokens in this vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        spec = json.loads(self.whole.to_str())
        self.parts = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}))
        self.special = [x["content"] for x in spec["added_tokens"]]
        self.chars = _byte_chars()
        self.known: dict[str, bytes] = {}
        self.cache_words = CACHE_WORDS
        self.clear()

    def clear(self) -> None:
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint16)
        self.known.clear()

    def _split(self, word: str) -> list[str] | None:
        if word.isascii() and word.isprintable() and "<|" not in word:
            low = word.lower()
            return [low] if low.isalpha() else SPLIT.findall(low)
        if not PLAIN.fullmatch(word) or any(x in word for x in self.special):
            return None
        low = unicodedata.normalize("NFC", word).lower()
        return SPLIT.findall(low) if PLAIN.fullmatch(low) else None

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as 16-bit numbers."""
        texts = [w.decode("utf-8", "replace") for w in words]
        parts = [self._split(w) for w in texts]
        if len(self.known) > KNOWN_PARTS:
            self.known.clear()
        new = list({p for x in parts if x for p in x if p not in self.known})
        shown = [p if p.isascii() else "".join(self.chars[b] for b in p.encode()) for p in new]
        for p, e in zip(new, self.parts.encode_batch_fast(shown, add_special_tokens=False)):
            self.known[p] = np.array(e.ids, np.uint16).tobytes()
        odd = [w for w, x in zip(texts, parts) if x is None]
        rest = iter(self.whole.encode_batch(odd, add_special_tokens=False)) if odd else iter(())
        known = self.known
        return [np.array(next(rest).ids, np.uint16).tobytes() if x is None else known[x[0]] if len(x) == 1 else b"".join(known[p] for p in x) for x in parts]

    def rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of the rows' texts, without an end token."""
        w = Words(texts, fold=False)
        keys, first = np.unique(w.hashes, return_index=True)
        if len(self.keys) > self.cache_words:
            self.clear()
        place = np.searchsorted(self.keys, keys)
        have = self.keys[np.minimum(place, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)
        fresh, where = keys[~have], first[~have]
        if len(fresh):
            ids = self.words([w.text(i) for i in where])
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 2
            at = len(self.pool) + np.cumsum(size) - size
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(ids), np.uint16)])
            every = np.concatenate([self.keys, fresh])
            order = np.argsort(every, kind="stable")
            self.keys, self.at, self.size = every[order], np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]
        i = np.searchsorted(self.keys, w.hashes)
        size = self.size[i] if len(i) else np.zeros(0, np.int64)
        word, nth = spread(size)
        ids = self.pool[self.at[i][word] + nth] if len(word) else np.zeros(0, np.uint16)
        return ids, np.concatenate([[0], np.cumsum(size)])[w.bounds]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The worker's own encoder, kept from task to task."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _cut(path: str, capacity: int, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        encoder.cache_words = cache_words
        for batch in by_size(batches, "text", 2 << 20):
            ids, bounds = encoder.rows(batch.column("text"))
            row, start, length, crc, total = [], [], [], [], []
            end = np.array([END], "<u4")
            for r in range(batch.num_rows):
                own = np.concatenate([ids[bounds[r] : bounds[r + 1]].astype("<u4"), end])
                for s in range(0, len(own), capacity):
                    piece = own[s : s + capacity]
                    row.append(r)
                    start.append(s)
                    length.append(len(piece))
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(own))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row, pa.int64())), *[pa.array(x, pa.int64()) for x in (start, length, crc, total)]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): a document's full sequences and the rest of it."""
    rest = T._parse_datatype_string("start long, length long, ids_crc32 long, doc_tokens long").fields
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_cut(tokenizer, capacity, cache_words), T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *rest]))


def grid(capacity: int) -> list[int]:
    """Piece lengths rounded up: exact to a sixty-fourth of the capacity, then in steps of at most 1.6 per cent."""
    out, at, step = [], 0, 1
    fine = max(capacity // 64, 1)
    while at < capacity:
        if at >= fine * step and step < capacity // 256:
            step *= 2
        at += step
        out.append(min(at, capacity))
    return out


def _knapsack(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best worth for each capacity with any number of each size, and the size taken last (-1: none). Sizes ascend."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            total = best[c - sizes[:k]] + worth[:k]
            i = int(total.argmax())
            if total[i] > best[c] + 1e-12:
                best[c], last[c] = total[i], i
    return best, last


def _unwind(last: np.ndarray, sizes: np.ndarray, c: int, counts: np.ndarray) -> np.ndarray:
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            counts[last[c]] += 1
            c -= sizes[last[c]]
    return counts


def _first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """Pattern that takes the largest sizes left first."""
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    for i in np.flatnonzero(left > 0)[::-1]:
        if sizes[i] <= room:
            pattern[i] = min(max(int(left[i]), 1), room // sizes[i])
            room -= pattern[i] * sizes[i]
    return pattern


def _first_fit_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """First-fit patterns in real amounts: each uses up one size more, so they are a basis in triangular form."""
    m = len(sizes)
    basis, x, left, owner = np.zeros((m, m)), np.zeros(m), demand.astype(float), np.full(m, -1)
    for k in range(m):
        if not (left > 0).any():
            break
        pattern = _first_fit(sizes, left, capacity)
        use = np.flatnonzero(pattern)
        ratio = left[use] / pattern[use]
        i = use[int(ratio.argmin())]
        basis[:, k], x[k], owner[k] = pattern, ratio.min(), i
        left = left - ratio.min() * pattern
        left[left < 1e-9] = 0
        left[i] = 0
    for k, i in zip(np.flatnonzero(owner < 0), np.setdiff1d(np.arange(m), owner)):
        basis[i, k] = 1
    return basis, x


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each size) and how often each is used; demand is met exactly.

    Linear program over patterns by column generation, from a first-fit start: duals of the current basis price sizes, the knapsack's best
    fillings enter, until Farley's bound says the program is within GAP of its optimum. Whole parts of the solution
    are kept; what rounding leaves, fewer sequences than sizes, is filled first fit, largest first.
    """
    m = len(sizes)
    if not m:
        return []
    basis, x = _first_fit_basis(sizes, demand, capacity)
    inverse = np.linalg.inv(basis)
    pivots, done = 0, False
    while not done and pivots < PIVOTS * m:
        price = np.maximum(inverse.sum(0), 0)
        best, last = _knapsack(sizes, price, capacity)
        if best[capacity] <= 1 + GAP:
            break
        gain = price + best[capacity - sizes]
        done = True
        columns = [_unwind(last, sizes, capacity, np.zeros(m))]
        for i in np.argsort(-gain, kind="stable")[:24]:
            column = np.zeros(m)
            column[i] = 1
            columns.append(_unwind(last, sizes, capacity - sizes[i], column))
        for column in columns:
            if inverse.sum(0) @ column <= 1 + GAP / 2:
                continue
            step = inverse @ column
            up = step > 1e-9
            if not up.any():
                continue
            ratio = np.where(up, x / np.where(up, step, 1), np.inf)
            least = ratio.min()
            leave = int(np.argmax(np.where(ratio <= least + 1e-9, step, -1)))
            basis[:, leave] = column
            x = np.maximum(x - least * step, 0)
            x[leave] = least
            row = inverse[leave] / step[leave]
            inverse -= np.outer(step, row)
            inverse[leave] = row
            pivots += 1
            done = False
            if pivots % 200 == 0:
                inverse = np.linalg.inv(basis)
                x = np.maximum(inverse @ demand, 0)
    left, out = demand.astype(np.int64).copy(), []
    for p in np.argsort(-x, kind="stable"):
        pattern = basis[:, p].round().astype(np.int64)
        times = int(x[p] + 1e-6)
        use = pattern > 0
        times = min(times, int((left[use] // pattern[use]).min())) if use.any() else 0
        if times > 0:
            out.append((pattern, times))
            left -= times * pattern
    while left.any():
        pattern = _first_fit(sizes, left, capacity)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        out.append((pattern, times))
        left -= times * pattern
    return out


def assign(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, start, length, ...).

    Only the histogram of rounded lengths, some 500 numbers, goes to the driver. A piece's rank among those of its size is
    a chunk's offset and its number in the chunk, chunks holding some CHUNK_ROWS pieces of all sizes; a pattern takes a
    range of ranks of each size.
    """
    spark = parts.sparkSession
    steps = grid(capacity)
    up = np.searchsorted(steps, np.arange(capacity + 1))
    size = F.element_at(F.array(*[F.lit(int(steps[i])) for i in up[1:]]), F.col("length").cast("int"))
    parts = stash(parts.withColumn("size", size), "pieces")
    chunks = max(1, -(-parts.count() // CHUNK_ROWS))
    parts = parts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks)))
    held = stash(parts.groupBy("size", "chunk").count(), "held")
    histogram = {r["size"]: r["n"] for r in held.groupBy("size").agg(F.sum("count").alias("n")).collect()}
    sizes = np.array(sorted(histogram), np.int64)
    plan = cutting_stock(sizes, np.array([histogram[s] for s in sizes], np.int64), capacity)
    taken, base, rows = np.zeros(len(sizes), np.int64), 0, []
    for pattern, times in plan:
        for i in np.flatnonzero(pattern):
            rows.append((int(sizes[i]), int(taken[i]), int(taken[i] + times * pattern[i]), int(pattern[i]), base))
            taken[i] += times * pattern[i]
        base += times
    patterns = spark.createDataFrame(rows, "size int, low long, high long, each long, base long")
    before = F.sum("count").over(Window.partitionBy("size").orderBy("chunk")) - F.col("count")
    offsets = held.withColumn("before", before).drop("count")
    nth = F.row_number().over(Window.partitionBy("size", "chunk").orderBy("doc_id", "start", "ids_crc32"))
    ranked = parts.withColumn("nth", nth).join(small_side(offsets), ["size", "chunk"]).withColumn("rank", F.col("before") + F.col("nth") - 1).drop("chunk", "nth", "before")
    p = F.broadcast(patterns)  # at most two patterns a size, both bounded by the grid
    dealt = ranked.join(p, (ranked["size"] == p["size"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(p["size"])
    dealt = dealt.withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each")).cast("long"))
    order = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0)).cast("long")).drop("size", "rank", "low", "high", "each", "base")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, cache_words: int = CACHE_WORDS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece, sequences of at most `capacity` tokens.

    tokenizer: file of a vocabulary whose tokens never span white space. cache_words: words of which a worker keeps the ids. A null or empty text is its end token alone; a text
    of more than `capacity` tokens is cut at its multiples. Repeated rows are packed as often as they are there, a null
    doc_id stays null, other columns are not read, an empty table gives no rows.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return assign(pieces(docs, tokenizer, capacity, cache_words), capacity)


def op6_column_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` packed into sequences of 4096."""
    return pack(table(spark, sf_dir, "documents"))
