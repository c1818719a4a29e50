"""Language of words and texts by a linear-chain conditional random field, labels found by forward-backward."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from salesloom.llm.shared import Words, by_size, spread, stash, stream, table

CELLS = 1 << 18
BLOCK = 128
#: The training sample: at most so many distinct labelled texts of a language, some so many in all, 8 of a language at least;
#: of a text longer than LONGEST characters a window of that length.
TEXTS_EACH, TEXTS_ALL, LONGEST = 60, 2400, 20_000
#: Beyond FULL languages the table has fewer cells, so that its size stays; beyond BLOCKED marginals are made word by word.
FULL, BLOCKED = 200, 64
ROUNDS, RATE, SPAN = 30, 0.5, 64
LETTER = regex.compile(r"\p{L}")
SALT = stream(31, 16)
#: Bytes between words: ASCII other than letters. Bytes of longer code points belong to words.
NO_LETTER = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray  # cells x languages
    moves: np.ndarray  # log weights of one label after another
    first: np.ndarray


def _cell(value: np.ndarray, kind: int) -> np.ndarray:
    h = (value.astype(np.uint64) + SALT[kind]) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(46)).astype(np.int64)


def cells_for(languages: int) -> int:
    """CELLS, or the power of two that keeps the table at the size of FULL languages."""
    cells = CELLS
    while cells * languages > CELLS * FULL and cells > 1 << 12:
        cells >>= 1
    return cells


def _batch_bytes(crf: Crf) -> int:
    return max(1 << 14, min(1 << 20, (1 << 20) * BLOCKED // max(1, len(crf.languages))))


def _lowered(texts: pa.Array) -> pa.Array:
    return pa.compute.utf8_lower(texts.cast(pa.large_string()).fill_null(""))


class Features:
    """Cells of a batch's words: affixes of two and three bytes, the word itself, its byte n-grams up to three."""

    def __init__(self, texts: pa.Array, cells: int = CELLS):
        self.cells = cells
        w = Words(_lowered(texts), fold=False, blank=NO_LETTER)
        self.words, size = w, w.ends - w.starts
        data = w.data.astype(np.uint32)
        self.size = size
        head = [data[np.minimum(w.starts + j, len(data) - 1)] * (size > j) for j in range(3)] if len(size) else [np.zeros(0, np.uint32)] * 3
        tail = [data[np.maximum(w.ends - 1 - j, 0)] * (size > j) for j in range(3)] if len(size) else [np.zeros(0, np.uint32)] * 3
        two, three = (lambda x: x[0] << 8 | x[1]), (lambda x: x[0] << 16 | x[1] << 8 | x[2])
        self.single = [_cell(two(head), 1), _cell(three(head), 2), _cell(two(tail), 3), _cell(three(tail), 4), _cell(w.hashes, 5)]
        self.word, place = spread(size)
        at, left = w.starts[self.word] + place, size[self.word] - place
        b0 = data[at] if len(at) else np.zeros(0, np.uint32)
        b1 = np.where(left > 1, data[np.minimum(at + 1, max(len(data) - 1, 0))], 0) if len(at) else b0
        b2 = np.where(left > 2, data[np.minimum(at + 2, max(len(data) - 1, 0))], 0) if len(at) else b0
        self.grams = [_cell(b0, 6), _cell(b0 << 8 | b1, 7), _cell(b0 << 16 | b1 << 8 | b2, 8)]
        if cells < CELLS:
            self.single, self.grams = [x & (cells - 1) for x in self.single], [x & (cells - 1) for x in self.grams]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Words x languages."""
        out = np.zeros((len(self.size), weights.shape[1]), np.float32)
        for cells in self.single:
            out += weights[cells]
        if len(self.size):
            sums = weights[self.grams[0]]
            for cells in self.grams[1:]:
                sums += weights[cells]
            out += np.add.reduceat(sums, np.cumsum(self.size) - self.size, axis=0)
        return out

    def gradient(self, by_word: np.ndarray) -> np.ndarray:
        out = np.empty((self.cells, by_word.shape[1]))
        cells = np.concatenate([*self.single, *self.grams])
        for k in range(by_word.shape[1]):
            of_word = by_word[:, k]
            out[:, k] = np.bincount(cells, np.concatenate([*[of_word] * len(self.single), *[of_word[self.word]] * len(self.grams)]), minlength=self.cells)
        return out


def _row_softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def chain_marginals(node: np.ndarray, moves: np.ndarray, first: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Label probabilities of each word by forward-backward, exact over sequences of any length.

    node: words x labels (log). Sequences are cut into blocks of BLOCK words; a block's transfer matrix, made for all
    blocks at once, carries the messages over it, so the steps one after another are BLOCK and the blocks of the
    longest sequence, not its words.
    """
    labels = node.shape[1]
    n = np.diff(bounds)
    if not len(node):
        return np.zeros((0, labels))
    e = np.exp((node - node.max(1, keepdims=True)).astype(np.float64))
    t, s = np.exp(moves - moves.max()), np.exp(first - first.max())
    if labels > BLOCKED:
        return _by_word(e, t, s, bounds)
    blocks = -(-n // BLOCK)
    seq, nth = spread(blocks)
    start = bounds[:-1][seq] + nth * BLOCK
    size = np.minimum(BLOCK, bounds[1:][seq] - start)
    steps = int(size.max())
    longest = np.argsort(-size, kind="stable")
    start, size, seq, nth = start[longest], size[longest], seq[longest], nth[longest]
    live = [int(np.searchsorted(-size, -k, "right")) for k in range(1, steps + 1)]  # blocks with a k-th word
    carry = np.tile(np.eye(labels), (len(size), 1, 1))
    for k in range(steps):
        m = live[k]
        moved = (carry[:m].reshape(-1, labels) @ t).reshape(m, labels, labels) * e[start[:m] + k][:, None, :]
        carry[:m] = moved / moved.sum((1, 2), keepdims=True)
    # messages into each block from the left and from the right
    order = np.empty((len(n), int(blocks.max())), np.int64)
    order[seq, nth] = np.arange(len(size))
    left, right = np.empty((len(size), labels)), np.ones((len(size), labels))
    back = np.linalg.solve(t.T, s) if abs(np.linalg.det(t)) > 1e-9 else None
    for b in range(order.shape[1]):
        who = np.flatnonzero(blocks > b)
        here = order[who, b]
        if b:
            left[here] = into
        elif back is not None:
            left[here] = back  # so that the first move gives the start weights
        into = np.einsum("il,ilk->ik", left[here], carry[here])
        if b == 0 and back is None:
            into = _first_block(here, start, size, e, t, s)
        into /= into.sum(1, keepdims=True)
        into = into[blocks[who] > b + 1]
    for b in range(order.shape[1] - 1, -1, -1):
        who = np.flatnonzero(blocks > b)
        here = order[who, b]
        more = blocks[who] > b + 1
        if more.any():
            nxt = order[who[more], b + 1]
            out = np.einsum("ikl,il->ik", carry[nxt], right[nxt])
            right[here[more]] = out / out.sum(1, keepdims=True)
    forward = np.empty((len(node), labels))
    message = left
    head = nth == 0
    for k in range(steps):
        m = live[k]
        now = message[:m] @ t
        if k == 0:
            now[head[:m]] = s
        now *= e[start[:m] + k]
        now /= now.sum(1, keepdims=True)
        forward[start[:m] + k] = now
        message = now
    out = np.empty((len(node), labels))
    message = right.copy()
    for k in range(steps - 1, -1, -1):
        m = live[k]
        at = start[:m] + k
        both = forward[at] * message[:m]
        out[at] = both / both.sum(1, keepdims=True)
        now = (message[:m] * e[at]) @ t.T
        message[:m] = now / now.sum(1, keepdims=True)
    return out


def _by_word(e: np.ndarray, t: np.ndarray, s: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The same for many labels: steps as many as the longest sequence has words, over all sequences at once."""
    size = np.diff(bounds)
    longest = np.argsort(-size, kind="stable")
    start, size = bounds[:-1][longest], size[longest]
    live = [int(np.searchsorted(-size, -k, "right")) for k in range(1, int(size[0]) + 1)]
    out = np.empty(e.shape)
    now = np.empty((len(size), e.shape[1]))
    for k, m in enumerate(live):
        now = (now[:m] @ t if k else np.tile(s, (m, 1))) * e[start[:m] + k]
        now /= now.sum(1, keepdims=True)
        out[start[:m] + k] = now
    message = np.ones((len(size), e.shape[1]))
    for k in range(len(live) - 1, -1, -1):
        m = live[k]
        at = start[:m] + k
        out[at] *= message[:m]
        out[at] /= out[at].sum(1, keepdims=True)
        back = (message[:m] * e[at]) @ t.T
        message[:m] = back / back.sum(1, keepdims=True)
    return out


def _first_block(here: np.ndarray, start: np.ndarray, size: np.ndarray, e: np.ndarray, t: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Forward messages out of first blocks, step by step, where the moves have no inverse."""
    now = s * e[start[here]]
    for k in range(1, int(size[here].max())):
        on = size[here] > k
        now[on] = (now[on] @ t) * e[start[here][on] + k]
        now /= now.sum(1, keepdims=True)
    return now


def fit(texts: list[str], labels: list[str]) -> Crf:
    """Gradient ascent (Adagrad) on the conditional likelihood of words labelled with their text's language.

    Half of the sequences are texts as they are, half are pieces of 4 to 40 words of texts of all languages in random
    order: the moves between languages are learned from these code-switched sequences.
    """
    languages = sorted(set(labels))
    cells = cells_for(len(languages))
    crf = Crf(languages, np.zeros((cells, len(languages)), np.float32), np.zeros((len(languages),) * 2), np.zeros(len(languages)))
    if len(languages) < 2:
        return crf
    f = Features(pa.array(texts, pa.large_string()), cells)
    n = np.diff(f.words.bounds)
    number = {x: i for i, x in enumerate(languages)}
    y = np.repeat([number[x] for x in labels], n)
    rng = np.random.default_rng(5)
    pieces = []
    for a, b in zip(f.words.bounds[:-1], f.words.bounds[1:]):
        while a < b:
            to = min(b, a + int(rng.integers(4, 41)))
            pieces.append(np.arange(a, to))
            a = to
    mixed = np.concatenate([pieces[i] for i in rng.permutation(len(pieces))]) if pieces else np.zeros(0, np.int64)
    take = np.concatenate([np.arange(len(y)), mixed])
    take = take[: len(take) // SPAN * SPAN].reshape(-1, SPAN)
    if not len(take):
        return crf
    truth = y[take]
    k = len(languages)
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[:, :-1], truth[:, 1:]), 1)
    began = np.bincount(truth[:, 0], minlength=k)
    squares, squares_m, squares_f = np.full((cells, k), 1e-4), np.full((k, k), 1e-4), np.full(k, 1e-4)
    for _ in range(ROUNDS):
        score = f.scores(crf.weights)[take].astype(np.float64)
        e = np.exp(score - score.max(2, keepdims=True))
        t, s = np.exp(crf.moves), np.exp(crf.first)
        alpha, beta = np.empty_like(e), np.ones_like(e)
        now = s * e[:, 0]
        for i in range(SPAN):
            now = (now @ t) * e[:, i] if i else now
            now /= now.sum(1, keepdims=True)
            alpha[:, i] = now
        expected = np.zeros((k, k))
        for i in range(SPAN - 2, -1, -1):
            out = e[:, i + 1] * beta[:, i + 1]
            beta[:, i] = out @ t.T
            beta[:, i] /= beta[:, i].sum(1, keepdims=True)
            expected += t * ((alpha[:, i] / ((alpha[:, i] @ t) * out).sum(1, keepdims=True)).T @ out)
        p = alpha * beta
        p /= p.sum(2, keepdims=True)
        by_word = np.zeros((len(y), k))
        delta = -p
        delta[np.arange(len(take))[:, None], np.arange(SPAN)[None, :], truth] += 1
        np.add.at(by_word, take.ravel(), delta.reshape(-1, k))
        g = f.gradient(by_word / len(y)) - 1e-7 * crf.weights
        squares += g * g
        crf.weights += (RATE * g / np.sqrt(squares)).astype(np.float32)
        g = (seen - expected) / take.size
        squares_m += g * g
        crf.moves += RATE * g / np.sqrt(squares_m)
        g = (began - p[:, 0].sum(0)) / len(take)
        squares_f += g * g
        crf.first += RATE * g / np.sqrt(squares_f)
    return crf


def sample(docs: DataFrame, learn: Column) -> tuple[list[str], list[str]]:
    """At most TEXTS_EACH distinct texts of each labelled language, those with the smallest text hashes; windows of long ones."""
    h = F.xxhash64("text")
    usable = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.coalesce(learn, F.lit(False)).alias("learn")).where("learn and text is not null and lang is not null").withColumn("h", h)
    counts = stash(usable.select("lang", "h").distinct().groupBy("lang").count(), "languages")
    languages = counts.count()
    if not languages:
        return [], []
    each = max(8, min(TEXTS_EACH, TEXTS_ALL // languages))
    share = counts.select("lang", F.least(F.lit(1 << 30), F.ceil(F.lit(8 * each << 30) / F.col("count"))).alias("share"))
    near = usable.join(F.broadcast(share), "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("share"))
    size = F.length("text")
    at = (F.pmod(F.shiftright("h", 30), F.greatest(size - LONGEST, F.lit(1))) + 1).cast("int")
    window = F.when(size > LONGEST, F.substr("text", at, F.lit(LONGEST))).otherwise(F.col("text"))
    once = near.select("lang", "h", window.alias("text")).groupBy("lang", "h").agg(F.first("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 30)), "h"))
    rows = once.withColumn("rank", rank).where(F.col("rank") <= each).orderBy("lang", "h").select("text", "lang").collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def learned(docs: DataFrame, learn: Column) -> Crf:
    return fit(*sample(docs, learn))


def _judged(texts: pa.Array, crf: Crf) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, Features, np.ndarray]:
    """Per row: language, score, words, changes of label; and the words with their labels."""
    f = Features(texts, len(crf.weights))
    b = f.words.bounds
    n = np.diff(b)
    letters = np.array([x is not None and LETTER.search(x) is not None for x in texts.to_pylist()], bool)
    if not crf.languages:
        return ["und"] * len(n), np.zeros(len(n)), n, np.zeros(len(n), np.int64), f, np.zeros(len(f.size), np.int64)
    p = chain_marginals(f.scores(crf.weights), crf.moves, crf.first, b)
    sums = np.concatenate([np.zeros((1, p.shape[1])), np.cumsum(p, 0)])
    mean = (sums[b[1:]] - sums[b[:-1]]) / np.maximum(n, 1)[:, None]
    best = np.round(mean, 9).argmax(1)
    label = p.argmax(1) if len(p) else np.zeros(0, np.int64)
    change = np.zeros(len(label) + 1, np.int64)
    change[1:-1] = label[1:] != label[:-1]
    change[b[:-1][b[:-1] < len(change)]] = 0
    total = np.concatenate([[0], np.cumsum(change)])
    names = [crf.languages[k] if ok else "und" for k, ok in zip(best, letters)]
    score = np.where(letters, np.clip(mean[np.arange(len(n)), best], 0, 1), 0.0)
    return names, score, n, total[b[1:]] - total[b[:-1]], f, label


def predict(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, lang_pred, score, n_words, n_switches): the language with the most label mass over a whole text's words.

    Null texts and texts without a letter are `und` with score 0, as is everything when nothing was learned. Ties go to
    the first name. Rows stay as many as they are; other columns are not read.
    """
    model = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", _batch_bytes(model.value)):
            names, score, n, changes, _, _ = _judged(batch.column("text"), model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names), pa.array(score), pa.array(n), pa.array(changes)], ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("lang_pred string, score double, n_words long, n_switches long").fields]))


def label_runs(docs: DataFrame, crf: Crf) -> DataFrame:
    """(doc_id, first_word, n_words, lang): runs of equally labelled words of code-switched texts."""
    model = docs.sparkSession.sparkContext.broadcast(crf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", _batch_bytes(model.value)):
            _, _, n, _, f, label = _judged(batch.column("text"), model.value)
            if len(label) and model.value.languages:
                row = np.repeat(np.arange(len(n)), n)
                new = np.concatenate([[True], (label[1:] != label[:-1]) | (row[1:] != row[:-1])])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(row[at])), pa.array(at - f.words.bounds[row[at]]), pa.array(np.diff(np.append(at, len(label)))), pa.array([model.value.languages[k] for k in label[at]])],
                    ["doc_id", "first_word", "n_words", "lang"],
                )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("first_word long, n_words long, lang string").fields]))


def accept(docs: DataFrame, crf: Crf, least: float = 0.3) -> DataFrame:
    """The rows, unchanged, whose text has a letter and one language holding at least that share of its words' label mass."""
    model = docs.sparkSession.sparkContext.broadcast(crf)
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            named = whole.rename_columns([f"c{i}" for i in range(whole.num_columns)])
            for batch in by_size(iter([named]), f"c{text}", _batch_bytes(model.value)):
                names, score, *_ = _judged(batch.column(text), model.value)
                keep = np.array([x != "und" for x in names], bool) & (score >= least) if model.value.languages else np.array([x is not None and LETTER.search(x) is not None for x in batch.column(text).to_pylist()], bool)
                yield batch.filter(pa.array(keep, pa.bool_())).rename_columns(whole.schema.names)

    return docs.mapInArrow(run, docs.schema)


def remainder(docs: DataFrame, divisor: int) -> Column:
    return F.crc32(docs["doc_id"].cast("string")) % divisor


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text of `documents`, learned from those whose crc32 remainder by 4 is not 2."""
    docs = table(spark, sf_dir, "documents")
    out = predict(docs, learned(docs, remainder(docs, 4) != 2))
    return out.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_words", "n_switches")
