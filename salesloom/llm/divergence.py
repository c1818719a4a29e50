"""Divergence of sources from each other and from their language, over terms counted by chunk factorization."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm.shared import by_size, spread, stash, table

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
BLOCK_BYTES = 16 << 20
#: Sources of a tile and terms of a block, some so many: what one task holds of the table of probabilities.
TILE, TERM_BLOCK = 256, 4096
#: A term: ASCII letters and bytes of longer code points.
TERM = re.compile(rb"[a-z\x80-\xff]+")

BLOCKS = "lang string, chunk string, documents int, places array<long>, sources array<long>, counts array<long>"
TERMS = "lang string, term string, documents long, places array<long>, sources array<long>, counts array<long>"


def _lists(starts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()), values)


def _firsts(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the sorted keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block of documents, language and chunk: in how many of them it is, where (if below LEAST_DOCUMENTS), how often per source."""
    block = TaskContext.get().partitionId() << 40
    for batch in _gathered(batches):
        words = pc.ascii_split_whitespace(batch.column("text").cast(pa.large_string()))
        ends = np.asarray(words.offsets).astype(np.int64)
        row = np.repeat(np.arange(batch.num_rows), np.diff(ends))
        coded = words.flatten().dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        some = np.asarray(pc.greater(pc.binary_length(coded.dictionary), 0))  # empty pieces beside leading and trailing blanks
        row, code = row[some[code]], code[some[code]]
        langs = batch.column("lang").dictionary_encode()
        lang = np.asarray(langs.indices).astype(np.int64)
        source = batch.column("source_key").to_numpy()
        n_rows = max(batch.num_rows, 1)
        pair, times = np.unique((lang[row] * max(len(some), 1) + code) * n_rows + row, return_counts=True)
        group, doc = pair // n_rows, pair % n_rows
        first = _firsts(group)
        documents = np.diff(np.append(first, len(group)))
        of = np.repeat(np.arange(len(first)), documents)
        rare = documents[of] < LEAST_DOCUMENTS
        order = np.lexsort((source[doc], of))
        at = _firsts(of[order], source[doc][order])
        sums = np.add.reduceat(times[order], at) if len(at) else times
        yield pa.RecordBatch.from_arrays(
            [
                langs.dictionary.take(pa.array(group[first] // max(len(some), 1))),
                coded.dictionary.take(pa.array(group[first] % max(len(some), 1))).cast(pa.string()),
                pa.array(documents, pa.int32()),
                _lists(np.searchsorted(of[rare], np.arange(len(first))), pa.array(block + doc[rare])),
                _lists(np.searchsorted(of[order][at], np.arange(len(first))), pa.array(source[doc][order][at])),
                _lists(np.searchsorted(of[order][at], np.arange(len(first))), pa.array(sums)),
            ],
            ["lang", "chunk", "documents", "places", "sources", "counts"],
        )
        block += batch.num_rows


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about BLOCK_BYTES of text, one row at least."""
    held, size = [], 0
    for batch in by_size(batches, "text", BLOCK_BYTES):
        n = pc.sum(pc.binary_length(batch.column("text"))).as_py() or 0
        if held and size + n > BLOCK_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        held.append(batch)
        size += n
    if held and sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _merged(rows: pa.Table) -> pa.Table:
    """One row per (chunk, lang) of rows sorted by them: documents and counts summed, places joined while they can matter."""
    chunk, lang = rows.column("chunk").combine_chunks(), rows.column("lang").combine_chunks()
    new = np.ones(len(chunk), bool)
    new[1:] = np.asarray(pc.or_(pc.not_equal(chunk[1:], chunk[:-1]), pc.not_equal(lang[1:], lang[:-1])))
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    documents = np.add.reduceat(rows.column("documents").to_numpy().astype(np.int64), first)
    places, sources, counts = (rows.column(x).combine_chunks() for x in ("places", "sources", "counts"))
    of = group[np.repeat(np.arange(len(group)), np.diff(np.asarray(places.offsets)))]
    rare = documents[of] < LEAST_DOCUMENTS
    place, of_place = places.flatten().to_numpy()[rare], of[rare]
    of = group[np.repeat(np.arange(len(group)), np.diff(np.asarray(sources.offsets)))]
    source, count = sources.flatten().to_numpy(), counts.flatten().to_numpy()
    order = np.lexsort((source, of))
    of, source, count = of[order], source[order], count[order]
    at = _firsts(of, source)
    starts = np.searchsorted(of[at], np.arange(len(first)))
    return pa.table(
        {
            "lang": lang.take(pa.array(first)), "chunk": chunk.take(pa.array(first)), "documents": documents, "places": _lists(np.searchsorted(of_place, np.arange(len(first))), pa.array(place)),
            "sources": _lists(starts, pa.array(source[at])), "counts": _lists(starts, pa.array(np.add.reduceat(count, at) if len(at) else count)),
        }
    )


def _terms(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows (one per chunk and language) under the chunk's terms, counts times the term's occurrences in the chunk."""
    coded = rows.column("chunk").combine_chunks().dictionary_encode()
    number, times, terms = [], [], []
    for i, chunk in enumerate(coded.dictionary.cast(pa.binary()).to_pylist()):
        found = TERM.findall(chunk.lower())
        if len(found) > 1:
            for term, n in Counter(found).items():
                number.append(i)
                times.append(n)
                terms.append(term)
        elif found:
            number.append(i)
            times.append(1)
            terms.append(found[0])
    code = np.asarray(coded.indices)
    many = np.bincount(np.array(number, np.int64), minlength=len(coded.dictionary))  # terms of each chunk
    row, nth = spread(many[code])
    of = (np.cumsum(many) - many)[code[row]] + nth
    out = rows.take(pa.array(row))
    counts = out.column("counts").combine_chunks()
    size = np.diff(np.asarray(counts.offsets))
    counts = _lists(np.cumsum(size) - size, pa.array(counts.flatten().to_numpy() * np.repeat(np.array(times, np.int64)[of], size)))
    words = pa.array(terms, pa.binary()).cast(pa.string()).take(pa.array(of))
    yield from pa.table({"lang": out.column("lang"), "term": words, "documents": out.column("documents"), "places": out.column("places"), "sources": out.column("sources"), "counts": counts}).combine_chunks().to_batches(10_000)


def _tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk and language, a chunk's all in one task: they are summed as they come, then the chunk is tokenized once."""
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if not rows.num_rows:
            continue
        rows = _merged(pa.concat_tables([held, rows.cast(held.schema)]) if held is not None else rows)
        last = rows.column("chunk")[-1]
        start = rows.num_rows - pc.sum(pc.equal(rows.column("chunk"), last)).as_py()
        held = rows.slice(start)
        if start:
            yield from _terms(rows.slice(0, start))
    if held is not None:
        yield from _terms(held)


def source_keys(docs: DataFrame) -> tuple[DataFrame, int]:
    """Distinct (lang, source, source_key) and the seed under which no two sources share a key."""
    names = stash(docs.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        keyed = names.withColumn("source_key", F.xxhash64(F.lit(seed), "source"))
        found = keyed.select("source", "source_key").distinct().agg(F.count("*").alias("n"), F.countDistinct("source_key").alias("k")).first()
        if found["n"] == found["k"]:
            return keyed, seed
        seed += 1


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Groups (lang, source) and counts (lang, source, term, count > 0) of the terms in at least LEAST_DOCUMENTS documents of their language.

    Documents are cut into chunks at ASCII white space, which no term contains, and chunks are counted by blocks of documents. All rows of a chunk
    then meet in order of the chunk, so each distinct chunk of the corpus is tokenized once and its terms join the counts there, as a stream.
    A term of one frequent chunk is in enough documents; one whose chunks' documents do not sum up to enough is not; only for the others, which have
    several chunks, all rare, distinct documents are counted one by one. Null text, lang and source are ''. Rows that repeat a doc_id
    are documents of their own; doc_id and other columns are not read. The documents are a stored table: a task that is repeated numbers its rows alike.
    """
    assert least <= LEAST_DOCUMENTS
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    plain = docs.select(text("text"), text("lang"), text("source"))
    groups, seed = source_keys(plain)
    keyed = plain.select("text", "lang", F.xxhash64(F.lit(seed), "source").alias("source_key"))
    chunks = keyed.mapInArrow(_count_chunks, BLOCKS)
    terms = stash(chunks.repartition("chunk").sortWithinPartitions("chunk", "lang").mapInArrow(_tokenize, TERMS), "terms")
    bounds = terms.groupBy("lang", "term").agg(F.max("documents").alias("low"), F.sum("documents").alias("high")).where(F.col("high") >= least)
    bounds = stash(bounds, "bounds")
    unsure = bounds.where(F.col("low") < least).select("lang", "term")
    places = terms.where(F.col("documents") < least).select("lang", "term", "places").join(unsure, ["lang", "term"], "left_semi")
    apart = places.select("lang", "term", F.explode("places").alias("place")).distinct().groupBy("lang", "term").count().where(F.col("count") >= least)
    kept = stash(bounds.where(F.col("low") >= least).select("lang", "term").unionByName(apart.select("lang", "term")), "kept")
    each = terms.select("lang", "term", "sources", "counts").join(kept, ["lang", "term"])
    each = each.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("lang", "term", F.col("x.sources").alias("source_key"), F.col("x.counts").alias("count"))
    summed = each.groupBy("lang", "term", "source_key").agg(F.sum("count").alias("count"))
    counts = stash(summed.join(groups, ["lang", "source_key"]).select("lang", "source", "term", "count"), "counts")
    return groups.select("lang", "source"), counts


def _p(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exact; null without terms."""
    wide = "DECIMAL(27,0)"
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 2 AS {wide})) div CAST(nullif({total} + 2 * {terms}, 0) AS {wide})")


def _gap(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)); both are at most SCALE + 1, so their squares fit."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(frame: pa.Table) -> pa.Table:
    """For a block of terms and two tiles of sources: sums over the block's terms of the gap less the gap of two absent terms."""
    lang, side, sid, p = (frame.column(x) for x in ("lang", "side", "sid", "p"))
    side, sid, p = side.to_numpy(), sid.to_numpy(), p.to_numpy()
    absent = np.asarray(pc.is_null(frame.column("term")))
    coded = frame.column("term").combine_chunks().dictionary_encode()
    terms = len(coded.dictionary)
    coded = np.asarray(coded.indices.fill_null(0)).astype(np.int64)
    tiles, base = [], []
    for k in (0, 1):
        own = sid[absent & (side == k)]
        if not len(own):  # a tile with itself
            tiles.append(tiles[0])
            base.append(base[0])
            continue
        order = np.argsort(own)
        own, zero = own[order], p[absent & (side == k)][order]
        matrix = np.repeat(zero[None, :], max(terms, 1), 0)
        here = ~absent & (side == k)
        matrix[coded[here], np.searchsorted(own, sid[here])] = p[here]
        tiles.append(matrix if terms else matrix[:0])
        base.append((own, zero))
    (a_ids, a_zero), (b_ids, b_zero) = base
    sums = np.empty((len(b_ids), len(a_ids)), np.int64)
    for j in range(len(b_ids)):
        b = tiles[1][:, j : j + 1]
        d = tiles[0] - b
        gap = (d * d // (tiles[0] + b)).sum(0)
        d = a_zero - b_zero[j]
        sums[j] = gap - terms * (d * d // (a_zero + b_zero[j]))
    return pa.table({"lang": pa.array([lang[0].as_py()] * sums.size, pa.string()), "a": np.tile(a_ids, len(b_ids)), "b": np.repeat(b_ids, len(a_ids)), "part": sums.ravel()})


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from its language's other sources (`pair`) and which terms it overuses (`term`).

    Sums over all kept terms are made without the absent ones: a term in neither of two sources adds the same gap for both, so
    V times that gap is corrected by the terms that occur. The table of sources and terms is dealt out in tiles of TILE sources by blocks of some TERM_BLOCK terms;
    a result has one row per pair of a language's sources, which is what is asked for. A language with one source has no pairs, a source without
    terms no `term` rows; an empty table gives no rows. Ties rank by item.
    """
    groups, counts = term_counts(docs, least)
    by_lang = stash(counts.groupBy("lang", "term").agg(F.sum("count").alias("lang_count")), "by_lang")
    langs = by_lang.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_count").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sid = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1  # names of sources, not rows
    state = groups.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(0, ["v", "lang_total", "total"])
    state = stash(state.withColumn("sid", sid.cast("long")).withColumn("zero", _p("0", "total", "v")), "sources")
    shape = stash(state.groupBy("lang").agg((F.floor(F.max("sid") / TILE) + 1).alias("tiles"), F.greatest(F.ceil(F.first("v") / TERM_BLOCK), F.lit(1)).alias("blocks")), "shape")

    found = counts.join(state, ["lang", "source"]).withColumn("p", _p("count", "total", "v"))
    cells = found.join(shape, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks"))).select("lang", "sid", "term", "p", "tiles", "block")
    blank = state.where("v > 0").join(shape, "lang").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cells.unionByName(blank.select("lang", "sid", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"), "tiles", "block"))
    own = F.floor(F.col("sid") / TILE)
    met = cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    met = met.select("lang", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"), "sid", "term", "p")
    parts = met.groupBy("lang", "block", "low", "high").applyInArrow(_pair_sums, "lang string, a long, b long, part long")
    sums = parts.where("a <> b").groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    # tiles that differ meet once: their pairs are turned round for the other order
    across = F.floor(F.col("a") / TILE) != F.floor(F.col("b") / TILE)
    sums = sums.unionByName(sums.where(across).select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "part"))
    one = state.select("lang", F.col("sid").alias("a"), "source", F.col("zero").alias("p0"), "v")
    two = state.select("lang", F.col("sid").alias("b"), F.col("source").alias("item"), F.col("zero").alias("q0"))
    pairs = one.join(two, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    value = F.when(F.col("v") > 0, F.col("v") * _gap("p0", "q0") + F.coalesce("part", F.lit(0))).otherwise(0)
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))

    over = found.join(by_lang, ["lang", "term"]).withColumn("q", _p("lang_count", "lang_total", "v")).where("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap("p", "q").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = pairs.withColumn("rank", rank).unionByName(over.withColumn("rank", rank).where(F.col("rank") <= top))
    return ranked


def op13_chunk_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of `documents`."""
    return divergence(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
t AS (SELECT k, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT k) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cl AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM cl GROUP BY lang),
g AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(s.total, 0) AS total FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN v USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) s ON s.lang = g.lang AND s.source = g.source),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // CAST(g.total + 2 * g.v AS HUGEINT) AS p
  FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair_rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
q AS (SELECT lang, cl.term, 1 + CAST(1000000000 AS HUGEINT) * (cl.n + 2) // CAST(v.total + 2 * v.v AS HUGEINT) AS q FROM cl JOIN v USING (lang)),
term_rows AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pair_rows UNION ALL SELECT * FROM term_rows))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
