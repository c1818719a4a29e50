"""Benchmark items inside documents: size-partitioned MinHash containment search and exact verification, in SQL functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import small_side, stash, table

SHINGLE = 5
NOT_WORD = r"[^\p{L}\p{N}]+"


def word_array(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def shingles(words: Column, width: int) -> Column:
    """Distinct hashes of the shingles of that width. The words are bound as a lambda variable, so they are made once a row."""

    def of(w: Column) -> Column:
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (width - 1), F.lit(0)))
        return F.array_distinct(F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, width)])))

    return F.get(F.transform(F.array(words), of), F.lit(0))


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """(item_id, width, n, s): an item shorter than SHINGLE words is one shingle of its own width; items without words fall out."""
    words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_array(F.col("text").cast("string")).alias("w")).where("item_id is not null and size(w) > 0").withColumn("width", F.least(F.size("w"), F.lit(SHINGLE)))
    parts = [words.where(F.col("width") == k).select("item_id", "width", shingles(F.col("w"), k).alias("s")) for k in range(1, SHINGLE + 1)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("item_id", "width").agg(F.array_distinct(F.flatten(F.collect_list("s"))).alias("s")).withColumn("n", F.size("s"))


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """(h, item_id): MinHash signatures by size partition.

    Items are partitioned by the power of two above their size. A document with the share `threshold` of an item
    holds all but u - t*u of its shingles at most, u being the partition's upper bound, so one of the
    floor((1 - t) * u) + 1 smallest hashes is among the document's: no item is missed.
    """
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n"))))
    keep = (F.floor(F.lit(1 - threshold) * upper + 1e-9) + 1).cast("int")
    return items.select("item_id", F.explode(F.slice(F.sort_array("s"), F.lit(1), keep)).alias("h"))


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, item_id, n_item, n_found, containment) for each item of which a document holds at least `threshold`.

    Size is counted in distinct shingles of five words (lower-cased runs of letters and digits). The short side alone
    is sketched: a long document's own MinHash would say nothing about an item a thousandth of its size. Null and
    empty texts hold nothing; rows without doc_id or item_id fall out, rows that repeat an id count as one text set.
    Other columns are not read. An empty benchmark or an empty table gives no rows.
    """
    items = stash(item_shingles(benchmark), "items")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    found = None
    for (width,) in sorted(items.select("width").distinct().collect()):  # 1 to 5
        mine = items.where(F.col("width") == width)
        held = plain.select("doc_id", shingles(word_array(F.col("text")), width).alias("s"))
        sign = small_side(stash(signatures(mine, threshold), "signatures"))
        hit = held.select("doc_id", F.explode("s").alias("h")).join(sign, "h")
        candidates = stash(hit.groupBy("doc_id").agg(F.count("*")).select("doc_id"), "candidates")
        again = plain.join(small_side(candidates), "doc_id").select("doc_id", shingles(word_array(F.col("text")), width).alias("s"))
        exact = small_side(stash(mine.select("item_id", F.col("n").alias("n_item"), F.explode("s").alias("h")), "exact"))
        pairs = again.select("doc_id", F.explode("s").alias("h")).join(exact, "h").groupBy("doc_id", "item_id", "n_item").agg(F.countDistinct("h").alias("n_found"))
        pairs = pairs.where(F.col("n_found") >= F.ceil(F.col("n_item") * threshold - 1e-9))
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_item int, n_found long, containment double")
    return found.withColumn("containment", F.col("n_found") / F.col("n_item"))


def op9_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of `benchmark` inside `documents`."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, w[i:i + 4] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
bs AS (SELECT DISTINCT item_id, w[i:i + least(len(w), 5) - 1] AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id)
SELECT ds.doc_id, bs.item_id, CAST(any_value(n.n_item) AS INTEGER) AS n_item, count(*) AS n_found, count(*) / any_value(n.n_item) AS containment
FROM ds JOIN bs USING (s) JOIN n USING (item_id) GROUP BY ds.doc_id, bs.item_id
HAVING 10 * count(*) >= 8 * any_value(n.n_item)
"""
