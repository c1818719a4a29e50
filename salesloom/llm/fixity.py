"""Merkle fixity audit of archive replicas, in DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salesloom.llm.shared import stash, table

#: Children of a node are 16, four bits of a record's position; a page has at most 2**COPY_BITS records.
BITS, COPY_BITS = 4, 20
PAGE_BITS = 8
RECORDS_PER_FILE = 1 << PAGE_BITS


def records(pages: DataFrame) -> DataFrame:
    """(page_id, file, pos, first_byte, length, digest): pages as WARC response records of files of RECORDS_PER_FILE page ids.

    first_byte is the record's place in its file, in order of page_id; pos is the file, the number of the copy among the page's
    records and the page's place in the file, so it does not depend on other pages. Null urls
    and bodies are empty; pages without page_id fall out, repeated rows are records of their own.
    """
    url, body = F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))
    size = F.octet_length(body)
    record = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "), size.cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))
    plain = pages.where("page_id is not null").select(F.col("page_id").cast("long").alias("page_id"), F.sha2(record.cast("binary"), 256).alias("digest"), F.octet_length(record).cast("long").alias("length"))
    filed = plain.withColumn("file", F.floor(F.col("page_id") / RECORDS_PER_FILE).cast("long"))
    order = Window.partitionBy("file").orderBy("page_id", "digest")
    copy = F.row_number().over(Window.partitionBy("file", "page_id").orderBy("digest")) - 1
    pos = F.shiftleft("file", COPY_BITS + PAGE_BITS) + F.shiftleft(copy.cast("long"), PAGE_BITS) + F.pmod("page_id", F.lit(RECORDS_PER_FILE))
    return filed.withColumn("first_byte", (F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")).cast("long")).withColumn("pos", pos)


def tree(leaves: DataFrame) -> list[DataFrame]:
    """Levels from the records up to one root: (replica, pos, hash, file, low, high, n), a node covering the bytes low to high of its files.

    leaves: replica and the columns of records(). A node's hash covers its children's positions and hashes in order, a record's its page, length and digest: not its place in
    the file, which a lost or truncated record moves.
    A group has 16 children at most; each level is stored, so a lost executor costs one level.
    """
    hashed = F.sha2(F.concat_ws(":", "page_id", "length", "digest"), 256)
    level = stash(leaves.select("replica", "pos", hashed.alias("hash"), F.col("first_byte").alias("low"), (F.col("first_byte") + F.col("length")).alias("high"), F.lit(1).cast("long").alias("n"), "page_id", "file", "length"), "leaves")
    low, high = level.agg(F.min("pos"), F.max("pos")).first()
    level = level.withColumn("pos", F.col("pos") - F.lit(low or 0))  # page ids may be negative: the tree stands over 0 and up
    levels = [level]
    top = high - low if low is not None else 0
    while top:
        child = F.sort_array(F.collect_list(F.struct("pos", "hash")))
        grouped = levels[-1].groupBy("replica", F.shiftright("pos", BITS).alias("up")).agg(child.alias("c"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        text: Column = F.array_join(F.transform("c", lambda x: F.concat_ws(":", x.pos, x.hash)), "|")
        levels.append(stash(grouped.select("replica", F.col("up").alias("pos"), F.sha2(F.concat_ws(":", "n", text), 256).alias("hash"), "low", "high", "n"), "level"))
        top >>= BITS
    return levels


def audit(levels: list[DataFrame]) -> DataFrame:
    """(page_id, file, first_byte, length, status) of records that differ between replicas 'a' and 'b': changed, missing (in b) or extra.

    Records of a page that have an equal one in the other replica are intact wherever they stand; the others are paired in order. Roots are compared first; of each level only the children of differing nodes are read on. Equal replicas give no rows after one comparison.
    """
    suspects = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        if suspects is not None:
            nodes = nodes.join(suspects, F.shiftright("pos", BITS) == F.col("suspect"), "left_semi")
        extra = ["page_id", "file", "low", "length"] if depth == 0 else []
        a = nodes.where("replica = 'a'").select("pos", F.col("hash").alias("a"), *extra)
        b = nodes.where("replica = 'b'").select("pos", F.col("hash").alias("b"), *[F.col(x).alias(f"b_{x}") for x in extra])
        differ = a.join(b, "pos", "full_outer").where(~F.col("a").eqNullSafe(F.col("b")))
        if depth:
            suspects = stash(differ.select(F.col("pos").alias("suspect")), "suspects")
    fields = ("page_id", "file", "low", "length")
    sides = differ.where("a is not null").select(F.lit("a").alias("replica"), F.col("a").alias("hash"), *fields)
    sides = sides.unionByName(differ.where("b is not null").select(F.lit("b").alias("replica"), F.col("b").alias("hash"), *[F.col(f"b_{x}").alias(x) for x in fields]))
    nth = sides.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "hash", "replica").orderBy("low")))
    alone = nth.withColumn("sides", F.count("*").over(Window.partitionBy("page_id", "hash", "nth"))).where("sides = 1")
    ranked = alone.withColumn("rank", F.row_number().over(Window.partitionBy("page_id", "replica").orderBy("low", "hash")))
    of = lambda replica: F.max(F.when(F.col("replica") == replica, F.struct("file", "low", "length"))).alias(replica)
    pairs = ranked.groupBy("page_id", "rank").agg(of("a"), of("b"))
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("changed")
    own = F.coalesce("a", "b")
    return pairs.select("page_id", own["file"].alias("file"), own["low"].alias("first_byte"), own["length"].alias("length"), status.alias("status"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica to audit: every page's copy, some with one character changed, some zeroed, and files' last pages lost.

    The damage follows from page_id alone, and keeps lengths, as failing disks do.
    """
    body = F.col("html")
    flipped = F.when(F.col("page_id") % 97 == 3, F.concat(F.lit("#"), F.expr("substr(html, 2)")))
    zeroed = F.when(F.col("page_id") % 101 == 5, F.repeat(F.lit("0"), F.octet_length(body)))
    lost = (F.col("page_id") % RECORDS_PER_FILE == RECORDS_PER_FILE - 1) & (F.floor(F.col("page_id") / RECORDS_PER_FILE) % 7 == 2)
    return pages.withColumn("html", F.coalesce(flipped, zeroed, body)).where(~F.coalesce(lost, F.lit(False)))


def op8_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage found between `pages` as an archive and its damaged replica."""
    pages = table(spark, sf_dir, "pages")
    leaves = records(pages).withColumn("replica", F.lit("a")).unionByName(records(damaged(pages)).withColumn("replica", F.lit("b")))
    return audit(tree(leaves))


OP8_SQL = """
WITH r AS (SELECT page_id, page_id // 256 AS file, html, CAST(octet_length(encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
  || chr(13) || chr(10) || 'Content-Length: ' || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10))) AS BIGINT) AS length
  FROM pages WHERE page_id IS NOT NULL),
p AS (SELECT *, CAST(sum(length) OVER (PARTITION BY file ORDER BY page_id) - length AS BIGINT) AS first_byte FROM r),
d AS (SELECT *, CASE WHEN page_id % 256 = 255 AND file % 7 = 2 THEN 'missing'
  WHEN page_id % 97 = 3 AND html <> '' AND left(html, 1) <> '#' THEN 'changed'
  WHEN page_id % 97 <> 3 AND page_id % 101 = 5 AND html <> repeat('0', octet_length(encode(html))) THEN 'changed' END AS status FROM p)
SELECT page_id, file, first_byte, length, status FROM d WHERE status IS NOT NULL
"""
