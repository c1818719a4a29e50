"""Keyed operators that hold up when one key owns a large share of the rows.

Three building blocks replace windows and plain joins over user-controlled keys:

* ``keyed_left_join`` - left join that never sends a hot key to one task;
* ``annotate_keys``   - per-key aggregates attached to every row of the key;
* ``running_sum``     - prefix sums in two bounded levels.

A key is *hot* when it has more than ``hot_rows`` rows. There are at most
``rows / hot_rows`` hot keys, which is the size bound of the one table that is
broadcast here.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesloom.session import stored

HOT_ROWS = 1_000_000
SPREAD = 1 << 16
BLOCK = 1 << 16


BROADCAST_ROWS = 500_000


def bounded_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint for a table of known row count; beyond the limit the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def _any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


_NULL, _ESCAPE, _UNIT = "\x00", "\x1e", "\x1f"


def packed(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The text columns as one, which a shuffle moves in half the bytes; ``unpacked`` gives them back byte for byte."""

    def cell(c: str) -> Column:
        x = F.col(c)
        marked = F.replace(F.replace(F.replace(x, F.lit(_ESCAPE), F.lit(_ESCAPE + "0")), F.lit(_UNIT), F.lit(_ESCAPE + "1")), F.lit(_NULL), F.lit(_ESCAPE + "2"))
        other = F.when(x.isNull(), _NULL).when(~F.is_valid_utf8(x), F.concat(F.lit(_ESCAPE + "3"), F.hex(x)))
        return other.when(x.rlike(f"[{_NULL}{_ESCAPE}{_UNIT}]"), marked).otherwise(x)

    return rows.select(*[c for c in rows.columns if c not in columns], F.concat_ws(_UNIT, *[cell(c) for c in columns]).alias(name))


def unpacked(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The columns that ``packed`` put into one."""

    def cell(i: int) -> Column:
        x = F.col(name)[i]
        plain = F.replace(F.replace(F.replace(x, F.lit(_ESCAPE + "1"), F.lit(_UNIT)), F.lit(_ESCAPE + "2"), F.lit(_NULL)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))
        raw = F.unhex(F.substring(x, 3, 1 << 30)).cast("string")
        return F.when(x == _NULL, F.lit(None)).when(x.startswith(_ESCAPE + "3"), raw).when(x.contains(_ESCAPE), plain).otherwise(x)

    apart = rows.withColumn(name, F.split(name, _UNIT, -1))
    return apart.select("*", *[cell(i).alias(c) for i, c in enumerate(columns)]).drop(name)


def _with_hot_match(rows, keys, hot, payload):
    """Broadcast-join the hot keys' payload; rows of hot or null keys get a spreading salt."""
    renamed = hot.select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        F.lit(True).alias("_hot"),
        (F.struct(*payload) if payload else F.lit(True)).alias("_hot_payload"),
    )
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_h_{k}") for k in keys])
    return rows.join(F.broadcast(renamed), on, "left").drop(*[f"_h_{k}" for k in keys])


def keyed_left_join(
    rows: DataFrame, table: DataFrame, keys: list[str], hot: DataFrame, spread_on: list[str]
) -> DataFrame:
    """``rows LEFT JOIN table USING (keys)``; ``table`` holds each key at most once.

    ``hot`` is the part of ``table`` whose keys are hot in ``rows``: those rows
    are matched by broadcast and stay where they are. Rows with a null key are
    spread as well, they can match nothing.
    """
    payload = [c for c in table.columns if c not in keys]
    staged = _with_hot_match(rows, keys, hot.select(*table.columns), payload)
    staged = staged.withColumn(
        "_salt",
        F.when(
            F.col("_hot").isNotNull() | _any_null(keys), 1 + F.pmod(F.xxhash64(*spread_on), F.lit(SPREAD))
        ).otherwise(F.lit(0).cast("bigint")),
    )
    cold = table.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.lit(0).cast("bigint").alias("_c_salt"),
        F.struct(*payload).alias("_cold_payload"),
    )
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_c_{k}") for k in keys])
    joined = staged.join(cold, on & (F.col("_salt") == F.col("_c_salt")), "left")
    picked = F.coalesce("_hot_payload", "_cold_payload")
    return joined.select(*rows.columns, *[picked[c].alias(c) for c in payload])


def hot_keys(rows: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows (at most rows / hot_rows of them)."""
    counts = rows.where(~_any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return counts.where(F.col("_n") > hot_rows).select(*keys)


def lookup_left_join(
    rows: DataFrame, table: DataFrame, keys: list[str], spread_on: list[str], hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS, whole: bool = False,
) -> DataFrame:
    """Left join of ``rows`` to a table unique on ``keys``, safe for hot keys.

    A table counted to at most ``broadcast_rows`` rows is broadcast. A larger
    one is shuffled, with the keys that are hot in ``rows`` matched apart. With
    ``whole``, for a caller that reads every column, the rows are stored before,
    as their keys are counted first, and their texts are shuffled as one column.
    """
    if broadcast_rows and table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), keys, "left").select(*rows.columns, *[c for c in table.columns if c not in keys])
    texts = [c for c, t in rows.dtypes if t == "string" and c not in [*keys, *spread_on]] if whole else []
    dealt = stored(rows) if whole else rows
    hot = table.join(F.broadcast(hot_keys(dealt, keys, hot_rows)), keys, "left_semi")
    if not texts:
        return keyed_left_join(dealt, table, keys, hot, spread_on)
    joined = keyed_left_join(packed(dealt, texts, "_texts"), table, keys, hot, spread_on)
    return unpacked(joined, texts, "_texts").select(*rows.columns, *[c for c in table.columns if c not in keys])


def _sieved(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with ``_may``, whether their key may repeat; false for null keys. ``rows`` are read twice.

    40 bits of the keys' hashes are counted; those that repeat mark the bits of a map, some eight bits a mark and 32 MB at
    most, which is broadcast: an upper bound of the rows to deal by key, the closer the fewer keys repeat.
    """
    mark = F.shiftrightunsigned(F.xxhash64(*keys), 24)
    counted = rows.where(~_any_null(keys)).groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n"))
    marks = stored(counted.where("_n > 1").select("_mark"))
    bits = 1 << min(28, max(15, (8 * marks.count()).bit_length()))
    place = lambda x: F.pmod(x, F.lit(bits))
    word, bit = (lambda x: F.shiftright(place(x), 15)), (lambda x: place(x) % 32768)
    maps = marks.select(word(F.col("_mark")).alias("_word"), bit(F.col("_mark")).alias("_bit")).repartition("_word")
    maps = maps.groupBy("_word").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (bit(mark) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("shiftright(_byte, _at) & 1") == 1
    joined = rows.withColumns({"_of": word(mark), "_at": (bit(mark) % 8).cast("int")}).join(F.broadcast(maps), F.col("_of") == F.col("_word"), "left")
    tested = joined.withColumn("_byte", byte).withColumn("_may", F.coalesce(marked, F.lit(False)) & ~_any_null(keys))
    return tested.select(*rows.columns, "_may")


def annotate_keys(
    rows: DataFrame,
    keys: list[str],
    aggregates: dict[str, Column],
    spread_on: list[str],
    where: Column | None = None,
    hot_rows: int = HOT_ROWS,
    keep: Callable[[DataFrame], DataFrame] = lambda stats: stats,
    few_repeated: bool = False,
    sieve: bool = False,
) -> DataFrame:
    """Attach per-key aggregates (and ``_n``, the key's row count) to each row.

    Only keys with several rows are joined back; a single row keeps nulls and
    ``_n = 1``. The aggregate combines map-side, so a hot key shuffles one row
    per map task. ``keep`` stores the aggregates, which hold repeated keys only:
    where these are few, the rows are not shuffled. With ``few_repeated`` hashes
    of the keys are counted first, and only rows whose hash repeats are aggregated.
    With ``sieve``, for stored rows, all others stay where they are read.
    """
    if sieve:
        tested = _sieved(rows if where is None else rows.withColumn("_judged", where), keys)
        may = annotate_keys(tested.where("_may").drop("_may"), keys, aggregates, spread_on, None if where is None else F.col("_judged"), hot_rows, keep)
        known = dict(may.dtypes)
        rest = tested.where("NOT _may").select(*rows.columns, F.lit(1).cast("bigint").alias("_n"), *[F.lit(None).cast(known[a]).alias(a) for a in aggregates])
        return may.select(*rest.columns).unionByName(rest)
    base = rows if where is None else rows.where(where)
    if few_repeated:
        mark = F.shiftrightunsigned(F.xxhash64(*keys), 24)  # 40 bits: fewer bytes dealt, and still few keys that share one by chance
        marks = base.where(~_any_null(keys)).groupBy(mark.alias("_mark")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_mark")
        base = base.join(keep(marks), mark == F.col("_mark"), "left_semi")
    stats = (
        base.where(~_any_null(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in aggregates.items()])
        .where(F.col("_n") > 1)
    )
    stats = keep(stats)
    hot = stats.where(F.col("_n") > hot_rows)
    joined = keyed_left_join(rows, stats, keys, hot, spread_on)
    return joined.withColumn("_n", F.coalesce("_n", F.lit(1).cast("bigint")))


def running_sum(
    rows: DataFrame, group: list[str], position: str, sums: dict[str, str], block: int = BLOCK
) -> DataFrame:
    """Inclusive prefix sums per group, ordered by the integer ``position``.

    ``position`` is unique within its group. Positions are cut into blocks of
    ``block`` values, so a window holds at most ``block`` rows of a group, and
    the block totals of a group (at most 2**31 / block of them) are summed by a
    second, equally bounded window. ``sums`` maps output to input column.
    """
    staged = rows.withColumn("_block", F.floor(F.col(position) / block).cast("bigint"))
    order = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    offsets = (
        staged.groupBy(*group, "_block")
        .agg(*[F.sum(source).alias(f"_t_{out}") for out, source in sums.items()])
        .select(*group, "_block", *[F.coalesce(F.sum(f"_t_{o}").over(order), zero).alias(f"_o_{o}") for o in sums])
    )
    inner = Window.partitionBy(*group, "_block").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    local = staged.select(*staged.columns, *[F.sum(source).over(inner).alias(f"_l_{out}") for out, source in sums.items()])
    joined = local.join(offsets, [*group, "_block"], "inner")
    return joined.select(*rows.columns, *[(F.col(f"_l_{o}") + F.col(f"_o_{o}")).alias(o) for o in sums])
