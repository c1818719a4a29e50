"""Point-in-interval joins as equi-joins on dyadic intervals.

An interval of days is the union of at most 2 * LEVELS dyadic ones, [k * 2^level, (k + 1) * 2^level); a day lies in exactly one of
each level. So days and intervals meet on (level, k): no nested loop, and an interval's length does not count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Days are numbered from 0 for the years 1 to 9999; 2^LEVELS days hold them all.
LEVELS = 22
FIRST_DAY = -719_162
LAST_DAY = 2_932_896


def day_number(day: Column) -> Column:
    return (F.unix_date(day) - FIRST_DAY).cast("bigint")


def pieces(low: Column, high: Column) -> Column:
    """array<struct<level, k>> of the dyadic intervals that make up the days low to high; a null bound is open, an empty interval has none."""
    first = F.coalesce(day_number(low), F.lit(0).cast("bigint"))
    after = F.coalesce(day_number(high), F.lit(LAST_DAY - FIRST_DAY).cast("bigint")) + 1
    none = F.array().cast("array<struct<level:int,k:bigint>>")
    start = F.struct(first.alias("l"), after.alias("r"), none.alias("out"))

    def step(state: Column, level: Column) -> Column:
        left, right = state["l"], state["r"]
        node = lambda k: F.array(F.struct(level.cast("int").alias("level"), k.cast("bigint").alias("k")))
        odd_left, odd_right = (left < right) & (left % 2 == 1), (left < right) & (right % 2 == 1)
        out = F.concat(state["out"], F.when(odd_left, node(left)).otherwise(none), F.when(odd_right, node(right - 1)).otherwise(none))
        up_left = F.floor((left + F.when(odd_left, 1).otherwise(0)) / 2).cast("bigint")
        up_right = F.floor((right - F.when(odd_right, 1).otherwise(0)) / 2).cast("bigint")
        return F.struct(up_left.alias("l"), up_right.alias("r"), out.alias("out"))

    # where both ends are odd and meet, left + 1 > right - 1 and nothing is left above
    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["out"])


def ancestors(day: Column) -> Column:
    """array<struct<level, k>> of the dyadic intervals that a day lies in."""
    number = day_number(day)
    return F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda level: F.struct(level.cast("int").alias("level"), F.floor(number / F.pow(F.lit(2.0), level)).cast("bigint").alias("k")))


def interval_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, on: list[str] | None = None) -> DataFrame:
    """``points`` with every interval that holds their day, bounds included, among those equal on ``on``.

    Only distinct days (with their keys) take ancestors; the rows meet the result by key and day. Null days and keys match nothing.
    """
    on = on or []
    extra = [c for c in intervals.columns if c not in on]
    cut = intervals.withColumn("_p", F.explode(pieces(F.col(low), F.col(high))))
    days = points.select(*on, point).where(F.col(point).isNotNull()).distinct().withColumn("_a", F.explode(ancestors(F.col(point))))
    same = [F.col(f"_l.{c}") == F.col(f"_r.{c}") for c in on]
    same += [F.col("_l._a.level") == F.col("_r._p.level"), F.col("_l._a.k") == F.col("_r._p.k")]
    met = days.alias("_l").join(cut.alias("_r"), reduce(lambda a, b: a & b, same))
    held = met.select(*[F.col(f"_l.{c}").alias(c) for c in [*on, point]], F.struct(*[F.col(f"_r.{c}").alias(c) for c in extra]).alias("_held"))
    joined = points.join(held, [*on, point])
    return joined.select(*points.columns, *[F.col(f"_held.{c}").alias(c) for c in extra])
