"""Upserts as full outer joins on unique keys, with the action of every row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F



def merge_upsert(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    changed: Column | None = None,
    assign: dict[str, Column] | None = None,
    on_insert: dict[str, Column] | None = None,
    on_update: dict[str, Column] | None = None,
) -> DataFrame:
    """``INSERT .. ON CONFLICT (keys) DO UPDATE .. WHERE changed`` over two tables.

    Both sides hold each key once. Expressions see the sides as ``o`` and ``n``.
    ``assign`` overrides the new value of a column on update; ``on_insert`` and
    ``on_update`` set columns the new side does not carry. The result has the
    columns of ``old`` plus ``merge_action`` (insert, update, keep).
    """
    assign, on_insert, on_update = assign or {}, on_insert or {}, on_update or {}
    flagged_old = old.withColumn("_in_old", F.lit(True)).alias("o")
    flagged_new = new.withColumn("_in_new", F.lit(True)).alias("n")
    on = reduce(lambda a, b: a & b, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys])
    joined = flagged_old.join(flagged_new, on, "full_outer")
    is_old, is_new = F.col("o._in_old").isNotNull(), F.col("n._in_new").isNotNull()
    update = is_old & is_new & (F.lit(True) if changed is None else F.coalesce(changed, F.lit(False)))
    action = F.when(is_new & ~is_old, "insert").when(update, "update").otherwise("keep")
    columns = []
    for field in old.schema.fields:
        name = field.name
        if name in keys:
            value = F.coalesce(f"o.{name}", f"n.{name}")
        else:
            incoming = F.col(f"n.{name}") if name in new.columns else None
            inserted = on_insert.get(name, incoming if incoming is not None else F.lit(None))
            updated = on_update.get(name, assign.get(name, incoming if incoming is not None else F.col(f"o.{name}")))
            value = F.when(is_new & ~is_old, inserted).when(update, updated).otherwise(F.col(f"o.{name}"))
        columns.append(value.cast(field.dataType).alias(name))
    return joined.select(*columns, action.alias("merge_action"))


def insert_missing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT .. ON CONFLICT DO NOTHING``: the old rows plus the unseen new ones."""
    fresh = new.join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def merge_counts(merged: DataFrame) -> dict[str, int]:
    """Rows by action."""
    rows = merged.groupBy("merge_action").count().collect()  # at most three rows
    counts = {row["merge_action"]: row["count"] for row in rows}
    return {"inserted": counts.get("insert", 0), "updated": counts.get("update", 0), "kept": counts.get("keep", 0)}


def replace_keys(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Every row of an updated key is replaced by the update (rows of a key may repeat)."""
    return existing.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)
