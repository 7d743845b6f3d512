"""Histories of versions and sets of names and identifiers: what is current, what changed, what came and went."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def current(history: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each group, whole; an aggregate that combines before the shuffle, so large groups are no matter.

    Rows of which the first column of ``order`` is null count only where a group has no others; ties in ``order`` go to the
    greater values of the other columns.
    """
    rest = [c for c in history.columns if c not in by]
    at = F.struct(F.col(f"`{order[0]}`").isNotNull(), *(F.col(f"`{c}`") for c in [*order, *(c for c in rest if c not in order)]))
    newest = history.groupBy(*by).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in rest)), at).alias("__row"))
    return newest.select(*by, "__row.*").select(*(F.col(f"`{c}`") for c in history.columns))


def deltas(history: DataFrame, by: Sequence[str], order: str, value: str, stretch: int = 1_000_000) -> DataFrame:
    """Adds ``previous``, the value of the version before in the group, and ``changed``; the first version has changed
    unless its value is null.

    ``order`` is a number. Groups are cut into stretches of it, and the last version of each stretch is carried to the next,
    so a task has at most one stretch of a group. Equal orders follow their values; versions without an order have no
    previous one and are that of no other.
    """
    h = history.withColumn("__in", F.floor(F.col(order) / stretch))
    inside = Window.partitionBy(*by, "__in").orderBy(order, value)
    one = F.struct(F.col(value).alias("v"))
    last = h.where(F.col(order).isNotNull()).groupBy(*by, "__in").agg(F.max_by(one, F.struct(order, value)).alias("__last"))
    earlier = F.lag("__last").over(Window.partitionBy(*by).orderBy("__in"))
    carried = last.select(*(F.col(c).alias(f"__of{i}") for i, c in enumerate(by)), F.col("__in").alias("__at"), earlier.alias("__before"))
    same = F.col("__in") == F.col("__at")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"__of{i}"))
    joined = h.withColumn("__prev", F.lag(one).over(inside)).join(carried, same, "left")
    previous = F.when(F.col(order).isNotNull(), F.coalesce("__prev", "__before")["v"]).alias("previous")
    return joined.select(*(F.col(f"`{c}`") for c in history.columns), previous).withColumn("changed", ~F.col(value).eqNullSafe(F.col("previous")))


def newest(rows: DataFrame, order: Sequence[str], limit: int, where: Column | None = None) -> DataFrame:
    """The newest rows, of those that ``where`` holds for; each task keeps no more than ``limit``."""
    return (rows if where is None else rows.where(where)).orderBy(*(F.desc(c) for c in order)).limit(limit)


def logged(log: DataFrame, versions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Log rows with ``columns`` of their version; rows of unknown versions go. ``versions`` has each key once."""
    return log.join(versions.select(key, *columns), key)


def compared(old: DataFrame, new: DataFrame, name: str) -> DataFrame:
    """``name, change``: each name once, as ``added``, ``removed`` or ``common``, from one aggregate over both sides."""
    sides = old.select(name, F.lit(True).alias("o"), F.lit(False).alias("n")).unionAll(new.select(name, F.lit(False), F.lit(True)))
    kind = F.when(F.bool_or("o") & F.bool_or("n"), "common").when(F.bool_or("o"), "removed").otherwise("added")
    return sides.groupBy(name).agg(kind.alias("change"))


def identifiers(rows: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """``kind, id``: the distinct non-null values of several columns of one type, in one pass."""
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(c).alias("id")) for k, c in kinds.items()))
    return rows.select(F.inline(each)).where("id is not null").distinct()


def cited(items: DataFrame, key: str, references: DataFrame, to: str, sources: DataFrame, source: str) -> DataFrame:
    """Items that some row of ``references`` points to by ``to`` and whose ``source`` is among ``sources``; two semi-joins, no lists."""
    kept = references.join(sources.select(source), source, "left_semi").select(F.col(to).alias(key))
    return items.join(kept, key, "left_semi")
