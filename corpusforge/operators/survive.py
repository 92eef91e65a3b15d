"""Survivors and merged attributes of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def survivors(rows: DataFrame, group: str, order: list[str], id: str) -> DataFrame:
    """The first member of each group by order, the number of the others and their ids, lowest first."""
    first = F.min(F.struct(*order, id)).getField(id)
    return rows.groupBy(group).agg(first.alias("kept"), (F.count("*") - 1).alias("others"), F.sort_array(F.collect_list(id)).alias("ids")).select(group, "kept", "others", F.array_remove("ids", F.col("kept")).alias("also_in"))


def first_non_null(value: Column, order: Column) -> Column:
    """Aggregate; the first value in order that is not null."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def unanimous(value: Column) -> Column:
    """Aggregate; the value if all that have one agree, else null."""
    return F.when(F.count_distinct(value) == 1, F.min(value))


def best_by(value: Column, *rank: Column) -> Column:
    """Aggregate; the value of the highest rank."""
    return F.max_by(value, F.struct(*rank))


def majority(rows: DataFrame, group: str, value: str, order: str, precedence: Column | None = None) -> DataFrame:
    """Per group the value of its first row that takes precedence, else the most frequent one, the earliest of equals."""
    counts = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    mode = counts.groupBy(group).agg(F.max_by(value, F.struct("n", -F.col("at"))).alias("mode"))
    if precedence is None:
        return mode.select(group, F.col("mode").alias("chosen"))
    ahead = rows.filter(precedence).groupBy(group).agg(F.min_by(value, order).alias("ahead"))
    return mode.join(ahead, group, "full").select(group, F.coalesce("ahead", "mode").alias("chosen"))
