"""Ordered lines: carry-forward, fences, trims, islands, pairing and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_lines(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ord, line), ord from 0 in the order of the text."""
    return docs.select(F.col(id), F.posexplode(F.split(text, "\n")).alias("ord", "line"))


def carry_forward(rows: DataFrame, partition: str, order: str, value: Column, name: str = "header") -> DataFrame:
    """The last value that isn't null, up to each row."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def fences(rows: DataFrame, partition: str, order: str, marker: Column) -> DataFrame:
    """is_marker, and inside, whether an odd number of markers stands before the line (markers are not inside)."""
    w = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    n = F.sum(marker.cast("int")).over(w)
    return rows.withColumn("is_marker", marker).withColumn("inside", (n % 2 == 1) & ~marker)


def edge_trim(rows: DataFrame, partition: str, order: str, line: str = "line") -> DataFrame:
    """Without blank lines at either end; a part of blank lines only goes."""
    w = Window.partitionBy(partition)
    filled = F.when(F.trim(line) != "", F.col(order))
    return rows.withColumn("_lo", F.min(filled).over(w)).withColumn("_hi", F.max(filled).over(w)).filter(F.col(order).between(F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def islands(rows: DataFrame, partition: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Numbers runs of rows from 1; a row for which `starts` holds begins one. Chain semantics: `starts` looks at the row before."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.sum(F.coalesce(starts, F.lit(True)).cast("int")).over(w))


def gap_to_previous(value: str, partition: list[str], order: list[str]) -> Column:
    return F.col(value) - F.lag(value).over(Window.partitionBy(*partition).orderBy(*order))


def adjacent_pairs(rows: DataFrame, partition: str, order: str, kind: str, first: str, second: str, value: str, near: Column | None = None) -> DataFrame:
    """A row of kind `first` with the next row, if that is of kind `second` (and `near` holds, which may use next_<value>)."""
    w = Window.partitionBy(partition).orderBy(order)
    paired = rows.withColumn("next_kind", F.lead(kind).over(w)).withColumn(f"next_{value}", F.lead(value).over(w)).withColumn("next_order", F.lead(order).over(w))
    hit = (F.col(kind) == first) & (F.col("next_kind") == second)
    return paired.filter(hit & near if near is not None else hit).drop("next_kind")


def forward_match(left: DataFrame, right: DataFrame, by: str, at: str, id: str, value: str) -> DataFrame:
    """For each left row the first right row of its key at or after it (as-of join, forward), in one pass over both."""
    both = left.select(by, at, F.col(id).alias("_left"), F.lit(None).cast(right.schema[value].dataType).alias("_value"), F.lit(0).alias("_side"))
    both = both.unionAll(right.select(by, at, F.lit(None).cast(left.schema[id].dataType), F.col(value), F.lit(1)))
    w = Window.partitionBy(by).orderBy(F.col(at), F.col("_side")).rowsBetween(0, Window.unboundedFollowing)
    return both.withColumn("match", F.first("_value", ignorenulls=True).over(w)).filter("_side = 0").select(F.col("_left").alias(id), "match")


def blank_on_gap(rows: DataFrame, partition: str, order: str, y: str, gap: float) -> DataFrame:
    """An empty line before a line that is more than `gap` below the one before."""
    wide = F.coalesce(gap_to_previous(y, [partition], [order]) > gap, F.lit(False))
    out = F.explode(F.when(F.col("_wide"), F.array(F.lit(""), F.col("line"))).otherwise(F.array("line")))
    return rows.withColumn("_wide", wide).withColumn("line", out).drop("_wide")


def balanced_split(rows: DataFrame, partition: str, order: str, weight: str, boundary: Column) -> DataFrame:
    """per part the boundary row after which to cut, so that the heavier side is as light as can be; the first of equals."""
    upto = Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum(weight).over(Window.partitionBy(partition))
    left = F.sum(weight).over(upto)
    scored = rows.withColumn("left", left).withColumn("right", whole - left).filter(boundary & (F.col("right") > 0))
    best = F.min_by(F.struct(F.col(order).alias("cut"), "left", "right"), F.struct(F.greatest("left", "right"), F.col(order)))
    return scored.groupBy(partition).agg(best.alias("b")).select(partition, "b.cut", "b.left", "b.right")


def quality_gate(body: Column, grammar: str, least: int = 3) -> Column:
    """At least `least` lines, one of which has only tokens of the grammar."""
    from corpusforge.functions.text import all_tokens

    return (F.size(body) >= least) & F.exists(body, lambda r: all_tokens(r, grammar))


def lead_lines(body: Column, most: int = 4, stop: str = r"^\s*$|\[") -> Column:
    """The leading lines, at most `most`, before one that matches `stop`."""
    at = F.array_position(F.transform(body, lambda r: r.rlike(stop)), True).cast("int")
    n = F.least(F.when(at > 0, at - 1).otherwise(F.size(body)), F.lit(most))
    return F.slice(body, F.lit(1), F.greatest(n, F.lit(0)))
