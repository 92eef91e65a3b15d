"""Sorted, numbered and linked indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import cut_lineage


def number_globally(rows: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """1, 2, 3 ... over the whole table in order, which should be total. Ranges of the order are numbered in parallel and
    moved by the sizes of the ranges before them; no task sees the whole table."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over one row per range
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn(name, nth).join(F.broadcast(starts), "_range").withColumn(name, (F.col(name) + F.col("_start")).cast("long")).drop("_range", "_start")


def number_within(rows: DataFrame, group: list[str], order: list[str], name: str = "nth") -> DataFrame:
    """1, 2, 3 ... within each group (null is one) in order. Ranges of group and order are numbered in parallel; only a group that goes on over the border of
    a range, of which there is one a border, needs the numbers of its rows before: a group of a third of all rows is many tasks."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut_lineage(rows.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*group, "_range").agg(F.count("*").alias("_n")).withColumn("_start", F.sum("_n").over(before)).filter("_start > 0")
    starts = counts.select(*(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)), F.col("_range").alias("_r"), "_start")  # as many rows as borders
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    nth = F.row_number().over(Window.partitionBy("_range", *group).orderBy(*order))
    numbered = dealt.withColumn(name, nth).join(F.broadcast(starts), same, "left")
    return numbered.withColumn(name, (F.col(name) + F.coalesce("_start", F.lit(0))).cast("long")).select(*rows.columns, name)


def suffixed(rows: DataFrame, slug: str, order: str, name: str = "unique_slug") -> DataFrame:
    """The first of equal slugs stays, later ones get -1, -2, ..."""
    nth = F.col("_nth") - 1
    return number_within(rows, [slug], [order], "_nth").withColumn(name, F.when(nth == 0, F.col(slug)).otherwise(F.concat_ws("-", F.col(slug), nth.cast("string")))).drop("_nth")


def variant_titles(rows: DataFrame, group: list[str], title: str, order: str, name: str = "variant") -> DataFrame:
    """The first of a group stays bare, the second and third get roman numerals, later ones Arabic numbers."""
    nth = F.col("_nth")
    sign = F.when(nth == 2, "(II)").when(nth == 3, "(III)").when(nth > 3, F.concat(F.lit("("), nth.cast("string"), F.lit(")")))
    return number_within(rows, group, [order], "_nth").withColumn(name, F.concat_ws(" ", title, sign)).drop("_nth")


def beside_base(rows: DataFrame, base: str, order: str) -> list[Column]:
    """The sort order that puts a variant right after its base."""
    return [F.coalesce(F.col(base), F.col(order)), F.col(base).isNotNull(), F.col(order)]


def postings(rows: DataFrame, key: str, id: str, block: int = 1024) -> DataFrame:
    """An inverted index in blocks of id ranges, so that a frequent key is many rows and never one task's."""
    return rows.withColumn("block", F.floor(F.col(id) / block).cast("long")).groupBy(key, "block").agg(F.count("*").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(id)), lambda x: x.cast("string")), ",").alias("ids"))


def neighbours(rows: DataFrame, partition: str, order: str, value: str) -> DataFrame:
    """Adds previous and next."""
    w = Window.partitionBy(partition).orderBy(order)
    return rows.withColumn("previous", F.lag(value).over(w)).withColumn("next", F.lead(value).over(w))


def merged_index(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A full outer join that says where each key stands."""
    joined = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full")
    side = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return joined.withColumn("side", side).drop("_l", "_r")


def merge_links(index: DataFrame, links: DataFrame, key: str, order: str, mark: str = "@ ") -> DataFrame:
    """Rows of an index (key, name, items array) with links (key, name, title, href) behind their own items, marked; names that the
    index lacks are put in at the place of their key. What an earlier run put in goes first, so that running twice changes nothing."""
    own = F.filter("items", lambda x: ~F.startswith(x, F.lit(mark)))
    base = index.select(key, F.col("name").alias("_name"), own.alias("_own")).filter(F.size("_own") > 0)
    fresh = F.transform(F.sort_array(F.collect_list(F.struct(order, "title", "href"))), lambda x: F.concat(F.lit(f"{mark}["), x["title"], F.lit("]("), x["href"], F.lit(")")))
    added = links.groupBy(key).agg(F.min("name").alias("_new"), fresh.alias("_links"))
    none = F.array().cast("array<string>")
    return base.join(added, key, "full").select(key, F.coalesce("_name", "_new").alias("name"), F.concat(F.coalesce("_own", none), F.coalesce("_links", none)).alias("items"))


def totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Counts by all keys, by leading keys and in all; level counts the keys that are summed over."""
    return rows.rollup(*keys).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))


def gaps(rows: DataFrame, partition: str, order: str, expected: Column) -> DataFrame:
    """Adds gap, the step from the row before, and ok, whether it is the expected one."""
    gap = F.col(order) - F.lag(order).over(Window.partitionBy(partition).orderBy(order))
    return rows.withColumn("gap", gap).withColumn("ok", gap.isNull() | (gap == expected))
