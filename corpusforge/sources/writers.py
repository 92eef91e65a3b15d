"""Sinks (K1-K3, K9, K11): snapshots, books and catalogues as ordered text, script data, records by part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, in folders by a column if wanted."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def item_markdown(df: DataFrame, level: int = 4) -> DataFrame:
    """K2: adds markdown: title, metadata and the body between fences of its kinds. body: array<struct<kind, line>>."""
    head = F.concat(F.lit("#" * level + " "), "title")
    opened = F.aggregate(
        "body",
        F.struct(F.lit("").alias("text"), F.lit("note").alias("kind")),
        lambda acc, x: F.struct(
            F.concat(
                acc["text"],
                F.when((acc["kind"] != x["kind"]) & (acc["kind"] != "note"), "```\n").otherwise(""),
                F.when((acc["kind"] != x["kind"]) & (x["kind"] != "note"), F.concat(F.lit("```"), x["kind"], F.lit("\n"))).otherwise(""),
                x["line"], F.lit("\n"),
            ).alias("text"),
            x["kind"].alias("kind"),
        ),
    )
    return df.withColumn("_b", opened).withColumn("markdown", F.concat(head, F.lit("\n"), F.col("_b.text"), F.when(F.col("_b.kind") != "note", "```\n").otherwise(""))).drop("_b")


def script_data(spark, path: str, name: str, data: dict) -> None:
    """A script file that assigns curated tables, as JSON, to a name."""
    import json

    spark.createDataFrame([(f"const {name} = {json.dumps(data, ensure_ascii=False, indent=1)};",)], "value string").coalesce(1).write.mode("overwrite").text(path)


def book(df: DataFrame, order: list[str], path: str, column: str = "markdown") -> None:
    """K2, K4, K5: the column's texts in order. Files are ranges of the order, so their names' order is the book's."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).select(column).write.mode("overwrite").text(path)


def catalogue(df: DataFrame, group: str, title: str, href: str) -> DataFrame:
    """K3: one row a group: a counted header and its links in order of their titles."""
    links = F.transform(F.sort_array(F.collect_list(F.struct(title, href))), lambda x: F.concat(F.lit("- ["), x[title], F.lit("]("), x[href], F.lit(")")))
    return df.groupBy(group).agg(F.count("*").alias("n"), F.array_join(links, "\n").alias("links")).select(group, F.concat(F.lit("## "), group, F.lit(" ("), F.col("n").cast("string"), F.lit(")\n"), "links").alias("markdown"))


def insert_lines(rows: DataFrame, fresh: DataFrame, partition: str, order: str, old: str) -> DataFrame:
    """K9: rows without lines that match `old`, with fresh ones (after: the order they follow) put in, renumbered; doing it twice
    changes nothing more as long as `after` counts lines that stay."""
    base = rows.filter(~F.col("line").rlike(old)).select(partition, F.col(order).cast("double").alias("_o"), "line")
    added = fresh.select(partition, (F.col("after") + 0.5).alias("_o"), "line")
    from pyspark.sql import Window

    return base.unionAll(added).select(partition, (F.row_number().over(Window.partitionBy(partition).orderBy("_o")) - 1).alias(order), "line")
