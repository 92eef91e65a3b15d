"""Connected components and fixpoints as loops over DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.session import ensure_checkpoint_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoints into the shared folder that the cluster names."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fixpoint(df: DataFrame, step: Callable[[DataFrame], DataFrame], signature: Callable[[DataFrame], object], max_iter: int = 60) -> DataFrame:
    """Applies step until signature(df) stays the same; raises if it doesn't within max_iter steps."""
    before = signature(df := cut_lineage(df))
    for _ in range(max_iter):
        after = signature(df := cut_lineage(step(df)))
        if after == before:
            return df
        before = after
    raise RuntimeError(f"no fixpoint within {max_iter} steps")


def shrink_to_fit(items: DataFrame, measure: Callable[[DataFrame], DataFrame], size: str = "size", factor: float = 0.93, passes: int = 6) -> DataFrame:
    """measure(items) adds bad; whoever is bad shrinks by the factor and is measured again, nobody else, in at most `passes` measurements.

    Adds passes (measurements taken) and bad, which is left true for those that still fail after the last one. Each pass works on the offenders of the one before."""
    settled, active = [], items.withColumn("passes", F.lit(1))
    for k in range(1, passes + 1):
        measured = cut_lineage(measure(active))
        if k == passes or measured.filter("bad").isEmpty():
            settled.append(measured)
            break
        settled.append(measured.filter("not bad"))
        active = measured.filter("bad").drop("bad").withColumn(size, F.col(size) * factor).withColumn("passes", F.lit(k + 1))
    return reduce(DataFrame.unionByName, settled)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest neighbour (or itself) to its larger neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smallest smaller neighbour to its other smaller neighbours and to itself."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    handed = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return handed.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row.n, row.s


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of an edge, component being the smallest node that it reaches.

    Alternating star contractions: logarithmically many rounds, each with bounded memory and
    partial aggregation, so neither long chains nor one huge component overload a task. Edges with a null end
    and loops are ignored; isolated nodes do not appear.
    """
    pair = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).filter("s <> d")
    start = pair.select(F.greatest("s", "d").alias("a"), F.least("s", "d").alias("b")).distinct()
    stars = fixpoint(start, lambda e: _small_star(_large_star(e)), _signature)
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
