"""Incremental, idempotent passes (K14, R2, T15): each micro-batch computes only rows whose content the store doesn't have."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def incremental(stream: DataFrame, key: str, compute: Callable[[DataFrame], DataFrame], store: str, checkpoint: str) -> StreamingQuery:
    """Appends compute(new rows) to the Parquet store. compute keeps `key` (a content hash); a key is computed once, also when a batch
    is replayed after a failure or repeats rows."""
    def step(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(store)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            fresh = fresh.join(spark.read.parquet(store).select(key), key, "left_anti")
        compute(fresh).write.mode("append").parquet(store)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def prune(spark: SparkSession, store: str, current: DataFrame, key: str, to: str) -> DataFrame:
    """The store's results for keys that current rows still have, written to `to` (a store is never overwritten while it is read)."""
    kept = spark.read.parquet(store).join(current.select(key).distinct(), key, "left_semi")
    kept.write.mode("overwrite").parquet(to)
    return spark.read.parquet(to)


def gap_sessions(stream: DataFrame, by: str, at: str, gap: str, late: str) -> DataFrame:
    """Gap clustering on a clock: runs of a key's rows with less than `gap` between neighbours; rows later than `late` are not waited for."""
    return stream.withWatermark(at, late).groupBy(by, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(by, "w.start", "w.end", "n")
