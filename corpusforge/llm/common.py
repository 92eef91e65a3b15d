"""What the training-data operators share: session settings, safe columns, Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.session import ensure_checkpoint_dir, ship_package, spread

#: Rows and bytes of one Arrow batch handed to Python; long texts make byte limits necessary.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20

#: A table of fewer bytes on disk than this is a row group or two, hence a task or two; its rows are dealt over all cores.
ONE_GROUP_BYTES = 32 << 20


def tune(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers receive, and hands them this package."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), ONE_GROUP_BYTES)


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that further or clashing columns can't interfere."""
    return df.select(*(F.col(f"`{source}`").alias(own) for own, source in columns.items()))


def checkpoint(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and cuts its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def strings(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def record(columns: dict, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], type=t) for k, t in types.items()], names=list(types))


Batches = Iterator[pa.RecordBatch]


def lean(run):
    """run, after which the worker hands freed memory back: workers live on, and an executor holds one for each task and Python step."""
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # not every C library can
            pass

    return wrapped
