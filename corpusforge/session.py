"""Session helpers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()

#: Tables of texts below this size on disk have fewer row groups than a cluster has cores; spreading them costs one bounded shuffle.
SPREAD_BYTES = 256 << 20


def ship_package(spark: SparkSession) -> None:
    """Hands this package to the Python workers, once per application: they need not find it on a path of their own."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="corpusforge-package-")
    atexit.register(shutil.rmtree, folder, True)
    with zipfile.ZipFile(path := f"{folder}/corpusforge.zip", "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(application)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder that the cluster names in spark.checkpoint.dir. A folder of this machine serves only where driver and executors are one
    process; on a cluster it would go with its machine, so there the setting is required."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusforge-checkpoint-"))


#: Curated tables up to this size, and this many rows where the planner has no estimate, are broadcast.
BROADCAST_BYTES, BROADCAST_ROWS = 8 << 20, 10_000


def estimated_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marks df for a broadcast if it is known to have at most `limit` bytes: by the planner's estimate or, where it has none (rows handed over
    by Python), by measuring up to BROADCAST_ROWS of them. Any other table is left to the planner's own joins."""
    size = estimated_bytes(df)
    if size >= 1 << 50:
        rows, written = df.limit(BROADCAST_ROWS + 1).agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
        size = (written or 0) if rows <= BROADCAST_ROWS else size
    return F.broadcast(df) if size <= limit else df


def spread(df: DataFrame, limit: int = SPREAD_BYTES) -> DataFrame:
    """Deals the rows of a small table of fewer files than cores over all cores. A file of one row group is one task however it is
    split, and work on texts is bound by the CPU. Tables of `limit` bytes or more have enough row groups and are left as they are."""
    if estimated_bytes(df) >= limit:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


#: Bytes on disk of a part whose rows become many different keys before they are added up.
PART_BYTES = 4 << 20


def dealt(df: DataFrame, key: str, size: int = PART_BYTES) -> DataFrame:
    """Deals the rows of a table by a key into parts of about `size` bytes by the planner's estimate, and at least one a core: what a task counts before it
    hands on is then bounded, however large the files and their row groups are."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-estimated_bytes(df) // size)), key)
