"""Best-fit-decreasing packing of token sequences into windows, for a whole corpus at once.

Overlong documents are first cut into full windows. What remains of a document is one piece
shorter than a window. Pieces of equal length are interchangeable, so best-fit decreasing runs
on the histogram of lengths, which has fewer than `window` entries however large the corpus:
lengths are taken in falling order, and a segment tree indexed by remaining capacity finds the
tightest open windows, whole runs of windows at a time. The plan is a short list of runs;
each piece finds its place in it by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import FastIds, read_vocabulary
from .common import Batches, checkpoint, lean, narrow, strings, tune

WINDOW = 1024
#: Ranks within a length are counted over this many parts, so that a length that half of the corpus has is not one task.
PARTS = 256


class CapacityTree:
    """Counts of open windows by remaining capacity; finds the smallest capacity that is large enough."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, least: int) -> int | None:
        at = self.leaves + least
        if self.count[at]:
            return least
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over {length: pieces}, lengths from 1 to below window.

    Returns runs (length, first rank, pieces, first window, pieces per window, offset) and the number of windows.
    """
    tree, runs, opened = CapacityTree(window), [], 0
    free: dict[int, list[tuple[int, int]]] = {}  # capacity -> runs of windows (first, number)

    def put(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            free.setdefault(capacity, []).append((first, n))
            tree.add(capacity, n)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity, first = window, opened
                n = -(-left // (window // length))
                opened += n
            else:
                first, n = free[capacity].pop()
                tree.add(capacity, -n)
            each = capacity // length
            full, rest = min(n, left // each), 0
            if full:
                runs.append((length, rank, full * each, first, each, window - capacity))
                put(capacity - full_size(each, length), first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:  # the last window of this length gets fewer pieces
                rest = 1
                runs.append((length, rank, left, first + full, left, window - capacity))
                put(capacity - full_size(left, length), first + full, 1)
                left = 0
            put(capacity, first + full + rest, n - full - rest)
    return runs, opened


def full_size(pieces: int, length: int) -> int:
    return pieces * length


def tokenized(documents: DataFrame, vocabulary_path: str, id: str, text: str, window: int, end: int) -> DataFrame:
    """Per document: its number of tokens with the end id, and the CRC of each piece when cut into full windows."""
    tune(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    df = narrow(documents, id=id, text=text)
    local: dict = {}

    def run(batches: Batches) -> Batches:
        if "ids" not in local:
            local["ids"] = FastIds(shared.value)
        tail = np.array([end], "<u4")
        for batch in batches:
            sizes, crcs = [], []
            for t in strings(batch, "text"):
                ids = np.concatenate([local["ids"].encode(t), tail])
                sizes.append(len(ids))
                crcs.append([zlib.crc32(ids[i : i + window]) for i in range(0, len(ids), window)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], names=["id", "doc_tokens", "crcs"])

    return df.mapInArrow(lean(run), f"id {df.schema['id'].dataType.simpleString()}, doc_tokens long, crcs array<long>")


def pack(documents: DataFrame, vocabulary_path: str, id: str = "doc_id", text: str = "text", window: int = WINDOW, end: int = 0) -> DataFrame:
    """Packs all documents (ids and then the end id) into sequences of at most `window` tokens.

    Returns id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece. A null or empty
    text is the end id alone. Repeated rows are packed each. An empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    docs = checkpoint(
        tokenized(documents, vocabulary_path, id, text, window, end)
        .withColumn("length", (F.col("doc_tokens") % window).cast("int"))
        .withColumn("full", F.expr(f"doc_tokens div {window}"))
        .withColumn("part", F.pmod(F.xxhash64("id", F.element_at("crcs", 1)), F.lit(PARTS)).cast("int"))
    )
    groups = checkpoint(docs.groupBy("length", "part").agg(F.count("*").alias("n"), F.sum("full").alias("full")))
    totals = {r.length: (r.n, r.full) for r in groups.groupBy("length").agg(F.sum("n").alias("n"), F.sum("full").alias("full")).collect()}  # at most `window` rows
    runs, opened = plan({k: n for k, (n, _) in totals.items() if k}, window)
    bases, at = {}, opened
    for k in sorted(totals):
        bases[k], at = at, at + totals[k][1]

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = reduce(lambda c, k: c.when(F.col("length") == k, bases[k]), sorted(bases), F.when(F.lit(False), 0)) if len(bases) < 8 else F.create_map(*[F.lit(x) for kv in bases.items() for x in kv])[F.col("length")]
    starts = groups.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), (base + F.coalesce(F.sum("full").over(before), F.lit(0))).alias("full0"))

    within = Window.partitionBy("length", "part").orderBy("id", "crcs")
    placed = (
        docs.withColumn("rank", F.row_number().over(within) - 1)
        .withColumn("fulls", F.sum("full").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("n0"))
        .withColumn("fulls", F.col("fulls") + F.col("full0"))
    )
    piece = lambda k, size, seq, offset: F.struct((k * window).cast("long").alias("start"), size.cast("long").alias("length"), F.get("crcs", k.cast("int")).alias("ids_crc32"), seq.cast("long").alias("sequence_id"), offset.cast("long").alias("offset"))
    cut = placed.filter("full > 0").select("id", "doc_tokens", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("full") - 1), lambda k: piece(k, F.lit(window), F.col("fulls") + k, F.lit(0)))).alias("p"))

    # The plan has at most a few runs per length, whatever the corpus's size: safe to broadcast.
    table = spark.createDataFrame(runs, "run_length int, rank0 long, pieces long, window0 long, each long, offset0 long")
    inside = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("rank0")) & (F.col("rank") < F.col("rank0") + F.col("pieces"))
    nth = F.col("rank") - F.col("rank0")
    ends = (
        placed.filter("length > 0")
        .join(F.broadcast(table), inside)
        .select("id", "doc_tokens", piece(F.col("full"), F.col("length"), F.col("window0") + F.floor(nth / F.col("each")), F.col("offset0") + nth % F.col("each") * F.col("length")).alias("p"))
    )
    return cut.unionAll(ends).select(F.col("id").alias(id), "p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset")
