"""Token files: frequency-ranked ids in byte-aligned variable-length coding, control bytes apart from data bytes.

Ids are replaced by their rank in the corpus, most frequent first, so that most take one byte. Four
ids share a control byte, two bits each for the number of their data bytes; both streams are made
and read by numpy, lengths by a table of the 256 control bytes. Documents stand in ascending order of
id, in ranges that are written side by side; a range is a run of blocks. Blocks are rows of Parquet
files, which any store that Spark reaches can hold and whose commit survives lost executors.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusforge.session import ensure_checkpoint_dir

from .bpe import FastIds, read_vocabulary
from .common import Batches, checkpoint, lean, narrow, strings, tune

#: A block is closed once it holds this many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 16
#: Documents that are moved before they are ranked are held compressed.
CODEC = "zstd"

#: Data bytes of each of the four ids of a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.arange(0, 8, 2) & 3).astype(np.uint8) + 1


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.arange(0, 8, 2, dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    letters, at = np.frombuffer(data, np.uint8), np.cumsum(size, dtype=np.int64) - size
    if n and at[-1] + size[-1] != len(letters):
        raise ValueError("a block's control bytes don't fit its data bytes")
    ranks = letters[at].astype("<u4")
    for k in (1, 2, 3):
        longer = np.nonzero(size > k)[0]
        ranks[longer] |= letters[at[longer] + k].astype("<u4") << np.uint32(8 * k)
    return ranks


def held(ids: np.ndarray, codec: pa.Codec) -> bytes:
    """Compressed ids of two bytes where all fit, else of four; the first byte says which."""
    width = 2 if ids.max(initial=0) <= 0xFFFF else 4
    return bytes([width]) + codec.compress(ids.astype(f"<u{width}").tobytes(), asbytes=True)


def unheld(raw: bytes, n: int, codec: pa.Codec) -> np.ndarray:
    return np.frombuffer(codec.decompress(raw[1:], raw[0] * n, asbytes=True), f"<u{raw[0]}").astype("<u4")


def encoded(documents: DataFrame, vocabulary_path: str, id: str, text: str, end: int) -> DataFrame:
    """Per document: id, n_tokens, raw (its ids and the end id, compressed); and for each task a row without raw that counts its ids."""
    tune(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    df = narrow(documents, id=id, text=text)
    key, local = to_arrow_type(df.schema["id"].dataType), {}
    schema = pa.schema([("id", key), ("n_tokens", pa.int64()), ("raw", pa.binary()), ("tokens", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def run(batches: Batches) -> Batches:
        if "ids" not in local:
            local["ids"] = FastIds(shared.value)
        codec, tail, seen = pa.Codec(CODEC), np.array([end], "<u4"), np.zeros(0, np.int64)
        for batch in batches:
            sizes, raws = [], []
            for t in strings(batch, "text"):
                ids = np.concatenate([local["ids"].encode(t), tail])
                n = np.bincount(ids, minlength=len(seen))
                n[: len(seen)] += seen
                seen = n
                sizes.append(len(ids))
                raws.append(held(ids, codec))
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(raws, pa.binary()), none.cast(schema.field(3).type), none.cast(schema.field(4).type)], schema=schema)
        there = np.nonzero(seen)[0]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, key), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([there], schema.field(3).type), pa.array([seen[there]], schema.field(4).type)], schema=schema)

    return df.mapInArrow(lean(run), f"id {df.schema['id'].dataType.simpleString()}, n_tokens long, raw binary, tokens array<int>, counts array<long>")


def write_tokens(documents: DataFrame, vocabulary_path: str, folder: str, id: str = "doc_id", text: str = "text", end: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all documents, each with the end id behind it, in ascending order of id (rows without one first) below `folder`.

    ranks: rank, token. blocks: range, block, first (ids before it in its range), ids and sizes of its documents, control, data.
    Null and empty texts are the end id alone; very long texts are blocks of their own; repeated rows are written each, rows of one id by the check sum of their
    ids. An empty table gives files without rows. Further columns are ignored.
    """
    spark = documents.sparkSession
    raw = checkpoint(encoded(documents, vocabulary_path, id, text, end))
    found = raw.filter("raw IS NULL").select(F.explode(F.arrays_zip("tokens", "counts")).alias("x")).groupBy(F.col("x.tokens").alias("token")).agg(F.sum("x.counts").alias("n"))
    ranked = found.select((F.row_number().over(Window.orderBy(F.desc("n"), "token")) - 1).alias("rank"), "token")  # at most as many rows as the vocabulary has
    ranked.coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = spark.sparkContext.broadcast(_table(spark.read.parquet(f"{folder}/ranks"), "token", "rank"))

    docs = raw.filter("raw IS NOT NULL").select("id", "n_tokens", "raw")
    key = to_arrow_type(docs.schema["id"].dataType)
    # Rows of one id, or copies of one row, are dealt at random: no range holds more than its share.
    order = [F.col("id").asc_nulls_first(), "sum", "n_tokens", "salt"]
    dealt = docs.withColumn("sum", F.crc32("raw")).withColumn("salt", F.rand(42)).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "n_tokens", "raw")
    schema = pa.schema([("range", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(key)), ("sizes", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary())])

    def blocks(batches: Batches) -> Batches:
        codec, place, k, first = pa.Codec(CODEC), TaskContext.get().partitionId(), 0, 0
        ids, sizes, parts, full = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal k, first, full
            n = full
            control, data = pack_ranks(rank_of.value[np.concatenate(parts)])
            out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((place, k, first, n, list(ids), list(sizes), control, data), schema.types)], schema=schema)
            k, first, full = k + 1, first + n, 0
            for x in (ids, sizes, parts):
                x.clear()
            return out

        for batch in batches:
            for i, n, packed in zip(*(batch.column(c).to_pylist() for c in range(3))):
                ids.append(i)
                sizes.append(n)
                parts.append(unheld(packed, n, codec))
                full += n
                if full >= block_ids:
                    yield close()
        if ids:
            yield close()

    kind = docs.schema["id"].dataType.simpleString()
    dealt.mapInArrow(lean(blocks), f"range long, block long, first long, n_ids long, ids array<{kind}>, sizes array<long>, control binary, data binary").write.parquet(f"{folder}/blocks")


def _table(pairs: DataFrame, key: str, value: str) -> np.ndarray:
    """value by key, both below the size of the vocabulary."""
    rows = pairs.select(key, value).collect()
    out = np.zeros(1 + max((r[0] for r in rows), default=0), "<u4")
    for k, v in rows:
        out[k] = v
    return out


def read_tokens(spark: SparkSession, folder: str, id: str = "doc_id", digest: bool = False) -> DataFrame:
    """Reads token files back. Per document: id, start (ids of all documents before it), n_tokens, and ids array<int>, or with digest
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers)."""
    tune(spark)
    token_of = spark.sparkContext.broadcast(_table(spark.read.parquet(f"{folder}/ranks"), "rank", "token"))
    blocks = spark.read.parquet(f"{folder}/blocks")
    starts, before = [], 0
    for r in sorted(blocks.groupBy("range").agg(F.sum("n_ids").alias("n")).collect()):  # one row a range
        starts.append((r["range"], before))
        before += r.n
    table = spark.createDataFrame(starts, "range long, start long")  # as many rows as ranges
    placed = blocks.join(F.broadcast(table), "range").select((F.col("start") + F.col("first")).alias("start"), "n_ids", "ids", "sizes", "control", "data")
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(batch.num_rows):
                start, n, ids, sizes, control, data = (batch.column(c)[at] for c in range(6))
                tokens = token_of.value[unpack_ranks(control.as_py(), data.as_py(), n.as_py())]
                counts = np.array(sizes.as_py(), np.int64)
                ends = np.cumsum(counts)
                cut = list(zip((ends - counts).tolist(), ends.tolist()))
                if digest:
                    last = pa.array([zlib.crc32(tokens[a:b]) for a, b in cut], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), pa.array(tokens.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([ids.values, pa.array(start.as_py() + ends - counts, pa.int64()), pa.array(counts), last], names=["id", "start", "n_tokens", "last"])

    last = "long" if digest else "array<int>"
    return placed.mapInArrow(lean(run), f"id {kind}, start long, n_tokens long, last {last}").select(F.col("id").alias(id), "start", "n_tokens", F.col("last").alias("ids_crc32" if digest else "ids"))


def shared_folder(spark: SparkSession) -> str:
    """A new folder where driver and executors both reach it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/token-files-{uuid.uuid4().hex}"
