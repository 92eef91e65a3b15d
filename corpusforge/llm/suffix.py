"""Exact removal of repeated byte strings by suffix sorting, one bucket at a time.

Whichever string of `length` bytes occurs twice has the same minimizer (the smallest hash of a
shorter string inside it) at the same place in both, so strings are dealt to suffix buckets by
their minimizers, and strings of different buckets never need to be compared. A run of starts
that share a minimizer occurrence is an anchor; its context is the bytes its strings cover.

1. Counts by bucket, summed in the tasks first, drop all buckets with one occurrence.
2. Contexts of equal bytes (by two 64-bit hashes) are a class, whose first and last member stand for it.
3. Buckets are sorted one at a time: a difference-cover sample of the suffixes of their contexts is ranked once, then the
   suffixes of one bucket of leading bytes after the other are merged by the ranks of the cover sample. Neighbours in that
   order are compared on all their `length` bytes. A class whose two members prove equal is a repeat with all its members.
4. A bucket of too many classes for one task is dealt again by minimizers of longer strings, at last by whole strings.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, checkpoint, lean, narrow, strings, tune

LENGTH = 200
#: Lengths of the strings whose smallest hash names a bucket; the last resort is the whole string.
GRAMS = (32, 64, 128)
#: Window starts handled at once in a long document.
SEGMENT = 1 << 18
#: Bytes of contexts sorted at once, and suffixes in a bucket of leading bytes.
SORT_BYTES, BUCKET = 1 << 19, 1 << 16
#: Classes of one bucket that one task sorts; a larger bucket is dealt again by longer strings.
GROUP = 2_000
#: A perfect difference cover: any two residues modulo 13 meet it at a common distance.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Bits of the rest of a head of PERIOD bytes after its first eight.
REST = 8 * (PERIOD - 8)


# -- suffix sorting ----------------------------------------------------------------------------------------------------
@lru_cache(1)
def distances() -> np.ndarray:
    """By two residues the smallest distance at which both stand on the cover; flat."""
    meets = lambda r, s: next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER and (s + d) % PERIOD in COVER)
    return np.array([meets(r, s) for r in range(PERIOD) for s in range(PERIOD)])


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    sorted_ = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
    return out


def _rest(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at + 8] >> np.uint64(64 - REST)).astype(np.int64)


def cover_ranks(words: np.ndarray, n: int, depth: int) -> np.ndarray:
    """Ranks, from 1, of the cover sample's suffixes by at least `depth` bytes; 0 elsewhere and beyond the end. words: the eight bytes
    from each of the n positions (and from some beyond them), as big-endian numbers."""
    at = np.nonzero(np.isin(np.arange(n) % PERIOD, COVER))[0]
    rank = np.zeros(n + 2 * depth + 2 * PERIOD, np.int32)
    rank[at] = _dense(_dense(words[at]) << REST | _rest(words, at)) + 1
    step = PERIOD
    while step < depth:
        rank[at] = _dense(rank[at].astype(np.int64) * (len(at) + 2) + rank[at + step]) + 1
        step *= 2
    return rank


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of the starts begin a string of `length` bytes that another start begins as well."""
    n, out = len(text), np.zeros(len(starts), bool)
    padded = np.concatenate([text, np.zeros(PERIOD + 16, np.uint8)]).astype(np.uint64)
    words = padded[:-7].copy()
    for k in range(1, 8):
        words <<= np.uint64(8)
        words |= padded[k : len(padded) - 7 + k]
    name = _dense(words[starts])
    order = np.nonzero(np.bincount(name)[name] > 1)[0]  # heads that no other start has need no sorting
    name = _dense(name[order] << REST | _rest(words, starts[order]))
    shared = np.bincount(name)[name] > 1 if len(name) else name > 0
    order, name = order[shared], name[shared]
    if not len(order):
        return out
    by = np.argsort(name, kind="stable")
    order, name = order[by], name[by]
    rank = cover_ranks(words, n, length)
    columns = np.minimum(np.arange(0, length, 8), length - 8)
    low = 0
    while low < len(order):
        high = min(low + BUCKET, len(order))
        high = int(np.searchsorted(name, name[high - 1], "right"))  # buckets hold whole groups of leading bytes
        ids = order[low:high]
        ids = ids[merged_order(starts[ids], name[low:high], rank)]
        at = starts[ids]
        for i in range(0, len(at) - 1, 8192):
            a, b = at[i : i + 8192], at[i + 1 : i + 8193]
            a = a[: len(b)]
            near = np.nonzero(words[a] == words[b])[0]
            for c in columns:
                near = near[words[a[near] + c] == words[b[near] + c]]
            out[ids[i + near]] = True
            out[ids[i + near + 1]] = True
        low = high
    return out


def merged_order(at: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The order of the suffixes of each group (neighbours in `at`): merge sort of all groups at once. Two suffixes are compared by the
    ranks at the distance where both stand on the cover; those of a left run find their places in the right one by halving.

    Suffixes that agree as deep as the ranks go stand together, in any order: how deep a comparison sees depends on the pair,
    so places are kept rising."""
    far, residue = distances(), at % PERIOD
    begin = np.concatenate([[0], np.nonzero(group[1:] != group[:-1])[0] + 1])
    size = np.diff(np.concatenate([begin, [len(at)]]))
    order, width = np.arange(len(at)), 1
    while (wide := size > width).any():
        begin, size = begin[wide], size[wide]  # sorted groups are left alone
        slot = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
        first = np.repeat(begin, size)
        left = (slot - first) // width % 2 == 0
        mine, last = slot[left], (first + np.repeat(size, size))[left]
        base = np.minimum(first[left] + ((mine - first[left]) // width + 1) * width, last)
        lo, hi = base.copy(), np.minimum(base + width, last)
        x = at[order[mine]]
        rx = residue[order[mine]] * PERIOD
        for _ in range(width.bit_length()):
            open_ = np.nonzero(lo < hi)[0]
            if not len(open_):
                break
            middle = (lo[open_] + hi[open_]) // 2
            theirs = order[middle]
            d = far[rx[open_] + residue[theirs]]
            before = rank[at[theirs] + d] < rank[x[open_] + d]
            lo[open_] = np.where(before, middle + 1, lo[open_])
            hi[open_] = np.where(before, hi[open_], middle)
        place = mine + np.maximum.accumulate(lo) - base
        free = np.zeros(len(at), bool)
        free[slot] = True
        free[place] = False
        moved = order.copy()
        moved[place] = order[mine]
        moved[free] = order[slot[~left]]
        order, width = moved, 2 * width
    return order


# -- anchors -----------------------------------------------------------------------------------------------------------
def gram_hashes(b: np.ndarray, gram: int = GRAMS[0]) -> np.ndarray:
    """A hash of the `gram` bytes (eight at least) from each position: hashes of twice as many bytes at a time, the last two overlapping."""
    x, width = b.astype(np.uint64), 8
    for shift in (1, 2, 4):
        x = x[:-shift] | x[shift:] << np.uint64(8 * shift)
    while width < gram:
        shift = min(width, gram - width)
        y = x * np.uint64(0x9E3779B97F4A7C15 + 2 * width)
        y ^= y >> np.uint64(29)
        x = (y[:-shift] * np.uint64(0x165667B19E3779F9)) ^ (y[shift:] + (y[shift:] >> np.uint64(32)))
        width += shift
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` values the position of its smallest, the first among equals (by their upper bits)."""
    n = len(h)
    bits = max(n.bit_length(), 1)
    mask = np.uint64((1 << bits) - 1)
    key = (h & ~mask) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = key
    full = full.reshape(blocks, width)
    left = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(full, axis=1).ravel()
    count = n - width + 1
    return (np.minimum(left[:count], right[width - 1 : width - 1 + count]) & mask).astype(np.int64)


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAMS[0]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(base, buckets, first starts, last starts) of all strings of `length` bytes in data, segment by segment; starts count from base."""
    whole, gram = np.frombuffer(data, np.uint8), min(gram, length)
    for base in range(0, len(data) - length + 1, SEGMENT):
        h = gram_hashes(whole[base : base + SEGMENT + length - 1], gram)
        best = sliding_argmin(h, length - gram + 1)
        cut = np.concatenate([[0], np.nonzero(best[1:] != best[:-1])[0] + 1, [len(best)]])
        yield base, h[best[cut[:-1]]].astype(np.int64), cut[:-1], cut[1:] - 1


def row_key(id, data: bytes) -> int:
    """The row's identity besides a 32-bit check sum of its text: its id, or a hash of its text if it has none."""
    if id is None:
        return xxhash.xxh3_64_intdigest(data, 1) - (1 << 63)
    return int(id)


Rows = Iterator[tuple[int, int, int, bytes]]


def texts_of(batch: pa.RecordBatch, least: int) -> Rows:
    """(key, sum, base, data) of documents (id, text) of at least `least` bytes."""
    for id, text in zip(strings(batch, "id"), strings(batch, "text")):
        data = (text or "").encode("utf-8", "replace")
        if len(data) >= least:
            yield row_key(id, data), zlib.crc32(data) - (1 << 31), 0, data


def pieces_of(batch: pa.RecordBatch, least: int) -> Rows:
    """The same of pieces, whose data is compressed."""
    unpack = zstandard.ZstdDecompressor().decompress
    for key, check, base, data in zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in PIECE)):
        yield key, check, base, unpack(data)


def _keyed(documents: DataFrame, least: int) -> DataFrame:
    """Whole texts as pieces (key, sum, base, data)."""
    def run(batches: Batches) -> Batches:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield _record([(*r[:3], pack(r[3])) for r in texts_of(batch, least)], PIECE)

    return documents.mapInArrow(lean(run), _ddl(PIECE))


PIECE = {"key": pa.int64(), "sum": pa.int32(), "base": pa.int32(), "data": pa.binary()}
ANCHOR = {"bucket": pa.int64(), "context": pa.int64(), "key": pa.int64(), "sum": pa.int32(), "base": pa.int32(), "first": pa.int32(), "last": pa.int32()}
CONTEXT = {"deal": pa.int64(), "large": pa.bool_(), "twice": pa.bool_(), **ANCHOR, "bytes": pa.binary()}
VERDICT = {"bucket": pa.int64(), "context": pa.int64(), "key": pa.int64(), "sum": pa.int32(), "start": pa.int32(), "end": pa.int32()}
_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary", pa.bool_(): "boolean"}


def _ddl(types: dict) -> str:
    return ", ".join(f"`{n}` {_NAMES[t]}" for n, t in types.items())


def _record(rows: list[tuple], types: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(types), types.values())], names=list(types))


def _counts(source: DataFrame, read: Callable, length: int, gram: int) -> DataFrame:
    """(bucket) of those with two occurrences or more. Occurrences are summed batch by batch, then in the task."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [buckets for *_, data in read(batch, length) for _, buckets, _, _ in anchors(data, length, gram)]
            buckets, n = np.unique(np.concatenate(found) if found else np.empty(0, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(n)], names=["bucket", "n"])

    return source.mapInArrow(lean(run), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter("n > 1").select("bucket")


def _anchor_rows(source: DataFrame, read: Callable, length: int, gram: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            parts = []
            for key, check, base, data in read(batch, length):
                for at, buckets, first, last in anchors(data, length, gram):
                    digest = xxhash.xxh3_64_intdigest
                    names = np.fromiter((digest(data[x:y], y - x) for x, y in zip((at + first).tolist(), (at + last + length).tolist())), np.uint64, len(first)).astype(np.int64)
                    start = base + at
                    same = [np.full(len(first), v, t) for v, t in ((key, np.int64), (check, np.int32), (base, np.int32))]
                    parts.append([buckets, names, *same, (start + first).astype(np.int32), (start + last).astype(np.int32)])
            columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[]] * len(ANCHOR)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, ANCHOR.values())], names=list(ANCHOR))

    return source.mapInArrow(lean(run), _ddl(ANCHOR))


# -- the operator ------------------------------------------------------------------------------------------------------
def _contexts(pieces: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted anchors with the bytes of their contexts."""
    fields = [n for n in CONTEXT if n != "bytes"]

    def cut(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                data = unpack(r["data"])
                for a in r["anchors"]:
                    rows.append((*(a[n] if n in a else r[n] for n in fields), data[a["first"] - r["base"] : a["last"] - r["base"] + length]))
            yield _record(rows, CONTEXT)

    here = ["key", "sum", "base"]
    per_row = wanted.groupBy(*here).agg(F.collect_list(F.struct(*(n for n in fields if n not in here))).alias("anchors"))
    return pieces.join(per_row, here).mapInArrow(lean(cut), _ddl(CONTEXT))


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    yield from zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())


def _verdicts(contexts: DataFrame, length: int) -> DataFrame:
    """Sorts bucket by bucket (deal); several small ones are sorted together. A class with further members (twice) that is
    repeated as a whole gives its name, any other context the spans (key, sum, start, end) of its repeats."""
    def run(batches: Batches) -> Batches:
        def solve(rows: list[tuple]) -> pa.RecordBatch:
            text = np.frombuffer(b"".join(r[-1] for r in rows), np.uint8)
            sizes = np.array([len(r[-1]) for r in rows])
            begin, number = np.cumsum(sizes) - sizes, sizes - length + 1
            first = np.cumsum(number) - number
            starts = np.arange(number.sum()) - np.repeat(first, number) + np.repeat(begin, number)
            flags = repeated_starts(text, starts, length)
            hits = np.add.reduceat(flags, first, dtype=np.int64)
            out = []
            for k in np.nonzero(hits)[0].tolist():
                _, twice, bucket, context, key, check, at, _ = rows[k]
                if twice and hits[k] == number[k]:
                    out.append((bucket, context, None, None, None, None))
                else:
                    out += [(None, None, key, check, at + a, at + z + length) for a, z in _runs(flags[first[k] : first[k] + number[k]])]
            return _record(out, VERDICT)

        done: list[tuple] = []  # whole buckets
        group: list[tuple] = []
        size = 0
        for batch in batches:
            for r in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if group and group[0][0] != r[0]:
                    if len(group) > 1:
                        done += group
                        size += sum(len(x[-1]) for x in group)
                        if size >= SORT_BYTES:
                            yield solve(done)
                            done, size = [], 0
                    group = []
                group.append(r)
        if len(group) > 1:
            done += group
        if done:
            yield solve(done)

    dealt = contexts.select("deal", "twice", "bucket", "context", "key", "sum", "first", "bytes").repartition("deal").sortWithinPartitions("deal")
    return dealt.mapInArrow(lean(run), _ddl(VERDICT)).distinct()


def _level(source: DataFrame, read: Callable, pieces: DataFrame, length: int, group: int, gram: int) -> tuple[DataFrame, DataFrame | None]:
    """Spans of the repeats that one dealing settles, and what is left of buckets too large for a task as pieces of their own."""
    last = gram >= length  # a bucket is one string then
    rows = _anchor_rows(source, read, length, gram)
    found = checkpoint(rows.join(checkpoint(_counts(source, read, length, gram)), "bucket"))
    member = F.struct("key", "sum", "base", "first", "last")
    classes = checkpoint(found.groupBy("bucket", "context").agg(F.count("*").alias("n"), F.min(member).alias("a"), F.max(member).alias("z")))
    sizes = classes.groupBy("bucket").agg(F.count("*").alias("m")).filter(F.lit(False) if last else F.col("m") > group).select("bucket", F.lit(True).alias("large"))
    marked = classes.join(sizes, "bucket", "left").withColumn("large", F.coalesce("large", F.lit(False))).withColumn("twice", F.col("n") > 1)
    # In a large bucket the members of a class meet; its classes meet at the next dealing.
    deal = F.when(F.col("large"), F.xxhash64("bucket", "context")).otherwise(F.col("bucket"))
    two = marked.withColumn("deal", deal).select("*", F.explode(F.when(F.col("twice"), F.array("a", "z")).otherwise(F.array("a"))).alias("m"))
    wanted = two.select("deal", "large", "twice", "bucket", "context", *(F.col(f"m.{c}").alias(c) for c in ("key", "sum", "base", "first", "last"))).distinct()
    bytes_ = checkpoint(_contexts(pieces, wanted, length))
    verdicts = checkpoint(_verdicts(bytes_.filter("twice or not large"), length))
    whole = found.join(verdicts.filter("key is null").select("bucket", "context"), ["bucket", "context"])
    spans = verdicts.filter("key is not null").select("key", "sum", "start", "end").unionAll(whole.select("key", "sum", F.col("first").alias("start"), (F.col("last") + length).alias("end")))
    if last or sizes.isEmpty():
        return spans, None
    one = bytes_.filter("large").groupBy("bucket", "context").agg(F.min(F.struct("key", "sum", F.col("first").alias("base"), "bytes")).alias("r")).select("r.*")
    return spans, checkpoint(one.select("key", "sum", "base", "bytes").distinct().mapInArrow(lean(_packed), _ddl(PIECE)))


def _packed(batches: Batches) -> Batches:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([pack(b.as_py()) for b in batch.column(3)], pa.binary())], names=list(PIECE))


def repeats(documents: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """Spans (key, sum, start, end) of the rows (id, text) that strings of `length` bytes cover which also start elsewhere."""
    if length < PERIOD:
        raise ValueError(f"strings of at least {PERIOD} bytes are sorted")
    source, read, pieces, out = documents, texts_of, _keyed(documents, length), None
    for gram in [*(g for g in GRAMS if g < length), length]:
        spans, rest = _level(source, read, pieces, length, group, gram)
        out = spans if out is None else out.unionAll(spans)
        if rest is None:
            break
        source = pieces = rest
        read = pieces_of
    return out


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def remove_repeats(documents: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP, digest: bool = False, carry: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Removes from every text each byte that lies in a string of `length` bytes which also starts elsewhere in the table.

    Returns id, the columns to carry, n_bytes, n_removed, n_spans (maximal removed runs) and either kept_sha256 (digest) or
    kept, the remaining text; where a cut falls inside a character, its remaining bytes go from kept too. ids are integers.
    Strings are judged on the input, so all copies go. Null and empty texts, and texts shorter than `length`, lose
    nothing. Repeated rows count as copies. An empty table gives an empty result; other columns are ignored.
    """
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text, **{f"carry{k}": c for k, c in enumerate(carry)})
    spans = repeats(df.select("id", "text"), length, group)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    kept, n = [f"carry{k}" for k in range(len(carry))], 1 + len(carry)

    def tag(batches: Batches) -> Batches:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            data = [(t or "").encode("utf-8", "replace") for t in strings(batch, "text")]
            keys = [row_key(i, d) for i, d in zip(strings(batch, "id"), data)]
            own = [pa.array(keys, pa.int64()), pa.array([zlib.crc32(d) - (1 << 31) for d in data], pa.int32()), pa.array(map(pack, data), pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), *own], names=["id", *kept, "key", "sum", "data"])

    def cut(batches: Batches) -> Batches:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for packed, found in zip(strings(batch, "data"), strings(batch, "spans")):
                data = unpack(packed)
                runs, parts, at = merge_spans([(s["start"], s["end"]) for s in found or ()]), [], 0
                for start, end in runs:
                    parts.append(data[at:start])
                    at = end
                rest = b"".join([*parts, data[at:]])
                rows.append((len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest() if digest else rest.decode("utf-8", "ignore")))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(n)), *(pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, types))], names=[id, *carry, "n_bytes", "n_removed", "n_spans", last])

    last = "kept_sha256" if digest else "kept"
    per_row = spans.groupBy("key", "sum").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    texts = df.select("id", *kept, "text").mapInArrow(lean(tag), "".join(f"{c} {kinds[c]}, " for c in ("id", *kept)) + "key long, sum int, data binary")
    out = "".join(f"`{c}` {kinds[own]}, " for c, own in zip((id, *carry), ("id", *kept)))
    return texts.join(per_row, ["key", "sum"], "left").select("id", *kept, "data", "spans").mapInArrow(lean(cut), f"{out}n_bytes long, n_removed long, n_spans long, {last} string")
