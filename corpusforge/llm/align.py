"""Alignment of two tokenizers by segment deduplication.

Texts are split before runs of white space where neither vocabulary has a piece that holds the run's first
character behind another kind of character, so no merge crosses the cut (the byte-level tokenizer's words end there
as well). Each different segment is tokenised by both and aligned once, whatever the number of texts
that hold it. Tasks number the segments of a bounded part of their texts; a text is then a list of numbers. A
part's dictionary goes to the tasks that hold the segments by their hash, a row for each, and comes back with the alignments;
texts are composed from it. A common word is one entry for each part, and texts are never shuffled. How many texts hold a pair is
counted in the same way, by the pair's first id.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpusforge.session import estimated_bytes

from .bpe import SETTLED, FastIds, Vocabulary, read_vocabulary
from .common import Batches, checkpoint, lean, narrow, strings, tune

#: A part is closed once its texts have this many characters; the dictionaries in memory are bounded by it.
PART_CHARS = 64 << 20
#: Segments that are tokenised together; alignments that a task remembers; segments whose links are listed together; pairs that are counted together.
TOGETHER, MEMO_ENTRIES, SLICE, HELD_PAIRS = 2048, 1 << 20, 1 << 16, 1 << 22
#: Bytes of the input on disk for each task of a shuffle, where the session asks for fewer tasks.
BUCKET_BYTES = 32 << 20
#: The fixed pattern of byte entries of piece vocabularies, and their sign for a space.
BYTE_ENTRY, SPACE = re.compile(r"<0x([0-9A-F]{2})>"), "▁"
WHITE = " \t\n\v\f\r"
GUARD = "x"


def splittable(pieces: list[bytes]) -> str:
    """The white space that no piece holds right behind anything but white space: no merge crosses a cut before a run of white space that begins with it.
    Parts of characters count as something else."""
    texts = [p.decode("utf-8", "replace") for p in pieces]
    inner = {b for t in texts for a, b in zip(t, t[1:]) if b in WHITE and not a.isspace()}
    return "".join(w for w in WHITE if w not in inner)


def segment_pattern(breaks: str) -> str:
    """Matches a segment: white space and what follows it up to the next run of white space that begins with one of `breaks`."""
    if not breaks:
        return r"[\s\S]+"
    glue = rf"[^\S{breaks}]"
    return rf"\s*\S+(?:{glue}\s*\S+)*(?:{glue}\s*\Z)?|\s+"


class Aligner:
    """Both tokenizers, the pieces' bytes, and the cuts that they allow."""

    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        from sentencepiece import SentencePieceProcessor

        vocabulary = Vocabulary(byte_vocabulary)
        self.first = FastIds(byte_vocabulary)
        self.first.whole.encode_special_tokens = True  # their strings are plain text
        self.second = SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        byte = [BYTE_ENTRY.fullmatch(p) if self.second.is_byte(i) else None for i, p in enumerate(pieces)]
        self.bytes = [vocabulary.pieces, [bytes([int(m[1], 16)]) if m else p.replace(SPACE, " ").encode() for p, m in zip(pieces, byte)]]
        self.sizes = [np.array(list(map(len, x)), np.int64) for x in self.bytes]
        self.decimal = np.array([str(i) for i in range(max(map(len, self.bytes)))], object)
        self.breaks = splittable([*self.bytes[0], *self.bytes[1]])
        guard = self.second.encode(GUARD)
        if len(guard) != 1:
            raise ValueError(f"{GUARD!r} is not one piece of the vocabulary")
        self.guard = guard[0]
        self.segments = re.compile(segment_pattern(self.breaks)).findall

    def encode(self, text: str) -> list[np.ndarray]:
        """Ids of a text that begins with white space. What is put before it for the second tokenizer takes the space which that adds."""
        settled = text.isascii() or max(text) < SETTLED
        first = self.first.fast(text) if settled else self.first.whole.encode(text, add_special_tokens=False).ids
        second = self.second.encode(GUARD + text)
        if second[0] != self.guard:
            raise ValueError("a merge crosses a cut that the vocabulary should not allow")
        return [np.array(first, np.int64), np.array(second[1:], np.int64)]

    def align(self, segments: list[str]) -> list[str]:
        """Per segment its groups as a1,a2|b1;a3|b2,b3; empty where the bytes of either tokenizer differ from the segment's."""
        text = "".join(segments)
        ids, size = self.encode(text), np.cumsum([len(s.encode()) for s in segments])
        plain = text.encode()
        if any(b"".join(map(of.__getitem__, x.tolist())) != plain for of, x in zip(self.bytes, ids)):
            if len(segments) == 1:
                return [""]
            half = len(segments) // 2
            return self.align(segments[:half]) + self.align(segments[half:])
        ends = [np.cumsum(sizes[x]) for sizes, x in zip(self.sizes, ids)]
        shared = np.intersect1d(*ends)  # no piece is empty, so ends rise
        groups = [np.searchsorted(shared, e) for e in ends]
        owner = np.searchsorted(size, shared)  # the segment that a group lies in
        if not np.isin(size, shared).all():
            raise ValueError("a token crosses a cut that the vocabularies should not allow")
        group, side = np.concatenate(groups), np.repeat([0, 1], list(map(len, ids)))
        order = np.argsort(group * 2 + side, kind="stable")
        group, side, out = group[order], side[order], self.decimal[np.concatenate(ids)[order]]
        sign = np.full(len(out), ",", object)
        new_group = np.append(group[1:] != group[:-1], True)
        sign[np.append(side[1:] != side[:-1], False) & ~new_group] = "|"
        sign[new_group] = ";"
        sign[np.append(owner[group[1:]] != owner[group[:-1]], True)] = "\n"
        mixed = np.empty(2 * len(out), object)
        mixed[::2], mixed[1::2] = out, sign
        return "".join(mixed.tolist()).split("\n")[:-1]

    def align_all(self, segments: list[str]) -> list[str]:
        out = [""] * len(segments)
        alone = [i for i, s in enumerate(segments) if s[-1:].isspace()]  # another segment behind them would lengthen their run of white space
        for i in alone:
            out[i] = self.align([segments[i]])[0]
        skip = set(alone)
        rest = [i for i in range(len(segments)) if i not in skip]
        for k in range(0, len(rest), TOGETHER):
            some = rest[k : k + TOGETHER]
            for i, groups in zip(some, self.align([segments[i] for i in some])):
                out[i] = groups
        return out


def _shared(documents: DataFrame, byte_vocabulary_path: str, piece_model_path: str):
    with open(piece_model_path, "rb") as f:
        return documents.sparkSession.sparkContext.broadcast((read_vocabulary(byte_vocabulary_path), f.read()))


def _pack(values, kind: str = "<u4") -> bytes:
    return zstandard.compress(np.asarray(values, kind).tobytes(), 1)


def _unpack(packed: bytes, kind: str = "<u4") -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


def _pack_strings(values: list[str]) -> bytes:
    sizes = np.fromiter(map(len, values), "<u4", len(values))
    return zstandard.compress(len(values).to_bytes(8, "little") + sizes.tobytes() + "".join(values).encode(), 1)


def _unpack_strings(packed: bytes) -> list[str]:
    block = zstandard.decompress(packed)
    n = int.from_bytes(block[:8], "little")
    ends, text = np.cumsum(np.frombuffer(block, "<u4", n, 8)).tolist(), block[8 + 4 * n :].decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


class _Rows:
    """Record batches of a schema, from rows as tuples."""

    def __init__(self, **types: pa.DataType):
        self.schema = pa.schema(list(types.items()))

    def of(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(self.schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


_LONG, _BYTES, _TEXT = pa.int64(), pa.binary(), pa.string()


def coded(documents: DataFrame, shared, id: str, text: str, part_chars: int, buckets: int) -> DataFrame:
    """Rows of two kinds. Texts: part, id, x (the numbers of their segments; null without text). Dictionaries: part, bucket, x (numbers), y (segments)."""
    df = narrow(documents, id=id, text=text)
    key, local = to_arrow_type(df.schema["id"].dataType), {}

    def run(batches: Batches) -> Batches:
        if "cut" not in local:
            local["cut"] = Aligner(*shared.value).segments
        out = _Rows(part=_LONG, bucket=_LONG, id=key, x=_BYTES, y=_BYTES)
        cut, k, chars = local["cut"], TaskContext.get().partitionId() << 32, 0
        index: defaultdict = defaultdict()
        index.default_factory = index.__len__

        def dictionary() -> Batches:
            known = list(index)
            index.clear()
            bucket = np.fromiter((zlib.crc32(s.encode()) % buckets for s in known), np.int64, len(known))
            order = np.argsort(bucket, kind="stable")
            for at in np.split(order, np.nonzero(np.diff(bucket[order]))[0] + 1) if len(known) else []:
                yield out.of([(k, int(bucket[at[0]]), None, _pack(at), _pack_strings([known[i] for i in at.tolist()]))])

        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0), strings(batch, "text")):
                rows.append((k, None, i.as_py(), _pack(list(map(index.__getitem__, cut(" " + t)))) if t else None, None))
                chars += len(t or "")
                if chars >= part_chars:
                    yield out.of(rows)
                    yield from dictionary()
                    rows, chars, k = [], 0, k + 1
            yield out.of(rows)
        yield from dictionary()

    return df.mapInArrow(lean(run), f"part long, bucket long, id {df.schema['id'].dataType.simpleString()}, x binary, y binary")


def aligned(dictionaries: DataFrame, shared, buckets: int) -> DataFrame:
    """Dictionaries with groups in place of segments. All copies of a segment meet in one task, which aligns it once and remembers it."""
    local: dict = {}

    def run(batches: Batches) -> Batches:
        if "both" not in local:
            local["both"] = Aligner(*shared.value)
        out, memo = _Rows(part=_LONG, x=_BYTES, y=_BYTES), {}
        for batch in batches:
            for part, x, y in zip(*(batch.column(c).to_pylist() for c in range(3))):
                segments = _unpack_strings(y)
                fresh = [s for s in segments if s not in memo]
                if len(memo) + len(fresh) > MEMO_ENTRIES:
                    memo, fresh = {}, segments
                memo.update(zip(fresh, local["both"].align_all(fresh)))
                yield out.of([(part, x, _pack_strings([memo[s] for s in segments]))])

    return dictionaries.repartition(buckets, "bucket").select("part", "x", "y").mapInArrow(lean(run), "part long, x binary, y binary")


class Dictionary:
    """What texts need of a part's segments, read from their groups: numbers of tokens, groups and links, and links as id pairs."""

    def __init__(self, groups: list[str]):
        self.groups = groups
        self.good = np.fromiter((g != "" for g in groups), bool, len(groups))
        self.n_a, self.n_b, self.n_groups, self.n_links, sizes = np.zeros((5, len(groups)), np.int64)
        slices = [self._links(k, min(k + SLICE, len(groups)), sizes) for k in range(0, len(groups), SLICE)]
        none = np.empty(0, np.int64)
        self.pairs = np.unique(np.concatenate([p for p, _, _ in slices] or [none]))
        self.at = np.concatenate([np.searchsorted(self.pairs, p).astype(np.uint32)[i] for p, i, _ in slices] or [none])
        self.times = np.concatenate([t for _, _, t in slices] or [none])
        self.begin = np.concatenate([[0], np.cumsum(sizes)])

    def _links(self, low: int, high: int, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the segments from low to high: their different pairs, and for each segment and pair of its links the pair's number and how many links."""
        here = low + np.nonzero(self.good[low:high])[0]
        if not len(here):
            return np.empty(0, np.int64), np.empty(0, np.uint32), np.empty(0, np.uint32)
        text = np.frombuffer(("\n".join(self.groups[i] for i in here.tolist()) + "\n").encode(), np.uint8)
        ends = np.nonzero((text < 48) | (text > 57))[0]
        starts, sign = np.concatenate([[0], ends[:-1] + 1]), text[ends]
        value = np.zeros(len(ends), np.int64)
        for k in range(int((ends - starts).max())):
            there = starts + k < ends
            value[there] = value[there] * 10 + text[starts[there] + k] - 48
        closes, before = (sign == ord(";")) | (sign == ord("\n")), lambda hit: np.cumsum(hit) - hit
        group, row = before(closes), before(sign == ord("\n"))
        second = before(sign == ord("|")) > group  # behind the bar of its group
        n_groups = int(closes.sum())
        a, b, first_group = value[~second], value[second], group[~second]
        in_a, in_b = np.bincount(first_group, minlength=n_groups), np.bincount(group[second], minlength=n_groups)
        owner = here[row[closes]]  # of each group
        for total, weights in ((self.n_a, in_a), (self.n_b, in_b), (self.n_groups, np.ones(n_groups)), (self.n_links, in_a * in_b)):
            total[low:high] = np.bincount(owner - low, weights, high - low)
        # Every token of a group's first side with every one of its second.
        times = in_b[first_group]
        left = np.repeat(np.arange(len(a)), times)
        nth = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        pairs, at = np.unique(a[left] << 32 | b[(np.cumsum(in_b) - in_b)[first_group[left]] + nth], return_inverse=True)
        entries, n = np.unique((owner[first_group[left]] - low) * len(pairs) + at, return_counts=True)  # links of one pair within a segment are one entry
        sizes[low:high] = np.bincount(entries // len(pairs), minlength=high - low)
        return pairs, (entries % len(pairs)).astype(np.uint32), n.astype(np.uint32)

    def links(self, segments: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs (by number) that segments, each so many times, link, and how many links each has."""
        size = self.begin[segments + 1] - self.begin[segments]
        entry = np.arange(size.sum()) + np.repeat(self.begin[segments] - (np.cumsum(size) - size), size)
        pairs, at = np.unique(self.at[entry], return_inverse=True)
        return pairs, np.bincount(at, np.repeat(counts, size) * self.times[entry], len(pairs)).astype(np.int64)


def _by_key(batches: Batches, columns: list[str]):
    """(key, kind, rows) of runs of rows sorted by key and kind; a long run comes in several pieces."""
    for batch in batches:
        rows = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ["key", "kind", *columns])))
        k = 0
        while k < len(rows):
            end = k
            while end < len(rows) and rows[end][:2] == rows[k][:2]:
                end += 1
            yield rows[k][0], rows[k][1], [r[2:] for r in rows[k:end]]
            k = end


FOUR = ["n_a", "n_b", "n_groups", "n_links"]


def composed(texts: DataFrame, dictionaries: DataFrame, buckets: int) -> DataFrame:
    """Rows of two kinds. Texts: part, id, their numbers and groups_sha256, x (pairs by number) and y (links of each). Pairs of a part: part, bucket,
    x (their numbers), y (the pairs), z (how many texts of the part link them)."""
    key, kind = to_arrow_type(texts.schema["id"].dataType), texts.schema["id"].dataType.simpleString()
    known = dictionaries.select(F.col("part").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("id"), "x", "y")
    rows = known.unionAll(texts.select(F.col("part").alias("key"), F.lit(1), "id", "x", F.lit(None).cast("binary")))

    def run(batches: Batches) -> Batches:
        out = _Rows(part=_LONG, bucket=_LONG, id=key, **dict.fromkeys(FOUR, _LONG), groups_sha256=_TEXT, x=_BYTES, y=_BYTES, z=_BYTES)
        part, heads, book, held = None, [], None, None

        def close() -> Batches:
            if book is None:
                return
            bucket = (book.pairs >> 32) % buckets
            order = np.argsort(bucket, kind="stable")
            for at in np.split(order, np.nonzero(np.diff(bucket[order]))[0] + 1) if len(order) else []:
                yield out.of([(part, int(bucket[at[0]]), *[None] * 6, _pack(at), _pack(book.pairs[at], "<u8"), _pack(held[at]))])

        for now, kind, some in _by_key(batches, ["id", "x", "y"]):
            if now != part:
                yield from close()
                part, heads, book = now, [], None
            if kind == 0:
                heads += [(x, y) for _, x, y in some]
                continue
            if book is None:
                at = [_unpack(x) for x, _ in heads]
                listed = np.empty(sum(map(len, at)), object)
                for a, (_, y) in zip(at, heads):
                    listed[a] = _unpack_strings(y)
                heads, book = [], Dictionary(listed.tolist())
                held = np.zeros(len(book.pairs), np.int64)
            done = []
            for i, x, _ in some:
                codes = _unpack(x) if x is not None else np.empty(0, "<u4")
                used, counts = np.unique(codes, return_counts=True)
                if len(codes) and book.good[used].all():
                    pairs, times = book.links(used, counts)
                    held[pairs] += 1
                    sha = hashlib.sha256(";".join(map(book.groups.__getitem__, codes.tolist())).encode()).hexdigest()
                    done.append((part, None, i, *(int((getattr(book, c)[used] * counts).sum()) for c in FOUR), sha, _pack(pairs), _pack(times), None))
                else:
                    done.append((part, None, i, 0, 0, 0, 0, "", None, None, None))
            yield out.of(done)
        yield from close()

    longs = ", ".join(f"{c} long" for c in FOUR)
    return rows.repartition(buckets, "key").sortWithinPartitions("key", "kind").mapInArrow(lean(run), f"part long, bucket long, id {kind}, {longs}, groups_sha256 string, x binary, y binary, z binary")


def counted(pairs: DataFrame, buckets: int) -> DataFrame:
    """Per bucket: x (pairs, rising), y (how many texts link each), z (whether that is the most of its first id). All pairs of an id share a bucket."""
    def run(batches: Batches) -> Batches:
        out = _Rows(bucket=_LONG, x=_BYTES, y=_BYTES, z=_BYTES)
        bucket, held, size = None, [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            listed, at = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
            return listed, np.bincount(at, np.concatenate([n for _, n in held]), len(listed)).astype("<u8")

        def close() -> Batches:
            if held:
                listed, n = summed()
                first = np.concatenate([[True], (listed[1:] >> np.uint64(32)) != (listed[:-1] >> np.uint64(32))])
                top = np.maximum.reduceat(n, np.nonzero(first)[0])[np.cumsum(first) - 1]
                yield out.of([(bucket, _pack(listed, "<u8"), _pack(n, "<u8"), _pack(n == top, "u1"))])

        for now, _, some in _by_key(batches, ["y", "z"]):
            if now != bucket:
                yield from close()
                bucket, held, size = now, [], 0
            for y, z in some:
                held.append((_unpack(y, "<u8"), _unpack(z)))
                size += len(held[-1][0])
                if size >= HELD_PAIRS:
                    held = [summed()]
                    size = 0
        yield from close()

    rows = pairs.select(F.col("bucket").alias("key"), F.lit(0).alias("kind"), "y", "z")
    return rows.repartition(buckets, "key").sortWithinPartitions("key").mapInArrow(lean(run), "bucket long, x binary, y binary, z binary")


def valued(pairs: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """Pairs of a part with their counts: part, x (their numbers), y (counts), z (whether the most of their first id)."""
    empty = F.lit(None).cast("binary")
    rows = counts.select(F.col("bucket").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("part"), "x", "y", "z")
    rows = rows.unionAll(pairs.select(F.col("bucket").alias("key"), F.lit(1), "part", "x", "y", empty))

    def run(batches: Batches) -> Batches:
        out, listed, n, best = _Rows(part=_LONG, x=_BYTES, y=_BYTES, z=_BYTES), None, None, None
        for _, kind, some in _by_key(batches, ["part", "x", "y", "z"]):
            for part, x, y, z in some:
                if kind == 0:
                    listed, n, best = _unpack(x, "<u8"), _unpack(y, "<u8"), _unpack(z, "u1")
                else:
                    at = np.searchsorted(listed, _unpack(y, "<u8"))
                    yield out.of([(part, x, _pack(n[at], "<u8"), _pack(best[at], "u1"))])

    return rows.repartition(buckets, "key").sortWithinPartitions("key", "kind").mapInArrow(lean(run), "part long, x binary, y binary, z binary")


def align(documents: DataFrame, byte_vocabulary_path: str, piece_model_path: str, id: str = "doc_id", text: str = "text", part_chars: int = PART_CHARS) -> DataFrame:
    """Aligns the tokens of a byte-level and of a piece tokenizer over every whole text.

    The first encodes a space and the text, the second the text (it adds the space itself). Groups lie between byte offsets at which tokens
    of both end; all token pairs of a group are links. Returns per row: id, n_a, n_b, n_groups, n_links, n_best (links of an id pair that as many
    texts hold as any pair of its first id), count_sum (over links, how many texts hold the pair) and groups_sha256. Texts that are null, empty or
    not kept byte for byte by both have no tokens: zeros and ''. Very long texts are segments like others; a text without white space is one
    segment. Repeated rows are a text each. An empty table gives an empty result; further columns are ignored.
    """
    spark = documents.sparkSession
    tune(spark)
    shared, buckets, known = _shared(documents, byte_vocabulary_path, piece_model_path), int(spark.conf.get("spark.sql.shuffle.partitions")), estimated_bytes(documents)
    buckets = max(buckets, known // BUCKET_BYTES) if known < 1 << 50 else buckets  # tasks stay as large as they are, whatever the input
    rows = checkpoint(coded(documents, shared, id, text, part_chars, buckets))
    books = aligned(rows.filter("bucket IS NOT NULL").select("part", "bucket", "x", "y"), shared, buckets)
    done = checkpoint(composed(rows.filter("bucket IS NULL").select("part", "id", "x"), books, buckets))
    pairs = done.filter("bucket IS NOT NULL").select("part", "bucket", "x", "y", "z")
    values = valued(pairs.drop("z"), counted(pairs, buckets), buckets)

    texts = done.filter("bucket IS NULL")
    key, kind = to_arrow_type(texts.schema["id"].dataType), texts.schema["id"].dataType.simpleString()
    none = [F.lit(None).cast(t).alias(c) for c, t in [("id", kind), *((c, "long") for c in FOUR), ("groups_sha256", "string")]]
    heads = values.select(F.col("part").alias("key"), F.lit(0).alias("kind"), *none, "x", "y", "z")
    both = heads.unionAll(texts.select(F.col("part").alias("key"), F.lit(1), "id", *FOUR, "groups_sha256", "x", "y", "z"))

    def run(batches: Batches) -> Batches:
        out = _Rows(id=key, **dict.fromkeys([*FOUR, "n_best", "count_sum"], _LONG), groups_sha256=_TEXT)
        part, held, n, best = None, [], None, None
        for now, kind, some in _by_key(batches, ["id", *FOUR, "groups_sha256", "x", "y", "z"]):
            if now != part:
                part, held, n = now, [], None
            if kind == 0:
                held += [(_unpack(x), _unpack(y, "<u8"), _unpack(z, "u1")) for *_, x, y, z in some]
                continue
            if n is None:
                size = sum(len(x) for x, _, _ in held)
                n, best = np.zeros(size, np.int64), np.zeros(size, bool)
                for x, y, z in held:
                    n[x], best[x] = y, z > 0
                held = []
            done = []
            for i, *four, sha, x, y, _ in some:
                pairs, times = (_unpack(x), _unpack(y).astype(np.int64)) if x is not None else (np.empty(0, np.uint32), np.empty(0, np.int64))
                done.append((i, *four, int(times[best[pairs]].sum()), int((times * n[pairs]).sum()), sha))
            yield out.of(done)

    longs = ", ".join(f"{c} long" for c in [*FOUR, "n_best", "count_sum"])
    return both.repartition(buckets, "key").sortWithinPartitions("key", "kind").mapInArrow(lean(run), f"id {kind}, {longs}, groups_sha256 string").withColumnRenamed("id", id)
