"""Document fingerprints as Merkle trees over paragraphs and sections.

A leaf is the hash of a piece of a paragraph (a line, cut after sentences and at content-defined
words, of bounded length), a section (lines up to and with the blank lines that end it) hashes its leaves, the root
hashes the sections. Roots test equality; where they differ, only sections that differ are
descended, which locates edits. The fingerprint is the tree written out, its hashes shortened, a leaf's
followed by its length: root|section.leaf,leaf,...|section.leaf,...
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import Batches, lean, narrow, strings, tune

LEAF_DIGITS, SECTION_DIGITS = 12, 16
LEAST = -(1 << 63)
#: Bounds of id ranges that an expression holds; more are searched in Python.
LITERAL_BOUNDS = 1024
#: A line is cut after a sentence, and after a word whose check sum is 0 modulo CUT: an edit moves no cut but those beside it.
CUT = 16
#: No leaf is much longer than this, however few words a text repeats; inside such a word, cuts are 1 in RUN_CUT characters.
LONGEST, RUN_CUT = 96, 64
#: No text holds a lone surrogate.
GLUE = "\ud800"
SENTENCE = re.compile(r"(?<=[.!?]) ")
BLANKS = re.compile(r"\n(?:[^\S\n]*(?:\n|\Z))+")


def _hash(kind: bytes, data: bytes) -> str:
    return hashlib.sha256(kind + data).hexdigest()


@lru_cache(1 << 16)
def _ends(word: str) -> bool:
    return zlib.crc32(word.encode("utf-8", "replace")) % CUT == 0


def runs(word: str) -> list[str]:
    """A long word cut behind characters that the eight up to them choose, and at LONGEST characters where these choose none."""
    out, start = [], 0
    for k in range(8, len(word)):
        if k - start >= LONGEST or k - start >= 32 and zlib.crc32(word[k - 8 : k].encode("utf-8", "replace")) % RUN_CUT == 0:
            out.append(word[start:k])
            start = k
    return [*out, word[start:]]


def pieces(line: str) -> list[str]:
    """What a line consists of, nothing lost: sentences, long ones cut at words that their own letters choose, or where a piece reaches LONGEST characters; words of
    more than that are cut as well, and what goes on within a word begins with GLUE."""
    out = []
    for sentence in SENTENCE.split(line):
        if len(sentence) < 64:
            out.append(sentence)
            continue
        at, size = [], 0
        for word in sentence.split(" "):
            if len(word) > LONGEST:
                first, *rest = runs(word)
                at.append(first)
                for run in rest:
                    out.append(" ".join(at))
                    at = [GLUE + run]
                size = LONGEST if size + len(at[-1]) >= LONGEST else len(at[-1])
            else:
                at.append(word)
                size += len(word) + 1
            if size >= LONGEST or len(word) <= LONGEST and _ends(word):
                out.append(" ".join(at))
                at, size = [], 0
        if at:
            out.append(" ".join(at))
    return out


def sections(text: str | None) -> list[tuple[list[str], str]]:
    """(pieces, the blank lines that follow) by section."""
    text, out, at = text or "", [], 0
    for gap in BLANKS.finditer(text):
        out.append((text[at : gap.start()], gap[0]))
        at = gap.end()
    if at < len(text):
        out.append((text[at:], ""))
    return [([p + "\n" * (k == len(cut) - 1) for line in body.split("\n") for cut in [pieces(line)] for k, p in enumerate(cut)], gap) for body, gap in out]


def fingerprint(text: str | None) -> str:
    """Hashes go up unshortened, and white space between sections with them, so equal roots are equal trees, and these equal texts."""
    branches, above = [], []
    for parts, gap in sections(text):
        leaves = [_hash(b"p", p.encode("utf-8", "surrogatepass")) for p in parts]
        above.append(_hash(b"s", ",".join([*leaves, gap]).encode("utf-8", "replace")))
        branches.append(above[-1][:SECTION_DIGITS] + "." + ",".join(f"{x[:LEAF_DIGITS]}{len(p):x}" for x, p in zip(leaves, parts)))
    return "|".join([_hash(b"r", "|".join(above).encode()), *branches])


def parse(fp: str) -> tuple[str, list[tuple[str, list[str]]]]:
    root, *branches = fp.split("|")
    return root, [(b.split(".")[0], b.split(".")[1].split(",")) for b in branches]


def weight(leaf: str) -> int:
    """Characters of a leaf."""
    return int(leaf[LEAF_DIGITS:], 16)


def likeness(a: str, b: str) -> float:
    """The share of characters in leaves that both have, of the longer one's; 1 for equal roots. Sections that match are taken whole."""
    if a == b:
        return 1.0
    (_, left), (_, right) = parse(a), parse(b)
    whole = {h: sum(map(weight, x)) for side in (left, right) for h, x in side}
    size = max(sum(whole[h] for h, _ in side) for side in (left, right))
    if not size:
        return 0.0
    common = Counter(h for h, _ in left) & Counter(h for h, _ in right)
    same, rests = sum(n * whole[h] for h, n in common.items()), []
    for side in (left, right):
        skip, rest = Counter(common), Counter()
        for h, own in side:
            if skip[h]:
                skip[h] -= 1
            else:
                rest.update(own)
        rests.append(rest)
    return (same + sum(n * weight(x) for x, n in (rests[0] & rests[1]).items())) / size


def edits(a: str, b: str) -> list[tuple[str, int, int]]:
    """(removed | added | moved, section, leaf), found by descending into differing sections only: what stands alike at the front and at the
    back of both is passed over, first section by section, then leaf by leaf. What is left of a, by its places, is removed, or moved if b
    has it elsewhere in what is left; the rest of b is added, by its places."""
    (root, left), (other, right) = parse(a), parse(b)
    if root == other:
        return []

    def middle(x: list, y: list) -> tuple[int, int]:
        least, front, back = min(len(x), len(y)), 0, 0
        while front < least and x[front] == y[front]:
            front += 1
        while back < least - front and x[-1 - back] == y[-1 - back]:
            back += 1
        return front, back

    front, back = middle([h for h, _ in left], [h for h, _ in right])
    rest = [[(x, i, j) for i, (_, leaves) in enumerate(side) if front <= i < len(side) - back for j, x in enumerate(leaves)] for side in (left, right)]
    front, back = middle(*([x for x, _, _ in side] for side in rest))
    rest = [side[front : len(side) - back] for side in rest]
    spare, out = Counter(x for x, _, _ in rest[1]), []
    stayed: Counter = Counter()
    for x, i, j in rest[0]:
        moved = spare[x] > 0
        spare[x] -= moved
        stayed[x] += moved
        out.append(("moved" if moved else "removed", i, j))
    for x, i, j in rest[1]:
        if stayed[x]:
            stayed[x] -= 1
        else:
            out.append(("added", i, j))
    return out


def fingerprints(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fingerprint) of every text; null counts as empty."""
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t) for t in strings(batch, "text")], pa.string())], names=[id, "fingerprint"])

    return df.mapInArrow(lean(run), f"`{id}` {df.schema['id'].dataType.simpleString()}, fingerprint string")


def with_next(documents: DataFrame, id: str, text: str) -> DataFrame:
    """Rows in falling order of id within ranges of ids, each range followed by the first row of the next one (extra).

    Sorting is by range; what follows a range's last row is carried over as one copied row per range, so no
    task sees more than its range. Equal ids are ordered by a hash of their texts; null ids come last. An id that fills several
    ranges is dealt to as many by that hash.
    """
    spark = documents.sparkSession
    df = narrow(documents, id=id, text=text).withColumn("order", F.coalesce(F.col("id").cast("long"), F.lit(LEAST))).withColumn("h", F.xxhash64("text"))
    ranges = max(16, min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 16))
    bounds = df.agg(F.percentile_approx("order", [k / ranges for k in range(1, ranges)], 10 * ranges).alias("b")).first().b
    hot = [(b, n) for b, n in Counter(bounds or []).items() if n > 1]  # at most half as many as ranges
    bounds = sorted(set(bounds or []))
    df = df.withColumn("range", _bucket(bounds)) if len(bounds) <= LITERAL_BOUNDS else _search(df, bounds)
    many = spark.createDataFrame(hot, "order long, parts long")
    part = F.floor((F.col("h") / float(1 << 64) + 0.5) * F.col("parts"))
    sub = F.when(F.col("parts").isNotNull(), 1 + F.col("parts") - F.least(F.greatest(part, F.lit(0)), F.col("parts") - 1)).otherwise(0)  # falls as the hash rises
    df = df.join(F.broadcast(many), "order", "left").withColumn("range", (F.col("range") * (1 << 20) + sub).cast("long")).drop("parts")
    heads = {r.range: (r["head"]["order"], r["head"]["h"]) for r in df.groupBy("range").agg(F.max(F.struct("order", (-F.col("h")).alias("back"), "h")).alias("head")).collect()}  # one row per range
    falling = sorted(heads, reverse=True)
    following = [(*heads[b], a) for a, b in zip(falling, falling[1:] + falling[:1])]
    table = spark.createDataFrame(following, "order long, h long, target long")
    # Rows of equal id and hash are alike: one of them is enough.
    extra = df.join(F.broadcast(table), ["order", "h"]).groupBy("order", "h", F.col("target").alias("range")).agg(F.min("id").alias("id"), F.min("text").alias("text"))
    extra = extra.select("id", "text", "order", "h", "range", F.lit(True).alias("extra"))
    return df.select("id", "text", "order", "h", "range", F.lit(False).alias("extra")).unionAll(extra)


def _bucket(bounds: list[int]):
    """How many bounds are smaller: a search that the JVM evaluates, as nested halves."""
    def half(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("order") > bounds[mid], half(mid + 1, hi)).otherwise(half(lo, mid))

    return half(0, len(bounds))


def _search(df: DataFrame, bounds: list[int]) -> DataFrame:
    """The same for more bounds than an expression should hold."""
    shared = df.sparkSession.sparkContext.broadcast(np.array(bounds, np.int64))  # at most 65,536 numbers

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = np.searchsorted(shared.value, batch.column(batch.schema.get_field_index("order")).to_numpy(), "left")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.astype(np.int32))], names=[*batch.schema.names, "range"])

    return df.mapInArrow(lean(run), StructType([*df.schema.fields, StructField("range", IntegerType())]))


def edit_report(documents: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints every text and its edited form: the last third of its characters (rounded down) replaced by as many from
    the front of the next document in falling order of id (or all it has); after the last comes the first.

    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_edits. ids are integers. Null texts
    count as empty; very long ones are read whole. Null ids come last; repeated ids are ordered by a hash of their texts. A single row is
    its own next one. n_edits: leaves that the edited text lost, gained or moved. An empty table gives an empty result; other columns are
    ignored.
    """
    tune(documents.sparkSession)
    rows = with_next(documents, id, text)
    kind = rows.schema["id"].dataType.simpleString()
    dealt = rows.repartition("range").sortWithinPartitions("range", "extra", F.desc("order"), "h")

    def run(batches: Batches) -> Batches:
        held = None  # (range, id, text, fingerprint), waiting for the row after it
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
        for batch in batches:
            ids, out = [], []
            for i, t, r, extra in zip(*(strings(batch, n) for n in ("id", "text", "range", "extra"))):
                t = t or ""
                fp = fingerprint(t)
                if held is not None and held[0] == r:
                    _, own, whole, mine = held
                    k = len(whole) // 3
                    edited = whole[: len(whole) - k] + t[:k]
                    other = fingerprint(edited)
                    ids.append(own)
                    out.append((len(whole), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), mine, other, likeness(mine, other), likeness(mine, fp), len(edits(mine, other))))
                held = None if extra else (r, i, t, fp)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types))], names=[id, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_edits"])

    return dealt.select("id", "text", "range", "extra").mapInArrow(lean(run), f"`{id}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_edits long")
