"""Finding near-duplicates by blocking, verification and grouping."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from corpusforge.functions import pitch
from corpusforge.functions import text as T
from corpusforge.operators.components import connected_components, cut_lineage
from corpusforge.session import ship_package

#: N-gram length, sizes of a block, shared n-grams of a candidate pair, thresholds.
GRAM, LEAST_BLOCK, MOST_BLOCK, SHARED = 5, 2, 8, 3
RATIO, CONTAINED = 0.55, 0.8


def gram_rows(docs: DataFrame, id: str = "doc_id", words: str = "words", n: int = GRAM) -> DataFrame:
    """(id, gram), each gram once a document."""
    return docs.select(F.col(id).alias("id"), F.explode(F.array_distinct(T.ngrams(F.col(words), n))).alias("gram"))


def candidate_pairs(docs: DataFrame, id: str = "doc_id", words: str = "words", n: int = GRAM, least: int = LEAST_BLOCK, most: int = MOST_BLOCK, shared: int = SHARED) -> DataFrame:
    """(a, b, shared) for documents a < b that share at least `shared` rare n-grams.

    An n-gram is rare if `least` to `most` documents have it (a rule of the operator): larger blocks are
    dropped before the join, so that no block yields more than most * (most - 1) / 2 pairs.
    """
    # Hashes instead of strings, in one shuffle. A row of a block sees the rows after it; the first row of a block that is no larger
    # than `most` (none stands `most` places behind it) pairs its own and each later one its own, so that no block is gathered.
    rows = gram_rows(docs, id, words, n).select("id", F.xxhash64("gram").alias("h1"), F.hash("gram").alias("h2"))
    block = Window.partitionBy("h1", "h2").orderBy("id")
    after = F.array(*(F.lead("id", k).over(block) for k in range(1, most + 1)))
    nth = F.row_number().over(block)
    first = rows.select("id", nth.alias("nth"), after.alias("after")).filter((F.col("nth") == 1) & F.get("after", F.lit(most - 1)).isNull())
    ids = F.filter(F.concat(F.array("id"), "after"), lambda x: x.isNotNull())
    lefts = first.select(ids.alias("ids")).filter(F.size("ids") >= F.greatest(F.lit(least), F.lit(2))).select("ids", F.posexplode("ids").alias("k", "a"))
    pairs = lefts.select("a", F.explode(F.slice("ids", F.col("k") + 2, F.size("ids"))).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("shared")).filter(F.col("shared") >= shared)


#: Up to this many documents of pairs are picked by a broadcast of their ids, before texts are shuffled.
PICKED = 1 << 20


def with_both(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """Pairs with the columns of told (id, ...) for a and for b, under their names with a or b behind. Only rows of documents in pairs are shuffled,
    if these are at most PICKED; pairs are evaluated more than once, so they should be cheap to read."""
    paired = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    few = paired.limit(PICKED + 1).count() <= PICKED
    told = told.join(F.broadcast(paired) if few else paired, "id", "left_semi")
    side = lambda c: told.select(F.col("id").alias(c), *(F.col(x).alias(f"{x}{c}") for x in told.columns if x != "id"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def containment(pairs: DataFrame, docs: DataFrame, id: str = "doc_id", words: str = "words") -> DataFrame:
    """Adds inter, the size of the multiset intersection of words, and least, the smaller number of words."""
    ship_package(pairs.sparkSession)
    # A pair meets its two documents as texts of words: counting words in place moves less than a row for every word of every pair.
    both = with_both(pairs, docs.select(F.col(id).alias("id"), F.array_join(words, " ").alias("t")))

    @F.pandas_udf("inter long, least long")
    def count(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        counted = [(Counter(p.split()), Counter(q.split())) for p, q in zip(x, y)]
        return pd.DataFrame([((p & q).total(), min(p.total(), q.total())) for p, q in counted], columns=["inter", "least"], dtype="int64")

    return both.select(*pairs.columns, count("ta", "tb").alias("c")).select(*pairs.columns, "c.inter", "c.least")


def verified(scored: DataFrame, num: int = 8, den: int = 10) -> DataFrame:
    """J6, the containment branch: inter / least above num / den, in whole numbers."""
    return scored.filter((F.col("least") > 0) & (F.col("inter") * den > F.col("least") * num))


def verified_either(scored: DataFrame, docs: DataFrame, id: str = "doc_id", words: str = "words") -> DataFrame:
    """Pairs by containment (branch cont), else by a ratio of their texts (words joined by blanks, letter by letter, a's first) above
    RATIO (branch seq). Pairs without a common word have neither. Lengths alone rule pairs out before any text moves; letter
    counts do before two texts are aligned."""
    ship_package(scored.sparkSession)
    contained = (F.col("least") > 0) & (F.col("inter") > CONTAINED * F.col("least"))
    text = docs.select(F.col(id).alias("id"), F.array_join(words, " ").alias("t"))
    na, nb = F.length("ta"), F.length("tb")
    rest = with_both(scored.filter(~contained & (F.col("inter") > 0)), text).filter(2 * F.least(na, nb) > RATIO * (na + nb)).repartition(F.col("a"), F.col("b"))

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([aligned_ratio(p, q, RATIO) for p, q in zip(x, y)], dtype="float64")

    by_ratio = rest.withColumn("ratio", run("ta", "tb")).filter(F.col("ratio") > RATIO)
    return scored.filter(contained).select(*scored.columns, F.lit("cont").alias("branch")).unionAll(by_ratio.select(*scored.columns, F.lit("seq").alias("branch")))


def drop_same_source(pairs: DataFrame, docs: DataFrame, id: str = "doc_id", source: str = "source") -> DataFrame:
    """Pairs whose two rows come from different sources."""
    s = docs.select(F.col(id).alias("id"), F.col(source).alias("s"))
    a, b = s.select(F.col("id").alias("a"), F.col("s").alias("sa")), s.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return pairs.join(a, "a").join(b, "b").filter(~F.col("sa").eqNullSafe(F.col("sb"))).select(pairs.columns)


# -- exact order-dependent forms -------------------------------------------------------------------------------------------
def ratio(a: str, b: str, autojunk: bool = False) -> float:
    """matching blocks' share; not symmetric, so the newer text comes first."""
    from difflib import SequenceMatcher

    return SequenceMatcher(None, a, b, autojunk=autojunk).ratio()


def aligned_ratio(a: str, b: str, above: float = 0.0, autojunk: bool = False) -> float:
    """ratio(a, b, autojunk), or 0 as soon as it can't exceed `above`: by letter counts, or by what the parts still to be aligned can add.
    The largest parts are aligned first, by hashes of runs, which is faster for letters than lists of places. With
    autojunk, letters of more than a hundredth of a b of 200 letters or more begin no run, but runs go on through them; few
    letters are left then, and difflib's own lists are short."""
    from difflib import SequenceMatcher

    total = len(a) + len(b)
    if not total:
        return 1.0
    if 2 * min(len(a), len(b)) <= above * total:
        return 0.0
    if autojunk and len(b) >= JUNK:
        # the nearer the texts have to be, the longer they agree, and the less do rare letters rule out
        if above <= 0.8 and 2 * _most_by_rare(a, b) <= above * total:
            return 0.0
        matcher = SequenceMatcher(None, a, b)
        return matcher.ratio() if matcher.real_quick_ratio() > above and matcher.quick_ratio() > above else 0.0
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    letters, ids = np.unique(np.concatenate([x, y]), return_inverse=True)
    x, y = ids[: len(x)], ids[len(x) :]
    if 2 * np.minimum(np.bincount(x, minlength=len(letters)), np.bincount(y, minlength=len(letters))).sum() <= above * total:
        return 0.0
    if above > 0.8 and 2 * _most_by_threes(x, y, len(letters)) <= above * total:
        return 0.0
    runs = _Runs(x, y, len(letters))
    matched, open_, room = 0, [(-len(x) * len(y), 0, len(x), 0, len(y), min(len(x), len(y)))], min(len(x), len(y))
    while open_ and 2 * (matched + room) > above * total:
        area, i0, i1, j0, j1, most = heappop(open_)
        room -= min(i1 - i0, j1 - j0)
        if -area <= SMALL_PART:
            matched += sum(m.size for m in SequenceMatcher(None, a[i0:i1], b[j0:j1], autojunk=False).get_matching_blocks())
            continue
        size, i, j = runs.longest(i0, i1, j0, j1, most)
        if size:
            matched += size
            for part in ((i0, i, j0, j), (i + size, i1, j + size, j1)):
                if fits := min(part[1] - part[0], part[3] - part[2]):
                    room += fits
                    heappush(open_, (-(part[1] - part[0]) * (part[3] - part[2]), *part, size))
    return 0.0 if open_ else 2 * matched / total


#: Parts of fewer pairs of letters are left to difflib. From this length on difflib leaves out the frequent letters of a text.
SMALL_PART, JUNK = 1 << 10, 200


#: Places of like rare letters up to which they are looked at.
SEEDS = 1 << 20


def _most_by_rare(a: str, b: str) -> float:
    """difflib matches no more letters where it leaves out b's frequent ones: a block grows from a place where both have the same rare letter, but for one
    at the very beginning of both, and goes no further than the texts agree there."""
    x, y = (np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in (a, b))
    letters, n = np.unique(y, return_counts=True)
    at = [(np.flatnonzero(x == c), np.flatnonzero(y == c)) for c in letters[n <= len(b) // 100 + 1]]
    if sum(len(i) * len(j) for i, j in at) > SEEDS:
        return math.inf
    start = np.zeros(int(a[:1] == b[:1]), np.int64)
    i, j = np.concatenate([start, *(np.repeat(i, len(j)) for i, j in at)]), np.concatenate([start, *(np.tile(j, len(i)) for i, j in at)])
    ends = []
    for step in (-1, 1):
        reach, going, far = np.zeros(len(i), np.int64), np.arange(len(i)), step
        while len(going):
            u, v = i[going] + far, j[going] + far
            going = going[inside] if not (inside := (np.minimum(u, v) >= 0) & (u < len(x)) & (v < len(y))).all() else going
            going = going[x[i[going] + far] == y[j[going] + far]]
            reach[going], far = far, far + step
        ends.append(reach)
    covered = lambda at, n: np.count_nonzero(np.cumsum(np.bincount(at + ends[0], minlength=n + 1) - np.bincount(at + ends[1] + 1, minlength=n + 1)))
    return min(covered(i, len(x)), covered(j, len(y)))


def _most_by_threes(x: np.ndarray, y: np.ndarray, letters: int) -> float:
    """No alignment matches more letters: e unmatched ones leave e + 1 blocks at most, and each block has two runs of three less than letters."""
    a, b = (np.unique((t[:-2] * letters + t[1:-1]) * letters + t[2:], return_counts=True) for t in (x.astype(np.int64), y.astype(np.int64)))
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return (np.minimum(a[1][i], b[1][j]).sum() + 2 * (len(x) + len(y) + 1)) / 5


class _Runs:
    """Longest common runs of parts of two texts, by hashes of their runs: n log n steps for a part of n letters. What hashes say is compared."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, x: np.ndarray, y: np.ndarray, letters: int):
        self.x, self.y = x, y
        codes, n = np.random.default_rng(42).integers(1, 1 << 63, letters, np.uint64), max(len(x), len(y)) + 1
        power, self.back = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(v % (1 << 64)))])) for v in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        self.sums = [np.concatenate([[np.uint64(0)], np.cumsum(codes[t] * power[: len(t)])]) for t in (x, y)]

    def hashes(self, side: int, start: int, end: int, size: int) -> np.ndarray:
        s = self.sums[side]
        return (s[start + size : end + 1] - s[start : end + 1 - size]) * self.back[start : end + 1 - size]

    def longest(self, i0: int, i1: int, j0: int, j1: int, most: int) -> tuple[int, int, int]:
        """(length, start in x, start in y) of the longest common run, at most `most` long, the earliest in x, then in y, of equals."""
        size, step, over, at = 0, 8, min(i1 - i0, j1 - j0, most) + 1, (i0, j0)
        while over - size > 1:
            middle = min(size + step, over - 1) if step else (size + over) // 2
            u, v = self.hashes(0, i0, i1, middle), self.hashes(1, j0, j1, middle)
            known = np.sort(v)
            hit = known[np.minimum(np.searchsorted(known, u), len(known) - 1)] == u
            first = int(hit.argmax())
            if hit[first]:
                size, step, at = middle, 2 * step, (i0 + first, j0 + int((v == u[first]).argmax()))
            else:
                over, step = middle, 0
        if (self.x[at[0] : at[0] + size] != self.y[at[1] : at[1] + size]).any():
            return _longest_run(self.x, self.y, i0, i1, j0, j1)
        return size, *at


def _longest_run(x: np.ndarray, y: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[int, int, int]:
    """The same by rows of a table of common runs, for texts of which different runs have one hash."""
    best, row = (0, i0, j0), np.zeros(j1 - j0 + 1, np.int64)
    for i in range(i0, i1):
        row[1:] = np.where(y[j0:j1] == x[i], row[:-1] + 1, 0)
        if row.max() > best[0]:
            top, j = int(row.max()), int(row.argmax())
            best = (top, i + 1 - top, j0 + j - top)
    return best


def ratio_column(a, b, autojunk: bool = False):
    """F30 as a Column over two string columns; null if either is."""
    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else ratio(p, q, autojunk) for p, q in zip(x, y)], dtype="float64")

    return run(a, b)


def close_pairs(left: DataFrame, right: DataFrame, cutoff: float) -> DataFrame:
    """(q, k, score): every pair of different strings, q of left and k of right, with score = ratio(k, q) >= cutoff; none is missed.

    Pairs that reach the cutoff have enough letters in common, wherever these stand: meet_by_letters compares counts of letters, tile by tile, which
    prose passes rarely and names of one pattern always. So short strings that may lose two letters at most (near_lengths) meet by what
    is left of both instead. Cutoffs up to 2/3 are refused: letters alone rule little out there.
    """
    if not 2 / 3 < cutoff <= 1:
        raise ValueError("the cutoff must be above 2/3, and 1 at most")
    ship_package(left.sparkSession)
    q, k = (df.select(F.col(df.columns[0]).alias("x")).filter("x <> ''").distinct().select("x", F.xxhash64("x").alias("id"), F.length("x").alias("n")) for df in (left, right))

    far, near = _met(q, k, cutoff)
    return _aligned(far.unionAll(near).distinct(), q, k, cutoff)


def close_links(left: DataFrame, right: DataFrame, cutoff: float, node=lambda x: F.xxhash64(x)) -> DataFrame:
    """(a, b): links that join the same nodes as all of close_pairs do, the node of a string of left being its hash, of right as given. Pairs of nodes that a tile has joined are not aligned
    again there, so many strings of one kind cost a few alignments each."""
    if not 2 / 3 < cutoff <= 1:
        raise ValueError("the cutoff must be above 2/3, and 1 at most")
    ship_package(left.sparkSession)
    q, k = (df.select(F.col(df.columns[0]).alias("x")).filter("x <> ''").distinct().select("x", F.xxhash64("x").alias("id"), F.length("x").alias("n")) for df in (left, right))
    far, near = _met(q, k, cutoff, node)
    return far.unionAll(_aligned(near, q, k, cutoff).select(F.xxhash64("q").alias("a"), node(F.col("k")).alias("b"))).distinct()


def _met(q: DataFrame, k: DataFrame, cutoff: float, node=None) -> tuple[DataFrame, DataFrame]:
    near, far = near_lengths(q, k, cutoff)
    # of strings of up to NEAR letters only those take part whose length has partners that don't meet as near ones
    longs = lambda df, side: df.filter((F.col("n") > NEAR) | F.col("n").isin(sorted({p[side] for p in far if p[side] <= NEAR})))
    return meet_by_letters(longs(q, 0), longs(k, 1), cutoff, node), meet_near(q, k, near)


def _aligned(found: DataFrame, q: DataFrame, k: DataFrame, cutoff: float) -> DataFrame:
    # Equal hashes of different strings only add candidates: both come back here, and the ratio decides. Planners take strings for 20 bytes, so
    # that they would hand long ones to all tasks.
    side = lambda df, c: df.select(F.col("id").alias(c), F.col("x").alias(f"x{c}")).hint("merge")
    texts = found.join(side(q, "q"), "q").join(side(k, "k"), "k").filter("xq <> xk")

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([aligned_ratio(a, b, cutoff - 1e-9) for a, b in zip(x, y)], dtype="float64")

    return texts.repartition(F.col("q"), F.col("k")).select(F.col("xq").alias("q"), F.col("xk").alias("k"), run("xk", "xq").alias("score")).filter(F.col("score") >= cutoff)


#: Strings of up to this many letters meet by what is left without up to LOST of their letters.
NEAR, LOST = 24, 2


def near_lengths(q: DataFrame, k: DataFrame, cutoff: float) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]]:
    """Pairs of lengths (of q, of k), one of them NEAR at most, that occur and can reach the cutoff: those of which neither string loses more than
    LOST letters, both being NEAR at most, and the others."""
    found = [sorted(r.n for r in df.filter(F.col("n") <= 2 * NEAR).select("n").distinct().collect()) for df in (q, k)]  # a partner is less than twice as long
    able = [(a, b) for a in found[0] for b in found[1] if min(a, b) <= NEAR and _kept(a, b, cutoff) <= min(a, b)]
    near = [(a, b) for a, b in able if max(a, b) <= NEAR and max(a, b) - _kept(a, b, cutoff) <= LOST]
    return [(a, b, max(a - _kept(a, b, cutoff), 0), max(b - _kept(a, b, cutoff), 0)) for a, b in near], sorted(set(able) - set(near))


def _kept(a: int, b: int, cutoff: float) -> int:
    """The least number of letters in common, in order, of strings of these lengths that reach the cutoff."""
    return math.ceil(cutoff * (a + b) / 2 - 1e-9)


#: Letters are counted by their codes modulo LETTERS; lengths are banded by powers of BAND; a tile has up to TILE strings of either side, of which ROWS are compared with
#: all others at once.
LETTERS, BAND, TILE, ROWS = 40, 1.07, 1 << 14, 64


def letter_counts(text: str, rare_below: int | None = None) -> np.ndarray:
    """How often the letters of each class stand in a text; with rare_below only letters that stand there no more often than that."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if rare_below is not None:
        letters, n = np.unique(codes, return_counts=True)
        return np.bincount(letters[n <= rare_below] % LETTERS, n[n <= rare_below], LETTERS).astype(np.int32)
    return np.bincount(codes % LETTERS, minlength=LETTERS).astype(np.int32)


#: Runs of this many letters are compared where letters don't rule a pair out, by counts of at most MOST_CLASSES classes.
PIECE, MOST_CLASSES = 5, 1 << 13


def piece_counts(texts: list[str], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts, up to 255, of runs of PIECE letters by classes of their hashes, and what goes beyond 255."""
    counts, over = np.zeros((len(texts), classes), np.uint8), np.zeros(len(texts), np.int64)
    shift = np.uint64(64 - classes.bit_length() + 1)
    for i, t in enumerate(texts):
        codes, n = np.frombuffer(t.encode("utf-32-le"), np.uint32).astype(np.uint64), max(len(t) - PIECE + 1, 0)
        hashed = sum((codes[j : j + n] * np.uint64(31**j) for j in range(PIECE)), np.zeros(n, np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        found = np.bincount((hashed >> shift).astype(np.int64), minlength=classes)
        counts[i], over[i] = np.minimum(found, 255), np.maximum(found - 255, 0).sum()
    return counts, over


def meet_by_letters(q: DataFrame, k: DataFrame, cutoff: float, node=None) -> DataFrame:
    """(q, k): ids of strings (x, id, n) with as many letters and short runs of letters in common, wherever they stand, as a pair that reaches the cutoff has at least. With node
    the pairs that reach it are told as links (a, b) of nodes, as many as join them in each tile (close_links).

    Every pair of like length is compared, by counts of letters: tiles of bounded size hold the strings and 160 bytes each. It is quadratic in the number of different strings of like length.
    If e letters of both are unmatched there are e + 1 common blocks at most, each with PIECE - 1 runs fewer than letters."""
    rows = [df.select("id", "n", F.floor(F.log(F.col("n").cast("double")) / math.log(BAND)).cast("int").alias("band"), "x", (node(F.col("x")) if node and side else F.col("id")).alias("node")) for side, df in enumerate((q, k))]
    parts = [{r.band: -(-r["count"] // TILE) for r in df.groupBy("band").count().collect()} for df in rows]
    reach = math.floor(math.log((2 - cutoff) / cutoff) / math.log(BAND)) + 1
    tiles = [(a, m, i, b, n, j) for a, m in parts[0].items() for b, n in parts[1].items() if abs(a - b) <= reach for i in range(m) for j in range(n)]
    plan = q.sparkSession.createDataFrame([(t, *x) for t, x in enumerate(tiles)], "tile int, bq int, mq int, iq int, bk int, mk int, ik int")

    def dealt(df: DataFrame, side: str) -> DataFrame:
        at = F.broadcast(plan.select(F.col("tile").alias(f"t{side}"), F.col(f"b{side}").alias("band"), F.col(f"m{side}").alias("m"), F.col(f"i{side}").alias("i")))
        return df.join(at, "band").filter(F.pmod("id", F.col("m")) == F.col("i")).select(f"t{side}", "id", "n", "x", "node")

    def pairs(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("n"), b.sort_values("n")
        na, nb = a.n.to_numpy(), b.n.to_numpy()
        out = [(np.zeros(0, np.int64),) * 2]
        if len(a) and len(b):
            kind = np.int16 if min(na[-1], nb[-1]) < 1 << 15 and max(na[-1], nb[-1]) < 1 << 15 else np.int32
            x, y = (np.ascontiguousarray(np.stack([letter_counts(t) for t in df.x]).T.astype(kind)) for df in (a, b))
            for i in range(0, len(a), ROWS):
                of = na[i : i + ROWS]
                lo, hi = np.searchsorted(nb, of[0] * cutoff / (2 - cutoff) - 1e-6), np.searchsorted(nb, of[-1] * (2 - cutoff) / cutoff + 1e-6, "right")
                common, one = np.zeros((len(of), hi - lo), kind), np.empty((len(of), hi - lo), kind)
                for u, v in zip(x[:, i : i + ROWS], y[:, lo:hi]):
                    common += np.minimum(u[:, None], v[None, :], out=one)
                r, c = np.nonzero(common >= cutoff / 2 * (of[:, None] + nb[None, lo:hi]) - 1e-9)
                out.append((i + r, lo + c))
        at, to = by_pieces(a.x.tolist(), b.x.tolist(), na, nb, *(np.concatenate(x) for x in zip(*out)))
        if node is None:
            return pd.DataFrame({"q": a.id.to_numpy()[at], "k": b.id.to_numpy()[to]})
        return pd.DataFrame(links(a.x.tolist(), b.x.tolist(), a.node.tolist(), b.node.tolist(), at.tolist(), to.tolist()), columns=["a", "b"], dtype="int64")

    def by_pieces(s: list[str], t: list[str], na: np.ndarray, nb: np.ndarray, at: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return at, to
        classes = min(max(1 << int(4 * max(na[at].max(), nb[to].max())).bit_length(), 256), MOST_CLASSES)
        (rows, at_), (columns, to_) = np.unique(at, return_inverse=True), np.unique(to, return_inverse=True)
        (g, over), (h, _) = piece_counts([s[i] for i in rows], classes), piece_counts([t[j] for j in columns], classes)
        step = max((1 << 24) // classes, 1)
        common = [np.minimum(g[at_[i : i + step]], h[to_[i : i + step]]).sum(1, dtype=np.int64) for i in range(0, len(at), step)]
        total = na[at] + nb[to]
        kept = np.concatenate(common) + over[at_] >= (2 * PIECE - 1) * (cutoff / 2 * total - 1e-9) - (PIECE - 1) * (total + 1)
        return at[kept], to[kept]

    def links(s: list[str], t: list[str], u: list[int], v: list[int], at: list[int], to: list[int]) -> list[tuple[int, int]]:
        parent, found = {}, []

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for i, j in zip(at, to):
            if (x := root(u[i])) != (y := root(v[j])) and aligned_ratio(t[j], s[i], cutoff - 1e-9) >= cutoff:
                parent[x] = y
                found.append((u[i], v[j]))
        return found

    return dealt(rows[0], "q").groupBy("tq").cogroup(dealt(rows[1], "k").groupBy("tk")).applyInPandas(pairs, "a long, b long" if node else "q long, k long")


def meet_near(q: DataFrame, k: DataFrame, near: list[tuple[int, int, int, int]]) -> DataFrame:
    """(q, k): ids of strings of which the same is left when the one loses as many letters as near says and so does the other."""
    without = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substring(x, i + 1, F.length(x))))
    plan = q.sparkSession.createDataFrame(near, "nq int, nk int, lq int, lk int")

    def left(df: DataFrame, side: str) -> DataFrame:
        x, lost = F.col("x"), F.col(f"l{side}")
        kept = F.when(lost == 0, F.array(x)).when(lost == 1, F.array_distinct(without(x))).otherwise(F.array_distinct(F.flatten(F.transform(F.array_distinct(without(x)), without))))
        rows = df.join(F.broadcast(plan), F.col("n") == F.col(f"n{side}"))
        return rows.select(F.col("id").alias(side), "nq", "nk", F.explode(F.transform(kept, lambda v: F.xxhash64(v))).alias("left"))

    return left(q, "q").join(left(k, "k").hint("merge"), ["nq", "nk", "left"]).select("q", "k").distinct()


def close_matches(queries: DataFrame, known: DataFrame, key: str = "key", cutoff: float = 0.92) -> DataFrame:
    """For every query key the equal known key, else the one of the highest ratio of at least cutoff; ties go to
    the larger string. Nothing that reaches the cutoff is missed (close_pairs)."""
    q, k = queries.select(F.col(key).alias("q")).distinct(), known.select(F.col(key).alias("k")).distinct()
    exact = q.join(k, q.q == k.k).select("q", F.col("k").alias("match"), F.lit(1.0).alias("score"))
    best = close_pairs(q.join(exact.select("q"), "q", "left_anti"), k, cutoff).groupBy("q").agg(F.max_by(F.struct("k", "score"), F.struct("score", "k")).alias("m")).select("q", F.col("m.k").alias("match"), F.col("m.score").alias("score"))
    return exact.unionAll(best).withColumnRenamed("q", key)


#: Ratios that a component's slots remember; what is forgotten is taken again.
REMEMBERED = 2000


#: Runs of letters that contents are compared by before they are aligned, and the bits of a slot's place behind a run's code.
RUN, PLACE = 8, np.uint64(24)
#: Runs of more of a title's slots than this, and than an eighth of all, are taken for common to all.
SPREAD_RUNS = 64


def run_codes(text: str, run: int) -> np.ndarray:
    """Sorted codes of 40 bits of the runs of letters of a text; the second of equal runs has another code than the first, and so on."""
    letters, n = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64), max(len(text) - run + 1, 0)
    prime, codes = np.uint64(0x9E3779B97F4A7C15), np.zeros(n, np.uint64)
    for i in range(run):
        codes = (codes ^ (codes >> np.uint64(29))) * prime + letters[i : i + n] + np.uint64(1)
    codes = np.sort(codes * prime)
    at = np.arange(n)
    nth = at - np.maximum.accumulate(np.where(np.concatenate([[True], codes[1:] != codes[:-1]])[:n], at, 0))
    codes = (codes + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * prime
    return np.sort((codes ^ (codes >> np.uint64(32))) * prime >> PLACE)


class Chain:
    """The contents of the slots name, name#2, name#2' and so on of one name, with an index of their runs of letters that leaves few of them to be aligned.

    Where difflib leaves out the frequent letters of a content, each of its matching blocks but one at the beginning of both texts holds a rare letter: the blocks of a
    pair have no more letters than the runs of RUN letters in common, and RUN - 1 more for each rare letter in common and for the beginning. Runs in common are
    found by sorted arrays, each at least twice as long as the next: 8 bytes a letter."""

    def __init__(self, cutoff: float, autojunk: bool):
        self.cutoff, self.autojunk, self.contents = cutoff, autojunk, []
        self.runs: list[np.ndarray] = []
        self.rare, self.told = np.zeros((8, LETTERS), np.int32), np.zeros((8, 3))

    def add(self, content: str) -> None:
        at = len(self.contents)
        if at == len(self.told):
            self.rare, self.told = (np.concatenate([x, np.zeros_like(x)]) for x in (self.rare, self.told))
        self.contents.append(content)
        if self.autojunk and len(content) >= JUNK:
            self.rare[at] = letter_counts(content, len(content) // 100 + 1)
            self.told[at] = len(content), self.rare[at].sum(), 0
            self.runs.append(run_codes(content, RUN) << PLACE | np.uint64(at))
            while len(self.runs) > 1 and 2 * len(self.runs[-1]) > len(self.runs[-2]):
                self.runs[-2:] = [np.sort(np.concatenate(self.runs[-2:]), kind="stable")]
        else:
            self.told[at] = len(content), 0, np.inf  # nothing is known of it

    def likely(self, content: str) -> Iterator[int]:
        """The places, in order, of contents that can reach the cutoff."""
        n, codes = len(self.contents), run_codes(content, RUN)
        found = [(np.searchsorted(r, codes << PLACE), np.searchsorted(r, (codes + np.uint64(1)) << PLACE)) for r in self.runs]
        times = sum((hi - lo for lo, hi in found), np.zeros(len(codes), np.int64))
        spread = times > max(SPREAD_RUNS, n // 8)
        common = np.full(n, int(spread.sum()))
        for r, (lo, hi) in zip(self.runs, found):
            size = np.where(spread, 0, hi - lo)
            places = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            common += np.bincount((r[places] & np.uint64((1 << 24) - 1)).astype(np.int64), minlength=n)
        size, rare, free = self.told[:n].T
        least = (self.cutoff - 1e-9) * (size + len(content)) / 2
        open_ = np.nonzero((np.minimum(size, len(content)) >= least) & (common + (RUN - 1) * (rare + 1) + free >= least))[0]
        seeds = np.minimum(self.rare[open_], letter_counts(content)).sum(1) + 1
        open_, seeds = (x[common[open_] + (RUN - 1) * seeds + free[open_] >= least[open_]] for x in (open_, seeds))
        short = run_codes(content, RUN - 3) if len(open_) else codes
        for at, seed in zip(open_.tolist(), seeds.tolist()):
            # shorter runs say more where rare letters are many
            if free[at] or np.isin(short, run_codes(self.contents[at], RUN - 3)).sum() + (RUN - 4) * seed >= least[at]:
                yield at


class Slots:
    """The slots of one component of titles, in the order of their opening."""

    def __init__(self, cutoff: float, content_cutoff: float, forced: frozenset[str], autojunk: bool = True):
        self.cutoff, self.content_cutoff, self.forced, self.autojunk = cutoff, content_cutoff, forced, autojunk
        self.first: dict[str, tuple[int, str]] = {}
        self.names: list[str] = []
        self.letters, self.lengths = np.zeros((8, LETTERS), np.int32), np.zeros(8, np.int64)
        self.nearest: dict[str, tuple[int, tuple[float, str]]] = {}
        self.likeness: dict[tuple[str, str], float] = {}
        self.chains: dict[str, Chain] = {}

    def closest(self, key: str) -> str:
        """The slot of the highest ratio of at least cutoff, the larger name of equals; key if there is none."""
        if key in self.first:
            return key
        seen, best = self.nearest.get(key, (0, (0.0, "")))
        # No ratio is above the share of letters in common, so names come by this share, until it falls below the best ratio.
        common = np.minimum(self.letters[seen : len(self.names)], letter_counts(key)).sum(1)
        most = 2 * common / np.maximum(self.lengths[seen : len(self.names)] + len(key), 1)
        for at in np.argsort(-most, kind="stable").tolist():
            least = max(self.cutoff, best[0]) - 1e-9
            if most[at] < least:
                break
            name = self.names[seen + at]
            score = aligned_ratio(name, key, least, self.autojunk)
            if score >= self.cutoff:
                best = max(best, (score, name))
        if len(self.nearest) >= REMEMBERED:
            self.nearest.clear()
        self.nearest[key] = (len(self.names), best)
        return best[1] or key

    def alike(self, content: str, name: str) -> bool:
        pair = (content, self.first[name][1])
        if pair not in self.likeness:
            if len(self.likeness) >= REMEMBERED:
                self.likeness.clear()
            self.likeness[pair] = 1.0 if content == pair[1] else aligned_ratio(*pair, self.content_cutoff - 1e-9, self.autojunk)
        return self.likeness[pair] >= self.content_cutoff

    def numbered(self, key: str, content: str) -> str:
        """key, if the contents are alike, else the first of key#2, key#2' and so on that is free or of a like content."""
        if key not in self.chains:
            self.chains[key] = Chain(self.content_cutoff, self.autojunk)
            self.chains[key].add(self.first[key][1])
        chain = self.chains[key]
        name = lambda at: f"{key}#2" + "'" * (at - 1) if at else key
        for at in chain.likely(content):
            if (at or content and chain.contents[0]) and self.alike(content, name(at)):
                return name(at)
        chain.add(content)
        return name(len(chain.contents) - 1)

    def place(self, order: int, key: str, content: str) -> str:
        name = self.closest(key)
        if name in self.first and name not in self.forced:
            if name == key:
                name = self.numbered(key, content)
            elif not (content and self.first[name][1] and self.alike(content, name)):
                name = key
        if name not in self.first:
            if (at := len(self.names)) == len(self.lengths):
                self.letters, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.letters, self.lengths))
            self.letters[at], self.lengths[at] = letter_counts(name), len(name)
            self.first[name] = (order, content)
            self.names.append(name)
        return name


def greedy_merge(rows: DataFrame, order: str, title: str, content: str, cutoff: float = 0.93, content_cutoff: float = 0.5, alias: dict[str, str] | None = None, forced: tuple[str, ...] = (), autojunk: bool = True) -> DataFrame:
    """(order, slot, name): online merging in the order of rows. title is a normalised key (a-z, 0-9); null counts as empty.

    A title is first replaced by its alias. It goes to the slot of the closest name of at least cutoff if both contents have a ratio of
    content_cutoff (an empty one has none), without that test if the name is one of `forced`. A title that equals the name but
    not the content goes to name#2, then name#2' and so on; one that is only close opens a slot of its own. slot is the
    order of the row that opened it. autojunk: ratios as difflib takes them by default, which leaves out the frequent letters of texts of 200 letters or more.

    Exact over the whole table: names of different components of close_pairs never meet, so components are merged in parallel.
    Rows of a component are streamed in order; only its slots and a bounded number of ratios are held.
    """
    ship_package(rows.sparkSession)
    key = F.coalesce(F.col(title), F.lit(""))
    if alias:
        key = F.coalesce(F.create_map(*[F.lit(x) for pair in alias.items() for x in pair])[key], key)
    df = rows.select(F.col(order).cast("long").alias("ord"), key.alias("key"), F.coalesce(F.col(content), F.lit("")).alias("content"))
    keys = cut_lineage(df.groupBy("key").agg((F.count("*") > 1).alias("again")))
    # A name#2 can be close to a title that is not close to the name. Marks after it stand in no title: they add nothing.
    names = keys.select(F.col("key").alias("k")).unionAll(keys.filter("again").select(F.concat("key", F.lit("#2")).alias("k")))
    edges = close_links(keys.select("key"), names, cutoff, lambda x: F.xxhash64(F.regexp_replace(x, "#2$", "")))
    component = connected_components(cut_lineage(edges), "a", "b")
    placed = df.withColumn("node", F.xxhash64("key")).join(component, "node", "left").select(F.coalesce("component", "node").alias("component"), "ord", "key", "content")
    always = frozenset(forced)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, slots = None, None
        for pdf in batches:
            out = []
            for c, o, k, text in zip(pdf.component, pdf.ord, pdf.key, pdf.content):
                if c != now:
                    now, slots = c, Slots(cutoff, content_cutoff, always, autojunk)
                name = slots.place(o, k, text)
                out.append((o, slots.first[name][0], name))
            yield pd.DataFrame(out, columns=["ord", "slot", "name"])

    ordered = placed.repartition("component").sortWithinPartitions("component", "ord", "key", "content")
    return ordered.mapInPandas(run, "ord long, slot long, name string").withColumnRenamed("ord", order)


def same_readings(pairs: DataFrame, docs: DataFrame, id: str = "doc_id", words: str = "words", chords: str = "chords", above: float = 0.9) -> DataFrame:
    """Of pairs (a, b) those that read alike: both sequences of chords agree as far as the shorter one goes, at least four, and the texts (words
    joined by blanks, letter by letter, a's first) have a ratio above `above`. Chords and lengths rule pairs out before a text moves to Python."""
    ship_package(pairs.sparkSession)
    told = docs.select(F.col(id).alias("id"), F.array_join(words, " ").alias("t"), F.col(chords).alias("c"))
    na, nb = F.col("na"), F.col("nb")
    # Chords come first and alone; only pairs that agree in them meet their texts.
    agree = with_both(pairs, told.select("id", "c", F.length("t").alias("n"))).filter(same_opening(F.col("ca"), F.col("cb"))).filter(2 * F.least(na, nb) > above * (na + nb))
    likely = with_both(cut_lineage(agree.select(pairs.columns)), told.select("id", "t"))

    @F.pandas_udf("double")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([aligned_ratio(p, q, above) for p, q in zip(x, y)], dtype="float64")

    return likely.repartition(F.col("a"), F.col("b")).withColumn("ratio", run("ta", "tb")).filter(F.col("ratio") > above).select(*pairs.columns, "ratio")


#: Lengths of openings that documents of the same reading meet by: two to a power of two.
OPENINGS = [m << k for k in range(28) for m in (4, 6)]


def meeting_openings(docs: DataFrame, above: float) -> DataFrame:
    """(node, component) of documents (id, t, c): those that may read alike are in one component.

    If the chords of one are the opening of the other's, both have the longest of OPENINGS that fits into the shorter ones, and their texts are nearly as long
    as each other. A key is such an opening and a band of lengths; it counts if a document has it as its own longest one. No key drops or pairs its documents: they
    are tied to the first of them."""
    band = F.floor(F.log(F.length("t").cast("double")) / math.log((2 - above) / above)).cast("int")
    bits = F.bin(F.size("c"))
    told = docs.select("id", "c", band.alias("band"), bits.alias("bits"))
    told = told.select("id", "c", "band", (2 * F.length("bits") - 5 + F.substring("bits", 2, 1).cast("int")).alias("many"))
    own, able = F.get(F.array(*map(F.lit, OPENINGS)), F.col("many") - 1), F.slice(F.array(*map(F.lit, OPENINGS)), F.lit(1), F.col("many"))
    # Most documents are far longer than those of which they'd have the opening: these lengths go before anything is hashed.
    beside = F.explode(F.array(*(F.col("band") + k for k in (-1, 0, 1))))
    used = cut_lineage(told.select(own.alias("opening"), beside.alias("band")).distinct())
    reach = told.select("id", "c", "band", own.alias("own"), F.explode(able).alias("opening")).join(F.broadcast(used), ["opening", "band"])
    hashed = reach.select("id", "opening", "band", "own", F.xxhash64(F.slice("c", F.lit(1), F.col("opening"))).alias("h"))
    keys = cut_lineage(hashed.select("id", "opening", "h", ((F.col("own") == F.col("opening")).alias("owned")), F.col("band").alias("of"), beside.alias("band")).select("id", F.xxhash64("opening", "band", "h").alias("key"), (F.col("owned") & (F.col("of") == F.col("band"))).alias("owned")))
    met = keys.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.max("owned").alias("counts")).filter("counts and first < last").select("key", "first")
    return connected_components(cut_lineage(keys.join(met, "key").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()), "a", "b")


class Readings:
    """The documents of one component that stay so far, in the order of their ids."""

    def __init__(self, above: float, n: int, shared: int):
        self.above, self.n, self.shared = above, n, shared
        self.staying: dict[int, tuple] = {}
        self.copies: dict[bytes, int] = {}
        self.known: dict[tuple[int, bytes], bool] = {}

    def grams(self, text: str) -> set:
        w = text.split()
        return set(zip(*(w[i:] for i in range(self.n))))

    def alike(self, x: tuple, y: tuple) -> bool:
        (t, c), (u, d) = x[1:3], y[1:3]
        if 2 * min(len(t), len(u)) <= self.above * (len(t) + len(u)) or not (c.startswith(d) or d.startswith(c)):
            return False
        p, q = Counter(t.split()), Counter(u.split())
        if (p & q).total() * 10 <= min(p.total(), q.total()) * 8 or len(self.grams(t) & self.grams(u)) < self.shared:
            return False
        return aligned_ratio(t, u, self.above) > self.above

    def place(self, id: int, source, text: str, chords: str) -> list[tuple[int, int]]:
        """(dropped, kept) by pairs of this document and those that came before."""
        digest = hashlib.blake2b(f"{len(text)} {text}{chords}".encode(), digest_size=16).digest()
        new, gone = (source, text, chords, digest), []
        # Who stays beside a copy of this document isn't like the copy, nor like this one, if it came before the copy.
        copy = self.copies.get(digest)
        if copy is None and len(self.grams(text)) < self.shared:
            return []
        for at, old in [(copy, self.staying[copy])] if copy is not None else []:
            if not _ahead(new, old):
                return [(id, at)]
            gone.append((at, id))
            self.leave(at)
        for at, old in list(self.staying.items()):
            if copy is not None and at < copy:
                continue
            if (at, digest) not in self.known:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                self.known[at, digest] = self.alike(old, new)
            if self.known[at, digest]:
                if not _ahead(new, old):
                    return [*gone, (id, at)]
                gone.append((at, id))
                self.leave(at)
        self.staying[id], self.copies[digest] = new, id
        return gone

    def leave(self, id: int) -> None:
        del self.copies[self.staying.pop(id)[3]]


def _ahead(new: tuple, old: tuple) -> bool:
    return new[0] is not None and old[0] is not None and new[0] < old[0]


def merge_readings(docs: DataFrame, id: str = "doc_id", words: str = "words", chords: str = "chords", source: str = "source", above: float = 0.9, n: int = GRAM, shared: int = SHARED) -> DataFrame:
    """(dropped, kept) by the pairs a < b of documents that share at least `shared` n-grams of words, however many documents have these, hold more than
    0.8 of the shorter one's words in common, and read alike (same_readings). In the order of a, then b: the document of the lesser source stays, else a, and the other one
    goes, unless either is gone already; what was kept may go later.

    Exact over the whole table, with no limit to the documents of an n-gram: those of the same reading meet by the openings of their chords, which the rule asks for anyway.
    Components of such documents run in parallel; rows of one are streamed in order of ids: pairs that share a document come in the same order then. Only documents that stay are held and
    aligned with the next ones, so a group of copies or near copies costs a few comparisons a document instead of one a pair. Chords must not hold line breaks."""
    ship_package(docs.sparkSession)
    # A generator's rows are worked out once, however often their columns are named after it.
    once = F.inline(F.array(F.struct(F.col(words).alias("w"), F.col(chords).alias("c"))))
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(source).alias("source"), once).filter(F.col("id").isNotNull() & (F.size("c") >= 4) & (F.size("w") >= n + shared - 1))
    told = rows.select("id", "source", F.array_join("w", " ").alias("t"), "c")
    component = cut_lineage(meeting_openings(told, above).withColumnRenamed("node", "id"))
    few = component.limit(PICKED + 1).count() <= PICKED
    placed = told.select("id", "source", "t", F.concat(F.array_join("c", "\n", ""), F.lit("\n")).alias("c")).join(F.broadcast(component) if few else component, "id")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, readings = None, None
        for pdf in batches:
            out = []
            for c, i, s, t, chord in zip(pdf.component, pdf.id, pdf.source, pdf.t, pdf.c):
                if c != now:
                    now, readings = c, Readings(above, n, shared)
                out += readings.place(i, s, t, chord)
            yield pd.DataFrame(out, columns=["dropped", "kept"], dtype="int64")

    return placed.repartition("component").sortWithinPartitions("component", "id").mapInPandas(run, "dropped long, kept long")


def fold_pairs(pairs: DataFrame, group: str, order: list[str], keep: str, drop: str) -> DataFrame:
    """In order within each group, `drop` goes and `keep` stays, unless either is gone already; what was kept may go later.

    Returns (dropped, kept). Pairs of different groups (components) don't touch, so groups are folded in parallel.
    """
    ship_package(pairs.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        gone: dict = {}
        for r in pdf.sort_values(order).itertuples():
            k, d = getattr(r, keep), getattr(r, drop)
            if k not in gone and d not in gone:
                gone[d] = k
        return pd.DataFrame({"dropped": list(gone), "kept": list(gone.values())}, dtype="int64")

    return pairs.groupBy(group).applyInPandas(run, "dropped long, kept long")


def best_shift(a: list[str], b: list[str]) -> tuple[float, int]:
    """the best ratio of b with the chords of a moved by 0 to 11 steps, and these steps; the fewest of equals, 0 if nothing is alike.
    Chords of a are written with sharps, without bass; what is no chord must not be among them (chord_list)."""
    best, moved = (0.0, 0), [re.match("([A-G][#b]?)([^/]*)", c).groups() for c in a]
    pitches = pitch.pitches()
    for steps in range(12):
        score = ratio([pitch.SHARPS[(pitches[r] + steps) % 12] + q for r, q in moved], b)
        if score > best[0]:
            best = (score, steps)
    return best


def best_shifts(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """F33 over a table: adds score and shift."""
    ship_package(pairs.sparkSession)
    schema = StructType([*pairs.schema.fields, StructField("score", DoubleType()), StructField("shift", IntegerType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [best_shift(list(x), list(y)) for x, y in zip(pdf[a], pdf[b])]
            yield pdf.assign(score=[s for s, _ in found], shift=[k for _, k in found])

    return pairs.mapInPandas(run, schema)


def same_opening(a, b, least: int = 4):
    """Arrays that agree as far as the shorter goes, which must be at least `least` long."""
    n = F.least(F.size(a), F.size(b))
    return (n >= least) & (F.slice(a, F.lit(1), F.greatest(n, F.lit(1))) == F.slice(b, F.lit(1), F.greatest(n, F.lit(1))))


def window_first(column: str, partition: list[str], order: list[str]):
    return F.first(column, ignorenulls=True).over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
