"""Folds over lines against plain versions on random lines; column edges, reading order, sizes."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import components, folds, geometry, songs

CHORDS = ["C", "Am", "F#m7", "G/B", "Dsus4", "E7", "|", "N.C."]


def chord_line(line):
    words = [w for w in line.split() if not re.search(songs.BETWEEN, w)]
    return bool(words) and all(re.search(songs.CHORD, w) for w in words)


def lists(spark, cases):
    return spark.createDataFrame(list(enumerate(cases)), "k long, x array<string>")


def by_case(df):
    return [r.y for r in df.orderBy("k").collect()]


# -- W17
def plain_join(rows, most, closed):
    out = []
    for row in rows:
        s = row.strip(" ")
        last = out[-1].rstrip(" ") if out else ""
        if s and last and s[0].islower() and len(s.split()) <= most and last[-1] not in closed and not chord_line(last):
            out[-1] = last + s if last[-1] == "-" else f"{last} {s}"
        else:
            out.append(row)
    return out


def test_join_wraps(spark):
    rng = random.Random(1)
    words = ["la", "Hai", "noap-", "tea,", "sus.", "élan", "C", "Am", "x"]
    cases = [[" " * rng.randint(0, 2) + " ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(rng.randint(0, 9))] for _ in range(300)] + [["a"] * 700]
    found = by_case(lists(spark, cases).select("k", folds.join_wraps(F.col("x"), grammar=songs.CHORD, between=songs.BETWEEN).alias("y")))
    assert found == [plain_join(c, 3, ".,!?:;") for c in cases]
    assert by_case(lists(spark, [["a,", "b"], None]).select("k", folds.join_wraps(F.col("x"), closed="").alias("y"))) == [["a, b"], []]


# -- W18
def plain_spans(rows):
    out, block, taken = [], 0, 0
    for i, row in enumerate(rows):
        if not row.strip(" "):
            block = taken = i + 1
            continue
        closer = re.search(r"/\s*[xX](\d+)\s*$", row)
        if closer:
            seen = [row[: closer.start()], *reversed(rows[max(block, taken) : i])]
            hidden = ["/" in re.sub(r"\[[^\]]*\]", "", x) for x in seen]
            out.append((i - hidden.index(True) if True in hidden else None, i, int(closer[1])))
            taken = i + 1
    return out


def test_repeat_spans(spark):
    rng = random.Random(2)
    bits = ["/", "la", "[G/4]", "[G", "x2", "/ x3", "/x12 ", "", "a/b"]
    cases = [[" ".join(rng.choices(bits, k=rng.randint(0, 4))) for _ in range(rng.randint(0, 10))] for _ in range(400)]
    found = by_case(lists(spark, cases).select("k", folds.repeat_spans(F.col("x")).alias("y")))
    assert [[tuple(s) for s in f] for f in found] == [plain_spans(c) for c in cases]


def test_bars(spark):
    cases = [["/ one", "two [G/4]", "three / x3"], ["a / b / X2"], ["none / x2"[5:], "", "/ x2"], []]
    assert by_case(lists(spark, cases).select("k", folds.bar_repeats(F.col("x")).alias("y"))) == [["||: one", "two [G/4]", "three :|| ×3"], ["a ||: b :||"], ["/ x2", "", "/ x2"], []]
    long = "x" * 60_000
    assert by_case(lists(spark, [["/ " + long, long + " / x4"]]).select("k", folds.bar_repeats(F.col("x")).alias("y"))) == [["||: " + long, long + " :|| ×4"]]


# -- F27
def plain_cuts(line, width):
    """(piece, origin, break) by looking at every blank of what is left."""
    out, origin = [], 0
    while True:
        rest = line[origin:] if not out else "  " + line[origin + 2 :]
        blanks = [k for k in range(1, len(rest)) if rest[k] == " "]
        fit = [k for k in blanks if k <= width]
        if fit and rest[: fit[-1]].strip(" "):
            cut = fit[-1]
        else:
            cut = next((k for k in blanks if k > (fit[-1] if fit else 0)), None)
        if len(rest) <= width or cut is None:
            return [*out, (rest, origin, None)]
        tail = len(rest) - len(rest[cut:].lstrip(" "))  # where the next piece's text begins
        if tail <= 2:
            return [*out, (rest, origin, None)]
        out.append((rest[:cut].rstrip(" "), origin, origin + cut))
        origin += tail - 2


def plain_place(pairs):
    line = ""
    for col, label in pairs:
        line = line.ljust(max(col, len(line) + (line != ""))) + label
    return line


def plain_pair(symbols, lyric, width):
    marks, out, since = [(m.start(), m[0]) for m in re.finditer("[^ ]+", symbols)], [], -1
    for k, (text, origin, cut) in enumerate(plain_cuts(lyric, width)):
        mine = [(max(c - origin, 2) if k else c, x) for c, x in marks if c >= since and (cut is None or c < cut)]
        out += [plain_place(mine)] * bool(mine) + [text]
        since = cut
    return out


def plain_symbols(line, width):
    out, row = [], []
    for m in re.finditer("[^ ]+", line):
        grown = [*row, (max(m.start(), 2) if out else m.start(), m[0])]
        if row and len(plain_place(grown)) > width:
            out.append(plain_place(row))
            grown = [(2, m[0])]
        row = grown
    return [*out, plain_place(row)]


def plain_wrap(rows, width):
    out, k = [], 0
    while k < len(rows):
        row, below = rows[k], rows[k + 1] if k + 1 < len(rows) else ""
        if chord_line(row) and below.strip(" ") and not chord_line(below):
            out += [row, below] if max(len(row), len(below)) <= width else plain_pair(row, below, width)
            k += 1
        elif not row.strip(" "):
            out.append("")
        elif len(row) <= width:
            out.append(row)
        else:
            out += plain_symbols(row, width) if chord_line(row) else [x for x, _, _ in plain_cuts(row.rstrip(" "), width)]
        k += 1
    return out


@pytest.mark.parametrize("width", [4, 11, 30])
def test_wrap(spark, width):
    rng = random.Random(width)
    line = lambda words, most: " " * rng.choice([0, 0, 1, 3, 40]) + (" " * rng.choice([1, 1, 2, 7])).join(rng.choices(words, k=rng.randint(0, most)))
    cases = [[(line(CHORDS, 8) if rng.random() < 0.4 else line(["a", "la", "lorem", "y" * 15, "C"], 12)).rstrip(" ") for _ in range(rng.randint(0, 7))] for _ in range(250)]
    found = by_case(lists(spark, cases).select("k", folds.wrap_lines(F.col("x"), width, songs.CHORD, songs.BETWEEN).alias("y")))
    assert found == [plain_wrap(c, width) for c in cases]


def test_wrap_passes_and_keeps_words(spark):
    rows = ["e|--0--2--|" * 9, "a " * 4000]
    wrapped = by_case(lists(spark, [rows]).select("k", folds.wrap_lines(F.col("x"), 20, songs.CHORD, untouched=r"^e\|").alias("y")))[0]
    assert wrapped[0] == rows[0] and all(len(x) <= 20 for x in wrapped[1:]) and "".join(wrapped[1:]).replace(" ", "") == "a" * 4000


# -- W16
def test_align_rows(spark):
    text = ["   C    G", "1. La multi ani", "", "  Am", "    D", "  R : hai", "E", "E", "  noroc", "2.5 lei", "12.", "   F#m7  G"]
    df = spark.createDataFrame([("d", i, x) for i, x in enumerate(text)] + [("e", 0, "  [C]la"), ("e", 1, "  C")], "doc string, ord int, line string")
    once = songs.align_rows(df, ["doc"], "ord")
    rows = lambda x, d: [r.line for r in x.filter(F.col("doc") == d).orderBy("ord").collect()]
    assert rows(once, "d") == ["1.", "C    G", "La multi ani", "", "R:", "Am", "D", "hai", "E", "E", "noroc", "2.5 lei", "12.", "F#m7  G"]
    assert rows(once, "e") == ["  [C]la", "  C"]
    assert rows(songs.align_rows(once, ["doc"], "ord"), "d") == rows(once, "d")


# -- A5, W8
def test_column_edges(spark):
    def edges(values, **kw):
        found = geometry.column_edges(spark.createDataFrame([("p", i, float(x)) for i, x in enumerate(values)], "p string, i long, x double"), ["p"], "x", ["i"], **kw).collect()
        return found[0].edges if found else []

    assert edges([300.0] * 6 + [301.5, 285.0] + [40.0] * 9) == [285.0]  # moved to the leftmost start within 20
    assert edges([200.0] * 5 + [400.0] * 7 + [430.0] * 6) == [200.0, 400.0]  # 430 is too near a fuller one
    assert edges([200.0] * 4) == []
    assert edges([200.0] * 5 + [300.0, 302.0, 304.0] * 2, least=4) == [200.0, 300.0]  # neighbours count along
    assert edges([200.0, 400.0] * 3, least=3, distance=1000.0) == [200.0]  # equals: the first seen


def test_reading_order_columns_between_full_lines(spark):
    data = [("d", 1, 0.0, 500.0, 0.0, "top"), ("d", 1, 0.0, 140.0, 10.0, "l1"), ("d", 1, 300.0, 450.0, 10.0, "r1"), ("d", 1, 0.0, 140.0, 40.0, "l2"), ("d", 1, 300.0, 450.0, 40.0, "r2"), ("d", 1, 0.0, 90.0, 50.0, "C G"), ("d", 1, 0.0, 500.0, 60.0, "end"), ("x", 1, 0.0, 1.0, 9.0, "b"), ("x", 1, 0.0, 1.0, 3.0, "a")]
    df = spark.createDataFrame(data, "doc string, page int, x0 double, x1 double, y double, text string")
    edges = spark.createDataFrame([("d", 1, [300.0])], "doc string, page int, edges array<double>")
    found = geometry.reading_order(df, edges, ["doc", "page"], F.col("text") == "C G").orderBy("doc", "ord").collect()
    assert [r.text for r in found] == ["top", "l1", "l2", "r1", "r2", "C G", "end", "a", "b"]
    assert [r.column for r in found] == [None, 0, 0, 1, 1, None, None, None, None]


# -- F52, T14
def test_largest_fitting(spark):
    found = spark.createDataFrame([(3.0,), (99.0,), (-1.0,)], "most double").select(folds.largest_fitting(F.lit(0.0), F.lit(10.0), lambda x: x <= F.col("most")).alias("y")).collect()
    assert [round(r.y, 5) for r in found] == [3.0, 10.0, 0.0]


def test_shrink_measures_offenders_only(spark):
    seen = []

    def measure(items):
        seen.append(sorted(r.id for r in items.collect()))
        return items.withColumn("bad", F.col("size") > F.col("most"))

    items = spark.createDataFrame([(1, 10.0, 10.0), (2, 10.0, 9.0), (3, 10.0, 8.5), (4, 10.0, 1.0)], "id long, size double, most double")
    done = {r.id: (round(r.size, 4), r.passes, r.bad) for r in components.shrink_to_fit(items, measure).collect()}
    assert done == {1: (10.0, 1, False), 2: (8.649, 3, False), 3: (8.0436, 4, False), 4: (round(10 * 0.93**5, 4), 6, True)}
    assert seen == [[1, 2, 3, 4], [2, 3, 4], [2, 3, 4], [3, 4], [4], [4]]
