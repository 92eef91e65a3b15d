"""Curated corrections, sections replaced, layouts, numbering within groups, statistics, and the aligner's default mode."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import curation, indexing, linkage


def tables(spark, merges=(), variants=(), titles=(), notes=()):
    return (
        spark.createDataFrame(list(merges), "kept long, dropped long, meta string"), spark.createDataFrame(list(variants), "first long, second long, meta string"),
        spark.createDataFrame(list(titles), "num long, title string"), spark.createDataFrame(list(notes), "num long, note string"),
    )


def test_precedence_of_rules(spark):
    items = spark.createDataFrame([(1, "Dor", "**Ana** · p. 1", "x"), (2, "Zi", None, "x"), (3, "Dor de (II)", "**Bob** · p. 3", "x"), (4, "Cer", "p. 4", "x"), (5, "Zi (III)", "p. 5", "x"), (6, "Nor", "p. 6", "x")], "num long, title string, meta string, _first string")
    rules = tables(spark, merges=[(1, 6, "merged")], variants=[(1, 3, None), (2, 5, "given")], titles=[(1, "ignored"), (4, "Cerul")], notes=[(1, "noted"), (4, "see 3")])
    found = curation.corrected(items.drop("_first"), *rules).orderBy("place").collect()
    assert [(r.num, r.title, r.meta) for r in found] == [
        (1, "Dor (I)", "noted · **Ana** · p. 1"), (3, "Dor (II)", "**Bob** · variant of „Dor”, titled „Dor de” · p. 3"), (2, "Zi (I)", ""), (5, "Zi (II)", "given"), (4, "Cerul", "see 3 · p. 4"),
    ]
    with pytest.raises(ValueError, match="aren't there"):
        curation.corrected(items, *tables(spark, titles=[(9, "x")]))
    with pytest.raises(ValueError, match="several rules"):
        curation.corrected(items, *tables(spark, notes=[(1, "x"), (1, "y")]))
    assert curation.corrected(items.limit(0), *tables(spark)).count() == 0


def test_sections(spark):
    book = spark.createDataFrame([(10 * i, x) for i, x in enumerate(["intro", "## A", "old", "old", "## B", "stays", "## A end", "---"])], "ord long, line string")
    sections = spark.createDataFrame([("## A", "## B")], "header string, until string")
    fresh = spark.createDataFrame([("## A", 2, "two"), ("## A", 1, "one")], "header string, nth int, line string")
    once = curation.replace_sections(book, "ord", sections, fresh)
    lines = lambda df: [r.line for r in df.orderBy("place").collect()]
    assert lines(once) == ["intro", "## A", "one", "two", "## B", "stays", "## A end", "---"]
    assert lines(curation.replace_sections(once.withColumnRenamed("place", "ord"), "ord", sections, fresh)) == lines(once)
    for wrong in (("## X", "## B"), ("## B", "## A")):
        with pytest.raises(ValueError, match="exactly once"):
            curation.replace_sections(book, "ord", spark.createDataFrame([wrong], "header string, until string"), fresh)


def test_layout(spark):
    items = spark.createDataFrame([(1, "Zi", "Bo", ["z"], "I", "a"), (2, "Étude", "Bo", ["e", "f"], "I", "a"), (3, "zi", None, [], "II", "c")], "item long, title string, artist string, body array<string>, part string, section string")
    layout = spark.createDataFrame([("I", "a", 1, 1), ("I", "b", 1, 2), ("II", "c", 2, 1)], "part string, section string, part_at int, section_at int")
    lines = [r.line for r in curation.relaid(items, layout).orderBy("place").collect()]
    assert lines == [
        "## Contents", "**I** (2 items)", "- a (2 items)", "- b (0 items)", "**II** (1 items)", "- c (1 items)", "### I — a", "- [Étude](#étude)", "- [Zi](#zi)", "### I — b", "### II — c", "- [zi](#zi-1)",
        "## I", "### a", "#### Étude", "e", "f", "#### Zi", "z", "### b", "## II", "### c", "#### zi", "## Index", "**Bo**", "- [Étude](#étude)", "- [Zi](#zi)",
    ]
    with pytest.raises(ValueError, match="lacks"):
        curation.relaid(items, layout.filter("section <> 'c'"))


def test_numbers_within_a_hot_group(spark):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "hot", "a", None]), i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, o long").repartition(3)
    seen: dict = {}
    want = {}
    for g, o in data:
        want[o] = seen[g] = seen.get(g, 0) + 1
    assert {r.o: r.nth for r in indexing.number_within(df, ["g"], ["o"]).collect()} == want


def test_observation(spark):
    df, seen = curation.observed(spark.range(10), F.count("*").alias("n"), F.sum("id").alias("s"))
    assert df.filter("id > 3").count() == 6 and seen.get == {"n": 10, "s": 45}


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz ", "aaaaaaaaaab"])
def test_ratio_with_autojunk_is_difflibs_default(letters):
    rng = random.Random(len(letters))
    for n in (0, 30, 199, 200, 260, 900):
        a = "".join(rng.choice(letters) for _ in range(n))
        for b in (a, "x" + a, a[: n // 2] + "q" + a[n // 2 :], "".join(rng.choice(letters) for _ in range(n))):
            exact = SequenceMatcher(None, a, b).ratio()
            assert linkage.aligned_ratio(a, b, autojunk=True) == exact
            found = linkage.aligned_ratio(a, b, 0.5, True)
            assert found == exact if exact > 0.5 else found <= 0.5
    assert linkage.aligned_ratio("ab" * 200, "x" + "ab" * 200, autojunk=True) < 0.5 < linkage.aligned_ratio("ab" * 200, "x" + "ab" * 200)


def test_same_readings(spark):
    docs = spark.createDataFrame([(1, ["la", "mul", "ti", "ani"] * 5, list("CGCGA")), (2, ["la", "mul", "ti", "ani"] * 5 + ["x"], list("CGCG")), (3, ["la", "mul", "ti", "ani"] * 5, list("CGCF")), (4, ["alt"] * 9, list("CGCGA")), (5, ["la"], [])], "doc_id long, words array<string>, chords array<string>")
    pairs = spark.createDataFrame([(a, b) for a in range(1, 6) for b in range(a + 1, 6)], "a long, b long")
    assert [(r.a, r.b) for r in linkage.same_readings(pairs, docs).collect()] == [(1, 2)]


def test_contents_of_several_documents(spark):
    from corpusforge.operators import songs

    rows = [(d, i, x) for d, t in (("a", " 1. Dor (Ana) ..... 7\nPARTEA A II-A\nCantor\n12\n 2. Cer ........ 9"), ("b", " 1. Zi ..... 7\n 2. Zi de zi, ..... 7")) for i, x in enumerate(t.split("\n"))]
    found = songs.contents(spark.createDataFrame(rows, "doc string, ord int, line string")).orderBy("doc", "page").collect()
    assert [tuple(r) for r in found] == [("a", 7, "Dor", "Ana", 1), ("a", 9, "Cer", "Cantor", 2), ("b", 7, "Zi de zi", None, 1)]
