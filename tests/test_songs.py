"""Composite steps on items with symbol lines."""

import pytest
from pyspark.sql import functions as F

from corpusforge.operators import songs


def lined(spark, text):
    return spark.createDataFrame([("d", i, x) for i, x in enumerate(text.split("\n"))], "doc string, ord int, line string")


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_row_kinds(spark):
    text = lined(spark, "C  Am\nla la\n\nG D\ne|--0--2--|\nB|--------|\nend\n[C]la ^lo [x]\nnote").withColumn("fence", F.when(F.col("ord").isin(4, 5), "tab").when(F.col("ord") == 8, "prose"))
    df = songs.row_kinds(text, "doc", "ord", "fence")
    assert [r.kind for r in df.orderBy("ord").collect()] == ["pair", "paired", "blank", "interlude", "tab", "tab", "plain", "inline", "prose"]
    assert [(r["first"], r["last"]) for r in songs.runs_of(df, "doc", "ord").collect()] == [(4, 5)]


def test_inline(spark):
    assert [(t.col, t.label) for t in value(spark, songs.inline_tokens(F.lit("[Am]wo[C]rd [G]")))] == [(0, "Am"), (2, "C"), (5, "G")]
    assert [(t.col, t.label) for t in value(spark, songs.inline_tokens(F.lit("a [x] ^b[(G)][No Chord][Riff][riff 2 + x][solo]")))] == [(6, "/"), (7, "(G)"), (7, "N.C."), (7, "riff"), (7, "riff 2 + x"), (7, "solo")]
    assert value(spark, songs.without_inline(F.lit("a [x] ^b[(G)][NC]"))) == "a [x] b" and value(spark, songs.inline_tokens(F.lit(""))) == []
    assert value(spark, songs.transpose_inline(F.lit("a [Am]b [C/G] [Solo]"), F.lit(2), F.lit(False))) == "a [Bm]b [D/A] [Solo]"
    assert songs.edit_keeping_labels("f[C]oo [D]bar", str.upper) == "F[C]OO [D]BAR"
    with pytest.raises(ValueError):
        songs.edit_keeping_labels("foo", lambda x: x + "!")


def test_transpose_items(spark):
    rows = spark.createDataFrame([(1, 0, "x"), (1, 1, "[C]a [F]b"), (2, 0, "[G]c"), (3, 0, "none")], "id long, ord int, line string")
    items = spark.createDataFrame([(1, "D"), (2, "Bb"), (3, "C")], "id long, key string")
    assert {(r.id, r.ord): r.line for r in songs.transpose_items(items, rows, "id", "ord", "key").collect()} == {(1, 0): "x", (1, 1): "[D]a [G]b", (2, 0): "[Bb]c", (3, 0): "none"}


def test_titles_marks_and_chords(spark):
    df = spark.createDataFrame([("d", 0, 10.0, "A"), ("d", 1, 25.0, "B"), ("d", 2, 60.0, "C")], "doc string, ord int, y double, text string")
    assert sorted(r.text for r in songs.merge_titles(df, "doc", "ord", "y", "text").collect()) == ["A B", "C"]
    assert value(spark, songs.compose_marks(F.lit("¸s t¸"), {("¸", "s"): "ș", ("¸", "t"): "ț"})) == "ș ț"
    assert tuple(value(spark, songs.hoist_marker(F.lit("[Refren] la")))) == ("[Refren]", "la")


def test_case_propagates(spark):
    df = spark.createDataFrame([("d", i, c) for i, c in enumerate("A?b? ?")], "doc string, seq int, c string")
    out = songs.propagate_case(df, ["doc"], ["seq"], F.col("c") == "?", F.lit("ș"))
    assert "".join(r.c for r in out.orderBy("seq").collect()) == "AȘbș ș"


def test_best_links_and_regroup(spark):
    tabs = spark.createDataFrame([("The A", "Étude", "u1", 1, 5, None, None), ("The A", "Etude", "u2", 2, 1, 4.0, 3), ("Bee", "x", "u3", 3, None, None, None)], "artist string, title string, href string, id long, favourites int, rating double, ratings int")
    index = spark.createDataFrame([("the a", "The A"), ("zed", "Zed")], "key string, artist string")
    aliases = spark.createDataFrame([("bee", "zed")], "alias string, target string")
    assert [(r.key, r.href, r.title, r.side, r.place) for r in songs.best_links(tabs, index, aliases).orderBy("place").collect()] == [("the a", "u2", "Étude", "both", 1), ("zed", "u3", "x", "both", 2)]
    items = spark.createDataFrame([(1, "b"), (2, "A"), (3, "c")], "k long, title string")
    sections = spark.createDataFrame([(1, "I", "1"), (2, "I", "1"), (3, "I", "0")], "k long, part string, sub string")
    assert [(r.k, r.number) for r in songs.regroup(items, sections, "k").orderBy("number").collect()] == [(3, 1), (2, 2), (1, 3)]
    with pytest.raises(Exception, match="no section for 3"):
        songs.regroup(items, sections.filter("k < 3"), "k").collect()
