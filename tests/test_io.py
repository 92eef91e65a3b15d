"""Sources, sinks and incremental passes."""

from pyspark.sql import functions as F

from corpusforge.sources import readers, writers
from corpusforge.streaming import incremental

BOOK = """intro
## Part
### Sub
#### One
**Artist** · Sursa: Book, p. 3

```text
# not a header
la la
```
note
#### Two
```tab
e--
```
## Next
"""


def test_book(spark, tmp_path):
    (tmp_path / "a.md").write_text(BOOK)
    songs = {r.title: r for r in readers.markdown_songs(readers.markdown_lines(spark, str(tmp_path))).collect()}
    assert set(songs) == {"One", "Two"}
    assert (songs["One"].part, songs["One"].sub, songs["One"].artist) == ("Part", "Sub", "Artist") and songs["Two"].artist is None
    assert [(b.kind, b.line) for b in songs["One"].body if b.line.strip()] == [("note", "**Artist** · Sursa: Book, p. 3"), ("text", "# not a header"), ("text", "la la"), ("note", "note")]
    out = writers.item_markdown(readers.markdown_songs(readers.markdown_lines(spark, str(tmp_path)))).filter("title = 'Two'").first().markdown
    assert out == "#### Two\n```tab\ne--\n```\n"


def test_catalogue_and_selection(spark):
    rows = spark.createDataFrame([("d", i, x) for i, x in enumerate(["## A", "- [t](u)", "- [s](v)", "other"])], "doc string, ord int, line string")
    links = readers.link_catalogue(rows)
    assert writers.catalogue(links, "artist", "title", "href").first().markdown == "## A (2)\n- [s](v)\n- [t](u)"
    picks = spark.createDataFrame([(0, "# x"), (1, "- Song | Am")], "ord int, line string")
    assert [tuple(r) for r in readers.selection(picks).collect()] == [(1, "Song", "Am")]


def test_book_order(spark, tmp_path):
    df = spark.createDataFrame([(i, f"line {i:03}") for i in range(50)], "k long, markdown string")
    writers.book(df.orderBy(F.rand(1)), ["k"], str(tmp_path / "book"))
    parts = sorted((tmp_path / "book").glob("part-*"))
    assert "".join(p.read_text() for p in parts).split("\n")[:-1] == [f"line {i:03}" for i in range(50)]


def test_insert_lines_twice(spark):
    rows = spark.createDataFrame([("d", 0, "title"), ("d", 1, "chords: old"), ("d", 2, "body")], "doc string, ord int, line string")
    fresh = spark.createDataFrame([("d", 0, "chords: new")], "doc string, after int, line string")
    once = writers.insert_lines(rows, fresh, "doc", "ord", "^chords:")
    twice = writers.insert_lines(once, fresh, "doc", "ord", "^chords:")
    expected = [(0, "title"), (1, "chords: new"), (2, "body")]
    assert [(r.ord, r.line) for r in once.orderBy("ord").collect()] == expected == [(r.ord, r.line) for r in twice.orderBy("ord").collect()]


def test_incremental(spark, tmp_path):
    compute = lambda df: df.select("key", (F.col("v") * 2).alias("r"))
    for k in range(2):
        spark.createDataFrame([("a", 1), ("b", 2 + k)], "key string, v long").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("key string, v long").parquet(str(tmp_path / "in"))
        incremental.incremental(stream, "key", compute, str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "store")).collect()) == [("a", 2), ("b", 4)]


def test_word_forms(spark, tmp_path):
    (tmp_path / "w.txt").write_text("été/AB\nété\nmaison\n")
    needed = spark.createDataFrame([("ete",)], "k string")
    assert {r.word for r in readers.word_forms(spark, str(tmp_path / "w.txt"), needed).collect()} == {"été"}
