"""Books typeset from the benchmark's passages as tables of glyphs and read back; the oracles know the passages and never see a glyph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.functions import text as T
from corpusforge.operators import books, songs
from corpusforge.sources import readers, writers

_W = "list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')"
#: Passages of one book; books are read side by side.
BOOK = 10


def _rows_sql(words: str, n: int) -> str:
    return f"list_transform(range(0, (len({words}) + {n - 1}) // {n}), lambda k: array_to_string({words}[k * {n} + 1:k * {n} + {n}], ' '))"


def passages(spark, sf_dir: str) -> DataFrame:
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.concat(F.lit("b"), F.floor(F.col("item_id") / BOOK).cast("string")).alias("doc"), (F.col("item_id") % BOOK + 1).cast("int").alias("page"), words.alias("w"))


def in_rows(words, n: int):
    """Rows of n words."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.size(words) + n - 1) / n).cast("int") - 1, F.lit(0))), lambda k: F.array_join(F.slice(words, k * n + 1, n), " "))


def line(y, x, text, size=10.0, font="f"):
    lit = lambda v: v if not isinstance(v, (int, float, str)) else F.lit(float(v) if isinstance(v, int) else v)
    return F.struct(lit(y).cast("double").alias("y"), lit(x).cast("double").alias("x"), text.alias("text"), lit(size).alias("size"), lit(font).alias("font"))


def glyphs(pages: DataFrame, lines) -> DataFrame:
    """Glyphs five points wide of every page's array of lines."""
    rows = pages.select("doc", "page", F.posexplode(lines).alias("row", "l"))
    chars = rows.select("doc", "page", "row", "l", F.posexplode(F.filter(F.split("l.text", ""), lambda c: c != "")).alias("i", "c"))
    x = F.col("l.x") + F.col("i") * 5.0
    return chars.select("doc", "page", (F.col("row") * 1000 + F.col("i")).cast("int").alias("seq"), "c", x.alias("x0"), (x + 5.0).alias("x1"), F.col("l.y").alias("ymid"), F.col("l.size").alias("size"), F.col("l.font").alias("font"))


def placed(rows, top: float, x: float, step: float = 12.0):
    return F.transform(rows, lambda r, i: line(F.lit(top) + i * step, x, r))


_CASED = "array_to_string(list_transform(range(1, length(r) + 1), lambda k: CASE WHEN r[k] = 'w' AND regexp_matches(right(regexp_replace(left(r, k - 1), '[ w]', '', 'g'), 1), '[A-ZÀ-Ý]') THEN 'W' ELSE r[k] END), '')"


@query(f"""WITH p AS (SELECT item_id, 'b' || (item_id // {BOOK}) AS doc, {_W} AS w FROM benchmark), r AS (SELECT *, list_transform({_rows_sql("w", 6)}, lambda r: {_CASED}) AS rows FROM p)
SELECT book, doc, item_id + 1 AS num, upper(w[1]) || CASE WHEN item_id % 3 = 0 THEN ' ' || upper(w[2]) ELSE '' END AS title, CASE WHEN book = 2 THEN 'Art ' || upper(w[3]) END AS artist, (item_id % {BOOK} + 1)::INT AS page, array_to_string(rows, '|') AS lines
FROM r, (VALUES (1), (2)) AS b(book)""")
def numbered_books(spark, sf_dir):
    """S4, S5 (F6, P3, P4, W1-W5, A1, A2): numbered titles, some in two lines, with or without an artist below; a letter is set as a control code."""
    p = passages(spark, sf_dir).withColumn("r", in_rows(F.col("w"), 6))
    coded = F.transform("r", lambda r: F.translate(r, "w", "\x01"))
    word = lambda k: T.upper_letters(F.get("w", F.lit(k)))
    title = F.array(line(30, 36.0, F.concat((F.col("id") + 1).cast("string"), F.lit(". "), word(0)), 14.0, "bold"))
    more = F.when(F.col("id") % 3 == 0, F.array(line(45, 36.0, word(1), 14.0, "bold"))).otherwise(F.slice(title, 1, 0))
    artist = F.array(line(57, 36.0, F.concat(F.lit("Art "), word(2)), 9.0))
    codes = spark.createDataFrame([("f", "\x01", "w")], "font string, c string, shown string")
    one = books.numbered_book(glyphs(p, F.concat(title, more, placed(coded, 70.0, 36.0))), ["bold"], codes)
    two = books.numbered_book(glyphs(p, F.concat(title, more, artist, placed(coded, 70.0, 36.0))), ["bold"], codes, small=True)
    both = one.withColumn("book", F.lit(1)).unionByName(two.withColumn("book", F.lit(2)))
    return both.select("book", "doc", F.col("num").cast("long").alias("num"), "title", "artist", "page", F.array_join("lines", "|").alias("lines"))


@query(f"""WITH p AS (SELECT item_id, {_W} AS w FROM benchmark), r AS (SELECT *, {_rows_sql("w", 3)} AS rows FROM p), s AS (SELECT *, CASE WHEN len(rows) >= 6 THEN (len(rows) + 1) // 2 ELSE len(rows) END AS half FROM r)
SELECT item_id % 2 + 1 AS part, item_id::INT AS page, w[1] || ' ' || w[2] || ' ' || w[3] || ' ' || item_id AS title, 'Artist ' || item_id AS artist,
  array_to_string(rows[1:half] || CASE WHEN half < len(rows) THEN [''] || rows[half + 1:len(rows)] ELSE []::VARCHAR[] END, '|') AS lines FROM s""")
def indexed_book_scan(spark, sf_dir):
    """S6 (J3, P5, W4, W7, A3, A4): pages in two columns under a title that lacks a letter of the table's; every page is a passage."""
    p = passages(spark, sf_dir).withColumn("doc", F.lit("b")).withColumn("page", F.col("id").cast("int")).withColumn("r", in_rows(F.col("w"), 3))
    title = F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1)), F.get("w", F.lit(2)), F.col("id").cast("string"))
    half = F.when(F.size("r") >= 6, F.floor((F.size("r") + 1) / 2).cast("int")).otherwise(F.size("r"))
    right = F.slice("r", half + 1, F.greatest(F.size("r") - half, F.lit(0)))
    pages = glyphs(p, F.concat(F.array(line(50, 58.0, F.regexp_replace(title, "^(.)(.)", "$1"), 18.0)), placed(F.slice("r", F.lit(1), half), 170.0, 58.0), placed(right, 170.0, 330.0)))
    contents = p.select("page", title.alias("title"), F.concat(F.lit("Artist "), F.col("id").cast("string")).alias("artist"), (F.col("id") % 2 + 1).alias("part"))
    return books.indexed_book(pages, contents).select("part", "page", "title", "artist", F.array_join("lines", "|").alias("lines"))


@query(f"""WITH p AS (SELECT item_id, 'b' || (item_id // {BOOK}) AS doc, {_W} AS w FROM benchmark), r AS (SELECT *, {_rows_sql("w", 6)} AS rows FROM p)
SELECT doc, (item_id % {BOOK} + 1)::INT AS page, 'Section ' || (item_id % {BOOK} // 3) AS section, 'Title ' || w[1] AS title, CASE WHEN item_id % 4 = 0 THEN 'Voice ' || w[2] ELSE 'Section ' || (item_id % {BOOK} // 3) END AS artist,
  CASE WHEN item_id % 2 = 1 THEN '(' || w[3] || ')' END AS composer, CASE WHEN item_id % 3 = 0 THEN '- ' || w[2] ELSE '' END AS credits, '[C]' || array_to_string(rows, '|') AS body FROM r WHERE item_id % {BOOK} // 3 <> 2""")
def font_book_scan(spark, sf_dir):
    """S7 (F7, F9, P14, P15, P17): roles by font, letters shifted by 29 code points, metadata in front, a dictionary behind; one section is left out."""
    p = passages(spark, sf_dir).withColumn("r", in_rows(F.col("w"), 6))
    of, none = F.col("id") % BOOK, F.array().cast("array<string>")
    section = F.concat(F.lit("Section "), F.floor(of / 3).cast("string"))
    meta = F.concat(
        F.when(F.col("id") % 4 == 0, F.array(F.concat(F.lit("Voice "), F.get("w", F.lit(1))))).otherwise(none), F.when(F.col("id") % 2 == 1, F.array(F.concat(F.lit("("), F.get("w", F.lit(2)), F.lit(")")))).otherwise(none),
        F.when(F.col("id") % 3 == 0, F.array(F.concat(F.lit("- "), F.get("w", F.lit(1))))).otherwise(none),
    )
    body = F.transform("r", lambda r, i: F.concat(F.when(i == 0, "[C]").otherwise(""), r))
    tail = F.array(F.concat(F.lit("page "), F.col("page").cast("string")), F.lit("Dictionar de acorduri"), F.lit("C x32010"))
    coded = lambda x: T.shift_decode(x, -29)
    text = F.transform(F.concat(meta, body, tail), lambda r, i: line(F.lit(60.0) + i * 12.0, 20.0, coded(r)))
    opens = F.when(of % 3 == 0, F.array(line(20, 20.0, coded(section), 10.0, "sec"))).otherwise(F.slice(text, 1, 0))
    heads = F.concat(F.array(line(10, 20.0, coded(F.lit("Songs 2.0")), 10.0, "run")), opens, F.array(line(40, 20.0, coded(F.concat(F.lit("Title "), F.get("w", F.lit(0)))), 10.0, "tit")))
    found = books.font_book(glyphs(p, F.concat(heads, text)), "run", "tit", "sec", F.char(F.ascii("c") + 29), r"^page \d+$", r"^[\s\-•]*Dic[țt]ionar de acorduri", ["Section 2"])
    return found.select("doc", "page", "section", "title", "artist", "composer", F.array_join("credits", "|").alias("credits"), F.array_join("body", "|").alias("body"))


# -- K2, S9-S14, K8, K9, S22 ------------------------------------------------------------------------------------------------
_BODY = "string_split(text, chr(10))"


@query(f"""WITH d AS (SELECT *, {_BODY} AS l FROM documents WHERE text IS NOT NULL)
SELECT source || '/' || (doc_id // 100) AS doc, lang AS part, CASE WHEN doc_id % 3 > 0 THEN 'S' || (doc_id % 3) END AS sub, 'Text ' || doc_id AS title, CASE WHEN doc_id % 4 > 0 THEN source END AS artist,
  (1 + len(l) + CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 0 END)::INT AS n, sha256(array_to_string(list_transform(l, lambda x: 'text:' || x) || CASE WHEN doc_id % 2 = 0 THEN ['tab:e|--' || doc_id, 'tab:B|--'] ELSE []::VARCHAR[] END, chr(10))) AS body FROM d""")
def book_steps(spark, sf_dir):
    """K2, S9-S12 (P16, W9, W10): the documents written as Markdown books of bounded size, with parts, sections, metadata and two kinds of fences, and parsed again."""
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    typed = lambda kind, x: F.struct(F.lit(kind).alias("kind"), x.alias("line"))
    tab = F.array(typed("tab", F.concat(F.lit("e|--"), F.col("doc_id").cast("string"))), typed("tab", F.lit("B|--")))
    meta = F.concat(F.when(F.col("doc_id") % 4 > 0, F.concat(F.lit("**"), "source", F.lit("** · "))).otherwise(""), F.lit("Sursa: "), "lang")
    body = F.concat(F.array(typed("note", meta)), F.transform(F.split("text", "\n"), lambda x: typed("text", x)), F.when(F.col("doc_id") % 2 == 0, tab).otherwise(F.slice(tab, 1, 0)))
    items = docs.select(F.concat_ws("/", "source", F.floor(F.col("doc_id") / 100).cast("string")).alias("doc"), "doc_id", "lang", F.concat(F.lit("Text "), F.col("doc_id").cast("string")).alias("title"), body.alias("body"))
    heads = F.concat(F.lit("## "), "lang", F.lit("\n"), F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("### S"), (F.col("doc_id") % 3).cast("string"), F.lit("\n"))).otherwise(""))
    lines = writers.item_markdown(items).select("doc", "doc_id", F.posexplode(F.split(F.regexp_replace(F.concat(heads, "markdown"), "\n$", ""), "\n")).alias("l", "line"))
    book = lines.select("doc", (F.col("doc_id") * (1 << 20) + F.col("l")).alias("ord"), "line")  # of at most a million lines each
    found = readers.markdown_songs(book)
    shown = F.transform(F.filter("body", lambda x: x["kind"] != "note"), lambda x: F.concat_ws(":", x["kind"], x["line"]))
    return found.select("doc", "part", "sub", "title", "artist", F.size("body").alias("n"), F.sha2(F.array_join(shown, "\n"), 256).alias("body"))


@query(f"""WITH l AS (SELECT doc_id, unnest({_BODY}) AS line, generate_subscripts({_BODY}, 1) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT doc_id, i, line, ['C', 'Am', '(G)', 'N.C.'][length(line) % 4 + 1] AS label FROM l)
SELECT doc_id, (i + 1)::INT AS ord, '[' || label || ']a ' || CASE WHEN length(line) % 4 < 2 THEN '^' ELSE '[' || label || ']' END || 'b ' || line AS line FROM h WHERE length(line) % 4 < 2""")
def held_fences(spark, sf_dir):
    """Within fences, a bracketed symbol equal to the one before it on its line becomes a sign; the lines that change."""
    label = F.get(F.array(*map(F.lit, ["C", "Am", "(G)", "N.C."])), F.length("line") % 4)
    rows = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    rows = rows.select("doc_id", (F.col("i") + 2).alias("ord"), F.concat(F.lit("["), label, F.lit("]a ["), label, F.lit("]b "), "line").alias("line"))
    ends = rows.groupBy("doc_id").agg(F.max("ord").alias("last"))
    fence = lambda at, x: ends.select("doc_id", at.cast("int").alias("ord"), F.lit(x).alias("line"))
    book = rows.unionAll(fence(F.lit(1), "```text")).unionAll(fence(F.col("last") + 1, "```")).unionAll(fence(F.col("last") + 2, "[C]a [C]b outside"))
    return songs.rewrite_fenced(book, "doc_id", "ord", "text", songs.hold_repeats, songs.is_chord_line).filter("changed").select("doc_id", "ord", "line")
