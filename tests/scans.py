"""Small typeset books read end to end (S4-S7); the items are worked out by hand from the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.operators import books
from corpusforge.operators.geometry import GLYPH
from worked import query, stated


def typeset(spark, rows: list[tuple]):
    """Glyphs, five points wide, of rows (page, y, x, text, size, font)."""
    out = []
    for page, y, x, text, size, font in rows:
        out += [("d", page, len(out) + i, c, x + 5.0 * i, x + 5.0 * (i + 1), float(y), float(size), font) for i, c in enumerate(text)]
    return spark.createDataFrame(out, GLYPH)


_rows = lambda c: F.array_join(c, "|")

BOOK_1 = [
    (1, 10, 300.0, "12", 10, "f"), (1, 30, 36.0, "1. Dor", 14, "bold"), (1, 45, 36.0, "mare", 14, "bold"), (1, 70, 36.0, "C", 9, "f"), (1, 70, 66.0, "Am", 9, "f"), (1, 80, 36.0, "la lume", 10, "f"),
    (1, 110, 48.0, "a\x01", 10, "f"), (2, 50, 36.0, "G", 10, "f"), (2, 50, 72.0, "D", 10, "f"), (2, 100, 36.0, "sus", 10, "f"), (2, 130, 36.0, "2. Cer", 14, "bold"), (2, 140, 36.0, "\x01i cer", 10, "f"),
]

BOOK_2 = [
    (1, 20, 36.0, "3. Sun", 14, "bold"), (1, 35, 36.0, "Terry", 9, "f"), (1, 50, 36.0, "x", 9, "f"), (1, 60, 36.0, "Em", 10, "f"), (1, 60, 47.5, "G", 10, "f"), (1, 70, 36.0, "note", 9, "f"),
    (2, 30, 36.0, "Jacques", 9, "f"), (2, 60, 36.0, "hi", 10, "f"),
]


@query(stated("book BIGINT, num BIGINT, title VARCHAR, artist VARCHAR, page BIGINT, lines VARCHAR", [
    (1, 1, "Dor mare", None, 1, "C     Am|la lume||  aș|G     D||sus"), (1, 2, "Cer", None, 2, "Și cer"), (2, 3, "Sun", "Terry", 1, "x|Em G|note"), (2, 7, "SEASONS", "Jacques", 2, "hi"),
]))
def numbered_books(spark, sf_dir):
    """S4, S5 (F6, P3, P4, W1-W5, W13, A1, A2)."""
    codes = spark.createDataFrame([("f", "\x01", "Ș")], "font string, c string, shown string")
    named = spark.createDataFrame([("d", 2, 7, "SEASONS")], "doc string, page int, num int, title string")
    one = books.numbered_book(typeset(spark, BOOK_1), ["bold"], codes)
    two = books.numbered_book(typeset(spark, BOOK_2), ["bold"], codes.limit(0), small=True, titles=named)
    both = one.withColumn("book", F.lit(1)).unionByName(two.withColumn("book", F.lit(2)))
    return both.select(F.col("book").cast("long"), F.col("num").cast("long"), "title", "artist", F.col("page").cast("long"), _rows("lines").alias("lines"))


BOOK_3 = [
    (1, 50, 58.0, "Doina mari", 18, "f"), *((1, y, x, t, 10, "f") for y, a, b in ((100, "alfa", "unua"), (120, "beta", "doua"), (140, "gama", "roşu")) for x, t in ((58.0, a), (330.0, b))),
    (2, 100, 58.0, "C", 10, "f"), (2, 110, 58.0, "vers", 10, "f"), (2, 140, 58.0, "123", 10, "f"), (2, 150, 58.0, "gata", 10, "f"),
    (3, 50, 58.0, "ZZZ QQ", 18, "f"), (3, 100, 58.0, "text", 10, "f"), (4, 100, 58.0, "foreword", 10, "f"),
]


@query(stated("part BIGINT, page BIGINT, title VARCHAR, page_title VARCHAR, artist VARCHAR, lines VARCHAR", [
    (1, 1, "Doina mare", "Doina mari", "Ana", "alfa|beta|gama||unua|doua|roșu"), (2, 2, "Alta", None, "Bob", "C|vers||gata"), (2, 3, "Zzz qq", "ZZZ QQ", "Cip", "text"),
]))
def indexed_book_scan(spark, sf_dir):
    """S6 (F5, J3, P5, W4, W7, W13, A3, A4)."""
    contents = spark.createDataFrame([(1, "Doina mare", "Ana", 1), (2, "Alta", "Bob", 2), (3, "Unu", "Cip", 2), (9, "Gone", "X", 2)], "page int, title string, artist string, part int")
    found = books.indexed_book(typeset(spark, BOOK_3), contents)
    return found.select(F.col("part").cast("long"), F.col("page").cast("long"), "title", "page_title", "artist", _rows("lines").alias("lines"))


def shifted(text: str) -> str:
    return "".join("k" if c == "â" else chr(ord(c) - 29) for c in text)


BOOK_4 = [(page, y, 20.0, shifted(text), 10, font) for page, y, text, font in [
    (1, 10, "Songs 2.0", "run"), (1, 20, "Ana", "sec"), (1, 40, "Dor", "tit"), (1, 50, "(trad)", "f"), (1, 60, "- by X", "f"), (1, 70, "[C]la", "f"), (1, 80, "page 3", "f"), (1, 90, "Dictionar de acorduri", "f"), (1, 100, "C x32010", "f"),
    (2, 40, "Cânt", "tit"), (2, 50, "Bob", "f"), (2, 60, "[G]x", "f"), (3, 20, "Teorie", "sec"), (3, 30, "Gama", "tit"), (3, 40, "do re", "f"),
]]


@query(stated("page BIGINT, section VARCHAR, title VARCHAR, artist VARCHAR, composer VARCHAR, credits VARCHAR, body VARCHAR", [(1, "Ana", "Dor", "Ana", "(trad)", "- by X", "[C]la"), (2, "Ana", "Cânt", "Bob", None, "", "[G]x")]))
def font_book_scan(spark, sf_dir):
    """S7 (F7, F9, P14, P15, P17)."""
    code = F.ascii("c")
    decode = F.when(code.between(3, 95), F.char(code + 29)).when(F.col("c") == "k", "â").otherwise(F.col("c"))
    found = books.font_book(typeset(spark, BOOK_4), "run", "tit", "sec", decode, r"^page \d+$", r"^[\s\-•]*Dic[țt]ionar de acorduri", ["Teorie"])
    return found.select(F.col("page").cast("long"), "section", "title", "artist", "composer", _rows("credits").alias("credits"), _rows("body").alias("body"))
