"""Sources (S1, S9, S10, S13, S14, S16, S19, S20): books as Markdown, catalogues, snapshots, word lists and glyph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusforge.operators.geometry import GLYPH
from corpusforge.operators.lines import carry_forward, fences


def markdown_lines(spark: SparkSession, path: str) -> DataFrame:
    """(doc, ord, line) of whole files, in the order of the file."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), F.col("value"))
    return files.select("doc", F.posexplode(F.split("value", "\r?\n")).alias("ord", "line"))


def markdown_songs(rows: DataFrame) -> DataFrame:
    """Items of a book: (doc, start, part, sub, title, meta, artist, body array<struct<kind, line>>), kind being the
    fence's language or note. Part and sub headers carry forward; a metadata line follows the title."""
    level = lambda n: F.when(F.col("line").rlike(f"^{'#' * n} "), F.expr(f"substring(line, {n + 2})"))
    f = fences(rows, "doc", "ord", F.col("line").rlike("^```"))
    f = carry_forward(f, "doc", "ord", F.when(F.col("line").rlike("^```[a-z]"), F.expr("substring(line, 4)")), "lang")
    inside = F.col("inside")
    f = carry_forward(f, "doc", "ord", F.when(~inside, level(2)), "part")
    f = carry_forward(f, "doc", "ord", F.when(~inside & F.col("line").rlike("^##?#? "), F.coalesce(level(3), F.lit(""))), "sub")
    f = carry_forward(f, "doc", "ord", F.when(~inside & F.col("line").rlike("^##{1,3} "), F.coalesce(F.when(level(4).isNotNull(), F.col("ord")), F.lit(-1))), "start")
    titled = f.filter(F.col("start") >= 0)
    item = ["doc", "start", "part", "sub"]
    body = F.transform(F.sort_array(F.collect_list(F.when((F.col("ord") > F.col("start")) & ~F.col("is_marker"), F.struct("ord", F.when(inside, F.col("lang")).otherwise("note").alias("kind"), "line")))), lambda x: F.struct(x["kind"].alias("kind"), x["line"].alias("line")))
    out = titled.groupBy(*item).agg(F.max(F.when(F.col("ord") == F.col("start"), level(4))).alias("title"), body.alias("body"))
    meta = F.get(F.filter("body", lambda x: (x["kind"] == "note") & (F.trim(x["line"]) != "")), F.lit(0))["line"]
    meta = F.when(meta.rlike(r"^\*\*|Sursa:"), meta)
    return out.withColumn("meta", meta).withColumn("sub", F.nullif("sub", F.lit(""))).withColumn("artist", F.nullif(F.regexp_extract(F.coalesce("meta", F.lit("")), r"^\*\*(.+?)\*\*", 1), F.lit("")))


def link_catalogue(rows: DataFrame) -> DataFrame:
    """(doc, ord, artist, title, href) from link rows under artist headers."""
    f = carry_forward(rows, "doc", "ord", F.when(F.col("line").rlike("^## "), F.expr("substring(line, 4)")), "artist")
    link = r"^[-*] \[(.+?)\]\((\S+?)\)"
    return f.filter(F.col("line").rlike(link)).select("doc", "ord", "artist", F.regexp_extract("line", link, 1).alias("title"), F.regexp_extract("line", link, 2).alias("href"))


def selection(rows: DataFrame) -> DataFrame:
    """(ord, title, key) of rows such as `- Title | Am`; a row that looks otherwise is an error."""
    form = r"^[-*] (.+?) \| ([A-G][#b]?m?)\s*$"
    found = rows.filter(F.col("line").rlike("^[-*] "))
    checked = F.when(F.col("line").rlike(form), F.regexp_extract("line", form, 1)).otherwise(F.raise_error(F.concat(F.lit("malformed row: "), "line")))
    return found.select("ord", checked.alias("title"), F.regexp_extract("line", form, 2).alias("key"))


def json_snapshot(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A JSON document or array with a stated schema."""
    return spark.read.json(path, schema=schema, multiLine=True)


def word_forms(spark: SparkSession, path: str, needed: DataFrame | None = None) -> DataFrame:
    """(word); with needed (k), only words whose folded key is among them."""
    from corpusforge.functions.text import fold

    words = spark.read.text(path).select(F.split("value", "/")[0].alias("word")).filter("word <> ''")
    return words if needed is None else words.withColumn("k", fold(F.col("word"))).join(needed.select("k").distinct(), "k", "left_semi")


def glyphs(spark: SparkSession, path: str) -> DataFrame:
    """A glyph table in Parquet or JSON, in place of scanning page images."""
    return (spark.read.schema(GLYPH).json(path) if path.endswith(".json") else spark.read.parquet(path)).select(*(c.split()[0] for c in GLYPH.split(", ")))
