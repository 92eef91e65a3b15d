"""Title case with proper nouns."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corpusforge.functions import text as T
from corpusforge.session import ship_package

# Small words of English titles, and words that are small in Romanian titles and never names (without accents).
SMALL = set("a an the and or but of in on at to for from with by".split())
STOP = set("de la cu in din pe si sau pentru fara ca o un lui cel cea cele care nu mai sa se am a ai e en prin ne mi te ce catre peste sub dintre intre unui unei al ale asta dar deci iar tot isi".split())
ROMAN = re.compile("[IVX]{2,}")
#: What separates the words of a title; a word is what is left if it has word characters only.
SEPARATORS = re.compile(r"(\s+|[-,.'’()!?])")


def proper_nouns(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = 4, letters: int = 5) -> DataFrame:
    """(word, form, n): words seen capitalised after a lower-case word of the same line at least `least` times, by their
    normal key of at least `letters` letters, with the form seen first. Words of capitals only and stop words don't count."""
    lines = docs.select(F.col(id).alias("id"), F.posexplode(T.lines(F.coalesce(F.col(text), F.lit("")))).alias("row", "line"))
    seen = lines.select("id", "row", F.posexplode(F.regexp_extract_all("line", F.lit(r"(?U)\p{Ll}\s+(\p{Lu}[\w'’-]{2,})"), 1)).alias("at", "form")).filter(F.col("form") != F.upper("form"))
    keyed = seen.withColumn("word", T.norm(F.col("form"))).filter((F.length("word") >= letters) & ~F.col("word").isin(*sorted(STOP)))
    return keyed.groupBy("word").agg(F.min_by("form", F.struct("id", "row", "at")).alias("form"), F.count("*").alias("n")).filter(F.col("n") >= least)


def recase(title: str, names: dict[str, str | None], english: bool) -> str:
    """English titles get title case; others that are mostly capitals get sentence case, and mixed ones stay. names: lower-case word ->
    its form as a proper noun, or None for a word that only shares a trusted noun's stem (J20). Roman numerals stay; up to two letters
    after an apostrophe are the tail of a contraction."""
    letters = [c for c in title if c.isalpha()]
    if not letters or not english and sum(map(str.isupper, letters)) < 0.7 * len(letters):
        return title
    out, first, tail = [], True, False
    for part in SEPARATORS.split(title):
        low = part.lower()
        if not re.fullmatch(r"\w+", part):
            tail = part in ("'", "’") or tail and not part.strip()
        elif tail and len(part) <= 2:
            part, tail = low, False
        else:
            tail = False
            if first:
                part = low.capitalize()
            elif not ROMAN.fullmatch(part):
                if english:
                    part = low if low in SMALL else low.capitalize()
                elif low in names:
                    part = names[low] or low.capitalize()
                else:
                    part = low
            first = False
        out.append(part)
    whole = "".join(out)
    return whole[:1].upper() + whole[1:]


def title_words(title: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(title), r"[\s\-,.'’()!?]+"), lambda w: w != ""))


def names_in_titles(words: DataFrame, nouns: DataFrame, trusted: DataFrame) -> DataFrame:
    """(low, form) for the different lower-case words (low) of titles that are proper nouns: nouns (word, form) by their own letters, and
    with a null form those that share a stem with a trusted noun (word): four letters or more, and all but two of the shorter one."""
    keyed = words.select("low", T.norm(F.col("low")).alias("word")).filter(~F.col("word").isin(*sorted(STOP)))
    exact = keyed.join(nouns.select("word", "form"), "word").filter(F.lower("form") == F.col("low")).select("low", "form")
    stem = lambda df: df.filter(F.length("word") >= 5).withColumn("stem", F.substring("word", 1, 4))
    kin = stem(keyed).join(stem(trusted.select("word").distinct()).withColumnRenamed("word", "noun"), "stem")
    kin = kin.filter(T.common_prefix(F.col("word"), F.col("noun")) >= F.least(F.length("word"), F.length("noun")) - 2)
    return exact.unionAll(kin.select("low", F.lit(None).cast("string").alias("form"))).groupBy("low").agg(F.min("form").alias("form"))


def recase_titles(rows: DataFrame, id: str, title: str, lang: str, nouns: DataFrame, trusted: DataFrame, english: str = "en") -> DataFrame:
    """T2 over a table with a key `id`; adds recased. nouns: (word, form); trusted: (word), nouns whose stems count as well.

    Only names that stand in a title travel with it, however many nouns there are. Null titles stay null."""
    ship_package(rows.sparkSession)
    pairs = rows.select(F.col(id).alias("_id"), F.explode(title_words(F.col(title))).alias("low"))
    found = names_in_titles(pairs.select("low").distinct(), nouns, trusted)
    held = pairs.join(found, "low").groupBy("_id").agg(F.map_from_entries(F.collect_list(F.struct("low", F.coalesce("form", F.lit(""))))).alias("_names"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            names = [{w: f or None for w, f in dict(m).items()} if m is not None else {} for m in pdf.pop("_names")]
            yield pdf.assign(recased=[None if t is None else recase(t, n, g == english) for t, g, n in zip(pdf[title], pdf[lang], names)])

    joined = rows.join(held, F.col(id) == F.col("_id"), "left").select(*rows.columns, "_names")
    return joined.mapInPandas(run, StructType([*rows.schema.fields, StructField("recased", StringType())]))


def first_line(text: str = "text"):
    return T.strip(F.substring_index(F.col(text), "\n", 1))
