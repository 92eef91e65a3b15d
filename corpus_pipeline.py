"""The training-data pipeline: language ID, quality, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import langid, ordinal, packing, simhash, suffix
from corpusforge.llm.common import checkpoint, documents
from corpusforge.llm.queries import vocabulary_path

#: A text stays with at least this part of its best language's usual familiarity (see README), and with at least this chance of the best grade.
MIN_FAMILIARITY, MIN_GOOD = 0.78, 0.5
#: Near-duplicates: five words, similarity 4 / 5. Candidates come from fingerprints of 16 words of 64 bits: at similarity 0.8 a bit
#: differs with a chance of 0.1875 at most (sets of 4 and 5), so either bound, on the whole or on two words, misses less than one pair in a million.
SHINGLE, SIMILARITY, WORDS, NEAR_RADIUS, LEAD, LEAD_RADIUS = 5, (4, 5), 16, 253, 2, 47
REPEAT_BYTES, WINDOW = 200, 1024


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters (so null and empty ones) and those that resemble no learned language. If no text has a lang, all
    texts with a letter stay. Ties and repeated rows are judged alike; an empty table stays empty; further columns come along."""
    return langid.keep_known(docs, langid.train(docs), MIN_FAMILIARITY)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts that are more likely than not below the best grade. Null texts are judged like empty ones; without two grades in
    labels all stay. Repeated rows are judged alike; an empty table stays empty; further columns come along."""
    ratings = ordinal.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.keep_good(docs, ordinal.train(docs, ratings), MIN_GOOD)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group. Rows without id can't be told apart and stay; rows that share an id stay together.
    Null, empty and blank texts are copies of each other. An empty table stays empty; further columns come along."""
    found = simhash.similar_documents(docs, "doc_id", "text", SHINGLE, WORDS, NEAR_RADIUS, LEAD_RADIUS, LEAD, *SIMILARITY)
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every passage of 200 bytes or more that also stands elsewhere; the documents stay, with what is left of them, maybe nothing.
    Null texts become empty. Repeated rows count as copies; an empty table stays empty; further columns come along, whatever their names."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in rest), F.lit(0).alias("_")).alias("rest"))  # names of their own, whatever they are
    cut = suffix.remove_repeats(own, length=REPEAT_BYTES, carry=["rest"])
    column = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType) if "n_chars" in rest else None}
    return cut.select(*((column[c] if c in column else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text, ended by an id of its own, as pieces of sequences. Null and empty texts are that id alone."""
    return packing.pack(docs, vocabulary_path(), window=WINDOW)


STAGES = [("language_id", language_id), ("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", pack)]

#: Trained models, sketches and tokenizers have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = checkpoint(docs)
    return docs
