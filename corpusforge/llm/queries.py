"""The queries opN_<name> and pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, conversation, html, langid, media, merkle, oracles, ordinal, packing, sharding, simhash, suffix, tokenfile
from .common import documents

#: Names of public vocabularies; their place is a parameter of the operators.
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARDS, WINDOW = 8, 1024


def vocabulary_path(name: str = BYTE_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(documents(spark, sf_dir), vocabulary_path())


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    claim = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) % 3  # a third right, a third wrong, a third without
    said = docs.select("doc_id", "text", F.when(claim == 0, media.WAV).when(claim == 1, "image/png").alias("declared"))
    return media.store_texts(said, declared="declared", keep=False)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), sharding.topology(SHARDS), sharding.topology(SHARDS + 1))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary_path(), window=WINDOW)


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edit_report(documents(spark, sf_dir))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), size=3, radius=3)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    ratings = ordinal.label_grades(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal.grade(docs, ordinal.train(docs, ratings)).select("doc_id", "expected_grade", F.get("tail", F.lit(0)).alias("p_not_toxic"), F.get("tail", F.lit(1)).alias("p_good"))


def op10_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(documents(spark, sf_dir), length=200, digest=True)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversation.repair(conversation.damage(rows), ids=rows, digest=True)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align(documents(spark, sf_dir), vocabulary_path(), vocabulary_path(PIECE_BPE))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfile.shared_folder(spark)
    tokenfile.write_tokens(documents(spark, sf_dir), vocabulary_path(), folder)
    return tokenfile.read_tokens(spark, folder, digest=True)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_bpe, op2_media, op3_sharding, op4_language, op5_packing, op6_html, op7_merkle, op8_simhash, op9_quality, op10_suffix, op11_conversations, op12_alignment, op13_tokens, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op11_conversations": oracles.OP11}
