"""The stages one after the other, each on what the one before kept."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs, out = spark.read.parquet(f"{DIR}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR).cache()
        out.append(docs)
    return out


def test_order_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "near_dedup", "suffix_dedup", "packing"]
    assert all(df.columns == kept[0].columns for df in kept[:-1])
    n = [df.count() for df in kept]
    assert n[0] >= n[1] > n[2] > n[3] == n[4] > 0


def test_quality_takes_the_toxic_and_leaves_the_good(spark, kept):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    before, after = (labels.join(df.select("doc_id"), "doc_id").collect() for df in kept[1:3])
    good = lambda rows: sum(r.quality == 1 and r.toxic == 0 for r in rows)
    assert good(after) >= 0.97 * good(before) and sum(r.toxic == 1 for r in after) <= 0.1 * sum(r.toxic == 1 for r in before)


def test_pieces_cover_what_is_left(kept):
    pieces = kept[-1].groupBy("doc_id").sum("length").collect()
    assert len(pieces) == kept[-2].count()


def test_near_dedup_keeps_one_of_each_group(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(9000)}" for _ in range(500)]
    near = [*base[:200], "new", "words", *base[202:]]  # similarity 0.98
    other = [f"o{rng.randrange(9000)}" for _ in range(500)]
    texts = [" ".join(x) for x in (other, near, base, base)] + [None, "", "alone here", "ALONE here"]
    df = spark.createDataFrame([(10 - i, t, "en", "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, df, DIR).collect()) == [3, 5, 7, 10]


def test_suffix_stage_cuts_text(spark):
    rng = random.Random(2)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260)).strip()
    df = spark.createDataFrame([(1, f"one start é {passage}|", "en", "s", 0), (2, f"two {passage}# end", "en", "s", 0), (3, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r.doc_id: r for r in corpus_pipeline.suffix_dedup(spark, df, DIR).collect()}
    assert rows[1].text.startswith("one start é") and rows[1].text.endswith("|") and rows[1].n_chars == len(rows[1].text) < 20
    assert rows[2].text.endswith("# end") and rows[3].text == ""


CLASHING = "kept n_bytes n_removed n_spans component_id fp c1 node id key sum data spans grade score lang_pred bucket rest part shard length start tile draw order range".split()


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_bear_hostile_tables(spark, name):
    """Nulls in any column, empty and long texts, repeated rows, clashing names, no rows at all."""
    stage = dict(corpus_pipeline.STAGES)[name]
    base = spark.read.parquet(f"{DIR}/documents.parquet").orderBy("doc_id").limit(60)
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    some = base.first().text
    odd = spark.createDataFrame([(None, None, None, None, None), (None, some, "en", "s", 1), (-1, "", "en", None, 0), (-2, None, None, "s", None), (-3, some * 40, "en", "s", None), (-3, some * 40, "en", "s", None)], columns)
    plain = base.select("doc_id", "text", "lang", "source", "n_chars").unionAll(odd)
    wide = plain.select("*", *(F.lit(f"{c}!").alias(c) for c in CLASHING))
    out = stage(spark, wide, DIR)
    if name != "packing":
        assert out.columns == wide.columns
        rows = out.collect()
        assert all(r[c] == f"{c}!" for r in rows for c in CLASHING)
        kept = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in rows)
        assert kept == sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in stage(spark, plain, DIR).collect())
        twice = sum(r.doc_id == -3 for r in rows)
        assert twice in (0, 2)
        if name == "language_id":
            assert not any((r.text or "") == "" for r in rows)
        if name == "suffix_dedup":
            assert len(rows) == plain.count() and all(r.text == "" for r in rows if r.doc_id in (-1, -2, -3))
    else:
        assert {r.n for r in out.groupBy("doc_id").agg(F.max("doc_tokens").alias("n")).filter("doc_id in (-1, -2)").collect()} == {1}
    none = stage(spark, wide.limit(0), DIR)
    assert none.count() == 0 and (name == "packing" or none.columns == wide.columns)
