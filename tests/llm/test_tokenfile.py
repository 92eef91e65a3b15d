"""Token files: the coding, and files against the tokenizers library."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusforge.llm import queries, tokenfile

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=70))
@settings(max_examples=200, deadline=None)
def test_coding(ranks):
    control, data = tokenfile.pack_ranks(np.array(ranks, "<u4"))
    assert len(control) == -(-len(ranks) // 4)
    size = [max(1, -(-r.bit_length() // 8)) for r in ranks]
    assert len(data) == sum(size)
    assert [control[i // 4] >> 2 * (i % 4) & 3 for i in range(len(ranks))] == [s - 1 for s in size]
    assert data == b"".join(r.to_bytes(s, "little") for r, s in zip(ranks, size))
    assert tokenfile.unpack_ranks(control, data, len(ranks)).tolist() == ranks


@given(st.lists(st.one_of(st.integers(0, 65_535), st.integers(0, 2**32 - 1)), max_size=9))
@settings(max_examples=100, deadline=None)
def test_held_ids(ids):
    codec = pa.Codec("zstd")
    raw = tokenfile.held(np.array(ids, "<u4"), codec)
    assert raw[0] == (4 if any(x > 65_535 for x in ids) else 2) and tokenfile.unheld(raw, len(ids), codec).tolist() == ids


def test_broken_block():
    control, data = tokenfile.pack_ranks(np.arange(300, dtype="<u4"))
    with pytest.raises(ValueError, match="control bytes"):
        tokenfile.unpack_ranks(control, data[:-1], 300)


def expected(rows):
    encoder = Tokenizer.from_file(PATH)
    encoder.no_truncation()
    encoder.no_padding()
    out, start = [], 0
    ids = [(i, [*encoder.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    for i, x in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0)):
        out.append((i, start, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        start += len(x)
    return out


HOSTILE = [
    (5, None), (4, ""), (3, " "), (9, "plain words, and 123"), (-2, "<|endoftext|> inside"), (0, "日本語 text"), (77, "a" * 70_000), (2**40, "nul \x00 é"), (12, "x " * 40_000), (None, "no id"),
]


@pytest.mark.parametrize("block_ids", [1, 50, tokenfile.BLOCK_IDS])
def test_files(spark, block_ids):
    df = spark.createDataFrame([(t, i, "clash", 1) for i, t in HOSTILE], "text string, doc_id long, ids string, range int")
    folder = tokenfile.shared_folder(spark)
    tokenfile.write_tokens(df, PATH, folder, block_ids=block_ids)
    want = expected(HOSTILE)
    assert [tuple(r) for r in tokenfile.read_tokens(spark, folder, digest=True).orderBy("start").collect()] == want
    whole = tokenfile.read_tokens(spark, folder).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in whole] == want
    ranks = {r.token: r["rank"] for r in spark.read.parquet(f"{folder}/ranks").collect()}
    seen = np.bincount([x for r in whole for x in r.ids])
    assert sorted(ranks, key=ranks.get) == sorted(np.nonzero(seen)[0].tolist(), key=lambda t: (-seen[t], t))


def test_repeated_and_empty(spark):
    rows = [(1, "same")] * 40 + [(1, "other"), (0, "first"), (2, None), (2, "")]
    folder = tokenfile.shared_folder(spark)
    tokenfile.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH, folder)
    got = [tuple(r) for r in tokenfile.read_tokens(spark, folder, digest=True).orderBy("start").collect()]
    assert sorted((i, n, c) for i, _, n, c in got) == sorted((i, n, c) for i, _, n, c in expected(rows))
    assert [i for i, *_ in got] == sorted(i for i, _ in rows)
    assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:])) and got[0][1] == 0
    empty = tokenfile.shared_folder(spark)
    tokenfile.write_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, empty)
    assert tokenfile.read_tokens(spark, empty, digest=True).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert [tuple(r) for r in queries.op13_tokens(spark, folder).orderBy("start").collect()] == expected(rows)
