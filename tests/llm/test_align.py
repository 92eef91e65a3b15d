"""Alignment of two tokenizers against whole texts encoded by the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpusforge.llm import align, bpe, queries

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(BYTES)
    first.no_truncation()
    first.no_padding()
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = bpe.byte_letters()
    vocab = {i: bytes(letters[c] for c in t) if t != "<|endoftext|>" else t.encode() for t, i in first.get_vocab().items()}
    return first, second, vocab


def plain(libraries, text):
    """Groups as lists of ids, offset by offset."""
    first, second, vocab = libraries
    if not text:
        return []
    a = [(i, vocab[i]) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(x for _, x in side) != (" " + text).encode() for side in (a, b)):
        return []
    out, group, x, y, i, j = [], ([], []), 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if x <= y and i < len(a):
            group[0].append(a[i][0])
            x, i = x + len(a[i][1]), i + 1
        else:
            group[1].append(b[j][0])
            y, j = y + len(b[j][1]), j + 1
        if x == y:
            out.append(group)
            group = ([], [])
    return out


def expected(libraries, rows):
    groups = [(i, plain(libraries, t)) for i, t in rows]
    links = [Counter((a, b) for g in gs for a in g[0] for b in g[1]) for _, gs in groups]
    count = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (i, gs), c in zip(groups, links):
        said = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in gs)
        best = sum(n for p, n in c.items() if count[p] == top[p[0]])
        out.append((i, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), sum(c.values()), best, sum(n * count[p] for p, n in c.items()), hashlib.sha256(said.encode()).hexdigest() if gs else ""))
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, df.collect()), key=repr)


HOSTILE = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\r\nb", "x;\r\n y", "x \r y", "tab\tand\n\n line", "trailing \n", "sign ▁ inside", "<|endoftext|> and <s> </s> <unk> <0x41>",
    "日本語のテキスト", "emoji 😀😀 and é́", "nul \x00 byte", "\x1c\x1d odd \x85 white\xa0space 　 wide", "it's we'll 'S", "12345 67 8.9", "-----" * 30, "q" * 3000, "word " * 3000, "a​b ﻿c", "the the the",
]


@pytest.mark.parametrize("part_chars", [1, 200, align.PART_CHARS])
def test_hostile_texts(spark, libraries, part_chars):
    rows = [(k, t) for k, t in enumerate(HOSTILE)] + [(3, "the the the"), (None, "no id"), (26, "the the the")]
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in rows], "text string, doc_id long, part int, segments string").repartition(3)
    assert found(align.align(df, BYTES, PIECES, part_chars=part_chars)) == expected(libraries, rows)


def test_random_texts(spark, libraries):
    rng, bits = random.Random(5), [" ", " ", "\n", "\r", "\t", "the", "ing", "é", ".", "'s", "9", "▁", "ß", "Ж", "語", ";", "(", "\r\n", "  ", "\xa0", "\v", "a", "xyz", "<0x0A>"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(1, 40)))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(align.align(df, BYTES, PIECES, part_chars=2000)) == expected(libraries, rows)


def test_empty_table(spark):
    assert found(align.align(spark.createDataFrame([], "doc_id long, text string"), BYTES, PIECES)) == []


def test_cuts_follow_the_vocabularies():
    assert align.splittable([b" the", b"\n\n", b"a\tb", b"x\r\n", b" \xc2\xa0 "]) == " \n\v\f"  # the line feed stands behind white space only
    with open(PIECES, "rb") as f:
        both = align.Aligner(bpe.read_vocabulary(BYTES), f.read())
    assert " " in both.breaks and "\n" in both.breaks and "\r" not in both.breaks
    assert both.segments(" a b\rc\n\r d\r") == [" a", " b\rc", "\n\r d\r"]


def test_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op12_alignment(spark, folder)) == expected(libraries, rows)
