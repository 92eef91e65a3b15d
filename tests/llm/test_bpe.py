"""BPE against the tokenizers library, and the parts of the transducer."""

import hashlib
import random
import tempfile

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpusforge.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SOURCE = bpe.read_vocabulary(PATH)
VOCABULARY = bpe.Vocabulary(SOURCE)
REFERENCE = Tokenizer.from_file(PATH)
WORDS = [" the", " and", "The", " of", "ing", " é", " über", " 中", "\n", " a"]


def mapped(block):
    with tempfile.NamedTemporaryFile() as f:
        f.write(block)
        f.flush()
        return bpe.Lexicon(f.name)


ENCODER = bpe.Encoder(VOCABULARY, mapped(bpe.build_lexicon(VOCABULARY, WORDS)))
ALPHABET = [*"ab é ß\n\t  '1٣-_Ա", "\x1c", "\x85", "中", "😀", "<|endoftext|>", "  ", "\r\n", "'re", "’s", "࢏", "꟒"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join))
def test_like_the_library(text):
    ids = REFERENCE.encode(text, add_special_tokens=False).ids
    assert ENCODER.encode(text).tolist() == ids
    batch = bpe.Encoder(VOCABULARY, ENCODER.lexicon)
    batch.prepare([text, None, " the" + text])
    assert batch.encode(text).tolist() == ids
    assert bpe.FastIds(SOURCE).encode(text).tolist() == ids if len(text) < 4 else True
    assert ENCODER.decode(ids) == REFERENCE.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["", None, "a" * 5000, "ab" * 20000, " " * 3000, "é" * 500 + "\n\n x", "=-" * 4000])
def test_long_and_empty(text):
    assert ENCODER.encode(text).tolist() == REFERENCE.encode(text or "", add_special_tokens=False).ids


def test_fast_ids():
    fast, rng = bpe.FastIds(SOURCE), random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30)))
        assert fast.encode(text).tolist() == REFERENCE.encode(text, add_special_tokens=False).ids


def test_broken_ids_decode_like_the_library():
    rng = random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert ENCODER.decode(ids) == REFERENCE.decode(ids, skip_special_tokens=False)


def test_own_merges_short_and_long():
    rng = random.Random(2)
    for n in (0, 1, 5, 40, 60, 300):
        word = bytes(rng.choice(b"abcdething") for _ in range(n))
        assert VOCABULARY._short([VOCABULARY.letter[b] for b in word]) == VOCABULARY._long([VOCABULARY.letter[b] for b in word]) == VOCABULARY.merge_word(word.decode())


def test_lexicon_is_minimal_and_complete():
    words = {w.encode(): [i, i + 1] for i, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", ""])}
    lexicon = mapped(bpe.compile_lexicon(words))
    assert all(lexicon.get(w) == ids for w, ids in words.items())
    assert lexicon.get(b"ta") is None and lexicon.get(b"tapss") is None and lexicon.get(b"x") is None
    assert lexicon.find([b"tops", b"zz", b"tap"]).tolist() == [6, -1, 3] and lexicon.find([]).tolist() == []
    assert len(lexicon.final) == 7  # "", "s" shared; "t", "st", ... without repeats
    assert mapped(bpe.compile_lexicon({})).get(b"a") is None


def test_operator(spark):
    texts = [None, "", "the the of", "a<|endoftext|>b", "中文 ü", "the the of", " x  y\n z " * 3000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    for r in bpe.encode_decode(df, PATH, lexicon_words=2).collect():
        assert r.ids == REFERENCE.encode(texts[r.doc_id] or "", add_special_tokens=False).ids and r.decoded == (texts[r.doc_id] or "")
    digests = bpe.encode_digest(df, PATH, lexicon_words=3).collect()
    assert len(digests) == 7
    for r in digests:
        ids = REFERENCE.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        back = REFERENCE.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
    assert bpe.encode_digest(df.limit(0), PATH).count() == 0


def test_frequent_words(spark):
    df = spark.createDataFrame([("the the the of of a",), (None,)], "text string")
    assert bpe.frequent_words(df, size=2) == [" the", " of"] or set(bpe.frequent_words(df, size=2)) == {" the", " of"}
    assert bpe.frequent_words(df, size=0) == []
