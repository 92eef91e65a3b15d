"""Best-fit decreasing against a plain version, and the pieces of real texts."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpusforge.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain(lengths, window):
    """Best-fit decreasing item by item: the multiset of the windows' contents."""
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [b for b in bins if sum(b) + x <= window]
        if fit:
            max(fit, key=sum).append(x)
        else:
            bins.append([x])
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rng = random.Random(seed)
    window = rng.choice([8, 16, 64])
    lengths = [rng.randint(1, window - 1) for _ in range(rng.randint(0, 200))]
    runs, opened = packing.plan(Counter(lengths), window)
    content = [[] for _ in range(opened)]
    seen = Counter()
    for length, rank, n, first, each, offset in runs:
        assert rank == seen[length]
        seen[length] += n
        for k in range(n):
            content[first + k // each].append((offset + k % each * length, length))
    assert seen == Counter(lengths)
    for c in content:
        at = 0
        for offset, length in sorted(c):
            assert offset == at
            at += length
        assert at <= window
    expected = plain(lengths, window)
    assert opened == len(expected) and Counter(sum(b) for b in expected) == Counter(sum(x for _, x in c) for c in content)


def test_tree():
    tree = packing.CapacityTree(16)
    assert tree.tightest(1) is None
    tree.add(5, 1)
    tree.add(9, 2)
    assert [tree.tightest(k) for k in (1, 5, 6, 9, 10)] == [5, 5, 9, 9, None]
    tree.add(5, -1)
    assert tree.tightest(1) == 9


def test_operator(spark):
    rng = random.Random(3)
    texts = {0: None, 1: "", 2: "word " * 5000, 3: "tie", 4: "tie", 5: "tie", **{k: "word " * rng.randint(1, 1500) for k in range(6, 60)}}
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "doc_id long, text string, length int")
    rows = packing.pack(df, PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    for k, t in texts.items():
        ids, at = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted((r for r in rows if r.doc_id == k), key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for c in by.values():
        at = 0
        for offset, length in sorted(c):
            assert offset == at
            at += length
        assert at <= 1024
    assert sorted(by) == list(range(len(by)))
    assert packing.pack(df.limit(0), PATH).count() == 0
