"""SimHash groups and repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpusforge.llm import simhash, suffix


# -- SimHash -------------------------------------------------------------------------------------------------------------
def plain_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    found = [b" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in found) for b in range(64)]
    return sum(1 << b for b in range(64) if found and bits[b] * 2 > len(found))


def plain_groups(ids, fps, radius):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if bin(fps[a] ^ fps[b]).count("1") <= radius and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def family(rng, n, size=400, edits=2):
    base = [f"w{rng.randrange(9000)}" for _ in range(size)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(size)] = f"v{rng.randrange(9000)}"
        out.append(" ".join(copy))
    return out


def test_near_duplicates(spark):
    rng = random.Random(4)
    texts = [*family(rng, 25), *family(rng, 10), *[" ".join(f"u{rng.randrange(9999)}" for _ in range(rng.randint(0, 60))) for _ in range(40)], None, "", " \t", "A b", "a B", "one", "Straße ÉÉ", "x " * 30000]
    ids = rng.sample(range(1000), len(texts))
    df = spark.createDataFrame([(i, t, "n") for i, t in zip(ids, texts)], "doc_id long, text string, component_id string")
    found = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    fps = {i: plain_fingerprint(t, 3) for i, t in zip(ids, texts)}
    label = plain_groups(ids, fps, 3)
    assert {i: (found[i].fingerprint, found[i].component_id) for i in ids} == {i: (f"{fps[i]:016x}", label[i]) for i in ids}
    assert len(set(label.values())) < len(ids) - 20


def test_many_tiles_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    rng = random.Random(9)
    df = spark.createDataFrame(list(enumerate(family(rng, 60, 300, 3))), "doc_id long, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(df, radius=6).collect()}
    label = plain_groups(list(found), {i: int(r.fingerprint, 16) for i, r in found.items()}, 6)
    assert {i: r.component_id for i, r in found.items()} == label


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "zz")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in simhash.near_duplicates(df).collect()) == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_long_fingerprints_follow_similarity():
    rng = random.Random(6)
    words = [f"w{rng.randrange(5000)}" for _ in range(600)]

    def distance(edits):
        copy = list(words)
        for k in range(edits):
            copy[k * (600 // max(edits, 1))] = f"x{k}"
        a, b = (np.frombuffer(simhash.fingerprint(" ".join(w), 5, 16)[0], np.uint8) for w in (words, copy))
        return int(np.bitwise_count(a ^ b).sum())

    near, far = distance(8), distance(40)  # similarities of 0.87 and 0.5
    assert distance(0) == 0 and near < 176 < far


# -- suffixes ------------------------------------------------------------------------------------------------------------
def plain_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[k : k + length] for d in data for k in range(len(d) - length + 1))
    out = []
    for d in data:
        mask = np.zeros(len(d) + 1, np.int8)
        for k in range(len(d) - length + 1):
            if count[d[k : k + length]] > 1:
                mask[k : k + length] = 1
        kept = bytes(np.frombuffer(d, np.uint8)[mask[: len(d)] == 0])
        out.append((len(d), int(mask.sum()), int((np.diff(np.concatenate([[0], mask])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def texts_with_repeats(rng, length):
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(2, 9)))
    passages = ["".join(word() for _ in range(40))[: length + extra] for extra in (-1, 0, 1, 37, 150, 400)]
    out = [" ".join(rng.choice(passages) if rng.random() < 0.2 else word() for _ in range(rng.randint(0, 60))) for _ in range(40)]
    copy = out[0] + "!" * 5
    return [*out, None, "", "a" * (length - 1), "a" * length, "a" * (length + 5), "b" * (3 * length), copy, copy, out[1][3:], *(out[2][:k] + "#" + out[2][k:] for k in (100, 300))]


@pytest.mark.parametrize(("length", "group"), [(200, 2_000), (60, 2_000), (60, 1), (200, 1), (40, 2)])
def test_remove_repeats(spark, length, group):
    texts = texts_with_repeats(random.Random(length + group), length)
    df = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(df, length=length, group=group, digest=True).collect()}
    assert [found[i * 3] for i in range(len(texts))] == plain_repeats(texts, length)


def test_segments_of_a_long_text(spark, monkeypatch):
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(900))
    long = "".join(rng.choice("ijklmnop ") for _ in range(30_000))
    texts = [long[:15_000] + passage + long[15_000:], passage, long[20_000:21_000]]
    monkeypatch.setattr(suffix, "SEGMENT", 1000)
    rows = [x for t in texts for x in suffix.anchors(t.encode(), 200)]
    assert all((0 <= last - first).all() and (last - first < 200).all() for _, _, first, last in rows)
    monkeypatch.undo()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.remove_repeats(df, digest=True).collect()}
    assert [found[i] for i in range(3)] == plain_repeats(texts, 200)


def test_repeats_edges(spark):
    t = "".join(random.Random(1).choice("abcdef") for _ in range(300))
    df = spark.createDataFrame([(None, t), (1, t), (1, t), (None, "é" * 120), (2, "short")], "doc_id long, text string")
    found = sorted((str(r.doc_id), r.n_removed) for r in suffix.remove_repeats(df, carry=["text"]).collect())
    assert found == [("1", 300), ("1", 300), ("2", 0), ("None", 240), ("None", 300)]
    assert suffix.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_suffix_sorting(seed):
    rng, length = random.Random(seed), 40
    parts = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 90))) for _ in range(8)]
    data = "".join(rng.choice(parts) for _ in range(30)).encode()
    text = np.frombuffer(data, np.uint8)
    starts = np.arange(len(data) - length + 1)
    count = Counter(data[k : k + length] for k in starts)
    assert suffix.repeated_starts(text, starts, length).tolist() == [count[data[k : k + length]] > 1 for k in starts]


def test_cover_meets_every_pair():
    d, p = suffix.distances(), suffix.PERIOD
    assert all((r + d[r * p + s]) % p in suffix.COVER and (s + d[r * p + s]) % p in suffix.COVER for r in range(p) for s in range(p))


@pytest.mark.parametrize("seed", range(6))
def test_merged_order_is_the_order_of_suffixes(seed):
    rng = random.Random(seed)
    data = "".join(rng.choice(["a" * 20, "ab", "b" * 15, "abcab"]) for _ in range(60)).encode()
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(40, np.uint8)]).astype(np.uint64)
    words = sum(padded[k : len(padded) - 7 + k] << np.uint64(56 - 8 * k) for k in range(8))
    heads = sorted({data[k : k + 13] for k in range(len(data) - 13)})
    at = np.array(sorted((k for k in range(len(data) - 13)), key=lambda k: heads.index(data[k : k + 13])))
    group = np.array([heads.index(data[k : k + 13]) for k in at])
    order = suffix.merged_order(at, group, suffix.cover_ranks(words, len(data), len(data)))
    assert at[order].tolist() == sorted(range(len(data) - 13), key=lambda k: data[k:])


# -- similar documents ---------------------------------------------------------------------------------------------------
def similar_texts():
    """Texts of 100 shingles of five words and their edits: a changed word at the end costs one shingle, further ones in a row one each."""
    rng = random.Random(8)
    out = []
    for _ in range(12):
        words = [f"w{rng.randrange(99999)}" for _ in range(104)]
        out += [" ".join(words)] + [" ".join([*words[: 104 - k], *(f"x{rng.randrange(99999)}" for _ in range(k))]) for k in (9, 10, 11, 12, 14, 18)]
    return out + [f"a b c d e f g h{x}" for x in ("", " i", " j k")] + [None, "", "one two", "ONE two", "one two three"]


def plain_components(texts, least=0.8):
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()) for w in ((t or "").lower().split() for t in texts)]
    alike = lambda x, y: x == y or len(x & y) >= least * len(x | y) > 0
    label = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and alike(x, sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if v == b else v for v in label]
    return label


@pytest.mark.parametrize("chunk", [512, 4])
def test_similar_documents_by_their_shingles(spark, monkeypatch, chunk):
    import corpus_pipeline as p

    monkeypatch.setattr(simhash, "SETS", chunk)
    texts = similar_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.similar_documents(df, "doc_id", "text", p.SHINGLE, p.WORDS, p.NEAR_RADIUS, p.LEAD_RADIUS, p.LEAD, *p.SIMILARITY)
    assert {r.doc_id: r.component_id for r in found.collect()} == dict(enumerate(plain_components(texts)))


def test_verify_counts_common_elements():
    rng = np.random.default_rng(1)
    sets = [np.unique(np.concatenate([np.arange(40) + 50 * (k % 3), rng.integers(1000, 9999, rng.integers(0, 12))]).astype(np.uint64)) for k in range(40)]
    linked = {(i, j) for i in range(40) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) * 5 >= 4 * len(np.union1d(sets[i], sets[j]))}
    for left, right in ((sets, None), (sets[:15], sets[15:])):
        edges = linked if right is None else {(i, j) for i, j in linked if i >= 15 > j}
        found = simhash.verify(left, right, 4, 5)
        assert all((max(e), min(e)) in edges for e in found)
        label = list(range(40))
        for i, j in found:
            a, b = sorted((label[i], label[j]))
            label = [a if v == b else v for v in label]
        assert all(label[i] == label[j] for i, j in edges)


def test_pipeline_keeps_documents_below_the_similarity(spark):
    """Radius 176 linked pairs of similarity 0.75 and missed sets of 4 and 5 shingles."""
    import corpus_pipeline as p

    texts = similar_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    label = plain_components(texts)
    assert sorted(r.doc_id for r in p.near_dedup(spark, df, None).collect()) == [i for i, v in enumerate(label) if i == v]


def test_repeated_passages_do_not_move_long_fingerprints():
    rng = random.Random(9)
    words = [f"w{rng.randrange(99999)}" for _ in range(200)]
    line = [f"v{rng.randrange(99999)}" for _ in range(20)]
    once, often = (" ".join(words + line * n) for n in (2, 9))  # the same set of shingles
    assert simhash.fingerprint(once, 5, 16) == simhash.fingerprint(often, 5, 16) and simhash.fingerprint(once, 3) != simhash.fingerprint(often, 3)
