"""Findings of the fourth round."""

import random
from collections import Counter
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.parquet as pq

from corpusforge.operators import linkage
from corpusforge.operators.components import connected_components
from corpusforge.plans import linking


# -- F2 ---------------------------------------------------------------------------------------------------------------------
def grams(w):
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def plain_fold(rows):
    gone = {}
    for a, x, s in rows:
        for b, y, r in rows:
            if a >= b or a in gone or b in gone:
                continue
            n, c, d = min(len(x), len(y)), [len(w) % 12 for w in x], [len(w) % 12 for w in y]
            near = len(grams(x) & grams(y)) >= 3 and (Counter(x) & Counter(y)).total() * 10 > n * 8
            if near and n >= 4 and c[:n] == d[:n] and SequenceMatcher(None, " ".join(x), " ".join(y), autojunk=False).ratio() > 0.9:
                gone.update({a: b} if r is not None and s is not None and r < s else {b: a})
    return sorted(gone.items())


def test_readings_of_any_number_of_documents(spark, tmp_path):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abcdef") for _ in range(n))
    bases = [[word(rng.choice([1, 2, 3, 4, 5, 13])) for _ in range(n)] for n in (5, 7, 8, 12, 23, 24, 40, 90)] + [["la"] * 30]
    texts = []
    for base in bases:
        for _ in range(30):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                at = rng.randrange(len(w))
                w[at] = word(len(w[at]) if rng.random() < 0.9 else 6)
            texts.append(w + [word(3) for _ in range(rng.choice([0, 0, 0, 1, 3]))])
    rng.shuffle(texts)
    rows = [(k, w, rng.choice([None, "s1", "s2", "s3"])) for k, w in enumerate(texts)] + [(900 + k, ["one", "two", "three", "four", "five", "six", "seven", "eight"], "s1") for k in range(12)]
    documents = pa.table({"doc_id": pa.array([k for k, _, _ in rows], pa.int64()), "text": [" ".join(w) for _, w, _ in rows], "source": [s for _, _, s in rows]})
    pq.write_table(documents, tmp_path / "documents.parquet")
    found = sorted(tuple(r) for r in linking.merge_same_reading(spark, str(tmp_path)).collect())
    assert found == plain_fold(rows)
    assert (911, 900) in found and len({d for d, _ in found}) == len(found)  # twelve documents of every n-gram: more than a block held


# -- F1 ---------------------------------------------------------------------------------------------------------------------
def soup(rng, n):
    syllables = ["the", "an", "er", "ou", "ing", "th", "re", "bl", "st", "ion", "qu", "ja", "vex", "zo"]
    return "".join(rng.choices(syllables, weights=[9] * 10 + [1] * 4, k=n))


def test_contents_of_one_title_are_found_by_their_runs(monkeypatch):
    rng = random.Random(6)
    bases = [soup(rng, rng.randrange(60, 400)) for _ in range(40)] + [soup(rng, 20) for _ in range(8)] + ["", "the"]
    texts = []
    for k in range(260):
        t = rng.choice(bases) if k % 2 else soup(rng, rng.randrange(70, 300))
        at = rng.randrange(len(t) + 1)
        texts.append(t[:at] + soup(rng, rng.randrange(0, 60)) * (k % 3 > 0) + t[at + rng.randrange(40) :])
    names, expected = {}, []
    for t in texts:  # the first content that is alike, difflib's own ratio
        order = [c for c in names if SequenceMatcher(None, t, c).ratio() >= 0.5 and not (t == c == texts[0] == "")]
        names.setdefault(t, len(names)) if not order else None
        expected.append(names[order[0] if order else t])
    aligned, ratio = [], linkage.aligned_ratio
    monkeypatch.setattr(linkage, "aligned_ratio", lambda a, b, *rest: (aligned.append(a), ratio(a, b, *rest))[1])
    slots = linkage.Slots(0.93, 0.5, frozenset())
    assert [("#2" in (n := slots.place(i, "song", t))) + n.count("'") for i, t in enumerate(texts)] == expected
    assert len(aligned) < 0.1 * len(texts) * len(slots.names)  # before, a tenth of all pairs passed and the first slot's content was always aligned


def test_titles_of_one_kind_are_aligned_a_few_times(spark, monkeypatch):
    rng = random.Random(8)
    base = soup(rng, 40)
    titles = [base] + [base[:at] + rng.choice("qzx") * rng.randrange(1, 4) + base[at + rng.randrange(4) :] for at in rng.sample(range(len(base)), 45)]
    titles += [soup(rng, 40) for _ in range(12)]
    df = spark.createDataFrame([(t,) for t in titles], "x string")
    pairs = {(r.q, r.k) for r in linkage.close_pairs(df, df, 0.93).collect()}
    assert pairs == {(q, k) for q in titles for k in titles if q != k and SequenceMatcher(None, k, q, autojunk=False).ratio() >= 0.93} and len(pairs) > 500
    links = linkage.close_links(df, df, 0.93).collect()
    assert len(links) < len(pairs) / 4
    node = {r.x: r.h for r in df.selectExpr("x", "xxhash64(x) h").collect()}
    joined = lambda edges: {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert joined([(node[q], node[k]) for q, k in pairs]) == joined([(r.a, r.b) for r in links])
    aligned, ratio = [], linkage.aligned_ratio
    monkeypatch.setattr(linkage, "aligned_ratio", lambda a, b, *rest: (aligned.append(a), ratio(a, b, *rest))[1])
    slots, plain = linkage.Slots(0.93, 0.5, frozenset()), []
    for i, t in enumerate(titles):
        near = max([(r, s) for s in plain if (r := SequenceMatcher(None, s, t).ratio()) >= 0.93], default=(0, t))[1]
        assert slots.closest(t) == near
        slots.place(i, t, "")
        plain.append(t)
    assert len(aligned) < len(plain) ** 2 / 8  # before, every pair
