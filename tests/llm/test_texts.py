"""Language ID, quality, HTML and Merkle fingerprints."""

import hashlib
import random
import re
import time
from html.parser import HTMLParser

import numpy as np
import pandas
import pytest

from pyspark.sql import functions as F

from corpusforge.llm import html, langid, merkle, ordinal

WORDS = {"en": "the and of that with this from they have are".split(), "de": "der und nicht eine mit auf für werden über ist".split(), "fr": "le est une dans que les pour avec été où".split()}


def corpus(n=240, seed=0):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[g]) for _ in range(rng.randint(8, 60))), g) for i in range(n) for g in [rng.choice(list(WORDS))]]


# -- language ------------------------------------------------------------------------------------------------------------
def test_language(spark):
    rows = [*corpus(), (1000, None, "en"), (1001, "12 -- 5", "de"), (1002, "", None), (1003, "the and of " * 20000, None), (1003, "the and of " * 20000, None)]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, score double")
    model = langid.train(df)
    found = langid.identify(df, model).collect()
    truth = {i: g for i, _, g in corpus()}
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 30 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    by = {r.doc_id: r for r in found}
    assert [by[k].lang_pred for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "en"]
    assert {r.doc_id for r in langid.keep_known(df, model, 0.0).collect()} >= {1003} and not {1000, 1001, 1002} & {r.doc_id for r in langid.keep_known(df, model, 0.0).collect()}


FOREIGN = [
    "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему.", "幸福的家庭都是相似的，不幸的家庭各有各的不幸。",
    "Wszystkie szczęśliwe rodziny są do siebie podobne, każda nieszczęśliwa rodzina jest nieszczęśliwa na swój sposób.",
    "Kaikki onnelliset perheet ovat toistensa kaltaisia, jokainen onneton perhe on onneton omalla tavallaan.",
    "a3f9c2e4b7d1f0a8e6c5b4d3a2f1e0d9c8b7a6f5e4d3c2b1", "xkcd qwrtz bvnmpl sdfghj zxcvb mnbvc lkjhg qwrty plmkn",
]


@pytest.mark.parametrize("labels", [1, 2, 4])
def test_unknown_languages_go_whatever_the_number_of_labels(spark, labels):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.col("lang").isin(["en", "de", "fr", "es"][:labels]))
    model = langid.train(docs)
    foreign = spark.createDataFrame([(-i, t) for i, t in enumerate(FOREIGN)], "doc_id long, text string")
    assert langid.keep_known(foreign, model, corpus_pipeline.MIN_FAMILIARITY).count() == 0
    held = docs.filter(langid.held_out(F.col("doc_id")) & F.col("text").rlike("[a-z]"))
    assert langid.keep_known(held, model, corpus_pipeline.MIN_FAMILIARITY).count() >= 0.99 * held.count() > 50


def test_language_held_out_labels_are_not_used(spark):
    import zlib

    df = spark.createDataFrame([(i, t, g if zlib.crc32(str(i).encode()) % 4 != 2 else "xx") for i, t, g in corpus()], "doc_id long, text string, lang string")
    assert langid.train(df).languages == ["de", "en", "fr"]


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.train(df) is None and langid.train(df.limit(0)) is None
    assert [(r.lang_pred, r.score) for r in langid.identify(df, None).collect()] == [("und", 0.0)]


def test_kernel_counts_shared_grams():
    a, b = langid.presence("abc abd"), langid.presence("abc xyz")
    k = langid.kernel(np.stack([a, b]).astype(np.float32), a[None].astype(np.float32), np.sqrt([a.sum()]))
    assert k[0, 0] == pytest.approx(1, abs=1e-6) and k[1, 0] == pytest.approx((a & b).sum() / np.sqrt(a.sum() * b.sum()), abs=1e-5)


def test_fit_solves_the_stated_problem():
    """Scores against a least-squares solution in the landmarks' own coefficients."""
    texts = corpus(150, 3)
    bits, names = np.stack([langid.presence(t) for _, t, _ in texts]), [g for _, _, g in texts]
    model, order, ridge = langid.fit(names, bits, landmarks=6), ["de", "en", "fr"], langid.RIDGE
    chosen = [i for g in order for i in [k for k, n in enumerate(names) if n == g][:6]]
    x = bits.astype(float)
    k = lambda a, b: (a @ b.T) / np.sqrt(np.outer(a.sum(1), b.sum(1)))
    full, marks = k(x, x[chosen]), k(x[chosen], x[chosen])
    share = np.array([len(names) / 3 / names.count(g) for g in names]) / len(names)
    target = np.array([[1.0 if g == o else -1.0 for o in order] for g in names])
    rows = np.sqrt(share)[:, None] * np.hstack([full, np.ones((len(names), 1))])
    penalty = np.sqrt(ridge) * np.hstack([np.linalg.cholesky(marks).T, np.zeros((len(chosen), 1))])
    last = np.sqrt(ridge * 1e-6) * np.eye(len(chosen) + 1)[-1:]
    solved = np.linalg.lstsq(np.vstack([rows, penalty, last]), np.vstack([np.sqrt(share)[:, None] * target, np.zeros((len(chosen) + 1, 3))]), rcond=None)[0]
    fresh = np.stack([langid.presence(t) for _, t, _ in corpus(40, 9)])
    assert model.languages == order
    assert np.allclose(model.scores(fresh), np.hstack([k(fresh.astype(float), x[chosen]), np.ones((40, 1))]) @ solved, atol=2e-3)


def test_language_of_an_empty_table(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    assert langid.identify(df.limit(0), langid.train(df)).count() == 0


# -- quality -------------------------------------------------------------------------------------------------------------
def test_quality_orders_grades(spark):
    rng = random.Random(1)
    extra = {0: ["idiot", "clown"], 1: ["%%%", "###"], 2: ["indeed", "fine"]}
    data = [(i, " ".join([*(rng.choice(WORDS["en"]) for _ in range(20)), *extra[i % 3]])) for i in range(600)]
    df = spark.createDataFrame([*data, (900, None), (901, ""), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(300)] + [(900, None), (None, 1)], "doc_id long, grade int")
    model = ordinal.train(df, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    found = {r.doc_id: r for r in ordinal.grade(df, model).collect()}
    assert len(found) == 602 and np.mean([round(found[i].expected_grade) == i % 3 for i in range(300, 600)]) > 0.97
    assert all(found[i].tail[0] >= found[i].tail[1] and found[i].expected_grade == pytest.approx(sum(found[i].tail)) for i in range(600))
    kept = {r.doc_id for r in ordinal.keep_good(df, model, 0.5).collect()}
    assert np.mean([(i in kept) == (i % 3 == 2) for i in range(300, 600)]) > 0.97


def test_quality_fit_is_the_maximum_of_the_penalised_likelihood():
    """The fit against Newton steps on numerical derivatives."""
    rng, k = np.random.default_rng(4), 4
    drawn = [np.nonzero(rng.random(k) < 0.5)[0].astype(np.int32) for _ in range(400)]
    latent = np.array([[1.5, -1.0, 0.5, 0.0][:k]] * 400) * np.array([[j in r for j in range(k)] for r in drawn])
    grades = np.digitize(latent.sum(axis=1) + rng.logistic(size=400), [-0.5, 1.0])
    seen = np.array([[float(j in r) for j in range(k)] for r in drawn])

    def loss(p):
        s, edge = seen @ p[:k], lambda t: 1 / (1 + np.exp(t - seen @ p[:k]))
        above = np.stack([np.ones(len(s)), edge(p[k]), edge(p[k + 1]), np.zeros(len(s))])
        chance = above[grades, np.arange(len(s))] - above[grades + 1, np.arange(len(s))]
        return -np.log(np.maximum(chance, 1e-12)).mean() + ordinal.L2 / 2 * (p[:k] ** 2).sum()

    p, h = np.array([0.0] * k + [-0.5, 0.5]), 1e-4
    unit = np.eye(k + 2) * h
    for _ in range(12):
        slope = np.array([(loss(p + u) - loss(p - u)) / (2 * h) for u in unit])
        bend = np.array([[(loss(p + u + v) - loss(p + u - v) - loss(p - u + v) + loss(p - u - v)) / (4 * h * h) for v in unit] for u in unit])
        p = p - np.linalg.solve(bend, slope)
    model = ordinal.fit(drawn, grades, 3)
    assert loss(np.concatenate([model.weights[:k], model.thresholds])) <= loss(p) + 1e-4
    assert np.allclose(model.weights[:k], p[:k], atol=0.05) and np.allclose(model.thresholds, p[k:], atol=0.05)


def test_quality_of_nothing_long_texts_and_clashing_names(spark):
    rated = [(i, "fine " * 8 if i % 2 else "idiot " * 8, 7) for i in range(40)]
    df = spark.createDataFrame([*rated, (99, "fine " * 400_000, 7)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(i, 1 + i % 2) for i in range(40)] + [(1, 1), (1, 2)], "doc_id long, grade int")
    model = ordinal.train(df, labels)
    found = {r.doc_id: r.expected_grade for r in ordinal.grade(df, model).collect()}
    assert len(found) == 41 and found[99] > found[0]
    assert ordinal.grade(df.limit(0), model).count() == 0 and ordinal.train(df.limit(0), labels) is None


def test_quality_without_ratings(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert ordinal.train(df, spark.createDataFrame([], "doc_id long, grade int")) is None
    r = ordinal.grade(df, None).first()
    assert r.expected_grade is None and r.tail == []
    assert ordinal.keep_good(df, None, 0.5).count() == 1


def test_label_grades(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 0), (5, None, 1), (6, 1, None)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in ordinal.label_grades(df).collect()} == {1: 2, 2: 1, 3: 0, 4: None, 5: 0, 6: 2}


# -- HTML ----------------------------------------------------------------------------------------------------------------
PAGES = [
    ("<p>one<p>two", "one\n\ntwo"),
    ("a <b> b</b>\n c<br>d", "a b c\nd"),
    ("<ul><li>a<li>b<ol><li>c</ol></ul>", "- a\n- b\n  1. c"),
    ("<ol start=4><li>a<li value=9>b<li>c</ol>", "4. a\n9. b\n10. c"),
    ("<table><tr><td>a<td>b<tr><td>long<td>c</table>", "a     b\nlong  c"),
    ("<table><caption>t</caption><tr><th colspan=2>wide head<tr><td>a<td>b</table>", "t\nwide head\na  b"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("x<script>if (a<b) '</p>'</script><style>p{}</style><!-- y -->z", "xz"),
    ("<head><title>t</title></head><body hidden>no</body>", ""),
    ("<div>a<span style='display: none'>no</span></div><div hidden>no</div><input type=hidden value=no>b", "a\nb"),
    ("<pre>a\n  b</pre>", "a\n  b"),
    ("&lt;p&gt; &amp; &eacute;&#33;", "<p> & é!"),
    ("<blockquote>a<p>b</blockquote>c", "  a\n\n  b\n\nc"),
    ("<dl><dt>t<dd>d</dl>", "t\n  d"),
    ("", ""),
    ("<", "<"),
    ("a<p", "a<p"),
    ("</p>x", "x"),
    ('<table><tr><td colspan="\u00b2" rowspan="\u00b3">a<td>b</table><ol start="--5"><li value="\u00b3">x<li value="+7">y<li>z</ol>', "a  b\n\n1. x\n7. y\n8. z"),
    ("<p title=it's>text it's", "text it's"),
    ("<p>&#" + "9" * 5000 + "; &#00065;", "\ufffd A"),
    ("\u0130\u0130<script>a</script>b", "\u0130\u0130b"),
    ("a<svg><title>no</title><path/><g><text>drawn</text>no</g></svg><math><mi>x</mi><mo>=</mo><annotation>no</annotation></math>", "a\ndrawn\nx="),
    ("<table><tr><td rowspan=0>a<td>b<tr><td>c<tr><td>d</table>", "a  b\n   c\n   d"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_html(page, text):
    assert html.to_text(page) == text


def test_html_hides_nothing_else():
    rng = random.Random(7)
    for _ in range(200):
        parts = [rng.choice(["<p>", "</p>", "<div>", "</div>", "<td>", "<tr>", "<table>", "</table>", "<li>", "<ul>", "</ul>", "<b>", "</i>", "<h1>", "</h2>", f"w{k}"]) for k in range(40)]
        shown = html.to_text(" ".join(parts)).split()
        assert sorted(w for w in shown if w[0] == "w") == sorted(p for p in parts if p[0] == "w")


def test_html_deep_and_long():
    assert html.to_text("<div>" * 5000 + "x") == "x"
    assert html.to_text("<table><tr><td>" * 300 + "x") == "x"
    assert len(html.to_text("<p>word " * 20000).split()) == 20000


HOSTILE = ['<a href="x ', "<a ", "<", "<!-- ", "a<b>b</b> ", "<div>", "</p>", "<td>x", "<option>", "<p>", "<script>", "&#9", "<tr><td colspan=1000 rowspan=0>x", "<table><tr><td>"]


@pytest.mark.parametrize("part", HOSTILE)
def test_html_takes_time_in_proportion(part):
    def seconds(size):
        page, start = "<table>" * (part[:3] == "<tr") + part * (size // len(part)), time.process_time()
        html.to_text(page)
        return time.process_time() - start

    seconds(1000)
    assert seconds(400_000) < 8 * max(seconds(100_000), 0.2)


class Words(HTMLParser):
    """Another parser: words of all text but that of elements that are not shown."""

    def __init__(self):
        super().__init__()
        self.found, self.dark = [], 0

    def handle_starttag(self, tag, attrs):
        self.dark += tag in ("script", "style", "head", "title", "template", "noscript")

    def handle_endtag(self, tag):
        self.dark -= tag in ("script", "style", "head", "title", "template", "noscript")

    def handle_data(self, data):
        if not self.dark:
            self.found += data.split()


def test_html_shows_the_words_another_parser_finds():
    pages = [p for p in pandas.read_parquet("/root/testdata/sf0.001/pages.parquet").html if p and not re.search(r"hidden|display|visibility|<(?:select|input|q|dialog|object|svg|iframe)", p)]
    assert pages
    for page in pages:
        other = Words()
        other.feed(page)
        other.close()
        shown = re.sub(r"(?m)^\s*(?:-|\d+\.) ", "", html.to_text(page))
        assert sorted("".join(shown.split())) == sorted("".join(w for w in "".join(re.sub(r"^(?:-|\d+\.)$", "", w) for w in other.found).split()))


@pytest.mark.parametrize(("page", "text"), [
    ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"), ("<ol reversed start=9><li>a<li value=4>b<li>c</ol>", "9. a\n4. b\n3. c"),
    ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"), ("<ol type=I><li>x<li value=1994>y<li value=0>z</ol>", "I. x\nMCMXCIV. y\n0. z"), ("<ol type=i><li>x<li>y</ol>", "i. x\nii. y"),
    ("<details><summary>More</summary><p>hidden</details>after", "More\nafter"), ("<details open><summary>More</summary>shown</details>", "More\nshown"), ("<details>hidden</details>x", "x"),
    ("a&nbsp;&nbsp;b  c&nbsp;", "a  b c"), ("<p>x &nbsp; y", "x   y"), ("<b>a</b>&nbsp;<i>b</i>", "a b"),
])
def test_lists_disclosures_and_fixed_blanks(page, text):
    assert html.to_text(page) == text


def test_html_operator(spark):
    df = spark.createDataFrame([(1, "u", "<p>a", "x"), (2, None, None, "x"), (3, "v", "", "x")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id, r.url, r.text, r.n_chars) for r in html.extract(df).collect() if r.url) == [(1, "u", "a", 1), (3, "v", "", 0)]
    assert html.extract(df.limit(0)).count() == 0


# -- Merkle --------------------------------------------------------------------------------------------------------------
def test_fingerprint_tree():
    a = "p1\np2\n\nq1\nq2\nq3"
    b = a.replace("q2", "Q2")
    assert merkle.fingerprint(a) == merkle.fingerprint(str(a)) != merkle.fingerprint(b)
    assert merkle.edits(merkle.fingerprint(a), merkle.fingerprint(b)) == [("removed", 1, 1), ("added", 1, 1)] and merkle.edits(merkle.fingerprint(a), merkle.fingerprint(a)) == []
    assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) == 0.8
    assert merkle.likeness(merkle.fingerprint(None), merkle.fingerprint("")) == 1.0 and merkle.likeness(merkle.fingerprint("a"), merkle.fingerprint("")) == 0.0
    assert merkle.fingerprint("a") != merkle.fingerprint("a ")


def test_edits_locate_insertions_moves_and_repeats():
    find = lambda a, b: merkle.edits(merkle.fingerprint(a), merkle.fingerprint(b))
    assert find("a\nb\nc", "a\nx\nb\nc") == [("added", 0, 1)]
    assert find("a\nb\nc\nd", "a\nc\nb\nd") == [("moved", 0, 1), ("moved", 0, 2)]
    assert find("a\na\na", "a\na") == [("removed", 0, 2)]
    assert find("", "a") == [("added", 0, 0)]


def test_leaves_lose_nothing():
    rng = random.Random(6)
    seen = {}
    for _ in range(3000):
        text = "".join(rng.choice(["a", "b. ", " ", "\n", "\n\n", "\t", "! "]) for _ in range(rng.randint(0, 8)))
        assert seen.setdefault(merkle.fingerprint(text), text) == text
    long = "word " * 400 + "end. Next one"
    assert " ".join(merkle.pieces(long)) == long and len(merkle.pieces("".join(f"w{k} " for k in range(900)))) > 20


def test_one_line_texts_keep_what_is_left():
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(600))
    assert 0.4 < merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(text[: len(text) * 2 // 3] + "x " * 300)) < 0.9


@pytest.mark.parametrize("text", ["Orre " * 6000, "x" * 30_000, "語" * 9000, "ab" * 2000 + " c" * 3000, "Das " * 200])
def test_leaves_are_bounded_whatever_a_text_repeats(text):
    parts = merkle.pieces(text)
    assert max(map(len, parts)) < 2 * merkle.LONGEST + 2
    whole = "".join(p[1:] if p.startswith(merkle.GLUE) else " " + p for p in parts)[1:]
    assert whole == text
    kept = text[: len(text) - len(text) // 3]
    assert merkle.likeness(merkle.fingerprint(text), merkle.fingerprint(kept + "Ein Satz. " * (len(text) // 30))) > 0.5


def test_cuts_within_words_are_told_from_blanks():
    word = "y" * 500
    first, second, *_ = merkle.pieces(word)
    assert second.startswith(merkle.GLUE) and merkle.fingerprint(word) != merkle.fingerprint(first + " " + word[len(first) :])


def test_many_rows_without_id_are_many_ranges(spark):
    texts = [f"text number {k} " * 3 for k in range(300)]
    df = spark.createDataFrame([(None if k % 2 else k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    ranges = merkle.with_next(df, "doc_id", "text").filter("not extra").groupBy("range").count().collect()
    assert len(ranges) > 12 and max(r["count"] for r in ranges) < 100
    hashes = {r.text: r.h for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(((k if k % 2 == 0 else None), t) for k, t in enumerate(texts) if k % 2 == 0)[::-1] + [(None, t) for t in sorted((t for k, t in enumerate(texts) if k % 2), key=hashes.get)]
    expected = []
    for (_, a), (_, b) in zip(order, order[1:] + order[:1]):
        k = len(a) // 3
        expected.append(hashlib.sha256((a[: len(a) - k] + b[:k]).encode()).hexdigest())
    assert sorted(r.edited_sha256 for r in merkle.edit_report(df).collect()) == sorted(expected)


@pytest.mark.parametrize("literal", [1024, 2])
@pytest.mark.parametrize("ids", [[1], [3, 9, 4, 100, -5], [7, 7, 2], list(range(0, 4000, 7)), [None, 4, None, 2]])
def test_edit_report(spark, ids, literal, monkeypatch):
    monkeypatch.setattr(merkle, "LITERAL_BOUNDS", literal)
    rng = random.Random(len(ids))
    texts = [rng.choice([None, "", "é\nb\n\nc" * rng.randint(1, 9), "x" * rng.randint(0, 50)]) for _ in ids]
    if len(set(ids)) < len(ids):
        texts = ["same text"] * len(ids)
    df = spark.createDataFrame([(i, t, 0) for i, t in zip(ids, texts)], "doc_id long, text string, n_chars int")
    found = merkle.edit_report(df).collect()
    order = sorted(zip(ids, texts), key=lambda x: -(1 << 63) if x[0] is None else x[0], reverse=True)
    expected = []
    for (i, a), (_, b) in zip(order, order[1:] + order[:1]):
        a, b = a or "", b or ""
        k = len(a) // 3
        edited = a[: len(a) - k] + b[:k]
        fa, fe = merkle.fingerprint(a), merkle.fingerprint(edited)
        expected.append((i, len(a), hashlib.sha256(edited.encode()).hexdigest(), fa, fe, merkle.likeness(fa, fe), merkle.likeness(fa, merkle.fingerprint(b)), len(merkle.edits(fa, fe))))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_edit_report_of_nothing(spark):
    assert merkle.edit_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
