"""Inputs on which queries failed or differed from their SQL."""

import random
import time
from collections import Counter
from difflib import SequenceMatcher

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from corpusforge import catalog
from corpusforge.functions import text as T
from corpusforge.operators import folds, lexicon, linkage, songs
from corpusforge.session import dealt

from test_entry import plain


def same_as_sql(spark, folder, name, **tables):
    """The query's rows over the tables (columns by name) are those of its SQL."""
    duck = duckdb.connect()
    for t, columns in tables.items():
        pq.write_table(pa.table(columns), f"{folder}/{t}.parquet")
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = catalog.queries()[name](spark, str(folder))
    found = duck.execute(catalog.oracle_sql()[name])
    rows = plain(found.fetchall(), [d[0] for d in found.description])
    assert plain(df.collect(), df.columns) == rows
    return rows


def documents(texts):
    n = len(texts)
    return {"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts, pa.string()), "lang": ["en", "de"] * (n // 2) + ["fr"] * (n % 2), "source": [f"src{k % 3}" for k in range(n)], "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}


# -- F3 ---------------------------------------------------------------------------------------------------------------------
def test_more_variants_than_numerals(spark, tmp_path):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    chain = [" ".join(words[6 * k : 6 * k + 40]) for k in range(20)]
    rows = same_as_sql(spark, tmp_path, "merge_build", documents=documents([*chain, "Alone here", "And alone too", None]))
    assert any("None" in r for r in rows)


# -- F5 ---------------------------------------------------------------------------------------------------------------------
def test_capitals_of_one_letter(spark, tmp_path):
    texts = ["Erßie entech erein w weiß", "ßa ŉb ǰc ﬁn ᾳw und so weiter bis hier"]
    same_as_sql(spark, tmp_path, "numbered_books", benchmark={"item_id": pa.array([0, 1], pa.int64()), "text": texts})


def test_capitals_as_in_sql(spark):
    letters = "".join(c for c in map(chr, range(0x20, 0x180)) if c.isalpha())
    found = spark.createDataFrame([(letters,)], "x string").select(T.upper_letters(F.col("x"))).first()[0]
    assert found == duckdb.connect().execute("SELECT upper(?)", [letters]).fetchone()[0]


# -- F10 to F19, F22, F7 ----------------------------------------------------------------------------------------------------
def test_grams_move_once_and_words_of_pairs_are_not_rows(spark):
    texts = [(k, [f"w{j}" for j in range(k, k + 40)]) for k in range(12)]
    docs = spark.createDataFrame(texts, "doc_id long, words array<string>")
    pairs = linkage.candidate_pairs(docs)
    plan = pairs._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Generate explode") <= 2  # the grams and the second ends of pairs; before, the grams twice
    scored = linkage.containment(pairs, docs)
    assert "Generate explode(words" not in scored._jdf.queryExecution().optimizedPlan().toString()
    at = dict(texts)
    blocks = {}
    for k, w in texts:
        for i in range(len(w) - 4):
            blocks.setdefault(tuple(w[i : i + 5]), []).append(k)
    shared = Counter((a, b) for ids in blocks.values() if 2 <= len(ids) <= 8 for a in ids for b in ids if a < b)
    want = sorted((a, b, n, len(set(at[a]) & set(at[b])), 40) for (a, b), n in shared.items() if n >= 3)
    assert sorted(tuple(r) for r in scored.select("a", "b", "shared", "inter", "least").collect()) == want and want


# -- F6, F9 -----------------------------------------------------------------------------------------------------------------
def test_lines_are_cut_alike_by_pieces_and_by_words(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abä𝒳\r") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 11, 14])))
    lines = ["", " ", "a", "a b ", " a b", *(rng.choice(["", "", "", " "]) + rng.choice([" ", " ", " ", "  "]).join(word() for _ in range(rng.randrange(1, 30))) for _ in range(600))]
    df = spark.createDataFrame([(x,) for x in lines], "x string")
    for width in (3, 9, 12, 40):
        both = df.select("x", folds.laid_out(F.col("x"), width).alias("p"), folds._laid_out_by_words(F.col("x"), width).alias("w")).collect()
        assert [(r.x, r.p) for r in both] == [(r.x, r.w) for r in both]
    # words one blank apart are not folded one by one: the line's pieces are
    long = spark.range(1).select(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(30000)), lambda i: F.lit("abcd")), " ").alias("x"))
    assert long.select(F.size(folds.laid_out(F.col("x"), 40))).first()[0] == 4286


# -- F4 ---------------------------------------------------------------------------------------------------------------------
def test_names_of_one_pattern_meet_by_what_is_left(spark):
    rng = random.Random(3)
    mixed = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 31))) for _ in range(150)]
    mixed += [x[:3] + x[4:] for x in mixed[:60]] + [x + "b" for x in mixed[60:90]]
    left, right = mixed[:150], mixed[150:]
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "key string")
    for cutoff in (0.75, 0.92):
        want = {(a, b) for a in left for b in right if a != b and SequenceMatcher(None, b, a, autojunk=False).ratio() >= cutoff}
        found = linkage.close_pairs(frame(left), frame(right), cutoff).collect()
        assert {(r.q, r.k) for r in found} == want and want
    names = [f"supplier{i:09d}" for i in range(300)]
    q, k = frame([n[:-1] for n in names]), frame(names)
    lengths = [df.select(F.col("key").alias("x"), F.xxhash64("key").alias("id"), F.length("key").alias("n")).distinct() for df in (q, k)]
    near, far = linkage.near_lengths(*lengths, 0.92)
    assert (near, far) == ([(16, 17, 0, 1)], [])  # before, all 30 * 300 pairs were candidates
    assert linkage.meet_near(*lengths, near).count() < 30 * 300 / 3


# -- F8 ---------------------------------------------------------------------------------------------------------------------
def test_margin_is_found_once(spark):
    n = 20000
    lines = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.repeat(F.lit(" "), (i % 3 + 2).cast("int")), F.lit("x")))
    began = time.monotonic()
    found = spark.range(1).select(T.dedent(lines).alias("l")).first().l
    assert found == [" " * ((i + 1) % 3) + "x" for i in range(n)]
    assert time.monotonic() - began < 30  # a margin for every line is 400 million steps


# -- F1 ---------------------------------------------------------------------------------------------------------------------
def test_bounds_of_alignment_hold():
    rng = random.Random(5)
    words = ["".join(rng.choice("eeetaoinshr" + "bcdfglmpuvwxyzjkq") for _ in range(rng.randrange(1, 8))) for _ in range(60)]
    for _ in range(250):
        a = "".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))
        b = "".join(rng.choice([c, c, c, c, c, c, "", rng.choice("abcz")]) for c in a) if rng.random() < 0.6 else a[: rng.randrange(30)] + "".join(rng.choice(words) for _ in range(rng.randrange(1, 120)))
        for junk in (False, True):
            want = SequenceMatcher(None, a, b, autojunk=junk).ratio()
            for above in (0.0, 0.3, 0.5, 0.85, 0.93):
                assert (found := linkage.aligned_ratio(a, b, above, junk)) == want or max(found, want) <= above
        chain = linkage.Chain(0.5, True)
        chain.add(b)
        assert SequenceMatcher(None, a, b).ratio() < 0.5 or list(chain.likely(a)) == [0]


def test_contents_of_one_title_are_not_all_aligned(monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choice("eeetaoinshrdlucmfwypvbgkqjxz") for _ in range(rng.randrange(2, 7))) for _ in range(400)]
    contents = ["".join(rng.choice(words) for _ in range(120)) for _ in range(80)]
    seen, slots, taken = [], linkage.Slots(0.93, 0.5, frozenset()), []
    monkeypatch.setattr(linkage, "aligned_ratio", lambda *x, f=linkage.aligned_ratio: seen.append(x) or f(*x))
    names = [slots.place(i, "title", c) for i, c in enumerate(contents)]
    assert names[:3] == ["title", "title#2", "title#2'"] and len(set(names)) == 80
    assert len(seen) < 80 * 79 / 4  # before, each content with all before it


def test_long_strings_are_not_broadcast(spark):
    left = spark.createDataFrame([(f"{i:03d}" * 30,) for i in range(50)], "key string")
    plan = linkage.close_pairs(left, left, 0.93)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "piece" not in plan  # before, all windows of all strings were rows, which planners take for few


# -- F20 --------------------------------------------------------------------------------------------------------------------
def test_restored_counts_like_rows(spark):
    rng = random.Random(9)
    pool = ["más", "mas", "años", "anos", "que", "él", "el", "straße", "où", "ou", "x1"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 40))) for _ in range(60)]
    tokens = lexicon.tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    dictionary = spark.createDataFrame([("mas", "más"), ("mas", "mas"), ("que", "que"), ("straße", "straße"), ("el", "él"), ("el", "el")], "k string, form string")
    rows = lexicon.restore(tokens.withColumn("truth", F.col("form")), tokens, dictionary, ["truth"]).collect()
    want = {(o, sum(r.outcome == o for r in rows), sum(r.outcome == o and r.form == r.truth for r in rows)) for o in {r.outcome for r in rows}}
    found = lexicon.restored_counts(tokens, lexicon.priors(tokens), dictionary).collect()
    assert {tuple(r) for r in found} == want and {o for o, _, _ in want} >= {"unique", "ambiguous"}


# -- F25 --------------------------------------------------------------------------------------------------------------------
def test_parts_grow_in_number_not_in_size(spark, tmp_path):
    texts = ["".join(random.Random(k).choices("abcdefgh ", k=4000)) for k in range(64)]
    pq.write_table(pa.table({"doc_id": pa.array(range(64), pa.int64()), "text": texts}), tmp_path / "t.parquet", compression="none")
    df = spark.read.parquet(str(tmp_path / "t.parquet"))
    assert dealt(df, "doc_id").rdd.getNumPartitions() == 4
    assert dealt(df, "doc_id", 1 << 14).rdd.getNumPartitions() >= 14  # before, one file of one row group was one task


# -- F2 ---------------------------------------------------------------------------------------------------------------------
def test_long_texts_are_aligned_without_a_table():
    rng = random.Random(11)
    text = "".join(rng.choice("abcdefgh ") for _ in range(60000))
    other = text[:20000] + "".join(rng.choice("abcdefgh ") for _ in range(3000)) + text[21000:]
    began = time.monotonic()
    found = linkage.aligned_ratio(other, text, 0.55)
    assert 0.95 < found < 1 and time.monotonic() - began < 20  # a table of common runs has 3,700 million places
    for _ in range(200):
        x = "".join(rng.choice("ab c"[: rng.randrange(1, 5)]) for _ in range(rng.choice([2, 30, 300])))
        y = "".join(rng.choice("abcd") if rng.random() < 0.2 else c for c in x)[rng.randrange(5) :]
        assert linkage.aligned_ratio(x, y) == SequenceMatcher(None, x, y, autojunk=False).ratio()
        i, j, size = SequenceMatcher(None, x, y, autojunk=False).find_longest_match()
        runs = linkage._Runs(*(linkage.np.array([ord(c) % 101 for c in t], int) for t in (x, y)), 101)
        assert y == "" or runs.longest(0, len(x), 0, len(y), len(x)) == linkage._longest_run(runs.x, runs.y, 0, len(x), 0, len(y)) == (size, i, j)


# -- F24 --------------------------------------------------------------------------------------------------------------------
def test_inline_tokens_fold_lengths_alone(spark):
    text = "a [C]b ^ [x] [(G)][riff] [No Chord]] [[Am] [solo"
    df = spark.createDataFrame([(text,), ("",), (None,)], "x string").select("x", songs.inline_tokens(F.col("x")).alias("t"))
    assert [(t.col, t.label) for t in df.collect()[0].t] == [(2, "C"), (4, "/"), (9, "(G)"), (9, "riff"), (10, "N.C."), (13, "Am")]
    assert [r.t for r in df.collect()[1:]] == [[], []]
    folded = df.select("t")._jdf.queryExecution().optimizedPlan().toString()
    assert folded.count("RLIKE") + folded.count("rlike") >= 1 and "gap" not in folded  # before, gaps and labels went through the fold


# -- F23 --------------------------------------------------------------------------------------------------------------------
def test_songs_are_aligned_after_one_shuffle_of_texts(spark, tmp_path):
    texts = [f"{k}. One verse, another verse. And more,\n  R: of it all" for k in range(50)]
    pq.write_table(pa.table({"doc_id": pa.array(range(50), pa.int64()), "text": texts}), tmp_path / "documents.parquet")
    df = catalog.queries()["aligned_songs"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan  # before, rows were shuffled into parts as large as the planner likes
