"""Placement, balance and movement of the hash tree."""

import hashlib
import math
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from corpusforge.llm import sharding


def place(spark, leaves, n=4000):
    return {r.id: r.s for r in spark.range(n).select("id", sharding.descend(F.col("id"), leaves).alias("s")).collect()}


def test_law(spark):
    texts = {0: None, 1: "", 2: "é", **{k: "t" * k for k in range(3, 300)}}
    df = spark.createDataFrame([(k, t, 9) for k, t in texts.items()], "doc_id long, text string, size int")
    rows = sharding.shard(df, sharding.topology(8), sharding.topology(9)).collect()
    assert len(rows) == 300
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key") and r.grown_shard in (r.shard, 8)
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), (5, "c"), (5, "c")], "doc_id long, text string")
    rows = sharding.shard(df, sharding.topology(8)).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4 and all(r.grown_shard is None for r in rows)
    assert sharding.shard(df.limit(0), sharding.topology(8)).count() == 0


def test_weights_share_and_confine_movement(spark):
    leaves = [sharding.Leaf("a", "a1", 0), sharding.Leaf("a", "a2", 1), sharding.Leaf("b", "b1", 2, 2.0), sharding.Leaf("b", "b2", 3)]
    before = place(spark, leaves)
    n = [sum(s == k for s in before.values()) for k in range(4)]
    assert abs(n[2] - 1600) < 160 and all(abs(n[k] - 800) < 130 for k in (0, 1, 3))
    after = place(spark, [*leaves[:3], sharding.Leaf("b", "b2", 3, 0.5)])  # b loses weight: rows leave b, or move within it
    assert all(before[k] in (2, 3) for k in before if before[k] != after[k])


def test_every_growth_past_the_first_layout(spark):
    for n in range(8, 12):
        a, b = place(spark, sharding.topology(n), 1500), place(spark, sharding.topology(n + 1), 1500)
        assert all(b[k] in (a[k], n) for k in a) and n in b.values()


def test_no_python_in_the_plan(spark):
    df = sharding.shard(spark.createDataFrame([(1, "a")], "doc_id long, text string"), sharding.topology(8), sharding.topology(9))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def draw(name, key):
    u = (int(hashlib.md5(f"{name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    return -math.log(u)


def plain(key, leaves):
    """The shard of a key, level by level in plain Python."""
    here = [((x.region, f"{x.region}/{x.rack}", f"{x.region}/{x.rack}/{x.shard}"), x) for x in leaves]
    for level in range(3):
        weight = defaultdict(float)
        for names, x in here:
            weight[names[level]] += x.weight
        best = min(weight, key=lambda n: (draw(n, key) / weight[n], n))
        here = [h for h in here if h[0][level] == best]
    return here[0][1].shard


def test_like_a_plain_descent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    eight, nine = sharding.topology(8), sharding.topology(9)
    rows = sharding.shard(docs, eight, nine).collect()
    assert len(rows) == docs.count()
    assert all((r.shard, r.grown_shard) == (plain(r.doc_id, eight), plain(r.doc_id, nine)) for r in rows)
    uneven = [sharding.Leaf("a", "r", 0, 3.0), sharding.Leaf("a", "r", 1), sharding.Leaf("a", "q", 2, 0.5), sharding.Leaf("b", "r", 3)]
    assert place(spark, uneven, 500) == {k: plain(k, uneven) for k in range(500)}


def test_a_very_long_text_and_nothing(spark):
    df = spark.createDataFrame([(1, "é" * 3_000_000), (2, None)], "doc_id long, text string")
    found = {r.doc_id: r for r in sharding.shard(df, sharding.topology(8)).collect()}
    assert found[1]["size"] == 6_000_001 and found[1].text_crc32 == zlib.crc32(("é" * 3_000_000).encode()) and (found[2]["size"], found[2].text_crc32) == (1, 0)
