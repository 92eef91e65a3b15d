"""Queries on ordered rows: runs, islands, pairs, gaps, splits and reading order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.operators import components, folds, geometry, indexing, linkage, lines


@query("""WITH e AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) SELECT user_id, event_id, event_type FROM e WHERE before IS DISTINCT FROM event_type""")
def run_collapse(spark, sf_dir):
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, sf_dir, "events").withColumn("before", before).filter("not (before <=> event_type)").select("user_id", "event_id", "event_type")


@query("SELECT conv_id, turn, lag(turn) OVER w AS previous, lead(turn) OVER w AS next FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def prev_next_links(spark, sf_dir):
    return indexing.neighbours(table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", "turn", "turn")


@query("""WITH s AS (SELECT user_id, list(event_type ORDER BY ts, event_id) AS a FROM events GROUP BY user_id), p AS (SELECT x.user_id, x.a, y.a AS b, least(len(x.a), len(y.a)) AS n FROM s x JOIN s y ON y.user_id = x.user_id + 1)
SELECT user_id, n >= 4 AND a[1:n] = b[1:n] AS whole, n >= 2 AND a[1:2] = b[1:2] AS two FROM p""")
def same_opening(spark, sf_dir):
    seq = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "event_type"))), lambda x: x["event_type"]).alias("a"))
    pairs = seq.join(seq.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b")), "user_id")
    two = lambda c: F.slice(c, 1, 2)
    return pairs.select("user_id", linkage.same_opening(F.col("a"), F.col("b")).alias("whole"), linkage.same_opening(two("a"), two("b"), 2).alias("two"))


@query("""WITH e AS (SELECT *, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) > 3600000000, true) AS s FROM events), i AS (SELECT *, sum(s::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
SELECT user_id, island::BIGINT AS island, count(*) AS n, min(event_id) AS first_id FROM i GROUP BY ALL""")
def gap_islands(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    gap = lines.gap_to_previous("us", ["user_id"], ["ts", "event_id"])
    return lines.islands(rows, ["user_id"], ["ts", "event_id"], gap > 3_600_000_000).groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("""WITH g AS (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events), m AS (SELECT user_id, quantile_cont(gap, 0.5) AS mid FROM g GROUP BY user_id)
SELECT user_id, floor(mid)::BIGINT AS mid, count(CASE WHEN gap > 2 * mid THEN 1 END) AS wide, count(gap) AS n FROM g JOIN m USING (user_id) GROUP BY ALL""")
def median_gap_split(spark, sf_dir):
    rows = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("gap", lines.gap_to_previous("us", ["user_id"], ["ts", "event_id"]))
    middle = rows.groupBy("user_id").agg(F.median("gap").alias("mid"))
    joined = rows.join(middle, "user_id").groupBy("user_id", "mid").agg(F.count_if(F.col("gap") > 2 * F.col("mid")).alias("wide"), F.count("gap").alias("n"))
    return joined.select("user_id", F.floor("mid").cast("long").alias("mid"), "wide", "n")


@query("""SELECT e.event_id, (SELECT arg_min(p.event_id, (p.ts, p.event_id)) FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND p.ts >= e.ts) AS match FROM events e WHERE e.event_type = 'error'""")
def asof_forward_match(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return lines.forward_match(events.filter("event_type = 'error'"), events.filter("event_type = 'purchase'"), "user_id", "ts", "event_id", "event_id")


@query("""WITH n AS (SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, length(text)::BIGINT AS asked, length(nt)::BIGINT AS answered FROM n WHERE role = 'user' AND nr = 'assistant'""")
def adjacent_pairing(spark, sf_dir):
    rows = lines.adjacent_pairs(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "user", "assistant", "text")
    return rows.select("conv_id", "turn", F.length("text").cast("long").alias("asked"), F.length("next_text").cast("long").alias("answered"))


@query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS gap FROM lineitem)
SELECT l_orderkey, count(*) AS n, count(CASE WHEN NOT (gap IS NULL OR gap = 1) THEN 1 END) AS wrong FROM g GROUP BY l_orderkey""")
def sequence_gap_verify(spark, sf_dir):
    rows = indexing.gaps(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", "l_linenumber", F.lit(1))
    return rows.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(~F.col("ok")).alias("wrong"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS ord FROM documents),
s AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY ord) AS lft, sum(length(line)) OVER (PARTITION BY doc_id) AS whole FROM l),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY greatest(lft, whole - lft), ord) AS r FROM s WHERE whole > lft)
SELECT doc_id, ord::BIGINT AS cut, lft::BIGINT AS "left", (whole - lft)::BIGINT AS "right" FROM r WHERE r = 1""")
def balanced_split(spark, sf_dir):
    rows = lines.explode_lines(table(spark, sf_dir, "documents")).withColumn("weight", F.length("line").cast("long"))
    return lines.balanced_split(rows.withColumn("ord", F.col("ord").cast("long")), "doc_id", "ord", "weight", F.lit(True))


_LAID = """SELECT doc_id::VARCHAR AS doc, i // 60 AS page, i AS ord, CASE WHEN i % 2 = 1 AND i % 7 <> 0 THEN 320.0 + i % 3 ELSE 40.0 END AS x0, CASE WHEN i % 7 = 0 THEN 560.0 WHEN i % 2 = 1 THEN 540.0 ELSE 260.0 END AS x1,
  (i - i % 2 * (i % 7 <> 0 AND (i - 1) % 7 <> 0)::INT) * 12.0 AS y, line, length(line) % 4 = 0 AND i % 7 <> 0 AS symbols
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)"""


def laid_out(spark, sf_dir):
    """Pages of the documents' lines in two columns, with lines over the whole width between them; some lines are symbols."""
    docs, i = lines.explode_lines(table(spark, sf_dir, "documents")), F.col("ord")
    wide, right = i % 7 == 0, i % 2 == 1
    beside = F.when(right & ~wide & ((i - 1) % 7 != 0), 1).otherwise(0)
    return docs.select(
        F.col("doc_id").cast("string").alias("doc"), F.floor(i / 60).cast("int").alias("page"), "ord", F.when(right & ~wide, F.lit(320.0) + i % 3).otherwise(40.0).alias("x0"),
        F.when(wide, 560.0).when(right, 540.0).otherwise(260.0).alias("x1"), ((i - beside) * 12).cast("double").alias("y"), "line", ((F.length("line") % 4 == 0) & ~wide).alias("symbols"),
    )


@query(f"""WITH l AS ({_LAID}), e AS (SELECT doc, page, min(x0) AS edge FROM l WHERE x0 >= 320 GROUP BY ALL HAVING count(*) >= 5),
c AS (SELECT l.*, edge, bool_or(edge IS NOT NULL AND x0 < edge - 12 AND x1 > edge + 2) OVER (PARTITION BY doc, page, y) AS crossing FROM l LEFT JOIN e USING (doc, page)),
h AS (SELECT *, (SELECT min(d.y) FROM c d WHERE d.doc = c.doc AND d.page = c.page AND d.crossing AND d.y >= c.y) AS below FROM c),
a AS (SELECT *, crossing OR coalesce(symbols AND below - y < 15, false) AS alone, CASE WHEN NOT crossing AND symbols AND below - y < 15 THEN below ELSE y END AS at FROM h),
b AS (SELECT *, (SELECT max(d.at) FROM a d WHERE d.doc = a.doc AND d.page = a.page AND d.alone AND d.at <= a.at) AS band, CASE WHEN edge IS NOT NULL AND NOT alone THEN (x0 >= edge - 4)::INT END AS col FROM a)
SELECT doc, page::INT AS page, ord::INT AS ord, col AS "column", (row_number() OVER (PARTITION BY doc, page ORDER BY band NULLS FIRST, alone DESC, coalesce(col, 0), y, x0) - 1)::INT AS nth FROM b""")
def two_column_reading_order(spark, sf_dir):
    """W8 with the edges of A5, on pages laid out from the documents' lines."""
    laid = laid_out(spark, sf_dir)
    edges = geometry.column_edges(laid, ["doc", "page"], "x0", ["ord"])
    read = geometry.reading_order(laid.withColumnRenamed("ord", "line_no"), edges, ["doc", "page"], F.col("symbols"))
    return read.select("doc", "page", F.col("line_no").alias("ord"), "column", F.col("ord").alias("nth"))


@query("""WITH RECURSIVE l AS (SELECT source, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
x AS (SELECT source, length(line)::DOUBLE AS x, doc_id * 100000 + i AS seen FROM l WHERE length(line) BETWEEN 150 AND 450),
b AS (SELECT source, round_even(x / 2, 0)::BIGINT AS bin, count(*) AS n, min(x) AS low, min(seen) AS seen FROM x GROUP BY ALL),
m AS (SELECT b.source, b.bin, b.n, b.seen, sum(c.n) AS wide, min(c.low) AS low FROM b JOIN b c ON c.source = b.source AND c.bin BETWEEN b.bin - 1 AND b.bin + 1 GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, seen) AS k FROM m),
g AS (
  SELECT source, 1 AS k, CASE WHEN wide >= 5 THEN [low] ELSE []::DOUBLE[] END AS edges, wide >= 5 AS go FROM k WHERE k = 1
  UNION ALL
  SELECT g.source, k.k, CASE WHEN k.wide >= 5 AND len(list_filter(edges, lambda e: abs(k.low - e) <= 60)) = 0 THEN edges || [k.low] ELSE edges END, k.wide >= 5 FROM g JOIN k ON k.source = g.source AND k.k = g.k + 1 WHERE go
),
e AS (SELECT source, unnest(arg_max(edges, k)) AS edge FROM g GROUP BY source),
f AS (SELECT e.source, e.edge, min(x.x) AS x FROM e JOIN x ON x.source = e.source AND x.x BETWEEN e.edge - 20 AND e.edge GROUP BY ALL)
SELECT source, array_to_string(list(x::BIGINT ORDER BY x), ',') AS edges FROM f GROUP BY source""")
def column_edges(spark, sf_dir):
    """A5: the lengths at which a source's lines pile up."""
    rows = table(spark, sf_dir, "documents").select("source", "doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line")).withColumn("x", F.length("line").cast("double"))
    found = geometry.column_edges(rows, ["source"], "x", ["doc_id", "ord"])
    return found.select("source", F.array_join(F.transform("edges", lambda e: e.cast("long").cast("string")), ",").alias("edges"))


_HEIGHT = "list_sum(list_transform(lens, lambda n: greatest(ceil(n * {0} / 800.0), 1.0))) * 1.2 * {0} <= 700.0"


def _sizes(spark, sf_dir):
    """per document the largest type size at which its lines, broken anywhere, fit a page."""
    lens = F.transform(F.split("text", "\n"), lambda x: F.length(x))

    def fits(size):
        rows = F.aggregate("lens", F.lit(0.0), lambda n, x: n + F.greatest(F.ceil(x * size / 800.0).cast("double"), F.lit(1.0)))
        return rows * 1.2 * size <= 700.0

    docs = table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", lens.alias("lens"))
    return docs.withColumn("size", folds.largest_fitting(F.lit(1.0), F.lit(12.0), fits))


_SIZES = f"""l AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: length(x)) AS lens FROM documents WHERE text IS NOT NULL),
h AS (
  SELECT doc_id, lens, 0 AS k, 1.0::DOUBLE AS low, 12.0::DOUBLE AS high FROM l
  UNION ALL
  SELECT doc_id, lens, k + 1, CASE WHEN ok THEN mid ELSE low END, CASE WHEN ok THEN high ELSE mid END
  FROM (SELECT *, {_HEIGHT.format("mid")} AS ok FROM (SELECT *, (low + high) / 2 AS mid FROM h WHERE k < 24))
),
z AS (SELECT doc_id, lens, CASE WHEN {_HEIGHT.format("12.0::DOUBLE")} THEN 12.0::DOUBLE ELSE low END AS size FROM h WHERE k = 24)"""


@query(f"WITH RECURSIVE {_SIZES} SELECT doc_id, size FROM z")
def largest_sizes(spark, sf_dir):
    return _sizes(spark, sf_dir).select("doc_id", "size")


@query(f"""WITH RECURSIVE {_SIZES},
t AS (
  SELECT doc_id, lens, size, 1 AS passes, {_HEIGHT.format("size").replace("n * size / 800.0", "n / floor(800.0 / size)")} AS ok FROM z
  UNION ALL
  SELECT doc_id, lens, smaller, passes + 1, {_HEIGHT.format("smaller").replace("n * smaller / 800.0", "n / floor(800.0 / smaller)")} FROM (SELECT *, size * 0.93::DOUBLE AS smaller FROM t WHERE NOT ok AND passes < 6)
)
SELECT doc_id, arg_max(size, passes) AS size, max(passes)::INT AS passes, NOT bool_or(ok) AS bad FROM t GROUP BY doc_id""")
def shrunk_to_fit(spark, sf_dir):
    """Sizes are verified with lines of whole characters; documents that don't fit shrink and are verified again."""
    def measure(items):
        rows = F.aggregate("lens", F.lit(0.0), lambda n, x: n + F.greatest(F.ceil(x / F.floor(800.0 / F.col("size"))).cast("double"), F.lit(1.0)))
        return items.withColumn("bad", ~(rows * 1.2 * F.col("size") <= 700.0))

    return components.shrink_to_fit(_sizes(spark, sf_dir), measure).select("doc_id", "size", "passes", "bad")
