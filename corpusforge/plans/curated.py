"""Queries on curated books made of the documents: corrections by rule tables, sections replaced, a whole layout, statistics of a pass, and an incremental pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.operators import curation, rules
from corpusforge.operators.indexing import number_globally
from corpusforge.session import ensure_checkpoint_dir
from corpusforge.streaming.incremental import incremental, prune

TITLE_SQL = "coalesce(list_filter(string_split_regex(text, '[^A-Za-zÀ-ÿ]+'), lambda w: w <> '')[1], '?')"


def shared_folder(spark) -> str:
    """A new folder where driver and executors both reach it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"


def items(spark, sf_dir: str) -> DataFrame:
    """Every document as an item: num, title (its first word), meta (its source in bold and its language), part, section, body."""
    text = F.col("text")
    title = F.coalesce(F.get(F.filter(F.split(text, "[^A-Za-zÀ-ÿ]+"), lambda w: w != ""), F.lit(0)), F.lit("?"))
    meta = F.when(F.col("doc_id") % 9 != 0, F.concat(F.lit("**"), "source", F.lit("** · "), "lang"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("num"), title.alias("title"), meta.alias("meta"), "lang", "source", "text")


_ITEMS = f"i AS (SELECT doc_id AS num, {TITLE_SQL} AS title, CASE WHEN doc_id % 9 <> 0 THEN '**' || source || '** · ' || lang ELSE '' END AS meta, lang, source, text FROM documents)"


# -- T13 --------------------------------------------------------------------------------------------------------------------
@query(f"""WITH {_ITEMS}, same AS (SELECT num, min(num) OVER (PARTITION BY text) AS kept, row_number() OVER (PARTITION BY text ORDER BY num) AS nth FROM i WHERE text IS NOT NULL),
m AS (SELECT kept, num AS dropped, 'merged with ' || num AS meta FROM same WHERE nth = 2),
n AS (SELECT doc_id AS num, 'note ' || quality AS note FROM labels JOIN i ON i.num = doc_id WHERE toxic = 1 AND doc_id NOT IN (SELECT dropped FROM m)),
t AS (SELECT doc_id AS num, 'Retitled ' || doc_id AS title FROM labels JOIN i ON i.num = doc_id WHERE quality = 0 AND toxic = 0 AND doc_id NOT IN (SELECT dropped FROM m)),
v AS (SELECT a.num AS first, b.num AS second, CASE WHEN a.num % 20 = 0 THEN 'given' END AS meta FROM i a JOIN i b ON b.num = a.num + 3 WHERE a.num % 10 = 0 AND a.num NOT IN (SELECT dropped FROM m) AND b.num NOT IN (SELECT dropped FROM m)),
r AS (
  SELECT i.num, CASE WHEN s.second IS NOT NULL THEN b.title || ' (II)' WHEN f.first IS NOT NULL THEN i.title || ' (I)' ELSE coalesce(t.title, i.title) END AS title,
    CASE WHEN s.second IS NOT NULL THEN coalesce(s.meta, CASE WHEN i.meta LIKE '**%' THEN '**' || i.source || '** · ' ELSE '' END || 'variant of „' || b.title || '”' || CASE WHEN i.title <> b.title THEN ', titled „' || i.title || '”' ELSE '' END || ' · ' || CASE WHEN i.meta LIKE '**%' THEN i.lang ELSE '' END)
      WHEN n.note IS NOT NULL THEN n.note || ' · ' || i.meta ELSE coalesce(m.meta, i.meta) END AS meta, coalesce(s.first, i.num) AS spot, s.second IS NOT NULL AS late
  FROM i LEFT JOIN v s ON s.second = i.num LEFT JOIN i b ON b.num = s.first LEFT JOIN v f ON f.first = i.num LEFT JOIN t ON t.num = i.num LEFT JOIN n ON n.num = i.num LEFT JOIN m ON m.kept = i.num
  WHERE i.num NOT IN (SELECT dropped FROM m)
)
SELECT num, title, meta, row_number() OVER (ORDER BY spot, late) AS place FROM r""")
def curated_dedup(spark, sf_dir):
    """Equal texts merge, labels give notes and new titles, every tenth document has a variant three places on."""
    all_, labels = items(spark, sf_dir), table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "num")
    same = all_.filter("text is not null").groupBy(F.sha2("text", 256).alias("key")).agg(F.min("num").alias("kept"), F.get(F.array_sort(F.collect_set("num")), F.lit(1)).alias("dropped")).filter("dropped is not null")
    merges = same.select("kept", "dropped", F.concat(F.lit("merged with "), F.col("dropped").cast("string")).alias("meta"))
    gone = merges.select(F.col("dropped").alias("num"))
    rated = labels.join(all_.select("num"), "num", "left_semi").join(gone, "num", "left_anti")
    notes = rated.filter("toxic = 1").select("num", F.concat(F.lit("note "), F.col("quality").cast("string")).alias("note"))
    titles = rated.filter("quality = 0 and toxic = 0").select("num", F.concat(F.lit("Retitled "), F.col("num").cast("string")).alias("title"))
    left = all_.select("num").join(gone, "num", "left_anti")
    variants = left.filter("num % 10 = 0").select(F.col("num").alias("first"), (F.col("num") + 3).alias("num")).join(left, "num").select("first", F.col("num").alias("second"), F.when(F.col("first") % 20 == 0, "given").alias("meta"))
    return curation.corrected(all_.drop("lang", "source", "text"), merges, variants, titles, notes)


# -- K4 ---------------------------------------------------------------------------------------------------------------------
@query("""WITH l AS (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
h AS (SELECT DISTINCT lang FROM l),
kept AS (SELECT '## ' || lang AS line, lang, 0 AS b, 0 AS d, 0 AS i FROM h UNION ALL SELECT line, lang, 2, doc_id, i FROM l WHERE source <> 'src3' UNION ALL SELECT '## end', '~', 0, 0, 0),
fresh AS (SELECT '- [' || doc_id || '](#' || source || ')' AS line, lang, 1 AS b, doc_id AS d, 0 AS i FROM documents WHERE text IS NOT NULL AND source = 'src3')
SELECT row_number() OVER (ORDER BY lang, b, d, i) AS place, line FROM (SELECT * FROM kept UNION ALL SELECT * FROM fresh UNION ALL SELECT '## text of ' || lang, lang, 1, 4611686018427387904, 0 FROM h)""")
def rewritten_sections(spark, sf_dir):
    """K4: a book of the documents by language; each language's section of source src3 is replaced by a list of links."""
    docs = table(spark, sf_dir, "documents").filter("text is not null")
    rows = docs.select("lang", F.when(F.col("source") == "src3", 1).otherwise(3).alias("b"), F.col("doc_id").alias("d"), F.posexplode(F.split("text", "\n")).alias("i", "line"))
    heads = docs.select("lang").distinct()
    zero = F.lit(0).cast("long")
    titles = heads.select("lang", F.lit(0).alias("b"), zero.alias("d"), F.lit(0).alias("i"), F.concat(F.lit("## "), "lang").alias("line"))
    borders = heads.select("lang", F.lit(2).alias("b"), zero.alias("d"), F.lit(0).alias("i"), F.concat(F.lit("## text of "), "lang").alias("line"))
    book = rows.unionByName(titles).unionByName(borders).unionByName(spark.range(1).select(F.lit("~").alias("lang"), F.lit(0).alias("b"), zero.alias("d"), F.lit(0).alias("i"), F.lit("## end").alias("line")))
    lines = number_globally(book, ["lang", "b", "d", "i"], "ord").select("ord", "line")
    sections = heads.select(F.concat(F.lit("## "), "lang").alias("header"), F.concat(F.lit("## text of "), "lang").alias("until"))
    fresh = docs.filter("source = 'src3'").select(F.concat(F.lit("## "), "lang").alias("header"), F.col("doc_id").alias("nth"), F.concat(F.lit("- ["), F.col("doc_id").cast("string"), F.lit("](#"), "source", F.lit(")")).alias("line"))
    return curation.replace_sections(lines, "ord", sections, fresh)


# -- K5, T11 ------------------------------------------------------------------------------------------------------------
_SORT = "regexp_replace(strip_accents(lower({0})), '^[^a-z0-9]+', '')"
_SLUG = r"replace(regexp_replace(lower({0}), '[^\w\- ß-ÿ]', '', 'g'), ' ', '-')"


@query(f"""WITH {_ITEMS}, l AS (SELECT DISTINCT lang AS part, 'S' || (substr(source, 4)::INT % 3) AS section FROM i),
p AS (SELECT *, dense_rank() OVER (ORDER BY part) AS p, dense_rank() OVER (PARTITION BY part ORDER BY section) AS s FROM l),
k AS (SELECT i.*, p, s, part, section, {_SORT.format("title")} AS sort FROM i JOIN p ON p.part = i.lang AND p.section = 'S' || (substr(source, 4)::INT % 3)),
n AS (SELECT *, row_number() OVER (ORDER BY p, s, sort, num) AS n, {_SLUG.format("title")} AS slug FROM k),
u AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY n) = 1 THEN slug ELSE slug || '-' || (row_number() OVER (PARTITION BY slug ORDER BY n) - 1) END AS link, CASE WHEN num % 9 <> 0 THEN source END AS artist FROM n),
c AS (SELECT p, s, part, section, count(*) AS c FROM u GROUP BY ALL), t AS (SELECT p, part, sum(c)::BIGINT AS c FROM c GROUP BY ALL),
r AS (
  SELECT 1 AS b, -1 AS p, -1 AS s, '' AS a, 0 AS n, 0 AS l, '## Contents' AS line UNION ALL SELECT 1, p, -1, '', 0, 0, '**' || part || '** (' || c || ' texts)' FROM t UNION ALL SELECT 1, p, s, '', 0, 0, '- ' || section || ' (' || c || ' texts)' FROM c
  UNION ALL SELECT 2, p, s, '', 0, 0, '### ' || part || ' — ' || section FROM c UNION ALL SELECT 2, p, s, '', n, 0, '- [' || title || '](#' || link || ')' FROM u
  UNION ALL SELECT 3, p, -1, '', 0, 0, '## ' || part FROM t UNION ALL SELECT 3, p, s, '', 0, 0, '### ' || section FROM c UNION ALL SELECT 3, p, s, '', n, 0, '#### ' || title FROM u UNION ALL SELECT 3, p, s, '', n, 1, 'source ' || source FROM u
  UNION ALL SELECT 4, -1, -1, '', 0, 0, '## Index' UNION ALL SELECT DISTINCT 4, 0, 0, {_SORT.format("artist")} || chr(1) || artist, 0, 0, '**' || artist || '**' FROM u WHERE artist IS NOT NULL
  UNION ALL SELECT 4, 0, 0, {_SORT.format("artist")} || chr(1) || artist, n, 0, '- [' || title || '](#' || link || ')' FROM u WHERE artist IS NOT NULL
)
SELECT row_number() OVER (ORDER BY b, p, s, a, n, l) AS place, line FROM r""")
def relaid_book(spark, sf_dir):
    """The documents as a book of languages and groups of sources, with contents, lists, index."""
    section = F.concat(F.lit("S"), (F.substring("source", 4, 9).cast("int") % 3).cast("string"))
    all_ = items(spark, sf_dir).select(F.col("num").alias("item"), "title", F.when(F.col("num") % 9 != 0, F.col("source")).alias("artist"), F.array(F.concat(F.lit("source "), "source")).alias("body"), F.col("lang").alias("part"), section.alias("section"))
    layout = all_.select("part", "section").distinct()
    layout = layout.withColumn("part_at", F.dense_rank().over(Window.orderBy("part"))).withColumn("section_at", F.dense_rank().over(Window.partitionBy("part").orderBy("section")))  # as many rows as sections
    return curation.relaid(all_, layout, items_word="texts")


# -- K15 --------------------------------------------------------------------------------------------------------------------
@query("""SELECT unnest(['rows', 'without text', 'characters', 'longest', 'de', 'en', 'es', 'fr']) AS name, unnest([count(*), count(*) FILTER (text IS NULL), coalesce(sum(length(text)), 0)::BIGINT, coalesce(max(length(text)), 0),
count(*) FILTER (lang = 'de'), count(*) FILTER (lang = 'en'), count(*) FILTER (lang = 'es'), count(*) FILTER (lang = 'fr')])::BIGINT AS value FROM documents""")
def run_statistics(spark, sf_dir):
    """Figures that ride on the job which writes the documents with their keys."""
    count = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    n = F.length("text")
    figures = [F.count("*").alias("rows"), count(F.col("text").isNull()).alias("without text"), F.coalesce(F.sum(n), F.lit(0)).alias("characters"), F.coalesce(F.max(n), F.lit(0)).alias("longest"), *(count(F.col("lang") == x).alias(x) for x in ("de", "en", "es", "fr"))]
    keyed, seen = curation.observed(table(spark, sf_dir, "documents"), *figures)
    keyed.withColumn("key", rules.content_key(F.col("text"), F.col("lang"))).write.parquet(shared_folder(spark))
    return spark.createDataFrame([(k, int(v)) for k, v in seen.get.items()], "name string, value long")


# -- R2, T15, K14 -------------------------------------------------------------------------------------------------------
_EVENT = """'{"user_id":' || user_id || ',"event_type":"' || event_type || '","day":"' || strftime(ts, '%Y-%m-%d') || '"}'"""


@query(f"""WITH e AS (SELECT sha256({_EVENT}) AS key, user_id, event_type, strftime(ts, '%Y-%m-%d') AS day, event_id % 3 AS batch FROM events)
SELECT DISTINCT key, user_id, event_type || ' on ' || day AS told FROM e WHERE key IN (SELECT key FROM e WHERE batch <> 0)""")
def incremental_pass(spark, sf_dir):
    """Events arrive as files in three batches; the stream is then started anew from the beginning, so that every batch comes again; at last the results
    of contents that only the first batch had go. The rows equal those of one batch over what is left."""
    day = F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd").alias("day")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", day, (F.col("event_id") % 3).alias("batch"))
    keyed = events.withColumn("key", rules.content_key(F.col("user_id"), F.col("event_type"), F.col("day")))
    folder = shared_folder(spark)
    for k in range(3):
        keyed.filter(F.col("batch") == k).write.parquet(f"{folder}/in/{k}")
    told = lambda df: df.select("key", "user_id", F.concat_ws(" on ", "event_type", "day").alias("told"))
    for start in ("first", "again"):
        stream = spark.readStream.schema(keyed.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", "4").parquet(f"{folder}/in")
        incremental(stream, "key", told, f"{folder}/store", f"{folder}/{start}").awaitTermination()
    return prune(spark, f"{folder}/store", keyed.filter("batch <> 0"), "key", f"{folder}/pruned")
