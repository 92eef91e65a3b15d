"""Queries on near-duplicates, groups and their survivors."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.functions import text as T
from corpusforge.functions import titles
from corpusforge.operators import indexing, linkage, songs, survive
from corpusforge.operators.components import connected_components, cut_lineage

CANDIDATES = """w AS (SELECT doc_id, list_filter(string_split_regex(strip_accents(lower(text)), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
k AS (SELECT gram FROM g GROUP BY gram HAVING count(*) BETWEEN 2 AND 8), r AS (SELECT g.* FROM g JOIN k USING (gram)),
cand AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM r x JOIN r y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL HAVING count(*) >= 3)"""
SCORED = f"""{CANDIDATES}, e AS (SELECT doc_id, unnest(w) AS t FROM w), c AS (SELECT doc_id, t, count(*) AS n FROM e GROUP BY ALL), z AS (SELECT doc_id, len(w) AS size FROM w),
i AS (SELECT a, b, sum(least(x.n, y.n))::BIGINT AS inter FROM cand JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b AND y.t = x.t GROUP BY ALL),
scored AS (SELECT cand.a, cand.b, shared, coalesce(inter, 0) AS inter, least(x.size, y.size)::BIGINT AS least FROM cand LEFT JOIN i ON cand.a = i.a AND cand.b = i.b JOIN z x ON x.doc_id = cand.a JOIN z y ON y.doc_id = cand.b)"""
COMPONENTS = f"""{SCORED}, edge AS (SELECT a, b FROM scored WHERE inter * 10 > least * 8), sym AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT a, b FROM sym UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a), comp AS (SELECT a AS doc_id, least(a, min(b)) AS component FROM reach GROUP BY a)"""


def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.words(F.col("text")).alias("words"))


def scored_pairs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return linkage.containment(cut_lineage(linkage.candidate_pairs(docs)), docs)


def components(spark, sf_dir):
    return connected_components(linkage.verified(scored_pairs(spark, sf_dir)), "a", "b").withColumnRenamed("node", "doc_id")


def members(spark, sf_dir):
    return components(spark, sf_dir).join(table(spark, sf_dir, "documents"), "doc_id")


@query(f"WITH {CANDIDATES} SELECT a, b, shared FROM cand")
def ngram_blocking_pairs(spark, sf_dir):
    return linkage.candidate_pairs(documents(spark, sf_dir))


@query(f"WITH {SCORED} SELECT a, b, shared, inter, least FROM scored")
def multiset_containment(spark, sf_dir):
    return scored_pairs(spark, sf_dir)


@query(f"WITH {SCORED} SELECT a, b, shared, inter, least FROM scored WHERE inter * 10 > least * 8")
def verified_pairs(spark, sf_dir):
    return linkage.verified(scored_pairs(spark, sf_dir))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT doc_id, component FROM comp")
def dup_components(spark, sf_dir):
    return components(spark, sf_dir)


@query(f"WITH RECURSIVE {COMPONENTS} SELECT component, min(doc_id) AS kept, count(*) - 1 AS others, string_agg(CASE WHEN doc_id <> component THEN doc_id::VARCHAR END, ',' ORDER BY doc_id) AS also_in FROM comp GROUP BY component")
def dup_survivors(spark, sf_dir):
    found = survive.survivors(components(spark, sf_dir), "component", [], "doc_id")
    return found.withColumn("also_in", F.array_join(F.transform("also_in", lambda x: x.cast("string")), ","))


@query(f"WITH RECURSIVE {COMPONENTS}, s AS (SELECT component, count(*) AS size FROM comp GROUP BY component) SELECT size, count(*) AS n FROM s GROUP BY size")
def group_size_histogram(spark, sf_dir):
    return components(spark, sf_dir).groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n"))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT component, arg_min(quality, comp.doc_id) FILTER (quality IS NOT NULL)::BIGINT AS quality FROM comp LEFT JOIN labels ON labels.doc_id = comp.doc_id GROUP BY component")
def first_nonnull_in_group(spark, sf_dir):
    rows = components(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rows.groupBy("component").agg(survive.first_non_null(F.col("quality").cast("long"), F.col("doc_id")).alias("quality"))


@query(f"WITH RECURSIVE {COMPONENTS} SELECT component, CASE WHEN count(DISTINCT source) = 1 THEN min(source) END AS source FROM comp JOIN documents USING (doc_id) GROUP BY component")
def unanimous_guard(spark, sf_dir):
    return members(spark, sf_dir).groupBy("component").agg(survive.unanimous(F.col("source")).alias("source"))


@query(f"""WITH RECURSIVE {COMPONENTS}, m AS (SELECT component, doc_id, lang, source FROM comp JOIN documents USING (doc_id)), f AS (SELECT component, arg_min(lang, doc_id) AS ahead FROM m WHERE source = 'src0' GROUP BY component),
cc AS (SELECT component, lang, count(*) AS n, min(doc_id) AS spot FROM m WHERE lang IS NOT NULL GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY n DESC, spot) AS r FROM cc)
SELECT component, coalesce(ahead, lang) AS chosen FROM o LEFT JOIN f USING (component) WHERE r = 1""")
def majority_with_precedence(spark, sf_dir):
    return survive.majority(members(spark, sf_dir), "component", "lang", "doc_id", F.col("source") == "src0")


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY p_retailprice DESC, p_size DESC, p_partkey) AS r FROM part) SELECT p_type, p_brand, p_partkey FROM r WHERE r = 1")
def best_version_rank(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_type", "p_brand").agg(survive.best_by(F.col("p_partkey"), F.col("p_retailprice"), F.col("p_size"), -F.col("p_partkey")).alias("p_partkey"))


MARKS = "[äçèéêíñóöü]"


@query(f"""WITH f AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9à-öø-ÿß]+'), lambda x: x <> '')[1] AS form FROM documents),
r AS (SELECT strip_accents(form) AS k, form, row_number() OVER (PARTITION BY strip_accents(form) ORDER BY len(regexp_extract_all(form, '{MARKS}')) DESC, doc_id) AS r FROM f WHERE form IS NOT NULL) SELECT k, form FROM r WHERE r = 1""")
def richest_spelling(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.get(T.surface_words(F.col("text")), F.lit(0)).alias("form")).filter("form is not null")
    return rows.groupBy(T.fold(F.col("form")).alias("k")).agg(survive.best_by(F.col("form"), F.regexp_count("form", F.lit(MARKS)), -F.col("doc_id")).alias("form"))


@query("""WITH t AS (SELECT doc_id, lang, list_filter(string_split_regex(strip_accents(lower(text)), '[^a-z0-9]+'), lambda x: x <> '')[1] AS title FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY lang, title ORDER BY doc_id) AS k FROM t WHERE title IS NOT NULL)
SELECT doc_id, CASE WHEN k = 1 THEN title WHEN k = 2 THEN title || ' (II)' WHEN k = 3 THEN title || ' (III)' ELSE title || ' (' || k || ')' END AS variant FROM n""")
def variant_numbering(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", F.get(T.words(F.col("text")), F.lit(0)).alias("title")).filter("title is not null")
    return indexing.variant_titles(rows, ["lang", "title"], "title", "doc_id").select("doc_id", "variant")


@query(f"""WITH RECURSIVE {COMPONENTS}, o AS (SELECT documents.doc_id, CASE WHEN component <> documents.doc_id THEN component END AS base FROM documents LEFT JOIN comp USING (doc_id))
SELECT doc_id, base, row_number() OVER (ORDER BY coalesce(base, doc_id), base IS NOT NULL, doc_id) AS rank FROM o""")
def variant_next_to_base(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id").join(components(spark, sf_dir), "doc_id", "left").withColumn("base", F.when(F.col("component") != F.col("doc_id"), F.col("component")))
    keys = docs.select("doc_id", "base", *(c.alias(f"k{i}") for i, c in enumerate(indexing.beside_base(docs, "base", "doc_id"))))
    return indexing.number_globally(keys, ["k0", "k1", "k2"]).select("doc_id", "base", "rank")


# -- no SQL: difflib and order-dependent folds; tests hold them against plain Python ----------------------------------------
@query()
def ratio_pairs(spark, sf_dir):
    """J6 with both branches: contained words (above 0.8), or else word sequences of a ratio above 0.55."""
    docs = documents(spark, sf_dir)
    return linkage.verified_either(cut_lineage(scored_pairs(spark, sf_dir)), docs)


@query()
def fuzzy_top1(spark, sf_dir):
    """Supplier names without their last digit against all of them."""
    names = table(spark, sf_dir, "supplier").select(T.norm(F.col("s_name")).alias("key"))
    return linkage.close_matches(names.select(F.substring("key", F.lit(1), F.length("key") - 1).alias("key")), names)


@query()
def greedy_merge(spark, sf_dir):
    """T5: documents merged in order by first line, which stands for the title, and content signature."""
    docs = table(spark, sf_dir, "documents").select("doc_id", T.norm(F.substring_index("text", "\n", 1)).alias("title"), T.signature(T.lines(F.col("text")), grammar=songs.CHORD, ignore=songs.BETWEEN).alias("content"))
    return linkage.greedy_merge(docs, "doc_id", "title", "content").select("doc_id", "slot")


@query()
def merge_same_reading(spark, sf_dir):
    """Near-duplicates of the same reading, folded in order: of a pair the document of the source that comes first stays. Words say their chords by their length."""
    labels = F.array(*map(F.lit, ["C", "Am", "F#", "G7", "Dm", "Bb", "E7", "A", "Em", "B7", "D", "Gsus4"]))
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", T.words(F.col("text")).alias("words"))
    return linkage.merge_readings(docs.withColumn("chords", F.transform("words", lambda w: F.get(labels, F.length(w) % 12))))


@query()
def best_shift_similarity(spark, sf_dir):
    """F33 on the event types of each user and the next one, read as chords."""
    kinds = F.create_map(*[F.lit(x) for k, c in zip(["view", "click", "purchase", "signup", "error"], ["C", "Dm", "E7", "F#", "G#m"]) for x in (k, c)])
    seq = table(spark, sf_dir, "events").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", kinds[F.col("event_type")].alias("k")))), lambda x: x["k"]).alias("a"))
    pairs = seq.join(seq.select((F.col("user_id") - 1).alias("user_id"), F.col("a").alias("b")), "user_id")
    return linkage.best_shifts(pairs).select("user_id", "score", "shift")


@query()
def recase_titles(spark, sf_dir):
    """First lines, which stand for titles, in capitals get back a reader's case."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", F.upper(titles.first_line()).alias("title"))
    nouns = cut_lineage(titles.proper_nouns(docs))
    return titles.recase_titles(rows, "doc_id", "title", "lang", nouns, nouns.filter("n >= 8")).select("doc_id", "title", "recased")
