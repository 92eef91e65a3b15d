"""Rules of text, verses, merges and links on whole tables: what a rule needs is made of the documents' own words."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.functions import pitch
from corpusforge.functions import text as T
from corpusforge.operators import indexing, lines, rules, songs
from corpusforge.operators.components import cut_lineage
from corpusforge.plans import linking, songbook
from corpusforge.plans.curated import TITLE_SQL, items

_WORDS = "regexp_extract_all(text, '[A-Za-z]+')"
_FOLD = "strip_accents(lower({0}))"
_SHA = "sha256(array_to_string({0}, chr(10)))"
_SIGNS = ["[C]", "[Am]", "[(G)]", "[N.C.]"]


def _nth(words, k: int):
    return F.coalesce(F.get(words, F.lit(k)), F.lit("x"))


# -- F3-F5, F12, F14, F16-F19, F24, F26, F34, P20, W12 ------------------------------------------------------------------
@query(rf"""WITH d AS (SELECT *, {_WORDS} AS w, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), e AS (SELECT *, list_transform(range(1, 9), lambda k: coalesce(w[k], 'x')) AS v FROM d)
SELECT doc_id, sha256(strip_accents(text)) AS plain, sha256(text) AS flat, sha256(replace(text, 's', 'ș')) AS comma, sha256({_FOLD.format("text")}) AS search,
  {_SHA.format("list_transform(w, lambda x, i: CASE WHEN length(w[greatest(i - 1, 1)]) > 1 AND w[greatest(i - 1, 1)] = upper(w[greatest(i - 1, 1)]) THEN upper(x) WHEN regexp_matches(w[greatest(i - 1, 1)], '^[A-Z]') THEN upper(left(x, 1)) || lower(substr(x, 2)) ELSE lower(x) END)")} AS cased,
  {_SHA.format("list_transform(l, lambda x, i: CASE WHEN trim(x) = '' THEN '' ELSE repeat(' ', (i - 1) % 3 - list_min(list_transform(list_filter(range(1, len(l) + 1), lambda k: trim(l[k]) <> ''), lambda k: (k - 1) % 3))) || x END)")} AS dedented,
  '<b>' || v[1] || '</b> <i>' || v[2] || '</i> <a href="' || v[4] || '">' || v[3] || '</a> <code>' || v[5] || '</code> &lt;' || v[6] AS html,
  '[' || v[1] || '](p/' || v[2] || '.md) [' || v[3] || '](#' || v[4] || ') [' || v[5] || '](http://' || v[6] || ')' AS links,
  list_max(list_filter(range(0, least(length(v[1]), length(v[3])) + 1), lambda n: left(v[1], n) = left(v[3], n)))::INT AS common,
  array_to_string(list_transform(list_filter(l, lambda x: length(trim(x)) > 8 AND NOT {songbook.symbols_sql("x")})[1:5], lambda x: regexp_replace({_FOLD.format("x")}, '[^a-z0-9]+', '', 'g')), ' ') AS signature,
  {_SHA.format(f"list_transform(w, lambda x, i: CASE WHEN i > 1 AND length(w[i - 1]) % 4 = length(x) % 4 AND length(x) % 4 < 2 THEN '^' ELSE {_SIGNS}[length(x) % 4 + 1] END)")} AS held,
  v[1] AS base, CASE WHEN doc_id % 3 = 0 THEN '**' || source || '** · ' ELSE '' END || 'Sursa: ' || v[2] || ', p. ' || doc_id || ' · ' || lang AS meta, CASE WHEN doc_id % 3 = 0 THEN source END AS artist, v[2] || ', p. ' || doc_id AS told
FROM e""")
def text_rules(spark, sf_dir):
    """F3, F4, F5, F12, F14, F16-F19, F24, F26, F34, P20, W12 on every document; long results by their SHA-256."""
    docs = table(spark, sf_dir, "documents").filter("text is not null").withColumn("w", F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1)).withColumn("l", F.split("text", "\n"))
    text, w, v = F.col("text"), F.col("w"), [_nth(F.col("w"), k) for k in range(8)]
    sha = lambda lines: F.sha2(F.array_join(lines, "\n"), 256)
    suffix = F.get(F.array(*map(F.lit, [" (I)", " (II)", " (Variantă)", " (varianta)", ""])), (F.col("doc_id") % 5).cast("int"))
    signs = F.array(*map(F.lit, _SIGNS))
    meta = T.meta_line(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("**"), "source", F.lit("**"))), F.concat(F.lit("Sursa: "), v[1], F.lit(", p. "), F.col("doc_id").cast("string")), F.col("lang"))
    return docs.select(
        "doc_id", F.sha2(T.strip_accents(text), 256).alias("plain"), F.sha2(T.flatten_marks(F.replace(F.replace(text, F.lit("t"), F.lit("ț")), F.lit("a"), F.lit("ă"))), 256).alias("flat"),
        F.sha2(T.comma_below(F.replace(text, F.lit("s"), F.lit("ş"))), 256).alias("comma"), F.sha2(T.search_key(text), 256).alias("search"),
        sha(F.transform("w", lambda x, i: T.match_case(F.lower(x), F.get(w, F.greatest(i - 1, F.lit(0)))))).alias("cased"), sha(T.dedent(F.transform("l", lambda x, i: F.concat(F.repeat(F.lit(" "), (i % 3 + 2).cast("int")), x)))).alias("dedented"),
        T.mini_markdown(F.concat(F.lit("**"), v[0], F.lit("** *"), v[1], F.lit("* ["), v[2], F.lit("]("), v[3], F.lit(") `"), v[4], F.lit("` <"), v[5])).alias("html"),
        T.rewrite_links(F.concat(F.lit("["), v[0], F.lit("]("), v[1], F.lit(".md) ["), v[2], F.lit("](#"), v[3], F.lit(") ["), v[4], F.lit("](http://"), v[5], F.lit(")")), "p/").alias("links"),
        T.common_prefix(v[0], v[2]).alias("common"), T.signature(F.col("l"), grammar=songs.CHORD, ignore=songs.BETWEEN).alias("signature"),
        sha(T.mark_repeats(F.transform("w", lambda x: F.get(signs, F.length(x) % 4)))).alias("held"), T.base_title(F.concat(v[0], suffix)).alias("base"),
        meta.alias("meta"), T.meta_artist(meta).alias("artist"), T.meta_source(meta).alias("told"),
    )


# -- F15, F20-F22, F41, F42, F44, F48, P10, P11, P13, P17, P18, P22 -------------------------------------------------------
_INLINE = f"list_transform({_WORDS}, lambda x, i: CASE i % 6 WHEN 1 THEN '[' || {songbook.LABELS}[length(x) % 12 + 1] || ']' WHEN 3 THEN '[riff]' WHEN 4 THEN '^' WHEN 5 THEN '[' || lower(x) || 'q]' ELSE '' END || x)"
_UNSIGNED = r"CASE WHEN regexp_matches(trim(r), '^\d{1,2}\.\d') THEN trim(r) ELSE regexp_replace(trim(r), '^(\d{1,2}\.|R:)\s*', '') END"
_COLUMN = "list_sum([0] || list_transform(x[:i], lambda y, k: CASE WHEN k < i THEN length(y.word) + 1 ELSE 0 END + CASE WHEN y.kind = 5 THEN length(y.word) + 3 ELSE 0 END))"


@query(rf"""WITH d AS (SELECT doc_id, {_WORDS} AS w, {songbook.SONG} AS body FROM documents WHERE text IS NOT NULL),
t AS (SELECT *, list_transform(w, lambda x, i: {{'word': x, 'kind': i % 6}}) AS x FROM d),
k AS (SELECT *, list_transform(x, lambda y, i: CASE WHEN y.kind IN (1, 3, 4) THEN ({_COLUMN})::VARCHAR || ':' || CASE y.kind WHEN 1 THEN {songbook.LABELS}[length(y.word) % 12 + 1] WHEN 3 THEN 'riff' ELSE '/' END END) AS marks,
  flatten(list_transform(body, lambda r: CASE WHEN {songbook.symbols_sql("r")} THEN list_filter(regexp_split_to_array(r, '\s+'), lambda c: regexp_matches(c, '^[A-G]')) ELSE []::VARCHAR[] END)) AS chords FROM t),
c AS (SELECT *, list_filter(list_transform(chords, lambda c, i: CASE WHEN i > 1 AND chords[i - 1] = c THEN NULL ELSE c END), lambda c: c IS NOT NULL) AS runs FROM k)
SELECT doc_id, sha256(array_to_string(list_filter(marks, lambda m: m IS NOT NULL), '|')) AS marks, array_to_string(runs, ' ') AS chords,
  array_to_string(list_transform(runs, lambda c: ['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'][(list_position(['C','C#','D','D#','E','F','F#','G','G#','A','A#','B'], coalesce(map {{'Bb': 'A#'}}[regexp_extract(c, '^[A-G][#b]?')], regexp_extract(c, '^[A-G][#b]?'))) + 1) % 12 + 1] || split_part(regexp_replace(c, '^[A-G][#b]?', ''), '/', 1)), ' ') AS moved,
  sha256(array_to_string(list_filter(string_split(regexp_replace(array_to_string(list_transform(list_filter(body, lambda r: trim(r) <> '' AND NOT {songbook.symbols_sql("r")} AND NOT regexp_matches(r, '^\s*(\d+\.|R:)\s*$')), lambda r: regexp_replace({_FOLD.format(_UNSIGNED)}, '[^a-z0-9]', ' ', 'g')), ' '), '\s+', ' ', 'g'), ' '), lambda x: x <> ''), ' ')) AS sung,
  len(body) >= 3 AND len(list_filter(body, lambda r: {songbook.symbols_sql("r")})) > 0 AS good, array_to_string(body[1:least(4, coalesce(list_position(list_transform(body, lambda r: trim(r) = ''), true) - 1, len(body)))], '|') AS lead, len(w) > 0 AS inline
FROM c""")
def song_rules(spark, sf_dir):
    """F15, F21 (P11), F41, F42, P10, P13, P17 on every document's song."""
    docs = songbook.documents(spark, sf_dir).select("doc_id", F.regexp_extract_all("text", F.lit("([A-Za-z]+)"), 1).alias("w"), songbook.song(F.col("text")).alias("body"))
    labels = F.array(*map(F.lit, songbook.LABELS))

    def signed(x, i):
        k = (i + 1) % 6
        return F.concat(F.when(k == 1, F.concat(F.lit("["), F.get(labels, F.length(x) % 12), F.lit("]"))).when(k == 3, "[riff]").when(k == 4, "^").when(k == 5, F.concat(F.lit("["), F.lower(x), F.lit("q]"))).otherwise(""), x)

    docs = docs.withColumn("line", F.array_join(F.transform("w", signed), " ")).withColumn("runs", pitch.chord_list(F.col("body"), songs.CHORD, songs.BETWEEN))
    marks = F.transform(songs.inline_tokens(F.col("line")), lambda t: F.concat_ws(":", t["col"].cast("string"), t["label"]))
    typed = F.array(F.struct(F.lit("tab").alias("kind"), F.lit("[C] e").alias("line")), F.struct(F.lit("text").alias("kind"), F.col("line").alias("line")))
    return docs.select(
        "doc_id", F.sha2(F.array_join(marks, "|"), 256).alias("marks"), F.array_join("runs", " ").alias("chords"), F.array_join(pitch.normalise(F.col("runs"), F.lit(2)), " ").alias("moved"),
        F.sha2(F.array_join(songs.lyric_words(F.col("body")), " "), 256).alias("sung"), lines.quality_gate(F.col("body"), songs.CHORD).alias("good"), F.array_join(lines.lead_lines(F.col("body")), "|").alias("lead"), songs.has_inline(typed).alias("inline"),
    )


# -- K7, F63 ----------------------------------------------------------------------------------------------------------------
@query(f"""WITH d AS (SELECT doc_id, lang, text, {TITLE_SQL} AS old, length(text) - length(replace(text, {TITLE_SQL}, '')) AS gone FROM documents WHERE text IS NOT NULL AND {TITLE_SQL} <> '?')
SELECT doc_id, sha256(replace(text, old, '<' || old || '>')) AS patched, sha256('{{"lang":"' || lang || '","n":' || length(text) || '}}') AS key FROM d WHERE gone = length(old)""")
def checked_patch(spark, sf_dir):
    """The first word of every document that has it once is put in angle brackets; and a key over a document's language and length."""
    old = F.get(F.filter(F.split("text", "[^A-Za-zÀ-ÿ]+"), lambda w: w != ""), F.lit(0))
    once = table(spark, sf_dir, "documents").withColumn("old", old).filter("old is not null").filter((F.length("text") - F.length(F.replace("text", "old", F.lit("")))) == F.length("old"))
    return once.select("doc_id", F.sha2(rules.patch_once(F.col("text"), F.col("old"), F.concat(F.lit("<"), "old", F.lit(">"))), 256).alias("patched"), rules.content_key(F.col("lang"), F.length("text").alias("n")).alias("key"))


# -- T8, T10, T16 -----------------------------------------------------------------------------------------------------------
_MERGED = f"""it AS (SELECT doc_id AS id, ['a', 'b', 'c'][doc_id % 3 + 1] AS src, {TITLE_SQL} || CASE WHEN doc_id % 4 = 1 THEN ' (II)' ELSE '' END AS title, doc_id % 5 AS part, CASE WHEN doc_id % 4 = 0 THEN source END AS artist, doc_id % 300 AS page FROM documents),
x AS (SELECT doc_id AS dropped, component AS kept FROM comp WHERE doc_id <> component AND doc_id % 2 = 0)"""


def merge_parts(spark, sf_dir):
    docs = items(spark, sf_dir)
    id_, src = F.col("num"), F.get(F.array(*map(F.lit, "abc")), (F.col("num") % 3).cast("int"))
    rows = docs.select(id_.alias("id"), src.alias("src"), F.concat("title", F.when(id_ % 4 == 1, " (II)").otherwise("")).alias("title"), (id_ % 5).alias("part"), F.when(id_ % 4 == 0, F.col("source")).alias("artist"), (id_ % 300).cast("int").alias("page"))
    members = linking.components(spark, sf_dir).select(F.col("doc_id").alias("node"), "component")
    return rows, cut_lineage(members), members.filter("node <> component and node % 2 = 0").select(F.col("node").alias("dropped"), F.col("component").alias("kept"))


@query(rf"""WITH RECURSIVE {linking.COMPONENTS}, {_MERGED},
gr AS (SELECT it.*, component, strpos('abc', src) AS rank FROM it LEFT JOIN comp ON comp.doc_id = id),
m AS (SELECT component, part, count(*) AS n, min(id) AS at FROM gr WHERE component IS NOT NULL GROUP BY ALL),
p AS (SELECT gr.component, CASE WHEN bool_or(gr.part = 3) THEN 3 ELSE coalesce(arg_min(gr.part, gr.id) FILTER (src = 'a'), (SELECT arg_max(m.part, (m.n, -m.at)) FROM m WHERE m.component = gr.component)) END AS part, arg_min(artist, id) FILTER (src <> 'a' AND artist IS NOT NULL) AS artist FROM gr WHERE component IS NOT NULL GROUP BY gr.component),
l AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY rank, title, id) AS nth, count(*) OVER (PARTITION BY component) AS n, first_value(title) OVER (PARTITION BY component ORDER BY rank, title, id) AS base FROM gr WHERE id NOT IN (SELECT dropped FROM x)),
o AS (SELECT l.id, l.src, CASE WHEN l.component IS NULL THEN l.title WHEN n = 1 THEN regexp_replace(l.title, ' \(II\)$', '') ELSE regexp_replace(base, ' \(II\)$', '') || ' (' || ['I', 'II', 'III', 'IV', 'V', 'VI'][nth] || ')' END AS title,
  coalesce(p.part, l.part) AS part, CASE WHEN l.src = 'a' THEN coalesce(p.artist, l.artist) ELSE l.artist END AS artist FROM l LEFT JOIN p USING (component)),
a AS (SELECT kept, array_to_string(list(src || ', p. ' || page ORDER BY src || ', p. ' || page), ' · ') AS also FROM x JOIN it ON it.id = dropped GROUP BY kept)
SELECT row_number() OVER (ORDER BY part, regexp_replace({_FOLD.format("title")}, '^[^a-z0-9]+', ''), o.id) AS num, o.id, title, part, artist, coalesce(also, '') AS also FROM o LEFT JOIN a ON a.kept = o.id""")
def merge_build(spark, sf_dir):
    """T10 with T8: the documents as items of three sources, near-duplicates as variants, every second one merged away."""
    rows, members, dropped = merge_parts(spark, sf_dir)
    return songs.merged_book(rows, members, dropped, F.expr("locate(src, 'abc')"), "a", always=3, beyond="untitled").select("num", "id", "title", "part", "artist", "also")


@query(f"""WITH RECURSIVE {linking.COMPONENTS}, {_MERGED}, ee AS (SELECT node.doc_id AS b, node.component AS a FROM comp node WHERE node.doc_id <> node.component),
s AS (SELECT component, count(*) AS size FROM comp GROUP BY ALL)
SELECT 'groups of size' AS what, size::VARCHAR AS key, count(*) AS n FROM s GROUP BY ALL UNION ALL SELECT 'pairs of', least(p.src, q.src) || ' - ' || greatest(p.src, q.src), count(*) FROM ee JOIN it p ON p.id = a JOIN it q ON q.id = b GROUP BY ALL
UNION ALL SELECT 'merges', '', count(*) FROM x UNION ALL SELECT 'items of part', part::VARCHAR, count(*) FROM it GROUP BY ALL""")
def merge_plan(spark, sf_dir):
    """What a merge of the documents would do."""
    rows, members, dropped = merge_parts(spark, sf_dir)
    pairs = members.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return songs.plan_report(rows.withColumn("part", F.col("part").cast("int")), pairs, members, dropped)


# -- K10, O8, T12 -----------------------------------------------------------------------------------------------------------
_LINKED = f"""i AS (SELECT source AS key, upper(source) AS name, list('[' || doc_id || '](#d)' ORDER BY doc_id) AS own FROM documents WHERE doc_id % 5 = 0 GROUP BY ALL),
l AS (SELECT CASE WHEN doc_id % 2 = 0 THEN source ELSE 'x' || lang END AS key, doc_id, {TITLE_SQL} AS title FROM documents WHERE doc_id % 5 = 1),
a AS (SELECT key, list('@ [' || title || '](h' || doc_id || ')' ORDER BY doc_id) AS links FROM l GROUP BY key)"""


@query(f"""WITH {_LINKED} SELECT coalesce(i.key, a.key) AS key, coalesce(i.name, 'New ' || a.key) AS name, sha256(array_to_string(coalesce(own, []) || coalesce(links, []), chr(10))) AS items, len(coalesce(own, [])) + len(coalesce(links, [])) AS n FROM i FULL JOIN a ON a.key = i.key""")
def index_links(spark, sf_dir):
    """Links of documents merged into an index of their sources, twice, the second time over its own output."""
    docs = items(spark, sf_dir)
    own = F.transform(F.sort_array(F.collect_list("num")), lambda x: F.concat(F.lit("["), x.cast("string"), F.lit("](#d)")))
    index = docs.filter("num % 5 = 0").groupBy(F.col("source").alias("key")).agg(F.upper(F.first("source")).alias("name"), own.alias("items"))
    key = F.when(F.col("num") % 2 == 0, F.col("source")).otherwise(F.concat(F.lit("x"), "lang"))
    links = docs.filter("num % 5 = 1").select(key.alias("key"), F.concat(F.lit("New "), key).alias("name"), "title", F.concat(F.lit("h"), F.col("num").cast("string")).alias("href"), F.col("num").alias("at"))
    once = cut_lineage(indexing.merge_links(index, links, "key", "at"))
    twice = indexing.merge_links(once, links, "key", "at")
    return twice.select("key", "name", F.sha2(F.array_join("items", "\n"), 256).alias("items"), F.size("items").cast("long").alias("n"))


_TABS = f"""t AS (SELECT CASE WHEN doc_id % 3 = 0 THEN 'The ' || source ELSE source END AS artist, {TITLE_SQL} AS title, 'u' || doc_id AS href, doc_id AS id, CASE WHEN doc_id % 7 <> 0 THEN length(text) % 50 END AS fav, CASE WHEN doc_id % 5 <> 0 THEN (length(text) % 40) / 8.0 END AS rating, length(text) % 13 AS ratings FROM documents)"""
_SPACED = "trim(regexp_replace(strip_accents(lower({0})), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""WITH {_TABS}, k AS (SELECT *, CASE WHEN {_SPACED.format("artist")} = 'the src2' THEN 'src2' ELSE {_SPACED.format("artist")} END AS key, {_SPACED.format("title")} AS t FROM t),
b AS (SELECT key, t, arg_max(href, (coalesce(fav, 0) + coalesce(rating, 0) * coalesce(ratings, 0), coalesce(ratings, 0), coalesce(fav, 0), -id)) AS href, arg_max(title, (len(regexp_extract_all(title, '[äçèéêíñóöü]')), -id)) AS title FROM k GROUP BY key, t),
x AS (SELECT DISTINCT source AS key, upper(source) AS artist FROM documents WHERE doc_id % 2 = 0), h AS (SELECT DISTINCT key FROM b),
m AS (SELECT coalesce(x.key, h.key) AS key, artist, CASE WHEN x.key IS NULL THEN 'right' WHEN h.key IS NULL THEN 'left' ELSE 'both' END AS side FROM x FULL JOIN h ON h.key = x.key)
SELECT m.key, artist, side, b.t, href, title, row_number() OVER (ORDER BY m.key, b.t NULLS FIRST) AS place FROM m LEFT JOIN b USING (key)""")
def best_links(spark, sf_dir):
    """Documents as tabs of their sources."""
    n, id_ = F.length("text"), F.col("num")
    tabs = items(spark, sf_dir).select(
        F.concat(F.when(id_ % 3 == 0, "The ").otherwise(""), F.col("source")).alias("artist"), "title", F.concat(F.lit("u"), id_.cast("string")).alias("href"), id_.alias("id"),
        F.when(id_ % 7 != 0, n % 50).alias("favourites"), F.when(id_ % 5 != 0, (n % 40) / 8.0).alias("rating"), (n % 13).alias("ratings"),
    )
    index = items(spark, sf_dir).filter("num % 2 = 0").select(F.col("source").alias("key"), F.upper("source").alias("artist")).distinct()
    return songs.best_links(tabs, index, spark.createDataFrame([("the src2", "src2")], "alias string, target string"), "[äçèéêíñóöü]").select("key", "artist", "side", "t", "href", "title", "place")
