"""Queries on songs made of the documents' own lines: symbols over lyrics, strophe numbers, indents, repeat signs.

Every document becomes the rows of a song by one rule of its text, stated in SQL as well: verses end at line ends, commas
and full stops; words say which symbol stands over them. The oracles work on these rows with joins, windows and recursions of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.catalog import query, table
from corpusforge.functions.text import let
from corpusforge.operators import folds, songs
from corpusforge.session import PART_BYTES, dealt

LABELS = ["C", "Am", "F#", "G7", "Dm", "Bb", "E7", "A", "Em", "B7", "D/F#", "Gsus4"]


def verses(text: Column) -> Column:
    """Lines of a text, divided after commas and full stops as well."""
    return F.split(F.replace(F.replace(text, F.lit(", "), F.lit(",\n")), F.lit(". "), F.lit(".\n")), "\n")


VERSES = "string_split(replace(replace(text, ', ', ',' || chr(10)), '. ', '.' || chr(10)), chr(10))"


def song(text: Column) -> Column:
    """array of rows: over every other verse a row of symbols; verses are indented, some numbered or marked as refrain; some end a strophe."""
    labels = F.array(*map(F.lit, LABELS))

    def rows(verse: Column, i: Column) -> Column:
        words = F.filter(F.split(verse, " "), lambda w: w != "")
        over = lambda w, j: F.rpad(F.when(j % 3 == 1, F.get(labels, F.length(w) % 12)).otherwise(""), F.greatest(F.length(w) + 1, F.lit(7)), " ")
        symbols = F.when((i % 2 == 0) & (F.size(words) > 1), F.array(F.rtrim(F.array_join(F.transform(words, over), "")))).otherwise(F.array().cast("array<string>"))
        sign = F.when(i % 5 == 0, F.concat((i % 9 + 1).cast("string"), F.lit(". "))).when(i % 7 == 3, "R: ").otherwise("")
        lyric = F.array(F.concat(F.repeat(F.lit(" "), (i % 3).cast("int")), sign, verse))
        return F.concat(symbols, lyric, F.when(F.length(verse) % 6 == 0, F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))

    return F.flatten(F.transform(verses(text), rows))


_OVER = f"rpad(CASE WHEN (j - 1) % 3 = 1 THEN ({LABELS})[length(w) % 12 + 1] ELSE '' END, greatest(length(w) + 1, 7)::INT, ' ')"
_SIGN = "CASE WHEN (i - 1) % 5 = 0 THEN ((i - 1) % 9 + 1)::VARCHAR || '. ' WHEN (i - 1) % 7 = 3 THEN 'R: ' ELSE '' END"
SONG = f"""flatten(list_transform({VERSES}, lambda verse, i:
    CASE WHEN (i - 1) % 2 = 0 AND len(list_filter(string_split(verse, ' '), lambda w: w <> '')) > 1
      THEN [rtrim(array_to_string(list_transform(list_filter(string_split(verse, ' '), lambda w: w <> ''), lambda w, j: {_OVER}), ''), ' ')] ELSE []::VARCHAR[] END
    || [repeat(' ', (i - 1) % 3) || {_SIGN} || verse] || CASE WHEN length(verse) % 6 = 0 THEN [''] ELSE []::VARCHAR[] END))"""


def symbols_sql(line: str) -> str:
    """SQL for all_tokens with the one grammar of symbols."""
    tokens = f"list_filter(regexp_split_to_array({line}, '\\s+'), lambda t: t <> '' AND NOT regexp_matches(t, '{songs.BETWEEN}'))"
    return f"(len({tokens}) > 0 AND len(list_filter({tokens}, lambda t: NOT regexp_matches(t, '{songs.CHORD}'))) = 0)"


def placed_sql(tokens: str) -> str:
    """SQL for tokens {p, t} placed at their columns, at least one blank between two."""
    wide = "CASE WHEN a.line = '' THEN 0 ELSE length(a.line) + 1 END"
    return f"""list_reduce(list_transform({tokens}, lambda x: {{'p': x.p::BIGINT, 't': x.t, 'line': ''}}),
      lambda a, b: {{'p': 0::BIGINT, 't': '', 'line': rpad(a.line, greatest(b.p, {wide})::INT, ' ') || b.t}}, {{'p': 0::BIGINT, 't': '', 'line': ''}}).line"""


def tokens_sql(line: str) -> str:
    """SQL for [{p, t}] of the words of a line: a word's column is what the words and blanks before it take."""
    gaps, words = (f"regexp_extract_all({line}, '( *)([^ ]+)', {k})" for k in (1, 2))
    return f"""list_transform({words}, lambda w, k: {{'p': coalesce(list_sum(list_transform({words}[:k - 1], lambda x: length(x))), 0) + list_sum(list_transform({gaps}[:k], lambda x: length(x))), 't': w}})"""


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text").filter("text is not null")


# -- W17 --------------------------------------------------------------------------------------------------------------------
@query(f"""WITH RECURSIVE v AS (SELECT doc_id, {VERSES} AS rows FROM documents WHERE text IS NOT NULL),
r AS (SELECT doc_id, unnest(rows) AS line, generate_subscripts(rows, 1) AS i FROM v),
j AS (
  SELECT doc_id, i, line AS joined, 1 AS nth FROM r WHERE i = 1
  UNION ALL
  SELECT j.doc_id, r.i, CASE WHEN joins THEN rtrim(joined, ' ') || CASE WHEN rtrim(joined, ' ') LIKE '%-' THEN '' ELSE ' ' END || trim(line, ' ') ELSE line END, nth + (NOT joins)::INT
  FROM j JOIN (SELECT * FROM r) r ON r.doc_id = j.doc_id AND r.i = j.i + 1,
  LATERAL (SELECT rtrim(joined, ' ') <> '' AND regexp_matches(trim(line, ' '), '^\\p{{Ll}}') AND len(regexp_split_to_array(trim(line, ' '), '\\s+')) <= 3
    AND NOT regexp_matches(rtrim(joined, ' '), '[.!?:;]$') AND NOT {symbols_sql("rtrim(joined, ' ')")} AS joins)
)
SELECT doc_id, (nth - 1)::BIGINT AS ord, arg_max(joined, i) AS line FROM j GROUP BY ALL""")
def joined_wraps(spark, sf_dir):
    """W17 over every document's verses; here a comma doesn't close a line, so that short pieces join."""
    joined = folds.join_wraps(verses(F.col("text")), 3, ".!?:;", songs.CHORD, songs.BETWEEN)
    return documents(spark, sf_dir).select("doc_id", F.posexplode(joined).alias("ord", "line")).select("doc_id", F.col("ord").cast("long").alias("ord"), "line")


# -- W18 --------------------------------------------------------------------------------------------------------------------
def signed(text: Column) -> Column:
    """Verses with slashes: some open, some close with a count, some hold a bracketed slash; some are blank."""
    def sign(v: Column) -> Column:
        n = F.length(v)
        row = F.concat(F.when(n % 7 == 0, "/ ").otherwise(""), v, F.when(n % 5 == 0, " [G/4]").otherwise(""), F.when(n % 11 < 2, F.concat(F.lit(" / x"), (n % 3 + 2).cast("string"))).otherwise(""))
        return F.when(n % 13 == 0, "").otherwise(row)

    return F.transform(verses(text), sign)


_SIGNED = f"""SELECT doc_id, generate_subscripts(rows, 1) - 1 AS i, unnest(list_transform(rows, lambda v: CASE WHEN length(v) % 13 = 0 THEN '' ELSE
    CASE WHEN length(v) % 7 = 0 THEN '/ ' ELSE '' END || v || CASE WHEN length(v) % 5 = 0 THEN ' [G/4]' ELSE '' END || CASE WHEN length(v) % 11 < 2 THEN ' / x' || (length(v) % 3 + 2) ELSE '' END END)) AS line
  FROM (SELECT doc_id, {VERSES} AS rows FROM documents WHERE text IS NOT NULL)"""
_SPANS = rf"""WITH l AS ({_SIGNED}), c AS (SELECT *, regexp_extract(line, '/\s*[xX](\d+)\s*$', 1) AS times, regexp_replace(line, '/\s*[xX]\d+\s*$', '') AS before FROM l),
o AS (SELECT *, length(regexp_extract(before, '^((?:[^/\[]|\[[^\]]*\])*)/', 0)) - 1 AS slash,
    sum((trim(line) = '')::INT) OVER w AS block, coalesce(sum((times <> '')::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
p AS (SELECT *, max(CASE WHEN slash >= 0 THEN i END) OVER (PARTITION BY doc_id, block, earlier ORDER BY i) AS first FROM o)"""


@query(f"{_SPANS} SELECT doc_id, first::BIGINT AS first, i::BIGINT AS last, times::BIGINT AS times, CASE WHEN first IS NULL THEN line END AS error FROM p WHERE times <> ''")
def repeat_passages(spark, sf_dir):
    """Every passage of every document; a closing sign without an opening one is a row with the line as its error."""
    def rows(x: Column) -> Column:
        return F.transform(folds.repeat_spans(x), lambda s: F.struct(s["first"].cast("long").alias("first"), s["last"].cast("long").alias("last"), s["times"].cast("long").alias("times"), F.when(s["first"].isNull(), F.get(x, s["last"])).alias("error")))

    return documents(spark, sf_dir).select("doc_id", F.explode(let(signed(F.col("text")), rows)).alias("s")).select("doc_id", "s.*")


@query(rf"""{_SPANS}, e AS (SELECT doc_id, first, i AS last, times::INT AS times FROM p WHERE times <> '' AND first IS NOT NULL),
d AS (SELECT o.doc_id, o.i, line, CASE WHEN e.last IS NOT NULL THEN rtrim(before, ' ') || ' :||' || CASE WHEN e.times = 2 THEN '' ELSE ' ×' || e.times END ELSE line END AS closed, slash, e.last
  FROM o LEFT JOIN e ON e.doc_id = o.doc_id AND e.last = o.i)
SELECT d.doc_id, d.i::BIGINT AS ord, CASE WHEN s.first IS NULL THEN closed ELSE left(closed, slash::INT) || '||: ' || ltrim(substr(closed, slash::INT + 2), ' ') END AS line
FROM d LEFT JOIN e s ON s.doc_id = d.doc_id AND s.first = d.i WHERE s.first IS NOT NULL OR d.last IS NOT NULL""")
def barred_passages(spark, sf_dir):
    """The lines that change when passages are drawn with repeat bars."""
    both = let(signed(F.col("text")), lambda x: F.arrays_zip(x.alias("old"), folds.bar_repeats(x).alias("line")))
    return documents(spark, sf_dir).select("doc_id", F.posexplode(both).alias("ord", "x")).filter("x.old <> x.line").select("doc_id", F.col("ord").cast("long").alias("ord"), "x.line")


# -- F27 --------------------------------------------------------------------------------------------------------------------
def _wrapped_sql(rows: str, width: int) -> str:
    """Cuts each line again and again at its last blank that fits, with the symbols over it; rows(doc_id, i, line) to (doc_id, i, n, line)."""
    return rf"""WITH RECURSIVE r AS ({rows}), k AS (SELECT *, {symbols_sql("line")} AS sym, trim(line) = '' AS blank FROM r),
u AS (SELECT *, lead(line) OVER w AS below, coalesce(lead(sym) OVER w, true) OR coalesce(lead(blank) OVER w, true) AS no_lyric, coalesce(lag(sym) OVER w, false) AND NOT sym AND NOT blank AS taken FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT *, CASE WHEN taken THEN 'taken' WHEN sym AND NOT no_lyric THEN CASE WHEN length(line) <= {width} AND length(below) <= {width} THEN 'short pair' ELSE 'pair' END WHEN blank THEN 'blank' WHEN length(line) <= {width} THEN 'short' WHEN sym THEN 'symbols' ELSE 'plain' END AS kind FROM u),
c AS (
  SELECT doc_id, i, 0 AS n, NULL::VARCHAR AS piece, NULL::STRUCT(p BIGINT, t VARCHAR)[] AS over, CASE kind WHEN 'pair' THEN below ELSE rtrim(line, ' ') END AS rest, CASE kind WHEN 'pair' THEN {tokens_sql("line")} ELSE [] END::STRUCT(p BIGINT, t VARCHAR)[] AS tokens
  FROM t WHERE kind IN ('pair', 'plain')
  UNION ALL
  SELECT doc_id, i, n + 1, CASE WHEN whole THEN rest ELSE rtrim(left(rest, cut), ' ') END, CASE WHEN whole THEN tokens ELSE list_filter(tokens, lambda x: x.p < cut) END,
    CASE WHEN NOT whole THEN '  ' || tail END, CASE WHEN whole THEN [] ELSE list_transform(list_filter(tokens, lambda x: x.p >= cut), lambda x: {{'p': greatest(x.p - (length(rest) - length(tail) - 2), 2), 't': x.t}}) END
  FROM (
    SELECT *, ltrim(substr(rest, cut + 1), ' ') AS tail, length(rest) <= {width} OR cut <= 0 OR length(ltrim(substr(rest, cut + 1), ' ')) + 2 >= length(rest) AS whole
    FROM (
      SELECT *, CASE WHEN last > 0 AND trim(left(rest, last)) <> '' THEN last WHEN strpos(substr(rest, greatest(last, 0) + 2), ' ') = 0 THEN -1 ELSE greatest(last, 0) + strpos(substr(rest, greatest(last, 0) + 2), ' ') END::INT AS cut
      FROM (SELECT *, CASE WHEN strpos(reverse(substr(rest, 2, {width})), ' ') = 0 THEN -1 ELSE length(substr(rest, 2, {width})) - strpos(reverse(substr(rest, 2, {width})), ' ') + 1 END::INT AS last FROM c WHERE rest IS NOT NULL)
    )
  )
), y AS (SELECT doc_id, i, {tokens_sql("line")} AS tokens FROM t WHERE kind = 'symbols'),
s AS (
  SELECT doc_id, i, 0 AS j, '' AS line, false AS later, 0 AS n, tokens FROM y
  UNION ALL
  SELECT doc_id, i, j + 1, CASE WHEN over THEN '  ' || tokens[j + 1].t ELSE grown END, later OR over, n + over::INT, tokens
  FROM (SELECT *, line <> '' AND length(grown) > {width} AS over FROM (
    SELECT *, rpad(line, greatest(CASE WHEN later THEN greatest(tokens[j + 1].p, 2) ELSE tokens[j + 1].p END, CASE WHEN line = '' THEN 0 ELSE length(line) + 1 END)::INT, ' ') || tokens[j + 1].t AS grown FROM s WHERE j < len(tokens)))
)
SELECT doc_id, i, n * 2 AS n, piece AS line FROM c WHERE piece IS NOT NULL
UNION ALL SELECT doc_id, i, n * 2 - 1, {placed_sql("over")} FROM c WHERE piece IS NOT NULL AND len(over) > 0
UNION ALL SELECT doc_id, i, n, arg_max(line, j) FROM s GROUP BY ALL
UNION ALL SELECT doc_id, i, 0, CASE WHEN kind = 'blank' THEN '' ELSE line END FROM t WHERE kind IN ('blank', 'short', 'short pair')
UNION ALL SELECT doc_id, i, 1, below FROM t WHERE kind = 'short pair'"""


_SONG_ROWS = f"SELECT doc_id, unnest(rows) AS line, generate_subscripts(rows, 1) AS i FROM (SELECT doc_id, {SONG} AS rows FROM documents WHERE text IS NOT NULL)"


@query(f"SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, n) - 1)::BIGINT AS ord, line FROM ({_wrapped_sql(_SONG_ROWS, 40)})")
def wrapped_songs(spark, sf_dir):
    """every document's song wrapped to 40 characters, symbols with their lyrics."""
    rows = folds.wrap_lines(song(F.col("text")), 40, songs.CHORD, songs.BETWEEN)
    return documents(spark, sf_dir).select("doc_id", F.posexplode(rows).alias("ord", "line")).select("doc_id", F.col("ord").cast("long").alias("ord"), "line")


_PLAIN_ROWS = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL"


@query(f"SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i, n) - 1)::BIGINT AS ord, line FROM ({_wrapped_sql(_PLAIN_ROWS, 72)})")
def wrap_lines(spark, sf_dir):
    """every line of every document wrapped to 72 characters."""
    rows = folds.wrap_lines(F.split("text", "\n"), 72, songs.CHORD, songs.BETWEEN)
    return documents(spark, sf_dir).select("doc_id", F.posexplode(rows).alias("ord", "line")).select("doc_id", F.col("ord").cast("long").alias("ord"), "line")


# -- W16 --------------------------------------------------------------------------------------------------------------------
_BLOCKS = f"SELECT doc_id, unnest(rows) AS line, generate_subscripts(rows, 1) - 1 AS i FROM (SELECT doc_id, {SONG} || CASE WHEN doc_id % 10 = 0 THEN ['a [Am]b'] ELSE [] END AS rows FROM documents WHERE text IS NOT NULL)"


@query(rf"""WITH r AS ({_BLOCKS}), h AS (SELECT doc_id, i, rtrim(line) AS line, trim(line) AS bare, length(rtrim(line)) - length(trim(line)) AS lead, bool_or(contains(line, '[')) OVER (PARTITION BY doc_id) AS held, line AS old FROM r),
k AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN {symbols_sql("bare")} THEN 'symbols' ELSE 'verse' END AS kind, regexp_extract(bare, '^(?:\d{{1,2}}\.|R\d?\s?:)\s*') AS found FROM h),
s AS (SELECT *, CASE WHEN kind = 'verse' AND length(found) < length(bare) AND NOT regexp_matches(bare, '^\d+\.\d') THEN found ELSE '' END AS sign FROM k),
n AS (SELECT s.*, (SELECT min(t.i) FROM s t WHERE t.doc_id = s.doc_id AND t.i > s.i AND t.kind <> 'symbols') AS after, coalesce((SELECT max(t.i) FROM s t WHERE t.doc_id = s.doc_id AND t.i < s.i AND t.kind <> 'symbols'), -1) AS head FROM s),
m AS (SELECT n.*, CASE WHEN a.kind = 'verse' THEN a.lead + length(a.sign) ELSE n.lead END AS shift FROM n LEFT JOIN s a ON a.doc_id = n.doc_id AND a.i = n.after),
o AS (
  SELECT doc_id, i AS place, 0 AS side, CASE WHEN held THEN old WHEN kind = 'symbols' THEN {placed_sql(f"list_transform({tokens_sql('line')}, lambda x: {{'p': greatest(x.p - shift, 0), 't': x.t}})")} ELSE substr(bare, length(sign) + 1) END AS line FROM m
  UNION ALL SELECT doc_id, head, 1, rtrim(sign) FROM m WHERE sign <> '' AND NOT held
)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY place, side) - 1)::INT AS ord, line FROM o""")
def aligned_songs(spark, sf_dir):
    """W16 on every document's song; those with a bracketed symbol stay as they are."""
    rows = F.concat(song(F.col("text")), F.when(F.col("doc_id") % 10 == 0, F.array(F.lit("a [Am]b"))).otherwise(F.array().cast("array<string>")))
    # Texts are dealt by document, in parts of bounded size, before they become rows: the windows need no other shuffle.
    docs = dealt(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", PART_BYTES // 2).select("doc_id", "text").filter("text is not null")
    return songs.align_rows(docs.select("doc_id", F.posexplode(rows).alias("ord", "line")), ["doc_id"], "ord")
