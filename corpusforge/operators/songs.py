"""Composite steps on items with symbol lines."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions import pitch
from corpusforge.functions.text import all_tokens, base_title, comma_below, fold, let, mark_repeats, norm_spaced, sort_key
from corpusforge.session import small

from .folds import fold as running
from .folds import place, tokens
from .indexing import merged_index, number_globally
from .lines import carry_forward, fences, gap_to_previous, islands
from .survive import majority

#: One grammar of symbol tokens, a fixed value: root, quality, bass, and what may stand between chords.
CHORD = r"^\(?[A-G][#b]?(?:m|maj|min|dim|aug|sus|add|M)?\d*(?:sus\d|add\d+|[#b]\d+)*(?:/[A-G][#b]?)?\)?$"
BETWEEN = r"^(?:\||-|/|x\d+|\(|\)|\^|N\.C\.)$"


def is_chord_line(line: Column) -> Column:
    return all_tokens(line, CHORD, BETWEEN)


def row_kinds(rows: DataFrame, partition: str, order: str, fence: str | None = None) -> DataFrame:
    """Kind of each row: tab and prose by the fence they stand in (a column of tab, prose or text; without one, all are text), blank, a row of symbols over a lyric (pair),
    one alone (interlude), the lyric of a pair (paired), a lyric with symbols of its own (inline) or plain."""
    w = Window.partitionBy(partition).orderBy(order)
    inside = F.when(F.col(fence).isin("tab", "prose"), F.col(fence)) if fence else F.lit(None).cast("string")
    base = F.coalesce(inside, F.when(F.trim("line") == "", "blank").when(is_chord_line(F.col("line")), "symbols").otherwise("lyric"))
    r = rows.withColumn("_k", base).withColumn("_n", F.lead(base).over(w)).withColumn("_p", F.lag(base).over(w))
    lyric = F.when(F.col("_p") == "symbols", "paired").when(F.size(inline_tokens(F.col("line"))) > 0, "inline").otherwise("plain")
    kind = F.when(F.col("_k") == "symbols", F.when(F.col("_n") == "lyric", "pair").otherwise("interlude")).when(F.col("_k") == "lyric", lyric).otherwise(F.col("_k"))
    return r.withColumn("kind", kind).drop("_k", "_n", "_p")


def runs_of(rows: DataFrame, partition: str, order: str, kind: str = "tab") -> DataFrame:
    """(partition, run, first, last) of neighbouring rows of one kind."""
    changed = F.lag("kind").over(Window.partitionBy(partition).orderBy(order)) != F.col("kind")
    numbered = islands(rows, [partition], [order], changed, "run")
    return numbered.filter(F.col("kind") == kind).groupBy(partition, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"))


def merge_titles(rows: DataFrame, partition: str, order: str, y: str, text: str, near: float = 20.0) -> DataFrame:
    """Neighbouring title lines less than `near` apart become one, joined by a blank."""
    joined = islands(rows, [partition], [order], gap_to_previous(y, [partition], [order]) >= near, "run")
    parts = F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return joined.groupBy(partition, "run").agg(F.min(order).alias(order), F.min(y).alias(y), F.array_join(parts, " ").alias(text)).drop("run")


def propagate_case(glyphs: DataFrame, partition: list[str], order: list[str], unknown: Column, letter: Column) -> DataFrame:
    """A glyph of unknown case takes that of the letter just before it; after anything else it is lower."""
    before = F.lag("c").over(Window.partitionBy(*partition).orderBy(*order))
    upper = before.rlike(r"^\p{Lu}$")
    return glyphs.withColumn("c", F.when(unknown, F.when(F.coalesce(upper, F.lit(False)), F.upper(letter)).otherwise(F.lower(letter))).otherwise(F.col("c")))


def compose_marks(text: Column, table: dict[tuple[str, str], str]) -> Column:
    """F8: (mark, letter) pairs, in either order, become one character."""
    for (mark, letter), made in table.items():
        text = F.replace(F.replace(text, F.lit(mark + letter), F.lit(made)), F.lit(letter + mark), F.lit(made))
    return text


#: Signs in front of a verse that move to a line of their own, and bracketed symbols within lines, fixed patterns.
VERSE_SIGN = r"^(?:\d{1,2}\.(?!\d)|R\d?\s?:|(?i:refren)(?:\s*[xX]\s*\d+)?\s*:)\s*"
BRACKETED = r"\[(?:\([A-G][^\]]*\)|[A-G][^\]]*)\]|\[(?i:no chords?|n\.c\.|nc|riff(?: [^\]]*)?|solo)\]"


def align_rows(rows: DataFrame, partition: list[str], order: str) -> DataFrame:
    """The rows (partition, order, line) of blocks of symbols over verses, without indents and signs in front of verses.

    A verse loses its indent and its sign (a strophe's number, a refrain's mark); a row of symbols moves left as far as the next verse did, if only rows of symbols
    stand between, else by its own indent; symbols stay apart and to the right of the margin. A sign becomes a row above the
    symbols over its verse. A block with bracketed symbols stays as it is. order is numbered anew from 0; doing it twice changes nothing more."""
    block = Window.partitionBy(*partition)
    above, below = (block.orderBy(o).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col(order).asc(), F.col(order).desc()))
    r = rows.withColumn("_held", F.max(F.col("line").rlike(BRACKETED)).over(block)).withColumn("_line", F.regexp_replace("line", r"\s+$", "")).withColumn("_bare", F.trim("_line"))
    r = r.withColumn("_kind", F.when(F.col("_bare") == "", "blank").when(is_chord_line(F.col("_bare")), "symbols").otherwise("verse"))
    sign = F.regexp_extract("_bare", VERSE_SIGN, 0)
    r = r.withColumn("_sign", F.when((F.col("_kind") == "verse") & (F.length(sign) < F.length("_bare")), sign).otherwise("")).withColumn("_lead", F.length("_line") - F.length(F.ltrim("_line")))
    other = F.when(F.col("_kind") != "symbols", F.struct(F.col("_kind").alias("kind"), (F.col("_lead") + F.length("_sign")).alias("shift"), F.col(order).alias("at")))
    r = r.withColumn("_next", F.last(other, ignorenulls=True).over(below)).withColumn("_head", F.last(other, ignorenulls=True).over(above)["at"])
    shift = F.when(F.col("_next.kind") == "verse", F.col("_next.shift")).otherwise(F.col("_lead"))
    moved = let(F.struct(tokens(F.col("_line")).alias("t"), shift.alias("by")), lambda x: place(F.transform(x["t"], lambda t: F.struct(F.greatest(t["col"] - x["by"], F.lit(0)).alias("col"), t["label"].alias("label")))))
    fresh = F.when(F.col("_kind") == "symbols", moved).otherwise(F.expr("substring(_bare, length(_sign) + 1)"))
    put = lambda at, side, line: F.struct(at.alias("at"), F.lit(side).alias("side"), line.alias("line"))
    own = F.array(put(F.col(order), 0, F.when(F.col("_held"), F.col("line")).otherwise(fresh)))
    shown = put(F.col("_head"), 1, F.regexp_replace(F.trim("_sign"), r"\s+:", ":"))  # behind the last row that isn't symbols
    out = r.select(*partition, F.explode(F.when(~F.col("_held") & (F.col("_sign") != ""), F.concat(F.array(shown), own)).otherwise(own)).alias("x"))
    nth = F.row_number().over(block.orderBy(F.col("x.at").asc_nulls_first(), "x.side")) - 1
    return out.select(*partition, nth.alias(order), "x.line")


def hoist_marker(line: Column, marker: str = r"\[(?:Refren|Chorus|Bridge)\]") -> Column:
    """(marker, rest) of a line; the marker is null if there is none."""
    found = F.nullif(F.regexp_extract(line, f"({marker})", 1), F.lit(""))
    return F.struct(found.alias("marker"), F.trim(F.regexp_replace(line, marker, "")).alias("rest"))


def inline_tokens(line: Column) -> Column:
    """array<struct<col, label>> of a line's bracketed chords, markers (as they are shown) and signs of repetition (/); columns count the line without them.
    Other brackets are text."""
    token = rf"(?=[\[^])(?:{BRACKETED}|\^)"

    def label(found: Column) -> Column:
        inner = F.substring(found, F.lit(2), F.length(found) - 2)
        return F.when(found == "^", "/").when(is_mark(inner), mark_label(inner)).otherwise(inner)

    def told(x: Column) -> Column:
        return F.transform(x["found"], lambda f, i: F.struct(F.get(x["ends"], i).alias("col"), label(f).alias("label")))

    # Only the lengths of the gaps are added up one by one; labels don't depend on what stands before them.
    gaps = F.transform(F.split(line, token), lambda g: F.length(g))
    ends = running(gaps, F.lit(0), lambda at, n: (at + n, F.array(at + n)), "int", "int")["out"]
    none = F.array().cast("array<struct<col:int,label:string>>")
    return F.coalesce(let(F.struct(F.regexp_extract_all(line, F.lit(f"({token})"), 1).alias("found"), ends.alias("ends")), told), none)


def without_inline(line: Column) -> Column:
    """The line that inline_tokens counts columns of."""
    return F.regexp_replace(line, rf"{BRACKETED}|\^", "")


def edit_keeping_labels(line: str, edit: Callable[[str], str]) -> str:
    """edits the text between bracketed labels as one, then puts the labels back at their columns; the edit keeps lengths."""
    labels, bare = [], []
    for part in re.split(r"(\[[^\]]*\])", line):
        if part.startswith("["):
            labels.append((sum(map(len, bare)), part))
        else:
            bare.append(part)
    text = "".join(bare)
    fixed = edit(text)
    if len(fixed) != len(text):
        raise ValueError("the edit changed the text's length")
    for at, label in reversed(labels):
        fixed = fixed[:at] + label + fixed[at:]
    return fixed


def first_chord(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, r"\[\(?([A-G][#b]?[^\]/)]*)", 1), F.lit(""))


def transpose_inline(line: Column, steps: Column, flats: Column) -> Column:
    """every bracketed chord of a line moved; other text stays."""
    pieces = F.split(line, r"(?=\[)|(?<=\])")
    moved = F.transform(pieces, lambda p: F.when(p.rlike(r"^\[[A-G]"), F.concat(F.lit("["), pitch.transpose(F.substring(p, F.lit(2), F.length(p) - 2), steps, flats), F.lit("]"))).otherwise(p))
    return F.array_join(moved, "")


def transpose_items(items: DataFrame, rows: DataFrame, id: str, order: str, key: str) -> DataFrame:
    """Rows (id, order, line) of items (id, key) moved so that the first chord becomes the key's root."""
    first = rows.withColumn("_c", first_chord(F.col("line"))).filter("_c is not null").groupBy(id).agg(F.min_by("_c", order).alias("_first"))
    steps = pitch.interval(pitch.pitch_class(pitch.root(F.col("_first"))), pitch.pitch_class(pitch.root(F.col(key))))
    plan = items.join(first, id, "left").select(id, F.coalesce(steps, F.lit(0)).alias("_s"), F.coalesce(pitch.uses_flats(F.col(key)), F.lit(False)).alias("_f"))
    return rows.join(plan, id).withColumn("line", transpose_inline(F.col("line"), F.col("_s"), F.col("_f"))).select(rows.columns)


def quality_score(hearts: Column, rating: Column, count: Column) -> Column:
    """null parts count as 0."""
    zero = F.lit(0.0)
    return F.coalesce(hearts.cast("double"), zero) + F.coalesce(rating * count, zero)


def best_links(tabs: DataFrame, index: DataFrame, aliases: DataFrame, marks: str = "[ăâîșțĂÂÎȘȚ]") -> DataFrame:
    """Of each (artist, title) the link of the best score (then ratings, favourites, smaller id) under its spelling with the most marks (smaller id of equals), merged into
    an index (key, artist). Names compare folded, with gaps between words; figures that are null count as 0. place: by key and folded title.
    tabs(artist, title, href, id, favourites, rating, ratings), aliases(alias, target)."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    score = zero("favourites") + zero("rating") * zero("ratings")
    keyed = tabs.withColumn("key", norm_spaced(F.col("artist"))).join(small(aliases.select(F.col("alias").alias("key"), "target")), "key", "left").withColumn("key", F.coalesce("target", "key"))
    best = keyed.groupBy("key", norm_spaced(F.col("title")).alias("t")).agg(
        F.max_by("href", F.struct(score, zero("ratings"), zero("favourites"), -F.col("id"))).alias("href"), F.max_by("title", F.struct(F.regexp_count("title", F.lit(marks)), -F.col("id"))).alias("title"),
    )
    merged = merged_index(index.select("key", "artist"), best.select("key").distinct(), "key")
    return number_globally(merged.select("key", "artist", "side").join(best, "key", "left"), ["key", "t"], "place")


def regroup(items: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """Items in the order of their sections and folded titles, numbered; an item without a section is an error."""
    joined = items.join(small(sections.select(key, "part", "sub")), key, "left")
    checked = joined.withColumn("part", F.coalesce("part", F.raise_error(F.concat(F.lit("no section for "), F.col(key).cast("string"))).cast("string")))
    return number_globally(checked.withColumn("fold", sort_key(F.col("title"))), ["part", "sub", "fold", key], "number").drop("fold")


# -- predicates and tokens of lines -----------------------------------------------------------------------------------------
#: Formats of the corpus, fixed values: bracketed chords (an optional one in parentheses), markers, lone section signs, bylines.
INLINE = r"\[(\([A-G][^\]]*\)|[A-G][^\]]*)\]"
MARK = r"(?i)^(?:no chords?|n\.c\.|nc|riff(?: [^\]]*)?|solo)$"
SIGN = r"\d{1,2}\.(?!\d)|R\d?\s*:|(?i:refren)(?:\s*[xX]\s*\d+)?\s*:"
SIGN_ALONE = r"^\s*(?:\d{1,2}\.(?!\d)|R\d?\s*:|(?i:refren)(?:\s*[xX]\s*\d+)?\s*:?|(?i:bis)|(?i:strofa\s*\d*)\s*:?|(?i:solo|intro|final|bridge)\s*:?)\s*$"
BYLINE = r"(?iU)^\(|^(?:tradi[țt]ional|popular|necunoscut)\b"


def is_mark(label: Column) -> Column:
    """The label of a bracket is a marker and no chord."""
    return label.rlike(MARK)


def mark_label(label: Column) -> Column:
    """How a marker is shown: no chord as N.C., a bare riff in lower case, others as written."""
    return F.when(F.startswith(F.lower(label), F.lit("n")), "N.C.").when(F.lower(label) == "riff", "riff").otherwise(label)


def split_optional(label: Column) -> Column:
    """(chord, optional): a chord in parentheses may be left out."""
    inner = F.regexp_extract(label, r"^\((.*)\)$", 1)
    return F.struct(F.when(label.rlike(r"^\(.*\)$"), inner).otherwise(label).alias("chord"), label.rlike(r"^\(.*\)$").alias("optional"))


def has_inline(body: Column) -> Column:
    """A line of a text fence that is no line of chords holds a bracketed chord or marker. body: array<struct<kind, line>>."""
    marked = lambda x: F.exists(F.regexp_extract_all(x, F.lit(r"\[([^\]]*)\]"), 1), is_mark)
    return F.exists(body, lambda x: (x["kind"] == "text") & ~is_chord_line(x["line"]) & (x["line"].rlike(INLINE) | marked(x["line"])))


def is_byline(line: Column) -> Column:
    """A line before the body that names an author."""
    return line.rlike(BYLINE)


def without_sections(items: DataFrame, section: str, denied: list[str]) -> DataFrame:
    """Items of other sections than the denied ones; items without a section stay."""
    return items.filter(~F.coalesce(F.col(section).isin(denied), F.lit(False)))


def clean_dots(lines: Column) -> Column:
    """Lines of a lone full stop go; one before white space is a blank, so that columns stay."""
    return F.transform(F.filter(lines, lambda x: F.trim(x) != "."), lambda x: F.regexp_replace(x, r"^\.(\s+)", " $1"))


def two_row_tokens(line: Column) -> Column:
    """array<struct<col, label>> of the words of a line, as inline_tokens gives them."""
    pieces = F.regexp_extract_all(line, F.lit(r"(\s*\S+)"), 1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<col:int,label:string>>").alias("out"))
    step = lambda acc, p: F.struct((acc["at"] + F.length(p)).alias("at"), F.concat(acc["out"], F.array(F.struct((acc["at"] + F.length(p) - F.length(F.ltrim(p))).alias("col"), F.ltrim(p).alias("label")))).alias("out"))
    return F.aggregate(pieces, start, step)["out"]


def lyric_words(body: Column) -> Column:
    """the folded words that are sung: bracketed chords go without leaving a gap, lines of chords and lone signs go, a leading sign goes."""
    bare = F.transform(body, lambda x: F.trim(F.regexp_replace(x, r"\[[^\]]*\]", "")))
    sung = F.filter(bare, lambda x: (x != "") & ~is_chord_line(x) & ~x.rlike(SIGN_ALONE))
    text = F.transform(sung, lambda x: F.regexp_replace(fold(F.regexp_replace(x, rf"^\s*(?:{SIGN})\s*", "")), r"[^a-z0-9\s]", " "))
    return F.filter(F.split(F.array_join(text, " "), r"\s+"), lambda w: w != "")


# -- composites -------------------------------------------------------------------------------------------------------------
def rewrite_fenced(rows: DataFrame, partition: str, order: str, kind: str, rewrite: Callable[[Column], Column], skip: Callable[[Column], Column]) -> DataFrame:
    """K8: rewrites the lines inside fences of one kind, but those to skip; adds changed. Doing it twice changes nothing more if the
    rewriting itself doesn't."""
    f = fences(rows, partition, order, F.col("line").rlike("^```"))
    opener = F.when(F.col("line").rlike("^```"), F.coalesce(F.nullif(F.trim(F.expr("substring(line, 4)")), F.lit("")), F.lit("text")))
    f = carry_forward(f, partition, order, F.when(F.col("is_marker"), opener), "_kind")
    fresh = F.when(F.col("inside") & (F.col("_kind") == kind) & ~skip(F.col("line")), rewrite(F.col("line"))).otherwise(F.col("line"))
    return f.withColumn("_old", F.col("line")).withColumn("line", fresh).withColumn("changed", F.col("_old") != F.col("line")).select(*rows.columns, "changed")


def hold_repeats(line: Column) -> Column:
    """A bracketed chord equal to the bracket just before it on the line becomes ^; markers and optional chords stay and divide."""
    token = r"\[(?:\([A-G][^\]]*\)|[A-G][^\]]*|(?i:no chords?|n\.c\.|nc|riff(?: [^\]]*)?|solo))\]"
    found = F.regexp_extract_all(line, F.lit(f"({token})"), 1)
    gaps = F.split(line, token)
    signs = mark_repeats(found, "^", r"^\[(?![A-G])|^\[\(")
    return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, F.coalesce(F.get(signs, i), F.lit("")))), "")


def contents(rows: DataFrame) -> DataFrame:
    """(doc, page, title, artist, part) of the entries of tables of contents (doc, ord, line): `12. Title (Artist) ..... 34`. A line that names the second part
    opens it; from there on, a short line that is no entry, number or running head names the artist of the entries below. An entry's own artist
    counts more; the later of two entries of one page counts."""
    entry, named = r"^\s*\d+\.\s*(.+?)\s*\.{3,}\s*,?\.*\s*(\d+)\s*$", r"\(([^()]*)\)?\s*$"
    line = F.rtrim("line")
    r = rows.withColumn("_entry", line.rlike(entry)).withColumn("_short", F.trim("line"))
    r = carry_forward(r, "doc", "ord", F.when(F.col("line").contains("PARTEA A II-A"), F.lit(2)), "part").withColumn("part", F.coalesce("part", F.lit(1)))
    running_head = F.col("_short").rlike(r"^\d*$|TRUPE|^PARTEA") | F.lower("_short").contains("pag")
    r = carry_forward(r, "doc", "ord", F.when((F.col("part") == 2) & ~F.col("_entry") & ~running_head & (F.length("_short") < 40), F.col("_short")), "header").filter("_entry")
    told = F.regexp_replace(F.regexp_extract(line, entry, 1), r"[\s.,]+$", "")
    title = F.trim(F.regexp_replace(F.regexp_replace(told, named, ""), r"\.{2,}", ""))
    artist = F.when(told.rlike(named), F.trim(F.regexp_extract(told, named, 1))).otherwise(F.col("header"))
    found = r.select("doc", F.regexp_extract(line, entry, 2).cast("int").alias("page"), F.struct(comma_below(title).alias("title"), comma_below(artist).alias("artist"), "part").alias("e"), "ord")
    return found.groupBy("doc", "page").agg(F.max_by("e", "ord").alias("e")).select("doc", "page", "e.*")


def foreign_lines(items: DataFrame, own: str, meta: str = "meta", body: str = "body") -> DataFrame:
    """The lines of all items but those whose metadata name our own product, chords out of the way."""
    kept = items.filter(~F.coalesce(F.contains(F.col(meta), F.lit(own)), F.lit(False)))
    return kept.select(F.explode(F.transform(body, lambda x: F.regexp_replace(x, r"\[[^\]]*\]", " "))).alias("line"))


def plan_report(items: DataFrame, pairs: DataFrame, components: DataFrame, merges: DataFrame) -> DataFrame:
    """(what, key, n): groups by size, pairs by their two sources, merges expected, items by part. items(id, src, part), pairs(a, b),
    components(node, component), merges(dropped)."""
    sizes = components.groupBy("component").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n")).select(F.lit("groups of size").alias("what"), F.col("size").cast("string").alias("key"), "n")
    src = items.select("id", "src")
    named = pairs.join(src.select(F.col("id").alias("a"), F.col("src").alias("sa")), "a").join(src.select(F.col("id").alias("b"), F.col("src").alias("sb")), "b")
    by = named.groupBy(F.concat_ws(" - ", F.least("sa", "sb"), F.greatest("sa", "sb")).alias("key")).agg(F.count("*").alias("n")).select(F.lit("pairs of").alias("what"), "key", "n")
    gone = merges.agg(F.count("*").alias("n")).select(F.lit("merges").alias("what"), F.lit("").alias("key"), "n")
    parts = items.groupBy(F.col("part").cast("string").alias("key")).agg(F.count("*").alias("n")).select(F.lit("items of part").alias("what"), "key", "n")
    return sizes.unionAll(by).unionAll(gone).unionAll(parts)


#: Numerals of variants, a fixed value.
NUMERALS = ["I", "II", "III", "IV", "V", "VI"]


def merged_book(items: DataFrame, components: DataFrame, dropped: DataFrame, priority: Column, first: str, always: object = None, beyond: str = "error") -> DataFrame:
    """Items (id, src, title, part, artist, page) after the merge: those kept, under their group's base title with a numeral where
    several are left, with the places of what was merged into them (also), and their number by part and folded title. dropped(dropped, kept),
    components(node, component), priority: rank of a source, lowest first.

    T8: a group's part is `always` if a member has it, else that of its first member (by id) of source `first`, else the most frequent one, the earliest of equals. An
    item of source `first` takes the artist of the first member of another source that has one, over its own; others keep theirs. There are
    six numerals: a seventh variant is an error, or with beyond="untitled" an item without a title, behind those that have one."""
    grouped = items.join(components.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("_rank", priority)
    members = grouped.filter("component is not null")
    ahead = F.when(F.max(F.col("part").eqNullSafe(F.lit(always)) if always is not None else F.lit(False)), F.lit(always)).otherwise(F.min_by("part", F.when(F.col("src") == first, F.col("id"))))
    artist = F.min_by("artist", F.when((F.col("src") != first) & F.col("artist").isNotNull(), F.col("id")))
    told = members.groupBy("component").agg(ahead.alias("_ahead"), artist.alias("_artist"))
    agreed = told.join(majority(members, "component", "part", "id"), "component", "left").select("component", F.coalesce("_ahead", "chosen").alias("_part"), "_artist")
    left = grouped.join(dropped.select(F.col("dropped").alias("id")), "id", "left_anti")
    # A group of readings of one song; items without a group are groups of their own, not one group of most items.
    group = ["component", F.when(F.col("component").isNull(), F.col("id"))]
    w, whole = Window.partitionBy(*group).orderBy("_rank", "title", "id"), Window.partitionBy(*group)
    nth = F.when(F.col("component").isNotNull(), F.row_number().over(w))
    left = left.withColumn("_nth", nth).withColumn("_n", F.count("*").over(whole)).withColumn("_base", F.first("title").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    spent = F.lit(None).cast("string") if beyond == "untitled" else F.raise_error(F.lit("more variants than numerals")).cast("string")
    numeral = F.coalesce(F.get(F.array(*map(F.lit, NUMERALS)), F.col("_nth") - 1), spent)
    title = F.when(F.col("component").isNull(), F.col("title")).when(F.col("_n") == 1, base_title(F.col("title"))).otherwise(F.concat(base_title(F.col("_base")), F.lit(" ("), numeral, F.lit(")")))
    also = dropped.join(items.select(F.col("id").alias("dropped"), F.concat_ws(", p. ", "src", F.col("page").cast("string")).alias("at")), "dropped").groupBy(F.col("kept").alias("id")).agg(F.array_join(F.sort_array(F.collect_list("at")), " · ").alias("also"))
    out = left.withColumn("title", title).join(agreed, "component", "left").join(also, "id", "left")
    named = F.when(F.col("src") == first, F.coalesce("_artist", "artist")).otherwise(F.col("artist"))
    out = out.select("id", "src", "title", F.coalesce("_part", "part").alias("part"), named.alias("artist"), F.coalesce("also", F.lit("")).alias("also"))
    out = out.withColumn("_fold", sort_key(F.col("title"))).withColumn("_untitled", F.col("title").isNull())
    return number_globally(out, ["part", "_untitled", "_fold", "id"], "num").drop("_fold", "_untitled")
