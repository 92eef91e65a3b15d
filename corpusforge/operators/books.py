"""Books of glyphs read end to end: numbered titles (S4, S5), pages named by a table of contents (S6), structure told by fonts
(P3-P5, W2-W4, W13, W15 on the way). Lines are rows; every step is an expression or a window over a line, a page or an item.

A line row has doc, page, line, y, size (the largest of its visible glyphs), fonts (theirs), left (where its column begins), text,
alone (the text in columns of an indent's width, for symbol rows without a lyric), spots (array of columns and positions of visible
glyphs) and labels (array of symbols and their positions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.functions.text import all_tokens, comma_below, norm, place_tokens, truncate_at

from .geometry import glyph_lines
from .lines import lead_lines
from .linkage import close_matches

#: The grammar of symbols in scanned books and the tokens that may stand between them: fixed values.
SYMBOL = r"^\(?[A-G](?:#|b)?(?:m|maj|min|dim|aug|sus|add)?[0-9]{0,2}(?:sus[0-9]?|maj[0-9]|add[0-9]+|\+|-)?(?:/[A-G](?:#|b)?)?\)?[:.]?$"
BESIDE = r"^(?:x[234]|\(x[234]\)|\([23]x\)|\||\|\||\|:|:\||%|-|\*|\*\*|R:)$"

#: A numbered title: a fixed value.
NUMBERED = r"^\s*(\d+)\s*\.\s*(.+)$"

LINE = ["doc", "page", "line"]


def visible() -> Column:
    return F.trim("c") != ""


def is_symbol_line(text: Column) -> Column:
    return all_tokens(text, SYMBOL, BESIDE)


def restore_codes(glyphs: DataFrame, table: DataFrame) -> DataFrame:
    """F6, W5 on lined glyphs: a control code becomes the letter that the table (font, c, shown) gives it, in the case of the letters it
    adjoins (the table's own case after anything else); codes without an entry become empty."""
    coded = F.col("c") < " "
    known = glyphs.join(table.select("font", "c", "shown"), ["font", "c"], "left").withColumn("coded", coded)
    known = known.withColumn("c", F.when(coded, F.coalesce("shown", F.lit(""))).otherwise(F.col("c"))).drop("shown")
    order = Window.partitionBy(*LINE).orderBy("x0", "ymid", "seq").rowsBetween(Window.unboundedPreceding, 0)
    # a chain is a plain visible glyph and the codes after it, up to the next one; its first letter tells the case
    chained = known.withColumn("_chain", F.sum((visible() & ~F.col("coded")).cast("int")).over(order))
    chain = Window.partitionBy(*LINE, "_chain").orderBy("x0", "ymid", "seq").rowsBetween(Window.unboundedPreceding, 0)
    told = F.first(F.when(F.col("c").rlike(r"^\p{L}"), F.col("c")), ignorenulls=True).over(chain)
    cased = F.when(told.rlike(r"^\p{Lu}"), F.upper("c")).when(told.rlike(r"^\p{Ll}"), F.lower("c")).otherwise(F.col("c"))
    return chained.withColumn("c", F.when(F.col("coded"), cased).otherwise(F.col("c"))).drop("_chain")


def _labels(glyphs: Column, apart: float) -> Column:
    """Symbols of a row: a blank or a gap divides two, and so does a glyph that would spoil a symbol that is complete."""
    def step(acc: Column, g: Column) -> Column:
        last = F.get(acc["found"], F.size(acc["found"]) - 1)
        longer = F.concat(last["label"], g["c"])
        ends = (g["x0"] - acc["right"] > apart) | (last["label"].rlike(SYMBOL) & ~longer.rlike(SYMBOL))
        fresh = F.concat(acc["found"], F.array(F.struct(g["c"].alias("label"), g["x0"].alias("x"))))
        grown = F.concat(F.slice(acc["found"], F.lit(1), F.greatest(F.size(acc["found"]) - 1, F.lit(0))), F.array(F.struct(longer.alias("label"), last["x"].alias("x"))))
        found = F.when(F.trim(g["c"]) == "", acc["found"]).when(acc["open"] & ~F.coalesce(ends, F.lit(False)), grown).otherwise(fresh)
        return F.struct(found.alias("found"), (F.trim(g["c"]) != "").alias("open"), g["x1"].alias("right"))

    none = F.array().cast("array<struct<label:string,x:double>>")
    start = F.struct(none.alias("found"), F.lit(False).alias("open"), F.lit(None).cast("double").alias("right"))
    return F.aggregate(glyphs, start, step)["found"]


def render(glyphs: DataFrame, left: Column, char: float = 6.0, space: float = 3.34, least: float = 1.2, most: int = 60, apart: float = 2.0) -> DataFrame:
    """Lined glyphs as line rows. Gaps above `least` become 1 to `most` blanks of the width `space`, the indent from `left`
    blanks of the width `char`; labels lie more than `apart` from each other."""
    order, whole = Window.partitionBy(*LINE).orderBy("x0", "ymid", "seq"), Window.partitionBy(*LINE)
    coded = F.col("coded") if "coded" in glyphs.columns else F.lit(False)
    shown = F.when((F.col("c") == "") | visible(), True).otherwise(False)
    g = glyphs.withColumn("left", left).select(
        *LINE, "seq", "c", "x0", "x1", "ymid", "left", coded.alias("coded"), F.avg("ymid").over(whole).alias("y"), F.max(F.when(shown, F.col("size"))).over(whole).alias("size"),
        F.array_sort(F.collect_set(F.when(shown, F.col("font"))).over(whole)).alias("fonts"), F.min("x0").over(whole).alias("first"),
    ).filter("c <> ''")
    gap, blank = F.col("x0") - F.lag("x1").over(order), F.trim("c") == ""
    before = F.lag(blank).over(order)
    wide = lambda width: F.when(gap > least, F.least(F.lit(most), F.greatest(F.lit(1), F.bround(gap / width).cast("int")))).otherwise(0)
    indent = F.greatest(F.lit(0), F.bround((F.col("first") - F.col("left")) / char).cast("int"))
    g = g.withColumn("indent", indent).withColumn("_n", F.row_number().over(order)).withColumn("_b", wide(space)).withColumn("_w", wide(char)).withColumn("_blank", blank).withColumn("_after", before)
    # a blank of the book counts only where none stands yet, and not in front of everything
    own = lambda n: F.when(~F.col("_blank"), F.col("c")).when((F.col(n) == 0) & ~F.coalesce("_after", F.lit(True)), " ").otherwise("")
    g = g.withColumn("_p", F.concat(F.repeat(F.lit(" "), F.col("_b")), own("_b"))).withColumn("_q", F.concat(F.repeat(F.lit(" "), F.col("_w")), own("_w")))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("_col", F.col("indent") + F.sum(F.length("_p")).over(upto) - F.length("c"))
    rows = g.groupBy(*LINE, "y", "size", "fonts", "left", "indent").agg(F.sort_array(F.collect_list(F.struct("_n", "_p", "_q", "_col", "_blank", "coded", "c", "x0", "x1"))).alias("g"))
    joined = lambda n: F.rtrim(F.concat(F.repeat(F.lit(" "), F.col("indent")), F.array_join(F.transform("g", lambda x: x[n]), "")))
    spots = F.transform(F.filter("g", lambda x: ~x["_blank"]), lambda x: F.struct(x["_col"].cast("int").alias("col"), x["x0"].alias("x")))
    return rows.select(*LINE, "y", "size", "fonts", "left", joined("_p").alias("text"), joined("_q").alias("alone"), spots.alias("spots"), _labels(F.filter("g", lambda x: ~x["coded"]), apart).alias("labels")).filter("trim(text) <> ''")


def above(labels: Column, text: Column, spots: Column, left: Column, space: float = 3.34) -> Column:
    """The labels in the columns of the glyphs that begin at or right of them (1.5 to their left counts as at), the others past the end."""
    end = F.coalesce(F.array_max(F.transform(spots, lambda s: s["x"])), left)
    def column(label: Column) -> Column:
        at = F.get(F.filter(spots, lambda s: s["x"] >= label["x"] - 1.5), F.lit(0))["col"]
        past = F.when(label["x"] > end, F.greatest(F.lit(1), F.bround((label["x"] - end) / space).cast("int"))).otherwise(1)
        return F.coalesce(at, F.length(text) + past)

    return place_tokens(F.transform(labels, column), F.transform(labels, lambda x: x["label"]))


def pair_rows(rows: DataFrame, stream: list[str], under: list[str], near: float, space: float = 3.34) -> DataFrame:
    """Adds shown: a chord row is set over the row below it, if that is of a kind in `under` and less than `near` below; else it
    stands in columns of its own. Other rows show their text."""
    w = Window.partitionBy(*stream).orderBy("y", "line")
    n = rows.withColumn("_n", F.lead(F.struct("kind", "y", "text", "spots")).over(w))
    over = F.col("_n.kind").isin(under) & (F.col("_n.y") - F.col("y") < near)
    shown = F.when(F.col("kind") != "chord", F.col("text")).when(over, above(F.col("labels"), F.col("_n.text"), F.col("_n.spots"), F.col("left"), space)).otherwise(F.col("alone"))
    return n.withColumn("shown", shown).drop("_n")


def join_titles(rows: DataFrame, near: float = 20.0) -> DataFrame:
    """Of neighbouring title rows of a page, those less than `near` below the first of them become one with it."""
    page = Window.partitionBy("doc", "page").orderBy("y", "line")
    t = rows.withColumn("_run", F.sum((F.coalesce(F.lag("kind").over(page), F.lit("")) != F.col("kind")).cast("int")).over(page.rowsBetween(Window.unboundedPreceding, 0)))
    run = t.filter("kind = 'title'").groupBy("doc", "page", "_run").agg(F.sort_array(F.collect_list(F.struct("y", "line", "text"))).alias("r"))
    def step(acc: Column, x: Column) -> Column:
        head = F.get(acc, F.size(acc) - 1)
        both = F.struct(head["y"].alias("y"), head["line"].alias("line"), F.concat(F.rtrim(head["text"]), F.lit(" "), F.trim(x["text"])).alias("text"))
        return F.when((F.size(acc) > 0) & (x["y"] - head["y"] < near), F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(both))).otherwise(F.concat(acc, F.array(x)))

    heads = F.aggregate("r", F.array().cast(run.schema["r"].dataType), step)
    merged = run.select("doc", "page", F.explode(heads).alias("h")).select("doc", "page", F.col("h.line").alias("line"), F.col("h.text").alias("_text"))
    out = t.join(merged, LINE, "left").filter("kind <> 'title' OR _text IS NOT NULL")
    return out.withColumn("text", F.coalesce("_text", "text")).drop("_text", "_run")


def _with_gaps(rows: DataFrame, stream: list[str], item: list[str], order: list[str], apart: float) -> DataFrame:
    """(item, lines): the shown lines in order, an empty one before a line more than `apart` below the row before it in its stream,
    but not in front of the first. Rows that aren't `body` only count as rows before."""
    before = F.lag("y").over(Window.partitionBy(*stream).orderBy("y", "line"))
    nth = F.row_number().over(Window.partitionBy(*item, "body").orderBy(*order))
    g = rows.withColumn("_wide", F.coalesce(F.col("y") - before > apart, F.lit(False))).withColumn("_nth", nth).filter("body")
    g = g.withColumn("_l", F.when(F.col("_wide") & (F.col("_nth") > 1), F.array(F.lit(""), F.col("shown"))).otherwise(F.array("shown")))
    return g.groupBy(*item).agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("_nth", "_l"))), lambda x: x["_l"])).alias("lines"))


def page_margin(first: Column, least: float = 9.5, default: float = 36.0) -> Column:
    """A2: the left edge of a page: of its lines that begin with a glyph of at least the size `least`; first: (x0, size) of a line's first glyph."""
    return F.coalesce(F.min(F.when(first["size"] >= least, first["x0"])).over(Window.partitionBy("doc", "page")), F.lit(default))


def numbered_book(glyphs: DataFrame, bold: list[str], codes: DataFrame, small: bool = False, titles: DataFrame | None = None, near: float = 17.0, apart: float = 24.0) -> DataFrame:
    """S4, and with small S5: (doc, num, title, artist, page, lines) of a book whose items begin at numbered titles, set in 13.5 points or
    more of a font in `bold`, and may go on over pages. codes: restore_codes' table. small (S5): symbols are told before size, and a
    row of at most 9.5 points just after a title is its artist. titles (doc, page, num, title): items that begin with a page whatever
    stands on it. Rows before the first title belong to no item. An empty table gives no item."""
    lined = restore_codes(glyph_lines(glyphs), codes)
    first = F.first(F.struct("x0", "size")).over(Window.partitionBy(*LINE).orderBy("x0", "ymid", "seq"))
    rows = render(lined.withColumn("_first", first), page_margin(F.col("_first")))
    stripped, chord = F.trim("text"), is_symbol_line(F.col("text"))
    kind = F.when((F.col("size") >= 13.5) & F.arrays_overlap("fonts", F.array(*map(F.lit, bold))), "title").when(stripped.rlike(r"^\d+$") & (F.col("size") <= 10.5), "number").when(chord, "chord")
    kind = (kind.when(F.coalesce("size", F.lit(0.0)) <= 9.5, "small") if small else kind).otherwise("lyric")
    rows = pair_rows(join_titles(rows.withColumn("kind", kind)), ["doc", "page"], ["lyric", "small"], near).filter("kind <> 'number'")
    begins = (F.col("kind") == "title") & F.trim("text").rlike(NUMBERED)
    rows = rows.withColumn("num", F.when(begins, F.regexp_extract(F.trim("text"), NUMBERED, 1).cast("int"))).withColumn("title", F.when(begins, F.trim(F.regexp_extract(F.trim("text"), NUMBERED, 2))))
    rows = rows.select("doc", "page", "line", "y", "kind", "shown", "num", "title")
    if titles is not None:
        named = titles.select("doc", "page", F.lit(0).cast("bigint").alias("line"), F.lit(None).cast("double").alias("y"), F.lit("page").alias("kind"), F.lit("").alias("shown"), F.col("num").cast("int"), "title")
        rows = rows.unionByName(named)
    book = Window.partitionBy("doc").orderBy("page", F.col("y").asc_nulls_first(), "line")
    rows = rows.withColumn("item", F.count("num").over(book.rowsBetween(Window.unboundedPreceding, 0))).filter("item > 0")
    item = ["doc", "item"]
    place = Window.partitionBy(*item).orderBy("page", F.col("y").asc_nulls_first(), "line")
    rows = rows.withColumn("byline", F.lit(small) & (F.col("kind") == "small") & (F.row_number().over(place) == 2)).withColumn("body", F.col("num").isNull() & ~F.col("byline"))
    heads = rows.groupBy(*item).agg(F.max("num").alias("num"), F.max("title").alias("title"), F.max(F.when(F.col("byline"), F.trim("shown"))).alias("artist"), F.min("page").alias("page"))
    lines = _with_gaps(rows, ["doc", "page"], item, ["page", "y", "line"], apart)
    return heads.join(lines, item, "left").select("doc", "num", "title", "artist", "page", F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))


def column_split(glyphs: DataFrame, gap: float = 50.0, span: tuple[float, float] = (280.0, 360.0), right: float = 320.0, share: float = 0.12, default: float = 330.0) -> DataFrame:
    """(doc, page, split) of lined glyphs: the median middle of wide gaps over the span, or the default where enough lines begin on
    the right; null for a page of one column, of which more than `share` of the lines run across the split."""
    order, page = Window.partitionBy(*LINE).orderBy("x0", "ymid", "seq"), ["doc", "page"]
    starts = glyphs.withColumn("_n", F.row_number().over(order)).groupBy(*page).agg(F.count_if((F.col("_n") == 1) & (F.col("x0") > right)).alias("starts"))
    ink = glyphs.filter(visible()).withColumn("_n", F.count("*").over(Window.partitionBy(*LINE))).filter("_n >= 4").withColumn("_next", F.lead("x0").over(order))
    wide = ink.filter((F.col("_next") - F.col("x1") > gap) & (F.col("x1") < span[1]) & (F.col("_next") > span[0]))
    middle = wide.groupBy(*page).agg(F.count("*").alias("gaps"), F.median((F.col("x1") + F.col("_next")) / 2).alias("middle"))
    split = starts.join(middle, page, "left").withColumn("split", F.when((F.coalesce("gaps", F.lit(0)) >= 3) | (F.col("starts") >= 6), F.coalesce("middle", F.lit(default)))).select(*page, "split")
    sides = ink.join(split, page).groupBy(*LINE).agg(F.max(F.when(F.col("x0") < F.col("split"), F.col("x1"))).alias("l"), F.min(F.when(F.col("x0") >= F.col("split"), F.col("x0"))).alias("r"))
    crossing = sides.groupBy(*page).agg(F.count_if(F.col("r") - F.col("l") < 25).alias("crossing"), F.count("*").alias("n"))
    return split.join(crossing, page, "left").select(*page, F.when(F.coalesce(F.col("crossing") / F.col("n") <= share, F.lit(True)), F.col("split")).alias("split"))


def indexed_book(glyphs: DataFrame, contents: DataFrame, char: float = 7.2, space: float = 3.6, near: float = 18.0, apart: float = 22.0) -> DataFrame:
    """S6 (J3, P5): (doc, part, page, title, page_title, artist, lines) for the entries of a table of contents (page, title, artist, part) whose page has
    glyphs. Glyphs of 16 points or more are the page's title; the rest is read column by column. The page's title settles title and artist
    by the entry of its key, or the closest from 0.75 on; without one it is the title itself and the entry's artist stays."""
    lined = glyph_lines(glyphs).join(contents.select("page"), "page", "left_semi")
    large = F.max(F.when(visible(), F.col("size"))).over(Window.partitionBy(*LINE)) >= 16
    lined = lined.withColumn("_large", F.coalesce(large, F.lit(False)))
    top = render(lined.filter("_large"), F.lit(0.0), char, space).filter("y < 150").groupBy("doc", "page").agg(F.sort_array(F.collect_list(F.struct("y", "line", F.trim("text").alias("t")))).alias("t"))
    top = top.select("doc", "page", comma_below(F.array_join(F.transform("t", lambda x: x["t"]), " ")).alias("page_title"))
    body = lined.filter("NOT _large")
    body = body.join(column_split(body), ["doc", "page"], "left").withColumn("column", F.when(F.col("x0") >= F.col("split"), 1).otherwise(0))
    # the halves of a line share its y, so they are told apart as lines of their own
    whole = F.avg("ymid").over(Window.partitionBy(*LINE))
    body = body.withColumn("ymid", whole).withColumn("line", F.col("line") * 2 + F.col("column"))
    rows = render(body, F.min("x0").over(Window.partitionBy("doc", "page", "column")), char, space).filter(~F.trim("text").rlike(r"^\d+$")).withColumn("column", F.col("line") % 2)
    rows = rows.withColumn("kind", F.when(is_symbol_line(F.col("text")), "chord").otherwise("lyric")).withColumn("body", F.lit(True))
    rows = pair_rows(rows, ["doc", "page", "column"], ["lyric"], near, space)
    opening = F.row_number().over(Window.partitionBy("doc", "page", "column").orderBy("y", "line")) == 1
    rows = rows.withColumn("shown", comma_below(F.col("shown"))).withColumn("_turn", opening & (F.col("column") == 1))
    # the second column follows an empty line: its first row takes part in the first column's stream, far below
    lines = _with_gaps(rows.withColumn("y", F.col("y") + F.col("column") * 1e6), ["doc", "page"], ["doc", "page"], ["column", "y", "line"], apart)
    key = lambda c: norm(F.col(c))
    entry = contents.withColumn("key", key("title")).groupBy("key").agg(F.min_by(F.struct("title", "artist"), "page").alias("e"))
    keyed = top.withColumn("key", key("page_title"))
    hit = close_matches(keyed.select("key").distinct(), entry.select("key"), "key", 0.75).join(entry.withColumnRenamed("key", "match"), "match").select("key", "e")
    settled = keyed.join(hit, "key", "left").select("doc", "page", "page_title", "e")
    out = lined.select("doc", "page").distinct().join(contents, "page").join(settled, ["doc", "page"], "left").join(lines, ["doc", "page"], "left")
    capital = F.concat(F.upper(F.substring("page_title", 1, 1)), F.lower(F.expr("substring(page_title, 2)")))
    title = F.when(F.col("page_title").isNull(), F.col("title")).otherwise(F.coalesce("e.title", capital))
    artist = F.when(F.col("e").isNull(), F.col("artist")).otherwise(F.col("e.artist"))
    return out.select("doc", "part", "page", title.alias("title"), "page_title", artist.alias("artist"), F.coalesce("lines", F.array().cast("array<string>")).alias("lines"))


def font_book(glyphs: DataFrame, running: str, title: str, section: str, decode: Column, footer: str, dictionary: str, skip: list[str], gap: float = 1.3) -> DataFrame:
    """S7 (F7, F9, P14, P15, P17): (doc, page, section, title, artist, composer, credits, body) of a book in which the font of a line's first glyph tells
    its role: running head (dropped), title, section or text. decode: a glyph's character, of column c. Up to four leading lines without a symbol are
    metadata: (composer) in brackets, - credits, else the artist, who is the section's where none is named. A footer goes; the item ends at its dictionary."""
    order = Window.partitionBy(*LINE).orderBy("x0", "ymid", "seq")
    far = F.coalesce(F.col("x0") - F.lag("x1").over(order) > gap, F.lit(False))
    g = glyph_lines(glyphs).withColumn("_s", F.concat(F.when(far, " ").otherwise(""), decode)).withColumn("_n", F.row_number().over(order))
    rows = g.groupBy(*LINE).agg(F.avg("ymid").alias("y"), F.min_by("font", "_n").alias("font"), F.rtrim(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_s"))), lambda x: x["_s"]), "")).alias("text"))
    rows = rows.filter((F.trim("text") != "") & (F.col("font") != running))
    book = Window.partitionBy("doc").orderBy("page", "y", "line").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("section", F.last(F.when(F.col("font") == section, F.trim("text")), ignorenulls=True).over(book))
    rows = rows.withColumn("item", F.count(F.when(F.col("font") == title, 1)).over(book)).filter((F.col("item") > 0) & (F.col("font") != section))
    head, at = F.col("font") == title, F.struct("page", "y", "line")
    texts = F.transform(F.sort_array(F.collect_list(F.when(~head, F.struct("page", "y", "line", "text")))), lambda x: x["text"])
    items = rows.groupBy("doc", "item").agg(F.min_by(F.struct("page", "section", F.trim("text").alias("title")), at).alias("h"), texts.alias("all"))
    lead = lead_lines(F.col("all"), 4, r"^\s*$|\[")
    items = items.select("doc", "h.*", F.transform(lead, F.trim).alias("meta"), F.slice("all", F.size(lead) + 1, F.size("all") + 1).alias("rest"))
    named = lambda test: F.get(F.filter("meta", test), F.lit(0))
    body = truncate_at(F.filter("rest", lambda x: ~x.rlike(footer)), dictionary)
    items = items.filter(F.col("section").isNull() | ~F.col("section").isin(skip)) if skip else items
    return items.select(
        "doc", "page", "section", "title", F.coalesce(named(lambda m: ~m.rlike(r"^[(-]")), "section").alias("artist"), named(lambda m: m.rlike(r"^\(")).alias("composer"),
        F.filter("meta", lambda m: m.rlike("^-")).alias("credits"), body.alias("body"),
    )
