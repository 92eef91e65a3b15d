"""Curated corrections of a book, its layout anew, and what a pass over it did."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusforge.functions.text import slug, sort_key
from corpusforge.session import small

from .components import cut_lineage
from .indexing import number_globally, suffixed
from .rules import require_empty

#: A variant's numeral at the end of a title, and the bold lead of a metadata line, fixed patterns.
NUMERAL = r" \((?:I{1,3}|IV|V)\)$"
LEAD = r"^(\*\*.+?\*\* · )"


def variant_note(meta: Column, base: Column, own: Column, of: str = "variant of „%s”", named: str = ", titled „%s”") -> Column:
    """The metadata of a second variant: a note of whose it is, with its own title if that is another, behind the bold lead if there is one."""
    plain = F.regexp_replace(own, NUMERAL, "")
    note = F.concat(F.format_string(of, base), F.when(plain != base, F.format_string(named, plain)).otherwise(""), F.lit(" · "))
    lead = F.regexp_extract(meta, LEAD, 1)
    return F.concat(lead, note, F.substring(meta, F.length(lead) + 1, F.length(meta)))


def corrected(items: DataFrame, merges: DataFrame, variants: DataFrame, titles: DataFrame, notes: DataFrame) -> DataFrame:
    """Items (num, title, meta) after four tables of rules; num is replaced by place, 1, 2, 3 in the old order with every second variant right behind its first.

    merges(kept, dropped, meta): dropped goes, kept gets the metadata. notes(num, note): the note goes in front of the item's own metadata, and counts more than a merge's.
    titles(num, title): a new title. variants(first, second, meta): both get the title that first has in the items, as (I) and (II), whatever titles says; second gets meta
    or, where that is null, its own metadata with a note of whose variant it is. A rule for a number that no item has is an error, and so is a second rule of
    one table for an item. Rows keep further columns; null metadata count as empty."""
    named = [merges.select(F.col("kept").alias("num"), F.lit("merges").alias("by")), merges.select("dropped", F.lit("merges")), variants.select("first", F.lit("variants")), variants.select("second", F.lit("variants")), titles.select("num", F.lit("titles")), notes.select("num", F.lit("notes"))]
    asked = named[0]
    for n in named[1:]:
        asked = asked.unionAll(n)
    require_empty(asked.join(items.select("num"), "num", "left_anti"), "rules for items that aren't there")
    require_empty(asked.groupBy("num", "by").count().filter("count > 1"), "several rules of a table for an item")

    columns, rest = items.columns, [c for c in items.columns if c not in ("num", "title", "meta")]
    items = items.select("num", "title", "meta", F.struct(*(F.col(f"`{c}`") for c in rest), F.lit(0).alias("_")).alias("_rest"))  # whatever their names
    second = variants.select(F.col("second").alias("num"), F.col("first").alias("_first"), F.col("meta").alias("_vmeta"))
    base = items.select(F.col("num").alias("_first"), F.col("title").alias("_base"))
    out = items.join(small(merges.select(F.col("dropped").alias("num"))), "num", "left_anti")
    out = out.join(small(merges.select(F.col("kept").alias("num"), F.col("meta").alias("_merged"))), "num", "left").join(small(notes.select("num", F.col("note").alias("_note"))), "num", "left")
    out = out.join(small(titles.select("num", F.col("title").alias("_title"))), "num", "left").join(small(variants.select(F.col("first").alias("num"), F.lit(True).alias("_leads"))), "num", "left")
    out = out.join(small(second.join(base, "_first")), "num", "left").withColumn("meta", F.coalesce("meta", F.lit("")))
    title = F.when(F.col("_base").isNotNull(), F.concat("_base", F.lit(" (II)"))).when(F.col("_leads"), F.concat("title", F.lit(" (I)"))).otherwise(F.coalesce("_title", "title"))
    plain = F.when(F.col("_note").isNotNull(), F.concat("_note", F.lit(" · "), "meta")).otherwise(F.coalesce("_merged", "meta"))
    meta = F.when(F.col("_base").isNotNull(), F.coalesce("_vmeta", variant_note(F.col("meta"), F.col("_base"), F.col("title")))).otherwise(plain)
    placed = out.select("num", title.alias("title"), meta.alias("meta"), "_rest", F.coalesce("_first", "num").alias("_at"), F.col("_first").isNotNull().alias("_after"))
    own = lambda c: F.col(f"_rest.`{c}`" if c in rest else c).alias(c)
    return number_globally(placed, ["_at", "_after"], "_place").select(*map(own, columns), F.col("_place").alias("place"))


def replace_sections(lines: DataFrame, order: str, sections: DataFrame, fresh: DataFrame) -> DataFrame:
    """K4: the lines of a book (order, line), renumbered from 1, in which named sections have other lines and everything else stays.

    sections(header, until): a section is what stands between the line that equals header and the next one after it that equals until; both stay.
    fresh(header, nth, line): its new lines. A header that no line or several lines have, or without an end, is an error. The book's lines are
    compared with the few borders only; no task sees the whole book."""
    heads = lines.join(small(sections), lines["line"] == sections["header"]).select(F.col(order).alias("_from"), "header", "until")
    ends = lines.select(F.col(order).alias("_to"), F.col("line").alias("until")).join(small(heads), "until").filter("_to > _from")
    found = cut_lineage(ends.groupBy("header", "_from").agg(F.min("_to").alias("_to")))
    require_empty(sections.join(found.groupBy("header").count().filter("count = 1"), "header", "left_anti"), "sections that aren't there exactly once")
    kept = lines.join(F.broadcast(found), (lines[order] > F.col("_from")) & (lines[order] < F.col("_to")), "left_anti")  # as many rows as sections
    new = fresh.join(small(found), "header").select(F.col("_from").alias("_at"), F.col("nth").cast("long").alias("_nth"), "line")
    rows = kept.select(F.col(order).alias("_at"), F.lit(-1).cast("long").alias("_nth"), "line").unionAll(new)
    return number_globally(rows, ["_at", "_nth"], "place").select("place", "line")


#: Blocks of a book in their order.
CONTENTS, LISTS, PARTS, INDEX = 1, 2, 3, 4


def placed_in_sections(items: DataFrame, sections: DataFrame, key: str) -> DataFrame:
    """Items with their part and section. Items without a section are an error that names them."""
    lost = items.join(sections.select(key), key, "left_anti")
    require_empty(lost.select(key), "items without a section")
    return items.join(sections, key)


def relaid(items: DataFrame, layout: DataFrame, item: str = "item", items_word: str = "items") -> DataFrame:
    """A book's lines (place, line) from items (part, section, title, artist, body: array of lines, and item, which breaks ties) and their layout (part, section, part_at,
    section_at: places of parts and of sections within them).

    Contents with the totals of parts and sections, an alphabetical list of every section, the parts with their items in the order of sort_key, and the index of
    artists, whose items stand in the book's order. Links are titles as slugs, later ones of equal slugs with a number. Empty parts and sections are listed with 0.
    Lines carry their block, part, section, item and line number, so that one sort makes the book: nothing is collected. Items of a section that the layout
    lacks are an error."""
    require_empty(items.join(layout, ["part", "section"], "left_anti").select("part", "section"), "sections that the layout lacks")
    book = items.join(small(layout), ["part", "section"]).withColumn("sort", sort_key(F.col("title")))
    book = number_globally(book, ["part_at", "section_at", "sort", item], "nth").withColumn("slug", slug(F.col("title")))
    book = cut_lineage(suffixed(book, "slug", "nth", "link"))
    counts = layout.join(small(book.groupBy("part", "section").agg(F.count("*").alias("n"))), ["part", "section"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    parts = counts.groupBy("part", "part_at").agg(F.sum("n").alias("n"))
    zero = F.lit(0).cast("long")

    def rows(df: DataFrame, block: int, part: Column, section: Column, nth: Column, lines: Column, name: Column | None = None) -> DataFrame:
        kept = df.select(F.lit(block).alias("b"), part.cast("long").alias("p"), section.cast("long").alias("s"), (name if name is not None else F.lit("")).alias("name"), nth.cast("long").alias("n"), F.posexplode(lines).alias("l", "line"))
        return kept

    part_at, section_at, nth = F.col("part_at"), F.col("section_at"), F.col("nth")
    count = F.concat(F.lit(" ("), F.col("n").cast("string"), F.lit(f" {items_word})"))
    link = F.concat(F.lit("- ["), "title", F.lit("](#"), "link", F.lit(")"))
    before = F.lit(-1)
    blocks = [
        rows(layout.limit(1), CONTENTS, before, before, zero, F.array(F.lit("## Contents"))),
        rows(parts, CONTENTS, part_at, before, zero, F.array(F.concat(F.lit("**"), "part", F.lit("**"), count))),
        rows(counts, CONTENTS, part_at, section_at, zero, F.array(F.concat(F.lit("- "), "section", count))),
        rows(counts, LISTS, part_at, section_at, zero, F.array(F.concat(F.lit("### "), "part", F.lit(" — "), "section"))),
        rows(book, LISTS, part_at, section_at, nth, F.array(link)),
        rows(parts, PARTS, part_at, before, zero, F.array(F.concat(F.lit("## "), "part"))),
        rows(counts, PARTS, part_at, section_at, zero, F.array(F.concat(F.lit("### "), "section"))),
        rows(book, PARTS, part_at, section_at, nth, F.concat(F.array(F.concat(F.lit("#### "), "title")), "body")),
        rows(layout.limit(1), INDEX, before, before, zero, F.array(F.lit("## Index"))),
    ]
    named = book.filter("artist is not null").withColumn("_sort", sort_key(F.col("artist")))
    heads = named.select("artist", "_sort").distinct()
    blocks.append(rows(heads, INDEX, zero, zero, zero, F.array(F.concat(F.lit("**"), "artist", F.lit("**"))), F.concat("_sort", F.lit("\x00"), "artist")))
    blocks.append(rows(named, INDEX, zero, zero, nth, F.array(link), F.concat("_sort", F.lit("\x00"), "artist")))
    all_ = blocks[0]
    for b in blocks[1:]:
        all_ = all_.unionByName(b)
    return number_globally(all_, ["b", "p", "s", "name", "n", "l"], "place").select("place", "line")


def observed(df: DataFrame, *figures: Column) -> tuple[DataFrame, Observation]:
    """Df and an observation of figures over its rows, known once the job that writes df has run; nothing is read twice."""
    seen = Observation()
    return df.observe(seen, *figures), seen
