"""Reading order from positions: glyphs to lines, columns and bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.session import small

from .folds import apart
from .lines import gap_to_previous, islands

#: Columns of a glyph table.
GLYPH = "doc string, page int, seq int, c string, x0 double, x1 double, ymid double, size double, font string"


def drop_fonts(glyphs: DataFrame, fonts: list[str]) -> DataFrame:
    """P1."""
    return glyphs.filter(~F.col("font").isin(fonts))


def band(glyphs: DataFrame, top: float, bottom: float) -> DataFrame:
    """Strictly between header and footer."""
    return glyphs.filter((F.col("ymid") > top) & (F.col("ymid") < bottom))


def decode_fonts(glyphs: DataFrame, table: DataFrame) -> DataFrame:
    """characters by (font, code) from a table (font, c, shown); others stay."""
    return glyphs.join(small(table), ["font", "c"], "left").withColumn("c", F.coalesce("shown", "c")).drop("shown")


def glyph_lines(glyphs: DataFrame, gap: float = 3.0) -> DataFrame:
    """Adds line, numbered down the page: a glyph more than `gap` below the glyph before it begins one."""
    page = ["doc", "page"]
    return islands(glyphs, page, ["ymid", "x0", "seq"], gap_to_previous("ymid", page, ["ymid", "x0", "seq"]) > gap, "line")


def line_text(lines: DataFrame, space: Column, least: float = 1.2, most: int = 60) -> DataFrame:
    """One row a line with its mean y, left margin, largest size and text; a gap above `least` becomes 1 to `most`
    blanks of the width `space`."""
    order = ["x0", "seq"]
    w = Window.partitionBy("doc", "page", "line").orderBy(*order)
    gap = F.col("x0") - F.lag("x1").over(w)
    blanks = F.when(gap > least, F.least(F.lit(most), F.greatest(F.lit(1), F.bround(gap / space).cast("int")))).otherwise(0)
    rows = lines.withColumn("_s", F.concat(F.repeat(F.lit(" "), F.coalesce(blanks, F.lit(0))), "c")).withColumn("_n", F.row_number().over(w))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_n", "_s"))), lambda x: x["_s"]), "")
    return rows.groupBy("doc", "page", "line").agg(F.avg("ymid").alias("y"), F.min("x0").alias("left"), F.max("x1").alias("right"), F.max("size").alias("size"), text.alias("text"))


def segments(lines: DataFrame, gap: float = 12.0) -> DataFrame:
    """Adds segment, cut in a line where a glyph begins at least `gap` right of the end of the one before."""
    by = ["doc", "page", "line"]
    new = F.col("x0") - F.lag("x1").over(Window.partitionBy(*by).orderBy("x0", "seq")) >= gap
    return islands(lines, by, ["x0", "seq"], new, "segment")


def two_columns(lines: DataFrame, share: float = 0.12) -> DataFrame:
    """Per page the median gap between segments' sides and whether few enough lines cross the middle of it."""
    gaps = lines.withColumn("gap", F.lead("x0").over(Window.partitionBy("doc", "page", "line").orderBy("x0")) - F.col("x1")).withColumn("mid", F.col("x1") + F.col("gap") / 2).filter("gap > 12")
    middle = gaps.groupBy("doc", "page").agg(F.median("mid").alias("middle"))
    crossing = lines.join(middle, ["doc", "page"]).groupBy("doc", "page", "middle").agg(F.count_if((F.col("x0") < F.col("middle")) & (F.col("x1") > F.col("middle"))).alias("crossing"), F.count("*").alias("n"))
    return crossing.withColumn("two", F.col("crossing") <= share * F.col("n"))


def column_edges(starts: DataFrame, by: list[str], x: str, order: list[str], low: float = 150.0, high: float = 450.0, least: int = 5, distance: float = 60.0, reach: float = 20.0) -> DataFrame:
    """A5: (by, edges): where columns after the first begin, rising, from the starts of runs.

    Starts from low to high are counted in bins of two points. From the fullest bin down (equals: the one seen first by order), a bin counts with both neighbours; the
    first with fewer than `least` starts ends the search; its leftmost start is an edge unless one taken before is within `distance`. An edge then moves to the
    leftmost start at most `reach` before it. Groups without an edge have no row. Bins are few, whatever the number of starts."""
    inside = starts.filter(F.col(x).between(low, high)).select(*by, F.col(x).cast("double").alias("_x"), F.struct(*order).alias("_at"))
    bins = inside.groupBy(*by, F.bround(F.col("_x") / 2).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.min("_x").alias("low"), F.min("_at").alias("seen"))
    w = Window.partitionBy(*by).orderBy("bin")
    near = lambda f, c, d: F.when(f("bin").over(w) == F.col("bin") + d, f(c).over(w))
    zero = F.lit(0)
    wide = bins.withColumn("wide", F.col("n") + F.coalesce(near(F.lag, "n", -1), zero) + F.coalesce(near(F.lead, "n", 1), zero)).withColumn("left", F.least("low", near(F.lag, "low", -1), near(F.lead, "low", 1)))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("rank"), "seen", F.col("wide").alias("n"), F.col("left").alias("low"))))
    edges = wide.groupBy(*by).agg(apart(ranked, least, distance).alias("edges")).select(*by, F.explode("edges").alias("_edge"))
    moved = inside.join(edges, by).filter(F.col("_x").between(F.col("_edge") - reach, F.col("_edge"))).groupBy(*by, "_edge").agg(F.min("_x").alias("x"))
    return moved.groupBy(*by).agg(F.array_sort(F.collect_list("x")).alias("edges"))


def reading_order(segments: DataFrame, edges: DataFrame, by: list[str], symbols: Column | None = None, gap: float = 12.0, lift: float = 15.0) -> DataFrame:
    """Segments (by, x0, x1, y) numbered from 0 as they are read (ord), with their column (null outside of columns).

    A line (segments of one y) with a segment that runs across a column's edge closes the band above it and is read by itself, together with symbols less than
    `lift` above it; the lines of a band are read column by column. A page without edges is read line by line."""
    page = Window.partitionBy(*by)
    s = segments.join(edges, by, "left").withColumn("edges", F.coalesce("edges", F.array().cast("array<double>")))
    runs = F.exists("edges", lambda e: (F.col("x0") < e - gap) & (F.col("x1") > e + 2))
    s = s.withColumn("_cross", F.max(runs).over(Window.partitionBy(*by, "y"))).withColumn("_symbols", F.coalesce(symbols, F.lit(False)) if symbols is not None else F.lit(False))
    after = F.min(F.when(F.col("_cross"), F.col("y"))).over(page.orderBy(F.desc("y")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    held = F.col("_symbols") & ~F.col("_cross") & (after - F.col("y") < lift)
    s = s.withColumn("_held", F.coalesce(held, F.lit(False))).withColumn("_line", F.when(F.col("_held"), after).otherwise(F.col("y")))
    s = s.withColumn("_alone", F.col("_cross") | F.col("_held"))
    opens = F.max(F.when(F.col("_alone"), F.col("_line"))).over(page.orderBy("_line").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    column = F.when((F.size("edges") > 0) & ~F.col("_alone"), F.size(F.filter("edges", lambda e: F.col("x0") >= e - 4)))
    s = s.withColumn("_band", opens).withColumn("column", column)
    order = page.orderBy(F.col("_band").asc_nulls_first(), F.desc("_alone"), F.coalesce("column", F.lit(0)), "y", "x0")
    return s.withColumn("ord", F.row_number().over(order) - 1).select(*segments.columns, "column", "ord")


def contained_notes(notes: DataFrame, lines: DataFrame, within: float = 15.0) -> DataFrame:
    """A note with the full-width line less than `within` below it."""
    n = notes.select("doc", "page", F.col("y").alias("note_y"), F.col("text").alias("note"))
    return n.join(lines.select("doc", "page", "y", "text"), ["doc", "page"]).filter((F.col("y") > F.col("note_y")) & (F.col("y") - F.col("note_y") < within))
