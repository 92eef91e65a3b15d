"""Small hand-written tables whose expected rows are worked out by hand from the rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusforge.functions import pitch
from corpusforge.functions import text as T
from corpusforge.operators import geometry, indexing, lines, rules, songs
from corpusforge.sources import readers, writers

#: What is stated: name -> (rows as SQL, function).
STATED: dict = {}


def query(rows: str):
    def register(f):
        STATED[f.__name__] = (rows, f)
        return f

    return register


def stated(columns: str, rows: list[tuple]) -> str:
    """SQL for the rows as they are."""
    cell = lambda x: "NULL" if x is None else str(x) if isinstance(x, (int, float)) else "'" + x.replace("'", "''") + "'"
    typed = ", ".join(f"{n}::{t} AS {n}" for n, t in (c.split() for c in columns.split(", ")))
    return f"SELECT {typed} FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) AS t({', '.join(c.split()[0] for c in columns.split(', '))})"


def columns_of(spark, named: dict) -> object:
    """(name, value) of Columns without a table."""
    pairs = F.array(*(F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in named.items()))
    return spark.range(1).select(F.explode(pairs).alias("p")).select("p.*")


_array = lambda *x: F.array(*map(F.lit, x))
_joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
_pairs = lambda c: F.array_join(F.transform(c, lambda t: F.concat_ws(":", t["col"].cast("string"), t["label"])), "|")


@query(stated("name VARCHAR, value VARCHAR", [
    ("F3", "asta Si TA"), ("F4", "Sâs ațî".replace("ț", "t")), ("F5", "șțȘȚ"), ("F7", "Ab!"), ("F12 all", "ȘTIU"), ("F12 first", "Știu"), ("F12 lower", "știu"),
    ("F14", "ca sa: (nu)!"), ("F16", "Song"), ("F17", "**A** · Sursa: B, p. 3"), ("F18 artist", "Phoenix"), ("F18 source", "Caiet, p. 3"), ("F18 none", None),
    ("F19", "a||  b"), ("F24", "<b>x</b> <i>y</i> <a href=\"u\">z</a> &lt;"), ("F26", "[a](p/b.md) [c](#d) [e](http://f)"), ("F34", "4"), ("P20", "primulvers acum"), ("W12", "[C] la|^|[(C)]|[C]|^"), ("W13", "C   Am Dm7 G"),
]))
def text_rules(spark, sf_dir):
    """F3-F5, F7, F12, F14, F16-F19, F24, F26, F34, P20, W12, W13."""
    meta = F.lit("**Phoenix** · Sursa: Caiet, p. 3 · x")
    return columns_of(spark, {
        "F3": T.strip_accents(F.lit("ăsta Şi ȚA")), "F4": T.flatten_marks(F.lit("Șâș ațî")), "F5": T.comma_below(F.lit("şţŞŢ")), "F7": T.shift_decode(F.lit("$E\x04"), 29),
        "F12 all": T.match_case(F.lit("știu"), F.lit("STIU")), "F12 first": T.match_case(F.lit("știu"), F.lit("Stiu")), "F12 lower": T.match_case(F.lit("știu"), F.lit("stiu")),
        "F14": T.search_key(F.lit("Că să: (NU)!")), "F16": T.base_title(F.lit("Song (Variantă)")), "F17": T.meta_line(F.lit("**A**"), F.lit(""), F.lit(None).cast("string"), F.lit("Sursa: B, p. 3")),
        "F18 artist": T.meta_artist(meta), "F18 source": T.meta_source(meta), "F18 none": T.meta_artist(F.lit("no bold")),
        "F19": _joined(T.dedent(_array("  a", "", "    b"))), "F24": T.mini_markdown(F.lit("**x** *y* [z](u) <")), "F26": T.rewrite_links(F.lit("[a](b.md) [c](#d) [e](http://f)"), "p/"),
        "F34": T.common_prefix(F.lit("dianei"), F.lit("diana")), "P20": T.signature(_array("la", "Primul vers", "acum"), 5, 3), "W12": _joined(T.mark_repeats(_array("[C] la", "[C] la", "[(C)]", "[C]", "[C]"))),
        "W13": T.place_tokens(_array(0, 4, 5, 6), _array("C", "Am", "Dm7", "G")),
    })


SONG = ["Refren:", "[Am]La mul[C]ți ani", "C  G", "", "1. Hai [(G)]noroc", "[N.C.] sus", "2.5 lei"]


@query(stated("name VARCHAR, value VARCHAR", [
    ("F15", "la multi ani hai noroc sus 2 5 lei"), ("F20 marker", "[Refren]"), ("F20 rest", "la la"), ("F21", "0:Am|2:C|5:G"), ("F22", "0:C|3:Am7|8:G"), ("F40", "9 m7"), ("F41", "Am|C|G"), ("F42", "Bm|D|A"), ("F43", "-5"), ("F44", "true false true"),
    ("F47 curated", "xx0232"), ("F47 other name", "244322"), ("F47 shifted", "x13331"), ("F28", "**C:** F 244322 · A# x13331 · Q"), ("F48", "a [Bm]b [D/A] [Solo]"), ("F49", "true"), ("F50", "17.5"),
    ("J15", "C#dim/F|C#dim|C#dim7|C#"), ("J16", "D4/F|D4"), ("J17", "D#5|D#|Eb5"), ("J18", "Db7 C# Am"), ("P10", "true"), ("P11", "true false N.C. riff G true"), ("P13", "true false"), ("P17", "by me|(popular)"), ("P18", "true true false"), ("P22", "a|  b"), ("O7", "two"),
]))
def song_rules(spark, sf_dir):
    """F15, F20-F22, F28, F40-F44, F47-F50, J15, J18, O7, P10-P13, P17, P18, P22."""
    shapes = F.create_map(F.lit("D"), F.lit("xx0232"), F.lit("Gb"), F.lit("244322"), F.lit("F"), F.lit("244322"))
    typed = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(x).alias("line")) for k, x in (("tab", "[C] e|--"), ("text", "C G"), ("text", "la [Riff 2] la"))))
    say = lambda *c: F.concat_ws(" ", *(x.cast("string") for x in c))
    hoisted, optional = songs.hoist_marker(F.lit("[Refren] la la")), songs.split_optional(F.lit("(G)"))
    layouts = F.array(*(F.struct(F.lit(s).alias("score"), F.lit(-c).alias("simple"), F.lit(n).alias("name")) for s, c, n in ((11.0, 3, "three"), (12.0, 2, "two"), (12.0, 4, "four"))))
    fret = lambda c, n: pitch.fingering(F.lit(c), F.lit("x02220"), F.lit(n), F.lit(False), shapes)
    return columns_of(spark, {
        "F15": F.array_join(songs.lyric_words(_array(*SONG)), " "), "F20 marker": hoisted["marker"], "F20 rest": hoisted["rest"], "F21": _pairs(songs.inline_tokens(F.lit("[Am]wo[C]rd [G]"))), "F22": _pairs(songs.two_row_tokens(F.lit("C  Am7  G"))),
        "F40": say(pitch.pitch_class(pitch.root(F.lit("Am7/G"))), pitch.quality(F.lit("Am7/G"))), "F41": _joined(pitch.chord_list(_array("[Am]la [Am]mul[C]ți", "C  G", "B: hai"), songs.CHORD, songs.BETWEEN)), "F42": _joined(pitch.normalise(_array("Am", "C", "G/B"), F.lit(2))),
        "F43": pitch.interval(F.lit(0), F.lit(7)), "F44": say(pitch.uses_flats(F.lit("Dm")), pitch.uses_flats(F.lit("Am")), pitch.uses_flats(F.lit("Abm"))),
        "F47 curated": fret("C", 2), "F47 other name": fret("F", 1), "F47 shifted": fret("A", 1), "F28": pitch.transpose_fingering_line(F.lit("**C:** E 022100 · A x02220 · Q"), F.lit(1), F.lit(False), shapes),
        "F48": songs.transpose_inline(F.lit("a [Am]b [C/G] [Solo]"), F.lit(2), F.lit(False)), "F49": pitch.fits(F.lit("x02210"), [4, 9, 2, 7, 11, 4], _array(9, 0, 4), F.array(F.lit(4))), "F50": songs.quality_score(F.lit(4), F.lit(4.5), F.lit(3)),
        "J15": _joined(pitch.guitar_keys(F.lit("(Dbdim/F)"))), "J16": _joined(pitch.ukulele_keys(F.lit("D4/F"))), "J17": _joined(pitch.catalogue_keys(F.lit("Eb5"))), "J18": say(pitch.respelled(F.lit("C#7")), pitch.respelled(F.lit("Db")), pitch.respelled(F.lit("Am"))),
        "P10": songs.has_inline(typed), "P11": say(songs.is_mark(F.lit("Riff 2")), songs.is_mark(F.lit("Am")), songs.mark_label(F.lit("no chord")), songs.mark_label(F.lit("Riff")), optional["chord"], optional["optional"]),
        "P13": say(lines.quality_gate(_array("C G", "la", "lo"), songs.CHORD), lines.quality_gate(_array("la", "lo", "li"), songs.CHORD)), "P17": _joined(lines.lead_lines(_array("by me", "(popular)", "[Am]la", "x"))),
        "P18": say(songs.is_byline(F.lit("Traditional")), songs.is_byline(F.lit("(N. N.)")), songs.is_byline(F.lit("Intro C"))), "P22": _joined(songs.clean_dots(_array("a", " . ", ". b"))), "O7": F.array_max(layouts)["name"],
    })


def lined(spark, text: str, doc: str = "d"):
    return spark.createDataFrame([(doc, i, x) for i, x in enumerate(text.split("\n"))], "doc string, ord int, line string")


BOOK = "## I\n### I.1\n#### One\n**Ana** · Sursa: A\n```text\n[C]la [C]lo\nC C\n```\n```tab\n[C]e [C]--\n```\n#### Two\n```text\n\n[G]a[(G)]b[G]c[G]d\n```\n## II\n#### Three\nnote"


@query(stated("step VARCHAR, spot BIGINT, value VARCHAR", [
    ("K8", 5, "[C]la ^lo"), ("K8", 14, "[G]a[(G)]b[G]c^d"),
    ("S10", 2, "I/I.1/One/Ana/note,text,text,tab"), ("S10", 11, "I/I.1/Two/-/text,text"), ("S10", 17, "II/-/Three/-/note"),
    ("K9", 0, "x"), ("K9", 1, "new"), ("K9", 2, "y"),
    ("W20", 0, "pair"), ("W20", 1, "paired"), ("W20", 2, "blank"), ("W20", 3, "interlude"), ("W20", 4, "tab"), ("W20", 5, "tab"), ("W20", 6, "plain"), ("W19", 4, "5"),
    ("P16", 1, "a"), ("P16", 2, ""), ("P16", 3, "b"), ("S14", 1, "Song=Am"), ("S13", 1, "Ana: T=u"),
    ("S15", 7, "Dor/Ana/1"), ("S15", 9, "Cer/Cantor/2"), ("S22", 0, "la   lo"),
]))
def book_steps(spark, sf_dir):
    """K8, K9, P16, S10-S15, S22, W12, W19, W20 on a book of a few lines."""
    part = lambda step, df, at, value: df.select(F.lit(step).alias("step"), F.col(at).cast("long").alias("spot") if isinstance(at, str) else at.cast("long").alias("spot"), value.cast("string").alias("value"))
    book = lined(spark, BOOK)
    held = songs.rewrite_fenced(book, "doc", "ord", "text", songs.hold_repeats, songs.is_chord_line).filter("changed")
    parsed = readers.markdown_songs(book)
    told = F.concat_ws("/", "part", F.coalesce("sub", F.lit("-")), "title", F.coalesce("artist", F.lit("-")), F.array_join(F.transform("body", lambda x: x["kind"]), ","))
    put = writers.insert_lines(lined(spark, "x\nold!\ny"), spark.createDataFrame([("d", 0, "new")], "doc string, after int, line string"), "doc", "ord", "!$")
    typed = lined(spark, "C  Am\nla la\n\nG D\ne|--0--2--|\nB|--------|\nend").withColumn("fence", F.when(F.col("ord").isin(4, 5), "tab").otherwise("text"))
    kinds = songs.row_kinds(typed, "doc", "ord", "fence")
    runs = songs.runs_of(kinds, "doc", "ord")
    trimmed = lines.edge_trim(lined(spark, "\na\n\nb\n "), "doc", "ord")
    chosen = readers.selection(lined(spark, "# list\n- Song | Am"))
    links = readers.link_catalogue(lined(spark, "## Ana\n- [T](u)"))
    toc = songs.contents(lined(spark, " 1. Dor (Ana) ..... 7\nPARTEA A II-A\nCantor\n 2. Cer ........ 9"))
    own = spark.createDataFrame([("by us", ["no"]), (None, ["la [C] lo"])], "meta string, body array<string>")
    return (
        part("K8", held, "ord", F.col("line")).unionAll(part("S10", parsed, "start", told)).unionAll(part("K9", put, "ord", F.col("line"))).unionAll(part("W20", kinds, "ord", F.col("kind")))
        .unionAll(part("W19", runs, "first", F.col("last"))).unionAll(part("P16", trimmed, "ord", F.col("line")))
        .unionAll(part("S14", chosen, "ord", F.concat_ws("=", "title", "key"))).unionAll(part("S13", links, "ord", F.concat(F.col("artist"), F.lit(": "), F.col("title"), F.lit("="), F.col("href"))))
        .unionAll(part("S15", toc, "page", F.concat_ws("/", "title", "artist", F.col("part").cast("string")))).unionAll(part("S22", songs.foreign_lines(own, "by us"), F.lit(0), F.col("line")))
    )


@query(stated("key VARCHAR, name VARCHAR, items VARCHAR", [("ana", "Ana", "[One](#one);@ [Zi](z)"), ("bob", "Bob", "@ [A](a);@ [B](b)"), ("zed", "Zed", "[Two](#two)")]))
def index_links(spark, sf_dir):
    """Run twice, the second time over its own output."""
    index = spark.createDataFrame([("ana", "Ana", ["[One](#one)", "@ [Old](o)"]), ("gone", "Gone", ["@ [X](x)"]), ("zed", "Zed", ["[Two](#two)"])], "key string, name string, items array<string>")
    links = spark.createDataFrame([("bob", "Bob", "B", "b", "b"), ("bob", "Bob", "A", "a", "a"), ("ana", "Ana", "Zi", "z", "zi")], "key string, name string, title string, href string, fold string")
    once = indexing.merge_links(index, links, "key", "fold")
    return indexing.merge_links(once, links, "key", "fold").withColumn("items", F.array_join("items", ";"))


GLYPHS = [("d", 1, i, c, x, x + 5, y, 10.0, f) for i, (c, x, y, f) in enumerate([("a", 0.0, 0.0, "f"), ("\x01", 6.0, 1.0, "f"), ("c", 21.0, 2.0, "f"), ("*", 50.0, 2.0, "deco"), ("d", 0.0, 30.0, "f"), ("e", 60.0, 30.0, "f"), ("n", 0.0, 900.0, "f")])]


@query(stated("line BIGINT, y DOUBLE, text VARCHAR, parts BIGINT, after BIGINT", [(1, 1.0, "aș  c", 1, 0), (2, 30.0, "d" + " " * 11 + "e", 2, 1)]))
def glyph_page(spark, sf_dir):
    """A page of glyphs becomes lines; parts: segments; after: blank lines before it."""
    page = geometry.band(geometry.drop_fonts(spark.createDataFrame(GLYPHS, geometry.GLYPH), ["deco"]), -1.0, 800.0)
    page = geometry.decode_fonts(page, spark.createDataFrame([("f", "\x01", "ș")], "font string, c string, shown string"))
    found = geometry.glyph_lines(page)
    parts = geometry.segments(found).groupBy("line").agg(F.max("segment").cast("long").alias("parts"))
    text = geometry.line_text(found, F.lit(5.0)).join(parts, "line")
    blanks = lines.blank_on_gap(text.withColumn("line", F.col("line").cast("string")).select("doc", "y", "line"), "doc", "y", "y", 24.0).filter("line = ''").groupBy("y").agg(F.count("*").alias("after"))
    return text.join(blanks, "y", "left").select(F.col("line").cast("long").alias("line"), "y", "text", "parts", F.coalesce("after", F.lit(0)).cast("long").alias("after"))


@query(stated("num BIGINT, title VARCHAR, part BIGINT, artist VARCHAR, also VARCHAR", [(1, "Dor (I)", 1, "Ana", "b, p. 20"), (2, "Dor (II)", 1, None, ""), (3, "Zi", 1, None, ""), (4, "Cer", 2, None, "b, p. 60")]))
def merge_build(spark, sf_dir):
    """T10 (T6, T8, W22, W24): six items of two sources, two of them merged away."""
    items = spark.createDataFrame([(1, "a", "Dor (Variantă)", 1, None, 10), (2, "b", "Dorul", 2, "Ana", 20), (3, "b", "Dor de", 1, None, 30), (4, "a", "Zi", 1, None, 40), (5, "b", "Cer (II)", 2, None, 50), (6, "b", "Cerul", 2, "Bob", 60)], "id long, src string, title string, part long, artist string, page int")
    components = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)], "node long, component long")
    dropped = spark.createDataFrame([(2, 1), (6, 5)], "dropped long, kept long")
    return songs.merged_book(items, components, dropped, F.when(F.col("src") == "a", 0).otherwise(1), "a").select("num", "title", "part", "artist", "also")


@query(stated("what VARCHAR, key VARCHAR, n BIGINT", [("groups of size", "2", 1), ("groups of size", "3", 1), ("pairs of", "a - b", 2), ("pairs of", "b - b", 1), ("merges", "", 1), ("items of part", "1", 3), ("items of part", "2", 2)]))
def merge_plan(spark, sf_dir):
    """T16."""
    items = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "b", 1), (4, "a", 2), (5, "b", 2)], "id long, src string, part int")
    pairs = spark.createDataFrame([(1, 2), (2, 3), (4, 5)], "a long, b long")
    components = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)], "node long, component long")
    return songs.plan_report(items, pairs, components, spark.createDataFrame([(2,)], "dropped long"))


@query(stated("name VARCHAR, value VARCHAR", [("K7", "a new b"), ("F63", "03d3eb2bd9b3b97a4b8b9ea9d8a8f3c9")]).replace("'03d3eb2bd9b3b97a4b8b9ea9d8a8f3c9'", "sha256('{\"t\":\"x\",\"n\":1}')"))
def checked_patch(spark, sf_dir):
    """A patch that stands exactly once, and a key over all inputs."""
    return columns_of(spark, {"K7": rules.patch_once(F.lit("a old b"), F.lit("old"), F.lit("new")), "F63": rules.content_key(F.lit("x").alias("t"), F.lit(1).alias("n"))})
