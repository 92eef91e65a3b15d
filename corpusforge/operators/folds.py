"""Folds over the lines of one text, in the JVM: Columns of arrays of lines to Columns.

A document's lines come from one row, so these need no shuffle. `fold` goes through an array in chunks:
what a step emits is appended to its chunk's short list, so a text of n lines costs no n squared copies.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import all_tokens, let, place_tokens

CHUNK = 256
#: Blanks in front of the rest of a wrapped line, a fixed value.
INDENT = 2
#: A closing repeat sign with its count, a fixed pattern; and the leading part of a line before its first slash outside of brackets.
CLOSER = r"/\s*[xX](\d+)\s*$"
BEFORE_SLASH = r"^((?:[^/\[]++|\[[^\]]*+\]|\[)*+)/"


def fold(items: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], state_type: str, out_type: str) -> Column:
    """struct<state, out>: step(state, item) gives the next state and an array of what to emit."""
    kind = f"struct<state:{state_type},out:array<{out_type}>>"
    none = F.array().cast(f"array<{out_type}>")

    def one(acc: Column, item: Column) -> Column:
        after, emitted = step(acc["state"], item)
        return F.struct(after.alias("state"), F.concat(acc["out"], emitted.cast(f"array<{out_type}>")).alias("out")).cast(kind)

    def some(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, F.struct(acc["state"].alias("state"), none.alias("out")).cast(kind), one)
        return let(inner, lambda x: F.struct(x["state"].alias("state"), F.concat(acc["out"], x["out"]).alias("out")).cast(kind))

    def chunks(all_: Column) -> Column:
        starts = F.when(F.size(all_) > 0, F.sequence(F.lit(1), F.size(all_), F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda at: F.slice(all_, at, CHUNK))

    return F.aggregate(let(items, chunks), F.struct(state.cast(state_type).alias("state"), none.alias("out")).cast(kind), some)


def enumerated(items: Column) -> Column:
    """array<struct<i, x>>, i from 0."""
    return F.transform(items, lambda x, i: F.struct(i.alias("i"), x.alias("x")))


# -- W17 --------------------------------------------------------------------------------------------------------------------
def join_wraps(rows: Column, most: int = 3, closed: str = ".,!?:;", grammar: str | None = None, between: str | None = None) -> Column:
    """A line of at most `most` words that begins in lower case joins the line before, as joined so far, behind a blank, or behind nothing
    after a hyphen; unless that line is blank, is a row of symbols or ends in one of the signs of `closed`. Null has no lines; lines that
    join lose the white space between them and at their end, others stay as they are."""
    def step(last: Column, row: Column) -> tuple[Column, Column]:
        s, before = F.trim(row), F.rtrim(last)
        open_ = ~F.lit(closed).contains(F.right(before, F.lit(1)))
        symbols = all_tokens(before, grammar, between) if grammar else F.lit(False)
        joins = last.isNotNull() & (before != "") & s.rlike(r"^\p{Ll}") & (F.size(F.split(s, r"\s+")) <= most) & open_ & ~symbols
        joined = F.concat(before, F.when(F.endswith(before, F.lit("-")), "").otherwise(" "), s)
        return F.when(joins, joined).otherwise(row), F.when(joins | last.isNull(), F.array().cast("array<string>")).otherwise(F.array(last))

    done = fold(rows, F.lit(None), step, "string", "string")
    return let(done, lambda x: F.when(x["state"].isNull(), x["out"]).otherwise(F.concat(x["out"], F.array(x["state"]))))


# -- W18 --------------------------------------------------------------------------------------------------------------------
def open_slash(line: Column) -> Column:
    """How many characters stand before the first slash outside of brackets; null without one."""
    found = F.regexp_extract(line, BEFORE_SLASH, 0)
    return F.when(found != "", F.length(found) - 1)


def repeat_spans(rows: Column) -> Column:
    """array<struct<first, last, times>> of the passages / ... / xN of a text's lines, in order of their end, lines counted from 0.

    A closing sign takes the nearest slash at or before it in its own block of lines between blank ones, across lines, above
    what an earlier passage of the block took; slashes in brackets don't count. first is null if there is none: an error of the text."""
    def step(free: Column, row: Column) -> tuple[Column, Column]:
        line = row["x"]
        times = F.nullif(F.regexp_extract(line, CLOSER, 1), F.lit(""))
        own = open_slash(F.regexp_replace(line, CLOSER, ""))
        first = F.when(own.isNotNull(), row["i"]).otherwise(free)
        after = F.when((F.trim(line) == "") | times.isNotNull(), F.lit(None)).when(own.isNotNull(), row["i"]).otherwise(free)
        span = F.struct(first.cast("int").alias("first"), row["i"].cast("int").alias("last"), times.cast("int").alias("times"))
        return after, F.when(times.isNotNull(), F.array(span)).otherwise(F.array().cast("array<struct<first:int,last:int,times:int>>"))

    return fold(enumerated(rows), F.lit(None), step, "int", "struct<first:int,last:int,times:int>")["out"]


def bar_repeats(rows: Column) -> Column:
    """The lines with the signs of their passages drawn as ||: and :||, with the count behind it unless it is 2. Closing signs without an
    opening one stay as they are."""
    def drawn(lines: Column, spans: Column) -> Column:
        known = F.filter(spans, lambda s: s["first"].isNotNull())
        starts, ends = F.transform(known, lambda s: s["first"]), F.map_from_arrays(F.transform(known, lambda s: s["last"]), F.transform(known, lambda s: s["times"]))

        def closed(line: Column, i: Column) -> Column:
            times = F.element_at(ends, i)
            sign = F.concat(F.rtrim(F.regexp_replace(line, CLOSER, "")), F.lit(" :||"), F.when(times == 2, "").otherwise(F.concat(F.lit(" ×"), times.cast("string"))))
            return F.when(times.isNotNull(), sign).otherwise(line)

        def opened(line: Column, i: Column) -> Column:
            at = open_slash(line)
            sign = F.concat(F.substring(line, F.lit(1), at), F.lit("||: "), F.ltrim(F.substring(line, at + 2, F.length(line))))
            return F.when(F.array_contains(starts, i) & at.isNotNull(), sign).otherwise(line)

        return F.transform(F.transform(lines, closed), opened)

    return let(F.struct(rows.alias("rows"), repeat_spans(rows).alias("spans")), lambda x: drawn(x["rows"], x["spans"]))


# -- F27 --------------------------------------------------------------------------------------------------------------------
_LAID = "struct<text:string,origin:int,break:int>"


def laid_out(line: Column, width: int) -> Column:
    """array<struct<text, origin, break>> of a line, as _laid_out_by_words cuts it. Where words stand one blank apart and fit behind the indent, a
    piece is the longest run of words that fits: one pattern finds it, and only pieces are folded."""
    kind = f"struct<at:int,out:array<{_LAID}>>"

    def piece(acc: Column, text: Column) -> Column:
        later = acc["at"] > 0
        own = F.struct(F.when(later, F.concat(F.lit(" " * INDENT), text)).otherwise(text).alias("text"), F.when(later, acc["at"] - INDENT).otherwise(0).alias("origin"), (acc["at"] + F.length(text)).alias("break"))
        return F.struct((acc["at"] + F.length(text) + 1).alias("at"), F.concat(acc["out"], F.array(own.cast(_LAID))).alias("out")).cast(kind)

    def ended(out: Column) -> Column:
        return F.transform(out, lambda p, i: F.struct(p["text"].alias("text"), p["origin"].alias("origin"), F.when(i < F.size(out) - 1, p["break"]).alias("break")).cast(_LAID))

    def cut(x: Column) -> Column:
        runs = F.regexp_extract_all(x, F.lit(rf"(?s)(^[^ ].{{0,{width - 1}}}|[^ ].{{0,{width - INDENT - 1}}})(?= |\z)"), 1)
        plain = let(F.aggregate(runs, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_LAID}>").alias("out")).cast(kind), piece)["out"], ended)
        return F.when(x.rlike(rf"^ |  | \z|^\z|[^ ]{{{max(width - INDENT + 1, 1)},}}"), _laid_out_by_words(x, width)).otherwise(plain)

    return let(line, cut) if width > INDENT else _laid_out_by_words(line, width)


def _laid_out_by_words(line: Column, width: int) -> Column:
    """array<struct<text, origin, break>>: the line cut at blanks into pieces of at most `width` characters, all but the first indented by two.

    A word wider than that stands alone; no word is cut. Where the first piece would be no longer than the indent, the line stays whole. origin:
    by how much a piece's columns are less than the line's; break: the line's column at which it was cut (null: its end). Blanks are U+0020."""
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit("( *)([^ ]+)"), 1).alias("gap"), F.regexp_extract_all(line, F.lit("( *)([^ ]+)"), 2).alias("word"))
    state = "struct<text:string,end:int,origin:int,whole:boolean>"
    indent = F.lit(" " * INDENT)

    def step(s: Column, t: Column) -> tuple[Column, Column]:
        start, gap = s["end"] + F.length(t["gap"]), F.length(t["gap"])
        end = start + F.length(t["word"])
        made = lambda text, origin, whole: F.struct(text.alias("text"), end.alias("end"), origin.alias("origin"), whole.alias("whole")).cast(state)
        emit = lambda text, cut: F.array(F.struct(text.alias("text"), s["origin"].alias("origin"), cut.cast("int").alias("break")).cast(_LAID))
        none = F.array().cast(f"array<{_LAID}>")
        first = s["text"].isNull()
        deep = first & (gap >= width + 2) & (gap > INDENT)  # nothing but blanks fits
        fits = ~first & (s["whole"] | (F.length(s["text"]) + gap + F.length(t["word"]) <= width))
        stays = ~first & ~fits & (s["origin"] == 0) & (start <= INDENT)
        fresh = made(F.concat(indent, t["word"]), start - INDENT, F.lit(False))
        grown = F.concat(F.coalesce(s["text"], F.lit("")), t["gap"], t["word"])
        # The last blank within the width, in the line's own columns; behind a word that is too wide, the first.
        cut = F.greatest(s["end"], F.least(start - 1, F.lit(width) + s["origin"]))
        after = F.when(deep, fresh).when(first, made(grown, F.lit(0), F.lit(False))).when(fits | stays, made(grown, s["origin"], s["whole"] | stays)).otherwise(fresh)
        return after, F.when(deep, emit(F.lit(""), F.lit(width + 1))).when(first | fits | stays, none).otherwise(emit(s["text"], cut))

    start = F.struct(F.lit(None).cast("string").alias("text"), F.lit(0).alias("end"), F.lit(0).alias("origin"), F.lit(False).alias("whole"))
    last = lambda x: F.struct(F.coalesce(x["state"]["text"], F.lit("")).alias("text"), x["state"]["origin"].alias("origin"), F.lit(None).cast("int").alias("break")).cast(_LAID)
    return let(fold(pairs, start, step, state, _LAID), lambda x: F.concat(x["out"], F.array(last(x))))


def wrap(line: Column, width: int) -> Column:
    """the pieces of a plain line."""
    return F.transform(laid_out(line, width), lambda p: p["text"])


def tokens(line: Column) -> Column:
    """array<struct<col, label>> of a row of symbols."""
    pairs = F.arrays_zip(F.regexp_extract_all(line, F.lit("( *)([^ ]+)"), 1).alias("gap"), F.regexp_extract_all(line, F.lit("( *)([^ ]+)"), 2).alias("label"))
    step = lambda at, t: (at + F.length(t["gap"]) + F.length(t["label"]), F.array(F.struct((at + F.length(t["gap"])).alias("col"), t["label"].alias("label"))))
    return fold(pairs, F.lit(0), step, "int", "struct<col:int,label:string>")["out"]


def place(positioned: Column) -> Column:
    """array<struct<col, label>> as a line, at least one blank between two."""
    return place_tokens(F.transform(positioned, lambda t: t["col"]), F.transform(positioned, lambda t: t["label"]))


def wrap_symbols(line: Column, width: int) -> Column:
    """a row of symbols alone, cut between symbols. Rows after the first begin indented and keep the columns of their further symbols."""
    def step(s: Column, t: Column) -> tuple[Column, Column]:
        begun, at = F.length(s["text"]) > 0, F.when(s["later"], F.greatest(t["col"], F.lit(INDENT))).otherwise(t["col"])
        grown = F.concat(F.rpad(s["text"], F.greatest(at, F.when(begun, F.length(s["text"]) + 1).otherwise(0)), " "), t["label"])
        over = begun & (F.length(grown) > width)
        after = F.struct(F.when(over, F.concat(F.lit(" " * INDENT), t["label"])).otherwise(grown).alias("text"), (s["later"] | over).alias("later"))
        return after, F.when(over, F.array(s["text"])).otherwise(F.array().cast("array<string>"))

    start = F.struct(F.lit("").alias("text"), F.lit(False).alias("later"))
    done = fold(tokens(line), start, step, "struct<text:string,later:boolean>", "string")
    return let(done, lambda x: F.concat(x["out"], F.array(x["state"]["text"])))


def wrap_pair(symbols: Column, lyric: Column, width: int) -> Column:
    """a row of symbols over a lyric, cut where the lyric is; a symbol goes with the piece that it stands over, and moves as far as that moves,
    but not into the indent. Pieces without symbols have no row of symbols."""
    def rows(x: Column) -> Column:
        def piece(p: Column, i: Column) -> Column:
            since = F.when(i > 0, F.get(x["pieces"], i - 1)["break"]).otherwise(F.lit(-1))
            mine = F.filter(x["tokens"], lambda t: (t["col"] >= since) & (p["break"].isNull() | (t["col"] < p["break"])))
            moved = F.transform(mine, lambda t: F.struct(F.when(i > 0, F.greatest(t["col"] - p["origin"], F.lit(INDENT))).otherwise(t["col"]).alias("col"), t["label"].alias("label")))
            return F.when(F.size(mine) > 0, F.array(place(moved), p["text"])).otherwise(F.array(p["text"]))

        return F.flatten(F.transform(x["pieces"], piece))

    return let(F.struct(laid_out(lyric, width).alias("pieces"), tokens(symbols).alias("tokens")), rows)


def wrap_lines(rows: Column, width: int, grammar: str, between: str | None = None, untouched: str | None = None) -> Column:
    """a text's lines wrapped: a row of symbols together with the lyric below it, rows of symbols alone between symbols, others between words. Blank
    lines are empty; lines that match `untouched` (tablature, prose) pass. Lines that fit pass as they are."""
    free = (lambda r: r.rlike(untouched)) if untouched else (lambda r: F.lit(False))

    def known(r: Column) -> Column:
        symbols = F.coalesce(all_tokens(r, grammar, between) & ~free(r), F.lit(False))
        return let(symbols, lambda s: F.struct(r.alias("row"), s.alias("symbols"), ((F.trim(r) != "") & ~s & ~free(r)).alias("lyric"), free(r).alias("free")))

    def one(all_: Column) -> Column:
        def line(x: Column, i: Column) -> Column:
            r, above, below = x["row"], F.get(all_, i - 1), F.get(all_, i + 1)
            taken = (i > 0) & x["lyric"] & F.coalesce(above["symbols"], F.lit(False))
            heads = x["symbols"] & F.coalesce(below["lyric"], F.lit(False))
            fit = F.length(r) <= width
            return (
                F.when(taken, F.array().cast("array<string>")).when(heads & fit & (F.length(below["row"]) <= width), F.array(r, below["row"])).when(heads, wrap_pair(r, below["row"], width))
                .when(F.trim(r) == "", F.array(F.lit(""))).when(x["free"] | fit, F.array(r)).when(x["symbols"], wrap_symbols(r, width)).otherwise(wrap(F.rtrim(r), width))
            )

        return F.flatten(F.transform(all_, line))

    return let(F.transform(rows, known), one)


# -- F52, A5 ------------------------------------------------------------------------------------------------------------
def largest_fitting(low: Column, high: Column, fits: Callable[[Column], Column], steps: int = 24) -> Column:
    """the largest value of a range for which a monotone predicate holds, by halving; high if it holds there, low if it holds nowhere."""
    def halve(x: Column, _: Column) -> Column:
        middle = (x["low"] + x["high"]) / 2
        return let(middle, lambda m: F.when(fits(m), F.struct(m.alias("low"), x["high"].alias("high"))).otherwise(F.struct(x["low"].alias("low"), m.alias("high"))))

    kind = "struct<low:double,high:double>"
    start = F.struct(low.alias("low"), high.alias("high")).cast(kind)
    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, lambda x, i: halve(x, i).cast(kind))["low"]
    return F.when(fits(high.cast("double")), high.cast("double")).otherwise(found)


def apart(bins: Column, least: int, distance: float) -> Column:
    """A5: of bins (struct<n, low>, the most frequent first; n and low with the neighbouring bins) the lows that are further than `distance` from
    all taken before, up to the first bin of fewer than `least`."""
    kind = "struct<taken:array<double>,open:boolean>"

    def step(acc: Column, b: Column) -> Column:
        go = acc["open"] & (b["n"] >= least)
        new = go & F.forall(acc["taken"], lambda e: F.abs(b["low"] - e) > distance)
        return F.struct(F.when(new, F.concat(acc["taken"], F.array(b["low"]))).otherwise(acc["taken"]).alias("taken"), go.alias("open")).cast(kind)

    return F.aggregate(bins, F.struct(F.array().cast("array<double>").alias("taken"), F.lit(True).alias("open")).cast(kind), step)["taken"]
