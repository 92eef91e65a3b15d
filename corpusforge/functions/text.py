"""Text functions, Column to Column."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding() -> tuple[str, str]:
    """Letters of the Latin blocks whose canonical decomposition is one base letter and marks, and those letters."""
    pairs = []
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if base != c and len(base) == 1:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_FROM, _TO = _folding()

#: Letters of surface words, one by one: the regex engine looks single letters up in a bit set but tries ranges in turn.
_SURFACE = "".join(map(chr, [*range(0x61, 0x7B), *range(0x30, 0x3A), *range(0xE0, 0xF7), *range(0xF8, 0x100), 0xDF]))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row. An expression that a lambda names is otherwise evaluated again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(x: Column) -> Column:
    """Lower case without accents, over the closed alphabet of the Latin blocks (ß stays)."""
    return F.translate(F.lower(x), _FROM, _TO)


def norm(x: Column) -> Column:
    """folded, a-z and 0-9 only."""
    return F.regexp_replace(fold(x), "[^a-z0-9]+", "")


def norm_spaced(x: Column) -> Column:
    """folded, every other run one space."""
    return F.trim(F.regexp_replace(fold(x), "[^a-z0-9]+", " "))


def sort_key(x: Column) -> Column:
    """O1: folded, without leading signs; compared by code points."""
    return F.regexp_replace(fold(x), "^[^a-z0-9]+", "")


def search_key(x: Column) -> Column:
    """folded, all signs kept: a filter may match anywhere."""
    return fold(x)


def strip_accents(x: Column) -> Column:
    """without accents, case kept."""
    return F.translate(x, _FROM, _TO)


def flatten_marks(x: Column) -> Column:
    """only ă, ș, ț and their cedilla forms lose their marks; â and î stay."""
    return F.translate(x, "ăĂșȘțȚşŞţŢ", "aAsStTsStT")


def comma_below(x: Column) -> Column:
    """legacy cedilla letters become comma-below ones."""
    return F.translate(x, "şŞţŢ", "șȘțȚ")


#: Letters whose capital is written with several letters, and their one-letter capitals (themselves if they have none).
_LONG = "".join(c for c in map(chr, range(0x80, 0x10000)) if len(c.upper()) > 1)
_CAPITALS = "".join("ẞ" if c == "ß" else c.title() if len(c.title()) == 1 else c for c in _LONG)


def upper_letters(x: Column) -> Column:
    """Capitals letter by letter: one letter stays one, so ß becomes ẞ and not SS."""
    return F.array_join(F.transform(F.split(x, ""), lambda c: F.when(F.length(F.upper(c)) > F.length(c), F.translate(c, _LONG, _CAPITALS)).otherwise(F.upper(c))), "")


def slug(x: Column) -> Column:
    """lower case, word characters, hyphens and blanks; blanks become hyphens."""
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"(?U)[^\w\- ]", ""), " ", "-")


def strip(x: Column) -> Column:
    """All white space at both ends goes."""
    return F.regexp_replace(F.regexp_replace(x, r"^\s+", ""), r"\s+$", "")


def words(x: Column) -> Column:
    """Folded words of a-z and 0-9, in order; null gives none."""
    return F.array_remove(F.split(F.coalesce(fold(x), F.lit("")), "[^a-z0-9]+"), "")


def surface_words(x: Column) -> Column:
    """Lower-case words with their accents, in order."""
    return F.array_remove(F.split(F.coalesce(F.lower(x), F.lit("")), f"[^{_SURFACE}]+"), "")


def lines(x: Column) -> Column:
    return F.split(x, "\n")


def ngrams(w: Column, n: int) -> Column:
    """Runs of n words joined by blanks; fewer than n words have none."""
    runs = lambda x: F.transform(F.sequence(F.lit(1), F.size(x) - (n - 1)), lambda i: F.array_join(F.slice(x, i, n), " "))
    return let(w, lambda x: F.when(F.size(x) >= n, runs(x)).otherwise(F.array().cast("array<string>")))


def match_case(word: Column, like: Column) -> Column:
    """the case of `like` (all capitals, initial capital or lower) for `word`."""
    first = F.concat(F.upper(F.substring(word, 1, 1)), F.expr("''"))
    capital = F.concat(first, F.substring(word, F.lit(2), F.length(word)))
    upper = (like == F.upper(like)) & (like != F.lower(like)) & (F.length(like) > 1)
    return F.when(upper, F.upper(word)).when(F.substring(like, 1, 1) != F.lower(F.substring(like, 1, 1)), capital).otherwise(word)


def base_title(x: Column) -> Column:
    """F16: without the suffix of a variant: (I) to (III), then (variantă), (varianta), (II) or (III) in any case."""
    return strip(F.regexp_replace(F.regexp_replace(x, r"\s*\(I{1,3}\)\s*$", ""), r"(?i)\s*\((?:variant[ăa]|II|III)\)\s*$", ""))


def meta_line(*parts: Column) -> Column:
    """the parts that aren't null or empty, joined by a middle dot."""
    return F.concat_ws(" · ", *(F.nullif(p, F.lit("")) for p in parts))


def meta_artist(x: Column) -> Column:
    """the bold lead of a metadata line; null if there is none."""
    return F.nullif(F.regexp_extract(x, r"^\*\*(.+?)\*\*", 1), F.lit(""))


def meta_source(x: Column) -> Column:
    """what follows the source label."""
    return F.nullif(F.regexp_extract(x, r"Sursa: ([^·]+?)\s*(?:·|$)", 1), F.lit(""))


def dedent(rows: Column) -> Column:
    """an array of lines without their common margin; blank lines don't count."""
    def moved(x: Column) -> Column:
        return F.transform(x["rows"], lambda r: F.when(F.trim(r) == "", "").otherwise(F.substring(r, F.coalesce(x["margin"], F.lit(0)) + 1, F.length(r))))

    def margin(all_: Column) -> Column:
        least = F.array_min(F.transform(F.filter(all_, lambda r: F.trim(r) != ""), lambda r: F.length(r) - F.length(F.ltrim(r))))
        return F.struct(all_.alias("rows"), least.alias("margin"))

    return let(let(rows, margin), moved)


def shift_decode(x: Column, shift: int, extra: dict[str, str] | None = None) -> Column:
    """every character moved by `shift` code points, but for those of a small map."""
    extra = extra or {}
    moved = F.transform(F.filter(F.split(x, ""), lambda c: c != ""), lambda c: F.coalesce(*([F.element_at(F.create_map(*[F.lit(v) for kv in extra.items() for v in kv]), c)] if extra else []), F.char(F.ascii(c) + shift)))
    return F.array_join(moved, "")


def strip_tags(html: Column) -> Column:
    """F24 the other way round: text without comments, scripts, styles and tags, blanks collapsed."""
    x = F.regexp_replace(html, r"(?s)<!--.*?-->", " ")
    x = F.regexp_replace(x, r"(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>", " ")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def links(html: Column) -> Column:
    """The targets of links, in order."""
    return F.regexp_extract_all(html, F.lit(r'<a\s+href="([^"]*)"'), 1)


def mini_markdown(x: Column) -> Column:
    """bold, emphasis, code and links of one line as HTML."""
    x = F.regexp_replace(F.regexp_replace(F.regexp_replace(x, "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    x = F.regexp_replace(x, r"\[([^\]]+)\]\(([^)\s]+)\)", '<a href="$2">$1</a>')
    x = F.regexp_replace(x, r"\*\*(.+?)\*\*", "<b>$1</b>")
    x = F.regexp_replace(x, r"\*(.+?)\*", "<i>$1</i>")
    return F.regexp_replace(x, r"`([^`]+)`", "<code>$1</code>")


def rewrite_links(x: Column, prefix: str) -> Column:
    """relative link targets get a prefix; absolute ones and anchors stay."""
    return F.regexp_replace(x, r"\]\((?![a-z]+:|#|/)([^)\s]+)\)", f"]({prefix}$1)")


def all_tokens(line: Column, grammar: str, ignore: str | None = None) -> Column:
    """A line has tokens, and all but the ignored ones match the grammar."""
    # Most lines fail by their first token, which is looked at before the line is split; the tokens are made once.
    first = F.regexp_extract(line, r"(\S++)", 1)
    fits = first.rlike(grammar) | first.rlike(ignore) if ignore else first.rlike(grammar)

    def told(tokens: Column) -> Column:
        return (F.size(tokens) > 0) & F.forall(tokens, lambda t: t.rlike(grammar))

    tokens = F.filter(F.split(line, r"\s+"), lambda t: (t != "") & ~t.rlike(ignore) if ignore else t != "")
    return F.when(line.isNull(), F.lit(None).cast("boolean")).otherwise((first != "") & fits & let(tokens, told))


def ordered_unique(tokens: Column) -> Column:
    """Different tokens in order of first appearance."""
    return F.array_distinct(tokens)


def collapse_runs(tokens: Column) -> Column:
    """Equal neighbours become one."""
    marked = lambda x: F.transform(x, lambda t, i: F.when((i > 0) & (F.get(x, i - 1) == t), F.lit(None)).otherwise(t))
    return F.filter(let(tokens, marked), lambda t: t.isNotNull())


def mark_repeats(tokens: Column, sign: str = "^", block: str = r"^\[\(|^\[(?:N\.C\.|Riff|Solo)") -> Column:
    """A token equal to the one just before it becomes the sign; optional tokens and markers neither change nor match."""
    same = lambda x, t, i: (i > 0) & (F.get(x, i - 1) == t) & ~t.rlike(block)
    return let(tokens, lambda x: F.transform(x, lambda t, i: F.when(same(x, t, i), F.lit(sign)).otherwise(t)))


def place_tokens(columns: Column, labels: Column) -> Column:
    """Labels at their columns, pushed right so that at least one blank stays between two."""
    pairs = F.arrays_zip(columns.alias("c"), labels.alias("l"))
    def step(line: Column, p: Column) -> Column:
        at = F.greatest(p["c"], F.when(F.length(line) > 0, F.length(line) + 1).otherwise(0))
        return F.concat(F.rpad(line, at.cast("int"), " "), p["l"])

    return F.aggregate(pairs, F.lit(""), step)


def truncate_at(rows: Column, sentinel: str) -> Column:
    """The lines before the first that matches; all if none does."""
    at = F.array_position(F.transform(rows, lambda r: r.rlike(sentinel)), True)
    return F.when(at > 0, F.slice(rows, F.lit(1), at.cast("int") - 1)).otherwise(rows)


def signature(rows: Column, k: int = 5, least: int = 8, grammar: str | None = None, ignore: str | None = None) -> Column:
    """P20: the first k lines longer than `least` that aren't rows of symbols, normalised and joined by blanks."""
    symbols = (lambda r: all_tokens(r, grammar, ignore)) if grammar else (lambda r: F.lit(False))
    told = F.filter(F.transform(rows, strip), lambda r: (F.length(r) > least) & ~symbols(r))
    return F.array_join(F.transform(F.slice(told, 1, k), norm), " ")


def common_prefix(a: Column, b: Column) -> Column:
    """the length of the common prefix."""
    n = F.least(F.length(a), F.length(b))
    first = F.array_min(F.filter(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))
    return F.coalesce(first - 1, n)
