"""Layout-aware rendering of HTML to text.

A tree builder supplies implied tags, visibility rules drop what a browser would not show, and the
renderer emits all visible text with block spacing, list markers and aligned table cells.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Batches, lean, narrow, strings, tune

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: What may follow a tag's name up to its end, without the quoted values.
BARE = re.compile(r"[^>\"']*")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
INTEGER = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]+)")

# Fixed values of HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
HIDDEN = {"head", "script", "style", "template", "noscript", "title", "iframe", "object", "audio", "video", "canvas", "annotation", "annotation-xml", "desc", "metadata", "defs", "symbol", "datalist", "noembed", "noframes", "param"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "dl", "blockquote", "pre", "table", "figure", "hr", "fieldset"}
BLOCKS = SPACED | {"address", "article", "aside", "body", "center", "dd", "details", "dialog", "div", "dt", "figcaption", "footer", "form", "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "option", "search", "section", "summary", "tr", "caption"}
HEAD_ONLY = {"base", "link", "meta", "script", "style", "template", "title", "noscript"}
#: A start tag of the key closes open elements of the values, up to the elements that bound them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
#: Inside these, anything but the parts of a table is moved in front of the table.
TABLE_CONTEXT = {"table", "thead", "tbody", "tfoot", "tr"}
TABLE_PARTS = {"caption", "colgroup", "col", "thead", "tbody", "tfoot", "tr", "td", "th", "script", "style", "template"}
#: HTML's own bounds of spans.
COLSPAN, ROWSPAN = 1000, 65534
#: Elements open at once; deeper ones are siblings, as in browsers. Their text stays.
DEPTH = 400
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|$)", re.I | re.A) for tag in RAW}
#: Blanks in front of an aligned cell at most; a table of ever wider rows would else be written in quadratic space.
PAD = 200
#: Inside a drawing only these hold text that is shown.
DRAWN = {"text", "foreignobject"}
SCOPES = {"table", "td", "th", "caption", "button", "object", "html", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def plain(text: str) -> str:
    """Character references resolved; a number of too many digits is no character."""
    if "&#" in text:
        text = re.sub(r"&#0*([0-9]*)", lambda m: f"&#{m[1] if len(m[1]) < 8 else 1 << 21}", text, flags=re.A)
    return unescape(text) if "&" in text else text


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(text):
        if value[:1] in ("'", '"') and value[-1] == value[0] and len(value) > 1:
            value = value[1:-1]
        out.setdefault(name.lower(), plain(value))
    return out


class Tokens:
    """Cuts a page into text, comments and tags in one pass. What is sought and not there is remembered, so that no number of
    unclosed tags, quotes or comments makes a page be searched twice."""

    def __init__(self, html: str):
        self.html, self.absent = html, set()

    def find(self, sign: str, at: int) -> int:
        if sign in self.absent:
            return -1
        found = self.html.find(sign, at)
        if found < 0:
            self.absent.add(sign)
        return found

    def tag_end(self, at: int) -> int:
        """Where the sign that ends a tag stands; -1 if none does. A quote that is never closed is an ordinary character."""
        html, size = self.html, len(self.html)
        while True:
            at = BARE.match(html, at).end()
            if at >= size:
                return -1
            if html[at] == ">":
                return at
            before = at - 1
            while html[before].isspace():
                before -= 1
            close = self.find(html[at], at + 1) if html[before] == "=" else -1  # elsewhere a quote is an ordinary character
            at = at + 1 if close < 0 else close + 1

    def __call__(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, slash, name, attributes) of the next tag from `at`, without name for a comment; None if there is none."""
        html, size = self.html, len(self.html)
        while (start := self.find("<", at)) >= 0:
            after = html[start + 1 : start + 2]
            if after in ("!", "?"):
                sign = "-->" if html.startswith("<!--", start) else ">"
                end = self.find(sign, start + (4 if sign == "-->" else 2))
                return start, size if end < 0 else end + len(sign), "", "", ""
            slash = "/" if after == "/" else ""
            name = NAME.match(html, start + 1 + len(slash))
            if name:
                if ">" in self.absent or (end := self.tag_end(name.end())) < 0:
                    self.absent.add("<")  # no tag ends from here on: the rest is text
                    return None
                return start, end + 1, slash, name[0], html[name.end() : end]
            at = start + 1
        return None


def build(html: str) -> Node:
    """The tree, with html, head, body, tbody and tr supplied and open elements closed as start tags imply."""
    root = Node("html", {})
    stack, at = [root], 0

    opened: Counter = Counter()  # open elements by name, so that what is not open is not sought

    def cut(k: int) -> None:
        opened.subtract(n.tag for n in stack[k:])
        del stack[k:]

    def close(names: set[str], bounds: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in bounds:
                return
            if stack[k].tag in names:
                cut(k)
                return close(names, bounds)

    def add(item, tag: str = "") -> None:
        table = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == "table"), 0) if stack[-1].tag in TABLE_CONTEXT and tag not in TABLE_PARTS and opened["table"] else 0
        if table:
            siblings = stack[table - 1].children
            siblings.insert(next((k for k in range(len(siblings) - 1, -1, -1) if siblings[k] is stack[table]), len(siblings)), item)
        else:
            stack[-1].children.append(item)

    def push(tag: str, attrs: dict[str, str]) -> None:
        node = Node(tag, attrs)
        add(node, tag)
        stack.append(node)
        opened[tag] += 1

    def in_body() -> None:
        if stack[-1].tag == "head":
            cut(len(stack) - 1)
        if len(stack) == 1 and stack[0].tag == "html":
            body = next((c for c in root.children if isinstance(c, Node) and c.tag == "body"), None)
            if body:
                stack.append(body)
                opened["body"] += 1
            else:
                push("body", {})

    def text(value: str) -> None:
        if not value:
            return
        if stack[-1].tag in ("html", "head"):
            if not value.strip():
                return
            in_body()
        if value.strip() or stack[-1].tag not in TABLE_CONTEXT:
            add(plain(value))

    tokens = Tokens(html)
    while (token := tokens(at)) is not None:
        start, end, slash, name, inner = token
        text(html[at:start])
        at = end
        if not name:
            continue
        tag = name.lower()
        if slash:  # an end tag
            if tag in ("html", "body"):
                continue
            if tag in ("br", "p") and not opened[tag]:
                in_body()
                add(Node(tag, {}), tag)
                continue
            bounds = {"table"} if tag not in ("table",) and tag in CLOSES else (set() if tag == "table" else {"td", "th", "table"} - {tag})
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    cut(k)
                    break
                if stack[k].tag in bounds and tag not in BLOCKS | {"tbody", "thead", "tfoot"}:
                    break
            continue
        attrs = attributes(inner) if inner.strip(" /\t\n") else {}
        if tag == "html":
            root.attrs = {**attrs, **root.attrs}
            continue
        if tag == "head":
            if len(stack) == 1 and not root.children:
                push("head", attrs)
            continue
        if tag == "body":
            in_body()
            body = next(n for n in stack if n.tag == "body") if opened["body"] else stack[-1]
            body.attrs = {**attrs, **body.attrs}
            continue
        if len(stack) == 1 and tag in HEAD_ONLY and not root.children:
            push("head", {})
        if stack[-1].tag in ("html", "head") and tag not in HEAD_ONLY:
            in_body()
        if tag in BLOCKS:
            close({"p"}, SCOPES)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            if stack[-1].tag == "table":
                push("tbody", {})
            push("tr", {})
        elif tag == "tr" and stack[-1].tag == "table":
            push("tbody", {})
        if tag[0] == "h" and tag[1:].isdigit() and stack[-1].tag[0] == "h" and stack[-1].tag[1:].isdigit():
            cut(len(stack) - 1)
        if tag in VOID:
            add(Node(tag, attrs), tag)
            continue
        if tag == "table" and stack[-1].tag in TABLE_CONTEXT:
            close({"table"}, {"td", "th", "caption"})
        push(tag, attrs)
        if tag in RAW:
            found = RAW_END[tag].search(html, at)
            end = found.start() if found else len(html)
            value = html[at:end]
            stack[-1].children.append(plain(value) if tag in ("textarea", "title") else value)
            cut(len(stack) - 1)
            closing = html.find(">", end)
            at = len(html) if closing < 0 else closing + 1
        elif inner.endswith("/") and (opened["svg"] or opened["math"]) or len(stack) > DEPTH:
            cut(len(stack) - 1)
    text(html[at:])
    return root


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs and node.attrs["hidden"] != "until-found":
        return False
    if node.tag == "input" and node.attrs.get("type", "").lower() == "hidden":
        return False
    if node.tag == "dialog" and "open" not in node.attrs:
        return False
    style = node.attrs.get("style")
    return not (style and re.search(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", style.lower()))


#: White space that collapses.
COLLAPSING = re.compile(r"[^\S\xa0]+")
ROMAN = [(1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")]


def numeral(n: int, kind: str) -> str:
    """A list item's number as the list's type asks: a, A, i or I; numbers that these can't write, and other types, are decimal."""
    out, rest = "", n
    if kind in ("a", "A") and n > 0:
        while rest:
            rest, k = divmod(rest - 1, 26)
            out = chr(97 + k) + out
    elif kind in ("i", "I") and 0 < n < 4000:
        for value, sign in ROMAN:
            out += sign * (rest // value)
            rest %= value
    return (out.upper() if kind.isupper() else out) or str(n)


def shown_part(node: Node) -> Node:
    """A closed disclosure shows its first summary only."""
    if node.tag != "details" or "open" in node.attrs:
        return node
    closed = Node("details", node.attrs)
    closed.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return closed


class Canvas:
    """Lines being laid out: collapses white space, and keeps the widest of the gaps asked for."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line being written
        self.space, self.gap, self.marker = False, 0, ""

    def take(self) -> str:
        line, self.parts = "".join(self.parts).rstrip(), []
        return line

    def break_line(self, gap: int = 0) -> None:
        if line := self.take():
            self.lines.append(line)
        self.space = False
        self.gap = max(self.gap, gap)

    def begin(self) -> None:
        if not self.parts:
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            if self.marker:
                self.parts.append(self.marker)
            self.marker = " " * len(self.marker)

    def write(self, text: str) -> None:
        """White space of HTML collapses; blanks that don't break stay, each as one."""
        words = [w for w in COLLAPSING.split(text) if w] if "\xa0" in text else text.split()
        if not words:
            self.space = self.space or bool(text)
            return
        lead = text[0] != "\xa0" and text[0].isspace() or self.space
        fresh = not self.parts
        self.begin()
        self.parts.append((" " if lead and not fresh else "") + " ".join(words).replace("\xa0", " "))
        self.space = text[-1] != "\xa0" and text[-1].isspace()

    def close(self, sign: str) -> None:
        """A sign right behind what is written."""
        self.begin()
        self.parts.append(sign)

    def verbatim(self, text: str) -> None:
        for k, part in enumerate(text.split("\n")):
            if k:
                if self.parts:
                    self.lines.append(self.take())
                elif self.lines:
                    self.lines.append("")
            if part:
                self.begin()
                self.parts.append(part.expandtabs(8))

    def text(self) -> str:
        self.break_line()
        return "\n".join(self.lines).strip("\n")


def table_rows(node: Node) -> list[Node]:
    out = []
    for c in node.children:
        if isinstance(c, Node) and visible(c):
            if c.tag == "tr":
                out.append(c)
            elif c.tag in ("thead", "tbody", "tfoot"):
                out += table_rows(c)
    return out


def number(value: str | None, default: int) -> int:
    """An integer as HTML reads it: blanks, a sign, ASCII digits, then anything. Others, and those of over nine digits, count as missing."""
    found = INTEGER.match(value or "")
    return int(found[1]) if found and len(found[1].lstrip("+-")) < 10 else default


def grid_of(node: Node) -> list[list[tuple[int, list[str]]]]:
    """(column, lines) of the cells of each row. What spans down from earlier rows is kept as runs (from, to, first free row)."""
    grid, hanging, rows = [], [], table_rows(node)
    for y, row in enumerate(rows):
        hanging = [h for h in hanging if h[2] > y]
        x, k, cells, fresh = 0, 0, [], []
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th") and visible(cell):
                while k < len(hanging) and hanging[k][0] <= x:
                    x = max(x, hanging[k][1])
                    k += 1
                wide = min(max(number(cell.attrs.get("colspan"), 1), 1), COLSPAN)
                high = number(cell.attrs.get("rowspan"), 1)
                cells.append((x, render(cell).split("\n")))
                if high == 0 or high > 1:  # 0: down to the end
                    fresh.append((x, x + wide, min(y + min(high or ROWSPAN, ROWSPAN), len(rows))))
                x += wide
        if fresh:
            joined = []
            for h in sorted(hanging + fresh):
                if joined and joined[-1][1:] == (h[0], h[2]):
                    joined[-1] = (joined[-1][0], *h[1:])
                else:
                    joined.append(h)
            hanging = joined
        grid.append(cells)
    return grid


def render_table(node: Node) -> list[str]:
    """Cells of a column start at the same place; cells of several lines keep them; spans take the columns they cover."""
    grid = grid_of(node)
    starts = sorted({x for row in grid for x, _ in row})
    width = dict.fromkeys(starts, 0)
    for row in grid:
        for (x, lines), after in zip(row, [*row[1:], None]):
            following = bisect_right(starts, x)
            if following == len(starts) or after is not None and starts[following] >= after[0]:
                width[x] = max(width[x], *(len(line) for line in lines))
    place, at = {}, 0
    for x in starts:
        place[x], at = at, at + width[x] + 2
    out = []
    for row in grid:
        parts: list[list[str]] = [[] for _ in range(max((len(lines) for _, lines in row), default=0))]
        sizes = [0] * len(parts)
        for x, lines in row:
            for k, line in enumerate(lines):
                if line:
                    pad = min(max(place[x] - sizes[k], 2 if sizes[k] else 0), PAD)
                    parts[k].append(" " * pad + line)
                    sizes[k] += pad + len(line)
        out += ["".join(p).rstrip() for p in parts]
    return out


def render(node: Node) -> str:
    canvas = Canvas()

    def walk(node: Node, depth: int, pre: bool, order: tuple[str, int, list[int]] | None) -> None:
        for child in shown_part(node).children:
            if isinstance(child, str):
                canvas.verbatim(child) if pre else canvas.write(child)
                continue
            if not visible(child):
                continue
            tag = child.tag
            if tag == "br":
                if not canvas.parts and canvas.lines:
                    canvas.gap = max(canvas.gap, 1)
                canvas.break_line()
            elif tag == "hr":
                canvas.break_line(1)
            elif tag == "wbr":
                pass
            elif tag == "input":
                if child.attrs.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                    canvas.write(child.attrs.get("value", ""))
            elif tag == "table":
                canvas.break_line(1)
                for c in child.children:
                    if isinstance(c, Node) and c.tag == "caption" and visible(c):
                        walk(c, depth, False, None)
                        canvas.break_line()
                for line in render_table(child):
                    canvas.verbatim(line)
                    canvas.break_line()
                canvas.break_line(1)
            elif tag in ("ul", "ol", "menu"):
                canvas.break_line(0 if depth else 1)
                marker = canvas.marker
                back = "reversed" in child.attrs
                items = sum(isinstance(c, Node) and c.tag == "li" for c in child.children) if back else 1
                walk(child, depth + 1, pre, (child.attrs.get("type", ""), -1 if back else 1, [number(child.attrs.get("start"), items)]) if tag == "ol" else None)
                canvas.break_line(0 if depth else 1)
                canvas.marker = marker
            elif tag == "li":
                canvas.break_line()
                sign = "- "
                if order:
                    kind, step, following = order
                    own = number(child.attrs.get("value"), following[0])
                    sign = f"{numeral(own, kind)}. "
                    following[0] = own + step
                before = canvas.marker
                canvas.marker = "  " * (max(depth, 1) - 1) + sign
                walk(child, max(depth, 1), pre, None)
                canvas.break_line()
                canvas.marker = before
            elif tag == "q":
                canvas.write('"')
                walk(child, depth, pre, order)
                canvas.close('"')
            elif tag == "svg":
                drawn(child, depth)
            elif tag in BLOCKS:
                gap = int(tag in SPACED and depth == 0)
                canvas.break_line(gap)
                before = canvas.marker
                if tag in ("blockquote", "dd"):
                    canvas.marker = canvas.marker + "  "
                walk(child, depth, pre or tag == "pre", None)
                canvas.break_line(gap)
                canvas.marker = before if not before.strip() else canvas.marker
            else:
                walk(child, depth, pre or tag in ("textarea",), order)

    def drawn(node: Node, depth: int) -> None:
        for child in node.children:
            if isinstance(child, Node) and visible(child):
                if child.tag in DRAWN:
                    canvas.break_line()
                    walk(child, depth, False, None)
                    canvas.break_line()
                else:
                    drawn(child, depth)

    walk(node, 0, node.tag == "pre", None)
    return canvas.text()


def to_text(html: str | None) -> str:
    """All visible text of a page; null and empty pages have none."""
    return render(build(html)) if html else ""


def extract(pages: DataFrame, id: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """Returns id, the kept columns, text and n_chars for every whole page.

    Null and empty pages give an empty text. Pages of any length are read in one pass; malformed ones are rendered as browsers recover:
    unclosed quotes and tags are text, numbers that are none count as missing, spans are bounded as in HTML (COLSPAN, ROWSPAN), aligned cells stand at most PAD blanks apart, and
    elements nested deeper than DEPTH become siblings, with all their text. Formulas and the text of drawings are shown. Repeated rows
    stay; an empty table gives an empty result; other columns are ignored.
    """
    tune(pages.sparkSession)
    df = narrow(pages, **{"id": id, "html": html}, **{f"kept{k}": c for k, c in enumerate(keep)})
    names = [id, *keep, "text", "n_chars"]

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = [to_text(h) for h in strings(batch, "html")]
            kept = [batch.column(batch.schema.get_field_index(f"kept{k}")) for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    kept = "".join(f"`{c}` {kind[f'kept{k}']}, " for k, c in enumerate(keep))
    return df.mapInArrow(lean(run), f"`{id}` {kind['id']}, {kept}text string, n_chars long")
