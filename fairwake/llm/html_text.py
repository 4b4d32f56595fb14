"""Visible text of HTML pages, laid out.

A page's tags and texts go through a small tree builder that closes what HTML lets authors
leave open (paragraphs, list items, table cells, options, definitions) and ignores end tags
without a start. Rendering walks the tree: invisible elements and those hidden by attribute
or style are left out, white space collapses, blocks stand on lines of their own with blank
lines around paragraphs and headings, list items are marked or numbered and indented,
`pre` keeps its white space, and tables become lines with aligned cells, spans included.
What `visibility` hides is left out unless an element in it is visible again.

The work is one pass over the pages without a shuffle; a page is one row, and memory is a
multiple of the longest one. NULL html gives a NULL text; empty html, or a page without
visible text, gives the empty text. Nesting is handled without recursion, and tags, open
elements and unclosed quotes are found without going back, so time grows with the page. NULL
ids and repeated rows are carried through; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from html import unescape
from unicodedata import east_asian_width

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import fresh, small_batches


def _names(text: str) -> frozenset[str]:
    return frozenset(text.split())


# Element names of the HTML standard, by how they behave here.
VOID = _names("area base br col embed hr img input link meta param source track wbr")
RAW = _names("script style textarea title xmp iframe noembed noframes noscript plaintext")
INVISIBLE = _names(
    "head script style title template noscript iframe noembed noframes object svg math canvas audio video"
    " datalist select textarea link meta base area param source track"
)
PARAGRAPHS = _names("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure fieldset hr")
BLOCKS = PARAGRAPHS | _names(
    "html body address article aside center details dialog dd div dt figcaption footer form header hgroup"
    " legend li main nav section summary optgroup option tr caption thead tbody tfoot"
)
CELLS = _names("td th")
# An opening tag of the key closes open elements of the named kinds, up to the barriers.
CLOSES_P = BLOCKS - _names("html body option optgroup tr thead tbody tfoot caption")
IMPLIED = {
    "li": (_names("li"), _names("ul ol")),
    "dt": (_names("dt dd"), _names("dl")),
    "dd": (_names("dt dd"), _names("dl")),
    "option": (_names("option"), _names("select datalist")),
    "optgroup": (_names("option optgroup"), _names("select")),
    "td": (_names("td th"), _names("table")),
    "th": (_names("td th"), _names("table")),
    "tr": (_names("td th tr"), _names("table")),
    "tbody": (_names("td th tr thead tbody tfoot caption"), _names("table")),
    "thead": (_names("td th tr thead tbody tfoot caption"), _names("table")),
    "tfoot": (_names("td th tr thead tbody tfoot caption"), _names("table")),
    "body": (_names("head"), frozenset()),
}
# An end tag closes open elements inside only up to these.
SCOPES = _names("table td th html")
THROUGH_SCOPES = _names("tr tbody thead tfoot body")

NOT_A_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?", re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
INSIDE = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+""")  # never goes back
OUTSIDE_QUOTES = re.compile(r"""([^>"']++)|"[^"]*+"|'[^']*+'""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`]+))?""")
NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)", re.I)
SPACES = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: str = ""):
        self.name, self.attributes = name, attributes
        self.children: list[Node | str] = []

    def values(self) -> dict[str, str]:
        found = {}
        for name, value in ATTRIBUTE.findall(self.attributes):
            found.setdefault(name.lower(), unescape(value.strip("\"'")))
        return found

    def hidden(self) -> bool:
        """Whether neither the element nor anything in it is shown."""
        if self.name in INVISIBLE:
            return True
        if not self.attributes.strip(" /"):
            return False
        values = self.values()
        return (
            "hidden" in values
            or bool(NO_DISPLAY.search(values.get("style", "")))
            or (self.name == "input" and values.get("type", "").lower() == "hidden")
        )

    def visibility(self) -> bool | None:
        """What the element says about itself and, until one says otherwise, those in it."""
        if "visibility" not in self.attributes.lower():
            return None
        said = VISIBILITY.findall(self.values().get("style", ""))
        return said[-1].lower() == "visible" if said else None

    def number(self, name: str, default: int) -> int:
        value = self.values().get(name, "") if name in self.attributes.lower() else ""
        return int(value) if re.fullmatch(r"-?\d{1,9}", value) else default


class Tags:
    """Finds the next tag or comment of a page, in time that grows with the page's length.

    A tag that is not closed is text. Where its attributes were read as being outside of
    quotes, a tag that starts there reads on the same way and is not closed either, so the
    stretch is remembered and read once.
    """

    def __init__(self, html: str):
        self.html = html
        self.unclosed: list[tuple[list[int], list[int]]] = []  # stretches of each such reading

    def next(self, at: int) -> tuple[int, int, re.Match | None, str] | None:
        """(start, end, tag, attributes); tag is None for comments and the like."""
        while (start := self.html.find("<", at)) >= 0:
            if other := NOT_A_TAG.match(self.html, start):
                return start, other.end(), None, ""
            if (tag := TAG.match(self.html, start)) and not self._known(tag.end()):
                end = INSIDE.match(self.html, tag.end()).end()
                if self.html[end : end + 1] == ">":
                    return start, end + 1, tag, self.html[tag.end() : end]
                outside = [m.span() for m in OUTSIDE_QUOTES.finditer(self.html, tag.end(), end) if m[1]]
                outside.append((end, end))
                self.unclosed.append(([a for a, _ in outside], [b for _, b in outside]))
            at = start + 1
        return None

    def _known(self, at: int) -> bool:
        for starts, ends in self.unclosed:
            i = bisect_right(starts, at) - 1
            if i >= 0 and at <= ends[i]:
                return True
        return False


class Stack:
    """The open elements, and where those of each name are."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().name].pop()

    def last(self, names: Iterable[str]) -> int:
        """Place of the innermost open element of these names, 0 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def close(self, names: frozenset[str], barriers: frozenset[str]) -> None:
        """Close the open elements of these names that no barrier hides."""
        barrier, found = self.last(barriers), []
        for name in names:
            places = self.places.get(name, [])
            i = bisect_right(places, barrier)
            found += places[i : i + 1]
        if found:
            self.cut(min(found))

    def end(self, name: str) -> None:
        """An end tag; one without a start within its scope does nothing."""
        place = self.last([name])
        if place and (name in SCOPES or name in THROUGH_SCOPES or place > self.last(SCOPES)):
            self.cut(place)


def tree(html: str) -> Node:
    root = Node("")
    stack, tags, at = Stack(root), Tags(html), 0
    while at < len(html):
        found = tags.next(at)
        text = html[at : found[0] if found else len(html)]
        if text:
            stack.nodes[-1].children.append(unescape(text))
        if not found:
            break
        _, at, tag, attributes = found
        if tag is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            stack.end(name)
            continue
        if name in CLOSES_P:
            stack.close(_names("p"), _names("table td th button"))
        if name in IMPLIED:
            stack.close(*IMPLIED[name])
        node = Node(name, attributes)
        stack.nodes[-1].children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            node.children.append(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
        elif name not in VOID:
            stack.push(node)
    return root


class Lines:
    """Collects text into lines; knows how much space the next text needs before it."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.prefix = ""  # indentation of the current block
        self.marker = ""  # of the list item whose first line is still to come
        self.gap = 0  # blank lines wanted before the next line
        self.space = False  # white space wanted before the next text

    def text(self, content: str, keep: bool = False) -> None:
        if keep:
            first, *rest = content.split("\n")
            self._add(first)
            for line in rest:
                self.end_line(force=True)
                self._add(line)
            return
        words = SPACES.split(content)
        if not words[0] and len(words) > 1:
            self.space = True
        for i, word in enumerate(words):
            if not word:
                continue
            if self.parts and (self.space or i and words[i - 1]):
                self.parts.append(" ")
            self.space = False
            self._add(word)
        if len(words) > 1 and not words[-1]:
            self.space = True

    def _add(self, content: str) -> None:
        if content:
            self.parts.append(content)

    def end_line(self, force: bool = False) -> None:
        if self.parts or force:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            head = self.marker or self.prefix
            self.marker = ""
            self.lines.append((head + "".join(self.parts)).rstrip())
        self.parts, self.space = [], False

    def block(self, blank: bool) -> None:
        self.end_line()
        if blank:
            self.gap = 1

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def width(line: str) -> int:
    """Places a line takes where wide characters take two."""
    return len(line) if line.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in line)


def table_lines(rows: list[list[str]]) -> list[str]:
    """Rows of cells, with columns as wide as their widest cell."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            size = max(map(width, cell.split("\n")))
            if i < len(widths):
                widths[i] = max(widths[i], size)
            else:
                widths.append(size)
    out = []
    for row in rows:
        cells = [cell.split("\n") for cell in row]
        for n in range(max(map(len, cells), default=0)):
            parts = [c[n] if n < len(c) else "" for c in cells]
            out.append("  ".join(p + " " * (widths[i] - width(p)) for i, p in enumerate(parts)).rstrip())
    return out


class Table:
    """Rows of cells; a cell that spans rows keeps its columns free below."""

    def __init__(self):
        self.rows: list[list[str]] = []
        self.taken: dict[int, int] = {}  # column -> further rows that it is taken for

    def row(self) -> None:
        self.rows.append([])
        self.free = dict(self.taken)  # of this row, from the rows above
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}

    def cell(self, text: str, columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        while len(row) in self.free:
            row.append("")
        if rows > 1:
            self.taken |= dict.fromkeys(range(len(row), len(row) + columns), rows - 1)
        row += [text, *[""] * (columns - 1)]


def render(root: Node) -> str:
    """The visible text of a tree. Steps wait on a stack, so depth does not matter."""
    out = Lines()
    outputs: list[Lines] = []  # of the tables and cells around the current place
    tables: list[Table] = []
    pre, shown = 0, True
    lists: list[list[int | None]] = []  # next number of each open list, None if unnumbered
    todo: list[tuple[str, object]] = [("open", root)]

    while todo:
        step, item = todo.pop()
        if step == "text":
            if shown:
                out.text(item, keep=pre > 0)
        elif step == "shown":
            shown = item
        elif step == "open":
            node = item
            if node.name and node.hidden():
                continue
            name, after = node.name, []
            if (said := node.visibility()) is not None and said != shown:
                after.append(("shown", shown))
                shown = said
            if name in ("br", "img"):
                if shown and name == "br":
                    out.end_line(force=True)
                elif shown:
                    out.text(node.values().get("alt", ""))
                todo += after
                continue
            if name == "table":
                out.block(True)
                tables.append(Table())
                after.append(("end table", None))
            elif name == "tr" and tables:
                tables[-1].row()
            elif name in CELLS and tables:
                outputs.append(out)
                out = Lines()
                after.append(("end cell", node))
            elif name in BLOCKS:
                nested = name in ("ul", "ol") and lists
                out.block(name in PARAGRAPHS and not nested)
                after.append(("block", name in PARAGRAPHS and not nested))
                if name in ("ul", "ol"):
                    lists.append([node.number("start", 1) if name == "ol" else None])
                    after.append(("end list", None))
                elif name == "li":
                    after.append(("indent", (out.prefix, out.marker)))
                    number = lists[-1][0] if lists else None
                    if number is not None:
                        number = node.number("value", number)
                        lists[-1][0] = number + 1
                    mark = "- " if number is None else f"{number}. "
                    out.marker = out.prefix + mark if shown else ""
                    out.prefix += " " * len(mark)
                elif name in ("blockquote", "dd"):
                    after.append(("indent", (out.prefix, "")))
                    out.prefix += "  "
                elif name == "pre":
                    pre += 1
                    after.append(("end pre", None))
            todo += after
            for child in reversed(node.children):
                todo.append(("text", child) if isinstance(child, str) else ("open", child))
        elif step == "block":
            out.block(item)
        elif step == "end list":
            lists.pop()
        elif step == "indent":
            out.end_line()
            out.prefix, out.marker = item[0], ""
        elif step == "end pre":
            out.end_line()
            pre -= 1
        elif step == "end cell":
            cell, out = out.result(), outputs.pop()
            tables[-1].cell(cell, *(max(1, min(item.number(n, 1), 1000)) for n in ("colspan", "rowspan")))
        elif step == "end table":
            for line in table_lines([r for r in tables.pop().rows if any(r)]):
                out.parts = [line]
                out.end_line()
            out.block(True)
    return out.result()


def visible_text(html: str) -> str:
    return render(tree(html))


def extractor(df: DataFrame):
    small_batches(df.sparkSession)

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([None if p is None else visible_text(p) for p in pages], dtype=object)

    return extract


def extract_text(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """All columns of `pages` and the visible text as one more column, named text if free."""
    return pages.withColumn(fresh(pages, "text"), extractor(pages)(F.col(html_column)))
