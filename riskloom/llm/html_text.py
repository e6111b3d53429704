"""Visible text of HTML pages, laid out: blocks, lists and aligned table cells.

A tree builder puts the tags of a page into a tree, with the end tags that HTML implies (a
block ends an open paragraph, an item the item before it, a cell or row the open one), void
elements, and stray end tags ignored. An open head ends at the first tag or text that is no
head content; a cell outside of rows opens one. Rendering walks the tree and leaves out what a reader
does not see: head, scripts, styles, templates, comments, and elements that ``hidden`` or
an inline style hides. White space collapses outside ``pre``; blocks begin a line, and
paragraphs, headings, lists and tables are set apart by an empty line; items get ``- `` or
their number and are indented by level; cells of a table are padded to columns. A table
with a cell wider than ``WIDEST_CELL`` is a layout table, and its cells are blocks. What
stands in a table outside of rows comes before it; of svg its text elements are shown.

Defined cases: null and empty pages give an empty text; text beyond ``DEEPEST`` open
elements is kept in the last of them; malformed markup never fails, unclosed elements end
with the page; repeated rows get a row each; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEEPEST = 200
WIDEST_CELL = 60

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNSEEN = frozenset(
    "head title script style template noscript iframe object audio video canvas "
    "annotation annotation-xml datalist noembed noframes".split()
)
_SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset menu dir".split()
)
_BLOCK = _SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd "
    "details summary figcaption caption center legend option optgroup search hgroup".split()
)
_TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup".split())
_SECTIONS = frozenset("thead tbody tfoot".split())
# The open elements that may directly hold a part of a table.
_HOLDERS = dict.fromkeys(("thead", "tbody", "tfoot", "caption", "colgroup"), {"table"})
_HOLDERS["tr"] = {"table", *_SECTIONS}
_HOLDERS["td"] = _HOLDERS["th"] = {"table", "tr", *_SECTIONS}
# What an opening tag ends, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "thead": (_TABLE_PARTS, {"table"}),
    "tbody": (_TABLE_PARTS, {"table"}),
    "tfoot": (_TABLE_PARTS, {"table"}),
}
_HEAD_CONTENT = frozenset(
    "head title meta link style script base basefont bgsound noscript template noframes".split()
)
_KEEPS_PARAGRAPH = frozenset("button td th caption table html body".split())
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b")
_SPACE = re.compile(r"[ \t\n\r\f\v]+")


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag = tag
        self.attributes = attributes
        self.children: list[Node | str] = []

    @property
    def unseen(self) -> bool:
        if self.tag in _UNSEEN or "hidden" in self.attributes:
            return True
        style = self.attributes.get("style")
        return bool(style and _HIDING.search(style.lower()))


class TreeBuilder(HTMLParser):
    """The tree of a page; ``root`` holds it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def _end(self, tags, stops) -> None:
        """Close the innermost open element of ``tags``, and all in it, above ``stops``."""
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                del self.open[at:]
                if tags is _TABLE_PARTS or "tr" in tags:
                    self._end(tags, stops)
                return
            if self.open[at].tag in stops:
                return

    def _into_table(self, tag: str) -> None:
        """Go back to where the open table can hold ``tag``, and open a row for a cell."""
        if any(node.tag == "table" for node in self.open):
            while self.open[-1].tag not in _HOLDERS[tag]:
                self.open.pop()
            if tag in ("td", "th") and self.open[-1].tag != "tr" and len(self.open) < DEEPEST:
                row = Node("tr", {})
                self.open[-1].children.append(row)
                self.open.append(row)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _ENDS:
            self._end(*_ENDS[tag])
        elif tag in _BLOCK:
            self._end({"p"}, _KEEPS_PARAGRAPH)
        if self.open[-1].tag == "head" and tag not in _HEAD_CONTENT:
            self.open.pop()
        if tag == "body":
            self._end({"head"}, ())
        if tag in _HOLDERS:
            self._into_table(tag)
        node = Node(tag, dict(attrs))
        within = self.open[-1]
        within.children.append(node)
        if tag == "form" and (within.tag in _HOLDERS["td"]):
            return  # a form around rows holds nothing
        if tag not in _VOID and len(self.open) < DEEPEST:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in ("svg", "math") or any(node.tag in ("svg", "math") for node in self.open):
            self.open[-1].children.append(Node(tag, dict(attrs)))
        else:
            self.handle_starttag(tag, attrs)  # a closing slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        stops = {"table"} if tag not in ("table", "body", "html") else ()
        if tag in ("td", "th", "tr", "thead", "tbody", "tfoot"):
            stops = {"table"}
        elif tag not in _BLOCK:
            stops = {"td", "th", "table"}  # an inline end tag does not close a cell
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                del self.open[at:]
                return
            if self.open[at].tag in stops:
                return

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and _SPACE.sub("", data):
            self.open.pop()
        self.open[-1].children.append(data)


def tree(page: str) -> Node:
    builder = TreeBuilder()
    builder.feed(page)
    builder.close()
    return builder.root


class _Layout:
    """Lines of text with margins and prefixes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self._parts: list[str] = []
        self._margin = False
        self._prefixes: list[list[str]] = []  # for the next line, for lines after it

    def text(self, text: str) -> None:
        text = _SPACE.sub(" ", text)
        if text == " " and (not self._parts or self._parts[-1].endswith(" ")):
            return
        if text[:1] == " " and self._parts and self._parts[-1].endswith(" "):
            text = text[1:]
        if text:
            self._parts.append(text)

    def as_it_is(self, text: str) -> None:
        first, *rest = text.split("\n")
        self._parts.append(first)
        for line in rest:
            self._emit("".join(self._parts).rstrip(), True)
            self._parts = [line]

    def _emit(self, line: str, empty: bool) -> None:
        if line or empty:
            if self._margin and self.lines:
                self.lines.append("")
            self._margin = False
            prefix = ""
            for pair in self._prefixes:
                prefix += pair[0]
                pair[0] = pair[1]
            self.lines.append((prefix + line).rstrip())

    def end_line(self, pre: bool = False) -> None:
        line = "".join(self._parts)
        self._parts = []
        self._emit(line.rstrip() if pre else line.strip(" "), False)

    def line_break(self) -> None:
        if self._parts:
            self.end_line()
        elif self.lines and not self._margin:
            self._margin = True

    def apart(self) -> None:
        self.end_line()
        self._margin = bool(self.lines)

    def indented(self, first: str) -> None:
        self._prefixes.append([first, " " * len(first)])

    def outdented(self) -> None:
        self._prefixes.pop()


def _number(text: str | None, otherwise: int) -> int:
    try:
        return int(text or otherwise)
    except ValueError:
        return otherwise


def _children(node: Node, out: _Layout, pre: bool, level: int) -> None:
    number = _number(node.attributes.get("start"), 1) if node.tag == "ol" else None
    for child in node.children:
        if isinstance(child, str):
            if pre:
                out.as_it_is(child)
            else:
                out.text(child)
        elif not child.unseen:
            if child.tag == "li":
                marker = "- "
                if number is not None:
                    number = _number(child.attributes.get("value"), number)
                    marker = f"{number}. "
                    number += 1
                out.end_line()
                out.indented(marker)
                _children(child, out, pre, level)
                out.end_line()
                out.outdented()
            else:
                _element(child, out, pre, level)


def _element(node: Node, out: _Layout, pre: bool, level: int) -> None:
    tag = node.tag
    if tag == "br":
        if pre:
            out.as_it_is("\n")
        else:
            out.line_break()
    elif tag == "table":
        out.apart()
        _table(node, out, level)
        out.apart()
    elif tag == "svg":
        _drawn(node, out, pre, level)
    elif tag == "pre":
        out.apart()
        _children(node, out, True, level)
        out.end_line(pre=True)
        out.apart()
    elif tag in ("ul", "ol", "menu", "dir"):
        (out.end_line if level else out.apart)()
        if level:
            out.indented("  ")
        _children(node, out, pre, level + 1)
        out.end_line()
        if level:
            out.outdented()
        else:
            out.apart()
    elif tag == "dd":
        out.end_line()
        out.indented("  ")
        _children(node, out, pre, level)
        out.end_line()
        out.outdented()
    elif tag in _BLOCK:
        edge = out.apart if tag in _SPACED else out.end_line
        edge()
        _children(node, out, pre, level)
        edge()
    else:
        _children(node, out, pre, level)


def _drawn(node: Node, out: _Layout, pre: bool, level: int) -> None:
    """The text elements of a drawing, but not of what it only defines."""
    for child in node.children:
        if isinstance(child, Node) and not child.unseen and child.tag not in ("defs", "symbol"):
            if child.tag in ("text", "foreignobject"):
                out.text(" ")
                _children(child, out, pre, level)
                out.text(" ")
            else:
                _drawn(child, out, pre, level)


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, Node) and not child.unseen:
            if child.tag == "tr":
                yield child
            elif child.tag in _SECTIONS:
                yield from _rows(child)


def _cell(node: Node) -> list[str]:
    inner = _Layout()
    _children(node, inner, False, 0)
    inner.end_line()
    return inner.lines


def _outside_rows(node: Node, out: _Layout, level: int) -> None:
    """What stands in a table outside of rows: captions, stray text and elements."""
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
        elif child.unseen or child.tag == "tr":
            continue
        elif child.tag in _SECTIONS or child.tag == "colgroup":
            _outside_rows(child, out, level)
        else:
            _element(child, out, False, level)


def _table(node: Node, out: _Layout, level: int) -> None:
    _outside_rows(node, out, level)
    out.end_line()
    grid: list[list[tuple[list[str], int]]] = []
    for row in _rows(node):
        cells = []
        for child in row.children:
            if isinstance(child, str):
                out.text(child)
            elif not child.unseen:
                span = max(1, min(_number(child.attributes.get("colspan"), 1), 100))
                cells.append((_cell(child), span))
        grid.append(cells)
    out.end_line()
    widths: dict[int, int] = {}
    for cells in grid:
        at = 0
        for lines, span in cells:
            if span == 1:
                widths[at] = max(widths.get(at, 0), *map(len, lines), 0)
            at += span
    if any(len(line) > WIDEST_CELL for cells in grid for lines, _ in cells for line in lines):
        for cells in grid:
            for lines, _ in cells:
                for line in lines:
                    out.as_it_is(line)
                    out.end_line(pre=True)
        return
    for cells in grid:
        for i in range(max((len(lines) for lines, _ in cells), default=0)):
            line, at = "", 0
            for lines, span in cells:
                width = sum(widths.get(at + j, 0) + 2 for j in range(span))
                line += (lines[i] if i < len(lines) else "").ljust(width - 2) + "  "
                at += span
            out.as_it_is(line)
            out.end_line(pre=True)


def visible_text(page: str | None) -> str:
    """The text of a page as a reader sees it."""
    if not page:
        return ""
    out = _Layout()
    _children(tree(page), out, False, 0)
    out.end_line()
    return "\n".join(out.lines).strip("\n")


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [visible_text(page.as_py()) for page in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string())], names=["page_id", "text"]
        )


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, text`` of ``page_id, html``."""
    slim = pages.select(F.col("page_id").cast("bigint"), F.col("html").cast("string"))
    return slim.mapInArrow(_rendered, "page_id bigint, text string")
