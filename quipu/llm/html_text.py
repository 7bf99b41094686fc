"""Layout-aware text of web pages.

A tree builder reads the tags, closing elements whose end tag is implied (paragraphs before
blocks, list items, table parts, options), at any depth.  Visibility rules leave out what a browser doesn't show: head, scripts, styles,
templates, ``hidden``, ``display:none``, ``visibility:hidden``, closed dialogs, comments, and what
drawings and formulas hold besides their text.  All other text is
rendered: white space collapses in inline text and stays in ``pre``; blocks start on new
lines, paragraphs, headings, lists and tables are set off by a blank line; list items get
their bullet or number and indentation; table cells are aligned in columns.

How it scales: one narrow pass, a page at a time.

Defined results: null html gives null text, an empty page empty text; null ids and repeated
rows are kept.  A column of a table is padded to ``PAD`` characters at most, so that one long
cell doesn't blow up all rows; longer cells are whole, but not aligned behind.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Generator, Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quipu.llm.common import cut_rows

PAD, SPAN = 60, 100
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript title iframe object canvas audio video datalist".split())
# hidden inside of these alone
WITHIN = {"math": frozenset("annotation annotation-xml".split()),
          "svg": frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split())}
BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table ul caption thead tbody tfoot tr td th""".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu".split())
PARTS = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
         "thead": {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
         "option": {"option"}, "optgroup": {"option", "optgroup"}}
PARTS |= {"tbody": PARTS["thead"], "tfoot": PARTS["thead"]}
# an implied end tag doesn't reach beyond these
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select", "datalist"}}
SPACE = re.compile(r"[ \t\n\r\f]+")
UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    @property
    def shown(self) -> bool:
        return not (self.tag in HIDDEN or "hidden" in self.attrs or UNSHOWN.search(self.attrs.get("style") or "")
                    or self.tag == "input" or self.tag == "dialog" and "open" not in self.attrs)


class TreeBuilder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("html", {})
        self.open = [self.root]
        self.n_open: Counter[str] = Counter()  # spares looking for what isn't open

    def _cut(self, i: int) -> None:
        self.n_open.subtract(e.tag for e in self.open[i:])
        del self.open[i:]

    def _close(self, tags: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        """Close up to the outermost open element of ``tags`` that no wall hides."""
        while any(self.n_open[t] for t in tags):
            i = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag in walls or self.open[i].tag in tags), 0)
            if not i or self.open[i].tag in walls:
                break
            self._cut(i)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag == "body":
            self._close({"head"}, set())
        elif self.open[-1].tag == "head" and tag not in {"title", "meta", "link", "script", "style", "base", "noscript", "template"}:
            self._close({"head"}, set())
        if tag in BLOCK:
            self._close({"p"}, {"td", "th", "table", "button", "caption", "object"})
        if tag in PARTS:
            self._close(PARTS[tag], WALLS.get(tag, {"table"}))
        element = Element(tag, dict(attrs))
        if any(tag in tags and self.n_open[outer] for outer, tags in WITHIN.items()):
            element.attrs["hidden"] = None
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)
            self.n_open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        walls = {"table"} if tag not in {"table", "body", "html"} else set()
        for i in range(len(self.open) - 1 if self.n_open[tag] else 0, 0, -1):
            if self.open[i].tag == tag:
                self._cut(i)
                return
            if self.open[i].tag in walls:
                return
        if tag == "p":
            self.open[-1].children.append(Element("p", {}))

    def handle_data(self, data: str) -> None:
        if self.open[-1].tag == "head" and data.strip():
            self._close({"head"}, set())
        self.open[-1].children.append(data)


class Lines:
    """Text laid out in lines."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.blank = False      # a blank line is due before the next text
        self.space = False      # a space is due before the next word

    def text(self, data: str) -> None:
        words = SPACE.sub(" ", data)
        if not words or words == " ":
            self.space |= bool(words)
            return
        if self.parts and (self.space or words[0] == " "):
            self.parts.append(" ")
        self.parts.append(words.strip(" "))
        self.space = words[-1] == " "

    def end_line(self) -> None:
        if self.parts:
            self._put("".join(self.parts))
            self.parts = []
        self.space = False

    def break_line(self) -> None:
        if self.parts:
            self.end_line()
        elif self.lines:
            self.blank = True

    def gap(self) -> None:
        self.end_line()
        self.blank = bool(self.lines)

    def _put(self, line: str) -> None:
        if self.blank:
            self.lines.append("")
            self.blank = False
        self.lines.append(line)

    def put_all(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._put(line)


def run(step: Generator) -> object:
    """The result of a step that yields the steps it needs, which nest to any depth."""
    stack, value = [step], None
    while stack:
        try:
            stack.append(stack[-1].send(value))
            value = None
        except StopIteration as end:
            stack.pop()
            value = end.value
    return value


def render(element: Element) -> Generator:
    """The lines of an element's visible text."""
    out = Lines()
    yield _flow(element, out)
    out.end_line()
    return out.lines


def _flow(element: Element, out: Lines) -> Generator:
    for child in element.children:
        if isinstance(child, str):
            out.text(child)
            continue
        if not child.shown:
            continue
        tag = child.tag
        if tag == "br":
            out.break_line()
            continue
        if tag not in BLOCK:
            if tag == "text":  # of a drawing: placed by itself
                out.space = True
            yield _flow(child, out)
            out.space |= tag == "text"
            continue
        out.gap() if tag in SPACED else out.end_line()
        if tag == "pre":
            out.put_all((yield _raw(child)).strip("\n").split("\n"))
        elif tag in ("ul", "ol", "menu"):
            out.put_all((yield _list(child)))
        elif tag == "table":
            out.put_all((yield _table(child)))
        elif tag in ("blockquote", "dd"):
            out.put_all(["  " + x if x else x for x in (yield render(child))])
        else:
            yield _flow(child, out)
        out.gap() if tag in SPACED else out.end_line()


def _raw(element: Element) -> Generator:
    parts: list[str] = []
    for c in element.children:
        if isinstance(c, str):
            parts.append(c)
        elif c.tag == "br":
            parts.append("\n")
        elif c.shown:
            parts.append((yield _raw(c)))
    return "".join(parts)


def _list(element: Element) -> Generator:
    lines: list[str] = []
    number = _number(element.attrs.get("start"), 1)
    loose = Element("li", {})
    for child in [*element.children, loose]:
        if isinstance(child, str) or child.tag != "li":
            loose.children.append(child)  # what stands outside of items
            continue
        if not child.shown:
            continue
        mark = f"{number}. " if element.tag == "ol" else "- "
        body = yield render(child)
        if child is loose:
            lines += body
            continue
        number += 1
        lines += [mark + body[0], *(" " * len(mark) + x if x else x for x in body[1:])] if body else [mark.rstrip()]
    return lines


def _number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?\d{1,9}", value.strip()) else default


def _table(element: Element) -> Generator:
    """Caption, then rows with their cells aligned; text outside of cells comes before."""
    rows: list[Element] = []
    loose = Element("div", {})

    def collect(parent: Element) -> None:
        for child in parent.children:
            if isinstance(child, str):
                loose.children.append(child)
            elif not child.shown:
                continue
            elif child.tag in ("thead", "tbody", "tfoot"):
                collect(child)
            elif child.tag == "tr":
                rows.append(child)
            elif child.tag in ("td", "th"):
                if not rows or rows[-1] is not implied[-1]:
                    implied.append(Element("tr", {}))
                    rows.append(implied[-1])
                rows[-1].children.append(child)
            else:
                loose.children.append(child)

    implied = [Element("tr", {})]
    collect(element)
    grid: list[list[tuple[int, int, list[str]]]] = []
    below: dict[int, int] = {}  # columns that a cell from above still fills, and for how many rows
    for row in rows:
        cells, column = [], 0
        taken, below = below, {c: n - 1 for c, n in below.items() if n > 1}
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                loose.children.append(cell)
                continue
            if not cell.shown:
                continue
            while column in taken:
                column += 1
            wide = max(1, min(SPAN, _number(cell.attrs.get("colspan"), 1)))
            cells.append((column, wide, (yield render(cell))))
            deep = _number(cell.attrs.get("rowspan"), 1)
            for c in range(column, column + wide):
                if deep > 1:
                    below[c] = deep - 1
            column += wide
        grid.append(cells)
    width: dict[int, int] = {}
    for cells in grid:
        for column, wide, lines in cells:
            if wide == 1:
                width[column] = max(width.get(column, 0), min(PAD, max(map(len, lines), default=0)))
    start, at = {}, 0
    for column in range(max((c + w for cells in grid for c, w, _ in cells), default=0) + 1):
        start[column] = at
        at += width.get(column, 0) + (2 if width.get(column) else 0)
    out = yield render(loose)
    for cells in grid:
        for i in range(max((len(lines) for *_, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(start[column])
                    line += ("  " if line and not line.endswith(" ") else "") + lines[i]
            out.append(line)
    return out


def page_text(html: str) -> str:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return "\n".join(line.rstrip() for line in run(render(builder.root)))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) for every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "html"):
            texts = [None if h is None else page_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string())], names=["page_id", "text"])

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).cast("string").alias("html"))
            .mapInArrow(run, "page_id long, text string"))
