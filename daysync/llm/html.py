"""Visible text of HTML pages with its layout.

A tree builder turns a page into elements that open and close in order, with the tags that
HTML implies. The renderer follows them and writes what a reader sees: blocks apart from
each other, items under their lists' markers, cells of a table in columns. Both keep stacks
and never recurse, and every page is read from front to back, once, and again where what
stands later bears on what stands before (rules of ``<style>``, lists numbered backwards), so
depth and length of a page only cost time in proportion. The text of a table may be longer than the table, as cells
are filled up to the width of their column.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from daysync.llm.common import blocks, extended, ship

# Elements by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head script style template noscript title datalist iframe noembed noframes audio video canvas object rp".split())
CLOSE_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
BLOCK = CLOSE_P | frozenset("body html tr td th caption option legend thead tbody tfoot".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
# What a start tag closes when it is open, and what stops the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption"}, {"table"}),
    "body": ({"head"}, set()),
}
ROW_GROUPS = frozenset("thead tbody tfoot".split())
HEADINGS = frozenset(f"h{k}" for k in range(1, 7))
# Start tags that do not open the body; all others and text do, and end an open head.
BEFORE_BODY = frozenset("html head body base link meta title style script noscript template".split())

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)|[^>=]++)*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
_CSS_OPAQUE = re.compile(r"""/\*.*?(?:\*/|\Z)|"[^"]*+"?|'[^']*+'?|\((?:[^()"']|"[^"]*+"?|'[^']*+'?)*+\)?""", re.DOTALL)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_CSS_AT_RULE = re.compile(r"@[^{};]*+(?:;|\{(?:[^{}]++|\{[^{}]*+\}?)*+\}?|(?=\})|\Z)")
_CSS_SELECTOR = re.compile(r"(\*|[A-Za-z][\w-]*+)?(?:([.#])([\w-]++))?")
_SHOWN_BY = frozenset("display visibility content-visibility".split())
_VISIBILITY = {"visible": True, "initial": True, "hidden": False, "collapse": False}
_WHITE = re.compile(r"[ \t\n\r\f]+")

Event = tuple[str, str, dict[str, str]]


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    if text and not text.isspace():
        for m in _ATTRIBUTE.finditer(text):
            value = m[2] or ""
            if value[:1] in ("'", '"'):
                value = value[1:-1]
            out.setdefault(m[1].lower(), unescape(value))
    return out


def _declared(style: str) -> dict[str, tuple[bool, str]]:
    """Properties of a style with whether they are important, and values; the last counts, important ones before others.

    Comments, strings and what is in parentheses are left out of the values.
    """
    plain: dict[str, tuple[bool, str]] = {}
    important: dict[str, tuple[bool, str]] = {}
    for declaration in _CSS_OPAQUE.sub(" ", style.lower()).split(";"):
        name, _, value = declaration.partition(":")
        value, sign, _ = value.partition("!")
        (important if sign else plain)[name.strip()] = bool(sign), value.strip()
    return plain | important


class Rules:
    """What the page's own rules say of what is shown, by selector.

    Selectors are a tag, a class, an id, or a tag with one class or id; others, and rules inside
    ``@media`` and the like, do not count. An element is looked up by its tag, id and classes.
    """

    def __init__(self) -> None:
        self.found: dict[tuple[str, str, str], dict[str, tuple[tuple[bool, int, int], str]]] = {}
        self.order = 0

    def add(self, text: str) -> bool:
        """Takes what a style sheet says; whether there is anything."""
        before = self.order
        for rule in _CSS_AT_RULE.sub(" ", _CSS_COMMENT.sub(" ", text)).split("}"):
            selectors, _, body = rule.partition("{")
            said = {n: v for n, v in _declared(body).items() if n in _SHOWN_BY} if body else {}
            for selector in selectors.split(",") if said else ():
                m = _CSS_SELECTOR.fullmatch(selector.strip())
                if not m or not m[0]:
                    continue
                tag, kind, name = (m[1] or "*").lower(), m[2] or "", m[3] or ""
                weight = {"": 0, ".": 10, "#": 100}[kind] + (tag != "*")
                self.order += 1
                mine = self.found.setdefault((tag, kind, name), {})
                for prop, (sign, value) in said.items():
                    rank = sign, weight, self.order
                    if prop not in mine or mine[prop][0] < rank:
                        mine[prop] = rank, value
        return self.order > before

    def style(self, name: str, attributes: dict[str, str]) -> dict[str, str]:
        """The properties that hold for an element; those of its own style go before rules of equal importance."""
        best: dict[str, tuple[tuple[bool, int, int], str]] = {}
        if "style" in attributes:
            best = {p: ((sign, 1000, 0), value) for p, (sign, value) in _declared(attributes["style"]).items()}
        if self.found:
            marks = [("", ""), *((".", c) for c in attributes.get("class", "").split())]
            if "id" in attributes:
                marks.append(("#", attributes["id"]))
            for kind, mark in marks:
                for tag in ("*", name):
                    for prop, said in self.found.get((tag, kind, mark), {}).items():
                        if prop not in best or best[prop][0] < said[0]:
                            best[prop] = said
        return {prop: value for prop, (_, value) in best.items()}


def tokens(page: str) -> Iterator[Event]:
    """``(kind, name or text, attributes)`` with the kinds open, close and text.

    What follows a comment, tag or quoted value that never ends belongs to it.
    """
    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            mark = size
        if mark > at:
            yield "text", unescape(page[at:mark]), {}
        if mark == size:
            return
        following = page[mark + 1 : mark + 2]
        tag = _TAG.match(page, mark)
        if tag:
            name, at = tag[2].lower(), tag.end()
            if tag[1]:
                yield "close", name, {}
                continue
            yield "open", name, _attributes(tag[3])
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                stop = end.start() if end else size
                yield "text", page[at:stop] if name not in ("textarea", "title") else unescape(page[at:stop]), {}
                at = stop
        elif page.startswith("<!--", mark):
            # "<!-->" and "<!--->" end where they begin.
            end = re.compile(r"--!?>").search(page, mark + 2)
            at = end.end() if end else size
        elif following in ("!", "?") or page.startswith("</", mark):
            if page[mark + 2 : mark + 3].isalpha() and following == "/":
                return  # an end tag that never ends
            end = page.find(">", mark)
            at = end + 1 if end >= 0 else size
        elif following.isascii() and following.isalpha():
            return  # a start tag that never ends
        else:
            yield "text", "<", {}
            at = mark + 1


class TreeBuilder:
    """Elements that open and close properly nested, with implied tags."""

    def __init__(self) -> None:
        self.open: list[str] = []
        self.counts: dict[str, int] = {}

    def _pop(self) -> Event:
        name = self.open.pop()
        self.counts[name] -= 1
        return "close", name, {}

    def _push(self, name: str, attributes: dict[str, str]) -> Event:
        self.open.append(name)
        self.counts[name] = self.counts.get(name, 0) + 1
        return "open", name, attributes

    def _pop_through(self, names: set[str] | frozenset[str], stops: set[str]) -> Iterator[Event]:
        """Closes what is open down to the outermost of ``names`` inside the nearest stop."""
        if not any(self.counts.get(n) for n in names):
            return
        deepest = None
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] in names:
                deepest = k
            elif self.open[k] in stops:
                break
        if deepest is not None:
            while len(self.open) > deepest:
                yield self._pop()

    def events(self, given: Iterator[Event]) -> Iterator[Event]:
        for kind, name, attributes in given:
            if kind == "text":
                if name.strip(" \t\n\r\f"):
                    yield from self._enter_body()
                yield kind, name, attributes
            elif kind == "open":
                yield from self._start(name, attributes)
            else:
                yield from self._end(name)
        while self.open:
            yield self._pop()

    def _start(self, name: str, attributes: dict[str, str]) -> Iterator[Event]:
        if name in ("html", "body") and self.counts.get(name):
            return
        if name in ("html", "head") and self.counts.get("body") or name == "head" and name in self.counts:
            return
        if name not in BEFORE_BODY:
            yield from self._enter_body()
        if name in CLOSE_P and self.counts.get("p"):
            yield from self._pop_through({"p"}, {"table", "td", "th", "caption", "button", "object"})
        if name in HEADINGS and self.open and self.open[-1] in HEADINGS:
            yield self._pop()
        if name == "a" and self.counts.get("a"):
            yield from self._pop_inline("a")
        if name in CLOSES:
            yield from self._pop_through(*CLOSES[name])
        if self.counts.get("table"):
            if name == "tr" and self.open[-1] == "table":
                yield self._push("tbody", {})
            elif name in ("td", "th") and "tr" not in self._inside_table():
                if self.open[-1] == "table":
                    yield self._push("tbody", {})
                yield self._push("tr", {})
        yield self._push(name, attributes)
        if name in VOID:
            yield self._pop()

    def _enter_body(self) -> Iterator[Event]:
        """Opens the body unless it is open, and closes the head; what is inside a title or template does neither."""
        if self.counts.get("body") or (self.open and self.open[-1] not in ("html", "head")):
            return
        if self.open and self.open[-1] == "head":
            yield self._pop()
        yield self._push("body", {})

    def _inside_table(self) -> set[str]:
        out: set[str] = set()
        for name in reversed(self.open):
            if name == "table":
                break
            out.add(name)
            if name == "tr":
                break
        return out

    def _pop_inline(self, name: str) -> Iterator[Event]:
        """Closes an inline element if no block was opened in it."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] == name:
                while len(self.open) > k:
                    yield self._pop()
                return
            if self.open[k] in BLOCK:
                return

    def _end(self, name: str) -> Iterator[Event]:
        if name == "br":
            yield from self._enter_body()
            yield "open", "br", {}
            yield "close", "br", {}
        elif name in HEADINGS:
            yield from self._pop_to(HEADINGS)
        elif name in ("html", "body"):
            return  # what follows is still content
        elif name == "p" and not self.counts.get("p"):
            yield self._push("p", {})
            yield self._pop()
        elif self.counts.get(name):
            yield from self._pop_to({name})

    def _pop_to(self, names: set[str] | frozenset[str]) -> Iterator[Event]:
        """Closes the innermost of ``names``; cells and tables shield what is around them."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] in names:
                while len(self.open) > k:
                    yield self._pop()
                return
            if self.open[k] in ("table", "td", "th", "caption") and not names & {"table", "tr", "thead", "tbody", "tfoot", "caption"}:
                return


class Box:
    """Lines of a page or a cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the line being written
        self.space = False  # white space to write if more text follows
        self.verbatim = False  # the line has text that keeps its white space
        self.gap = 0  # blank lines due
        self.margins: list[str] = []
        self.marker = ""

    def write(self, text: str, keep: bool) -> None:
        if keep:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self.parts.append(first)
            self.verbatim = True
            for line in more:
                self.end_line(True)
                self.parts.append(line)
                self.verbatim = True
            return
        words = _WHITE.split(text)
        if len(words) == 1 and not words[0]:
            return
        if not words[0]:
            self.space = True
        inner = [w for w in words if w]
        if inner:
            if self.space and self.parts:
                self.parts.append(" ")
            self.parts.append(" ".join(inner))
            self.space = not words[-1]

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.parts)
        if not (keep or self.verbatim):
            line = line.strip(" ")
        self.parts, self.space, self.verbatim = [], False, False
        if line or keep:
            if self.lines:
                self.lines += [""] * self.gap
            margin = "".join(self.margins)
            if self.marker and margin:
                margin = margin[: -len(self.marker)] + self.marker
            self.lines.append((margin + line).rstrip())
            self.gap, self.marker = 0, ""

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def finish(self) -> list[str]:
        self.end_line()
        return self.lines


@dataclass
class Cell:
    """How many columns and rows a cell takes (0: all rows of its group that follow), and its lines."""

    columns: int
    rows: int
    lines: list[str]


@dataclass
class Grid:
    """Rows of a table and where its row groups begin or end; no cell reaches over that."""

    rows: list[list[Cell]] = field(default_factory=list)
    edges: list[int] = field(default_factory=list)

    def placed(self) -> Iterator[list[tuple[int, Cell]]]:
        """The cells of each row with their columns: the next that no cell of a row above still takes."""
        edges = sorted({*self.edges, len(self.rows)})
        above: list[tuple[int, int, int]] = []  # columns from, up to, and the row where they are free again
        for k, row in enumerate(self.rows):
            if not row:
                continue
            above = [x for x in above if x[2] > k]
            end = edges[bisect_left(edges, k + 1)]
            at, j, out, longer = 0, 0, [], []
            for cell in row:
                while j < len(above) and above[j][0] <= at:
                    at, j = max(at, above[j][1]), j + 1
                out.append((at, cell))
                if cell.rows != 1:
                    longer.append((at, at + cell.columns, min(k + cell.rows, end) if cell.rows else end))
                at += cell.columns
            if longer:
                above = sorted(above + longer)
            yield out

    def text(self) -> list[str]:
        """The lines of all rows; columns in which a cell begins start at the same place in each row.

        A column is as wide as its widest cell. What a cell over several columns needs beyond
        them widens the last of them.
        """
        rows = list(self.placed())
        columns = sorted({at for row in rows for at, _ in row})
        rank = {at: k for k, at in enumerate(columns)}
        widths = [0] * len(columns)
        wide: list[tuple[int, int, int]] = []
        for row in rows:
            for at, cell in row:
                need = max(map(_width, cell.lines), default=0)
                first, last = rank[at], bisect_left(columns, at + cell.columns) - 1
                if first == last:
                    widths[first] = max(widths[first], need)
                else:
                    wide.append((last, first, need))
        for last, first, need in sorted(wide):
            widths[last] += max(0, need - sum(widths[first : last + 1]) - 2 * (last - first))
        starts = [0]
        for width in widths:
            starts.append(starts[-1] + width + 2)
        out = []
        for row in rows:
            for k in range(max(len(cell.lines) for _, cell in row)):
                parts, size = [], 0
                for at, cell in row:
                    if k < len(cell.lines) and cell.lines[k]:
                        # Cells that a page lays over each other stay apart.
                        gap = max(starts[rank[at]] - size, 2 if size else 0)
                        parts += [" " * gap, cell.lines[k]]
                        size += gap + _width(cell.lines[k])
                out.append("".join(parts).rstrip())
        return out


class Renderer:
    """Writes events as text.

    Of a closed ``<details>`` its summary is shown. ``totals`` are the items of the page's lists in the
    order of their start tags, which lists numbered backwards start from.
    """

    def __init__(self, rules: Rules | None = None, totals: list[int] | None = None) -> None:
        self.rules = rules or Rules()
        self.totals = totals or []
        self.items: list[int] = []  # of each list so far
        self.folded = [""]  # of each open element, the child it still shows if it is closed, or "-" for none
        self.boxes = [Box()]
        self.unseen = 0  # open elements from the outermost one that is not shown
        self.visible = [True]  # of each open element, whether its own text is seen
        self.keep = 0  # open elements that keep white space
        self.lists: list[tuple[bool, int]] = []  # whether numbered, and its place in the lists below
        self.numbers: list[int] = []  # of each list, that of its next item
        self.steps: list[int] = []  # and what it grows by
        self.tables: list[Grid] = []

    def text(self) -> str:
        return "\n".join(self.boxes[0].finish())

    def feed(self, kind: str, name: str, attributes: dict[str, str]) -> None:
        if kind == "text":
            if not self.unseen and self.visible[-1] and not self.folded[-1]:
                self.boxes[-1].write(name, bool(self.keep))
        elif kind == "open":
            self._open(name, attributes)
        elif self.unseen:
            self.unseen -= 1
        else:
            self._close(name)

    def _open(self, name: str, attributes: dict[str, str]) -> None:
        style = {} if self.unseen else self.rules.style(name, attributes)
        if self.unseen or self.folded[-1] not in ("", name) or self._is_unseen(name, attributes, style):
            self.unseen += 1
            return
        if self.folded[-1]:
            self.folded[-1] = "-"
        self.folded.append("summary" if name == "details" and "open" not in attributes else "")
        visible = _VISIBILITY.get(style.get("visibility", ""), self.visible[-1])
        self.visible.append(visible)
        box = self.boxes[-1]
        if name == "br":
            box.end_line(visible)
        elif name == "hr":
            box.block(1)
        elif name == "input" and attributes.get("type", "").lower() in ("submit", "button", "reset"):
            if visible:
                box.write(attributes.get("value", ""), False)
        elif name in ("td", "th") and self.tables:
            self.boxes.append(Box())
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            spans = _span(attributes.get("colspan", ""), 1, 1000), _span(attributes.get("rowspan", ""), 0, 65534)
            self.tables[-1].rows[-1].append(Cell(*spans, self.boxes[-1].lines))
        elif name == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif name == "table":
            box.block(1)
            self.tables.append(Grid())
        elif name in BLOCK:
            nested = name in ("ul", "ol") and self.lists
            box.block(0 if nested else int(name in SPACED))
        if name in ROW_GROUPS and self.tables:
            self.tables[-1].edges.append(len(self.tables[-1].rows))
        if name in ("pre", "textarea"):
            self.keep += 1
        elif name in ("ul", "ol", "menu", "dir"):
            place, backwards = len(self.items), name == "ol" and "reversed" in attributes
            first = self.totals[place] if backwards and place < len(self.totals) else 1
            self.lists.append((name == "ol", place))
            self.items.append(0)
            self.numbers.append(_number(attributes.get("start", ""), first))
            self.steps.append(-1 if backwards else 1)
        elif name == "li":
            marker = "- "
            if self.lists:
                numbered, place = self.lists[-1]
                self.items[place] += 1
                if numbered:
                    number = _number(attributes.get("value", ""), self.numbers[place])
                    self.numbers[place] = number + self.steps[place]
                    marker = f"{number}. "
            box.margins.append(" " * len(marker))
            box.marker = marker if visible else ""
        elif name in ("dd", "blockquote"):
            box.margins.append("  ")

    def _is_unseen(self, name: str, attributes: dict[str, str], style: dict[str, str]) -> bool:
        """Whether nothing of an element is shown, whatever is inside it."""
        if name in HIDDEN or "hidden" in attributes or (name == "dialog" and "open" not in attributes):
            return True
        return style.get("display") == "none" or style.get("content-visibility") == "hidden"

    def _close(self, name: str) -> None:
        self.visible.pop()
        self.folded.pop()
        if name in VOID:
            if name == "hr":
                self.boxes[-1].block(1)
            return
        box = self.boxes[-1]
        if name in ("td", "th") and self.tables and len(self.boxes) > 1:
            box.finish()
            self.boxes.pop()
        elif name == "table" and self.tables:
            box.end_line()
            for line in self.tables.pop().text():
                box.parts = [line]
                box.end_line(True)
            box.block(1)
        elif name in BLOCK:
            nested = name in ("ul", "ol") and len(self.lists) > 1
            box.block(0 if nested else int(name in SPACED))
        if name in ROW_GROUPS and self.tables:
            self.tables[-1].edges.append(len(self.tables[-1].rows))
        if name in ("pre", "textarea"):
            self.keep -= 1
        elif name in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
        elif name in ("li", "dd", "blockquote"):
            box.margins.pop()
            box.marker = ""


def _number(text: str, default: int) -> int:
    return int(text) if re.fullmatch(r"\s*-?[0-9]{1,9}\s*", text) else default


def _width(text: str) -> int:
    """The columns a text takes: two for a wide sign, none for one that combines with another."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


def _span(text: str, least: int, most: int) -> int:
    return min(max(int(text), least), most) if re.fullmatch(r"\s*[0-9]{1,9}\s*", text) else 1


_REVERSED = re.compile("reversed", re.IGNORECASE)


def _events(page: str) -> Iterator[Event]:
    return TreeBuilder().events(tokens(page))


def _first(page: str) -> tuple[Renderer, bool]:
    """A renderer that went through the page, and whether rules came after what they may bear on.

    Rules of the head are known when the body begins; only ``html`` and ``head`` stand before them.
    """
    rules = Rules()
    renderer = Renderer(rules)
    before: list[Event] = []
    sheet = body = late = False
    for event in _events(page):
        kind, name, attributes = event
        if kind == "text" and sheet:
            late |= rules.add(name) and body
        sheet = kind == "open" and name == "style" and attributes.get("media", "").strip().lower() in ("", "all", "screen")
        if kind == "open" and not body:
            body = name == "body"
            if name in ("html", "head"):
                before.append(event)
        renderer.feed(*event)
    return renderer, late or bool(rules.found) and any(rules.style(name, attributes) for _, name, attributes in before)


def render(page: str | None) -> str:
    """The visible text of a page; empty for null."""
    page = (page or "").replace("\x00", "")
    renderer, again = _first(page)
    if again:
        renderer = _again(page, renderer.rules, [])
    if renderer.items and _REVERSED.search(page):
        renderer = _again(page, renderer.rules, renderer.items)
    return renderer.text().strip("\n")


def _again(page: str, rules: Rules, totals: list[int]) -> Renderer:
    renderer = Renderer(rules, totals)
    for event in _events(page):
        renderer.feed(*event)
    return renderer


def visible_text(pages: DataFrame, html_column: str = "html", text_column: str = "text") -> DataFrame:
    """``pages`` with the visible text of each.

    Null and empty pages have an empty text. Text without any tag is a page too. Repeated rows
    each give a row; other columns are kept, one named as the result is replaced. An empty
    table gives an empty result. Of a page's style sheets those inside it count, see ``Rules``.
    """
    ship(pages.sparkSession)
    if text_column != html_column:
        pages = pages.drop(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, html_column):
                texts = pa.array([render(p) for p in block.column(html_column).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*block.columns, texts], names=[*block.schema.names, text_column])

    return pages.mapInArrow(run, extended(pages, {text_column: "string"}))
