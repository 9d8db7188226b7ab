"""Layout-aware text of HTML pages.

A tolerant tree builder (implied end tags of p, li, dt, dd, tr, td, th,
option and table sections; implied tr; void and raw-text elements; text that
stands directly in a table moves before it; tags of rows, cells, sections and
captions outside any table are ignored and their content stays; nesting beyond 512 levels is
flattened, as browsers do) is followed by a renderer that emits all visible
text: paragraphs, headings and similar blocks are set apart by an empty line,
other blocks begin a new line, ``br`` breaks one; list items carry a bullet or
their number and are indented by level; table cells are padded to their
column's width (column and row spans take their places; lines of more than
120 characters do not widen a column), cells with several
lines keep them; white space collapses except in ``pre`` and ``textarea``.

Invisible are elements that browsers do not render (script, style, template,
noscript, the head, media and embedded frames), closed ``dialog`` and
``details`` (but for its summary), the ``hidden`` attribute and the inline
styles ``display: none`` and ``visibility: hidden`` or ``collapse``; an inner
``visibility: visible`` shows again.

Defined cases: null html gives a null text, empty html an empty one; html
without tags is its own collapsed text; an unclosed tag at the end is text if
it is not a tag; repeated rows give equal texts; pages of any length are
rendered whole; an empty table gives an empty result; other columns are never
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import pieces_of

# fixed values: element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
UNRENDERED = frozenset("head title script style template noscript iframe noembed noframes datalist audio video canvas object param area "
                       "base link meta col colgroup source track input".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset menu dir listing".split())
BLOCKS = SPACED | frozenset("html body div section article aside header footer nav main address form li dt dd tr td th thead tbody tfoot caption "
                            "figcaption details summary legend center search hgroup dialog optgroup option".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                     "h6 header hgroup hr main menu nav ol p pre section search summary table ul li dt dd listing".split())
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
TABLE_PARTS = SECTIONS | frozenset("tr td th caption colgroup col".split())
MAX_DEPTH = 512
WIDE = 120  # longer lines of a cell stick out of their column instead of widening it for every row

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comment
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"  # CDATA, doctype, processing instruction
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"  # tag; quotes protect >
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",  # tag with an unbalanced quote
    re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*>?", re.I) for t in RAW}
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBLE = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\b", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.depth = parent.depth + 1 if parent is not None else 0


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        value = next((v for v in (m[2], m[3], m[4]) if v is not None), "")
        out.setdefault(m[1].lower(), unescape(value) if "&" in value else value)
    return out


class _Builder:
    """Open element stack as parent links; every new element first closes what it implies."""

    def __init__(self):
        self.root = self.at = Node("#root", {}, None)

    def inside(self, tags, stop=()) -> Node | None:
        """The nearest open element among ``tags``, looking no further than an element of ``stop``."""
        n = self.at
        while n.tag != "#root":
            if n.tag in tags:
                return n
            if n.tag in stop:
                return None
            n = n.parent
        return None

    def close(self, node: Node | None) -> None:
        if node is not None:
            self.at = node.parent

    def open(self, tag: str, attrs: dict) -> None:
        if tag in ("html", "body") and self.inside((tag,)):
            return
        if tag in TABLE_PARTS and self.inside(("table",)) is None:
            return
        if tag in CLOSES_P:
            self.close(self.inside(("p",), ("td", "th", "table", "caption", "button", "object")))
        if self.at.tag == "head" and tag not in ("title", "meta", "link", "base", "script", "style", "template", "noscript"):
            self.close(self.at)
        if tag == "li":
            self.close(self.inside(("li",), ("ul", "ol", "menu", "dir", "table", "td", "th")))
        elif tag in ("dt", "dd"):
            self.close(self.inside(("dt", "dd"), ("dl", "table", "td", "th")))
        elif tag in ("option", "optgroup"):
            self.close(self.inside(("option",), ("select", "datalist")))
            if tag == "optgroup":
                self.close(self.inside(("optgroup",), ("select",)))
        elif tag in ("td", "th"):
            self.close(self.inside(("td", "th"), ("tr", "table")))
            if self.inside(("tr",), ("table",)) is None and self.inside(("table",)):
                self.row_place()
                self.push("tr", {})
            else:
                self.up_to(("tr", "#root"))
        elif tag == "tr":
            self.close(self.inside(("tr",), ("table",)))
            self.row_place()
        elif tag in SECTIONS or tag in ("caption", "colgroup"):
            table = self.inside(("table",))
            if table is not None:
                self.at = table
        elif self.at.tag in ("table", "tr", *SECTIONS) and tag not in ("script", "style", "template", "col", "input", "form"):
            self.before_table(tag, attrs)
            return
        self.push(tag, attrs)

    def row_place(self) -> None:
        """Stand in the section or table that a row belongs to."""
        place = self.inside((*SECTIONS, "table"))
        if place is not None:
            self.at = place

    def up_to(self, tags) -> None:
        n = self.inside(tags, ("table",))
        if n is not None:
            self.at = n

    def push(self, tag: str, attrs: dict) -> None:
        node = Node(tag, attrs, self.at)
        self.at.children.append(node)
        if tag not in VOID and node.depth <= MAX_DEPTH:
            self.at = node

    def before_table(self, tag: str, attrs: dict) -> None:
        """An element that may not stand between cells goes before the table, and so does its content."""
        table = self.inside(("table",))
        node = Node(tag, attrs, table.parent)
        node.children = []
        place = table.parent.children
        place.insert(len(place) - 1 if place and place[-1] is table else len(place), node)
        if tag not in VOID:
            node.parent = self.at  # closing it returns to where it was opened
            self.at = node

    def text(self, s: str) -> None:
        if self.at.tag in ("table", "tr", *SECTIONS) and not s.isspace():
            table = self.inside(("table",))
            place = table.parent.children
            place.insert(len(place) - 1 if place and place[-1] is table else len(place), s)
        elif self.at.tag in ("head",) and not s.isspace():
            self.close(self.at)
            self.at.children.append(s)
        else:
            self.at.children.append(s)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.push("br", {})
        elif tag == "p" and self.inside(("p",), ("td", "th", "table", "caption")) is None:
            self.push("p", {})
            self.close(self.at)
        elif tag in ("table", "td", "th", "tr", "caption", *SECTIONS):
            self.close(self.inside((tag,), ("table",) if tag != "table" else ()))
        elif tag in ("html", "body"):
            return
        else:
            stop = ("td", "th", "table", "caption")
            if tag == "li":
                stop += ("ul", "ol")
            self.close(self.inside((tag,), stop if tag in BLOCKS else (*stop, *BLOCKS)))


def build_tree(html: str) -> Node:
    b, at, n = _Builder(), 0, len(html)
    last = html.rfind(">") + 1  # no tag ends behind it, so searching there again and again would find none
    while at < n:
        m = _TOKEN.search(html, at, last) if at < last else None
        if m is None:
            break
        if m.start() > at:
            b.text(unescape(html[at:m.start()]))
        at = m.end()
        name = m[2] or m[5]
        if m[0].startswith("<!--") and not m[0].endswith(("-->", "--!>", "<!-->", "<!--->")):
            at = n  # a comment without an end
        if name is None:
            if m[0].startswith("<![CDATA["):
                b.text(m[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m[1] or m[4]:
            b.end(tag)
            continue
        rest = m[3] if m[2] else m[6]
        b.open(tag, _attributes(rest) if rest and rest != "/" else {})
        if tag in RAW:
            done = _RAW_END[tag].search(html, at)
            stop = done.start() if done else n
            if tag in ("textarea", "title", "xmp"):
                b.at.children.append(html[at:stop] if tag == "xmp" else unescape(html[at:stop]))
            if b.at.tag == tag:
                b.close(b.at)
            at = done.end() if done else n
    rest = html[at:].split("<!--", 1)[0]
    if rest:
        b.text(unescape(rest))
    return b.root


class _Flow:
    """Lines of one block container. ``gap`` is the number of empty lines owed before the next text."""

    __slots__ = ("lines", "now", "gap", "space")

    def __init__(self):
        self.lines, self.now, self.gap, self.space = [], [], 0, False

    def text(self, s: str) -> None:
        parts = _SPACE.sub(" ", s)
        if not parts:
            return
        if parts == " ":
            self.space = self.space or bool(self.now)
            return
        if (parts[0] == " " or self.space) and self.now:
            self.now.append(" ")
        self.now.append(parts.strip(" "))
        self.space = parts[-1] == " "

    def keep(self, s: str) -> None:
        """Text whose white space stays."""
        lines = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        for i, line in enumerate(lines):
            if i:
                self.line(force=True)
            if line:
                if self.space and self.now:
                    self.now.append(" ")
                self.now.append(line)
                self.space = False

    def line(self, force: bool = False) -> None:
        if self.now or force:
            self._owed()
            self.lines.append("".join(self.now).rstrip())
        self.now, self.space = [], False

    def _owed(self) -> None:
        if self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0

    def block(self, gap: int = 0) -> None:
        self.line()
        self.gap = max(self.gap, gap)

    def put(self, lines: list[str], first: str = "", rest: str = "") -> None:
        """Finished lines as a block, with a prefix on the first and one on the others."""
        self.line()
        if lines or first.strip():
            self._owed()
            for i, x in enumerate(lines or [""]):
                self.lines.append(((first if i == 0 else rest) + x).rstrip())

    def done(self) -> list[str]:
        self.line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        skip = 0
        while skip < len(lines) and not lines[skip]:
            skip += 1
        return lines[skip:]


class _Table:
    """Cells by column. A span is one entry however many rows and columns it covers."""

    __slots__ = ("rows", "held", "caption", "at", "next")

    def __init__(self):
        self.rows, self.caption = [], []  # a row is a list of (column, lines)
        self.held = []  # columns taken by cells of rows above: [begin, end, first row that is free again], by begin
        self.at = self.next = 0  # the next column of the current row, and the next entry of ``held`` from there on

    def start_row(self) -> None:
        n = len(self.rows)
        self.rows.append([])
        merged: list[list[int]] = []
        for begin, end, until in self.held:
            if until <= n:
                continue
            if merged and merged[-1][1] == begin and merged[-1][2] == until:
                merged[-1][1] = end
            else:
                merged.append([begin, end, until])
        self.held, self.at, self.next = merged, 0, 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        held = self.held
        while self.next < len(held) and held[self.next][0] <= self.at:
            self.at = max(self.at, held[self.next][1])
            self.next += 1
        if lines:
            self.rows[-1].append((self.at, lines))
        if down > 1:
            held.insert(self.next, [self.at, self.at + across, len(self.rows) - 1 + down])
            self.next += 1
        self.at += across

    def lines(self) -> list[str]:
        width: dict[int, int] = {}
        for row in self.rows:
            for c, lines in row:
                width[c] = max(width.get(c, 0), max((len(x) if len(x) <= WIDE else 1 for x in lines if x), default=0))
        place, at = {}, 0  # where each column with text begins
        for c in sorted(c for c in width if width[c]):
            place[c] = at
            at += width[c] + 2
        out = list(self.caption)
        for row in self.rows:
            for k in range(max((len(x) for _, x in row), default=0)):
                line, end = [], 0  # ``end``: where the columns so far end, as if none were wider than its width
                for c, lines in row:
                    if k < len(lines) and lines[k]:
                        line.append(" " * (place[c] - end) + lines[k].ljust(width[c]))
                        end = place[c] + width[c]
                out.append("".join(line).rstrip())
        return out


def _number(value: str | None, default: int, most: int = 1000) -> int:
    try:
        return min(max(int(value), 1), most)
    except (TypeError, ValueError):
        return default


def _shown(node: Node, visible: bool) -> bool | None:
    """Whether the element's own text is visible; None if nothing below it is rendered."""
    attrs = node.attrs
    if node.tag in UNRENDERED or "hidden" in attrs or node.tag == "dialog" and "open" not in attrs:
        return None
    style = attrs.get("style")
    if style:
        if _DISPLAY.search(style):
            return None
        found = _VISIBLE.findall(style)
        if found:
            return found[-1].lower() == "visible"
    return visible


def render(root: Node) -> str:
    """The visible text of a tree. One explicit stack, so depth costs no recursion."""
    page = _Flow()
    # an entry: (node or text, flow, visible, pre, list state) or a function to run on the way out
    stack: list = [(c, page, True, False, None, None) for c in reversed(root.children)]
    while stack:
        entry = stack.pop()
        if callable(entry):
            entry()
            continue
        item, flow, visible, pre, items, table = entry
        if isinstance(item, str):
            if visible:
                (flow.keep if pre else flow.text)(item)
            continue
        shown = _shown(item, visible)
        if shown is None:
            continue
        tag, inner_flow, inner_items, inner_table = item.tag, flow, items, table
        children = item.children
        inner_pre = pre or tag in ("pre", "textarea", "listing", "xmp")
        if tag == "br":
            flow.line(force=True)
            continue
        if tag == "wbr" or tag in VOID and tag != "hr":
            continue
        if tag in ("ul", "ol", "menu", "dir"):
            inner_items = [_start(item) if tag == "ol" else None]
            gap = 0 if items is not None else 1
            flow.block(gap)
            stack.append(lambda f=flow, g=gap: f.block(g))
        elif tag == "li":
            inner_flow = _Flow()
            mark = "- "
            if items is not None and items[0] is not None:
                items[0] = _start(item, "value", items[0])
                mark, items[0] = f"{items[0]}. ", items[0] + 1
            stack.append(lambda f=flow, i=inner_flow, m=mark: f.put(i.done(), m, " " * len(m)))
            flow.block()
            inner_items = None if items is None else []
            inner_items = [None] if inner_items is not None else None
        elif tag in ("dd", "blockquote"):
            inner_flow = _Flow()
            gap = 1 if tag == "blockquote" else 0
            flow.block(gap)
            stack.append(lambda f=flow, i=inner_flow, g=gap: (f.put(i.done(), "  ", "  "), f.block(g)))
        elif tag == "table":
            inner_table = _Table()
            flow.block(1)
            stack.append(lambda f=flow, t=inner_table: (f.put(t.lines()), f.block(1)))
        elif tag == "tr" and table is not None:
            table.start_row()
        elif tag in ("td", "th") and table is not None and table.rows:
            inner_flow, across, down = _Flow(), _number(item.attrs.get("colspan"), 1), _number(item.attrs.get("rowspan"), 1, 65534)
            stack.append(lambda t=table, i=inner_flow, a=across, d=down: t.cell(i.done(), a, d))
            inner_table = None
            inner_items = None
        elif tag == "caption" and table is not None:
            inner_flow = _Flow()
            stack.append(lambda t=table, i=inner_flow: t.caption.extend(i.done()))
            inner_table = None
        elif tag in SPACED:
            flow.block(1)
            stack.append(lambda f=flow: f.block(1))
        elif tag in BLOCKS:
            flow.block()
            stack.append(flow.block)
        if tag == "details" and "open" not in item.attrs:
            children = [c for c in children if not isinstance(c, str) and c.tag == "summary"][:1]
        for c in reversed(children):
            stack.append((c, inner_flow, shown, inner_pre, inner_items, inner_table))
    return "\n".join(page.done())


def _start(node: Node, name: str = "start", default: int = 1) -> int:
    try:
        return int(node.attrs.get(name, default))
    except ValueError:
        return default


def title_of(root: Node) -> str | None:
    stack = [root]
    while stack:
        node = stack.pop()
        if node.tag == "title":
            return _SPACE.sub(" ", "".join(c for c in node.children if isinstance(c, str))).strip()
        if node.tag in ("#root", "html", "head"):
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return None


def page_text(html: str) -> tuple[str, str | None]:
    root = build_tree(html.replace("\0", ""))
    return render(root), title_of(root)


def extract(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The ``keep`` columns plus title, text and n_lines, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sources = whole.column(0).to_pylist()
            for a, b in pieces_of([len(s or "") for s in sources], 8_000_000):
                done = [(None, None) if s is None else page_text(s) for s in sources[a:b]]
                texts = [t for t, _ in done]
                lines = [None if t is None else t.count("\n") + 1 if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*whole.slice(a, b - a).columns[1:], pa.array([t for _, t in done], pa.string()), pa.array(texts, pa.string()), pa.array(lines, pa.int64())],
                    [*keep, "title", "text", "n_lines"])

    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return pages.select(F.col(html_col).cast("string").alias("__html"), *keep).mapInArrow(run, f"{fields}, title string, text string, n_lines long")
