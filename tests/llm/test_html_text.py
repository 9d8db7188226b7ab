import time

import pytest
from conftest import SMALL

from ledgerline.llm import html_text as H

CASES = [
    ("<p>a<p>b<ul><li>x<li>y<ol start=3><li>1<li>2</ol></ul>tail", "a\n\nb\n\n- x\n- y\n  3. 1\n  4. 2\n\ntail"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"),
    ("<table><caption>C</caption><td colspan=2>wide<tr><td rowspan=2>r<td>1<tr><td>2</table>", "C\nwide\nr     1\n      2"),
    ("x<div hidden>no</div><span style='visibility:hidden'>h<b style='visibility:visible'>v</b></span><i style='DISPLAY : none'>n</i>", "xv"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"),
    ("<head><title>T</title></head><script>if(a<b)</script>t<style>p{}</style>&amp;&lt;&#233;", "t&<é"),
    ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<table>foster<tr><td>1</table>after", "foster\n\n1\n\nafter"),
    ("a < b and <3 c", "a < b and <3 c"),
    ("<details><summary>S</summary>hid</details><details open>seen</details>", "S\nseen"),
    ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
    ("<table><tr><td>one<br>two<td>x</table>", "one  x\ntwo"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"),
    ("<h1>H</h1>text<blockquote>q</blockquote>", "H\n\ntext\n\n  q"),
    ("<dl><dt>T<dd>D<dt>U<dd>E</dl>", "T\n  D\nU\n  E"),
    ("a <!-- b > --> c <!-- open", "a c"),
    ("<select><option>1<option>2</select>", "1\n2"),
    ("<p>one <b>two</p><p>three</b> four", "one two\n\nthree four"),
    ("<a title='x > y'>z</a>", "z"),
    ("", ""), ("   ", ""), ("plain\n text", "plain text"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_layout(html, text):
    assert H.page_text(html)[0] == text


def test_titles():
    assert H.page_text("<title> A &amp;\n B </title><p>x")[1] == "A & B" and H.page_text("x")[1] is None


@pytest.mark.parametrize("html", ["<a" * 200_000, "<a " * 100_000 + ">", "<div>" * 50_000 + "x", "<ul><li>" * 2000 + "x", "<a '" * 20_001 + ">z", "<table>" * 2000 + "x",
                                  "<td>" * 20_000, "</p>" * 20_000, "<p>" + "w " * 300_000,
                                  "<table><tr><td rowspan=65534 colspan=1000>x" + "<tr>" * 20_000, "<table><tr>" + "<td rowspan=65534 colspan=1000>x" * 2000 + "<tr><td>y" * 3000,
                                  "<table>" + "".join(f"<tr><td rowspan={65534 - i}>x" for i in range(3000))])
def test_odd_pages_end_soon(html):
    began = time.process_time()
    H.page_text(html)
    assert time.process_time() - began < 20


def test_every_visible_word_of_the_pages_is_there(spark):
    import re
    from html import unescape

    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title|head)\b.*?</\1>", " ", re.sub(r"(?s)<head>.*?</head>", " ", r["html"]))
        words = unescape(re.sub(r"<[^>]*>", " ", body)).split()
        got = "".join(H.page_text(r["html"])[0].split())
        at = 0
        for w in words:
            at = got.find(w, at)
            assert at >= 0, (r["page_id"], w)


def test_edge_rows(spark):
    rows = spark.createDataFrame([(1, None, "t"), (None, "", "t"), (2, "<p>x", None), (2, "<p>x", None), (3, "<b>" + "y" * 300_000, "t")], "page_id long, html string, text string")
    out = [(r["page_id"], r["text"] if r["text"] is None else len(r["text"]), r["n_lines"]) for r in H.extract(rows, ["page_id"]).collect()]
    assert out == [(1, None, None), (None, 0, 0), (2, 1, 1), (2, 1, 1), (3, 300_000, 1)]
    assert H.extract(rows.where("false"), ["page_id"]).collect() == []


@pytest.mark.parametrize("html, text", [
    ("<tr>hello", "hello"), ("<tbody><br>a<div>b</div>c", "a\nb\nc"), ("<thead><span>x</span> y", "x y"), ("<td>a</td><td>b</td>", "ab"),
    ("<table><tr><td>1</table><tr>late<td>row</tr>end", "1\n\nlaterowend"), ("<caption>c<tr><p>d", "c\n\nd"), ("<col>x<colgroup>y", "xy"),
])
def test_table_parts_outside_a_table_are_ignored_and_their_text_stays(html, text):
    assert H.page_text(html)[0] == text


def test_large_spans_take_little_memory():
    import tracemalloc

    tracemalloc.start()
    text, _ = H.page_text("<table><tr><td rowspan=65534 colspan=1000>x" + "<tr><td>y" * 2000 + "</table>")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000_000 and text.split("\n")[0] == "x" and text.count("   y") == 2000


# ---------------------------------------------------------------- a plain renderer over the same tree


class Grid:
    """A table as a matrix with every covered position marked."""

    def __init__(self):
        self.rows, self.head, self.taken, self.at = [], [], set(), 0

    def cell(self, lines, across, down):
        n = len(self.rows) - 1
        while (n, self.at) in self.taken:
            self.at += 1
        self.rows[-1][self.at] = lines
        self.taken |= {(r, k) for r in range(n + 1, n + down) for k in range(self.at, self.at + across)}
        self.at += across

    def lines(self):
        columns = sorted({c for r in self.rows for c, x in r.items() if any(x)})
        width = {c: max((len(x) if len(x) <= H.WIDE else 1 for r in self.rows for x in r.get(c, []) if x), default=0) for c in columns}
        out = list(self.head)
        for r in self.rows:
            for k in range(max((len(x) for x in r.values()), default=0)):
                out.append("  ".join((r[c][k] if k < len(r.get(c, [])) else "").ljust(width[c]) for c in columns).rstrip())
        return out


def plain(node, visible=True, pre=False, items=None, table=None):
    """Pieces of a node, by recursion: ("text", s), ("keep", s), ("br",), ("gap", n) and ("lines", lines, first, rest)."""
    if isinstance(node, str):
        return [("keep" if pre else "text", node)] if visible else []
    shown = True if node.tag == "#root" else H._shown(node, visible)
    if shown is None or node.tag == "wbr" or node.tag in H.VOID and node.tag not in ("br", "hr"):
        return []
    tag, number = node.tag, lambda k: int(node.attrs.get(k, 1))
    if tag == "br":
        return [("br",)]
    children = node.children
    if tag == "details" and "open" not in node.attrs:
        children = [c for c in children if not isinstance(c, str) and c.tag == "summary"][:1]
    pre = pre or tag in ("pre", "textarea", "listing", "xmp")
    inside = lambda its=items, t=table: [p for c in children for p in plain(c, shown, pre, its, t)]
    if tag in ("ul", "ol", "menu", "dir"):
        gap = ("gap", 0 if items is not None else 1)
        return [gap, *inside([number("start")] if tag == "ol" else [None]), gap]
    if tag == "li":
        mark = "- "
        if items is not None and items[0] is not None:
            n = int(node.attrs.get("value", items[0]))
            mark, items[0] = f"{n}. ", n + 1
        return [("gap", 0), ("lines", laid_out(inside(None if items is None else [None])), mark, " " * len(mark))]
    if tag in ("dd", "blockquote"):
        gap = ("gap", 1 if tag == "blockquote" else 0)
        return [gap, ("lines", laid_out(inside()), "  ", "  "), gap]
    if tag == "table":
        grid = Grid()
        around = inside(items, grid)  # what stands in the table, but in no cell, comes before it
        return [("gap", 1), *around, ("lines", grid.lines(), "", ""), ("gap", 1)]
    if tag == "tr" and table is not None:
        table.rows.append({})
        table.at = 0
        return inside()
    if tag in ("td", "th") and table is not None and table.rows:
        table.cell(laid_out(inside(None, None)), number("colspan"), number("rowspan"))
        return []
    if tag == "caption" and table is not None:
        table.head.extend(laid_out(inside(items, None)))
        return []
    gap = [("gap", 1)] if tag in H.SPACED else [("gap", 0)] if tag in H.BLOCKS else []
    return gap + inside() + gap


def laid_out(pieces):
    """Lines of a list of pieces: white space folded, empty lines between spaced blocks."""
    import re

    lines, now, owed, space = [], "", 0, False

    def close(force=False):
        nonlocal now, owed, space
        if now or force:
            if owed and lines:
                lines.extend([""] * owed)
            owed = 0
            lines.append(now.rstrip())
        now, space = "", False

    for p in pieces:
        if p[0] == "text":
            folded = re.sub(r"[ \t\n\r\f]+", " ", p[1])
            if folded.strip(" "):
                now += (" " if now and (space or folded[0] == " ") else "") + folded.strip(" ")
                space = folded[-1] == " "
            elif folded:
                space = space or bool(now)
        elif p[0] == "keep":
            for i, line in enumerate(p[1].replace("\r\n", "\n").replace("\r", "\n").split("\n")):
                if i:
                    close(True)
                if line:
                    now += (" " if now and space else "") + line
                    space = False
        elif p[0] == "br":
            close(True)
        elif p[0] == "gap":
            close()
            owed = max(owed, p[1])
        else:
            close()
            if p[1] or p[2].strip():
                if owed and lines:
                    lines.extend([""] * owed)
                owed = 0
                lines += [((p[2] if i == 0 else p[3]) + x).rstrip() for i, x in enumerate(p[1] or [""])]
    close()
    text = "\n".join(lines).split("\n") if lines else []
    while text and not text[-1]:
        text.pop()
    while text and not text[0]:
        text.pop(0)
    return text


def same(html):
    want = "\n".join(laid_out(plain(H.build_tree(html.replace("\0", "")))))
    assert H.page_text(html)[0] == want, html


def test_the_pages_equal_a_plain_recursive_renderer(spark):
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        same(r["html"] or "")


def test_random_markup_equals_the_plain_renderer():
    import random

    rng = random.Random(8)
    tags = "p div ul ol li table tr td th caption tbody blockquote pre b span dl dt dd h1 br hr details summary section".split()
    for _ in range(400):
        out = []
        for _ in range(rng.randrange(40)):
            kind = rng.random()
            if kind < 0.4:
                out.append(rng.choice(["one", " two ", "three\nfour", "  ", "x", "&amp; y", "long " * 5]))
            elif kind < 0.8:
                tag = rng.choice(tags)
                extra = rng.choice(["", "", " hidden", " style='visibility:hidden'", " start=7", " colspan=2", " rowspan=3", " colspan=3 rowspan=2", " open"])
                out.append(f"<{tag}{extra}>")
            else:
                out.append(f"</{rng.choice(tags)}>")
        same("".join(out))
