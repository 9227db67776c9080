"""Layout-aware text of web pages.

A page is tokenised, built into a tree (with the tags that HTML implies: a paragraph ends where
a block begins, items, cells and rows end where the next begins, void elements have no
content), and rendered: all visible text in order, white space collapsed outside ``pre``, blank
lines around blocks, markers and indentation for lists, cells of a table padded to columns.

Not visible are ``head``, scripts, styles, templates, comments, elements with ``hidden`` or a
style of ``display:none`` or ``visibility:hidden``, hidden inputs, ``noscript`` (a renderer
runs scripts), ``datalist``, frames, what stands in ``video``, ``audio``, ``canvas`` and an
``object`` with ``data`` (a renderer shows these instead), titles, descriptions, definitions
and metadata of ``svg``, and annotations and phantoms of ``math``. Other text of ``svg`` and
``math`` is inline; labels, cells and the parts of a fraction or script are set apart by a
blank. Nothing recurses, so nesting may be as deep as the page is long; only the first ``LEVELS`` levels
of lists and quotes are indented, and a table whose aligned form would be more than ``SPREAD`` times as
long as what it holds (one very long cell among many rows) is written without padding, so the text of a
page grows in proportion to the page.

Defined results: a null, empty or text-free page gives an empty text; broken markup never
fails; repeated rows give repeated results; other columns are kept by :func:`render`, and a
column named like the output is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe noembed noframes video audio canvas datalist".split())
UNSEEN_FOREIGN = frozenset("title desc defs metadata annotation annotation-xml mphantom".split())   # in svg and math
#: Elements of svg and math around whose text, or around each of whose children, a blank stands.
APART = frozenset("text mtd".split())
PARTS_APART = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr".split())
WIDE = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset form article section header footer nav main aside address details hr menu".split())
LINE = frozenset("div li dt dd tr caption legend option summary figcaption center dir body html optgroup".split())
CLOSES_P = WIDE | frozenset("div dir center li dt dd summary".split())
#: A start tag ends the open element on the left of it, up to the borders on the right.
IMPLIED = {
    "li": (frozenset({"li"}), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset({"dl"})), "dd": (frozenset("dt dd".split()), frozenset({"dl"})),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset({"table"})),
    "td": (frozenset("td th caption".split()), frozenset("table tr".split())),
    "th": (frozenset("td th caption".split()), frozenset("table tr".split())),
    "option": (frozenset({"option"}), frozenset("select datalist optgroup".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset({"select"})),
}
for _t in ("thead", "tbody", "tfoot", "caption", "colgroup"):
    IMPLIED[_t] = (frozenset("thead tbody tfoot caption colgroup tr td th".split()), frozenset({"table"}))
_ENDS_CELLS = frozenset("table tr tbody thead tfoot td th html body".split())
_BORDERS = frozenset("table td th caption button object template html body".split())

LEVELS = 32
SPREAD, ROOM = 16, 4096
# nothing is given back once read, so a tag that does not close is read once
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?+)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?+)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S)
DECLARED = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?", re.S)   # all that can follow the last ">"
ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']*)))?""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)


class Node:
    __slots__ = ("tag", "attrs", "children", "foreign")

    def __init__(self, tag: str, attrs: str = "", foreign: bool = False):
        self.tag, self.attrs, self.children, self.foreign = tag, attrs, [], foreign

    def get(self, name: str) -> str | None:
        for m in ATTR.finditer(self.attrs):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None

    @property
    def hidden(self) -> bool:
        if self.tag in UNSEEN or self.foreign and self.tag in UNSEEN_FOREIGN:
            return True
        if not self.attrs:
            return False
        low = self.attrs.lower()
        if "hidden" in low and (self.get("hidden") is not None or self.tag == "input" and (self.get("type") or "").lower() == "hidden"):
            return True
        if self.tag == "object" and self.get("data"):
            return True
        return "style" in low and bool(_HIDES.search(self.get("style") or ""))


def build(page: str) -> Node:
    """The tree of a page; children are nodes and strings."""
    root = Node("#root")
    open_ = [root]
    where: dict[str, list[int]] = {}   # places of the open elements of each tag
    at, end, last = 0, len(page), page.rfind(">")

    def pop_to(i: int) -> None:
        while len(open_) > i:
            where[open_.pop().tag].pop()

    def say(text: str) -> None:
        if text:
            open_[-1].children.append(unescape(text) if "&" in text else text)

    def find(tags: frozenset, borders: frozenset) -> int:
        """Place of the outermost open element of the tags above the nearest border, 0 if none."""
        border = max((where[t][-1] for t in borders if where.get(t)), default=0)
        hit = 0
        for t in tags:
            open_here = where.get(t)
            if open_here and open_here[-1] > border:
                first = open_here[bisect_right(open_here, border)]
                hit = min(hit, first) if hit else first
        return hit

    while at < end:
        m = (TOKEN if at <= last else DECLARED).search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5]) if m.re is TOKEN else None
        if not name:
            if open_[-1].foreign and m[0].startswith("<![CDATA["):
                stop = page.find("]]>", m.start())
                open_[-1].children.append(page[m.start() + 9:stop if stop >= 0 else end])
                at = stop + 3 if stop >= 0 else end
            continue
        tag, closing, attrs = name.lower(), (m[1] or m[4]) == "/", (m[3] if m[2] else m[6]) or ""
        if closing:
            if tag == "br":
                open_[-1].children.append(Node("br"))
            elif where.get(tag):
                i = where[tag][-1]
                # what stands in a cell ends nothing outside of it
                if tag in _ENDS_CELLS or not any(where.get(t) and where[t][-1] > i for t in ("table", "td", "th")):
                    pop_to(i)
            continue
        if tag == "body" and where.get("head"):
            pop_to(where["head"][0])
        if tag in CLOSES_P and where.get("p"):
            i = find(frozenset({"p"}), _BORDERS)
            if i:
                pop_to(i)
        if tag in IMPLIED and any(where.get(t) for t in IMPLIED[tag][0]):
            i = find(*IMPLIED[tag])
            if i:
                pop_to(i)
        # HTML stands in a foreignObject
        node = Node(tag, attrs, tag in ("svg", "math") or open_[-1].foreign and open_[-1].tag != "foreignobject")
        open_[-1].children.append(node)
        if tag in VOID or attrs.endswith("/") and (node.foreign or tag == "path"):
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            body = page[at:stop.start() if stop else end]
            if body:
                node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = stop.end() if stop else end
            continue
        where.setdefault(tag, []).append(len(open_))
        open_.append(node)
    return root


class Flow:
    """Lines of text with collapsed white space, block gaps and list indentation."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indent: list[str] = []
        self.marker: str | None = None

    def write(self, text: str, pre: bool) -> None:
        if pre:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in more:
                self._end_line(True)
                self._put(line)
            return
        words = _BLANKS.split(text)
        if words[0] == "" and len(words) > 1:
            self.space = True
        for i, w in enumerate(words):
            if w:
                if i:
                    self.space = True
                self._put((" " if self.space and self.parts else "") + w)
                self.space = False
        if len(words) > 1 and words[-1] == "":
            self.space = True

    def _put(self, text: str) -> None:
        if text:
            if not self.parts:
                if self.gap and self.lines and self.lines[-1] != "":
                    self.lines += [""] * (self.gap - 1)
                self.gap = 0
                lead = "".join(self.indent[:LEVELS])
                if self.marker is not None:
                    lead = lead[:len(lead) - len(self.marker)] + self.marker
                    self.marker = None
                if lead:
                    self.parts.append(lead)
            self.parts.append(text)

    def _end_line(self, even_empty: bool = False) -> None:
        if self.parts or even_empty:
            self.lines.append("".join(self.parts).rstrip(" ") if not even_empty else "".join(self.parts))
            self.parts = []
        self.space = False

    def line(self, gap: int = 1) -> None:
        """End the line; the next text stands after ``gap - 1`` blank lines."""
        self._end_line()
        self.gap = max(self.gap, gap)

    def hard_break(self) -> None:
        if self.parts:
            self._end_line()
        elif self.lines and self.lines[-1] != "" and not self.gap > 1:
            self.lines.append("")

    def text(self) -> str:
        self._end_line()
        lines = self.lines
        a, b = 0, len(lines)
        while a < b and not lines[a].strip():
            a += 1
        while b > a and not lines[b - 1].strip():
            b -= 1
        return "\n".join(lines[a:b])


def _number(value: str | None, default: int, most: int = 1000) -> int:
    """A decimal attribute, at most ``most``."""
    m = re.match(r"\s*(-?[0-9]{1,9})", value or "")
    return min(int(m[1]), most) if m else default


def lay_out(rows: list[list[tuple[str, int]]]) -> list[str]:
    """Lines of a table: cells padded to their columns' widths; a wide cell spans columns.

    Where padding would make it far longer than its cells are, they are only set apart.
    """
    width: dict[int, int] = {}
    for row in rows:
        col = 0
        for text, span in row:
            if span == 1:
                width[col] = max(width.get(col, 0), *(len(x) for x in text.split("\n")))
            col += span
    before = [0]   # room of the columns up to each
    for c in range(max(width, default=-1) + 1):
        before.append(before[-1] + width.get(c, 0))

    def room_of(col: int, span: int) -> int:
        return before[min(col + span, len(before) - 1)] - before[min(col, len(before) - 1)] + 3 * (span - 1)

    padded = held = 0
    for row in rows:
        col = wide = 0
        for text, span in row:
            wide += max(room_of(col, span), 0) + 3
            col += span
            held += len(text) + 4
        padded += wide * max((text.count("\n") + 1 for text, _ in row), default=0)
    if padded > SPREAD * held + ROOM:
        return [x.rstrip() for row in rows for x in " | ".join(text for text, _ in row).split("\n")]
    out = []
    for row in rows:
        height = max((text.count("\n") + 1 for text, _ in row), default=0)
        lines = [""] * height
        col = 0
        for text, span in row:
            room = room_of(col, span)
            cell = text.split("\n") + [""] * height
            for i in range(height):
                lines[i] += (" | " if col else "") + cell[i].ljust(room)
            col += span
        out += [x.rstrip() for x in lines]
    return out


def visible_text(page: str | None) -> str:
    """All visible text of a page in its layout."""
    if not page:
        return ""
    flows = [Flow()]
    lists: list[list] = []           # [kind, next number]
    tables: list[list[list[tuple[str, int]]]] = []
    spans: list[int] = []
    pre = 0
    stack: list[tuple[Node | str, bool]] = [(build(page), False)]
    while stack:
        node, leaving = stack.pop()
        flow = flows[-1]
        if isinstance(node, str):
            flow.write(node, pre > 0)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and tables and spans and len(flows) > 1:
                cell = flows.pop()
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((cell.text(), spans.pop()))
            elif tag == "table":
                rows = [r for r in tables.pop() if any(t for t, _ in r)]
                for x in lay_out(rows):
                    flow.line()
                    flow.write(x, True)
                flow.line(2)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                flow.line(1 if lists else 2)
            elif tag == "li":
                flow.marker = None
                flow.indent.pop()
                flow.line()
            elif tag in ("dd", "blockquote"):
                flow.indent.pop()
                flow.line(1 if tag == "dd" else 2)
            elif tag == "pre":
                pre -= 1
                flow.line(2)
            elif tag in WIDE:
                flow.line(2)
            elif tag in LINE:
                flow.line()
            elif tag in ("select", "button"):
                flow.space = True
            continue
        if node.hidden:
            continue
        if tag == "br":
            flow.hard_break()
            continue
        if tag == "hr":
            flow.line(2)
            flow.write("---", True)
            flow.line(2)
            continue
        if tag == "wbr" or tag in VOID:
            if tag in ("img", "input", "embed"):
                flow.space = flow.space or bool(flow.parts)
            continue
        if tag == "table":
            flow.line(2)
            tables.append([])
        elif tag == "tr":
            if tables:
                tables[-1].append([])
            else:
                flow.line()
        elif tag in ("td", "th"):
            if tables:
                spans.append(max(1, _number(node.get("colspan"), 1)))
                flows.append(Flow())
            else:
                flow.space = True
        elif tag in ("ul", "ol", "menu", "dir"):
            flow.line(1 if lists else 2)
            lists.append([tag, _number(node.get("start"), 1, 10 ** 9) if tag == "ol" else 0])
        elif tag == "li":
            flow.line()
            marker = "- "
            if lists and lists[-1][0] == "ol":
                lists[-1][1] = _number(node.get("value"), lists[-1][1], 10 ** 9)
                marker = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            flow.indent.append(" " * len(marker))
            flow.marker = marker
        elif tag in ("dd", "blockquote"):
            flow.line(1 if tag == "dd" else 2)
            flow.indent.append("  " if tag == "dd" else "> ")
        elif tag == "pre":
            flow.line(2)
            pre += 1
        elif tag in WIDE:
            flow.line(2)
        elif tag in LINE:
            flow.line()
        stack.append((node, True))
        children = node.children
        if tag == "pre" and children and isinstance(children[0], str) and children[0].startswith("\n"):
            children = [children[0][1:], *children[1:]]
        if node.foreign and tag in APART:
            children = [" ", *children, " "]
        elif node.foreign and tag in PARTS_APART:
            children = [" ", *(x for c in children for x in (c, " "))]
        stack += [(c, False) for c in reversed(children)]
    return flows[0].text()


def render(pages: DataFrame, html: str = "html", output: str = "text") -> DataFrame:
    """Add the visible text of every page."""
    kept = [f for f in pages.schema.fields if f.name != output or f.name == html]
    schema = T.StructType([f for f in kept if f.name != output] + [T.StructField(output, T.StringType())])
    at = [f.name for f in kept].index(html)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                b = batch.slice(lo, 256)
                text = pa.array([visible_text(x) for x in b.column(at).to_pylist()], pa.string())
                cols = [b.column(i) for i, f in enumerate(kept) if f.name != output]
                yield pa.RecordBatch.from_arrays([*cols, text], schema.names)

    return pages.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)
