"""Visible text of HTML pages by layout-aware rendering.

A tree builder opens and closes implied elements; visibility rules drop what a browser would not
show, by attributes, own styles and simple rules of style sheets; the renderer keeps block spacing, list markers with their indents, preformatted text and tables
whose cells are aligned in columns. Parsing and rendering use explicit stacks, so nesting may be deep.
Cells that span rows keep their columns in the rows below; a cell outside any row opens one. Formulas and
drawings show their text, not their titles, descriptions, definitions and annotations. A ``details``
element without ``open`` shows its first summary only.

Defined cases: null and empty pages render as the empty string; unclosed tags, stray end tags, bad
attributes and unknown entities are taken as text or closed at the end of their parent; rows are never
merged; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator
from unicodedata import east_asian_width

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attesta.llm.common import map_batches, slices

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that end an open paragraph.
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements with a blank line before and after.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 menu ol p pre table ul".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas datalist param title area".split())
#: Not shown inside drawings and formulas.
HIDDEN_PARTS = frozenset("desc defs metadata symbol clippath mask annotation annotation-xml".split())
#: Start tags that close an open element of the second set, looked for up to the third.
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
#: End tags don't reach beyond these.
SCOPE = frozenset(("table", "td", "th", "caption", "html", "template", "object"))

# quotes count only where a value begins; an unquoted value ends at white space or the tag's end
_VALUE = r"""\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+)"""
_TAG = re.compile(rf"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+)>""")
_ATTR = re.compile(rf"""([^\s/>][^\s/>=]*+)(?:{_VALUE})?+""")
#: A selector that is a tag, .class, #id or tag.class.
_SELECTOR = re.compile(r"\s*([A-Za-z][A-Za-z0-9]*)?(?:([.#])([A-Za-z_][\w-]*))?\s*")
_HIDDEN_BOX = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(?:!\s*important\s*)?(?=;|$)", re.I)
_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!\s*important\s*)?(?=;|$)", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(source):
        value = m[2] or ""
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes): kinds are text, open, close."""
    at, n, foreign = 0, len(page), 0
    while at < n:
        start = page.find("<", at)
        if start < 0:
            yield "text", html.unescape(page[at:]), ""
            return
        if start > at:
            yield "text", html.unescape(page[at:start]), ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = n if end < 0 else end + 3
        elif foreign and page.startswith("<![CDATA[", start):
            end = page.find("]]>", start + 9)
            yield "text", page[start + 9 : n if end < 0 else end], ""
            at = n if end < 0 else end + 3
        elif page[start + 1 : start + 2] in ("!", "?"):
            end = page.find(">", start)
            at = n if end < 0 else end + 1
        elif m := _TAG.match(page, start):
            name, at = m[2].lower(), m.end()
            if name in ("svg", "math"):
                foreign = max(0, foreign + (-1 if m[1] else not m[3].rstrip().endswith("/")))
            if m[1]:
                yield "close", name, ""
                continue
            yield "open", name, m[3]
            if name == "plaintext":
                yield "text", page[at:], ""
                return
            if name in RAW:
                end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
                body = page[at : end.start() if end else n]
                if name in ("textarea", "title"):
                    body = html.unescape(body)
                yield "text", body, ""
                at = end.start() if end else n
                if not end:
                    yield "close", name, ""
        elif page.find(">", start) < 0 and page[start + 1 : start + 2].isalpha():
            return  # a tag that the page's end cuts
        else:
            yield "text", "<", ""
            at = start + 1


def build(page: str) -> Node:
    """The tree of a page; the root is html, with head and body where the page implies them."""
    root = Node("html", {})
    body: Node | None = None
    stack = [root]
    # where the open elements of each tag stand on the stack, so that no search walks it
    places: dict[str, list[int]] = {"html": [0]}

    def put(node: Node) -> None:
        places.setdefault(node.tag, []).append(len(stack))
        stack.append(node)

    def pop() -> None:
        places[stack.pop().tag].pop()

    def is_open(tag: str) -> bool:
        return bool(places.get(tag))

    def innermost(tags: set[str] | frozenset[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=-1)

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        put(node)

    def to_body() -> None:
        nonlocal body
        while len(stack) > 1:
            pop()
        if body is None:
            body = Node("body", {})
            push(body)
        else:
            put(body)

    def end_up_to(tags: set[str], barrier: set[str] | frozenset[str]) -> None:
        """Pops up to and with the outermost open element of ``tags`` above the barrier."""
        floor = innermost(barrier)
        above = [held[k] for t in tags if (held := places.get(t)) and (k := bisect_right(held, floor)) < len(held)]
        last = min(above, default=None)
        while last is not None and last > 0 and len(stack) > last:
            pop()

    head_tags = {"base", "link", "meta", "title", "style", "script", "template", "noscript"}
    for kind, name, attrs in _tokens(page):
        top = stack[-1]
        if kind == "text":
            if len(stack) == 1 or top.tag == "head":
                if not name.strip():
                    continue
                to_body()
            stack[-1].children.append(name)
        elif kind == "open":
            if name == "html":
                continue
            if name == "head":
                if body is None and len(stack) == 1:
                    push(Node("head", {}))
                continue
            if name == "body":
                if body is None:
                    while len(stack) > 1:
                        pop()
                    body = Node("body", _attributes(attrs))
                    push(body)
                continue
            if len(stack) == 1 or (top.tag == "head" and name not in head_tags):
                if not (len(stack) == 1 and body is None and name in head_tags):
                    to_body()
            if name in BLOCK and is_open("p"):
                end_up_to({"p"}, SCOPE)
            if name in IMPLIED_END:
                end_up_to(*IMPLIED_END[name])
            if name in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
                push(Node("tr", {}))
            node = Node(name, _attributes(attrs))
            if name in VOID:
                stack[-1].children.append(node)
            else:
                push(node)
        elif name == "br":
            stack[-1].children.append(Node("br", {}))
        elif name == "p" and not is_open("p"):
            stack[-1].children.append(Node("p", {}))
        elif is_open(name) and name not in ("html", "body"):
            k = places[name][-1]
            if name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th") and innermost(SCOPE) > k:
                k = 0
            while k > 0 and len(stack) > k:
                pop()
    return root


class Styles:
    """Rules of a page's style sheets that show or hide, by simple selectors; what stands inside at-rules counts, too."""

    def __init__(self, sheets: list[str]) -> None:
        self.rules: dict[tuple[str, str, str], tuple[bool, bool | None]] = {}
        for sheet in sheets:
            for part in _COMMENT.sub(" ", sheet).split("}"):
                selectors, brace, body = part.rpartition("{")
                if not brace:
                    continue
                selectors = selectors.rpartition("{")[2]
                shown = _declared(body)
                if shown == (True, None) and "display" not in body:
                    continue
                for one in selectors.rsplit(";", 1)[-1].split(","):
                    m = _SELECTOR.fullmatch(one)
                    if m and (m[1] or m[2]):
                        key = ((m[1] or "").lower(), m[2] or "", m[3] or "")
                        before = self.rules.get(key, (True, None))
                        self.rules[key] = (shown[0] if "display" in body else before[0], before[1] if shown[1] is None else shown[1])

    def of(self, node: Node) -> tuple[bool, bool | None]:
        """Whether the element makes a box, and whether its text is seen; None where nothing says so. Ids go before classes, classes before tags, its own style before all."""
        box, seen = True, None
        if self.rules:
            tag, named = node.tag, [("", "")]
            named += [(".", c) for c in node.attrs.get("class", "").split()]
            if "id" in node.attrs:
                named.append(("#", node.attrs["id"]))
            for kind, name in named:
                for t in ("", tag):
                    if (rule := self.rules.get((t, kind, name))) is not None:
                        box, seen = rule[0], seen if rule[1] is None else rule[1]
        if "style" in node.attrs:
            own = _COMMENT.sub(" ", node.attrs["style"])
            declared = _declared(own)
            box = declared[0] and (box or "display" in own)
            seen = seen if declared[1] is None else declared[1]
        return box, seen


def _declared(body: str) -> tuple[bool, bool | None]:
    box = not _NONE.search(body)
    seen = None
    for m in _HIDDEN_BOX.finditer(body):
        seen = m[1].lower() == "visible"
    return box, seen


def _sheets(root: Node) -> list[str]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "style":
            out.append("".join(c for c in node.children if isinstance(c, str)))
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def visible(node: Node) -> bool:
    return not (node.tag in HIDDEN or node.tag in HIDDEN_PARTS or "hidden" in node.attrs or (node.tag == "dialog" and "open" not in node.attrs))


def shown_children(node: Node) -> list:
    """The children that the element shows: of closed details, the first summary."""
    if node.tag == "details" and "open" not in node.attrs:
        return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
    return node.children


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(2 if east_asian_width(c) in "WF" else 1 for c in s)


class _Writer:
    """Lines of output; white space collapses, requested line ends merge."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # line ends due before the next text
        self.space = False
        self.indents: list[str] = []
        self.marker: str | None = None

    def block(self, ends: int) -> None:
        self.gap = max(self.gap, ends)
        self.space = False

    def newline(self) -> None:
        self._start()
        self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.space = [], False

    def _start(self) -> None:
        """Settles due line ends and begins the line with its indent."""
        if self.gap and self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        if self.gap > 1 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap = 0
        if not self.line:
            if self.marker is not None:
                outer = "".join(self.indents[:-1])
                self.line = [outer + self.marker]
                self.marker = None
            elif self.indents:
                self.line = ["".join(self.indents)]
            self.space = False

    def text(self, s: str) -> None:
        words = _SPACE.sub(" ", s)
        if not words or words == " ":
            self.space = self.space or bool(words and self.line and not self.gap)
            return
        begins = not self.line or self.gap > 0
        self._start()
        lead = words[0] == " "
        if not begins and (self.space or lead):
            self.line.append(" ")
        self.space = words[-1] == " "
        self.line.append(words.strip(" ").replace("\xa0", " "))

    def raw(self, s: str) -> None:
        parts = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        for k, part in enumerate(parts):
            if k:
                self.newline()
            if part:
                self._start()
                self.line.append(part)

    def done(self) -> str:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        return "\n".join(self.lines).strip("\n")


#: A row that no table has.
_NEVER = 1 << 60


class _Table:
    def __init__(self) -> None:
        #: Rows of (text, columns, rows) as they come.
        self.given: list[list[tuple[str, int, int]]] = []

    def open_row(self) -> None:
        self.given.append([])

    def add(self, cell: str, columns: int, rows: int) -> None:
        if not self.given:
            self.open_row()
        self.given[-1].append((cell, columns, rows))

    def placed(self) -> list[list[tuple[str, int, int]]]:
        """Rows of (text, first column, columns); columns that a cell above spans are left free.

        Spanned columns are kept as stretches (first, end, last row); neighbours that end in the same row are one, and none goes
        beyond the table, so a stack of long spans stays one stretch.
        """
        out: list[list[tuple[str, int, int]]] = []
        busy: list[tuple[int, int, int]] = []
        due: list[tuple[int, int, int]] = []
        first_end = _NEVER
        for now, cells in enumerate(self.given):
            if due or first_end < now:
                merged: list[tuple[int, int, int]] = []
                for a, b, last in sorted(x for x in [*busy, *due] if x[2] >= now):
                    if merged and merged[-1][1] >= a and merged[-1][2] == last:
                        merged[-1] = (merged[-1][0], max(b, merged[-1][1]), last)
                    else:
                        merged.append((a, b, last))
                busy, due = merged, []
                first_end = min((x[2] for x in busy), default=_NEVER)
            row: list[tuple[str, int, int]] = []
            at = k = 0
            for cell, columns, rows in cells:
                while k < len(busy) and busy[k][0] <= at:
                    at, k = max(at, busy[k][1]), k + 1
                row.append((cell, at, columns))
                last = min(now + rows, len(self.given)) - 1
                if last > now:
                    due.append((at, at + columns, last))
                at += columns
            out.append(row)
        return out

    def render(self) -> str:
        """Cells in columns, each as wide as its widest line; a spanning cell starts at its first column."""
        placed = self.placed()
        widths: dict[int, int] = {}
        for row in placed:
            for k, (cell, at, span) in enumerate(row):
                if span == 1 and k < len(row) - 1:
                    widths[at] = max(widths.get(at, 0), *map(_width, cell.split("\n")))
                elif span == 1:
                    widths.setdefault(at, 0)
        # a column that no cell has to itself takes no room
        starts, room = {}, 0
        for c in sorted({at for row in placed for _, at, _ in row}):
            starts[c] = room
            room += widths[c] + 2 if c in widths else 0
        out = []
        for row in placed:
            cells = [(cell.split("\n"), at) for cell, at, _ in row]
            for k in range(max((len(c) for c, _ in cells), default=0)):
                line, wide = "", 0
                for n, (cell, at) in enumerate(cells):
                    part = cell[k] if k < len(cell) else ""
                    gap = starts[at] - wide
                    if n and gap < 2:  # the cell before is wider than its columns
                        gap = 2
                    line += " " * gap + part
                    wide += gap + _width(part)
                out.append(line.rstrip(" "))
        return "\n".join(out)


def _number(value: str | None, default: int) -> int:
    return int(value) if value and re.fullmatch(r"-?[0-9]{1,6}", value.strip()) else default


def render(page: str | None) -> str:
    """All visible text of a page."""
    if not page:
        return ""
    writers, tables = [_Writer()], []
    lists: list[list] = []  # [ordered, next number, step]
    pre = 0
    root = build(page)
    styles = Styles(_sheets(root))
    seen = [True]  # of the open elements: whether text is seen
    stack: list[tuple[object, bool]] = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        out = writers[-1]
        if isinstance(node, str):
            if not seen[-1]:
                continue
            if pre:
                out.raw(node)
            elif not (tables and tables[-1][1] is None):
                out.text(node)
            elif node.strip():  # text between rows of a table stands before it
                tables[-1][2].text(node)
            continue
        tag = node.tag
        if not leaving:
            box, shows = styles.of(node) if styles.rules or "style" in node.attrs else (True, None)
            if not box or not visible(node):
                continue
            shows = seen[-1] if shows is None else shows
            if tag == "br":
                out.newline()
                continue
            if tag in VOID:
                if tag == "hr":
                    out.block(1)
                elif tag == "input" and shows and node.attrs.get("type", "").lower() in ("submit", "button", "reset") and node.attrs.get("value"):
                    out.text(node.attrs["value"])
                elif tag == "wbr":
                    continue
                continue
            if tag in SPACED:
                out.block(1 if lists and tag in ("ul", "ol", "menu") else 2)
            elif tag in BLOCK:
                out.block(1)
            if tag in ("ul", "ol", "menu"):
                back = tag == "ol" and "reversed" in node.attrs
                first = sum(isinstance(c, Node) and c.tag == "li" for c in node.children) if back else 1
                lists.append([tag == "ol", _number(node.attrs.get("start"), first), -1 if back else 1])
            elif tag == "li":
                kind = lists[-1] if lists else [False, 1, 1]
                kind[1] = _number(node.attrs.get("value"), kind[1])
                mark = f"{kind[1]}. " if kind[0] else "- "
                kind[1] += kind[2]
                out.marker = mark if shows else None
                out.indents.append(" " * len(mark))
            elif tag in ("dd", "blockquote"):
                out.indents.append("    ")
            elif tag in ("pre", "textarea"):
                pre += 1
            elif tag == "table":
                tables.append([_Table(), None, _Writer()])
            elif tag == "tr" and tables and tables[-1][1] is None:
                tables[-1][0].open_row()
            elif tag in ("td", "th", "caption") and tables:
                tables[-1][1] = node
                writers.append(_Writer())
            seen.append(shows)
            stack.append((node, True))
            stack += [(c, False) for c in reversed(shown_children(node))]
        else:
            seen.pop()
            if tag in ("td", "th", "caption") and tables:
                cell = writers.pop().done()
                tables[-1][1] = None
                if tag == "caption":
                    tables[-1][2].raw(cell)
                else:
                    tables[-1][0].add(cell, max(1, min(1000, _number(node.attrs.get("colspan"), 1))), max(1, min(65534, _number(node.attrs.get("rowspan"), 1))))
                continue
            if tag == "table":
                made, _, stray = tables.pop()
                before = stray.done()
                for part in (before, made.render()):
                    if part:
                        out.block(2 if part is not before else 1)
                        out.raw(part)
            elif tag in ("ul", "ol", "menu"):
                lists.pop()
            elif tag == "li":
                if out.marker is not None and out.marker.strip() != "-":
                    out._start()
                out.marker = None
                out.indents.pop()
            elif tag in ("dd", "blockquote"):
                out.indents.pop()
            elif tag in ("pre", "textarea"):
                pre -= 1
            if tag in SPACED:
                out.block(1 if lists and tag in ("ul", "ol", "menu") else 2)
            elif tag in BLOCK:
                out.block(1)
    return writers[0].done()


def visible_text(pages: DataFrame, key: str = "page_id", source: str = "html") -> DataFrame:
    """(key, text) for each row of ``pages``; narrow, no shuffle."""
    schema = T.StructType([T.StructField("key", pages.schema[key].dataType), T.StructField("text", T.StringType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(render, batch.column(1).to_pylist()), pa.string())], names=["key", "text"])

    return map_batches(pages.select(F.col(key).alias("key"), F.col(source)), run, schema).withColumnRenamed("key", key)
