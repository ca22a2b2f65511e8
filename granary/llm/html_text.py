"""Visible text of web pages, laid out as a reader sees it.

A tree is built first: void elements take no children, raw text is read to its
end tag, and missing tags are implied (a paragraph ends where a block starts, an
item where the next one does, cells and rows likewise). The tree is then
rendered: hidden elements are left out, a select box shows its chosen option, white space collapses outside ``pre``,
blocks are set apart by blank lines, items get bullets or numbers with an indent
for each level, and a table's columns are aligned by padding. Visibility is
inherited, and a child may show itself again; of closed details the summary is seen.

Text and time stay in proportion to the page. Columns that no row fills are left
out, however far cells reach. A line longer than ``WIDE`` pushes what follows it to
the right and makes no other row wider. A table in which most places would stay
empty, as in one that is used for layout, is not aligned: its rows follow one
another, cells of one line side by side, others as blocks.

Each page is handled by itself in ``mapInArrow`` tasks: no shuffle, and memory
bounded by a lot of pages. Both passes use stacks of their own, so neither
depth nor length of a page is limited.

Defined cases: null or empty HTML gives an empty text; plain text comes back
with its white space collapsed; unclosed tags, quotes and comments end with the
page; repeated rows give the same text each; an empty table gives no rows;
columns other than id and HTML are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import in_lots

_TAG = re.compile(
    r"<!--(?:.*?--!?>|.*)|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*>?|<[A-Za-z][^>]*>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
_STYLE = re.compile(r"(?<![\w-])(display|visibility)\s*:\s*([\w-]+)", re.IGNORECASE)
_UNENDED = re.compile(r"<[A-Za-z/!?]")
_SPACES = re.compile(r"[ \t\n\f\r]+")

#: Elements of the HTML standard by the way they behave.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas datalist rp".split()
)
#: In drawings and formulas: what describes them, or is drawn only where it is referred to.
UNSEEN_IN = {
    "svg": frozenset("defs desc metadata symbol clippath mask pattern marker lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml".split()),
}
BLOCK = frozenset(
    "address article aside blockquote body center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split()
)
#: Blocks with a blank line before and after; other blocks start a new line.
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl pre blockquote table figure hr".split())
#: A start tag of the key ends open elements of the value, up to the nearest of the bounds.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
IMPLIED |= {"thead": IMPLIED["tbody"], "tfoot": IMPLIED["tbody"]}
SCOPE = frozenset("table td th caption html body button".split())


def attributes(source: str) -> dict[str, str]:
    """Values by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


class Node:
    """visible says whether the element's own style shows its text, hides it, or, if None, leaves that to what is around it."""

    __slots__ = ("tag", "shown", "start", "children", "attrs", "visible")

    def __init__(self, tag: str, shown: bool = True, start: int = 1, attrs: dict[str, str] | None = None, visible: bool | None = None) -> None:
        self.tag, self.shown, self.start, self.attrs, self.visible = tag, shown, start, attrs or {}, visible
        self.children: list[Node | str] = []

    def seen(self) -> list[Node | str]:
        """The children, of closed details the first summary alone."""
        if self.tag != "details" or "open" in self.attrs:
            return self.children
        return [c for c in self.children if isinstance(c, Node) and c.tag == "summary"][:1]


class _Open:
    """The stack of open elements, with the number of each tag so that a tag that is not open is not searched for."""

    def __init__(self, root: Node) -> None:
        self.stack, self.count = [root], Counter()

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.count[node.tag] += 1

    def cut(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.count[node.tag] -= 1
        del self.stack[depth:]

    def close(self, tags: set[str] | frozenset[str], bounds: set[str] | frozenset[str], lowest: bool = True) -> None:
        """Ends the lowest (or the highest) open element of tags above the nearest bound, and all above it."""
        if not any(self.count[t] > 0 for t in tags):
            return
        found = None
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[i].tag
            if tag in tags:
                found = i
                if not lowest:
                    break
            elif tag in bounds:
                break
        if found is not None:
            self.cut(found)


#: An end tag reaches beyond an open cell only for the parts of a table.
CELLS = frozenset("table td th".split())
PARTS = frozenset("table tr tbody thead tfoot".split())


def build_tree(html: str) -> Node:
    root = Node("html")
    open_ = _Open(root)
    at = 0

    def text(part: str) -> None:
        if part:
            open_.stack[-1].children.append(unescape(part) if "&" in part else part)

    last = html.rfind(">") + 1  # no tag ends beyond it
    while m := _TAG.search(html, at, last):
        text(html[at : m.start()])
        at = m.end()
        if not (name := m["name"]) or name.lower() in ("html", "body"):
            continue
        name = name.lower()
        if m["end"]:
            open_.close({name}, frozenset() if name in PARTS else CELLS, lowest=False)
            continue
        attrs = attributes(m["attrs"]) if m["attrs"] else {}
        if name in BLOCK:
            open_.close({"head"}, frozenset())
            open_.close({"p"}, SCOPE)
        if name in IMPLIED:
            open_.close(*IMPLIED[name])
        style = {k.lower(): v.lower() for k, v in _STYLE.findall(attrs.get("style", ""))}  # the last of a property counts
        shown = name not in UNSEEN and "hidden" not in attrs and style.get("display") != "none"
        shown = shown and (name != "dialog" or "open" in attrs)
        visible = {"visible": True, "hidden": False, "collapse": False}.get(style.get("visibility", ""))
        for outer, unseen in UNSEEN_IN.items():
            shown = shown and not (name in unseen and open_.count[outer] > 0)
        first = re.match(r"\s*(-?\d+)", attrs.get("start", "")) if name == "ol" else None
        node = Node(name, shown, int(first[1]) if first else 1, attrs, visible)
        if m["attrs"].endswith("/") and (open_.count["svg"] > 0 or open_.count["math"] > 0):
            open_.stack[-1].children.append(node)  # foreign elements may end themselves
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            if name == "textarea":
                content = html[at : end.start() if end else len(html)]
                node.children.append(unescape(content).replace("\r\n", "\n").removeprefix("\n"))
                open_.stack[-1].children.append(node)
            at = end.end() if end else len(html)
        elif name in VOID:
            open_.stack[-1].children.append(node)
        else:
            open_.push(node)
    text(_UNENDED.split(html[at:], maxsplit=1)[0])
    return root


def _chosen(select: Node) -> list[Node]:
    """The options that a browser shows: all of a list box, else the last selected one or the first that can be chosen."""
    options, work = [], [(c, False) for c in reversed(select.children)]
    while work:
        node, off = work.pop()
        if isinstance(node, str) or not node.shown:
            continue
        off = off or "disabled" in node.attrs
        if node.tag == "option":
            options.append((node, off))
        else:
            work += [(c, off) for c in reversed(node.children)]
    size = select.attrs.get("size", "").strip()
    if "multiple" in select.attrs or (size.isdecimal() and int(size) > 1):
        return [o for o, _ in options]
    selected = [o for o, _ in options if "selected" in o.attrs]
    return selected[-1:] or [o for o, off in options if not off][:1]


def _texts(node: Node) -> list[str]:
    """The texts below a node, in order."""
    out, work = [], [node]
    while work:
        part = work.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.shown:
            work += reversed(part.children)
    return out


class _Page:
    """Lines of one flow: the page itself or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line = ""
        self.gap = 0  # blank lines due before the next text
        self.mark = ""  # a bullet waiting for its text

    def add(self, text: str, indent: int) -> None:
        if not self.line:
            text = text.lstrip(" ")
            if not text:
                return
            if self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            self.line = " " * max(0, indent - len(self.mark)) + self.mark
            self.mark = ""
        elif self.line.endswith(" "):
            text = text.lstrip(" ")
        self.line += text

    def end(self, gap: int = 0) -> None:
        if self.line.strip():
            self.lines.append(self.line.rstrip(" "))
        self.line = ""
        self.gap = max(self.gap, gap)

    def block(self, lines: list[str], indent: int) -> None:
        self.end(1)
        if lines:
            self.lines += [""] * (self.gap if self.lines else 0) + [(" " * indent + x).rstrip() for x in lines]
            self.gap = 1

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def _reach(node: Node, name: str, most: int) -> int:
    """How many columns or rows a cell covers, within the standard's bound."""
    value = node.attrs.get(name, "").strip()
    return min(most, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 9 else 1


WIDE = 80  # characters of a line up to which it makes its column wider


def _placed(rows: list[list[tuple[str, int, int]]]) -> list[dict[int, list[str]]]:
    """For each row the lines of its cells that hold text, by column; a cell that reaches further is in its first one."""
    out: list[dict[int, list[str]]] = []
    hanging: list[tuple[int, int, int]] = []  # columns from one on to before another that are covered for so many rows more
    for row in rows:
        line: dict[int, list[str]] = {}
        later, at, column = [], 0, 0
        for text, wide, high in row:
            while at < len(hanging) and hanging[at][0] <= column:
                column = max(column, hanging[at][1])
                at += 1
            if text:
                line[column] = text.split("\n")
            if high > 1:
                later.append((column, column + wide, high))
            column += wide
        hanging = sorted((a, b, n - 1) for a, b, n in [*hanging, *later] if n > 1)
        if line:
            out.append(line)
    return out


def _set_out(rows: list[dict[int, list[str]]]) -> list[str]:
    """Rows of cells below one another, a cell's lines too, each column as wide as its widest line up to WIDE."""
    number = {c: k for k, c in enumerate(sorted(set().union(*rows)))} if rows else {}
    height = [max(map(len, row.values())) for row in rows]
    places = sum(n * (number[max(row)] + 1) for n, row in zip(height, rows, strict=True))
    if places > 4 * sum(len(lines) for row in rows for lines in row.values()):
        out = []
        for n, row in zip(height, rows, strict=True):
            cells = [row[c] for c in sorted(row)]
            out += [" | ".join(lines[0] for lines in cells)] if n == 1 else [x for lines in cells for x in lines]
        return out
    width = [0] * len(number)
    for row in rows:
        for c, lines in row.items():
            width[number[c]] = max(width[number[c]], max((len(x) for x in lines if len(x) <= WIDE), default=0))
    out = []
    for n, row in zip(height, rows, strict=True):
        own = {number[c]: lines for c, lines in row.items()}
        for k in range(n):
            parts = [(own[i][k] if i in own and k < len(own[i]) else "").ljust(width[i]) for i in range(max(own) + 1)]
            out.append(" | ".join(parts).rstrip())
    return out


def render(root: Node) -> str:
    pages, tables = [_Page()], []
    lists: list[list[int | None]] = [[]]  # for each flow, its open lists: the next number, or None for bullets
    pre = 0
    work: list[tuple[Node | str, bool, bool]] = [(root, False, True)]
    while work:
        node, leaving, visible = work.pop()
        page = pages[-1]
        indent = 2 * len(lists[-1])
        if isinstance(node, str):
            if not visible:
                continue
            if pre:
                first, *others = node.expandtabs(8).split("\n")
                page.line += first
                for x in others:
                    page.lines += [""] * (page.gap if page.lines and page.line else 0)
                    page.gap = 0
                    page.lines.append(page.line.rstrip())
                    page.line = x
            else:
                page.add(_SPACES.sub(" ", node), indent)
            continue
        tag = node.tag
        if not leaving:
            if not node.shown:
                continue
            if node.visible is not None:
                visible = node.visible
            if not visible and tag in ("br", "hr", "select", "textarea"):
                continue
            if tag == "br":
                if page.line:
                    page.end()
                else:
                    page.gap = max(page.gap, 1)
                continue
            if tag == "hr":
                page.end(1)
                continue
            if tag == "select":
                for k, option in enumerate(_chosen(node)):
                    if k:
                        page.add(" ", indent)
                    label = option.attrs.get("label")
                    texts = [label] if label else _texts(option)
                    page.add(_SPACES.sub(" ", "".join(texts)).strip(" "), indent)
                continue
            if tag == "textarea":
                for k, x in enumerate("".join(node.children).split("\n")):
                    if k:
                        page.end()
                    page.add(x, indent)
                continue
            if tag in BLOCK:
                page.end(1 if tag in APART and not (lists[-1] and tag in ("ul", "ol", "menu")) else 0)
            if tag in ("ul", "menu"):
                lists[-1].append(None)
            elif tag == "ol":
                lists[-1].append(node.start)
            elif tag == "li":
                own = lists[-1]
                if own and own[-1] is not None:
                    page.mark = f"{own[-1]}. " if visible else ""
                    own[-1] += 1
                else:
                    page.mark = "- " if visible else ""
            elif tag == "pre":
                pre += 1
                page.lines += [""] * (page.gap if page.lines else 0)
                page.gap = 0
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th", "caption") and tables:
                pages.append(_Page())
                lists.append([])
            work.append((node, True, visible))
            work.extend((c, False, visible) for c in reversed(node.seen()))
            continue
        if tag in ("ul", "ol", "menu"):
            page.end()
            lists[-1].pop()
            page.gap = max(page.gap, 0 if lists[-1] else 1)
        elif tag == "li":
            page.end()
            page.mark = ""
        elif tag == "pre":
            pre -= 1
            page.end(1)
        elif tag in ("td", "th", "caption") and tables:
            cell = pages.pop().text()
            lists.pop()
            if tag == "caption":
                pages[-1].block(cell.split("\n") if cell else [], 2 * len(lists[-1]))
            else:
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append((cell, _reach(node, "colspan", 1000), _reach(node, "rowspan", 65534)))
        elif tag == "table" and tables:
            page.block(_set_out(_placed(tables.pop())), indent)
        elif tag in BLOCK:
            page.end(1 if tag in APART else 0)
    return pages[0].text().strip("\n")


def visible_text(html: str | None) -> str:
    return render(build_tree(html)) if html else ""


def extract_text(pages: DataFrame, *, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """One row for each row of pages: the id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_lots(batches, 1, rows=1000, size=4_000_000):
            texts = pa.array([visible_text(h) for h in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], [id_column, "text"])

    kind = pages.schema[id_column].dataType.simpleString()
    return pages.select(F.col(id_column), F.col(html_column)).mapInArrow(run, f"`{id_column}` {kind}, text string")
