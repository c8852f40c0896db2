"""Layout-aware text of web pages.

A tree builder closes elements whose end tags may be left out and drops what a browser
doesn't show; a renderer walks the tree and writes all visible text with the spacing
that blocks have, bullets and numbers of lists, and columns of tables aligned.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content isn't shown.
UNSHOWN = frozenset(
    "head script style template noscript title iframe object canvas audio video datalist".split()
)
#: Elements that may stand in the head; any other ends it.
OF_HEAD = frozenset("html head base basefont bgsound link meta title noscript noframes style script template".split())
#: Elements of drawings and formulas that aren't shown, and those that hold HTML.
UNSHOWN_OF = {
    "svg": frozenset(
        "defs desc metadata symbol clippath mask pattern marker filter lineargradient radialgradient".split()
    ),
    "math": frozenset(("annotation", "annotation-xml", "mphantom")),
}
HOLDS_HTML = {"svg": ("foreignobject", "desc", "title"), "math": ("mi", "mo", "mn", "ms", "mtext")}
#: Elements of HTML that end a drawing or formula they stand in.
ENDS_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Elements of formulas whose parts stand apart.
PARTS = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr".split())
#: Blocks with an empty line before and after, and blocks with a line break only.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr".split())
BROKEN = frozenset(
    "html body div section article header footer main nav aside address form details summary figcaption legend "
    "li dt dd tr caption thead tbody tfoot center option optgroup td th".split()
)
BLOCKS = SPACED | BROKEN
ROW_GROUPS = ("thead", "tbody", "tfoot")
#: An opening tag closes open elements of these names, up to one of the scope.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th", "caption"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "body": ("head",),
    "option": ("option",),
    "optgroup": ("option", "optgroup"),
    "input": ("select",),
    "textarea": ("select",),
    **{group: (*ROW_GROUPS, "tr", "td", "th", "caption") for group in ROW_GROUPS},
}
SCOPE = {
    "li": ("ul", "ol", "menu"),
    "dt": ("dl",),
    "dd": ("dl",),
    "tr": ("table",),
    "td": ("table", "tr"),
    "th": ("table", "tr"),
    "option": ("select", "datalist"),
    "optgroup": ("select", "datalist"),
    "input": ("table",),
    "textarea": ("table",),
    **{group: ("table",) for group in ROW_GROUPS},
}
#: End tags that close elements outside the nearest table.
OUTER = ("table", "tr", "td", "th", "html", "body", *ROW_GROUPS)
HIDING = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "kind", "holds")

    def __init__(self, tag: str, attrs: dict[str, str], within: str = ""):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        #: "svg", "text" (text of an svg), "math", or nothing for HTML, and that of what it holds
        self.kind = tag if tag in ("svg", "math") else "text" if (within, tag) == ("svg", "text") else within
        self.holds = "" if tag in HOLDS_HTML.get(self.kind.replace("text", "svg"), ()) else self.kind


class TreeBuilder(HTMLParser):
    """The tree of the visible part of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.open = [self.root]
        self.unshown = 0  # depth in a subtree that isn't shown
        self.begun = False  # something has come that may not stand in the head

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_FOREIGN:
            self._end_foreign()
        within = self.open[-1].holds
        if not within:
            if tag not in OF_HEAD:
                self._end_head()
            elif tag == "head" and (self.begun or self.open[-1].tag not in ("#root", "html")):
                return
            if tag in BLOCKS and tag not in ("option", "optgroup"):
                self._close_to("p", ("button", "td", "th", "table", "li", "caption"))
            if tag == "select" and self._in_select():
                self._close_to("select", ("table",))
                return
            self._imply(tag)
        named = {k: v or "" for k, v in attrs}
        hidden = (
            tag in UNSHOWN or "hidden" in named or HIDING.search(named.get("style", "")) is not None
            or (tag == "input" and named.get("type", "").lower() == "hidden")
        )
        if within:
            hidden |= tag in UNSHOWN_OF[within.replace("text", "svg")] or named.get("display", "").strip() == "none"
            hidden |= named.get("visibility", "").strip() in ("hidden", "collapse")
        elif tag == "option" and self._in_select():
            hidden = False  # a hidden option is shown while it is selected
        if tag in VOID:
            if not hidden and not self.unshown and tag in ("br", "hr", "wbr"):
                self.open[-1].children.append(Node(tag, named))
            return
        node = Node(tag, named, within)
        if hidden or self.unshown:
            self.unshown += 1
        else:
            self.open[-1].children.append(node)
        self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        depth, last = len(self.open), self.open[-1]
        self.handle_starttag(tag, attrs)
        # a slash doesn't close an element of HTML
        if self.open[-1] is not last and self.open[-1].kind and tag not in VOID and len(self.open) > depth:
            self._pop()

    def handle_endtag(self, tag: str) -> None:
        if self.open[-1].tag == "head" and tag not in ("head", "body", "html", "br"):
            return
        if tag == "p":
            self._end_foreign()
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag == "p" and not any(n.tag == "p" for n in self.open):
            self.handle_starttag("p", [])
            self._pop()
        elif tag not in VOID:
            self._close_to(tag, () if tag in OUTER else ("table",))

    def handle_data(self, data: str) -> None:
        within = self.open[-1].holds
        if not within and self.open[-1].tag in ("#root", "html", "head") and data.strip(" \t\n\r\f"):
            self._end_head()
        if not self.unshown and within != "svg" and not (within == "math" and data.isspace()):
            self.open[-1].children.append(data)

    def unknown_decl(self, data: str) -> None:
        if data.startswith("CDATA[") and self.open[-1].holds:
            self.handle_data(data[6:])

    def _end_head(self) -> None:
        """What comes next may not stand in the head."""
        if self.open[-1].tag == "head":
            self._pop()
        if self.open[-1].tag in ("#root", "html"):
            self.begun = True

    def _end_foreign(self) -> None:
        while self.open[-1].holds:
            self._pop()

    def _in_select(self) -> bool:
        for node in reversed(self.open):
            if node.tag in ("select", "table"):
                return node.tag == "select"
        return False

    def _imply(self, tag: str) -> None:
        names, scope = CLOSES.get(tag, ()), SCOPE.get(tag, ())
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in scope:
                break
            if self.open[i].tag in names:
                while len(self.open) > i:
                    self._pop()

    def _close_to(self, tag: str, scope: tuple[str, ...]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i].tag in scope:
                return

    def _pop(self) -> None:
        self.open.pop()
        self.unshown = max(0, self.unshown - 1)


class Page:
    """Lines of a page, or of a table cell, that grow by words and breaks."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0  # empty lines that are due before the next text
        self.indents: list[str] = []
        self.marker = ""

    def text(self, data: str) -> None:
        for i, word in enumerate(BLANK.split(data)):
            self.space |= i > 0 and bool(self.line)
            if word:
                self._start()
                self.line.append(" " + word if self.space else word)
                self.space = False

    def verbatim(self, data: str) -> None:
        for i, part in enumerate(data.split("\n")):
            if i:
                self._start()
                self.end_line()
            if part:
                self._start()
                self.line.append(part)

    def _start(self) -> None:
        if not self.line:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            before = [*self.indents[:-1], self.marker] if self.marker else self.indents
            self.line.append("".join(before))
            self.marker, self.space = "", False

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.lines:
            self.gap = max(self.gap, 1)

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.lines)


def content(node: Node) -> str:
    """All text below a node, blanks as one space."""
    parts, stack = [], [node]
    while stack:
        below = stack.pop()
        if isinstance(below, str):
            parts.append(below)
        else:
            stack += reversed(below.children)
    return " ".join(word for word in BLANK.split("".join(parts)) if word)


def shown_options(select: Node) -> list[str]:
    """What a choice shows: all options as a list, else the selected one, or the first
    that can be chosen."""
    options: list[Node] = []
    labels: list[tuple[str, bool]] = []
    stack = [(child, False) for child in reversed(select.children)]
    while stack:
        node, off = stack.pop()
        if isinstance(node, str):
            continue
        if node.tag == "option":
            options.append(node)
            hidden = "hidden" in node.attrs or HIDING.search(node.attrs.get("style", "")) is not None
            labels.append((node.attrs.get("label") or content(node), off or "disabled" in node.attrs))
            if hidden:
                labels[-1] = (labels[-1][0], True)
                node.attrs["hidden"] = ""
            continue
        if node.tag == "optgroup" and node.attrs.get("label"):
            group = Node("group", {})
            options.append(group)
            labels.append((node.attrs["label"], True))
        off = off or (node.tag == "optgroup" and "disabled" in node.attrs)
        stack += [(child, off) for child in reversed(node.children)]
    size = select.attrs.get("size", "")
    if "multiple" in select.attrs or (size.isdigit() and int(size) > 1):
        return [label for option, (label, _) in zip(options, labels) if "hidden" not in option.attrs]
    chosen = [label for option, (label, _) in zip(options, labels) if "selected" in option.attrs]
    free = [label for label, off in labels if not off]
    return chosen[-1:] or free[:1]


def render(root: Node) -> str:
    """The text of a tree, walked with a stack of own, as pages may nest deeply."""
    page = Page()
    lists: list[list] = []  # kind and next number
    pre = 0
    cells: list[dict] = []  # open tables: rows, pages to go back to
    stack: list[tuple[Node | str, bool]] = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        if isinstance(node, str):
            page.verbatim(node) if pre else page.text(node)
            continue
        tag = node.tag
        if tag == "br":
            page._start()
            page.end_line()
            continue
        if tag == "hr":
            page.block(True)
            page.text("---")
            page.block(True)
            continue
        if tag == "select" and not node.kind:
            # a box of its own, in which a list has lines
            shown = shown_options(node)
            for i, label in enumerate(shown):
                page.text(f" {label} ")
                if i < len(shown) - 1:
                    page.end_line()
            continue
        apart = (node.kind == "text" and (tag == "text" or not node.attrs.keys().isdisjoint(("x", "y", "dy"))))
        if apart:
            page.text(" \n ")
        if not leaving:
            stack.append((node, True))
            for child in reversed(node.children):
                stack.append((child, False))
                if tag in PARTS and node.kind == "math":
                    stack.append((" ", False))
            if tag == "table":
                page.block(not cells)
                cells.append({"rows": [], "page": page, "stack": []})
            elif tag == "tr" and cells:
                cells[-1]["rows"].append([])
            elif tag in ("td", "th") and cells:
                if not cells[-1]["rows"]:
                    cells[-1]["rows"].append([])
                cells[-1]["stack"].append((page, pre, lists))
                page, pre, lists = Page(), 0, []
            elif tag in BLOCKS:
                page.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag == "pre":
                pre += 1
            elif tag in ("ul", "ol", "menu"):
                first = node.attrs.get("start", "1")
                lists.append([tag, int(first) if first.lstrip("-").isdigit() and len(first) < 10 else 1])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1]
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                page.indents.append(" " * len(mark))
                page.marker = mark
            elif tag in ("blockquote", "dd"):
                page.indents.append("> " if tag == "blockquote" else "    ")
            elif tag == "q":
                page.text('"')
            continue
        if tag == "table":
            table = cells.pop()
            page = table["page"]
            for line in aligned(table["rows"]):
                page.verbatim(line)
                page.end_line()
            page.block(not cells)
        elif tag in ("td", "th") and cells and cells[-1]["stack"]:
            span = node.attrs.get("colspan", "1")
            width = min(int(span), 100) if span.isdigit() and len(span) < 5 else 1
            cells[-1]["rows"][-1].append((page.result(), max(1, width)))
            page, pre, lists = cells[-1]["stack"].pop()
        elif tag in BLOCKS:
            page.block(tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
        if tag == "pre":
            pre = max(0, pre - 1)
        elif tag in ("ul", "ol", "menu") and lists:
            lists.pop()
        elif tag in ("li", "blockquote", "dd") and page.indents:
            page.indents.pop()
            page.marker = ""
        elif tag == "q":
            page.text('"')
    return page.result()


def width_of(text: str) -> int:
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in text)


def aligned(rows: list[list[tuple[str, int]]]) -> Iterator[str]:
    """Lines of a table with columns two spaces apart.  A cell over several columns
    doesn't widen them; a cell of several lines takes several lines."""
    rows = [row for row in rows if any(text for text, _ in row)]
    widths: list[int] = []
    for row in rows:
        at = 0
        for text, span in row:
            widths += [0] * (at + span - len(widths))
            if span == 1:
                widths[at] = max([widths[at], *map(width_of, text.split("\n"))])
            at += span
    for row in rows:
        split = [text.split("\n") for text, _ in row]
        for i in range(max(map(len, split), default=0)):
            line, at = "", 0
            for (_, span), parts in zip(row, split):
                part = parts[i] if i < len(parts) else ""
                room = sum(widths[at : at + span]) + 2 * (span - 1)
                line += part + " " * (room - width_of(part) + 2 if room >= width_of(part) else 2)
                at += span
            yield line.rstrip()


def visible_text(html: str) -> str:
    """All visible text of a page."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return render(builder.root)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without ``column`` but with ``text``, its visible text; a NULL page has
    a NULL text, an empty one an empty text.  A column ``text`` of ``pages`` is left out."""
    names = [c for c in pages.columns if c not in (column, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(batch.num_columns - 1).to_pylist()
            texts = [None if html is None else visible_text(html) for html in given]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string())], [*names, "text"]
            )

    fields = T.StructType([pages.schema[name] for name in names]).add("text", "string")
    return pages.select(*names, column).mapInArrow(run, fields)
