"""Visible text of HTML pages, laid out: blocks, lists and aligned table cells.

A page is read into a tree in one pass over its tags; end tags that HTML lets authors leave out
are implied (a block closes an open paragraph, an item the item before it, a cell or row its
predecessor), and stray end tags are ignored. Subtrees nobody sees are skipped: scripts, styles,
templates, objects and media, ``hidden``, ``display:none``, ``visibility:hidden``, hidden inputs,
closed details, what a drawing only defines or describes, annotations of formulas. Formulas,
labels of drawings and all options of a select are text like any other.
The tree is then written as text. White space collapses except in ``pre``; blocks stand on lines
of their own, paragraphs and headings with a blank line around; list items carry a bullet or
their number and are indented by depth; the cells of a table are padded to columns, spanning
cells take the width of what they span and keep their columns in the rows they reach down to.

Depth is bounded by closing nothing and nesting no further beyond ``DEPTH`` levels: deeper
elements become children of the last level, so no text is lost; what is hidden there stays so.

Defined cases: a NULL or empty page gives empty text and no blocks; a tag that is never closed
by ``>`` is text; rows that repeat a page_id are pages of their own.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.common import text_batches

DEPTH = 200
CHUNK_BYTES = 4 << 20

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style head title template noscript iframe object datalist "
                   "audio video canvas noembed noframes".split())
UNSEEN_IN = {"desc": "svg", "defs": "svg", "metadata": "svg", "symbol": "svg", "annotation": "math",
             "annotation-xml": "math"}
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset".split())
BLOCKS = SPACED | frozenset(
    "html body div section article aside header footer nav main address li dt dd tr caption thead tbody "
    "tfoot form details summary figcaption legend center option optgroup text td th".split())
# Which open elements a start tag closes, and which elements it does not look beyond.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
CLOSE_P = BLOCKS - frozenset("html body tr td th option optgroup text thead tbody tfoot caption summary legend figcaption".split())
SCOPE = frozenset("table td th button".split())
HEAD_ONLY = frozenset("base link meta title style script template noscript head html".split())

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(double or single or bare))
    return found


class TreeBuilder:
    """``open`` are all open elements, ``into`` where the content of each goes: into itself or,
    below DEPTH, into the last level, or nowhere (None) if it is hidden."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        self.into: list[Node | None] = [self.root]
        self.count = Counter(["html"])

    def push(self, node: Node, into: Node | None) -> None:
        self.open.append(node)
        self.into.append(into)
        self.count[node.name] += 1

    def cut(self, place: int) -> None:
        for node in self.open[place:]:
            self.count[node.name] -= 1
        del self.open[place:], self.into[place:]

    def text(self, text: str) -> None:
        if self.open[-1].name == "head" and text.strip():
            self.cut(len(self.open) - 1)
        if self.into[-1] is not None:
            self.into[-1].children.append(html.unescape(text))

    def close_open(self, names: set[str] | frozenset[str], scope: set[str] | frozenset[str]) -> None:
        """Close up to the outermost open element of these names within the scope."""
        lowest, left = None, sum(self.count[name] for name in names)
        for place in range(len(self.open) - 1, 0, -1):
            if not left:
                break
            if self.open[place].name in names:
                lowest = place
                left -= 1
            elif self.open[place].name in scope:
                break
        if lowest is not None:
            self.cut(lowest)

    def foreign(self, name: str) -> bool:
        return name in ("svg", "math") or self.count["svg"] > 0 or self.count["math"] > 0

    def start(self, name: str, attributes: dict[str, str], closed: bool = False) -> None:
        if name == "html" or (name == "body" and self.count["body"]):
            return
        if self.open[-1].name == "head" and name not in HEAD_ONLY:
            self.cut(len(self.open) - 1)
        if name in CLOSE_P:
            self.close_open({"p"}, SCOPE)
        if name in CLOSES:
            self.close_open(*CLOSES[name])
        if self.count[UNSEEN_IN.get(name, "")]:
            attributes = attributes | {"hidden": ""}
        node, into = Node(name, attributes), self.into[-1]
        if into is not None:
            into.children.append(node)
        if name in VOID or closed:
            return
        if len(self.open) < DEPTH - (name == "details"):
            self.push(node, node)
        elif not visible(node) or (name == "details" and "open" not in attributes):
            self.push(node, None)
        elif name == "summary" and self.open[-1].name == "details" and visible(self.open[-1]):
            self.push(node, self.into[-2])
        else:
            self.push(node, into)

    def end(self, name: str) -> None:
        if not self.count[name]:
            return
        for place in range(len(self.open) - 1, 0, -1):
            if self.open[place].name == name:
                self.cut(place)
                return
            if self.open[place].name in SCOPE and name not in ("table", "tr", "tbody", "thead", "tfoot", "body"):
                return


def tree_of(page: str) -> Node:
    builder, at = TreeBuilder(), 0
    while (tag := TAG.search(page, at)) is not None:
        if tag.start() > at:
            builder.text(page[at:tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            builder.end(name)
            continue
        closed = tag[3].endswith("/") and builder.foreign(name)
        builder.start(name, attributes_of(tag[3]) if tag[3] else {}, closed)
        if name in RAW and not closed:
            end = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
            inside = page[at:end.start() if end else len(page)]
            at = end.end() if end else len(page)
            if builder.into[-1] is not None:
                builder.into[-1].children.append(html.unescape(inside))
            builder.end(name)
    if at < len(page):
        builder.text(page[at:])
    return builder.root


def visible(node: Node) -> bool:
    if node.name in UNSEEN:
        return False
    given = node.attributes
    if not given:
        return True
    return not ("hidden" in given or HIDING.search(given.get("style", ""))
                or (node.name == "input" and given.get("type", "").lower() == "hidden"))


class Writer:
    """Lines of text with pending white space and blank lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = self.blank = False
        self.prefix = self.first = ""

    def inline(self, text: str) -> None:
        if not text:
            return
        lead, rest = text[0] in " \t\n\r\f", SPACE.sub(" ", text).strip(" ")
        if not rest:
            self.space = True
            return
        if (lead or self.space) and self.parts:
            self.parts.append(" ")
        self.parts.append(rest)
        self.space = text[-1] in " \t\n\r\f"

    def end_line(self, even_empty: bool = False) -> None:
        text = "".join(self.parts)
        self.parts, self.space = [], False
        if text or even_empty:
            self.whole_line(text)

    def whole_line(self, text: str) -> None:
        if self.blank and self.lines and self.lines[-1]:
            self.lines.append("")
        self.blank = False
        self.lines.append((self.first + text).rstrip() if text or self.first.strip() else "")
        self.first = self.prefix

    def gap(self) -> None:
        self.end_line()
        self.blank = True


def cell_text(node: Node) -> str:
    writer = Writer()
    for child in node.children:
        write(child, writer)
    writer.end_line()
    return " ".join(line.strip() for line in writer.lines if line.strip())


def rows_of(node: Node) -> int:
    """The rows a cell reaches over; 0 is all of its section."""
    digits = node.attributes.get("rowspan", "1")
    return int(digits) if digits.isascii() and digits.isdigit() and len(digits) < 6 else 1


def span_of(node: Node) -> int:
    digits = node.attributes.get("colspan", "1")
    return min(max(int(digits), 1), 100) if digits.isascii() and digits.isdigit() and len(digits) < 5 else 1


def placed_rows(rows: list[tuple[Node, list[Node]]]) -> Iterator[list[tuple[Node | None, int]]]:
    """(cell, columns) of each row; None stands for a column a cell further up reaches into."""
    section, taken = None, {}
    for own, cells in rows:
        if own is not section:  # no cell reaches out of its section
            section, taken = own, {}
        row, place, below = [], 0, {}
        for cell in cells:
            while place in taken:
                row.append((None, 1))
                place += 1
            span, down = span_of(cell), rows_of(cell)
            row.append((cell, span))
            if down != 1:
                below |= dict.fromkeys(range(place, place + span), down - 1 if down else math.inf)
            place += span
        taken = {column: left - 1 for column, left in taken.items() if left > 1} | below
        yield row


def write_table(node: Node, writer: Writer) -> None:
    rows: list[tuple[Node, list[Node]]] = []  # section and cells
    captions: list[Node] = []
    loose: list = []

    def collect(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                if child.strip():
                    loose.append(child)
            elif not visible(child):
                continue
            elif child.name in ("thead", "tbody", "tfoot", "form"):
                collect(child)
            elif child.name == "tr":
                cells = [c for c in child.children if isinstance(c, Node) and c.name in ("td", "th") and visible(c)]
                others = [c for c in child.children if c not in cells and (isinstance(c, Node) or c.strip())]
                loose.extend(others)
                rows.append((part, cells))
            elif child.name in ("td", "th"):
                rows.append((part, [child]))
            elif child.name == "caption":
                captions.append(child)
            elif child.name not in ("colgroup", "col"):
                loose.append(child)

    collect(node)
    writer.gap()
    for child in [*loose, *captions]:  # what a table may not hold stands in front of it
        write(child, writer)
        writer.end_line()
    widths: list[int] = []
    placed = [row for row in placed_rows(rows) if any(cell is not None for cell, _ in row)]
    texts = [[("" if cell is None else cell_text(cell), span) for cell, span in row] for row in placed]
    for row in texts:
        place = 0
        for text, span in row:
            widths.extend([0] * (place + span - len(widths)))
            if span == 1:
                widths[place] = max(widths[place], len(text))
            place += span
    for row in texts:
        line, place = [], 0
        for text, span in row:
            room = sum(widths[place:place + span]) + 2 * (span - 1)
            line.append(text.ljust(room))
            place += span
        writer.whole_line("  ".join(line).rstrip())
    writer.gap()


def write_list(node: Node, writer: Writer, depth: int) -> None:
    start = node.attributes.get("start", "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    outer, nested = writer.prefix, bool(writer.prefix.strip(" ")) or depth > 0
    writer.end_line() if nested else writer.gap()
    for child in node.children:
        if isinstance(child, str) or child.name != "li":
            write(child, writer, depth)
            continue
        if not visible(child):
            continue
        mark = f"{number}. " if node.name == "ol" else "- "
        number += 1
        writer.end_line()
        writer.first, writer.prefix = outer + mark, outer + " " * len(mark)
        for part in child.children:
            write(part, writer, depth + 1)
        writer.end_line()
        if writer.first == outer + mark:  # an empty item
            writer.whole_line("")
        writer.first = writer.prefix = outer
        writer.blank = False
    writer.first = writer.prefix = outer
    if not nested:
        writer.gap()


def write_pre(node: Node, writer: Writer) -> None:
    pieces: list[str] = []

    def collect(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                pieces.append(child)
            elif child.name == "br":
                pieces.append("\n")
            elif visible(child):
                collect(child)

    collect(node)
    writer.gap()
    text = "".join(pieces).replace("\r\n", "\n")
    for line in text.removeprefix("\n").rstrip("\n").split("\n"):
        writer.whole_line(line)
    writer.gap()


def write(node: Node | str, writer: Writer, depth: int = 0) -> None:
    if isinstance(node, str):
        writer.inline(node)
        return
    if not visible(node):
        return
    name = node.name
    if name == "br":
        writer.end_line(even_empty=True)
    elif name == "hr":
        writer.gap()
    elif name == "img":
        writer.inline(node.attributes.get("alt", ""))
    elif name == "input":
        writer.inline(node.attributes.get("value", ""))
    elif name == "option" and not any(isinstance(c, Node) or c.strip() for c in node.children):
        writer.end_line()
        writer.inline(node.attributes.get("label", ""))
        writer.end_line()
    elif name == "table":
        write_table(node, writer)
    elif name in ("ul", "ol", "menu"):
        write_list(node, writer, depth)
    elif name == "pre":
        write_pre(node, writer)
    else:
        children = node.children
        if name == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.name == "summary"]
        around = writer.gap if name in SPACED and depth == 0 else writer.end_line if name in BLOCKS else None
        if around:
            around()
        if name == "optgroup":
            writer.inline(node.attributes.get("label", ""))
            writer.end_line()
        outer = writer.prefix
        if name in ("dd", "blockquote"):
            writer.prefix = writer.first = outer + "    "
        for child in children:
            write(child, writer, depth)
        if around:
            around()
        if name in ("dd", "blockquote"):
            writer.prefix = writer.first = outer


def rendered(page: str | None) -> str:
    """The visible text of a page."""
    if not page:
        return ""
    writer = Writer()
    write(tree_of(page), writer)
    writer.end_line()
    return "\n".join(writer.lines).strip("\n")


def render_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_batches(batches, CHUNK_BYTES):
        texts = [rendered(page) for page in batch.column(1).to_pylist()]
        blocks = [len([b for b in text.split("\n\n") if b]) for text in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(blocks, pa.int64())],
            names=["page_id", "text", "n_blocks"])


def render_pages(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_blocks) of pages (page_id, html): text blocks are parted by blank
    lines."""
    return pages.select("page_id", "html").mapInArrow(
        render_task, "page_id long, text string, n_blocks long")
