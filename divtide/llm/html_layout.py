"""Renders the visible text of HTML as it is laid out: blocks, lists and aligned table cells.

A tree is built from the tag stream with the tags that HTML lets authors leave out put in (end of `p`, `li`,
`td` and so on). Elements that a reader does not see are left out: scripts, styles, the head, form controls,
anything hidden by attribute or inline style. All other text comes out, in order.

- Blocks start on a line of their own; paragraphs, headings, lists and tables have an empty line around them.
- List items start with `- ` or their number and are indented by two spaces per level.
- Cells of a table are padded to the widest of their column; columns are two spaces apart.
- White space is one space except in `pre` and `textarea`; `br` ends a line, `hr` is a line of dashes.

Defined cases: NULL or empty HTML gives an empty text; text without tags comes out as one block; stray end tags
are ignored; what follows markup that cannot be parsed is taken as text. Nesting may be of any depth (trees are
walked with a stack; tables nested in more than DEEPEST tables are laid out as blocks). NULL ids are carried,
repeated rows rendered one by one, and other columns not read.
"""

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
UNSEEN = frozenset(
    "head script style template noscript iframe object svg math canvas audio video select datalist title meta link".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset".split())
BLOCKS = PARAGRAPHS | frozenset(
    """
    html body div section article aside nav header footer main address hgroup figcaption form details summary
    dialog search center menu li dt dd tr td th thead tbody tfoot caption legend hr option optgroup textarea
    """.split()
)
# An opening tag ends these if one is open, unless one of the second group stands between.
P_ENDS = frozenset(
    """
    address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2
    h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul
    """.split()
)
LIST, TABLE = frozenset("ul ol menu dl".split()), frozenset(["table"])
IMPLIED_ENDS = {
    **{tag: (frozenset(["p"]), TABLE | frozenset("button td th".split())) for tag in P_ENDS},
    "li": (frozenset("li p".split()), LIST | TABLE),
    "dt": (frozenset("dt dd p".split()), LIST | TABLE),
    "dd": (frozenset("dt dd p".split()), LIST | TABLE),
    "td": (frozenset("td th p".split()), TABLE),
    "th": (frozenset("td th p".split()), TABLE),
    "tr": (frozenset("tr td th p caption".split()), TABLE),
    "thead": (frozenset("thead tbody tfoot tr td th p caption".split()), TABLE),
    "tbody": (frozenset("thead tbody tfoot tr td th p caption".split()), TABLE),
    "tfoot": (frozenset("thead tbody tfoot tr td th p caption".split()), TABLE),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "body": (frozenset(["head"]), frozenset()),
}
HIDING = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)|font-size\s*:\s*0(?![.\d])|opacity\s*:\s*0(?:\.0*)?\s*(?:;|$)")
BLANKS = re.compile(r"[ \t\n\r\f]+")
DEEPEST = 20


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str | None]):
        self.tag, self.attrs, self.children = tag, attrs, []


def visible(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag in UNSEEN or "hidden" in attrs and attrs["hidden"] != "until-found":
        return False
    if attrs.get("aria-hidden") == "true" or tag == "dialog" and "open" not in attrs:
        return False
    style = attrs.get("style")
    return not (style and HIDING.search(style.lower()))


class Builder(HTMLParser):
    """The tree of the visible elements; invisible ones are followed to their end and left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        self.unseen: list[int] = []  # places in `open` where what is not seen begins

    def close_from(self, place: int) -> None:
        del self.open[place:]
        while self.unseen and self.unseen[-1] >= place:
            self.unseen.pop()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        named = dict(attrs)
        if tag == "html":
            return
        ends, stops = IMPLIED_ENDS.get(tag, (frozenset(), frozenset()))
        if tag != "head" and self.open[-1].tag == "head" and tag not in UNSEEN and tag not in ("base", "noscript"):
            self.close_from(len(self.open) - 1)  # content ends a head that was not closed
        if ends:
            least = None
            for place in range(len(self.open) - 1, 0, -1):
                name = self.open[place].tag
                if name in stops:
                    break
                if name in ends:
                    least = place
                elif tag in P_ENDS and name in BLOCKS:
                    break
            if least is not None:
                self.close_from(least)
        node = Node(tag, named)
        if not self.unseen:
            if visible(tag, named):
                self.open[-1].children.append(node)
            elif tag not in VOID:
                self.unseen.append(len(self.open))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # Only void elements end this way; the slash on others means nothing.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
            return
        stops = TABLE if tag in ("li", "p", "div", "span") else frozenset()
        for place in range(len(self.open) - 1, 0, -1):
            name = self.open[place].tag
            if name == tag:
                self.close_from(place)
                return
            if name in stops:
                return

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.open[-1].children.append(data)

    def unknown_decl(self, data: str) -> None:
        pass


def tree(html: str) -> Node:
    builder = Builder()
    try:
        builder.feed(html)
        builder.close()
    except AssertionError:  # the parser gives up on some declarations
        builder.handle_data(re.sub(r"<[^<>]*>", " ", builder.rawdata))
    return builder.root


class Page:
    """Lines of text with what stands before each."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = 0  # empty lines wanted before the next line
        self.indent = ""
        self.marker = ""

    def flush(self) -> None:
        text = BLANKS.sub(" ", "".join(self.inline)).strip(" ")
        self.inline.clear()
        if text:
            self.line(text)

    def line(self, text: str) -> None:
        if self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.append(self.indent + self.marker + text)
        self.marker = " " * len(self.marker)

    def block(self, gap: int) -> None:
        self.flush()
        self.gap = max(self.gap, gap)


def walk(node: Node, into: tuple[str, ...] = ()) -> Iterator[tuple[str, Node | str]]:
    """The node's content in order, as starts, ends and texts; elements named in `into` are not entered."""
    stack: list[tuple[str, Node | str]] = [("node", child) for child in reversed(node.children)]
    while stack:
        kind, item = stack.pop()
        if kind == "end":
            yield "end", item
        elif isinstance(item, str):
            yield "text", item
        else:
            yield "start", item
            if item.tag not in into:
                stack.append(("end", item))
                stack.extend(("node", child) for child in reversed(item.children))


def span(cell: Node) -> int:
    value = cell.attrs.get("colspan") or ""
    return min(100, int(value)) if value.isascii() and value.isdigit() and int(value) > 0 else 1


def table_lines(table: Node, depth: int) -> list[str]:
    """The rows of a table with their cells aligned; a caption stands above."""
    rows: list[list[str]] = []
    above: list[str] = []
    stack = [child for child in reversed(table.children)]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            if item.strip():
                above.append(BLANKS.sub(" ", item).strip())
        elif item.tag in ("td", "th"):
            if not rows:
                rows.append([])
            rows[-1] += [" ".join(x.strip() for x in rendered(item, depth + 1) if x.strip()), *[""] * (span(item) - 1)]
        elif item.tag in ("tr", "thead", "tbody", "tfoot"):
            if item.tag == "tr":
                rows.append([])
            stack.extend(reversed(item.children))
        else:
            above.extend(x for x in rendered_node(item, depth + 1) if x.strip())
    widths: list[int] = []
    for row in rows:
        widths.extend([0] * (len(row) - len(widths)))
        for i, cell in enumerate(row):
            widths[i] = max(widths[i], len(cell))
    return above + [line for row in rows if (line := "  ".join(c.ljust(w) for c, w in zip(row, widths)).rstrip())]


def rendered_node(node: Node, depth: int) -> list[str]:
    holder = Node("div", {})
    holder.children.append(node)
    return rendered(holder, depth)


def rendered(root: Node, depth: int = 0) -> list[str]:
    page, lists, pre, opened = Page(), [], 0, False
    tables = ("table",) if depth < DEEPEST else ()
    for kind, item in walk(root, tables):
        if kind == "text":
            if pre:
                # A line break right after the opening tag is not part of the text.
                first, *more = (item[1:] if opened and item.startswith("\n") else item).split("\n")
                opened = False
                page.inline.append(first)
                for line in more:
                    page.line("".join(page.inline))
                    page.inline[:] = [line]
            else:
                page.inline.append(item)
            continue
        tag = item.tag
        if kind == "start" and tag in tables:
            page.block(1)
            for line in table_lines(item, depth):
                page.line(line)
            page.gap = max(page.gap, 1)
        elif tag == "br":
            if kind == "start":
                if pre:
                    page.line("".join(page.inline))
                    page.inline.clear()
                else:
                    page.flush()
        elif tag == "hr":
            if kind == "start":
                page.block(0)
                page.line("---")
        elif tag in ("pre", "textarea"):
            if kind == "start":
                page.block(1)
                pre, opened = pre + 1, True
            else:
                pre -= 1
                if not pre:
                    if "".join(page.inline).strip():
                        page.line("".join(page.inline).rstrip())
                    page.inline.clear()
                    page.gap = max(page.gap, 1)
        elif tag in ("ul", "ol", "menu"):
            page.block(0 if lists else 1)
            if kind == "start":
                start = item.attrs.get("start") or ""
                lists.append([tag, int(start) if start.isascii() and start.isdigit() else 1, page.indent, page.marker])
                page.indent, page.marker = "  " * (len(lists) - 1), ""
            else:
                page.indent, page.marker = lists.pop()[2:]
        elif tag == "li":
            page.block(0)
            if kind == "start" and lists:
                page.marker = f"{lists[-1][1]}. " if lists[-1][0] == "ol" else "- "
                lists[-1][1] += 1
            else:
                page.marker = ""
        elif tag in ("td", "th"):  # a cell outside a table, or in one too deep
            page.inline.append("  ")
        elif tag == "dd":
            page.block(0)
            page.indent = page.indent + "  " if kind == "start" else page.indent[:-2]
        elif tag in BLOCKS:
            page.block(1 if tag in PARAGRAPHS else 0)
    page.flush()
    return page.lines


def render(html: str | None) -> str:
    """The visible text of a page."""
    return "\n".join(rendered(tree(html))) if html else ""


def extract(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """The id, the rendered `text` and its length in characters, one row per page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(x) for x in batch.column(1).to_pylist()]
            columns = [pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[id_column, "text", "n_chars"])

    return pages.select(F.col(id_column).cast("long").alias(id_column), "html").mapInArrow(
        read, f"{id_column} long, text string, n_chars long"
    )
