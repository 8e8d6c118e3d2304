"""Visible text of HTML pages, laid out.

A tokenizer splits the page, a tree builder supplies implied tags, visibility rules drop what a browser does not show,
and a renderer writes blocks, lists and aligned table cells as plain text. Builder and renderer keep their own stacks,
so that any depth of nesting works; the builder knows the open elements by name, so its time does not grow with depth.

Of style sheets, `display` and `visibility` count, in rules of `<style>` whose selectors are an element, classes and an
id together (`p`, `.a.b`, `div#c`). Rules with combinators, pseudo-classes or attributes, at-rules and linked sheets are
not applied, so what only they hide is shown.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.common import text_of

# Element names of the HTML standard, by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPED_RAW = frozenset("textarea title".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe object audio video canvas noembed noframes "
                   "datalist param source track area".split())
#: Inside drawings and formulas.
FOREIGN = frozenset(("svg", "math"))
FOREIGN_UNSEEN = frozenset("annotation annotation-xml clippath defs desc marker mask metadata pattern symbol".split())
#: Elements that end a drawing or formula they stand in.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
                     "pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Elements of drawings and formulas that hold ordinary content again.
INTEGRATION = frozenset("annotation-xml desc foreignobject mi mn mo ms mtext title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure hr fieldset menu".split())
BLOCK = SPACED | frozenset("address article aside body center dd details dialog dir div dt figcaption footer form header hgroup "
                           "html legend li main nav optgroup option search section summary tr tbody thead tfoot caption".split())
CLOSES_PARAGRAPH = BLOCK - frozenset("html body option optgroup tr tbody thead tfoot caption legend".split())
CELLS = frozenset(("td", "th"))
SECTIONS = frozenset(("tbody", "thead", "tfoot"))
#: A start tag closes the open ones of these names, looking no farther than the scope's names.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist", "optgroup")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("td", "th", "tr", "caption"), ("table",)),
    "tbody": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), ("table",)), "thead": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), ("table",)),
    "tfoot": (("td", "th", "tr", "tbody", "thead", "tfoot", "caption"), ("table",)), "caption": (("caption",), ("table",)),
    "body": (("head",), ("html",)),
}
#: An end tag does not reach out of these.
BARRIER = frozenset(("table", "td", "th", "caption", "template", "html"))
PARAGRAPH_SCOPE = (*BARRIER, "button")

#: A quote opens a value only behind an equals sign; anywhere else it is an ordinary character.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                 r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: Mark of a drawing's label, no name of an attribute.
LABEL = " label"
COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
BRACE = re.compile(r"[{}]")
SELECTOR = re.compile(r"([a-z][a-z0-9-]*|\*)?((?:[.#][\w-]+)*)", re.I)
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("name", "attributes", "children")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


class Open:
    """The open elements, and for every name the places where it is open."""

    def __init__(self, root: Node):
        self.stack: list[Node | None] = [root]  # None: closed while a block inside it is still open
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.places.setdefault(node.name, []).append(len(self.stack))
        if node.name in BLOCK or node.name in CELLS:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Closes the element at a place and all inside it."""
        while len(self.stack) > place or self.stack[-1] is None:
            node = self.stack.pop()
            if node is not None:
                self.places[node.name].pop()
                if self.blocks and self.blocks[-1] == len(self.stack):
                    self.blocks.pop()

    def close_alone(self, place: int) -> None:
        """Closes the innermost element of its name; what is inside it stays open."""
        self.places[self.stack[place].name].pop()
        self.stack[place] = None

    def innermost(self, names: Iterable[str]) -> int:
        """Place of the innermost open one of these names, 0 when none is."""
        return max((self.places[name][-1] for name in names if self.places.get(name)), default=0)


def tree(page: str) -> tuple[Node, list[str]]:
    """The page as nodes and strings, and its style sheets. Character references are resolved; unclosed elements end with their parents."""
    root = Node("html", {})
    opened = Open(root)
    stack, innermost = opened.stack, opened.innermost
    sheets: list[str] = []
    any_foreign = False

    def foreign() -> str:
        """The drawing or formula whose own element comes next, or nothing."""
        if any_foreign:
            place = innermost(FOREIGN)
            if place > innermost(INTEGRATION):
                return stack[place].name
        return ""

    def drawn() -> bool:
        """Text of a drawing is shown in its labels only."""
        return not any_foreign or innermost(("svg",)) <= innermost(("text", "foreignobject", "math"))

    def close(names: tuple, scope: tuple) -> None:
        """Closes the innermost of the names again and again, as a row around a cell, up to the scope."""
        while (place := innermost(names)) > innermost(scope):
            opened.cut(place)

    def start(name: str, attributes: dict[str, str]) -> None:
        if name in ("html", "body") and name != "body":
            root.attributes |= attributes
            return
        if name in CLOSES_PARAGRAPH:
            close(("p",), PARAGRAPH_SCOPE)
        if name in IMPLIED_END:
            close(*IMPLIED_END[name])
        if name in CELLS and stack[-1].name in ("table", *SECTIONS):
            start("tr", {})
        if name == "body" or (name not in UNSEEN and len(stack) > 1 and stack[1] is not None and stack[1].name == "head"):
            opened.cut(1)
        node = Node(name, attributes)
        stack[-1].children.append(node)
        if name not in VOID:
            opened.push(node)

    def end(name: str) -> None:
        place, barrier = innermost((name,)), innermost(BARRIER)
        if barrier > place and name not in ("table", "body", "html", *SECTIONS, "tr"):
            return
        if place:
            inline = name not in BLOCK and name not in CELLS and name not in BARRIER
            if inline and place < len(stack) - 1 and opened.blocks and opened.blocks[-1] > place:
                opened.close_alone(place)  # an inline element that a block outlives
            else:
                opened.cut(place)
        elif name == "p":
            start("p", {})
            opened.cut(len(stack) - 1)

    def text(data: str, resolve: bool = True) -> None:
        if not data or not drawn():
            return
        if len(stack) == 2 and stack[1].name == "head" and data.strip():
            opened.cut(1)
        stack[-1].children.append(html.unescape(data) if resolve and "&" in data else data)

    at = 0
    while True:
        found = TAG.search(page, at)
        if found is None or found[2] and not found[4]:
            text(page[at:])  # a tag without an end is text
            return root, sheets
        text(page[at:found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                text(found[0][9:].removesuffix("]]>"), False)
            continue
        if found[1]:
            end(name)
            continue
        attributes = {}
        for key, *values in ATTRIBUTE.findall(found[3]) if found[3].strip(" /") else ():
            attributes.setdefault(key.lower(), html.unescape("".join(values)))
        inside = foreign()
        while inside and name in BREAKOUT:
            opened.cut(len(stack) - 1)
            inside = foreign()
        if inside and name in FOREIGN_UNSEEN:
            attributes["hidden"] = ""
        elif inside == "svg" and name == "text":
            attributes[LABEL] = ""
        start(name, attributes)
        any_foreign = any_foreign or name in FOREIGN
        if (inside or name in FOREIGN) and found[3].endswith("/") and stack[-1].name == name:
            opened.cut(len(stack) - 1)
            continue
        if name in RAW or name in ESCAPED_RAW:
            stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            until = stop.start() if stop else len(page)
            text(page[at:until], name in ESCAPED_RAW)
            if name == "style" and not opened.places.get("template") and on_screen(attributes.get("media", "")):
                sheets.append(page[at:until])
            at = stop.end() if stop else len(page)
            end(name)


def on_screen(media: str) -> bool:
    """Whether a list of media holds the screen; conditions such as a width are not met."""
    return not media.strip() or any(kind.strip().lower() in ("all", "screen") for kind in media.split(","))


def declared(body: str) -> list[tuple[str, str, bool]]:
    """(property, value, important) of the declarations that can hide."""
    out = []
    for declaration in body.split(";"):
        name, _, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if name in ("display", "visibility"):
            bare = value.removesuffix("important").rstrip()
            important = bare != value and bare.endswith("!")
            out.append((name, bare[:-1].rstrip() if important else value, important))
    return out


class Styles:
    """Rules of style sheets, found by an id, a class or an element of their selectors."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list[tuple]] = {}
        number = 0
        for sheet in sheets:
            for selectors, body in self._blocks(COMMENT.sub(" ", sheet)):
                found = declared(body)
                for selector in selectors.split(",") if found else ():
                    parts = SELECTOR.fullmatch(selector.strip())
                    if not selector.strip() or parts is None:
                        continue
                    kind = (parts[1] or "*").lower()
                    marks = frozenset(re.findall(r"[.#][\w-]+", parts[2]))
                    ids = sum(mark[0] == "#" for mark in marks)
                    rank = (ids, len(marks) - ids, int(kind != "*"), number := number + 1)
                    key = max(marks, key=lambda mark: (mark[0] == "#", mark), default=kind)
                    self.rules.setdefault(key, []).append((kind, marks, rank, found))

    @staticmethod
    def _blocks(sheet: str) -> Iterator[tuple[str, str]]:
        """Selectors and declarations of the rules outside of at-rules."""
        at = 0
        while (brace := sheet.find("{", at)) >= 0:
            selectors = sheet[at:brace].rpartition(";")[2]  # behind at-rules without a block
            stop = sheet.find("}", brace)
            stop = stop if stop >= 0 else len(sheet)
            if not selectors.lstrip().startswith("@"):
                yield selectors, sheet[brace + 1:stop]
                at = stop + 1
                continue
            depth, at = 1, brace + 1
            while depth and (step := BRACE.search(sheet, at)):
                depth, at = depth + (1 if step[0] == "{" else -1), step.end()
            if depth:
                return

    def of(self, node: Node) -> dict[str, str]:
        """display and visibility as rules and the element's own style set them."""
        attributes = node.attributes
        if not self.rules and "style" not in attributes:
            return {}
        best: dict[str, tuple] = {}
        own = {f".{c}" for c in attributes.get("class", "").split()} | ({f"#{attributes['id']}"} if "id" in attributes else set())
        for key in (*own, node.name, "*") if self.rules else ():
            for kind, marks, rank, found in self.rules.get(key, ()):
                if kind in ("*", node.name) and marks <= own:
                    for n, (name, value, important) in enumerate(found):
                        best[name] = max(best.get(name, ()), (important, (0, rank), n, value))
        for n, (name, value, important) in enumerate(declared(COMMENT.sub(" ", attributes.get("style", "")))):
            best[name] = max(best.get(name, ()), (important, (1, ()), n, value))
        return {name: found[-1] for name, found in best.items()}


def shown(node: Node, parent: Node, style: dict[str, str]) -> bool:
    """Whether an element has a place on the page; `display` beats the attribute `hidden`."""
    attributes = node.attributes
    if node.name in UNSEEN or style.get("display") == "none":
        return False
    if "hidden" in attributes and attributes["hidden"].lower() != "until-found" and "display" not in style:
        return False
    return not (node.name == "dialog" and "open" not in attributes
                or parent.name == "details" and "open" not in parent.attributes and node.name != "summary")


class Writer:
    """Lines of one flow: running text with collapsed blanks, block breaks, list marks, indents."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line, self.gap, self.blank = [], False, False
        self.indent, self.mark = "", ""

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.put(first)
            for line in rest:
                self.flush(True)
                self.put(line)
            return
        parts = BLANKS.sub(" ", data)
        if not parts:
            return
        if parts[0] == " " and self.line:
            self.gap = True
        body = parts.strip(" ")
        if body:
            self.put(body)
            self.gap = parts[-1] == " "

    def put(self, data: str) -> None:
        if not data:
            return
        if not self.line and self.blank:
            if self.lines and self.lines[-1]:
                self.lines.append("")
            self.blank = False
        self.line.append((" " if self.gap and self.line else "") + data)
        self.gap = False

    def flush(self, even_empty: bool = False) -> None:
        if self.line or even_empty:
            self.lines.append((self.indent + self.mark + "".join(self.line)).replace("\xa0", " ").rstrip())
            if self.line and self.mark:
                self.mark = ""
        self.line, self.gap = [], False

    def rule(self, lines: list[str]) -> None:
        self.flush()
        for line in lines:
            self.put(line)
            self.flush(True)

    def rest(self) -> list[str]:
        self.flush()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return lines


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of cells (lines, columns and rows spanned) with columns padded to their widest line; rows without text are left out."""
    covered: dict[int, int] = {}  # last row that a cell from above covers, by column
    placed = []
    for number, row in enumerate(rows):
        column, cells = 0, []
        for lines, across, down in row:
            while covered.get(column, -1) >= number:
                column += 1
            cells.append((column, lines, across))
            if down > 1:
                covered |= dict.fromkeys(range(column, column + across), number + down - 1)
            column += across
        placed.append(cells)
    widths: dict[int, int] = {}
    for cells in placed:
        for column, lines, across in cells:
            if across == 1:
                widths[column] = max(widths.get(column, 0), max(map(len, lines), default=0))
    out = []
    for cells in placed:
        for n in range(max((len(lines) for _, lines, _ in cells), default=0)):
            at, line = 0, ""
            for column, lines, across in cells:
                line += " " * sum(widths.get(k, 0) + 2 for k in range(at, column))
                width = sum(widths.get(k, 0) for k in range(column, column + across)) + 2 * (across - 1)
                line += (lines[n] if n < len(lines) else "").ljust(width) + "  "
                at = column + across
            out.append(line.rstrip())
    return out


def _number(text: str, otherwise: int) -> int:
    digits = text.strip()
    return int(digits) if digits.isascii() and digits.removeprefix("-").isdigit() and len(digits) < 10 else otherwise


def _spans(node: Node) -> tuple[int, int]:
    """Columns and rows of a cell; no rows stand for all that follow."""
    down = _number(node.attributes.get("rowspan", "1"), 1)
    return min(max(_number(node.attributes.get("colspan", "1"), 1), 1), 1000), 65534 if down == 0 else min(max(down, 1), 65534)


def render(root: Node, styles: Styles) -> str:
    """Walks the tree: ("enter" or "leave", node, its parent, whether it is visible), with a stack of writers (one more in
    each table cell). What is invisible has its place, without its text; a child can be visible again."""
    writers, tables, lists = [Writer()], [], []
    kept = 0
    steps: list[tuple] = [("enter", root, root, True)]
    while steps:
        step, node, parent, visible = steps.pop()
        writer = writers[-1]
        if step == "enter":
            if isinstance(node, str):
                if not visible or parent.name == "details" and "open" not in parent.attributes:
                    continue
                if tables and parent.name in ("table", "tr", *SECTIONS):
                    if node.strip():
                        writer.text(node, False)
                else:
                    writer.text(node, kept > 0)
                continue
            style = styles.of(node)
            if not shown(node, parent, style):
                continue
            if style.get("visibility", "inherit") not in ("inherit", "unset"):
                visible = style["visibility"] not in ("hidden", "collapse")
            name = node.name
            if not visible and name in ("br", "hr", "input"):
                continue
            if LABEL in node.attributes:
                writer.gap = True
            if name == "br":
                writer.flush(True)
                continue
            if name == "hr":
                writer.flush()
                writer.blank = True
                writer.rule(["---"])
                writer.blank = True
                continue
            if name == "input" and node.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text", "search") and node.attributes.get("value"):
                writer.gap = True
                writer.put(node.attributes["value"])
                writer.gap = True
                continue
            if name in BLOCK:
                writer.flush()
                if name in SPACED and not (name in ("ul", "ol", "menu") and lists):
                    writer.blank = True
            if name in ("ul", "ol", "menu", "dir"):
                back = name == "ol" and "reversed" in node.attributes
                items = sum(isinstance(c, Node) and c.name == "li" and shown(c, node, styles.of(c)) for c in node.children) if back else 1
                lists.append([name == "ol", _number(node.attributes.get("start", ""), items), -1 if back else 1])
                writer.indent += "  " if len(lists) > 1 else ""
            elif name == "li":
                number = lists[-1] if lists else [False, 1, 1]
                number[1] = _number(node.attributes.get("value", ""), number[1])
                writer.mark = f"{number[1]}. " if number[0] else "- "
                number[1] += number[2]
            elif name == "dd" or name == "blockquote":
                writer.indent += "  "
            elif name == "pre":
                kept += 1
            elif name == "table":
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in CELLS:
                writers.append(Writer())
                if tables and not tables[-1]:
                    tables[-1].append([])
            steps.append(("leave", node, parent, visible))
            steps += [("enter", child, node, visible) for child in reversed(node.children)]
            continue
        name = node.name
        if LABEL in node.attributes:
            writer.gap = True
        if name in CELLS:
            lines = writers.pop().rest()
            if tables:
                tables[-1][-1].append((lines, *_spans(node)))
            else:
                writers[-1].rule(lines)
        elif name == "table":
            writer.rule(aligned(tables.pop()))
            writer.blank = True
        elif name in BLOCK:
            writer.flush()
            if name in ("ul", "ol", "menu", "dir"):
                lists.pop()
                writer.indent = writer.indent[:-2] if lists else writer.indent
                writer.blank = writer.blank or not lists
            elif name == "li":
                writer.mark = ""
            elif name in ("dd", "blockquote"):
                writer.indent = writer.indent[:-2]
                writer.blank = writer.blank or name == "blockquote"
            elif name == "pre":
                kept -= 1
                writer.blank = True
            elif name in SPACED:
                writer.blank = True
    return "\n".join(writers[0].rest())


def page_text(page: str) -> str:
    root, sheets = tree(page)
    return render(root, Styles(sheets))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text): the visible text of every row's page. A null or empty page, or one without visible text, has an
    empty text; null and repeated ids stay as they are; other columns are not read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "text": [page_text(page) for page in batch["html"]]})

    return pages.select(F.col(id_col).cast("long").alias("page_id"), text_of(html_col).alias("html")).mapInPandas(run, "page_id long, text string")
