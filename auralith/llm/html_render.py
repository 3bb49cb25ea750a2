"""HTML extraction by layout-aware rendering.

A scanner feeds a tree builder that closes what HTML closes by itself (paragraphs before blocks, list items, table parts, options), ignores
stray end tags and takes scripts, styles and the like as raw text. The renderer walks the tree, leaves out what isn't visible (by element,
hidden attribute, inline style, or a one-part selector of the page's own style sheet with display:none or visibility:hidden; the latter is inherited and
visibility:visible ends it), and writes the rest: blocks on lines of their own, a blank line around paragraphs, headings, lists and tables, list
markers with indents, preformatted text as it stands, table cells in aligned columns, cells that span rows and columns in their place. Columns without
text take no room. Before a cell stand GAP spaces at most, in tables of any size, so that the output stays in proportion to the page; cells after it stand in their columns again.
All loops are iterative and read on from where they were, so nesting may be as deep as it likes and time is in proportion to the page.

Cases: null and empty html give an empty text; text without tags is one block; an unclosed comment or raw element reaches to the end; a tag without an end makes
the rest text; indents end at DEEPEST; spans are read up to the standard's limits (1,000 columns, 65,534 rows); repeated rows render alike; an empty table gives an empty result; columns other
than the id and the html are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from auralith.llm.common import map_texts

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = set("head script style title template noscript iframe object audio video canvas datalist noembed noframes annotation annotation-xml".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset".split())
BLOCKS = SPACED | set("address article aside body center caption dd details dialog dir div dt fieldset figcaption footer form header hgroup hr html legend li main menu nav option section summary tr".split())
#: A start tag closes an open element of the set, searched upwards to one of the limits.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, {"html"}),
}
#: Where the search for an open paragraph ends.
P_LIMITS = {"table", "td", "th", "caption", "button", "object", "body", "html"}
_name = re.compile(r"[^\s/>]+")
_plain = re.compile(r"[^>\"']*+")
_attribute = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
_none = re.compile(r"display\s*+:\s*+none", re.I)
_visibility = re.compile(r"visibility\s*+:\s*+(hidden|collapse|visible)", re.I)
_space = re.compile(r"[ \t\n\r\f]+")
#: Spaces before a table cell, at most.
GAP = 256
#: Lists and quotes are indented by so many characters at most.
DEEPEST = 80


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


class Scanner:
    """Texts and tags of a page, each character read once: what was looked for in vain isn't looked for again."""

    def __init__(self, html: str) -> None:
        self.html, self.at = html, 0
        self.absent: set[str] = set()

    def find(self, what: str, at: int) -> int:
        """Where `what` is next, -1 if it isn't there any more."""
        if what in self.absent:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.absent.add(what)
        return found

    def tag_end(self, at: int) -> int:
        """The > that ends the tag whose attributes begin at `at`, -1 without one; quotes count where a value may begin, and only if they close."""
        html, n = self.html, len(self.html)
        while at < n:
            at = _plain.match(html, at).end()
            if at >= n:
                break
            c = html[at]
            if c == ">":
                return at
            before = at - 1
            while html[before] in " \t\n\r\f":
                before -= 1
            closing = self.find(c, at + 1) if html[before] == "=" else -1
            at = closing + 1 if closing >= 0 else at + 1
        return -1

    def next(self) -> tuple[str, str, str, str]:
        """kind (text, start, end, skip, done), text or tag name, attributes, and for start tags the name as written."""
        html, at, n = self.html, self.at, len(self.html)
        if at >= n:
            return "done", "", "", ""
        start = self.find("<", at)
        if start != at:
            self.at = start if start >= 0 else n
            return "text", html[at : self.at], "", ""
        c = html[at + 1 : at + 2]
        if html.startswith("<!--", at):
            end = self.find("-->", at + 4)
            self.at = end + 3 if end >= 0 else n
            return "skip", "", "", ""
        closing = c == "/"
        first = html[at + 2 : at + 3] if closing else c
        if not (first.isascii() and first.isalpha()) and c not in ("!", "?"):
            self.at = at + 1
            return "text", "<", "", ""
        if self.find(">", at) < 0:
            self.at = n
            return "text", html[at:], "", ""
        if c in ("!", "?"):
            self.at = self.find(">", at) + 1
            return "skip", "", "", ""
        name = _name.match(html, at + 1 + closing)
        end = self.tag_end(name.end())
        if end < 0:
            self.at = n
            return "text", html[at:], "", ""
        self.at = end + 1
        return ("end" if closing else "start"), name[0].lower(), html[name.end() : end], name[0]


def parse(html: str) -> tuple[Node, list[str]]:
    """The tree, and the text of its style elements."""
    root = Node("html")
    scanner, open_nodes, styles, n = Scanner(html), [root], [], len(html)
    places: dict[str, list[int]] = {}  # of the open elements, by tag

    def deepest(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    def close(tags: set[str], limits: set[str]) -> None:
        at = deepest(tags)
        if at and at > deepest(limits - tags):
            for node in open_nodes[at:]:
                places[node.tag].pop()
            del open_nodes[at:]

    while True:
        kind, tag, inside, _ = scanner.next()
        if kind == "done":
            return root, styles
        if kind == "text":
            open_nodes[-1].children.append(unescape(tag))
        if kind not in ("start", "end"):
            continue
        if kind == "end":
            if tag == "p" and not places.get("p"):
                open_nodes[-1].children.append(Node("p"))
            elif tag != "html":
                close({tag}, {"table"} if tag not in ("table", "div", "body") else set())
            continue
        attributes = {k.lower(): unescape(v.strip("\"'")) for k, v in _attribute.findall(inside)} if inside else {}
        if tag == "html":
            root.attributes |= attributes
            continue
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in BLOCKS and tag not in ("option", "tr", "li", "dt", "dd", "caption", "body"):
            close({"p"}, P_LIMITS)
        node = Node(tag, attributes)
        open_nodes[-1].children.append(node)
        if tag in RAW:
            at = scanner.at
            end = None if f"</{tag}" in scanner.absent else re.compile(rf"</{re.escape(tag)}\s*+>", re.I).search(html, at)
            if end is None:
                scanner.absent.add(f"</{tag}")
            text = html[at : end.start() if end else n]
            scanner.at = end.end() if end else n
            if tag == "style":
                styles.append(text)
            node.children.append(unescape(text) if tag == "textarea" else text)
        elif tag not in VOID:
            places.setdefault(tag, []).append(len(open_nodes))
            open_nodes.append(node)


@dataclass
class Styles:
    """One-part selectors (tag, .class, #id) that rules of the page remove, hide and show."""

    gone: set[str] = field(default_factory=set)
    seen: dict[str, bool] = field(default_factory=dict)


def page_styles(sheets: list[str]) -> Styles:
    out = Styles()
    for sheet in sheets:
        for rule in sheet.split("}"):
            names, brace, body = rule.rpartition("{")
            if not brace:
                continue
            names = [s.strip().lower() for s in names.rpartition("{")[2].split(",")]
            names = [s for s in names if re.fullmatch(r"[.#]?[\w-]+", s)]
            if _none.search(body):
                out.gone.update(names)
            if found := _visibility.findall(body):
                out.seen.update(dict.fromkeys(names, found[-1].lower() == "visible"))
    return out


def _selectors(node: Node) -> list[str]:
    a = node.attributes
    return [node.tag, *["." + c.lower() for c in a.get("class", "").split()], *(["#" + a["id"].lower()] if "id" in a else [])]


def kept(node: Node, styles: Styles) -> bool:
    """Whether the element takes part in the page at all."""
    a = node.attributes
    if node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a):
        return False
    if "style" in a and _none.search(a["style"]):
        return False
    return not styles.gone or styles.gone.isdisjoint(_selectors(node))


def visible(node: Node, styles: Styles, above: bool) -> bool:
    """Whether the element's own text shows; `above`: whether its parent's does."""
    if "style" in node.attributes and (own := _visibility.findall(node.attributes["style"])):
        return own[-1].lower() == "visible"
    if styles.seen:
        for s in _selectors(node):
            above = styles.seen.get(s, above)
    return above


#: Parts of a drawing that it only refers to or that describe it.
NOT_DRAWN = set("defs symbol clippath mask pattern marker desc metadata title style script".split())


def shown(node: Node, styles: Styles) -> list[Node | str]:
    """The children that a browser shows: of a drawing its texts, of a drop-down list the chosen option (the first if none is), of an open list all."""
    if node.tag not in ("svg", "select"):
        return node.children
    out: list[Node] = []
    todo = list(reversed(node.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str) or child.tag in NOT_DRAWN or not kept(child, styles):
            continue
        if child.tag in (("text", "foreignobject") if node.tag == "svg" else ("option",)):
            out.append(child)
        else:
            todo.extend(reversed(child.children))
    if node.tag == "svg":
        return [part for child in out for part in (" ", child, " ")]
    labelled = [Node("div", o.attributes, [o.attributes["label"]] if o.attributes.get("label") else o.children) for o in out]
    if "multiple" in node.attributes or (node.attributes.get("size") or "1").strip() not in ("0", "1"):
        return labelled
    chosen = [o for o in labelled if "selected" in o.attributes][-1:] or [o for o in labelled if "disabled" not in o.attributes][:1]
    return [Node("span", o.attributes, o.children) for o in chosen]


class Page:
    """Lines being written: of a document or of a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = self.gap = False
        self.indent = 0
        self.marker = ""

    def text(self, text: str) -> None:
        for i, part in enumerate(_space.split(text)):
            self.space |= i > 0
            if part:
                if self.space and self.line:
                    self.line.append(" ")
                self.line.append(part)
                self.space = False

    def end(self) -> None:
        if self.line:
            self.put("".join(self.line))
        self.line, self.space = [], False

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        lead = " " * max(0, min(self.indent, DEEPEST) - len(self.marker)) + self.marker
        self.marker = ""
        self.lines.append(lead + line if line else "")

    def block(self, spaced: bool) -> None:
        self.end()
        self.gap |= spaced and bool(self.lines)


def render(html: str) -> str:
    root, sheets = parse(html)
    styles = page_styles(sheets)
    pages, tables, lists, pre, seen = [Page()], [], [], 0, [True]
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if not seen[-1]:
                continue
            if pre:
                first, *rest = node.split("\n")
                page.line.append(first)
                for line in rest:
                    page.put("".join(page.line))
                    page.line = [line]
            else:
                page.text(node)
            continue
        tag = node.tag
        if not leaving:
            if not kept(node, styles):
                continue
            if tag == "br":
                if page.line:
                    page.end()
                else:
                    page.put("")
                continue
            seen.append(visible(node, styles, seen[-1]))
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(shown(node, styles)))
        else:
            seen.pop()
        if tag in ("td", "th") and tables:
            if not leaving:
                pages.append(Page())
            else:
                page.end()
                pages.pop()
                rows = tables[-1]
                if not rows:
                    rows.append([])
                rows[-1].append((page.lines, _span(node, "colspan", 1000), _span(node, "rowspan", 65_534)))
        elif tag == "tr" and tables:
            if not leaving:
                tables[-1].append([])
        elif tag == "table":
            if not leaving:
                page.block(True)
                tables.append([])
            else:
                page.end()
                for line in aligned(tables.pop()):
                    page.put(line)
                page.gap |= bool(page.lines)
        elif tag in ("ul", "ol", "menu", "dir"):
            if leaving:
                lists.pop()
                page.indent -= 2
            page.block(not lists)
            if not leaving:
                start = node.attributes.get("start", "1")
                lists.append([tag, int(start) if start.isdigit() else 1])
                page.indent += 2
        elif tag == "li":
            page.block(False)
            if not leaving and lists and seen[-1]:
                page.marker = f"{lists[-1][1]}. " if lists[-1][0] == "ol" else "- "
            if not leaving and lists:
                lists[-1][1] += 1
            elif leaving:
                page.marker = ""
        elif tag in ("blockquote", "dd"):
            page.block(tag in SPACED)
            page.indent += -2 if leaving else 2
        elif tag == "pre":
            if leaving:
                page.put("".join(page.line)) if page.line and "".join(page.line) else None
                page.line, page.gap = [], True
                pre -= 1
            else:
                page.block(True)
                pre += 1
        elif tag in BLOCKS:
            page.block(tag in SPACED)
    pages[0].end()
    return "\n".join(pages[0].lines).strip("\n")


def _span(node: Node, name: str, most: int) -> int:
    value = node.attributes.get(name, "1").strip()
    return min(most, max(1, int(value))) if value.isascii() and value.isdigit() and len(value) < 9 else most if value.isascii() and value.isdigit() else 1


def placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, list[str]]]]:
    """Column and lines of each row's cells, from lines, columns and rows that they span: a cell takes the first columns that no cell from above holds."""
    held: dict[int, tuple[int, int]] = {}  # column -> last row that the cell which begins there holds, and its end
    out = []
    for r, row in enumerate(rows):
        at, cells = 0, []
        for lines, width, height in row:
            while at in held and held[at][0] >= r:
                at = held[at][1]
            cells.append((at, lines))
            if height > 1 or at in held:
                held[at] = (r + height - 1, at + width)
            at += width
        out.append(cells)
    return out


def aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """The rows as lines, columns as wide as their widest line, two spaces apart; a cell further than GAP from what precedes it in its line moves up to it."""
    grid = placed(rows)
    widths: dict[int, int] = {}
    for row in grid:
        for column, lines in row:
            if lines:
                widths[column] = max([widths.get(column, 0), *map(len, lines)])
    starts, at = {}, 0
    for column in sorted(c for c, w in widths.items() if w):
        starts[column] = at
        at += widths[column] + 2
    texts = [[(starts[c], lines) for c, lines in row if c in starts] for row in grid]
    heights = [max([0, *(len(lines) for _, lines in row)]) for row in texts]
    out = []
    for height, row in zip(heights, texts, strict=True):
        for k in range(height):
            line, end = [], 0
            for start, lines in row:
                if k < len(lines):
                    gap = min(GAP, start - end)
                    line.append(" " * gap + lines[k])
                    end += gap + len(lines[k])
            out.append("".join(line).rstrip())
    return out


def extract(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """The key and text: the visible text of each whole page."""
    return map_texts(pages.select(key, html), html, "text string", lambda texts: [pa.array([render(t) for t in texts], pa.string())]).drop(html)
