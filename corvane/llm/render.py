"""Visible text of HTML pages, laid out as a reader sees it.

A tree builder reads tags in any state of repair: start tags close what they imply
(a paragraph before a block, an item before the next item, cells and rows, options,
terms), unknown end tags are ignored, and what is open at the end is closed. Elements
that aren't shown are left out: head matter, scripts, styles, templates, comments,
the ``hidden`` attribute, hidden inputs, and elements hidden by an inline style or by a
``display:none`` or ``visibility:hidden`` rule of the page for a tag, class or id. Of
the rules for a selector the last one that sets a property holds, unless an earlier one
is ``!important``; rules in blocks for print or under other conditions are left out.

Blocks stand on lines of their own, with a blank line around paragraphs, headings,
lists, quotes, preformatted text and tables. List items carry ``- `` or their number and
are indented by depth; preformatted text keeps its spaces. Cells of a table are aligned
in columns, spans taken into account, with two spaces between them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from corvane.llm.common import map_rows

# Elements by the role they have here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style title template noscript iframe noembed noframes object audio video canvas "
    "datalist param source track meta link base area map".split())
UNDRAWN = frozenset(  # in SVG and MathML
    "defs symbol desc metadata clippath mask marker pattern lineargradient radialgradient filter "
    "annotation annotation-xml".split())
SPACED = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu".split())
BLOCK = SPACED | frozenset(
    "html body address article aside center details dialog dd dir div dt figcaption footer form header "
    "hgroup legend li main nav section summary caption optgroup option tr".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
# Start tag -> (elements it closes, elements that shut them off).
_LISTS, _TABLE = frozenset(("ul", "ol", "menu", "dir")), frozenset(("table",))
IMPLIED = {
    "li": (frozenset(("li",)), _LISTS),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th", "caption")), _TABLE | {"tr"}),
    "th": (frozenset(("td", "th", "caption")), _TABLE | {"tr"}),
    "tr": (frozenset(("td", "th", "tr", "caption", "colgroup")), _TABLE),
    "thead": (frozenset(("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup")), _TABLE),
    "tbody": (frozenset(("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup")), _TABLE),
    "tfoot": (frozenset(("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup")), _TABLE),
    "body": (frozenset(("head",)), frozenset()),
}
HEAD_ONLY = frozenset("base link meta title style script noscript template head html".split())
P_SCOPE = frozenset(("button", "td", "th", "caption", "table", "object", "template", "body"))
END_SCOPE = frozenset(("td", "th", "table", "caption"))

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
ASKED = re.compile(r"hidden|style|class|id|type|colspan|start|value|alt|media", re.I)
CSS = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:\\.|[^\"\\\n])*\"|'(?:\\.|[^'\\\n])*'|[{};]|[^{};/\"']+|.", re.S)
ON_SCREEN = re.compile(r"@media\s+(?:only\s+)?(?:screen|all)\s*|@layer\b.*|@media\s*", re.I | re.S)
SETS = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([\w-]+)[^;!]*(!\s*important)?", re.I)
HIDES = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
SIMPLE = re.compile(r"[.#]?[\w-]+")
BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _attributes(source: str) -> dict[str, str]:
    if not ASKED.search(source):
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)}


def _holds(at_rule: str) -> bool:
    """Whether the block of an at-rule holds on every screen."""
    if at_rule[:6].lower() != "@media":
        return ON_SCREEN.fullmatch(at_rule) is not None
    first, *more = at_rule[6:].split(",")
    return any(ON_SCREEN.fullmatch("@media " + query.strip()) for query in (first, *more))


def collect_rules(sheet: str, values: dict[tuple[str, str], tuple[str, bool]]) -> None:
    """Adds display and visibility of the sheet's simple selectors to ``values``, as
    (selector, property) -> (value, important). What is open at the end is closed."""
    # Open blocks: selectors, or "" of an at-rule; whether it holds; declarations before it.
    blocks: list[tuple[str, bool, str]] = []
    body = ""

    def end_block() -> None:
        selectors, holds, _ = blocks[-1]
        if not selectors or not holds:
            return
        for selector in (x.strip() for x in selectors.split(",")):
            if SIMPLE.fullmatch(selector):
                for name, value, important in SETS.findall(body):
                    key = selector.lower(), name.lower()
                    if important or not values.get(key, ("", False))[1]:
                        values[key] = value.lower(), bool(important)

    for m in CSS.finditer(sheet):
        piece = m[0]
        if piece.startswith("/*"):
            continue
        if piece == "{":
            holds = not blocks or blocks[-1][1]
            inside = bool(blocks and blocks[-1][0])  # a rule nested in a rule
            before, _, head = body.rpartition(";") if inside else ("", "", body)
            head, body = head.strip(), ""
            if head.startswith("@"):
                blocks.append(("", holds and not inside and _holds(head), before))
            else:
                blocks.append((head or "*", holds and not inside, before))
        elif piece == "}":
            if blocks:
                end_block()
            before = blocks.pop()[2] if blocks else ""
            body = before + ";" if blocks and blocks[-1][0] else ""
        elif piece == ";" and not (blocks and blocks[-1][0]):
            body = ""  # the end of @import and the like
        else:
            body += piece
    while blocks:
        end_block()
        body = blocks.pop()[2]


def build(page: str) -> tuple[Node, set[str]]:
    """The tree of a page and the simple selectors its style rules hide."""
    root = Node("#root", {})
    stack, values = [root], {}
    lowered = None

    def close(tags: frozenset[str], stop: frozenset[str]) -> None:
        """Close the outermost open element of ``tags`` inside the nearest of ``stop``."""
        found = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in stop:
                break
            if stack[i].tag in tags:
                found = i
        if found:
            del stack[found:]

    at, size = 0, len(page)
    while at < size:
        m = MARKUP.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            text = page[at:m.start()]
            if stack[-1].tag == "head" and text.strip():
                stack.pop()
            stack[-1].children.append(text)
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            if tag == "br":
                stack[-1].children.append(Node("br", {}))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in END_SCOPE and tag not in ("table", "tr", "thead", "tbody", "tfoot"):
                    break
                if stack[i].tag == "table":
                    break
        elif m[2]:
            tag = m[2].lower()
            if stack[-1].tag == "head" and tag not in HEAD_ONLY:
                stack.pop()
            if tag in CLOSES_P:
                close(frozenset(("p",)), P_SCOPE)
            if tag in IMPLIED:
                close(*IMPLIED[tag])
            node = Node(tag, _attributes(m[3]))
            if tag in UNDRAWN and any(n.tag in ("svg", "math") for n in stack):
                node.attributes["hidden"] = ""
            stack[-1].children.append(node)
            if tag in RAW:
                if lowered is None:
                    lowered = page.lower() if len(page.lower()) == size else page
                end = lowered.find(f"</{tag}", at)
                end = size if end < 0 else end
                if tag == "style":
                    if _holds(f"@media {node.attributes.get('media', '')}"):
                        collect_rules(page[at:end], values)
                elif tag in ("textarea", "xmp"):
                    node.children.append(page[at:end])
                close_at = page.find(">", end)
                at = size if close_at < 0 or end == size else close_at + 1
            elif tag not in VOID and not m[3].rstrip().endswith("/"):
                stack.append(node)
            elif tag not in VOID:
                stack.append(node)  # HTML ignores the slash of elements with content
    hidden = {selector for (selector, name), (value, _) in values.items()
              if (name, value) in (("display", "none"), ("visibility", "hidden"))}
    return root, hidden


def shown(node: Node, hidden: set[str]) -> bool:
    tag, a = node.tag, node.attributes
    if tag in UNSEEN or tag in hidden:
        return False
    if not a:
        return True
    if "hidden" in a or (tag == "input" and a.get("type", "").lower() == "hidden"):
        return False
    if "style" in a and HIDES.search(a["style"]):
        return False
    if hidden and ("#" + a.get("id", "").lower() in hidden
                   or any("." + c.lower() in hidden for c in a.get("class", "").split())):
        return False
    return True


class Lines:
    """Text laid out in lines; spaces are collapsed outside preformatted text."""

    def __init__(self):
        self.lines: list[str] = []
        self.open = ""          # the line in work
        self.gap = 0            # blank lines owed before the next text
        self.marker = ""        # list marker that stands before the next text
        self.indent = ""

    def text(self, body: str) -> None:
        body = BLANKS.sub(" ", html.unescape(body) if "&" in body else body)
        if not self.open or self.open[-1] == " ":
            body = body.lstrip(" ")
        if body:
            self.open += body

    def preformatted(self, body: str) -> None:
        first, *more = html.unescape(body).replace("\r\n", "\n").split("\n")
        self.open += first
        for line in more:
            self.end_line(keep=True)
            self.open = line

    def end_line(self, keep: bool = False) -> None:
        line = self.open if keep else self.open.strip(" ")
        self.open = ""
        if not line.strip() and not keep:
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = 0
        before = self.indent
        if self.marker:
            before = self.indent[:max(0, len(self.indent) - len(self.marker))] + self.marker
            self.marker = ""
        self.lines.append((before + line).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced:
            self.gap = 1


def _number(value: str | None, otherwise: int) -> int:
    digits = (value or "").strip()
    return int(digits) if re.fullmatch(r"-?\d{1,6}", digits) else otherwise


def _table_lines(rows: list[list[tuple[list[str], int]]]) -> list[str]:
    """Rows of (cell lines, column span) in aligned columns."""
    widths: list[int] = []
    for row in rows:
        at = 0
        for lines, span in row:
            widths += [0] * (at + span - len(widths))
            if span == 1:
                widths[at] = max([widths[at], *map(len, lines)])
            at += span
    for row in rows:  # wide cells stretch the last column they span
        at = 0
        for lines, span in row:
            room = sum(widths[at:at + span]) + 2 * (span - 1)
            widths[at + span - 1] += max(0, max([0, *map(len, lines)]) - room)
            at += span
    out = []
    for row in rows:
        for i in range(max([0, *(len(lines) for lines, _ in row)])):
            at, pieces = 0, []
            for lines, span in row:
                room = sum(widths[at:at + span]) + 2 * (span - 1)
                pieces.append((lines[i] if i < len(lines) else "").ljust(room))
                at += span
            out.append("  ".join(pieces).rstrip())
    return out


def render(page: str | None) -> str:
    """Visible text of a page; null and empty pages give an empty text."""
    root, hidden = build(page or "")
    out = Lines()
    outer: list[Lines] = []                  # layouts that wait for a cell to end
    lists: list[list] = []                   # [kind, next number, indent before]
    tables: list[list] = []                  # rows of each open table
    pre = 0
    todo: list[tuple[bool, Node | str]] = [(True, root)]
    while todo:
        entering, node = todo.pop()
        if isinstance(node, str):
            if pre:
                out.preformatted(node)
            else:
                out.text(node)
            continue
        tag = node.tag
        if entering:
            if not shown(node, hidden):
                continue
            if tag == "br":
                if out.open.strip() or pre:
                    out.end_line(keep=bool(pre))
                continue
            if tag == "img":
                if node.attributes.get("alt"):
                    out.text(html.escape(node.attributes["alt"]))
                continue
            if tag == "input":
                kind = node.attributes.get("type", "text").lower()
                if kind in ("submit", "button", "reset", "text"):
                    out.text(html.escape(node.attributes.get("value", "")))
                continue
            todo.append((False, node))
            if tag in ("td", "th") and tables:
                outer.append(out)
                out = Lines()
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in BLOCK:
                out.block(tag in SPACED and not (lists and tag in _LISTS))
            if tag == "table":
                tables.append([])
            elif tag in _LISTS:
                lists.append([tag, _number(node.attributes.get("start"), 1), out.indent])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1, out.indent]
                if kind[0] == "ol":
                    kind[1] = _number(node.attributes.get("value"), kind[1])
                    out.marker = f"{kind[1]}. "
                    kind[1] += 1
                else:
                    out.marker = "- "
                node.attributes = {"indent": out.indent}
                out.indent += " " * len(out.marker)
            elif tag in ("blockquote", "dd"):
                node.attributes = {"indent": out.indent}
                out.indent += "  "
            elif tag == "pre":
                pre += 1
            todo.extend((True, child) for child in reversed(node.children))
            continue
        if tag in ("td", "th") and tables:
            out.end_line()
            lines, out = out.lines, outer.pop()
            if not tables[-1]:
                tables[-1].append([])
            span = min(1000, max(1, _number(node.attributes.get("colspan"), 1)))
            tables[-1][-1].append((lines, span))
            continue
        if tag == "table":
            rows = _table_lines(tables.pop())
            out.block(True)
            for line in rows:
                out.open = line
                out.end_line(keep=True)
        elif tag in _LISTS and lists:
            out.end_line()
            out.indent = lists.pop()[2]
        elif tag in ("li", "blockquote", "dd"):
            out.end_line()
            out.indent, out.marker = node.attributes["indent"], ""
        elif tag == "pre":
            if out.open:
                out.end_line(keep=True)
            pre -= 1
        if tag in BLOCK and tag != "tr":
            out.block(tag in SPACED and not (lists and tag in _LISTS))
        elif tag == "tr" and not tables:
            out.block(False)
    out.end_line()
    return "\n".join(out.lines).strip("\n")


def extract(pages: DataFrame, markup: str = "html") -> DataFrame:
    """``pages`` without ``markup``, with ``text`` and ``n_chars`` (code points).

    One row for each page, repeated ones too. Columns named text or n_chars are replaced.
    """
    rest = [c for c in pages.columns if c not in (markup, "text", "n_chars")]
    schema = pages.select(*[F.col(f"`{c}`") for c in rest], F.lit("").alias("text"),
                          F.lit(0).cast("bigint").alias("n_chars")).schema

    def rows(part: dict[str, list]) -> Iterator[tuple]:
        for *row, page in zip(*part.values()):
            text = render(page)
            yield (*row, text, len(text))

    return map_rows(pages.select(*[F.col(f"`{c}`") for c in rest], F.col(markup).alias("html_")),
                    schema, rows, 64)
