"""Visible text of HTML pages, laid out as a browser would.

A tokenizer feeds a tree builder that keeps the stack of open elements: it supplies end tags that
HTML lets authors leave out (p, li, dt, dd, options, table parts), opens missing table parts, and
knows which subtrees are not displayed. The elements it opens and closes drive the layout: blocks
start lines, paragraphs keep a blank line, list items get markers and indents, preformatted text
keeps its white space, and table cells are set in aligned columns.

Every step is one pass over the page without recursion, so a page of any size or depth costs
time in proportion to its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.stages import raw_bytes

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())
UNSEEN = frozenset("head script style template title iframe noembed noframes noscript datalist object audio video canvas svg math".split())
HEAD = frozenset("base link meta noscript script style template title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table figure hr fieldset listing xmp".split())
BLOCK = SPACED | frozenset(
    "address article aside body center details dialog dir div dd dt figcaption footer form header hgroup html legend li "
    "main nav optgroup option search section select summary textarea caption".split())
CLOSES_P = BLOCK - frozenset("body html option optgroup select textarea legend caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARTS = frozenset("thead tbody tfoot".split())
CELLS = frozenset("td th".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
WALL = frozenset("table td th caption template button object html".split())

OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
BETWEEN, NAME, EQUALS, BARE = (re.compile(p) for p in (r"[\s/]*+", r"=?[^\s/>=]*+\s*+", r"=\s*+", r"[^\s>]*+"))
NOT_SHOWN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
HINT = re.compile(r"hidden|style|type", re.I)
SPACE = re.compile(r"[ \t\n\r\f]+")
NUMBER = re.compile(r"\s*[+-]?\d+")
DEEPEST = 64  # no deeper indents
ALIGN = 80  # a longer cell doesn't widen its column


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag, the first of each name."""
    out: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), unescape(double or single or bare))
    return out


def _whole(value: str | None, default: int) -> int:
    found = NUMBER.match(value or "")
    return int(found[0][:12]) if found else default


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("start", name, attribute source) and ("end", name, "") in order."""
    at, size, unpaired = 0, len(html), set()

    def tag_end(at: int) -> int:
        """The end of a tag, attribute by attribute: a quote delimits a value only directly after the equals sign."""
        while (at := BETWEEN.match(html, at).end()) < size:
            if html[at] == ">":
                return at
            at = NAME.match(html, at).end()
            if html.startswith("=", at):
                at = EQUALS.match(html, at).end()
                quote = html[at:at + 1]
                if quote in ('"', "'") and quote not in unpaired:
                    if (close := html.find(quote, at + 1)) >= 0:
                        at = close + 1
                        continue
                    unpaired.add(quote)
                at = BARE.match(html, at).end()
        return -1

    while at < size:
        less = html.find("<", at)
        if less < 0:
            yield "text", "", html[at:]
            return
        if less > at:
            yield "text", "", html[at:less]
        if found := OPEN.match(html, less):
            stop = tag_end(found.end())
            if stop < 0:
                return
            name, at = found[2].lower(), stop + 1
            if found[1]:
                yield "end", name, ""
                continue
            yield "start", name, html[found.end():stop]
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                end = close.start() if close else size
                yield "text", "", html[at:end]
                at = end
        elif html.startswith("<!--", less):
            stop = html.find("-->", less + 2)
            at = size if stop < 0 else stop + 3
        elif html.startswith(("<!", "<?", "</"), less):
            stop = html.find(">", less)
            at = size if stop < 0 else stop + 1
        else:
            yield "text", "", "<"
            at = less + 1


class _Flow:
    """Lines of text in blocks."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap, self.space, self.indent, self.marker = 0, False, "", ""

    def _begin(self) -> None:
        if self.gap > 1 and self.lines:
            self.lines.append("")
        self.gap, self.space = 0, False
        self.line.append(self.indent[:max(0, len(self.indent) - len(self.marker))] + self.marker)
        self.marker = ""

    def text(self, text: str) -> None:
        plain = SPACE.sub(" ", text)
        words = plain.strip(" ")
        if not words:
            self.space = self.space or bool(self.line)
            return
        if not self.line:
            self._begin()
        elif self.space or plain[0] == " ":
            self.line.append(" ")
        self.line.append(words)
        self.space = plain[-1] == " "

    def kept(self, text: str) -> None:
        """Text with its white space."""
        first, *others = text.replace("\r\n", "\n").split("\n")
        for i, piece in enumerate((first, *others)):
            if i:
                if not self.line:
                    self._begin()
                self.finish()
            if piece:
                if not self.line:
                    self._begin()
                self.line.append(piece)

    def finish(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.space = False

    def apart(self, gap: int) -> None:
        self.finish()
        self.gap = max(self.gap, gap)

    def next_line(self) -> None:
        gap = 1 if self.line else 2
        self.apart(gap)

    def set_lines(self, lines: list[str]) -> None:
        """Lines laid out elsewhere."""
        for line in lines:
            self._begin()
            self.line.append(line)
            self.finish()


class _Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.captions: list[str] = []

    def laid_out(self) -> list[str]:
        """Rows with the cells of a column below each other; spanning cells keep their columns free."""
        taken: dict[int, int] = {}  # column -> rows still covered from above
        placed, widths = [], {}
        for row in self.rows:
            column, cells = 0, []
            for lines, across, down in row:
                while taken.get(column, 0):
                    column += 1
                cells.append((column, lines))
                if down > 1:
                    taken.update(dict.fromkeys(range(column, column + across), down))
                if across == 1:
                    short = [len(x) for x in lines if len(x) <= ALIGN]
                    widths[column] = max(widths.get(column, 0), *short, 0) if short else widths.get(column, 0)
                column += across
            taken = {c: d - 1 for c, d in taken.items() if d > 1}
            placed.append(cells)
        starts, at = {}, 0
        for column in sorted({c for cells in placed for c, _ in cells} | set(widths)):
            starts[column] = at
            at += widths.get(column, 0) + 2 * (widths.get(column, 0) > 0)
        out = list(self.captions)
        for cells in placed:
            for i in range(max((len(lines) for _, lines in cells), default=0)):
                text = ""
                for column, lines in cells:
                    if i < len(lines) and lines[i]:
                        text = (text + "  " if text and len(text) > starts[column] - 2 else text).ljust(starts[column]) + lines[i]
                out.append(text.rstrip(" "))
        return out


class Layout:
    """Tree builder and layout of one page."""

    def __init__(self) -> None:
        self.open: list[str] = []
        self.states: list[tuple[bool, bool]] = []  # hides its content, was laid out
        self.count: dict[str, int] = {}
        self.hidden = self.kept = 0
        self.flow = _Flow()
        self.frames: list[tuple[_Flow, _Table]] = []
        self.cells: list[tuple[int, int]] = []
        self.lists: list[tuple[str, list[int]]] = []
        self.items: list[tuple[str, str]] = []
        self.after_pre = False

    # -- elements ----------------------------------------------------------
    def push(self, name: str, source: str = "") -> None:
        given = attributes(source) if source and (HINT.search(source) or name in ("td", "th", "ol", "li", "details", "dialog")) else {}
        hide = name in UNSEEN or "hidden" in given or bool(NOT_SHOWN.search(given.get("style", ""))) \
            or name == "dialog" and "open" not in given
        if name in VOID:
            if not self.hidden and not hide:
                if name == "br":
                    self.flow.kept("\n") if self.kept else self.flow.next_line()
                elif name == "hr":
                    self.flow.apart(2)
            return
        self.hidden += hide
        self.open.append(name)
        self.states.append((hide, not self.hidden))
        self.count[name] = self.count.get(name, 0) + 1
        if not self.hidden:
            self.entered(name, given)

    def pop(self) -> None:
        name, (hide, shown) = self.open.pop(), self.states.pop()
        self.count[name] -= 1
        self.hidden -= hide
        if shown:
            self.left(name)

    def close_to(self, names: frozenset[str], wall: frozenset[str]) -> bool:
        """End the innermost open element of these names and all inside it, unless a wall stands between."""
        if not any(self.count.get(n) for n in names):
            return False
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] in names:
                while len(self.open) > i:
                    self.pop()
                return True
            if self.open[i] in wall:
                return False
        return False

    def start(self, name: str, source: str) -> None:
        if self.count.get("head") and name not in HEAD and name not in ("html", "head"):
            self.close_to(frozenset(("head",)), frozenset())
        if name in ("html", "body", "head"):
            if self.count.get(name) or name == "head" and self.open not in ([], ["html"]):
                return
        elif name in CLOSES_P:
            self.close_to(frozenset("p"), WALL)
        if name in HEADINGS and self.open and self.open[-1] in HEADINGS:
            self.pop()
        elif name == "li":
            self.close_to(frozenset(("li",)), WALL | {"ul", "ol", "menu"})
        elif name in ("dt", "dd"):
            self.close_to(frozenset(("dt", "dd")), WALL | {"dl"})
        elif name in ("option", "optgroup"):
            self.close_to(frozenset(("option", name)), WALL | {"select", "datalist"})
        elif name in CELLS or name == "tr" or name in PARTS or name in ("caption", "colgroup"):
            if not self.count.get("table"):
                return
            inside = frozenset(("table", "template"))
            self.close_to(CELLS | {"caption", "colgroup"}, inside)
            if name not in CELLS:
                self.close_to(frozenset(("tr",)), inside)
                if name != "tr":
                    self.close_to(PARTS, inside)
            elif self.open[-1] != "tr":
                self.start("tr", "")
            if name == "tr" and self.open[-1] == "table":
                self.push("tbody")
        self.push(name, source)

    def end(self, name: str) -> None:
        if name == "br" or name == "p" and not self._within("p"):
            if name == "p":
                self.start("p", "")
                self.pop()
            else:
                self.push("br")
        elif name in ("body", "html"):
            return  # what follows still belongs to the body
        elif name in HEADINGS:
            self.close_to(HEADINGS, WALL)
        elif name in BLOCK or name in CELLS or name in PARTS or name in ("tr", "table", "caption", "template", "button", "object", "head"):
            self.close_to(frozenset((name,)), frozenset(("table",)) - {name} if name not in ("template", "head") else frozenset())
        elif self.count.get(name):
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i] == name:
                    if i == len(self.open) - 1:
                        self.pop()
                    elif name in FORMATTING:  # may overlap blocks: ends alone
                        del self.open[i]
                        self.hidden -= self.states.pop(i)[0]
                        self.count[name] -= 1
                    else:
                        while len(self.open) > i:
                            self.pop()
                    return
                if self.open[i] in WALL or self.open[i] in BLOCK and name not in FORMATTING:
                    return

    def _within(self, name: str) -> bool:
        if not self.count.get(name):
            return False
        for tag in reversed(self.open):
            if tag == name:
                return True
            if tag in WALL:
                return False
        return False

    def text(self, text: str) -> None:
        if self.open and self.open[-1] == "head" and text.strip(" \t\r\n\f"):
            self.pop()
        if self.hidden or self.open and (self.open[-1] in ("table", "tr") or self.open[-1] in PARTS) and not text.strip():
            return
        text = unescape(text) if "&" in text else text
        if self.kept:
            self.flow.kept(text[1:] if self.after_pre and text[:1] == "\n" else text)
        else:
            self.flow.text(text)
        self.after_pre = False

    # -- layout ------------------------------------------------------------
    def entered(self, name: str, given: dict[str, str]) -> None:
        flow = self.flow
        if name in BLOCK:
            nested = name in ("ul", "ol", "menu") and bool(self.lists)
            flow.apart(2 if name in SPACED and not nested else 1)
        if name in ("pre", "textarea", "listing", "xmp"):
            self.kept += 1
            self.after_pre = True
        elif name in ("ul", "ol", "menu"):
            step = -1 if "reversed" in given else 1
            self.lists.append((name, [_whole(given.get("start"), 1), step]))
        elif name == "li":
            mark = "- "
            if self.lists and self.lists[-1][0] == "ol":
                count = self.lists[-1][1]
                count[0] = _whole(given.get("value"), count[0])
                mark = f"{count[0]}. "
                count[0] += count[1]
            self.items.append((flow.indent, flow.marker))
            flow.marker = flow.marker + mark if flow.marker else mark
            flow.indent += " " * (len(mark) if len(flow.indent) < DEEPEST else 0)
        elif name in ("dd", "blockquote"):
            self.items.append((flow.indent, ""))
            flow.indent += "  " if len(flow.indent) < DEEPEST else ""
        elif name == "table":
            self.frames.append((flow, _Table()))
        elif name == "tr" and self.frames:
            self.frames[-1][1].rows.append([])
        elif (name in CELLS or name == "caption") and self.frames:
            self.cells.append((min(1000, max(1, _whole(given.get("colspan"), 1))), max(1, _whole(given.get("rowspan"), 1))))
            self.flow = _Flow()
        elif name == "q":
            flow.text("“")

    def left(self, name: str) -> None:
        if name in ("pre", "textarea", "listing", "xmp"):
            self.kept -= 1
        elif name in ("ul", "ol", "menu") and self.lists:
            nested = len(self.lists) > 1
            self.lists.pop()
            self.flow.apart(1 if nested else 2)
            return
        elif name in ("li", "dd", "blockquote"):
            self.flow.finish()
            if self.items:
                self.flow.indent, self.flow.marker = self.items.pop()[0], ""
        elif name == "table" and self.frames:
            self.flow.finish()
            self.flow, table = self.frames.pop()
            self.flow.apart(2)
            self.flow.set_lines(table.laid_out())
        elif (name in CELLS or name == "caption") and self.frames and self.cells:
            self.flow.finish()
            table, span, lines = self.frames[-1][1], self.cells.pop(), self.flow.lines
            if name == "caption":
                table.captions += lines
            else:
                if not table.rows:
                    table.rows.append([])
                table.rows[-1].append((lines, *span))
            self.flow = self.frames[-1][0]
        elif name == "q":
            self.flow.line.append("”") if self.flow.line else self.flow.text("”")
        if name in BLOCK:
            self.flow.apart(2 if name in SPACED else 1)

    def page(self, html: str) -> str:
        for kind, name, rest in tokens(html):
            if kind == "text":
                self.text(rest)
            elif kind == "start":
                self.start(name, rest)
            else:
                self.end(name)
        while self.open:
            self.pop()
        self.flow.finish()
        return "\n".join(self.flow.lines)


@F.arrow_udf(T.StringType())
def _rendered(pages: pa.Array) -> pa.Array:
    return pa.array([Layout().page(raw_bytes(p).decode(errors="replace")) if p.is_valid else None for p in pages], pa.string())


def rendered(html: Column) -> Column:
    """Visible text of a page. Null stays null; a page without visible text gives the empty string."""
    return _rendered(html)


def extract(pages: DataFrame) -> DataFrame:
    """The rows of ``pages`` (html and others) with ``text``; a column of that name is replaced.

    Not displayed are: head, scripts, styles, templates, embedded documents and media, elements
    with a hidden attribute or an inline style that hides them, and closed dialogs. Style sheets
    are not applied: what only a class hides is shown. Broken markup
    never fails: unknown tags are inline, unmatched end tags are ignored, an unfinished tag or
    comment at the end is dropped. Repeated rows give equal texts; an empty table no rows.
    """
    return pages.withColumn("text", rendered(F.col("html")))
