"""Visible text of HTML, laid out in lines, lists and aligned tables.

A tokenizer cuts the page into tags and text; a tree builder adds the tags that HTML
implies (a paragraph ends where a block begins, a list item where the next one begins, a
cell, row or table section likewise, a head at the first thing that may not stand in it)
and closes what an end tag leaves open; visibility rules drop what browsers do not show,
in svg and math too; the renderer keeps block spacing, list markers and
indents, preformatted text, and pads table cells to columns. The builder hands open and
close events to the renderer, so pages of any depth need no recursion.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html import unescape
from itertools import accumulate
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import rows_of, schema_with, with_text_bytes

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their content is not markup; it ends at their own end tag.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style title head template noscript iframe noembed noframes object audio video canvas datalist".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr xmp".split())
BLOCKS = PARAGRAPHS | frozenset(
    "html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li main menu nav option "
    "optgroup search section summary caption tr".split()
)
#: What a start tag closes, up to the elements that bound it.
_SCOPE = frozenset("table td th caption html template button".split())
_CLOSES = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split()) | _SCOPE),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"]) | _SCOPE),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"]) | _SCOPE),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup".split()) | _SCOPE),
    "optgroup": (frozenset("option optgroup".split()), frozenset("select".split()) | _SCOPE),
    "td": (frozenset("td th".split()), frozenset("tr table template".split())),
    "th": (frozenset("td th".split()), frozenset("tr table template".split())),
    "tr": (frozenset("tr caption".split()), frozenset("table template".split())),
    "tbody": (frozenset("thead tbody tfoot caption".split()), frozenset("table template".split())),
    "thead": (frozenset("thead tbody tfoot caption".split()), frozenset("table template".split())),
    "tfoot": (frozenset("thead tbody tfoot caption".split()), frozenset("table template".split())),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
_END_SCOPE = frozenset("table td th template html".split())
#: All that a head may hold; any other start tag ends it.
_IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript noframes template".split())
#: Elements of svg and math that hold HTML again.
_HTML_IN = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
#: Start tags of HTML that end an open svg or math.
_LEAVES_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span "
    "strong strike sub sup table tt u ul var".split()
)
#: What svg and math hold without showing it. Letters of svg show in text and foreignObject only.
_UNSEEN_IN = {
    "svg": frozenset("title desc metadata defs symbol style script clippath mask marker pattern lineargradient radialgradient filter".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
#: Foreign elements that stand apart from the text before and after.
_APART = frozenset("svg text foreignobject mtr mtd".split())

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<[!?][^>]*>?|</[^A-Za-z>][^>]*>?"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.IGNORECASE)
_UNSHOWN = re.compile(r"(?:^|\s)(?:display\s*=\s*[\"']?none|visibility\s*=\s*[\"']?(?:hidden|collapse))", re.IGNORECASE)
_VALUE_TO_END = re.compile(r"=\s*[^\s\"']*\Z")
_BLANK = re.compile(r"[ \t\n\r\f]+")


def tokens(page: str, foreign: Callable[[], bool]) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("open", tag, attributes) and ("close", tag, "").

    ``foreign`` says whether the element opened last and still open belongs to svg or
    math, where no element is raw and CDATA is text.
    """
    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if not m:
            yield "text", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at, tag = m.end(), (m["tag"] or "").lower()
        if page.startswith("<![CDATA[", m.start()) and foreign():
            stop = page.find("]]>", m.start())
            yield "text", "", page[m.start() + 9 : stop if stop >= 0 else end].replace("&", "&amp;")
            at = stop + 3 if stop >= 0 else end
            continue
        if tag and m["end"]:
            yield "close", tag, ""
        elif tag:
            yield "open", tag, m["rest"]
            if tag in RAW and not foreign():
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
                yield "raw", tag, page[at : stop.start() if stop else end]
                at = stop.start() if stop else end


def hidden(tag: str, rest: str) -> bool:
    """True for elements that are not shown."""
    if tag in UNSEEN:
        return True
    if not rest or rest.isspace():
        return False
    for name, *values in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), "".join(values)
        if name == "hidden" or name == "style" and _HIDDEN.search(unescape(value)) or tag == "input" and name == "type" and value.lower() == "hidden":
            return True
    return False


def self_closing(rest: str) -> bool:
    """True if a start tag ends in a slash that is not part of an unquoted value."""
    return rest.endswith("/") and not _VALUE_TO_END.search(rest)


def width_of(text: str) -> int:
    """Columns a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of one flow of blocks: the page, a list item or a cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.words: list[str] = []
        self.gap = 0  # blank lines owed before the next line
        self.blank = False  # white space owed before the next word

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *more = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.words.append(first)
            for line in more:
                self.end_line(keep=True)
                self.words.append(line)
            return
        parts = _BLANK.split(text)
        if not parts[0] and len(parts) > 1:
            self.blank = True
        body = " ".join(p for p in parts if p)
        if body:
            if self.blank and self.words and not self.words[-1].endswith(" "):
                self.words.append(" ")
            self.words.append(body)
            self.blank = len(parts) > 1 and not parts[-1]

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.words)
        self.words, self.blank = [], False
        if not keep:
            line = line.strip(" ")
        if line or keep:
            self.emit([line])

    def emit(self, lines: list[str]) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        self.lines += lines

    def result(self) -> list[str]:
        self.end_line()
        return self.lines


def attributes(rest: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; of equal names the first counts."""
    return {name.lower(): "".join(values) for name, *values in reversed(_ATTRIBUTE.findall(rest))}


def reach(value: str, most: int) -> int | None:
    """The whole number an attribute starts with, at most ``most``; None without one."""
    digits = re.match(r"[ \t\r\n\f]*\+?([0-9]+)", value)
    return min(most, int(digits[1][:9])) if digits else None


@dataclass(frozen=True)
class Cell:
    """``wide`` columns by ``deep`` rows; 0 rows reach to the end of the section."""

    lines: list[str]
    wide: int
    deep: int


class Table:
    def __init__(self) -> None:
        self.rows: list[list[Cell]] = []
        self.sections: set[int] = set()  # rows that begin one
        self.caption: list[str] = []

    def placed(self) -> list[list[tuple[int, Cell]]]:
        """Cells of each row with their first column, which is the next that no cell of a row above reaches into.

        No cell reaches past its section. Cells that overlap because of their width stay where they begin.
        """
        out: list[list[tuple[int, Cell]]] = []
        free_from: list[float] = []  # by column, the row from which no earlier cell is in it
        for number, row in enumerate(self.rows):
            if number in self.sections:
                free_from = []
            column, cells = 0, []
            for cell in row:
                while column < len(free_from) and free_from[column] > number:
                    column += 1
                free_from += [0] * (column + cell.wide - len(free_from))
                if cell.deep != 1:
                    below = number + cell.deep if cell.deep else inf
                    for k in range(column, column + cell.wide):
                        free_from[k] = max(free_from[k], below)
                cells.append((column, cell))
                column += cell.wide
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        """Cells side by side, padded to the width of their column; a cell of several lines stays beside the first row it is in."""
        rows = self.placed()
        widths: list[int] = []
        for row in rows:
            for column, cell in row:
                widths += [0] * (column + cell.wide - len(widths))
                if cell.wide == 1:
                    widths[column] = max([widths[column], *map(width_of, cell.lines)])
        begins = [0, *accumulate(w + 2 for w in widths)]
        out = list(self.caption)
        for row in rows:
            for k in range(max((len(cell.lines) for _, cell in row), default=0)):
                line, at = [], 0
                for column, cell in row:
                    text = cell.lines[k] if k < len(cell.lines) else ""
                    if text:
                        gap = max(begins[column] - at, 2 if at else 0)
                        line += [" " * gap, text]
                        at += gap + width_of(text)
                out.append("".join(line).rstrip(" "))
        return out


class Renderer:
    """Open and close events to text. Each open element holds what it does on closing."""

    def __init__(self) -> None:
        self.flows = [Flow()]
        self.tables: list[Table] = []
        self.lists: list[list[int | None]] = []
        self.unseen = 0
        self.kept = 0
        self.fresh = False  # a line end right after <pre> is not shown
        self.lettered = True  # false inside svg, outside its text
        self.outer: list[bool] = []

    def text(self, text: str) -> None:
        if not self.unseen and self.lettered:
            if self.fresh:
                text = text.removeprefix("\r\n").removeprefix("\n")
            self.fresh = False
            self.flows[-1].text(unescape(text) if "&" in text else text, self.kept > 0)

    def open(self, tag: str, rest: str) -> bool:
        """True if the element is not shown."""
        if self.unseen or hidden(tag, rest):
            self.unseen += tag not in VOID
            return True
        flow = self.flows[-1]
        if tag == "br":
            if flow.words or self.kept:
                flow.end_line(keep=self.kept > 0)
            elif flow.lines and not flow.gap:
                flow.emit([""])
        elif tag in BLOCKS:
            flow.end_line()
            if tag in PARAGRAPHS and not (tag in ("ul", "ol", "dl") and self.lists):
                flow.gap = 1
        if tag == "table":
            self.tables.append(Table())
        elif tag in ("ul", "ol", "menu"):
            start = attributes(rest).get("start", "")
            self.lists.append([int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1] if tag == "ol" else [None])
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("thead", "tbody", "tfoot") and self.tables:
            self.tables[-1].sections.add(len(self.tables[-1].rows))
        elif tag in ("li", "td", "th", "caption", "dd", "blockquote"):
            self.flows.append(Flow())
        if tag in ("pre", "textarea", "xmp"):
            self.kept += 1
        self.fresh = tag in ("pre", "textarea")
        return False

    def open_foreign(self, tag: str, rest: str, kind: str) -> bool:
        """``open`` for an element of svg or math."""
        self.outer.append(self.lettered)
        self.lettered = kind == "math" or tag in ("text", "foreignobject") or self.lettered and tag != "svg"
        if self.unseen or tag in _UNSEEN_IN[kind] or hidden("", rest) or kind == "svg" and _UNSHOWN.search(rest):
            self.unseen += 1
            return True
        if tag in _APART:
            self.apart()
        return False

    def apart(self) -> None:
        if not self.unseen:
            self.flows[-1].blank = True

    def close(self, tag: str, rest: str, unseen: bool, kind: str = "") -> None:
        if kind:
            self.lettered = self.outer.pop()
            if tag in _APART:
                self.apart()
        if unseen:
            self.unseen -= 1
            return
        if kind:
            return
        if tag in ("pre", "textarea", "xmp"):
            if self.flows[-1].words:
                self.flows[-1].end_line(keep=True)
            self.kept -= 1
        if tag in ("li", "td", "th", "caption", "dd", "blockquote"):
            lines = self.flows.pop().result()
            self._placed(tag, rest, lines)
        elif tag in ("ul", "ol", "menu"):
            self.lists.pop()
        elif tag in ("thead", "tbody", "tfoot") and self.tables:
            self.tables[-1].sections.add(len(self.tables[-1].rows))
        elif tag == "table":
            lines = self.tables.pop().lines()
            self.flows[-1].end_line()
            if lines:
                self.flows[-1].emit(lines)
        flow = self.flows[-1]
        if tag in BLOCKS:
            flow.end_line()
            if tag in PARAGRAPHS and not (tag in ("ul", "ol", "dl") and self.lists):
                flow.gap = 1

    def _placed(self, tag: str, rest: str, lines: list[str]) -> None:
        if tag in ("td", "th") and self.tables:
            if not self.tables[-1].rows:
                self.tables[-1].rows.append([])
            given = attributes(rest)
            deep = reach(given.get("rowspan", ""), 65_534)
            self.tables[-1].rows[-1].append(Cell(lines, reach(given.get("colspan", ""), 1000) or 1, 1 if deep is None else deep))
            return
        if tag == "caption" and self.tables:
            self.tables[-1].caption += lines
            return
        mark = ""
        if tag == "li":
            number = self.lists[-1] if self.lists else [None]
            mark = "- " if number[0] is None else f"{number[0]}. "
            if number[0] is not None:
                number[0] += 1
        first, rest_of = (mark, " " * len(mark)) if tag == "li" else ("  ", "  ") if tag in ("dd", "blockquote") else ("", "")
        if lines:
            self.flows[-1].emit([((rest_of if k else first) + line).rstrip(" ") for k, line in enumerate(lines)])


def visible_text(page: str) -> str:
    """The page's visible text: lines without trailing spaces, blocks apart by one empty line."""
    out = Renderer()
    opened: list[tuple[str, str, bool, str]] = []
    held: dict[str, int] = {}
    begun = False  # a head can no longer start

    def push(tag: str, rest: str, unseen: bool, kind: str = "") -> None:
        opened.append((tag, rest, unseen, kind))
        held[tag] = held.get(tag, 0) + 1

    def close_top() -> None:
        tag, rest, unseen, kind = opened.pop()
        held[tag] -= 1
        out.close(tag, rest, unseen, kind)

    def foreign() -> bool:
        return bool(opened and opened[-1][3])

    def kind_of(tag: str) -> str:
        """svg, math or "" for the kind of element that a start tag makes here."""
        top, rest, _, kind = opened[-1] if opened else ("", "", False, "")
        if kind and top not in _HTML_IN[kind]:
            if top != "annotation-xml" or tag != "svg" and not re.search(r"encoding\s*=\s*[\"']?(?:text/html|application/xhtml\+xml)", rest, re.IGNORECASE):
                return kind
        elif kind == "math" and tag in ("mglyph", "malignmark"):
            return kind
        return tag if tag in ("svg", "math") else ""

    def leave_foreign() -> None:
        while foreign() and opened[-1][0] not in _HTML_IN[opened[-1][3]]:
            close_top()

    def end_head() -> None:
        if opened and opened[-1][0] == "head":
            close_top()

    def close_implied(closes: frozenset[str], bounds: frozenset[str]) -> None:
        """Closes the outermost of ``closes`` above the nearest bound."""
        if not any(held.get(t) for t in closes):
            return
        last = None
        for k in range(len(opened) - 1, -1, -1):
            if opened[k][0] in bounds or opened[k][3]:
                break
            if opened[k][0] in closes:
                last = k
        while last is not None and len(opened) > last:
            close_top()

    for event, tag, rest in tokens(page, foreign):
        if event == "text":
            if not _BLANK.fullmatch(rest):
                end_head()
                begun = True
            out.text(rest)
        elif event == "raw":
            out.text(rest)
        elif event == "open":
            if tag not in _IN_HEAD:
                end_head()
            if tag == "head" and begun:
                continue
            begun = begun or tag != "html"
            kind = kind_of(tag)
            if kind and tag not in ("svg", "math") and (tag in _LEAVES_FOREIGN or tag == "font" and re.search(r"(?:^|\s)(?:color|face|size)\s*=", rest, re.IGNORECASE)):
                leave_foreign()
                kind = ""
            if kind:
                if not self_closing(rest):
                    push(tag, rest, out.open_foreign(tag, rest, kind), kind)
                elif tag in _APART:
                    out.apart()
                continue
            if tag in BLOCKS and tag not in ("option", "optgroup"):
                close_implied(frozenset(["p"]), _SCOPE | frozenset(["li", "dd"]))
            if tag in _CLOSES:
                close_implied(*_CLOSES[tag])
            if tag in ("td", "th") and held.get("table") and not _inside(opened, "tr", "table"):
                push("tr", "", out.open("tr", ""))
            unseen = out.open(tag, rest)
            if tag in VOID:
                continue
            push(tag, rest, unseen)
            continue
        if event != "close":
            continue
        if tag in ("p", "br"):
            leave_foreign()
        if tag == "br":
            end_head()
        if held.get(tag):
            bounds = frozenset(["html", "template"]) if tag in ("table", "template", "html") else frozenset(["table", "template"]) if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else _END_SCOPE
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == tag:
                    while len(opened) > k:
                        close_top()
                    break
                if opened[k][0] in bounds:
                    break
        elif tag in ("p", "br") and not out.unseen:
            out.open(tag, "")
            if tag == "p":
                out.close(tag, "", False)
    while opened:
        close_top()
    return "\n".join(out.flows[0].result()).strip("\n")


def _inside(opened: list[tuple[str, str, bool, str]], tag: str, bound: str) -> bool:
    for name, *_ in reversed(opened):
        if name == tag:
            return True
        if name == bound:
            return False
    return False


def extract(pages: DataFrame, keep: list[str] = ["page_id"], html: str = "html") -> DataFrame:
    """The columns ``keep`` of each page and its visible ``text``.

    A null or empty page gives an empty text, as does one with nothing to show. Pages are
    rendered one by one, whatever their length or nesting, so repeated rows and null or
    equal ids change nothing. No rows, no result; other columns are not read.
    """
    read = with_text_bytes(pages, keep, html)

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_of(batches):
            shown = pa.array([visible_text(t.decode("utf-8", "replace")) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], shown], names=[*keep, "text"])

    return read.mapInArrow(render, schema_with(read, "text string"))
