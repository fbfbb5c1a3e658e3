"""Visible text of HTML pages, laid out as a reader would see it.

A tokenizer cuts the markup, a tree builder keeps the open elements and adds
the tags that HTML lets authors omit, visibility rules drop what isn't shown,
and a renderer keeps block spacing, list markers, preformatted text and tables
with aligned columns. All of it is one pass with a stack; the places of open
elements are kept by name, so a tag costs the same at any depth.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import text_steps

TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)
    |<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")
NO_BOX = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)", re.I)

# Fixed names from the HTML standard: elements by what they mean for parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template title noscript iframe noembed noframes object audio video canvas datalist".split()
)
FOREIGN = frozenset(["svg", "math"])
# Parts of drawings and formulas that are not drawn.
FOREIGN_HIDDEN = frozenset("annotation annotation-xml clippath defs desc marker mask metadata pattern symbol".split())
LISTS = frozenset("ul ol menu dir".split())
# Fields whose value isn't text on the page.
NO_TEXT = frozenset("hidden password checkbox radio range color file image".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary ul".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul menu dir hr".split())
TABLE_PARTS = frozenset("caption colgroup col thead tbody tfoot tr td th".split())
CLOSES_P = (BLOCK - frozenset("body dd dt html legend li optgroup option".split())) | frozenset(["table", "hr"])
# An opening tag ends these open elements, looked for up to the given limits.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
}
# What may stand in a head; anything else, and any text, ends one that was not closed.
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head html".split())
SCOPE = frozenset("table td th caption html".split())
CELL_GAP = "  "
# Spans reach no further by the standard.
MOST_SPAN = {"colspan": 1000, "rowspan": 65534}


class Flow:
    """Lines of one block context: the page, a list item's page or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.blank = False
        self.indents: list[str] = []
        self.marker = ""
        self.started = False

    def text(self, raw: str, pre: bool) -> None:
        if pre:
            first, *rest = raw.replace("\r\n", "\n").split("\n")
            self.inline.append(first)
            for line in rest:
                self.end_line(True)
                self.inline.append(line)
            return
        joined = SPACE.sub(" ", raw)
        if joined and (joined != " " or (self.inline and not self.inline[-1].endswith(" "))):
            if joined[0] == " " and (not self.inline or self.inline[-1].endswith(" ")):
                joined = joined[1:]
            if joined:
                self.inline.append(joined)

    def end_line(self, keep_empty: bool = False) -> None:
        line = "".join(self.inline)
        line = line.rstrip(" ") if not keep_empty else line.rstrip()
        self.inline = []
        if not line and not keep_empty:
            return
        if self.blank and self.started:
            self.lines.append("")
        self.blank = False
        self.started = True
        self.lines.append(("".join(self.indents) + self.marker + line).rstrip())
        if self.marker:
            self.indents.append(" " * len(self.marker))
            self.marker = ""

    def space(self) -> None:
        self.end_line()
        self.blank = True

    def add(self, lines: list[str]) -> None:
        """A finished block, such as a table."""
        self.end_line()
        for line in lines:
            self.inline.append(line)
            self.end_line(True)


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []

    def lines(self) -> list[str]:
        """Cells in columns as wide as their widest single-column cell; spans reach over columns."""
        grid: list[list[tuple[int, int, list[str]]]] = []
        taken: dict[int, int] = {}
        widths: dict[int, int] = {}
        for row in self.rows:
            placed, column = [], 0
            for lines, wide, tall in row:
                while taken.get(column, 0) > 0:
                    column += 1
                placed.append((column, wide, lines))
                for c in range(column, column + wide):
                    if tall > 1:
                        taken[c] = tall
                if wide == 1:
                    widths[column] = max([widths.get(column, 0), *map(len, lines)])
                column += wide
            taken = {c: n - 1 for c, n in taken.items() if n > 1}
            grid.append(placed)
        last = max((c + w for row in grid for c, w, _ in row), default=0)
        starts, at = [], 0
        for c in range(last):
            starts.append(at)
            at += widths.get(c, 0) + (len(CELL_GAP) if widths.get(c, 0) else 0)
        out = list(self.caption)
        for row in grid:
            for i in range(max((len(lines) for _, _, lines in row), default=0)):
                line = ""
                for column, _, lines in row:
                    if i < len(lines) and lines[i]:
                        room = starts[column] - len(line)
                        line += " " * room if room > 0 or not line else CELL_GAP
                        line += lines[i]
                out.append(line.rstrip())
        return out


class Page:
    """Open elements and the flows they write to."""

    def __init__(self, reversed_sizes: list[int] | None = None) -> None:
        self.flows = [Flow()]
        self.open: list[tuple[str, bool, object, bool]] = []
        # Places in ``open`` by name, the last one last.
        self.at: dict[str, list[int]] = {}
        self.tables: list[Table] = []
        self.hidden = 0
        self.visible = True
        self.pre = 0
        # Items of the numbered lists of the page, in the order of their tags.
        self.sizes = iter(reversed_sizes or [])

    @property
    def flow(self) -> Flow:
        return self.flows[-1]

    def place(self, names) -> int:
        """Place of the innermost open element of these names, -1 without one."""
        return max([self.at[n][-1] for n in names if self.at.get(n)], default=-1)

    def is_open(self, names, limits) -> bool:
        """Whether one of ``names`` is open with none of ``limits`` inside it."""
        place = self.place(names)
        return place >= 0 and place >= self.place(limits)

    def in_head(self) -> bool:
        return bool(self.open) and self.open[-1][0] == "head"

    def text(self, raw: str) -> None:
        if self.in_head() and raw.strip(" \t\n\r\f"):
            self.close_through({"head"})
        if self.hidden or not self.visible or not raw:
            return
        # Text between the parts of a table, outside cells, is not laid out there.
        if self.open and self.open[-1][0] in ("table", "thead", "tbody", "tfoot", "tr", "colgroup") and not raw.strip():
            return
        self.flow.text(unescape(raw), self.pre > 0)

    def start(self, name: str, attributes: str, closed: bool) -> None:
        if name in CLOSES_P and self.is_open({"p"}, SCOPE):
            self.close_through({"p"})
        if name in ENDS:
            ends, limits = ENDS[name]
            while self.is_open(ends, limits):
                self.close_through(ends)
        if name in TABLE_PARTS and not self.tables:
            # Parts of a table outside any table mean nothing.
            return
        if name in ("td", "th") and not self.is_open({"tr"}, {"table"}):
            self.start("tr", "", False)
        if name == "tr" and not self.is_open({"thead", "tbody", "tfoot"}, {"table"}):
            self.start("tbody", "", False)
        if name in ("html", "body", "head") and self.at.get(name):
            return
        if name == "body" and self.is_open({"head"}, {"html"}):
            self.close_through({"head"})
        if self.in_head() and name not in IN_HEAD:
            self.close_through({"head"})
        found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip(" /") else {}
        style = found.get("style", "")
        foreign = self.place(FOREIGN) >= 0
        hidden = (
            name in HIDDEN
            or "hidden" in found
            or bool(NO_BOX.search(style))
            or (name == "dialog" and "open" not in found)
            or (foreign and name in FOREIGN_HIDDEN)
        )
        said = VISIBILITY.findall(style)
        visible = said[-1].lower() == "visible" if said else self.visible
        if name in VOID:
            if not hidden and not self.hidden and visible:
                self.void(name, found)
            return
        if closed and (foreign or name in FOREIGN):
            return
        kept: object = None
        before, self.visible = self.visible, visible
        if hidden:
            self.hidden += 1
        elif not self.hidden:
            kept = self.begin(name, found)
        self.at.setdefault(name, []).append(len(self.open))
        self.open.append((name, hidden, kept, before))

    def void(self, name: str, found: dict[str, str]) -> None:
        if name == "br":
            self.flow.end_line(True)
        elif name == "hr":
            self.flow.space()
            self.flow.add(["---"])
            self.flow.space()
        elif name == "img" and found.get("alt"):
            self.flow.text(unescape(found["alt"]), False)
        elif name == "input" and found.get("type", "text").lower() not in NO_TEXT:
            self.flow.text(unescape(found.get("value", "")), False)

    def begin(self, name: str, found: dict[str, str]) -> object:
        flow = self.flow
        if name == "table":
            flow.space()
            self.tables.append(Table())
        elif name == "tr":
            self.tables[-1].rows.append([])
        elif name in ("td", "th", "caption"):
            self.flows.append(Flow())
            return [_number(found.get(k), 1, most) for k, most in MOST_SPAN.items()]
        elif name == "textarea":
            self.pre += 1
        elif name == "select":
            # All options are shown, or only the chosen one, the first unless another is marked.
            listed = "multiple" in found or _number(found.get("size"), 1, 1 << 31) > 1
            return {"options": [], "chosen": None, "listed": listed}
        elif name == "option" and self.at.get("select"):
            self.flows.append(Flow())
            return "selected" in found
        elif name == "optgroup" and self.at.get("select"):
            pass
        elif name in LISTS or name == "dl":
            nested = self.place(("li", "dd")) >= 0
            flow.end_line()
            flow.blank |= not nested
            numbers = Numbers.of(found, next(self.sizes, 0)) if name == "ol" else None
            return [numbers, nested]
        elif name == "li":
            flow.end_line()
            depth = len(flow.indents)
            place = self.place(LISTS)
            kept = self.open[place][2] if place >= 0 else None
            if not self.visible:
                flow.marker = ""
            elif kept and kept[0] is not None:
                flow.marker = kept[0].marker(found.get("value"))
            else:
                flow.marker = "- "
            return depth
        elif name in ("dd", "blockquote"):
            if name in SPACED:
                flow.space()
            flow.end_line()
            flow.indents.append("  ")
            return len(flow.indents) - 1
        elif name in BLOCK:
            flow.space() if name in SPACED else flow.end_line()
            self.pre += name == "pre"
        return None

    def finish(self, name: str, kept: object) -> None:
        flow = self.flow
        if name == "table":
            lines = self.tables.pop().lines()
            flow.add(lines)
            flow.space()
        elif name in ("td", "th", "caption"):
            flow.end_line()
            self.flows.pop()
            if name == "caption":
                self.tables[-1].caption += flow.lines
            else:
                self.tables[-1].rows[-1].append((flow.lines, *kept))
        elif name == "textarea":
            self.pre -= 1
        elif name == "select":
            shown = kept["options"] if kept["listed"] else kept["options"][kept["chosen"] or 0 :][:1]
            for i, text in enumerate(shown):
                if i:
                    flow.end_line()
                flow.text(text, False)
        elif name == "option" and self.at.get("select"):
            flow.end_line()
            self.flows.pop()
            of = self.open[self.at["select"][-1]][2]
            if kept:
                of["chosen"] = len(of["options"])
            of["options"].append(" ".join(flow.lines))
        elif name == "optgroup" and self.at.get("select"):
            pass
        elif name in LISTS or name == "dl":
            flow.end_line()
            flow.blank |= not kept[1]
        elif name == "li":
            flow.end_line()
            if flow.marker:
                flow.end_line(True)
            del flow.indents[kept:]
        elif name in ("dd", "blockquote"):
            flow.end_line()
            del flow.indents[kept:]
            flow.blank |= name in SPACED
        elif name in BLOCK:
            flow.space() if name in SPACED else flow.end_line()
            self.pre -= name == "pre"

    def close_last(self) -> None:
        name, hidden, kept, visible = self.open.pop()
        self.at[name].pop()
        if hidden:
            self.hidden -= 1
        elif not self.hidden:
            self.finish(name, kept)
        self.visible = visible

    def close_through(self, names) -> None:
        while self.open:
            name = self.open[-1][0]
            self.close_last()
            if name in names:
                return

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self.start("br", "", False)
            return
        limits = frozenset(["table"]) if name in TABLE_PARTS or name == "table" else SCOPE
        if self.is_open({name}, limits):
            self.close_through({name})
        elif name == "p":
            self.start("p", "", False)
            self.close_through({"p"})

    def result(self) -> str:
        while self.open:
            self.close_last()
        self.flow.end_line()
        lines = self.flow.lines
        while lines and not lines[-1]:
            lines.pop()
        begin = next((i for i, line in enumerate(lines) if line), 0)
        return "\n".join(lines[begin:])


ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


class Numbers:
    """Markers of one numbered list: the next number, its step and how it is written."""

    def __init__(self, at: int, step: int, kind: str):
        self.at, self.step, self.kind = at, step, kind

    @classmethod
    def of(cls, found: dict[str, str], size: int) -> Numbers:
        down = "reversed" in found
        return cls(_integer(found.get("start"), size if down else 1), -1 if down else 1, found.get("type", "1"))

    def marker(self, value: str | None) -> str:
        n = _integer(value, self.at)
        self.at = n + self.step
        written = ""
        if self.kind in ("a", "A"):
            while n > 0:
                n, letter = divmod(n - 1, 26)
                written = chr(97 + letter) + written
        elif self.kind in ("i", "I") and 0 < n < 4000:
            for size, letters in ROMAN:
                written += letters * (n // size)
                n %= size
        if not written:
            return f"{self.at - self.step}. "
        return f"{written.upper() if self.kind in ('A', 'I') else written}. "


def _integer(raw: str | None, default: int) -> int:
    digits = re.match(r"\s*([+-]?\d{1,9})", raw or "")
    return int(digits[1]) if digits else default


def _number(raw: str | None, default: int, most: int) -> int:
    digits = re.match(r"\s*(\d{1,9})", raw or "")
    return min(max(1, int(digits[1])), most) if digits else default


def visible_text(html: str | None) -> str:
    """The text of a page; a null or empty page has none.

    Broken markup never fails: unclosed elements end with their parent,
    closing tags without an opening one are ignored, an unclosed comment runs
    to the end, and a ``<`` that opens nothing is text.
    """
    if not html:
        return ""
    page = Page(list_sizes(html) if "reversed" in html.lower() else None)
    for what, name, rest in tokens(html):
        if what == "text":
            page.text(rest)
        elif what == "literal":
            if not page.in_head():
                page.text(rest.replace("&", "&amp;"))
        elif what == "end":
            page.end(name)
        elif what == "start":
            page.start(name, rest, rest.endswith("/"))
        elif page.open and page.open[-1][0] == name:
            # The inside of an element that holds text alone; a field drops its first line break.
            page.text(re.sub(r"\A\r?\n", "", rest) if name == "textarea" else rest)
            page.end(name) if name == "textarea" else None
    return page.result()


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """Texts, start and end tags of a page in order, and the insides of elements that hold text alone."""
    at, n = 0, len(html)
    while at < n:
        found = TAG.search(html, at)
        if not found:
            yield "text", "", html[at:]
            return
        if found.start() > at:
            yield "text", "", html[at : found.start()]
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                yield "literal", "", found[0][9:].removesuffix("]]>")
            continue
        if found[1] or found[4]:
            yield "end", name, ""
            continue
        yield "start", name, found[3] or found[6] or ""
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(html, at)
            stop = close.start() if close else n
            yield "inside", name, html[at:stop]
            at = stop
        elif name == "plaintext":
            yield "literal", "", html[at:]
            return


def list_sizes(html: str) -> list[int]:
    """Items of each numbered list, in the order of their start tags."""
    sizes: list[int] = []
    lists: list[int | None] = []
    for what, name, _ in tokens(html):
        if what == "start" and name in LISTS:
            lists.append(len(sizes) if name == "ol" else None)
            sizes += [0] * (name == "ol")
        elif what == "end" and name in LISTS and lists:
            lists.pop()
        elif what == "start" and name == "li" and lists and lists[-1] is not None:
            sizes[lists[-1]] += 1
    return sizes


def extract_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """``page_id, text, n_chars, n_lines`` of every page.

    Null and repeated ids keep their rows; a null page has an empty text.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = pages.select(F.col(f"`{key}`").cast("long").alias(key), F.col(f"`{html}`").alias("_html"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws in text_steps(batches, "_html"):
            texts = [visible_text(raw.decode()) for raw in raws]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                ],
                names=[key, "text", "n_chars", "n_lines"],
            )

    return rows.mapInArrow(step, f"`{key}` long, text string, n_chars long, n_lines long")
