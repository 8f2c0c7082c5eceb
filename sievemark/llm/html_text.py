"""All visible text of web pages, laid out as a browser would order it.

A page is read in three steps: tags, text and raw elements by one pattern; a tree, with the tags that HTML
implies (a paragraph ends where a block begins, cells and rows and list items end one another,
tables get rows); and rendering. Hidden elements are left out: head, scripts, styles,
templates, ``hidden``, ``display: none``, ``visibility: hidden``, hidden inputs, and
what closed ``details`` fold away. Rendering keeps

* blocks on lines of their own, with a blank line around paragraphs, headings, lists and tables;
* lists with bullets or numbers, indented by level; definition lists with indented definitions;
* tables as columns of equal width, cells padded and separated by two spaces;
* ``pre`` text as it is, and white space elsewhere as single spaces.

Defined results: a null page stays null, an empty one is empty; unclosed, misnested and unknown tags are
handled as the tree builder says, at any depth: nothing here recurses. Of ``svg`` the text elements are
seen, of ``math`` all but its annotations. Columns other than the page are kept. Reading takes time in
proportion to the page, however broken it is; so does rendering, but for tables of several columns inside
one another, whose lines are laid out again at each level. Indents grow to ``WIDEST_INDENT`` columns; what
is nested deeper keeps that indent.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape as html_unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WIDEST_INDENT = 128
_BEGIN = re.compile(r"<(?:(?P<mark>[!?])|(?P<end>/)?(?P<name>[A-Za-z][^\s/>]*+))")
_MARK = re.compile("<[!?]")
_LIMITS = re.compile("[>\"']")
_LONG_NUMBER = re.compile(r"&#0*+(?:[0-9]{9,}|[xX]0*+[0-9a-fA-F]{8,});?")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Elements as the HTML standard groups them.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_UNSEEN = set(
    "head script style template noscript title meta link base iframe noembed noframes object "
    "audio video canvas datalist param area map".split()
)
_BLOCKS = set(
    "address article aside blockquote body center details dialog dd dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre search section summary table ul caption tr tbody thead tfoot td th".split()
)
_SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl pre blockquote table figure fieldset hr menu dir".split())
_ENDS_PARAGRAPH = _BLOCKS - {"html", "body", "caption", "tr", "tbody", "thead", "tfoot", "td", "th"}
# Which open elements a start tag ends, and the elements beyond which it does not look.
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
_SCOPES = {"table", "td", "th", "caption", "button", "template", "html"}
_TABLE_FRAMES = {"table", "thead", "tbody", "tfoot", "tr"}
_IN_TABLE = set(
    "caption colgroup col thead tbody tfoot tr td th script style template form input".split()
)
_SVG_UNSEEN = set("desc metadata defs symbol clippath mask pattern marker".split())
_SVG_TEXT = {"text", "foreignobject"}
_HEAD = set("base link meta title style script noscript template".split())
_GAP = re.compile(r"[ \t\n\r\f]+")
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Element:
    __slots__ = ("name", "attributes", "children", "before")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes = name, attributes
        self.children: list[Element | str] = []
        # What a table cannot hold, which stands before it.
        self.before: list[Element | str] = []

    def hidden(self) -> bool:
        given = self.attributes
        return (
            self.name in _UNSEEN
            or "hidden" in given
            or (self.name == "input" and given.get("type", "").lower() == "hidden")
            or ("style" in given and _HIDDEN_STYLE.search(given["style"]) is not None)
        )


def unescape(text: str) -> str:
    """Character references read; numbers far beyond all characters are the replacement character."""
    return html_unescape(_LONG_NUMBER.sub("\ufffd", text) if "&#" in text else text)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return found


class _TagEnds:
    """Finds where tags end, past quoted values, in time that all tags of a page share.

    A search that fails remembers the limits it passed outside quotes: whatever reaches one of them
    fails too.
    """

    def __init__(self, page: str):
        self.page = page
        self.limits = [found.start() for found in _LIMITS.finditer(page)]
        self.failed: set[int] = set()

    def find(self, at: int) -> int:
        """The place of the ``>`` that ends a tag whose attributes begin at ``at``, or -1."""
        passed: list[int] = []
        while True:
            index = bisect_left(self.limits, at)
            if index == len(self.limits):
                break
            limit = self.limits[index]
            if limit in self.failed:
                break
            if self.page[limit] == ">":
                return limit
            passed.append(limit)
            closing = self.page.find(self.page[limit], limit + 1)
            if closing < 0:
                break
            at = closing + 1
        self.failed.update(passed)
        return -1


class TreeBuilder:
    """Builds the tree of a page from its tags and texts, in order."""

    def __init__(self):
        self.root = Element("html", {})
        self.open = [self.root]
        # Where the open elements of each name are, so that none is looked for one by one.
        self.places: defaultdict[str, list[int]] = defaultdict(list)

    def _innermost(self, names: Iterable[str]) -> int:
        """The place of the innermost open element of these names; 0 if there is none."""
        return max((self.places[name][-1] for name in names if self.places[name]), default=0)

    def _pop_to(self, size: int) -> None:
        for element in self.open[size:]:
            self.places[element.name].pop()
        del self.open[size:]

    def build(self, page: str) -> Element:
        ends = _TagEnds(page)
        done = at = 0
        while found := _BEGIN.search(page, at):
            begin, at = found.span()
            if found["mark"]:
                comment = page.startswith("<!--", begin)
                closing = page.find("-->" if comment else ">", begin + 4 if comment else at)
                at = len(page) if closing < 0 else closing + (3 if comment else 1)
                self.text(page[done:begin])
                done = at
                continue
            closing = ends.find(at)
            if closing < 0:
                # No tag; nor are the tags that seem to begin inside its name, which end where it does.
                mark = _MARK.search(page, begin + 1, at)
                at = mark.start() if mark else at
                continue
            self.text(page[done:begin])
            name, given = found["name"].lower(), page[at:closing]
            at = closing + 1
            if found["end"]:
                self.end(name)
            else:
                empty = given.endswith("/") and bool(self.places["svg"] or self.places["math"])
                self.start(name, _attributes(given) if given else {}, empty)
                if name in _RAW and not empty:
                    at = self.raw(name, page, at)
            done = at
        self.text(page[done:])
        return _settled(self.root)

    def raw(self, name: str, page: str, at: int) -> int:
        """The text of an element that holds no tags, up to its end tag."""
        found = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
        closing = page.find(">", found.end()) if found else -1
        body = page[at : found.start()] if closing >= 0 else page[at:]
        self.open[-1].children.append(unescape(body) if name in ("textarea", "title") else body)
        self.end(name)
        return closing + 1 if closing >= 0 else len(page)

    def text(self, raw: str) -> None:
        if not raw:
            return
        if self.open[-1].name == "head" and raw.strip():
            self._pop_to(len(self.open) - 1)
        self._put(unescape(raw) if "&" in raw else raw, bool(raw.strip()))

    def _put(self, child: Element | str, shown: bool) -> None:
        """Add to the innermost open element; what a table cannot hold goes before the table."""
        if not shown or self.open[-1].name not in _TABLE_FRAMES:
            self.open[-1].children.append(child)
            return
        at = self._innermost(("table",))
        holder = self.open[at].before if at else self.open[-1].children
        holder.append(child)

    def _close_to(self, names: set[str], scope: set[str]) -> None:
        """End the outermost of the named elements that is open within the scope."""
        inner = self._innermost(names)
        if inner == 0 or self._innermost(scope) > inner:
            return
        while inner > 1 and self.open[inner - 1].name in names:
            inner -= 1
        self._pop_to(inner)

    def start(self, name: str, attributes: dict[str, str], empty: bool = False) -> None:
        if name == "html":
            self.root.attributes.update(attributes)
            return
        if self.open[-1].name == "head" and name not in _HEAD:
            self._pop_to(len(self.open) - 1)
        if name in _ENDS_PARAGRAPH:
            self._close_to({"p"}, _SCOPES)
        if name in _IMPLIED:
            self._close_to(*_IMPLIED[name])
        if name in ("td", "th") and self.open[-1].name in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", {})
        new = Element(name, attributes)
        self._put(new, name not in _IN_TABLE)
        if name not in _VOID and not empty:
            self.places[name].append(len(self.open))
            self.open.append(new)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
            return
        scope = {"table"} if name not in ("table", "body", "html") else set()
        cell = {"td", "th", "caption"} if name not in _BLOCKS else set()
        if self.places[name]:
            at = self.places[name][-1]
            if self._innermost(scope | cell) < at or name in cell:
                self._pop_to(at)
        elif name == "p" and not self.places["table"]:
            self.open[-1].children.append(Element("p", {}))


def _settled(root: Element) -> Element:
    """The tree with what stands before tables in its place."""
    left = [root]
    while left:
        element = left.pop()
        if any(isinstance(child, Element) and child.before for child in element.children):
            placed, waiting = [], [*reversed(element.children)]
            while waiting:
                child = waiting.pop()
                if isinstance(child, Element) and child.before:
                    waiting.append(child)
                    waiting.extend(reversed(child.before))
                    child.before = []
                else:
                    placed.append(child)
            element.children = placed
        left.extend(child for child in element.children if isinstance(child, Element))
    return root


Steps = Iterator["Steps"]


def _run(steps: Steps) -> None:
    """Take steps, each of which may be steps of its own to take first, without recursion."""
    stack = [steps]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        else:
            stack.append(inner)


class Renderer:
    """Writes the visible text of a tree in lines.

    What goes into elements yields the steps to take there, for ``_run``.
    """

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.blank_due = False
        # Each entry is the whole indent of its level.
        self.indents: list[str] = []
        self.marker = ""
        # Inside how many cells of tables of one column. No blank lines are there but before the first line.
        self.cells = 0
        self.blank_before = False

    def indent(self, more: str) -> None:
        whole = self.indents[-1] if self.indents else ""
        self.indents.append(whole + more if len(whole) + len(more) <= WIDEST_INDENT else whole)

    def result(self) -> str:
        self.flush()
        return "\n".join(self.lines)

    def flush(self) -> None:
        line = "".join(self.current).strip(" ")
        self.current = []
        if line:
            self._line(line)

    def _line(self, line: str) -> None:
        if self.cells and not self.marker and not line.strip():
            return
        if (self.blank_before if self.cells else self.blank_due) and self.lines:
            self.lines.append("")
        self.blank_due = self.blank_before = False
        indent = self.indents[-1] if self.indents else ""
        if self.marker:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = ""
        self.lines.append((indent + line).rstrip())

    def space(self) -> None:
        self.flush()
        self.blank_due = bool(self.lines)

    def text(self, text: str) -> None:
        plain = _GAP.sub(" ", text)
        if plain[:1] == " " and (not self.current or self.current[-1].endswith(" ")):
            plain = plain[1:]
        if plain:
            self.current.append(plain)

    def children(self, element: Element) -> Steps:
        for child in element.children:
            if isinstance(child, str):
                self.text(child)
            elif not child.hidden():
                steps = self.element(child)
                if steps is not None:
                    yield steps

    def element(self, element: Element) -> Steps | None:
        special = getattr(self, f"render_{element.name}", None)
        if special:
            return special(element)
        if element.name in _BLOCKS:
            return self.block(element)
        return self.children(element)

    def block(self, element: Element) -> Steps:
        begin = self.space if element.name in _SPACED else self.flush
        begin()
        yield self.children(element)
        begin()

    def render_svg(self, element: Element) -> Steps:
        for child in element.children:
            if isinstance(child, str) or child.hidden() or child.name in _SVG_UNSEEN:
                continue
            if child.name in _SVG_TEXT:
                self.text(" ")
                yield self.children(child)
                self.text(" ")
            else:
                yield self.render_svg(child)

    def render_semantics(self, element: Element) -> Steps:
        """Of a formula given in several ways the first is seen."""
        for child in element.children:
            if isinstance(child, Element) and not child.hidden():
                yield self.children(child)
                break

    def render_br(self, element: Element) -> None:
        if self.current:
            self.flush()
        elif self.lines and self.lines[-1]:
            self.blank_due = True

    def render_hr(self, element: Element) -> None:
        self.space()

    def render_img(self, element: Element) -> None:
        """Pictures show no text; what stands in for them is not on the page."""

    def render_input(self, element: Element) -> None:
        kind = element.attributes.get("type", "text").lower()
        if kind in ("submit", "button", "reset", "text", "search", "email", "url", "number"):
            shown = element.attributes.get("value") or element.attributes.get("placeholder")
            if shown:
                self.text(f" {shown} ")

    def render_pre(self, element: Element) -> None:
        self.space()
        lines = _whole_text(element).replace("\r\n", "\n").split("\n")
        if lines and not lines[0].strip():
            lines = lines[1:]
        while lines and not lines[-1].strip():
            lines.pop()
        for line in lines:
            if line.strip():
                self._line(line.rstrip())
            elif not self.cells:
                self.lines.append("")
        self.space()

    def render_textarea(self, element: Element) -> None:
        self.text(f" {_whole_text(element)} ")

    def render_details(self, element: Element) -> Steps:
        if "open" in element.attributes:
            yield self.block(element)
            return
        self.flush()
        for child in element.children:
            if isinstance(child, Element) and child.name == "summary" and not child.hidden():
                yield self.block(child)
                break

    def _listed(self, element: Element, numbered: bool) -> Steps:
        self.flush() if self.indents else self.space()
        start = element.attributes.get("start", "1")
        number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
        for child in element.children:
            if isinstance(child, str):
                self.text(child)
            elif child.hidden():
                continue
            elif child.name == "li":
                self.flush()
                marker = f"{number}. " if numbered else "- "
                number += 1
                self.indent(" " * len(marker))
                self.marker = marker
                yield self.children(child)
                self.flush()
                if self.marker == marker:
                    self.marker = ""
                self.indents.pop()
            else:
                steps = self.element(child)
                if steps is not None:
                    yield steps
        self.flush() if self.indents else self.space()

    def render_ul(self, element: Element) -> Steps:
        return self._listed(element, False)

    render_menu = render_dir = render_ul

    def render_ol(self, element: Element) -> Steps:
        return self._listed(element, True)

    def render_li(self, element: Element) -> Steps:
        holder = Element("ul", {})
        holder.children.append(element)
        return self._listed(holder, False)

    def render_dd(self, element: Element) -> Steps:
        self.flush()
        self.indent("    ")
        yield self.children(element)
        self.flush()
        self.indents.pop()

    def render_blockquote(self, element: Element) -> Steps:
        self.space()
        self.indent("  ")
        yield self.children(element)
        self.space()
        self.indents.pop()

    def render_table(self, element: Element) -> Steps:
        self.space()
        parts = list(_rows(element))
        for part in parts:
            if part.name != "tr":
                yield self.children(part)
                self.flush()
        cells = [[*filter(_is_cell, part.children)] for part in parts if part.name == "tr"]
        if all(len(row) <= 1 for row in cells) and not self.marker:
            # Nothing to align: the cells are blocks.
            if self.cells == 0:
                self.blank_before = self.blank_due
            self.cells += 1
            for cell in (cell for row in cells for cell in row):
                yield self.children(cell)
                self.flush()
            self.cells -= 1
        else:
            rows: list[list[list[str]]] = []
            for row in cells:
                rows.append([])
                for cell in row:
                    inner = Renderer()
                    yield inner.children(cell)
                    rows[-1].append([line for line in inner.result().split("\n") if line])
            self._aligned(rows)
        self.space()

    def _aligned(self, rows: list[list[list[str]]]) -> None:
        widths: list[int] = []
        for row in rows:
            for i, cell in enumerate(row):
                width = max((len(line) for line in cell), default=0)
                if i == len(widths):
                    widths.append(width)
                widths[i] = max(widths[i], width)
        for row in rows:
            for n in range(max((len(cell) for cell in row), default=0)):
                line = "  ".join(
                    (cell[n] if n < len(cell) else "").ljust(width) for cell, width in zip(row, widths)
                )
                if line.strip():
                    self._line(line)


def _is_cell(child: Element | str) -> bool:
    return isinstance(child, Element) and child.name in ("td", "th") and not child.hidden()


def _rows(table: Element) -> Iterator[Element]:
    """Rows of a table and what stands between them: captions first, then in order."""
    parts = [c if isinstance(c, Element) else _anonymous(c) for c in table.children]
    parts = [p for p in parts if not p.hidden() and (p.name != "#text" or p.children[0].strip())]
    yield from (p for p in parts if p.name == "caption")
    for part in parts:
        if part.name in ("thead", "tbody", "tfoot"):
            yield from _rows(part)
        elif part.name != "caption":
            yield part


def _anonymous(text: str) -> Element:
    made = Element("#text", {})
    made.children.append(text)
    return made


def _whole_text(element: Element) -> str:
    pieces, left = [], [*reversed(element.children)]
    while left:
        child = left.pop()
        if isinstance(child, str):
            pieces.append(child)
        elif child.name == "br":
            pieces.append("\n")
        elif not child.hidden():
            left.extend(reversed(child.children))
    return "".join(pieces)


def visible_text(page: str) -> str:
    root = TreeBuilder().build(page)
    writer = Renderer()
    if not root.hidden():
        _run(writer.children(root))
    return writer.result()


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with the visible text of each page in place of its HTML, as ``text``."""
    columns = [n for n in pages.columns if n not in (html_col, "text")]
    rows = pages.select(
        F.struct(*[pages[n] for n in columns]).alias("kept") if columns else F.lit(True).alias("kept"),
        pages[html_col].alias("html"),
    )
    kind = rows.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = (page.as_py() for page in batch.column("html"))
            texts = [None if page is None else visible_text(page) for page in pages]
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), pa.array(texts, pa.string())], ["kept", "text"]
            )

    done = rows.mapInArrow(run, f"kept {kind}, text string")
    return done.select(*[F.col(f"kept.`{n}`").alias(n) for n in columns], "text")
