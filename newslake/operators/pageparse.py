"""One parse of a page into rows: its elements and its pieces of text.

This is the only Python over markup.  It emits flat rows in document order and decides
nothing: which elements matter, what is dropped and how text is joined are DataFrame
expressions in :mod:`newslake.operators.html`.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: An element: place in document order, place of its last descendant and of its parent
#: (-1: none), tag, path of segments ``/tag#id.class`` from the top, attributes, text
#: directly inside it, and its slice of the markup.
ELEMENT = ("struct<pos: int, last: int, parent: int, tag: string, path: string, attrs: map<string,string>, texts: array<string>,"
           " start: int, stop: int>")
#: A piece of text: the element it is in; the paragraph, line and table cell it belongs to
#: (numbers that go up), what its line starts with, and the text.
PIECE = "struct<element: int, para: int, line: int, cell: int, mark: string, text: string>"
PAGE = f"struct<elements: array<{ELEMENT}>, pieces: array<{PIECE}>>"

_ARROW = pa.struct([
    ("elements", pa.list_(pa.struct([("pos", pa.int32()), ("last", pa.int32()), ("parent", pa.int32()), ("tag", pa.string()), ("path", pa.string()),
                                     ("attrs", pa.map_(pa.string(), pa.string())), ("texts", pa.list_(pa.string())), ("start", pa.int32()), ("stop", pa.int32())]))),
    ("pieces", pa.list_(pa.struct([("element", pa.int32()), ("para", pa.int32()), ("line", pa.int32()), ("cell", pa.int32()),
                                   ("mark", pa.string()), ("text", pa.string())])))])

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
PARAGRAPHS = frozenset("address article aside blockquote body dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html main nav"
                       " ol p pre section table ul".split())
#: Start tags that end an open element of the same group, up to the element that holds it.
ENDS = {t: (frozenset(g.split()), frozenset(h.split())) for ts, g, h in (
    ("li", "li", "ul ol"), ("dt dd", "dt dd", "dl"), ("tr", "tr td th", "table"), ("td th", "td th", "tr table"), ("option", "option", "select"))
    for t in ts.split()}
#: What may stand in a head; any other start tag ends it.
HEAD = frozenset("html head base link meta noscript script style template title".split())
HEADINGS = {f"h{i}": "#" * i + " " for i in range(1, 7)}
SPACES = re.compile(" {2,}")
#: A run of equal plain segments in a path is cut to this many (more than any selector has).
DEEPEST_RUN = 8


def segment(tag: str, attrs: dict[str, str]) -> str:
    """``/tag#id.class.class``; ids and classes with ``/ # . %`` are written as ``%xx``."""
    safe = lambda s: re.sub(r"[/#.%]", lambda m: f"%{ord(m[0]):02x}", s)          # noqa: E731
    ident = attrs.get("id", "").strip()
    return f"/{tag}" + (f"#{safe(ident)}" if ident else "") + "".join(f".{safe(c)}" for c in attrs.get("class", "").split())


class Page(HTMLParser):
    """Elements and pieces of a page.  ``markup_in_text``: text that is itself markup (it was
    escaped) counts as markup for the pieces."""

    def __init__(self, markup: str, markup_in_text: bool = False, lean: bool = False):
        super().__init__(convert_charrefs=True)
        self.markup, self.markup_in_text, self.lean = markup, markup_in_text, lean
        self.lines = [0, *accumulate(len(x) + 1 for x in markup.split("\n"))]
        self.elements: list[dict] = []
        self.pieces: list[dict] = []
        self.open: list[dict] = []              # open elements, outermost first
        self.plain = [0]                        # equal plain segments at the end of each path
        self.para = self.line = self.cell = 0
        self.mark, self.begun = "", False
        self.counts: list[int | None] = []      # numbers of open lists; None: not numbered
        self.feed(markup)
        self.close()
        while self.open:
            self._end(len(markup))

    def _at(self) -> int:
        line, offset = self.getpos()
        return self.lines[line - 1] + offset

    # ---- breaks -----------------------------------------------------------
    def _break(self, paragraph: bool, mark: str = "") -> None:
        self.line += 1
        self.para += paragraph
        self.mark, self.begun = mark, False

    def _breaks(self, tag: str, start: bool) -> None:
        if tag in HEADINGS:
            self._break(True, HEADINGS[tag] if start else "")
        elif tag == "li":
            number = self.counts[-1] if self.counts else None
            if start and number is not None:
                self.counts[-1] = number + 1
            self._break(False, "" if not start else "  * " if number is None else f"  {number + 1}. ")
        elif tag in ("br", "tr"):
            self._break(False)
        elif tag in ("td", "th"):
            self.cell += start
        elif tag in PARAGRAPHS and (start or tag not in ("html", "body")):
            self._break(True)

    # ---- events -----------------------------------------------------------
    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = self._at()
        group, held = ENDS.get(tag, (frozenset(), frozenset()))
        if tag in PARAGRAPHS:
            group, held = frozenset(["p"]), frozenset(["td", "th", "li", "div", "section", "article", "main", "body", "table"])
        if tag not in HEAD:
            group = group | {"head"}
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i]["tag"] in group:
                while len(self.open) > i:
                    self._end(at)
                break
            if self.open[i]["tag"] in held:
                break
        named = {k: "" if v is None else v for k, v in reversed(attrs)}      # the first of repeated attributes counts
        run, path = 0, None
        if self.lean:
            named = {k: named[k] for k in ("id", "class") if k in named}
        else:
            own = segment(tag, named)
            above = self.open[-1]["path"] if self.open else ""
            run = self.plain[-1] + 1 if above.endswith(own) and own == f"/{tag}" and self.open and self.open[-1]["tag"] == tag else 0
            path = above if run >= DEEPEST_RUN else above + own
        e = {"pos": len(self.elements), "parent": self.open[-1]["pos"] if self.open else -1, "tag": tag, "path": path, "attrs": named, "texts": [], "start": at}
        self.elements.append(e)
        self._breaks(tag, True)
        if tag in ("ul", "ol"):
            self.counts.append(0 if tag == "ol" else None)
        self.open.append(e)
        self.plain.append(run)
        if tag in VOID:
            self._end(at + len(self.get_starttag_text() or ""))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def _end(self, stop: int) -> None:
        e = self.open.pop()
        self.plain.pop()
        e["last"], e["stop"] = len(self.elements) - 1, stop
        if e["tag"] in ("ul", "ol"):
            self.counts.pop()
        if e["tag"] not in VOID:
            self._breaks(e["tag"], False)

    def handle_endtag(self, tag: str) -> None:
        at = self._at()
        if any(e["tag"] == tag for e in self.open):          # a stray end tag is ignored
            while self.open[-1]["tag"] != tag:
                self._end(at)
            self._end(self.markup.find(">", at) + 1 or len(self.markup))

    def handle_data(self, data: str) -> None:
        if self.open:
            if not self.lean:
                self.open[-1]["texts"].append(data)
            if self.open[-1]["tag"] in ("script", "style"):
                return
        if self.markup_in_text and re.search(r"<[a-zA-Z/!]", data):
            return self._nested(data)
        text = data.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\f", " ")
        text = SPACES.sub(" ", text) if "  " in text else text          # lone spaces, by far the most, are left alone
        if text and (self.begun or text != " "):
            self.begun = True
            self.pieces.append({"element": self.open[-1]["pos"] if self.open else -1, "para": self.para,
                                "line": self.line, "cell": self.cell, "mark": self.mark, "text": text})

    def _nested(self, data: str) -> None:
        """Pieces of markup inside text, as if it stood in the page."""
        for p in Page(_html.unescape(data), lean=True).pieces:
            self.pieces.append({**p, "element": self.open[-1]["pos"] if self.open else -1, "para": self.para + p["para"], "line": self.line + p["line"], "cell": self.cell + p["cell"], "mark": p["mark"] or self.mark})
            self.begun = True
        if self.pieces:
            self.para, self.line, self.cell = (max(getattr(self, k), self.pieces[-1][k]) for k in ("para", "line", "cell"))


def page_of(markup: str, mode: str, lean: bool = False) -> Page:
    """``mode``: "page" (elements and pieces as they stand), "crawl" (escaped markup in text
    is markup), "listing" (the whole value is escaped once more)."""
    return Page(_html.unescape(markup) if mode == "listing" else markup, mode == "crawl", lean)


def _offsets(sizes) -> pa.Array:
    return pa.array([0, *accumulate(sizes)], pa.int32())


def _column(rows: list[dict], name: str, kind: pa.DataType) -> pa.Array:
    return pa.array([r[name] for r in rows], kind)


def _packed(pages: list[Page | None]) -> pa.Array:
    """Pages as Arrow, column by column."""
    elements = [e for p in pages if p for e in p.elements]
    pieces = [r for p in pages if p for r in p.pieces]
    attrs = [kv for e in elements for kv in e["attrs"].items()]
    of = _ARROW.field("elements").type.value_type
    columns = {"attrs": pa.MapArray.from_arrays(_offsets(len(e["attrs"]) for e in elements), pa.array([k for k, _ in attrs], pa.string()), pa.array([v for _, v in attrs], pa.string())),
               "texts": pa.ListArray.from_arrays(_offsets(len(e["texts"]) for e in elements), pa.array([t for e in elements for t in e["texts"]], pa.string()))}
    rows = pa.StructArray.from_arrays([columns[f.name] if f.name in columns else _column(elements, f.name, f.type) for f in of], fields=list(of))
    of = _ARROW.field("pieces").type.value_type
    text = pa.StructArray.from_arrays([_column(pieces, f.name, f.type) for f in of], fields=list(of))
    lists = [pa.ListArray.from_arrays(_offsets(len(p.elements) if p else 0 for p in pages), rows).cast(_ARROW.field("elements").type),
             pa.ListArray.from_arrays(_offsets(len(p.pieces) if p else 0 for p in pages), text).cast(_ARROW.field("pieces").type)]
    return pa.StructArray.from_arrays(lists, fields=list(_ARROW), mask=pa.array([p is None for p in pages], pa.bool_()))


def packs(batches: Iterator[pa.Array], mode: str = "page", lean: bool = False) -> Iterator[pa.Array]:
    """``PAGE`` of every page, a few pages at a time."""
    for values in batches:
        for i in range(0, len(values), 32):
            yield _packed([None if v is None else page_of(v, mode, lean) for v in values.slice(i, 32).to_pylist()])


def parse_page(html: Column, mode: str = "page", lean: bool = False) -> Column:
    """``PAGE`` of each page; null for null.  ``lean``: of elements only place, tag, id and
    class, which is what cleaning text asks for.  A few pages at a time are parsed, packed
    and sent on, so a worker's memory does not grow with the rows of a batch."""
    @F.arrow_udf(PAGE)
    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from packs(batches, mode, lean)

    return parsed(html)


__all__ = ["ELEMENT", "PAGE", "PIECE", "Page", "packs", "page_of", "parse_page", "segment"]
