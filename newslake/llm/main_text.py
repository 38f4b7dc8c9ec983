"""Main text of web pages: differencing against the page with the nearest URL.

Pages of a host that lie next to each other by URL path share a template.  The
lines of a page are aligned with those of its neighbour by longest common
subsequence; aligned lines are the template's and go.  Markup then has the last
word where it speaks: lines in an article element stay even if the neighbour has
them too (copies, a sentence that many articles share), and lines in menus,
footers, adverts and the like go even if no neighbour has them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.llm.common import materialise, slices

# Element names of HTML and words that sites use in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th
    thead tr ul""".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
OUT_TAGS = frozenset("""head nav footer aside form script style noscript template button select option textarea iframe svg object
    canvas dialog menu title math audio video map""".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent
    gdpr notice notices newsletter subscribe subscription signup sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs
    footer comment comments disqus respond replies social share sharing related recommended widget popup modal overlay paywall
    pagination""".split())
PAGE_HEAD_WORDS = frozenset("header masthead topbar".split())
ARTICLE_TAGS, ARTICLE_ROLES = frozenset({"article", "main"}), frozenset({"article", "main"})

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[^a-z0-9]+")

#: What markup says of a line: boilerplate, nothing, article.
OUT, OPEN, ARTICLE = 0, 1, 2
#: Most bits of alignment rows held at once; larger alignments are halved first.
HELD_BITS = 1 << 28


def _zone(tag: str, attrs: str, zone: int, in_article: bool) -> int:
    """Zone inside an element, given that outside."""
    if zone == OUT or tag in OUT_TAGS or (tag == "header" and not in_article):
        return OUT
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTR.finditer(attrs)} if "=" in attrs else {}
    role = found.get("role", "")
    if role in OUT_ROLES:
        return OUT
    words = set(_WORD.split(found.get("class", "") + " " + found.get("id", "")))
    if tag not in ("html", "body", "article", "main") and (words & OUT_WORDS or (not in_article and words & PAGE_HEAD_WORDS)):
        return OUT
    return ARTICLE if tag in ARTICLE_TAGS or role in ARTICLE_ROLES else zone


def page_lines(page: str | None) -> list[tuple[str, int]]:
    """Text lines of a page in order, one per block, each with its zone.  Character
    references are decoded and white space inside a line is one space."""
    lines: list[tuple[str, int]] = []
    if not page:
        return lines
    stack: list[tuple[str, int]] = []
    buffer: list[str] = []
    zone, at, n = OPEN, 0, len(page)

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                lines.append((text, zone))

    def close(depth: int) -> None:
        nonlocal zone
        flush()
        zone = stack[depth - 1][1] if depth else OPEN
        del stack[depth:]

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        if m.start() > at:
            buffer.append(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if tag == "br":
            buffer.append(" ")
            continue
        block = tag in BLOCKS
        if m[1]:
            for d in range(len(stack) - 1, -1, -1):
                if stack[d][0] == tag:
                    if block or stack[d][1] != zone or tag in OUT_TAGS:
                        close(d)
                    else:
                        del stack[d:]
                    break
                if not block and stack[d][0] in BLOCKS:
                    break  # a stray inline end does not close blocks
            else:
                if block:
                    flush()
            continue
        if block:
            flush()
            if tag in ("li", "dd", "dt", "td", "th", "tr", "option"):
                same = {"dd": ("dd", "dt"), "dt": ("dd", "dt"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
                stops = {"ul", "ol", "dl", "table", "menu"}
            else:
                same, stops = ("p",), BLOCKS - {"p"}
            for d in range(len(stack) - 1, -1, -1):
                if stack[d][0] in same:
                    close(d)
                    break
                if stack[d][0] in stops:
                    break
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            continue
        inner = _zone(tag, m[3], zone, zone == ARTICLE)
        if inner != zone:
            flush()
        stack.append((tag, inner))
        zone = inner
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
            if zone != OUT:
                buffer.append(page[at:end.start() if end else n])
            at = end.start() if end else n
    flush()
    return lines


def _rows(a: list, b: list) -> Iterator[int]:
    """Bit-parallel table of common subsequence lengths: for each prefix of ``a`` the
    places of ``b`` where the length does not grow, as bits."""
    places: dict = {}
    for j, y in enumerate(b):
        places[y] = places.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & places.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    v = (1 << len(b)) - 1
    for v in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def common_lines(a: list, b: list) -> list[int]:
    """Indices in ``a`` of one longest common subsequence with ``b``."""
    lo, hi_a, hi_b = 0, len(a), len(b)
    while lo < hi_a and lo < hi_b and a[lo] == b[lo]:
        lo += 1
    while hi_a > lo and hi_b > lo and a[hi_a - 1] == b[hi_b - 1]:
        hi_a, hi_b = hi_a - 1, hi_b - 1
    both = set(a[lo:hi_a]) & set(b[lo:hi_b])
    where = [i for i in range(lo, hi_a) if a[i] in both]
    out = [*range(lo), *range(hi_a, len(a))]
    todo = [(where, [y for y in b[lo:hi_b] if y in both])]
    while todo:
        ia, bb = todo.pop()
        if not ia or not bb:
            continue
        aa = [a[i] for i in ia]
        if len(aa) > 1 and len(aa) * len(bb) > HELD_BITS:  # halve: each half aligns with its own part of b
            mid = len(aa) // 2
            total = _lengths(aa[:mid], bb) + _lengths(aa[mid:][::-1], bb[::-1])[::-1]
            cut = int(total.argmax())
            todo += [(ia[:mid], bb[:cut]), (ia[mid:], bb[cut:])]
            continue
        table = list(_rows(aa, bb))
        i, j = len(aa) - 1, len(bb) - 1
        while i >= 0 and j >= 0:
            if table[i] >> j & 1:
                j -= 1
            elif i and not table[i - 1] >> j & 1:
                i -= 1
            else:
                out.append(ia[i])
                i, j = i - 1, j - 1
    return sorted(out)


def candidates(lines: list[tuple[str, int]]) -> tuple[str, bytes | None]:
    """Lines that can be main text, joined by line feeds.  With an article element: its
    lines and null.  Without: the unmarked lines and their places in the page."""
    if any(z == ARTICLE for _, z in lines):
        return "\n".join(t for t, z in lines if z == ARTICLE), None
    places = [i for i, (_, z) in enumerate(lines) if z == OPEN]
    return "\n".join(lines[i][0] for i in places), np.array(places, np.int32).tobytes()


def main_text(text: str, places: bytes | None, shared: bytes | None) -> str:
    """The candidates without the unmarked lines that the neighbour shares."""
    if not places or not shared:
        return text
    gone = set(np.frombuffer(shared, np.int32).tolist())
    return "\n".join(t for t, i in zip(text.split("\n"), np.frombuffer(places, np.int32).tolist(), strict=True) if i not in gone)


def _digest_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each line as 32 bits: enough to align the lines of two pages."""
    for b in slices(batches, "html", 8 << 20):
        lines = [np.array([xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) for t, _ in page_lines(p)], np.uint32).tobytes()
                 for p in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("host"), b.column("path"), pa.array(lines, pa.binary())],
                                         names=["id", "host", "path", "lines"])


def _candidate_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html", 8 << 20):
        texts, places = zip(*(candidates(page_lines(p)) for p in b.column("html").to_pylist()), strict=True)
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("rest"), pa.array(texts, pa.string()), pa.array(places, pa.binary())],
                                         names=["id", "rest", "text", "places"])


def _align_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shared lines of each page with the neighbour whose path has the longer common start."""
    def alike(x: str, y: str | None) -> int:
        if y is None:
            return -1
        n = next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        return n

    for b in batches:
        shared = []
        for path, lines, bp, bl, ap, al in zip(*(b.column(c).to_pylist() for c in
                                                 ("path", "lines", "before_path", "before", "after_path", "after")), strict=True):
            near = bl if alike(path, bp) >= alike(path, ap) else al
            mine = np.frombuffer(lines, np.uint32).tolist()
            other = [] if near is None else np.frombuffer(near, np.uint32).tolist()
            shared.append(np.array(common_lines(mine, other), np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(shared, pa.binary())], names=["id", "shared"])


def _text_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(*x) for x in zip(*(b.column(c).to_pylist() for c in ("text", "places", "shared")), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("rest"), pa.array(texts, pa.string())], names=["rest", "text"])


def nearest_pairs(digests: DataFrame) -> DataFrame:
    """``host, path, before_path, before, after_path, after``: each path of a host with
    the lines of its neighbours in path order (null at the ends).

    Paths are distinct before they are sorted into ranges, so neither a host with
    many pages nor a path with many copies is one task's; a running number over
    the ranges gives the neighbours by equality joins.
    """
    paths = digests.groupBy("host", "path").agg(F.min(F.struct("id", "lines")).alias("m")).select("host", "path", "m.lines")
    ranged = paths.repartitionByRange("host", "path").sortWithinPartitions("host", "path")
    placed = materialise(ranged.select("*", F.monotonically_increasing_id().alias("m")), "paths") \
        .select("host", "path", "lines", F.shiftrightunsigned("m", 33).alias("part"), F.col("m").bitwiseAND((1 << 33) - 1).alias("pos"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = placed.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    line = placed.join(starts, "part").select("host", "path", "lines", (F.col("start") + F.col("pos")).alias("no"))

    def side(step: int, name: str) -> DataFrame:
        return line.select((F.col("no") + step).alias("no"), F.col("host").alias(f"{name}_host"), F.col("path").alias(f"{name}_path"),
                           F.col("lines").alias(name))

    both = line.drop("lines").join(side(1, "before"), "no", "left").join(side(-1, "after"), "no", "left")
    return both.select("host", "path", *[F.when(F.col(f"{n}_host") == F.col("host"), F.col(c)).alias(c)
                                         for n in ("before", "after") for c in (f"{n}_path", n)])


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: ``rest`` (struct of all columns but the html) and ``text``.

    ``text`` joins the lines of the main text with one line feed; null or empty html,
    and pages with no main text, give an empty string.  Pages without a URL, alone on
    their host or with the only path there have no neighbour and share no line.
    Rows that repeat are extracted alike.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    rest = [c for c in pages.columns if c != html_col]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(f"`{html_col}`").alias("html"),
                        F.xxhash64(F.col(f"`{url_col}`"), F.col(f"`{html_col}`")).alias("id"),
                        F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)).alias("host"),
                        F.regexp_extract(url, r"^(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*)?([^?#]*)", 1).alias("path"))
    digests = materialise(rows.select("id", "host", "path", "html").mapInArrow(_digest_side, "id long, host string, path string, lines binary"), "page_lines")
    pairs = nearest_pairs(digests)
    aligned = digests.join(pairs, ["host", "path"]).select("id", "path", "lines", "before_path", "before", "after_path", "after") \
        .mapInArrow(_align_side, "id long, shared binary").groupBy("id").agg(F.first("shared").alias("shared"))
    half = T.StructType([T.StructField("id", T.LongType()), rows.schema["rest"], T.StructField("text", T.StringType()),
                         T.StructField("places", T.BinaryType())])
    found = rows.select("id", "rest", "html").mapInArrow(_candidate_side, half).join(aligned, "id", "left")
    out = T.StructType([rows.schema["rest"], T.StructField("text", T.StringType())])
    return found.select("rest", "text", "places", "shared").mapInArrow(_text_side, out)
