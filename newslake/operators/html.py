"""HTML jobs over page tables (H1-H3) and the field fallbacks built on them.

A page is parsed once into rows of elements and pieces of text
(:mod:`newslake.operators.pageparse`).  Selectors are predicates on an element's path
and attributes; fields, fallbacks, dropped parts, section links and the joining of text
are column expressions over these rows, and only the branch of a page's layout is
evaluated.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake import constants as K
from newslake.functions.text import let as _let, replaced, tags_from_hrefs, whitespace_collapse
from newslake.functions.timeparse import publish_time_parse_array
from newslake.functions.urls import article_key, url_parts
from newslake.operators.filters import category_allow, https_only, slug_blocked
from newslake.operators.joins import new_only
from newslake.operators.pageparse import parse_page, segment
from newslake.operators.windows import first_wins


# ------------------------------------------------------------------ selectors
_COMPOUND = re.compile(r"""([a-zA-Z0-9]+|\*)?((?:[#.][\w-]+|\[[^\]]+\])*)""")
_PART = re.compile(r"""#([\w-]+)|\.([\w-]+)|\[\s*([\w:-]+)\s*(?:([*^$]?=)\s*["']?(.*?)["']?\s*)?\]""")


def _steps(selector: str) -> list[tuple[str, str | None, list]]:
    """Compounds of a selector: combinator before it (" " or ">"), tag, and its conditions."""
    steps, comb = [], " "
    for token in re.split(r"\s*(>)\s*|\s+", selector.strip()):
        if token == ">":
            comb = ">"
        elif token:
            m = _COMPOUND.fullmatch(token)
            if not m:
                raise ValueError(f"unsupported selector {selector!r}")
            steps.append((comb, None if m[1] in (None, "*") else m[1], _PART.findall(m[2] or "")))
            comb = " "
    if any(name for _, _, conds in steps[:-1] for _, _, name, _, _ in conds):
        raise ValueError(f"attributes are tested on the last part only: {selector!r}")
    return steps


def path_pattern(selector: str) -> str:
    """Regular expression for the paths of elements that a selector's tags, ids and classes
    and their nesting allow."""
    out = ""
    for comb, tag, conds in _steps(selector):
        own = f"/{re.escape(tag)}(?=[#./]|$)" if tag else "/[^/#.]+"
        for ident, cls, *_ in conds:
            if ident or cls:
                mark, name = ("#", ident) if ident else (r"\.", cls)
                own += f"(?=[^/]*{mark}{re.escape(segment('', {'class': name})[2:])}(?=[#./]|$))"
        out += ("(?:/[^/]+)*" if comb == " " and out else "") + own + "[^/]*"
    return out + "$"


def matches(e: Column, selector: str) -> Column:
    """Whether an element is one that ``selector`` names (tags, ``#id``, ``.class``, descendants,
    ``>``; attribute tests on the last part)."""
    _, tag, conds = _steps(selector)[-1]
    out = F.lit(True) if tag is None else e["tag"] == tag
    for _, _, name, op, value in conds:
        if name:
            a = e["attrs"][name]
            test = {"": a.isNotNull(), "=": a == value, "*=": F.contains(a, F.lit(value)), "^=": F.startswith(a, F.lit(value)), "$=": F.endswith(a, F.lit(value))}[op]
            out = out & F.coalesce(test, F.lit(False))
    if len(_steps(selector)) > 1 or any(i or c for i, c, *_ in conds):
        out = out & e["path"].rlike(path_pattern(selector))
    return out


def select(page: Column, selector: str) -> Column:
    """Elements a selector names, in document order."""
    return F.filter(page["elements"], lambda e: matches(e, selector))


def texts(page: Column, selector: str) -> Column:
    """Text that stands directly in these elements, piece by piece."""
    return F.flatten(F.transform(select(page, selector), lambda e: e["texts"]))


def text(page: Column, selector: str) -> Column:
    return F.get(texts(page, selector), F.lit(0))


def attrs(page: Column, selector: str, name: str) -> Column:
    return F.array_compact(F.transform(select(page, selector), lambda e: e["attrs"][name]))


def attr(page: Column, selector: str, name: str) -> Column:
    return F.get(attrs(page, selector, name), F.lit(0))


def element(page: Column, selector: str) -> Column:
    """The first element a selector names."""
    return F.get(select(page, selector), F.lit(0))


def outer(html: Column, e: Column) -> Column:
    """An element's markup as it stands in the page."""
    return F.substring(html, e["start"] + 1, e["stop"] - e["start"])


# ------------------------------------------------------------------ H2 and fallbacks
def page_fields(pages: DataFrame, html_col: str = "html", out: str = "f", mode: str = "page") -> DataFrame:
    """H2: parse each page once; fields are asked of ``out`` with the functions above."""
    return pages.withColumn(out, parse_page(F.col(html_col), mode))


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _first(*columns: Column) -> Column:
    return F.coalesce(*columns)


def title_fallback(f: str = "f", subdomain: Column | None = None) -> Column:
    """Og:title -> <title> (trimmed) -> layout heading -> 'No title'."""
    p = F.col(f)
    meta = _first(_truthy(attr(p, 'meta[property="og:title"]', "content")), _truthy(text(p, "title")))
    layout = F.lit(None).cast("string")
    for sub, selectors in K.TITLE_SELECTORS.items():
        if sub != "*":
            layout = F.when(subdomain == sub, _first(*[text(p, s) for s in selectors], F.lit(K.NO_TITLE))).otherwise(layout)
    named = subdomain.isin([s for s in K.TITLE_SELECTORS if s != "*"])
    default = _first(*[text(p, s) for s in K.TITLE_SELECTORS["*"]], F.lit(K.NO_TITLE))
    return F.when(meta.isNotNull(), _strip(meta)).when(named, layout).otherwise(default)


def _first_capture(found: Column, pattern: str) -> Column:
    hits = F.filter(found, lambda t: t.rlike(pattern))
    return F.regexp_extract(F.try_element_at(hits, F.lit(1)), pattern, 1)


def author_fallback(f: str = "f", subdomain: Column | None = None) -> Column:
    """P5: three author metas -> layout byline (two regex forms) -> 'No author'."""
    p = F.col(f)
    meta = _first(*[_truthy(attr(p, s, "content")) for s in K.AUTHOR_META_SELECTORS])
    none = F.lit(K.NO_AUTHOR)
    spans = texts(p, K.AUTHOR_SPAN_SELECTOR)
    by = {sub: [text(p, s) for s in selectors] for sub, selectors in K.AUTHOR_SELECTORS.items()}
    by["cebudailynews"] += [_truthy(_first_capture(spans, "(?U)" + K.AUTHOR_SPAN_PATTERN_CEBU)), text(p, K.AUTHOR_CEBU_LAST)]
    by["bandera"] = [_truthy(_first_capture(spans, "(?U)" + K.AUTHOR_SPAN_PATTERN_BANDERA))]
    selector, name = K.AUTHOR_DEFAULT_BYLINE_ATTR
    platform = texts(p, K.AUTHOR_DEFAULT_PLATFORM + " *")
    out = _first(_truthy(attr(p, selector, name)), F.when(F.size(platform) > 2, F.try_element_at(platform, F.lit(2))), none)
    for sub, columns in by.items():
        out = F.when(subdomain == sub, _first(*columns, none)).otherwise(out)
    return F.when(meta.isNotNull(), _strip(meta)).otherwise(out)


def content_element(f: str = "f", subdomain: Column | None = None, selectors: dict[str, str] | None = None) -> Column:
    """The content block of the page's layout (``selectors``: by subdomain, ``*`` for any
    other); null if the page has none."""
    selectors = K.CONTENT_SELECTORS if selectors is None else selectors
    p = F.col(f)
    out = element(p, selectors["*"]) if "*" in selectors else F.lit(None)
    for sub, s in selectors.items():
        if sub != "*":
            out = F.when(subdomain == sub, element(p, s)).otherwise(out)
    return out


def content_fallback(f: str = "f", subdomain: Column | None = None, selectors: dict[str, str] | None = None,
                     html_col: str = "html") -> Column:
    """Markup of the content block, else the sentinel."""
    block = content_element(f, subdomain, selectors)
    return F.coalesce(_let(block, lambda e: outer(F.col(html_col), e)), F.lit(K.NO_CONTENT_EXTRACTED))


def tags_fallback(f: str = "f", subdomain: Column | None = None, marker: str = K.TAG_MARKER) -> Column:
    """P11 on article pages: tag-link hrefs of the layout -> 'a, b, c'."""
    p = F.col(f)
    hrefs = F.when(subdomain == "pop", attrs(p, K.TAG_LINK_SELECTORS["pop"], "href")).otherwise(attrs(p, K.TAG_LINK_SELECTORS["*"], "href"))
    return tags_from_hrefs(F.coalesce(hrefs, F.array().cast("array<string>")), marker)


def publish_time_fallback(f: str = "f") -> Column:
    """P8 on article pages: published-time metas, then the body date."""
    p = F.col(f)
    first, second = (attrs(p, s, "content") for s in K.PUBLISH_META_SELECTORS)
    metas = F.coalesce(F.when(F.size(first) > 0, first).otherwise(second), F.array().cast("array<string>"))
    body = texts(p, K.PUBLISH_BODY_SELECTOR)
    return publish_time_parse_array(metas, F.when(F.size(body) > 0, F.array_join(body, " ")))


def article_details(pages: DataFrame, category_col: str = "category", date_col: str = "date",
                    url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Phase-2 record per fetched article page: key from the URL, fields from the page with
    every fallback, and the content block both as markup and as clean text (H1), all of
    one parse."""
    p = page_fields(pages, html_col, "f", "crawl").withColumn("_u", url_parts(url_col))
    sub = F.col("_u.subdomain")
    p = p.withColumn("_block", content_element("f", sub))
    cleaned = F.when(F.col("_block").isNotNull(), clean_text(F.col("f"), within=F.col("_block"))).otherwise(F.lit(K.NO_CONTENT_EXTRACTED))
    return p.select(article_key("_u").alias("id"), F.col("_u.origin").alias("source"), F.col(url_col).alias("url"),
                    F.col(category_col).alias("category"), F.col(date_col).cast("date").alias("date"),
                    title_fallback("f", sub).alias("title"), author_fallback("f", sub).alias("author"),
                    publish_time_fallback("f").alias("publish_time"),
                    F.coalesce(outer(F.col(html_col), F.col("_block")), F.lit(K.NO_CONTENT_EXTRACTED)).alias("raw_content"),
                    cleaned.alias("content"), tags_fallback("f", sub).alias("tags"))


# ------------------------------------------------------------------ H1
#: Never text, whatever a caller drops.
_NO_TEXT = ("head", "script", "style", "template")


def _dropped(page: Column, ids, classes, tags) -> Column:
    """Elements that are dropped, with all inside them, by tag, id or class."""
    def away(e: Column) -> Column:
        out = e["tag"].isin(list(tags))
        if ids:
            out = out | F.coalesce(e["attrs"]["id"].isin(list(ids)), F.lit(False))
        if classes:
            own = F.split(F.coalesce(e["attrs"]["class"], F.lit("")), r"\s+")
            out = out | F.arrays_overlap(own, F.array(*[F.lit(c) for c in classes]))
        return out

    return F.filter(page["elements"], away)


def clean_text(page: Column, ids=K.CRAWL_UNWANTED_IDS, classes=K.CRAWL_UNWANTED_CLASSES, tags=K.CRAWL_UNWANTED_TAGS,
               within: Column | None = None) -> Column:
    """H1 on a parsed page: its pieces of text (those ``within`` an element), without dropped
    elements.  Paragraphs are parted by a blank line, lines by a line break, cells by `` | ``;
    headings start with ``#``, items with ``*`` or their number; links, images and emphasis
    leave their text alone; whitespace is collapsed (P14)."""
    def kept(gone: Column) -> Column:
        return F.filter(page["pieces"], lambda r: ~F.exists(gone, lambda e: r["element"].between(e["pos"], e["last"])))

    def inside(e: Column) -> Column:
        return F.filter(_let(gone, kept), lambda r: r["element"].between(e["pos"], e["last"]))

    def piece(r: Column, o: Column) -> Column:
        """A piece after ``o``, the one before it (null: none)."""
        gap = (F.when(o.isNull(), r["mark"]).when(o["para"] != r["para"], F.concat(F.lit("\n\n"), r["mark"]))
               .when(o["line"] != r["line"], F.concat(F.lit("\n"), r["mark"])).when(o["cell"] != r["cell"], F.lit(" | ")).otherwise(F.lit("")))
        return F.concat(gap, r["text"])

    gone = _dropped(page, ids, classes, (*tags, *_NO_TEXT))
    pieces = _let(gone, kept) if within is None else _let(within, inside)
    joined = _let(pieces, lambda ps: F.array_join(F.zip_with(
        ps, F.concat(F.array(F.lit(None)), F.slice(ps, F.lit(1), F.greatest(F.size(ps) - 1, F.lit(0)))), piece), ""))
    return whitespace_collapse(replaced(joined, " *\n *", "\n", " \n", "\n "))


def html_clean_text(df: DataFrame, html_col: str, out_col: str = "text",
                    ids=K.CRAWL_UNWANTED_IDS, classes=K.CRAWL_UNWANTED_CLASSES, tags=K.CRAWL_UNWANTED_TAGS,
                    mode: str = "crawl") -> DataFrame:
    """H1: page markup -> clean text.  ``mode="crawl"``: escaped markup in the text counts as
    markup; ``mode="listing"``: the whole value is unescaped before it is parsed."""
    parsed = df.withColumn("_page", parse_page(F.col(html_col), mode, lean=True))
    return parsed.withColumn(out_col, clean_text(F.col("_page"), tuple(ids), tuple(classes), tuple(tags))).drop("_page")


# ------------------------------------------------------------------ H3
def _list_links(elements: Column, ul: Column) -> Column:
    """Hrefs of the links directly in the items of a list."""
    items = F.transform(F.filter(elements, lambda e: (e["tag"] == "li") & (e["parent"] == ul["pos"])), lambda e: e["pos"])
    links = _let(items, lambda li: F.filter(elements, lambda a: (a["tag"] == "a") & F.array_contains(li, a["parent"])))
    return F.array_compact(F.transform(links, lambda a: a["attrs"]["href"]))


def section_links(page: Column, heading: str = "h4", nav_lists: bool = False) -> Column:
    """Index-page sections, array of (heading, hrefs): for each heading the links ``li > a`` of
    its first following sibling ``ul``; ``nav_lists`` instead takes each ``ul`` inside a ``nav``
    as one section without a heading."""
    def sections(elements: Column) -> Column:
        if nav_lists:
            lists = F.filter(elements, lambda e: matches(e, "nav ul"))
            return F.transform(lists, lambda ul: F.struct(F.lit("").alias("heading"), _list_links(elements, ul).alias("hrefs")))

        def section(h: Column) -> Column:
            after = F.filter(elements, lambda e: (e["tag"] == "ul") & (e["parent"] == h["parent"]) & (e["pos"] > h["pos"]))
            hrefs = _let(F.get(after, F.lit(0)), lambda ul: F.when(ul.isNotNull(), _list_links(elements, ul)).otherwise(F.array().cast("array<string>")))
            name = F.regexp_replace(F.coalesce(F.get(h["texts"], F.lit(0)), F.lit("")), r"^\s+|\s+$", "")
            return F.struct(name.alias("heading"), hrefs.alias("hrefs"))

        return F.transform(F.filter(elements, lambda e: e["tag"] == heading), section)

    return _let(page["elements"], sections)


def harvested_links(index_pages: DataFrame, date_col: str = "date", html_col: str = "html", url_col: str = "url",
                    categories: list[str] | None = None, nav_lists: bool = False, resolve_relative: bool = False,
                    block_rules=K.SLUG_BLOCK_RULES, carry: tuple[str, ...] = ()) -> DataFrame:
    """Index pages -> one row per accepted link with its key and arrival order (and the
    columns ``carry`` of its page).

    Steps: parse, sections -> category allow-list (F4) -> optional resolution of
    site-relative links -> https only (F5) -> URL parts (P1) -> slug block rules (F6) ->
    article key (P2).
    """
    parsed = page_fields(index_pages, html_col, "_page").withColumn("_sections", section_links(F.col("_page"), nav_lists=nav_lists))
    secs = parsed.select(*carry, F.col(date_col).cast("date").alias("date"), F.col(url_col).alias("_page_url"),
                         F.posexplode("_sections").alias("_sec", "s"))
    links = secs.select(*carry, "date", "_page_url", "_sec", F.col("s.heading").alias("category"),
                        F.posexplode("s.hrefs").alias("_link", "href"))
    links = category_allow(links, categories)
    url = F.col("href")
    if resolve_relative:
        origin = F.regexp_extract(F.col("_page_url"), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
        url = F.when(url.startswith("/") & ~url.startswith("//"), F.concat(origin, url)).otherwise(url)
    links = https_only(links.withColumn("url", url))
    links = links.withColumn("_u", url_parts("url"))
    links = links.filter(~slug_blocked(F.col("_u.slug"), F.col("_u.subdomain"), block_rules))
    return links.select(*carry, article_key("_u").alias("id"), F.col("_u.origin").alias("source"), "url", "category",
                        "date", "_page_url", "_sec", "_link")


def new_stubs(links: DataFrame, known_ids: DataFrame) -> DataFrame:
    """Harvested links -> new stub rows (id, source, url, category, date): links already
    stored are skipped (J1) and a link repeated within the run keeps its first arrival
    (N5; order = date, page, section, position)."""
    fresh = new_only(links, known_ids, "id")
    first = first_wins(fresh, "id", ["date", "_page_url", "_sec", "_link"])
    return first.select("id", "source", "url", "category", "date")


def link_harvest(index_pages: DataFrame, known_ids: DataFrame, **kw) -> DataFrame:
    """H3: index pages -> new stub rows."""
    return new_stubs(harvested_links(index_pages, **kw), known_ids)
