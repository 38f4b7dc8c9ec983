"""Publisher listings landed as JSON -> the articles table.

Each listing shape arrives as text rows (one listing page or one detail
record per row, e.g. ``spark.read.text`` over landed files); parsing uses
``from_json`` with a declared schema, so no inference pass over the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.constants import (LISTING_A_SITE_ROOT, LISTING_UNWANTED_TAGS, NO_CONTENT_FOUND, NO_TITLE_FOUND,
                                SOURCE_LISTING_DETAIL, SOURCE_NESTED_POSTS, SOURCE_SECTIONED, UNKNOWN)
from newslake.functions.text import tags_normalise
from newslake.functions.timeparse import ISO_T_SECONDS, ISO_Z_FRACTION, SPACE_SECONDS, api_time_parse
from newslake.functions.urls import url_category
from newslake.operators.aggregates import listing_frontier
from newslake.operators.filters import has_key, newest_first_cutoff
from newslake.operators.joins import listing_detail, new_only, record_exists, tag_lookup
from newslake.schema import ARTICLE_COLUMNS, conform_articles


def clean_listing_content(articles: DataFrame) -> DataFrame:
    """Listing bodies -> text (H1, listing path: unescape first, drop
    img/figure/iframe, links/images/emphasis reduced to text)."""
    from newslake.operators.html import html_clean_text
    return html_clean_text(articles, "content", out_col="content", ids=(), classes=(),
                           tags=LISTING_UNWANTED_TAGS, mode="listing")


def _records(rows: DataFrame, schema: str, value_col: str, *keep: str) -> DataFrame:
    """``d``, the record in each row's JSON.  A generator makes it, so that what is asked of
    ``d`` later, a filter too, does not parse the row again."""
    return rows.select(*keep, F.explode_outer(F.array(F.from_json(F.col(value_col), schema))).alias("d"))


# ---- shape A: listing of items + a detail record per item -----------------
LISTING_A_PAGE = ("struct<listItem: array<struct<_id: bigint, createdDateFull: string, slugline_url: string, "
                  "category: string, title: string, author: string, tags: string>>>")
LISTING_A_DETAIL = "struct<_id: bigint, data: struct<body_html: string>>"


def norm_listing_detail(pages: DataFrame, details: DataFrame, start=None, source: str = SOURCE_LISTING_DETAIL,
                        site_root: str = LISTING_A_SITE_ROOT, page_col: str = "page",
                        value_col: str = "value", known_ids: DataFrame | None = None,
                        clean_content: bool = True) -> DataFrame:
    """Shape A -> articles.

    Items are read in listing order (page, then position); with ``start``
    the listing is cut at the first item older than it (F8).  Items without
    a slug are dropped; the category is upper-cased; the URL is the site root
    plus the slug; the ISO time (``...T...fZ``) gives date and second-precision
    publish time; content is the detail's ``body_html``, or 'No content found'
    when the item has no detail data.  With ``known_ids`` (an ``id`` column),
    items already stored are dropped before the detail join (J1).  With
    ``clean_content`` the body is converted to text (H1, listing path).
    """
    items = pages.select(F.col(page_col).alias("_page"),
                         F.posexplode_outer(F.from_json(F.col(value_col), LISTING_A_PAGE)["listItem"]).alias("_idx", "it")).filter(F.col("_idx").isNotNull())
    items = items.select(F.struct("_page", "_idx").alias("_pos"), "it.*")
    items = items.withColumn("_t", api_time_parse(F.col("createdDateFull"), ISO_Z_FRACTION))
    if start is not None:
        items = newest_first_cutoff(items.withColumn("_ts", F.col("_t.publish_time")), [], "_pos", "_ts", start)
    items = has_key(items, ["slugline_url"])
    if known_ids is not None:        # skip stored ids before the detail join
        items = new_only(items.withColumn("id", F.col("_id").cast("string")), known_ids, "id").drop("id")
    det = (_records(details, LISTING_A_DETAIL, value_col)
           .select(F.col("d._id").alias("_id"), F.col("d.data").isNotNull().alias("_has_data"),
                   F.col("d.data.body_html").alias("_body"))
           .filter(F.col("_id").isNotNull()))
    joined = listing_detail(items, det, key="_id", mode="left")
    content = F.when(F.col("_has_data"), F.col("_body")).otherwise(F.lit(NO_CONTENT_FOUND))
    out = conform_articles(joined.select(
        F.col("_id").cast("string").alias("id"), F.lit(source).alias("source"),
        F.concat(F.lit(site_root), F.col("slugline_url")).alias("url"),
        F.upper("category").alias("category"), "title", "author",
        F.col("_t.date").alias("date"), F.col("_t.publish_time").alias("publish_time"),
        content.alias("content"), "tags"))
    return clean_listing_content(out) if clean_content else out


# ---- shape B: sectioned, paginated summaries + detail per id --------------
LISTING_B_PAGE = "struct<response: string, data: array<struct<cms_article_id: bigint, publish_time: string>>>"
LISTING_B_DETAIL = ("struct<response: string, data: struct<cms_article_id: bigint, body: string, summary: string, "
                    "cf_article_tags: string, link: string, section_name: string, title: string, "
                    "author_name: string, publish_time: string>>")


def _walked_rows(rows: DataFrame, start, known_ids: DataFrame | None, section: str, page: str) -> DataFrame:
    """Timed listing rows that a newest-first walk of each section takes: those of
    the pages that A7 processes, up to the page's first row older than ``start``."""
    rows = rows.withColumn("_ts", api_time_parse(F.col("_lt"), SPACE_SECONDS)["publish_time"]).filter(F.col("_ts").isNotNull())
    rows = rows.withColumn("id", F.col("cms_article_id").cast("string"))
    rows = rows.withColumn("_known", F.lit(False)) if known_ids is None else record_exists(rows, known_ids, "id", "_known")
    walked = listing_frontier(rows, start, section, page, "_pos", "_ts", "_known").select(section, page)
    return newest_first_cutoff(rows, [section, page], "_pos", "_ts", start).join(walked, on=[section, page], how="left_semi")


def norm_sectioned(pages: DataFrame, details: DataFrame, source: str = SOURCE_SECTIONED,
                   value_col: str = "value", known_ids: DataFrame | None = None,
                   clean_content: bool = True, start=None, section_col: str = "section",
                   page_col: str = "page") -> DataFrame:
    """Shape B -> articles.

    Listing rows with an empty publish time are skipped (F9); only
    successful detail records count, and a listing row without one is dropped
    (inner J3).  Content is the body, or the summary when the body is empty,
    else 'No content found'; title, author and category take their defaults
    when absent; tags are normalised (P10); the date is the text before the
    first space of the publish time.  With ``known_ids``, stored ids are
    dropped before the detail join (J1); with ``clean_content`` the body is
    converted to text (H1, listing path).  With ``start``, ``section_col`` and
    ``page_col`` of ``pages`` give the walk's order: each section's pages are
    taken until one is missing, holds nothing new in range, or reaches a row
    older than ``start`` (A7), and rows from that one on are left out.
    """
    walk = [] if start is None else [section_col, page_col]
    rows = (_records(pages, LISTING_B_PAGE, value_col, *walk)
            .filter(F.col("d.response") == "success")
            .select(*walk, F.posexplode("d.data").alias("_pos", "r"))
            .select(*walk, "_pos", F.col("r.cms_article_id").alias("cms_article_id"), F.col("r.publish_time").alias("_lt")))
    rows = has_key(rows, ["cms_article_id", "_lt"])
    if start is not None:
        rows = _walked_rows(rows, start, known_ids, section_col, page_col)
    rows = rows.select("cms_article_id").distinct()
    if known_ids is not None:        # skip stored ids before the detail join
        rows = new_only(rows.withColumn("id", F.col("cms_article_id").cast("string")), known_ids, "id").drop("id")
    det = (_records(details, LISTING_B_DETAIL, value_col)
           .filter((F.col("d.response") == "success") & F.col("d.data").isNotNull())
           .select("d.data.*"))
    j = listing_detail(rows, det, key="cms_article_id", mode="inner")
    pt = F.coalesce(F.col("publish_time"), F.lit(""))
    content = F.coalesce(F.nullif(F.col("body"), F.lit("")), F.col("summary"), F.lit(NO_CONTENT_FOUND))
    out = conform_articles(j.select(
        F.col("cms_article_id").cast("string").alias("id"), F.lit(source).alias("source"),
        F.coalesce(F.col("link"), F.lit("")).alias("url"),
        F.coalesce(F.col("section_name"), F.lit(UNKNOWN)).alias("category"),
        F.coalesce(F.col("title"), F.lit(NO_TITLE_FOUND)).alias("title"),
        F.coalesce(F.col("author_name"), F.lit(UNKNOWN)).alias("author"),
        F.try_to_date(F.split_part(pt, F.lit(" "), F.lit(1))).alias("date"),
        api_time_parse(pt, SPACE_SECONDS)["publish_time"].alias("publish_time"),
        content.alias("content"), tags_normalise(F.col("cf_article_tags")).alias("tags")))
    return clean_listing_content(out) if clean_content else out


# ---- shape C: posts with nested rendered fields + tag dimension -----------
LISTING_C_PAGE = ("array<struct<id: bigint, link: string, date: string, title: struct<rendered: string>, "
                  "content: struct<rendered: string>, tags: array<bigint>>>")


def norm_nested_posts(pages: DataFrame, tag_dim: DataFrame, source: str = SOURCE_NESTED_POSTS,
                      value_col: str = "value", known_ids: DataFrame | None = None,
                      clean_content: bool = True, after=None) -> DataFrame:
    """Shape C -> articles.

    Nested ``rendered`` fields (defaults when absent), category = first path
    segment of the link (P7), author NULL, ``T``-separated time, tag ids
    resolved through ``tag_dim`` (id, slug) in their listed order with
    unmatched ids dropped (J4).  With ``known_ids``, stored ids are dropped
    before the tag lookups (J1); with ``clean_content`` the rendered content
    is converted to text (H1, listing path); with ``after`` only posts later
    than that time are kept.
    """
    posts = (pages.select(F.explode_outer(F.from_json(F.col(value_col), LISTING_C_PAGE)).alias("p"))
             .select("p.*").filter(F.col("id").isNotNull()))
    posts = posts.select(F.col("id").cast("string").alias("id"), "link", "date",
                         F.col("title.rendered").alias("_title"), F.col("content.rendered").alias("_content"),
                         F.coalesce(F.col("tags"), F.array().cast("array<bigint>")).alias("_tag_ids"))
    if after is not None:
        posts = posts.filter(api_time_parse(F.col("date"), ISO_T_SECONDS)["publish_time"] > F.lit(after).cast("timestamp_ntz"))
    if known_ids is not None:        # skip stored ids before the tag lookups
        posts = new_only(posts, known_ids, "id")
    tagged = tag_lookup(posts, "id", "_tag_ids", tag_dim, tag_id="id", slug="slug", out_col="tags", sep=",")
    out = conform_articles(tagged.select(
        "id", F.lit(source).alias("source"), F.col("link").alias("url"),
        url_category(F.col("link")).alias("category"),
        F.coalesce(F.col("_title"), F.lit(NO_TITLE_FOUND)).alias("title"),
        F.lit(None).cast("string").alias("author"),
        F.try_to_date(F.split_part(F.col("date"), F.lit("T"), F.lit(1))).alias("date"),
        api_time_parse(F.col("date"), ISO_T_SECONDS)["publish_time"].alias("publish_time"),
        F.coalesce(F.col("_content"), F.lit(NO_CONTENT_FOUND)).alias("content"), "tags"))
    return clean_listing_content(out) if clean_content else out


def union_sources(*frames: DataFrame) -> DataFrame:
    """Combine normalised sources under the one article schema."""
    out = conform_articles(frames[0])
    for f in frames[1:]:
        out = out.unionByName(conform_articles(f), allowMissingColumns=True)
    return out.select(*ARTICLE_COLUMNS)


def load_normalise(records: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Type-normalising bulk load of raw records (``extra`` columns pass through).

    id -> text; ``cleaned_content`` -> ``content``; the date text is cut to
    its day; the publish time is parsed; the text 'None' (a NULL that was
    stringified upstream) becomes NULL in every text column.
    """
    df = records
    if "cleaned_content" in df.columns:
        df = df.withColumnRenamed("cleaned_content", "content")
    out = {}
    for c in df.columns:
        if c in (extra or []):
            continue
        if c == "date":
            out[c] = F.to_date(F.col(c).cast("string").try_cast("timestamp_ntz"))
        elif c == "publish_time":
            out[c] = F.col(c).cast("string").try_cast("timestamp_ntz")
        else:
            s = F.col(c).cast("string")
            out[c] = F.when(s == "None", F.lit(None).cast("string")).otherwise(s)
    return conform_articles(df.withColumns(out), extra)
