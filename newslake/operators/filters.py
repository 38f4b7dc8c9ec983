"""Filters and predicates."""

from __future__ import annotations

import functools

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.constants import (CHALLENGE_LIVE_PHRASES, CHALLENGE_SCAN_CHARS, CHALLENGE_STATUSES,
                                SLUG_BLOCK_RULES, UNEXTRACTED_CONTENT_MARKER, UNEXTRACTED_TITLE_MARKER)
from newslake.functions.dates import date_to_text


def pending_articles(articles: DataFrame) -> DataFrame:
    """stubs not yet populated (title IS NULL) -> url, category, date text."""
    return (articles.filter(F.col("title").isNull())
            .select("url", "category", date_to_text("date").alias("date")))


def unextracted_articles(articles: DataFrame, mode: str = "or",
                         title_marker: str = UNEXTRACTED_TITLE_MARKER,
                         content_marker: str = UNEXTRACTED_CONTENT_MARKER) -> DataFrame:
    """re-crawl work list (id, url, category, date text).

    ``mode="or"`` follows the executed query (either field failed);
    ``mode="and"`` follows the documented intent (both failed).
    """
    t = F.lower("title").contains(title_marker)
    c = F.lower("content").contains(content_marker)
    cond = (t | c) if mode == "or" else (t & c)
    return articles.filter(cond).select("id", "url", "category", date_to_text("date").alias("date"))


def as_of_date(df: DataFrame, col: str = "date") -> Column:
    """Scalar subquery: the latest date in ``df`` (a stand-in for CURRENT_DATE)."""
    return df.select(F.max(F.col(col).cast("date"))).scalar()


def date_window(df: DataFrame, days: int | None = None, start=None, as_of=None,
                col: str = "date") -> DataFrame:
    """``col >= start``; start explicit or ``as_of - days``.

    ``as_of`` may be a date, a literal string or a Column (e.g.
    :func:`as_of_date`); without it CURRENT_DATE is used.
    """
    if start is None:
        if days is None:
            raise ValueError("give start or days")
        anchor = (F.lit(as_of) if isinstance(as_of, (str, _dt.date)) else as_of) if as_of is not None \
            else F.current_date()
        start_col = F.date_sub(anchor.cast("date"), days)
    else:
        start_col = F.lit(start).cast("date")
    return df.filter(F.col(col) >= start_col)


def category_allow(df: DataFrame, allow: list[str] | None, col: str = "category") -> DataFrame:
    """trimmed, upper-cased category in the allow list; no list keeps all."""
    if not allow:
        return df
    wanted = sorted({a.strip().upper() for a in allow})
    return df.filter(F.upper(F.trim(F.col(col))).isin(wanted))


def https_only(df: DataFrame, col: str = "url") -> DataFrame:
    """keep links starting with ``https://``."""
    return df.filter(F.col(col).startswith("https://"))


def slug_blocked(slug: Column, subdomain: Column, rules=SLUG_BLOCK_RULES) -> Column:
    """True when any (substring, subdomain-or-None) rule matches.

    Rules are a small fixed configuration list, so they compile into one
    boolean expression instead of a join.
    """
    hit = F.lit(False)
    for needle, sub in rules:
        r = slug.contains(needle)
        if sub is not None:
            r = r & (subdomain == F.lit(sub))
        hit = hit | F.coalesce(r, F.lit(False))
    return hit


def slug_block(df: DataFrame, rules=SLUG_BLOCK_RULES, slug_col: str = "slug",
               subdomain_col: str = "subdomain") -> DataFrame:
    """drop rows whose slug matches a block rule."""
    return df.filter(~slug_blocked(F.col(slug_col), F.col(subdomain_col), rules))


def challenge_flag(html: Column, status: Column | None = None, phrases=CHALLENGE_LIVE_PHRASES,
                   scan_chars: int = CHALLENGE_SCAN_CHARS) -> Column:
    """F7 predicate: status 403/503, or a phrase in the first characters."""
    head = F.lower(F.substring(html, 1, scan_chars))
    hit = F.lit(False)
    for p in phrases:
        hit = hit | head.contains(p.lower())
    hit = F.coalesce(hit, F.lit(False))
    if status is not None:
        hit = hit | F.coalesce(status.isin(CHALLENGE_STATUSES), F.lit(False))
    return hit


def challenge_page_flag(pages: DataFrame, phrases=CHALLENGE_LIVE_PHRASES, html_col: str = "html",
                        status_col: str | None = None) -> DataFrame:
    """pages with an ``is_challenge`` flag column."""
    st = F.col(status_col) if status_col else None
    return pages.withColumn("is_challenge", challenge_flag(F.col(html_col), st, phrases))


def newest_first_cutoff(df: DataFrame, listing_cols: list[str], pos_col: str, ts_col: str,
                        start) -> DataFrame:
    """F8: ordered take-while. Within each listing (rows in ``pos_col`` order,
    newest first) keep rows until the first one older than ``start``.

    Expressed as an aggregate (first stop position per listing, partially
    aggregated before the shuffle) joined back, so a hot listing is never
    gathered into one task; the join side has one row per listing.
    """
    start_c = F.lit(start).cast("timestamp_ntz") if not isinstance(start, Column) else start
    if not listing_cols:
        # One listing: the stop position is a scalar subquery.
        stop = df.filter(F.col(ts_col) < start_c).select(F.min(pos_col)).scalar()
        return df.filter(stop.isNull() | (F.col(pos_col) < stop))
    stops = (df.filter(F.col(ts_col) < start_c)
             .groupBy(*listing_cols).agg(F.min(pos_col).alias("_stop_pos")))
    stops = stops.select(*[F.col(c).alias(f"_stop_{c}") for c in listing_cols], "_stop_pos")
    same = functools.reduce(lambda a, b: a & b, [df[c].eqNullSafe(stops[f"_stop_{c}"]) for c in listing_cols])
    joined = df.join(stops, same, "left").drop(*[f"_stop_{c}" for c in listing_cols])
    return (joined.filter(F.col("_stop_pos").isNull() | (F.col(pos_col) < F.col("_stop_pos")))
            .drop("_stop_pos"))


def has_key(df: DataFrame, cols: list[str]) -> DataFrame:
    """drop rows lacking any of ``cols`` (NULL or empty text)."""
    cond = F.lit(True)
    for c in cols:
        col = F.col(c)
        cond = cond & col.isNotNull() & (col.cast("string") != "")
    return df.filter(cond)
