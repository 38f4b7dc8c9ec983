"""The two-phase crawl as two batch jobs over landed page tables.

Phase 1 (:func:`harvest_index`): index pages -> new stub rows (id, source,
url, category, date) -> two-phase upsert into the table.
Phase 2 (:func:`resolve_articles`): work list (pending stubs, or the
re-crawl list of failed extractions) joined with the fetched article pages
on URL -> fields with all fallbacks -> content cleaned to text -> upsert.
Both return the next table version; the caller commits it
(:func:`newslake.operators.writes.commit_snapshot`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.operators.filters import pending_articles, unextracted_articles
from newslake.operators.html import article_details, link_harvest
from newslake.operators.windows import best_per_key, first_wins
from newslake.operators.writes import upsert_two_phase
from newslake.schema import conform_articles


def harvest_index(table: DataFrame, index_pages: DataFrame, seq_base: int = 0, **harvest_opts) -> DataFrame:
    """Phase 1: stubs for links not yet stored, upserted (stubs never
    overwrite stored rows).  ``index_pages``: (date, url, html)."""
    stubs = link_harvest(index_pages, table.select("id"), **harvest_opts)
    batch = conform_articles(stubs.withColumn("seq", F.lit(seq_base)), extra=["seq"])
    return upsert_two_phase(table, batch)


def resolve_articles(table: DataFrame, fetched: DataFrame, work: str = "pending", mode: str = "or",
                     seq_base: int = 1, fetched_at: str | None = None) -> DataFrame:
    """Phase 2: fill the work list from fetched pages (url, html).

    ``work="pending"``: stubs (title NULL); ``work="unextracted"``: rows whose
    title or content extraction failed (``mode`` as in F2).  Of several
    fetches of a URL the latest by the column ``fetched_at`` counts (without one,
    the smallest page).  Each page is parsed once, for its fields and for the text
    of its content block (H1); one record per id is upserted, replacing the five
    content columns.
    """
    todo = pending_articles(table) if work == "pending" else unextracted_articles(table, mode).drop("id")
    when = [fetched_at] if fetched_at else []
    pages = fetched.select("url", "html", *when).join(todo.select("url", "category", "date"), on="url", how="inner")
    pages = best_per_key(pages, "url", [F.col(fetched_at)]) if fetched_at else first_wins(pages, "url", ["html"])
    batch = conform_articles(article_details(pages).withColumn("seq", F.lit(seq_base)), extra=["seq"])
    return upsert_two_phase(table, batch)
