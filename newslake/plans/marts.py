"""Declared marts and trend outputs (D1-D7), built from the operators.

Layering: ``stg_articles`` (staging view) -> ``int_articles_cleaned``
(intermediate view) -> ``fct_articles`` / ``dim_sources`` /
``agg_daily_trends`` (mart tables).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.constants import BOILERPLATE_MARKER, BOILERPLATE_SOURCE
from newslake.functions.dates import date_spine, monday_of
from newslake.functions.text import boilerplate_cut, tags_to_array, title_cut, tokenise
from newslake.operators.aggregates import source_comparison
from newslake.operators.filters import challenge_flag
from newslake.operators.joins import stopword_anti
from newslake.operators.windows import dedupe_latest, rolling_7_by_source
from newslake.operators.writes import conditional_update


def stg_articles(raw: DataFrame, marker: str = BOILERPLATE_MARKER, source: str | None = BOILERPLATE_SOURCE) -> DataFrame:
    """Staging: the boilerplate cut (P15) where the source matches and
    the marker occurs, plus tags as an array (P12)."""
    pred = F.col("content").contains(marker)
    if source is not None:
        pred = (F.col("source") == source) & pred
    cleaned = conditional_update(raw, pred, {"content": boilerplate_cut(F.col("content"), marker),
                                             "title": title_cut(F.col("title"))})
    return cleaned.withColumn("tags", tags_to_array(F.col("tags")))


def int_articles_cleaned(stg: DataFrame, pages: DataFrame | None = None, newest: str = "publish_time",
                         challenge_phrases: list[str] | None = None) -> DataFrame:
    """Staging minus pending (F1), unextracted (F2) and challenge pages
    (F7, matched on the article URL), one row per id (N4)."""
    ok = stg.filter(F.col("title").isNotNull()
                    & ~F.coalesce(F.lower("title").contains("no title")
                                  | F.lower("content").contains("cannot extract article"), F.lit(False)))
    if pages is not None:
        flag = challenge_flag(F.col("html"), None, challenge_phrases) if challenge_phrases else challenge_flag(F.col("html"))
        bad = pages.filter(flag).select(F.col("url"))
        ok = ok.join(bad, on="url", how="left_anti")
    return dedupe_latest(ok, "id", newest)


def fct_articles(cleaned: DataFrame) -> DataFrame:
    """Fact table: deduped cleaned articles with content length, tag
    count and Monday-week."""
    return cleaned.select(
        "id", "source", "url", "category", "title", "author", "date", "publish_time",
        F.length("content").cast("bigint").alias("content_length"),
        F.coalesce(F.size(F.filter(F.col("tags"), lambda t: F.trim(t) != "")), F.lit(0)).alias("tag_count"),
        monday_of("date").alias("week"))


def dim_sources(articles: DataFrame) -> DataFrame:
    """D3: one row per source (A2) with a surrogate id that depends on the
    name alone (first 60 bits of its MD5), so it stays the same when sources
    are added; NULL for a NULL source."""
    digest = F.md5(F.col("source").cast("binary"))
    return source_comparison(articles).withColumn("source_id", F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"))


def agg_daily_trends(articles: DataFrame, fill_calendar: bool = False) -> DataFrame:
    """(date, source, category) counts with a 7-row moving mean per
    (source, category).  With ``fill_calendar`` every day between each
    group's first and last day is present (zero counts), so the mean is over
    calendar days instead of existing days."""
    keys = ["source", "category"]
    if not fill_calendar:
        return rolling_7_by_source(articles, keys)
    daily = articles.groupBy("date", *keys).agg(F.count(F.lit(1)).alias("daily_count"))
    bounds = daily.groupBy(*keys).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    spine = date_spine(bounds).select(*keys, F.col("day").alias("date"))
    had = daily.select("daily_count", *[F.col(c).alias(f"_{c}") for c in ("date", *keys)])
    same = functools.reduce(lambda a, b: a & b, [spine[c].eqNullSafe(had[f"_{c}"]) for c in ("date", *keys)])
    filled = (spine.join(had, same, "left").drop("_date", *[f"_{c}" for c in keys])
              .withColumn("daily_count", F.coalesce("daily_count", F.lit(0)).cast("bigint")))
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(-6, 0)
    return filled.withColumn("moving_avg_7d", F.avg("daily_count").over(w))


def trending_terms(articles: DataFrame, as_of: Column, window_days: int = 7, k: int = 20,
                   id_col: str = "id", text_col: str = "content") -> DataFrame:
    """Term counts in the current window (as_of - window_days, as_of]
    against the window before it; top ``k`` by growth (ties by term).

    Terms: alphabetic tokens (H4) minus stopwords (J5, case-sensitive);
    the two windows are counted in one aggregate (conditional sums).
    """
    cur_start = F.date_sub(as_of, window_days - 1)
    prev_start = F.date_sub(as_of, 2 * window_days - 1)
    scoped = articles.filter((F.col("date") >= prev_start) & (F.col("date") <= as_of))
    scoped = scoped.withColumn("_cur", F.col("date") >= cur_start)
    toks = stopword_anti(tokenise(scoped, id_col, text_col, keep_case_col="_raw", carry=["_cur"]), "_raw")
    counts = toks.groupBy(F.col("token").alias("term")).agg(
        F.count_if(F.col("_cur")).alias("this_window"), F.count_if(~F.col("_cur")).alias("prev_window"))
    counts = counts.withColumn("growth", F.col("this_window") - F.col("prev_window"))
    return counts.orderBy(F.desc("growth"), F.asc("term")).limit(k)


def incremental_refresh(mart: DataFrame, all_articles: DataFrame, new_rows: DataFrame,
                        build) -> DataFrame:
    """Recompute only the dates touched by ``new_rows`` and replace them.

    ``build(articles)`` recomputes mart rows (keyed by ``date``) from
    articles; it runs over the articles of the touched dates only (a
    semi-join), and the untouched dates of ``mart`` are kept as they are.
    Returns the refreshed mart as a DataFrame; :func:`refresh_partitions` is
    the stored form that rewrites only the touched date partitions.
    """
    touched = new_rows.select("date").distinct()
    recomputed = build(all_articles.join(touched, on="date", how="left_semi"))
    kept = mart.join(touched, on="date", how="left_anti")
    return kept.unionByName(recomputed.select(*mart.columns))


def refresh_partitions(mart_path: str, all_articles: DataFrame, new_rows: DataFrame, build,
                       partition_col: str = "date") -> DataFrame:
    """D6 on a stored mart: recompute the partitions of the dates touched by
    ``new_rows`` from the articles alone and replace just those partitions
    (dynamic overwrite).  The mart itself is never read by this job, so no
    partition is read while it is being replaced.  Returns the rows written."""
    touched = new_rows.select(partition_col).distinct()
    recomputed = build(all_articles.join(touched, on=partition_col, how="left_semi"))
    write_partitions(recomputed, mart_path, partition_col)
    return recomputed


def write_partitions(df: DataFrame, path: str, partition_col: str = "date") -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
