"""Window operators.

Rolling means and week-over-week run on already-aggregated rows (one per
day / week), never on raw articles.  "Best row per key" operators are
written as aggregates (``max``/``min`` over a struct whose leading fields are
the sort keys) so that rows of a hot key are reduced map-side before the
shuffle instead of being gathered into one window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslake.operators.aggregates import daily_counts, weekly_counts


def rolling_7(articles: DataFrame) -> DataFrame:
    """Daily counts with the mean over the current and 6 preceding
    *existing* days (ROWS frame: missing days are not filled)."""
    daily = daily_counts(articles).withColumnRenamed("daily_count", "daily_articles")
    # Un-partitioned window: input is one row per day, so it is small.
    w = Window.orderBy("date").rowsBetween(-6, 0)
    return (daily.withColumn("rolling_7day_avg", F.avg("daily_articles").over(w))
            .orderBy(F.desc("date")))


def rolling_7_by_source(articles: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """As N1, per source (or other keys)."""
    keys = list(keys or ["source"])
    daily = daily_counts(articles, by=keys)
    w = Window.partitionBy(*keys).orderBy("date").rowsBetween(-6, 0)
    return (daily.withColumn("moving_avg_7d", F.avg("daily_count").over(w))
            .orderBy(F.desc("date"), *keys))


def week_over_week(articles: DataFrame, key: str = "category") -> DataFrame:
    """Per key and Monday-week: count, the previous existing week's count
    (LAG) and the change in percent rounded to one place (NULL when the
    previous week is absent or zero)."""
    weekly = weekly_counts(articles, by=[key]).withColumnRenamed("weekly_count", "articles_this_week")
    w = Window.partitionBy(key).orderBy("week")
    prev = F.lag("articles_this_week").over(w)
    return (weekly.withColumn("articles_last_week", prev)
            .withColumn("percent_change",
                        F.round(F.lit(100.0).cast("double") * (F.col("articles_this_week") - F.col("articles_last_week"))
                                / F.nullif(F.col("articles_last_week"), F.lit(0)).cast("double"), 1))
            .orderBy(F.desc("articles_this_week")))


def best_per_key(df: DataFrame, key: str | list[str], order: list[Column], pick: str = "max") -> DataFrame:
    """Keep one row per key: the greatest (or least) by ``order``; remaining
    ties are broken by the row's own values, so the result is deterministic.

    ``order`` entries are ascending-comparable columns: NULL sorts lowest, so
    with ``pick="max"`` NULLs come last.
    """
    keys = [key] if isinstance(key, str) else list(key)
    payload = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)],
                        F.struct(*payload).alias("_row"))
    agg = F.max(ordering) if pick == "max" else F.min(ordering)
    best = df.groupBy(*keys).agg(agg.alias("_best"))
    return best.select(*keys, *[F.col("_best._row")[c].alias(c) for c in payload])


def dedupe_latest(df: DataFrame, key: str = "id", newest: str = "publish_time") -> DataFrame:
    """Best row per id: titled rows first, then the newest ``newest``
    (NULLs last), then a deterministic tie-break on the remaining columns."""
    return best_per_key(df, key, [F.col("title").isNotNull(), F.col(newest)], pick="max")


def first_wins(df: DataFrame, key: str | list[str], arrival: str | list[str]) -> DataFrame:
    """Drop repeats inside a batch; the first arrival wins."""
    arr = [arrival] if isinstance(arrival, str) else list(arrival)
    return best_per_key(df, key, [F.col(a) for a in arr], pick="min")
