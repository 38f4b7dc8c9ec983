"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.constants import INDEX_URL_TEMPLATE


def date_to_text(d) -> Column:
    """``yyyy-MM-dd`` text of a date (work lists carry dates as text)."""
    return (F.col(d) if isinstance(d, str) else d).cast("string")


def monday_of(d) -> Column:
    """Monday of the ISO week holding date ``d`` (date arithmetic only, so no
    session time zone is involved)."""
    c = F.col(d) if isinstance(d, str) else d
    return F.date_sub(c, F.pmod(F.dayofweek(c) + 5, F.lit(7)))


def date_spine(bounds: DataFrame, start_col: str = "start", end_col: str = "end",
               url_template: str = INDEX_URL_TEMPLATE) -> DataFrame:
    """One row per day from start to end inclusive, with its index-page URL.

    ``bounds`` holds one row per range (a range per listing, or a single
    overall range); the days of each range are generated in place.
    """
    prefix, _, suffix = url_template.partition("{date}")
    days = bounds.select(*[c for c in bounds.columns if c not in (start_col, end_col)],
                         F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"),
                                              F.expr("interval 1 day"))).alias("day"))
    return days.withColumn("index_url", F.concat(F.lit(prefix), F.col("day").cast("string"), F.lit(suffix)))
