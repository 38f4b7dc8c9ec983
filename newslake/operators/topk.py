"""Sorts, limits and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_report(df: DataFrame, by: list, descending: list[bool] | None = None) -> DataFrame:
    """Order a report by metric(s) or by date desc, source."""
    desc = descending or [True] * len(by)
    return df.orderBy(*[F.col(c).desc() if d else F.col(c).asc() for c, d in zip(by, desc)])


def top_terms(term_counts: DataFrame, k: int = 10, id_col: str = "id", term: str = "token") -> DataFrame:
    """The ``k`` most common terms per article; ties by first occurrence.

    ``row_number() <= k`` lets the optimiser insert a partial group-limit
    before the shuffle, so each map task forwards at most ``k`` rows per
    article.
    """
    # first_pos is unique per (article, term), so (n, first_pos) is already a
    # total order inside an article: no string tie-break is needed.
    w = Window.partitionBy(id_col).orderBy(F.desc("n"), F.asc("first_pos"))
    return (term_counts.withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k))


def exists_limit1(df: DataFrame, key: str, value) -> DataFrame:
    """``SELECT 1 ... WHERE key = value LIMIT 1`` probe; the limit lets
    the scan stop at the first match."""
    return df.filter(F.col(key) == F.lit(value)).select(F.lit(1).alias("present")).limit(1)
