"""Set operations (U1, U2; bag union is :func:`newslake.sources.listings.union_sources`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_ids(df: DataFrame, source: str | None = None, key: str = "id") -> DataFrame:
    """Distinct ids (of one source)."""
    if source is not None:
        df = df.filter(F.col("source") == source)
    return df.select(key).distinct()


def missing_rows(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``a`` whose key is not in ``b`` (keyed difference)."""
    return a.join(b.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti")
