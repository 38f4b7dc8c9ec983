"""Data-quality checks (Q1-Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dq_unique(df: DataFrame, key: str = "id") -> DataFrame:
    """Q1: keys occurring more than once, with their counts."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


def dq_not_null(df: DataFrame, key: str = "id") -> DataFrame:
    """Q2: rows whose key is NULL."""
    return df.filter(F.col(key).isNull())


def dq_report(df: DataFrame, unique: list[str] = ("id",), not_null: list[str] = ("id",),
              multi_source_key: str | None = "id") -> DataFrame:
    """Q3: every check as a row (check, column, failures).

    ``not_null`` and ``unique`` checks come from one aggregate over one scan
    (NULL counts, and surplus rows of repeated keys = non-NULL count minus
    distinct count), turned into rows with ``stack``.  ``single_source``
    (keys seen with more than one source) needs its own grouping by key.
    """
    aggs, cells = [], []
    for i, c in enumerate(not_null):
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
        cells.append(("not_null", c, f"_n{i}"))
    for i, c in enumerate(unique):
        aggs.append((F.count(F.col(c)) - F.countDistinct(F.col(c))).alias(f"_u{i}"))
        cells.append(("unique", c, f"_u{i}"))
    one_pass = df.agg(*aggs)
    args = ", ".join(f"'{chk}', '{col}', `{ref}`" for chk, col, ref in cells)
    out = one_pass.select(F.expr(f"stack({len(cells)}, {args}) as (`check`, `column`, failures)"))
    if multi_source_key:
        multi = (df.filter(F.col(multi_source_key).isNotNull()).groupBy(multi_source_key)
                 .agg(F.countDistinct("source").alias("k"))
                 .agg(F.count_if(F.col("k") > 1).alias("failures")))
        out = out.unionByName(multi.select(F.lit("single_source").alias("check"),
                                           F.lit(multi_source_key).alias("column"), "failures"))
    return out
