"""The one article table type and helpers to conform frames to it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("url", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("author", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("publish_time", T.TimestampNTZType(), True),
    T.StructField("content", T.StringType(), True),
    T.StructField("tags", T.StringType(), True),
])

ARTICLE_COLUMNS = [f.name for f in ARTICLE_SCHEMA.fields]
# Upsert never changes these once a row exists.
KEY_COLUMNS = ["id", "source", "url", "category", "date"]
# Upsert replaces these five together (NULLs included).
CONTENT_COLUMNS = ["title", "author", "publish_time", "content", "tags"]


def conform_articles(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Project ``df`` onto ARTICLE_SCHEMA: cast present columns, NULL for absent ones.

    ``extra`` columns (e.g. an arrival ``seq``) are carried through after the
    article columns.
    """
    present = set(df.columns)
    cols: list[Column] = []
    for f in ARTICLE_SCHEMA.fields:
        c = F.col(f.name) if f.name in present else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    for e in extra or []:
        cols.append(F.col(e))
    return df.select(*cols)
