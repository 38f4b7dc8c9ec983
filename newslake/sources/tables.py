"""The articles table and parquet scans/sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newslake.schema import ARTICLE_SCHEMA, conform_articles
from newslake.session import path_exists


def open_articles(spark: SparkSession, path: str) -> DataFrame:
    """Open the articles table at ``path``; create it empty if absent.
    The declared schema is always applied (no inference)."""
    if not path_exists(spark, path):
        spark.createDataFrame([], ARTICLE_SCHEMA).write.mode("errorifexists").parquet(path)
    return spark.read.schema(ARTICLE_SCHEMA).parquet(path)


def save_articles(df: DataFrame, path: str, mode: str = "append") -> str:
    conform_articles(df).write.mode(mode).parquet(path)
    return path


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where=None) -> DataFrame:
    """Full or projected scan; the projection and predicate reach the
    parquet reader (ReadSchema / PushedFilters)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.filter(where)
    return df.select(*columns) if columns else df


def export_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table or query result to parquet; returns the read-back frame."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.parquet(path)


def query_parquet(spark: SparkSession, sql: str, **paths: str) -> DataFrame:
    """Query parquet files in place: ``{name}`` placeholders in ``sql``
    become ``parquet.`path``` relations."""
    rel = {k: f"parquet.`{v}`" for k, v in paths.items()}
    return spark.sql(sql.format(**rel))


__all__ = ["open_articles", "save_articles", "scan", "export_parquet", "query_parquet"]
