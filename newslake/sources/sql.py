"""Ad-hoc SQL over registered tables (S3, S4) and CSV in place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newslake.operators.aggregates import category_count


def register(views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None,
            args: dict | list | None = None) -> DataFrame:
    """Run SQL over the given frames (registered as temp views), with
    optional bound parameters (``:name`` with a dict, ``?`` with a list)."""
    register(views or {})
    return spark.sql(sql, args=args) if args is not None else spark.sql(sql)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row and an inferred schema."""
    return spark.read.csv(path, header=True, inferSchema=True)


def query_csv(spark: SparkSession, path: str, sql: str, view: str = "read_csv_auto") -> DataFrame:
    """Query CSV files in place; the file set is exposed as ``view``."""
    read_csv(spark, path).createOrReplaceTempView(view)
    return spark.sql(sql)


def csv_category_count(spark: SparkSession, path: str, category: str = "category") -> DataFrame:
    """Rows per category over a CSV source."""
    return category_count(read_csv(spark, path), category)
