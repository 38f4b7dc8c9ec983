"""Tables laid out by date: one folder a day (or month), read by date range.

A date bound on such a table is a partition filter, so folders outside the window are
neither listed for splits nor opened.  The bound may be a literal or a scalar subquery;
Spark evaluates the latter before it picks the folders.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from newslake.operators.filters import date_window
from newslake.schema import ARTICLE_SCHEMA
from newslake.session import path_exists

UNITS = {"month": "MM", "year": "YYYY"}


class DatedTable:
    """A parquet table at ``path``, in folders by ``date`` or, with ``unit`` ("month",
    "year"), by the first day of that unit (column ``<date>_<unit>``, beside the date)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType = ARTICLE_SCHEMA, date: str = "date", unit: str | None = None):
        if unit is not None and unit not in UNITS:
            raise ValueError(f"unit must be one of {sorted(UNITS)}")
        self.spark, self.path, self.date, self.unit = spark, path.rstrip("/"), date, unit
        self.part = date if unit is None else f"{date}_{unit}"
        self.schema = schema if unit is None else StructType([*schema.fields, StructField(self.part, DateType())])

    def _of(self, day: Column) -> Column:
        return day if self.unit is None else F.trunc(day, UNITS[self.unit])

    def save(self, df: DataFrame, mode: str = "append") -> DatedTable:
        """Write rows into their folders.  They are rebalanced by folder first: few files a
        folder, and a folder that holds much of the input is dealt to several tasks."""
        rows = df if self.unit is None else df.withColumn(self.part, self._of(F.col(self.date)))
        rows.select(*self.schema.names).hint("rebalance", self.part).write.mode(mode).partitionBy(self.part).parquet(self.path)
        return self

    def read(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path)

    def latest_part(self) -> _dt.date | None:
        """First day of the newest folder, from the folder names alone (null dates aside)."""
        if not path_exists(self.spark, self.path):
            return None
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory()]
        days = [n.partition("=")[2] for n in names if n.startswith(self.part + "=")]
        return max((_dt.date.fromisoformat(d) for d in days if d[:1].isdigit()), default=None)

    def latest(self) -> Column:
        """The newest date, to anchor windows: a literal if folders are days, else a scalar
        subquery that reads the dates of the newest folder."""
        part = self.latest_part()
        if self.unit is None or part is None:
            return F.lit(part).cast("date")
        return self.read().filter(F.col(self.part) == F.lit(part)).select(F.max(F.col(self.date).cast("date"))).scalar()

    def window(self, days: int | None = None, start=None, as_of=None) -> DataFrame:
        """F3 on the stored table: rows of the last ``days`` days before ``as_of`` (default:
        :meth:`latest`), or from ``start`` on; only their folders are read."""
        anchor = self.latest() if as_of is None and start is None else as_of
        rows = date_window(self.read(), days, start, anchor, col=self.date)
        if self.unit is None:
            return rows
        first = F.lit(start).cast("date") if start is not None else F.date_sub((F.lit(anchor) if not isinstance(anchor, Column) else anchor).cast("date"), days)
        return rows.filter(F.col(self.part) >= self._of(first))


__all__ = ["DatedTable"]
