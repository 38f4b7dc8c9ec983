"""Table versions as lists of files: updates that rewrite only the files they touch.

A table is a folder of data files and a list of the files that make up each version.
A write finds the files that hold a row it changes (``_metadata.file_path``), writes
their rows anew, and commits a list that keeps all other files by name.  Lists are
committed by creating the next number, which only one writer can do.  The driver
handles file names, as it does for any scan of the table; rows stay on the executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newslake.operators import idfilter as idf
from newslake.operators.windows import first_wins
from newslake.operators.writes import conditional_update, split_rejects, upsert_two_phase
from newslake.schema import ARTICLE_SCHEMA


@dataclass(frozen=True)
class Version:
    """A version's number (-1: nothing committed yet), its files (names below the table's
    folder), the last batch each stream has brought into it, and the files of its id
    filter with the filter's number of blocks (0: the table keeps none)."""

    number: int = -1
    files: tuple[str, ...] = ()
    batches: dict[str, int] = field(default_factory=dict)
    filters: tuple[str, ...] = ()
    blocks: int = 0


@dataclass(frozen=True)
class Written:
    """What a write did: the version it made, and how many files it rewrote, kept and added."""

    version: Version
    rewritten: int
    kept: int
    added: int


class FileTable:
    """The table at ``root`` (on storage that the driver and all executors share)."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType = ARTICLE_SCHEMA, key: str = "id",
                 cluster: tuple[str, ...] = (), expected_ids: int = 0):
        """``cluster``: columns by whose ranges rows are dealt to files (default: the key).
        ``expected_ids``: give a new table a filter of its ids of that size; it is kept up
        with every write and committed with it."""
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.cluster, self.blocks = cluster or (key,), idf.blocks_for(expected_ids) if expected_ids else 0
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._read_all = jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray

    # ---- versions ---------------------------------------------------------
    def _list_path(self, number: int):
        return self._path(f"{self.root}/versions/{number:012d}.json")

    def current(self) -> Version:
        folder = self._path(f"{self.root}/versions")
        if not self._fs.exists(folder):
            return Version(blocks=self.blocks)
        numbers = [int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
        return self.version(max(numbers)) if numbers else Version(blocks=self.blocks)

    def version(self, number: int) -> Version:
        path = self._list_path(number)
        stream = self._fs.open(path)
        try:
            text = bytes(self._read_all(stream)).decode()
        finally:
            stream.close()
        entry = json.loads(text)
        return Version(number, tuple(entry["files"]), entry["batches"], tuple(entry["filters"]), entry["blocks"])

    def commit(self, files: list[str], after: Version, batches: dict[str, int] | None = None, filters: list[str] | None = None) -> Version:
        """The version after ``after``, with ``filters`` added to those it has.  Fails if another writer has made one meanwhile.
        The list is written under another name and renamed, so that no reader sees part of it."""
        new = Version(after.number + 1, tuple(sorted(files)), {**after.batches, **(batches or {})}, (*after.filters, *(filters or [])), after.blocks)
        target = self._list_path(new.number)
        if self._fs.exists(target):
            raise RuntimeError(f"version {new.number} of {self.root} exists already")
        part = self._path(f"{self.root}/versions/_{uuid.uuid4().hex}")
        out = self._fs.create(part, False)
        out.write(bytearray(json.dumps({"files": new.files, "batches": new.batches, "filters": new.filters, "blocks": new.blocks}).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(part, target):
            self._fs.delete(part, False)
            raise RuntimeError(f"version {new.number} of {self.root} was committed by another writer")
        return new

    # ---- reading ----------------------------------------------------------
    def read(self, version: Version | None = None) -> DataFrame:
        return self._frame((version or self.current()).files)

    def _frame(self, files) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{f}" for f in files])

    def id_filter(self, version: Version | None = None) -> DataFrame:
        """Rows of the version's id filter (see :mod:`newslake.operators.idfilter`)."""
        version = version or self.current()
        schema = "block long, " + ", ".join(f"{w} long" for w in idf.WORDS)
        if not version.filters:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in version.filters])

    @staticmethod
    def _names(paths: DataFrame) -> list[str]:
        """Names below the table's folder (``data/<write>/<file>``) of listed paths."""
        return sorted("/".join(r[0].split("/")[-3:]) for r in paths.distinct().collect())

    # ---- writing ----------------------------------------------------------
    def _store(self, rows: DataFrame, kind: str) -> list[str]:
        folder = f"{kind}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        return [f"{folder}/{s.getPath().getName()}" for s in self._fs.listStatus(self._path(f"{self.root}/{folder}"))
                if s.getPath().getName().startswith("part-") and s.getLen() > 0]

    def _write(self, rows: DataFrame) -> list[str]:
        """Data files of ``rows``, clustered, so that rows that change together tend to lie
        together; adaptive execution sizes them."""
        return self._store(rows.repartitionByRange(*self.cluster).sortWithinPartitions(*self.cluster), "data")

    def _filter_of(self, ids: DataFrame, now: Version) -> list[str]:
        return self._store(idf.build(ids, now.blocks, self.key), "filter") if now.blocks else []

    def append(self, rows: DataFrame) -> Written:
        """Add rows as they are (first load)."""
        now = self.current()
        new = self._write(rows.select(*self.schema.names))
        return Written(self.commit([*now.files, *new], now, None, self._filter_of(self._frame(new), now)), 0, len(now.files), len(new))

    def insert(self, batch: DataFrame, order: str = "seq") -> Written:
        """First arrivals of ids that are not stored, as new files; no file is rewritten.
        With an id filter the stored ids are read only if one of the batch's passes it."""
        now = self.current()
        if now.blocks:
            fresh = idf.fresh_rows(batch, self._frame(now.files), self.id_filter(now), now.blocks, self.key, order)
        else:
            firsts = first_wins(split_rejects(batch, self.key)[0], self.key, order)
            fresh = firsts.join(self._frame(now.files).select(self.key), self.key, "left_anti")
        new = self._write(fresh.select(*self.schema.names))
        return Written(self.commit([*now.files, *new], now, None, self._filter_of(self._frame(new), now)), 0, len(now.files), len(new))

    def _rewrite(self, now: Version, touched: list[str], change: Callable[[DataFrame], DataFrame]) -> tuple[list[str], list[str]]:
        new = self._write(change(self._frame(touched)))
        gone = set(touched)
        return new, [f for f in now.files if f not in gone]

    def update(self, predicate: Column, updates: dict[str, Column]) -> Written:
        """Set columns (not the key) where ``predicate`` holds.  Its columns alone are read
        to find the files that hold such a row; the others are not rewritten."""
        if self.key in updates:
            raise ValueError(f"{self.key} is the table's key")
        now = self.current()
        touched = self._names(self._frame(now.files).filter(predicate).select("_metadata.file_path")) if now.files else []
        if not touched:
            return Written(now, 0, len(now.files), 0)
        new, kept = self._rewrite(now, touched, lambda rows: conditional_update(rows, predicate, updates))
        return Written(self.commit([*kept, *new], now), len(touched), len(kept), len(new))

    def upsert(self, batch: DataFrame, seq: str = "seq", batches: dict[str, int] | None = None) -> Written:
        """Two-phase upsert of ``batch``.  Stored rows of the batch's ids all lie in the
        files found by a semi-join on the id column, so that folding the batch over these
        files alone equals folding it over the table.  With an id filter only ids that pass
        it are looked for, and none are if none does."""
        now = self.current()
        good, _ = split_rejects(batch, self.key)
        touched: list[str] = []
        if now.files:
            stored = self._frame(now.files).select(self.key, F.col("_metadata.file_path").alias("_file"))
            ids = good.select(self.key) if not now.blocks else idf.passing_written(good, self.id_filter(now), now.blocks, self.key)
            if not now.blocks or not ids.isEmpty():
                touched = self._names(stored.join(ids, self.key, "left_semi").select("_file"))
        new, kept = self._rewrite(now, touched, lambda rows: upsert_two_phase(rows, good, seq))
        return Written(self.commit([*kept, *new], now, batches, self._filter_of(good, now)), len(touched), len(kept), len(new))

    def upsert_once(self, batch: DataFrame, stream: str, batch_id: int, seq: str = "seq") -> Written | None:
        """:meth:`upsert` for a micro-batch: its number is committed in the same list as its
        rows, and a batch the table has already is left out (None)."""
        if self.current().batches.get(stream, -1) >= batch_id:
            return None
        return self.upsert(batch, seq, {stream: batch_id})


__all__ = ["FileTable", "Version", "Written"]
