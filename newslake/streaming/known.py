"""Known ids held as keyed state (M2).

The state store holds one entry for every id that has landed, so a micro-batch reads its
own rows and looks their ids up in the store, whatever the length of the log.  Ids stored
before the stream are written beside its state when it first starts; ids that are new to
the state are looked up there, by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from newslake.session import path_exists

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Rows a task of :func:`firsts` gathers before it compares them.
LEAST_HELD = 10_000


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB (on disk, changes to the
    checkpoint); the session's own setting comes back afterwards."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_STORE) if before is None else spark.conf.set(_STORE, before)


def _firsts(rows: pa.Table | pa.RecordBatch, key: str, columns: list[str]) -> pa.Table | pa.RecordBatch:
    """The lowest row of every id, by ``columns``; nulls come first, as in :func:`first_wins`."""
    order = pc.sort_indices(rows, sort_keys=[(c, "ascending") for c in [key, *columns]], null_placement="at_start")
    ids = np.asarray(rows.column(key).take(order))
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    return rows.take(order.filter(pa.array(first)))


def firsts_of_slices(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The first arrival of every id in each Arrow batch: what a map-side combine leaves
    of an id that fills a micro-batch."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield _firsts(b, key, columns)

    return df.mapInArrow(step, df.schema)


def firsts(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The first arrival of every id, one partition of ids at a time.  A task holds its ids'
    lowest rows so far and at most as many rows again that were not yet compared."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, n = None, [], 0
        for b in batches:
            waiting.append(b)
            n += b.num_rows
            if n > max(LEAST_HELD, held.num_rows if held else 0):
                rows = pa.Table.from_batches(waiting)
                held = _firsts(rows if held is None else pa.concat_tables([held, rows]), key, columns).combine_chunks()
                waiting, n = [], 0
        if n:
            rows = pa.Table.from_batches(waiting)
            held = _firsts(rows if held is None else pa.concat_tables([held, rows]), key, columns)
        if held is not None:
            yield from held.to_batches(max_chunksize=LEAST_HELD)

    return firsts_of_slices(df, key, columns).repartition(key).mapInArrow(step, df.schema)


def stored_beside(spark: SparkSession, stored_ids: DataFrame, checkpoint: str, key: str) -> DataFrame:
    """Ids stored before the stream's first start: written under ``checkpoint`` then, and
    only read there when it starts again."""
    path = checkpoint.rstrip("/") + "/stored_ids"
    ids = stored_ids.filter(F.col(key).isNotNull()).select(key).distinct()
    if not path_exists(spark, path + "/_SUCCESS"):
        ids.write.mode("overwrite").parquet(path)
    return spark.read.schema(ids.schema).parquet(path)


def new_arrivals(stream: DataFrame, stored_ids: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Rows of ``stream`` that bring an id neither stored nor seen before: within a
    micro-batch the lowest ``order`` wins (ties: the lowest row).  Rows without an id are
    left out.  Needs :func:`rocksdb_state` around the start of the stream."""
    columns = [order, *[c for c in stream.columns if c not in (key, order)]]
    arrived = firsts(stream.filter(F.col(key).isNotNull()), key, columns).dropDuplicates([key])
    return arrived.join(stored_ids, key, "left_anti").select(*stream.columns)


def stream_known_ids(spark: SparkSession, landing: str, schema: StructType, stored_ids: DataFrame, log_path: str,
                     checkpoint: str, key: str = "id", order: str = "seq", files_per_trigger: int | None = 1,
                     fmt: str = "parquet") -> StreamingQuery:
    """M2: landed records -> a log that holds each new id once (exactly-once file sink;
    restarts go on from what ``checkpoint`` holds and do not read ``stored_ids`` again)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    stored = stored_beside(spark, stored_ids, checkpoint, key)
    fresh = new_arrivals(reader.load(landing), stored, key, order)
    with rocksdb_state(spark):
        return (fresh.writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(availableNow=True).start())


__all__ = ["firsts", "firsts_of_slices", "new_arrivals", "rocksdb_state", "stored_beside", "stream_known_ids"]
