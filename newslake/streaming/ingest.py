"""Structured Streaming ingest (M1, and M2's variant with a watermark).

* :func:`stream_ingest` (M1): landed record files -> an append-only parquet
  log through the file sink (exactly-once with its checkpoint);
  ``maxFilesPerTrigger`` plays the buffer size, ``availableNow`` is the final
  flush.  The current table is the insert-if-absent fold of the log
  (:func:`current_table`).
* :func:`stream_upsert_table` (M1 + W2): micro-batches folded into a table of file lists,
  each exactly once.
* known ids as keyed state (M2) are in :mod:`newslake.streaming.known`, progress as a
  table (M3) in :mod:`newslake.streaming.progress`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from newslake.operators.versions import FileTable
from newslake.operators.writes import insert_ignore, upsert_two_phase


def stream_ingest(spark: SparkSession, landing: str, schema: StructType, log_path: str, checkpoint: str,
                  files_per_trigger: int | None = 1, available_now: bool = True, fmt: str = "parquet") -> StreamingQuery:
    """M1: start the landing -> log stream; returns the running query.  Without
    ``files_per_trigger`` a micro-batch takes all files that have landed."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    src = reader.load(landing)
    w = (src.writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def current_table(spark: SparkSession, log_path: str, schema: StructType, snapshot: DataFrame | None = None,
                  key: str = "id", order: str = "seq", how: str = "insert_ignore") -> DataFrame:
    """The table as of the log, folded over ``snapshot`` (or an empty table):
    ``how="insert_ignore"`` (W1, first arrival wins) or ``how="upsert"`` (W2,
    stubs then full records in ``order``)."""
    log = spark.read.schema(schema).parquet(log_path)
    base = snapshot if snapshot is not None else spark.createDataFrame([], schema).drop(order)
    if how == "upsert":
        return upsert_two_phase(base, log, order)
    return insert_ignore(base, log, key, order)


def stream_upsert_table(table: FileTable, landing: str, schema: StructType, checkpoint: str, name: str, seq: str = "seq",
                        files_per_trigger: int | None = 1, fmt: str = "parquet") -> StreamingQuery:
    """M1 + W2: fold every micro-batch of landed records into ``table`` by two-phase upsert.

    The batch's number is committed in the same step as its rows (under ``name``, which
    stands for this stream and its checkpoint), so a batch that is replayed after a
    failure changes nothing.  Per id, records must arrive in ``seq`` order across batches.
    """
    reader = table.spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def fold(batch: DataFrame, batch_id: int) -> None:
        table.upsert_once(batch, name, batch_id, seq)

    return (reader.load(landing).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_dedup_state(spark: SparkSession, landing: str, schema: StructType, stored_ids: DataFrame,
                       log_path: str, checkpoint: str, key: str = "id", watermark: tuple[str, str] | None = None,
                       files_per_trigger: int = 1, fmt: str = "parquet") -> StreamingQuery:
    """M2, state-store variant: stream-static anti-join against the stored
    ids, then ``dropDuplicates`` on the key held in the state store (or
    ``dropDuplicatesWithinWatermark`` when ``watermark=(event_time_col,
    delay)`` bounds the state).  Every id is emitted at most once; which copy
    survives when repeats share one micro-batch is not ordered by arrival, so
    exact first-wins comes from folding the log with N5 instead.
    """
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(fmt).load(landing)
    fresh = src.join(stored_ids.select(key), on=key, how="left_anti")
    if watermark is not None:
        fresh = fresh.withWatermark(watermark[0], watermark[1]).dropDuplicatesWithinWatermark([key])
    else:
        fresh = fresh.dropDuplicates([key])
    return (fresh.writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())
