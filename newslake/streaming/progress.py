"""Micro-batch progress as a table (M3).

A :class:`ProgressLog` listens to the session's streams and keeps one record for every
finished micro-batch, also across restarts and beyond the few reports a running query
remembers.  A record is one small file named by query and batch, so a batch that is
replayed replaces its record.  Folders are dates, which bounds what a reader of some
days lists.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS_SCHEMA = ("query_id string, run_id string, name string, batch_id long, num_input_rows long, timestamp string,"
                   " trigger_ms long, state_rows long, state_memory_bytes long, sources string, sink string, day date")


class ProgressLog(StreamingQueryListener):
    """Appends every progress event to ``path``; use as a context::

        with ProgressLog(spark, path) as log:
            query = ...start()
            query.awaitTermination()
            log.wait(query)                  # its events have all arrived
        read_progress(spark, path)
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()
        self.errors: list[str] = []

    def __enter__(self) -> ProgressLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> None:
        self._spark.streams.removeListener(self)

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end_of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        states = p.stateOperators
        day = p.timestamp[:10]
        record = {"query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "num_input_rows": p.numInputRows,
                  "timestamp": p.timestamp, "trigger_ms": p.durationMs.get("triggerExecution", 0),
                  "state_rows": sum(s.numRowsTotal for s in states), "state_memory_bytes": sum(s.memoryUsedBytes for s in states),
                  "sources": "; ".join(s.description for s in p.sources), "sink": p.sink.description}
        try:
            self._put(f"{self._path}/day={day}/{p.id}-{p.batchId:012d}.json", json.dumps(record))
        except Exception as e:  # noqa: BLE001  the listener bus would only log it; kept for wait()
            self.errors.append(f"batch {p.batchId}: {e}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.runId)).set()

    def _put(self, name: str, text: str) -> None:
        sc = self._spark.sparkContext
        part = sc._jvm.org.apache.hadoop.fs.Path(name.replace("/day=", "/_writing/day="))
        done = sc._jvm.org.apache.hadoop.fs.Path(name)
        fs = done.getFileSystem(sc._jsc.hadoopConfiguration())
        out = fs.create(part, True)
        out.write(bytearray((text + "\n").encode()))
        out.close()
        fs.mkdirs(done.getParent())
        fs.delete(done, False)
        if not fs.rename(part, done):
            raise OSError(f"could not rename {part} to {done}")

    def wait(self, query: StreamingQuery, timeout: float = 60) -> None:
        """Until all events of an ended run have been written; raises if one was not."""
        if not self._end_of(str(query.runId)).wait(timeout):
            raise TimeoutError(f"no end of run {query.runId} within {timeout} s")
        if self.errors:
            raise OSError("; ".join(self.errors))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished micro-batch.  Where two days hold the same batch (one finished
    again after a failure), the latest record counts."""
    rows = spark.read.schema(PROGRESS_SCHEMA).json(path)
    names = rows.columns
    last = rows.groupBy("query_id", "batch_id").agg(F.max(F.struct("timestamp", F.struct(*names).alias("row"))).alias("last"))
    return last.select("last.row.*")


__all__ = ["PROGRESS_SCHEMA", "ProgressLog", "read_progress"]
