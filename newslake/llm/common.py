"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.session import shared_path

#: Pattern of a word: a run of anything but space and the controls TAB..CR.
WORD_GAP = r"[\x20\x09-\x0D]+"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 (``bytes.split`` cuts at exactly the six ASCII
    blanks of ``[^\\x20\\x09-\\x0D]+``); a null text has none."""
    return [] if text is None else text.encode("utf-8").split()


def word_count(text) -> "F.Column":
    """Number of words of a text column as long; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, WORD_GAP), "")).cast("long"), F.lit(0).cast("long")) \
        * F.when(text.isNull(), F.lit(0)).otherwise(F.lit(1))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared scratch folder and read it back.

    Cuts the lineage with files every executor can see, so what follows neither
    recomputes ``df`` nor depends on the executor that made it.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written intermediate that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``limit`` bytes in each
    piece (one longer value stands alone), which bounds a step's memory."""
    for b in batches:
        start, held = 0, 0
        sizes = [0 if v is None else v for v in pc.binary_length(b.column(column)).to_pylist()]
        for i, n in enumerate(sizes):
            if i > start and held + n > limit:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < b.num_rows:
            yield b.slice(start)

