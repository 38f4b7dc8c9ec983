"""Cases of the third round's findings."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newslake.llm import pieces
from newslake.llm.common import slices
from newslake.session import shared_path
from newslake.streaming import known as kn


def test_sampling_holds_little_whatever_the_batch():
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("abcdefghilmnoprstu") for _ in range(r.randrange(3, 12))) for _ in range(600)) for _ in range(600)]
    lattice = pieces.Lattice(pieces.read_vocabulary())
    batch = pa.RecordBatch.from_pydict({"text": texts})
    tracemalloc.start()
    try:
        n = sum(len(lattice.sample(b.column("text").to_pylist(), np.zeros(b.num_rows, np.int64))[0])
                for b in slices(iter([batch]), "text", pieces.PIECE_BYTES))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 0 and peak < 100e6          # 2.7 MB of texts at once took several times that


def test_known_ids_are_looked_up_in_the_jvm(spark):
    root = shared_path(spark, "t_known_native")
    df = spark.range(20_000).selectExpr("if(id % 2 = 0, cast(id % 50 as string), cast(id as string)) id", "-id seq")
    df.repartition(4).write.parquet(root + "/landing")
    stored = spark.createDataFrame([("4",), ("7",), (None,)], "id string")
    q = kn.stream_known_ids(spark, root + "/landing", df.schema, stored, root + "/log", root + "/ckpt", files_per_trigger=None)
    q.awaitTermination()
    assert [s["operatorName"] for s in q.lastProgress["stateOperators"]] == ["dedupe"]
    want = df.groupBy("id").agg(F.min("seq").alias("seq")).where("id NOT IN ('4', '7')")
    got = spark.read.parquet(root + "/log")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
