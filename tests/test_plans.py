"""Plan shape: what the scale claims rest on."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from newslake.operators import topk as tk
from newslake.operators import windows as wn
from newslake.operators import writes as wr
from newslake.schema import ARTICLE_SCHEMA

SF = "/root/testdata/sf0.001"
RISKY = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in E.queries() if not k.startswith("stream_")))
def test_no_cross_joins_or_row_udfs(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert not [r for r in RISKY if r in plan]


def _hot(spark, n=3000):
    # One id holds a third of all rows.
    rows = [("hot" if i % 3 == 0 else f"id{i}", "s", f"u{i}", "c", None if i % 2 else f"t{i}", None, None, None,
             f"c{i}", None, i) for i in range(n)]
    schema = T.StructType(ARTICLE_SCHEMA.fields + [T.StructField("seq", T.LongType())])
    return spark.createDataFrame(rows, schema)


def test_hot_key_reduced_before_shuffle(spark):
    df = _hot(spark)
    for out in (wn.first_wins(df, "id", "seq"), wn.dedupe_latest(df, "id", "seq"),
                wr.upsert_two_phase(spark.createDataFrame([], ARTICLE_SCHEMA), df)):
        plan = _plan(out)
        assert "partial_max" in plan or "partial_min" in plan
    first = {r.id: r.seq for r in wn.first_wins(df, "id", "seq").collect()}
    assert first["hot"] == 0 and len(first) == 1 + 2000
    best = {r.id: r.seq for r in wn.dedupe_latest(df, "id", "seq").collect()}
    assert best["hot"] == 2994          # highest seq among titled (even) hot rows
    up = {r.id: r.url for r in wr.upsert_two_phase(spark.createDataFrame([], ARTICLE_SCHEMA), df).collect()}
    assert up["hot"] == "u0"           # key columns from the first record


def test_top_k_limited_before_shuffle(spark):
    counts = spark.range(1000).select((F.col("id") % 3).alias("id"), F.col("id").cast("string").alias("token"),
                                      F.lit(1).alias("n"), F.col("id").alias("first_pos"))
    out = tk.top_terms(counts, 10)
    assert "WindowGroupLimit" in _plan(out)
    assert out.count() == 30
