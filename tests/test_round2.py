"""Null keys, repeats, dates and shipping: cases that the tables do not hold."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

import __spark_entry__ as E
from newslake.functions.timeparse import publish_time_parse
from newslake.functions.urls import article_key, url_parts
from newslake.operators import filters as fl
from newslake.operators import joins as jn
from newslake.operators import writes as wr
from newslake.plans.marts import agg_daily_trends

SF = "/root/testdata/sf0.001"


def test_null_url_has_no_key(spark):
    df = spark.createDataFrame([("https://a.b.com/1/x",), (None,)], "url string")
    assert [r.k for r in df.select(article_key(url_parts("url")).alias("k")).collect()][1] is None


def test_null_category_counts(spark):
    df = spark.createDataFrame([("2024-01-01", "s", None)] * 2 + [("2024-01-03", "s", None)], "date string, source string, category string") \
        .withColumn("date", F.col("date").cast("date"))
    got = {str(r.date): r.daily_count for r in agg_daily_trends(df, fill_calendar=True).collect()}
    assert got == {"2024-01-01": 2, "2024-01-02": 0, "2024-01-03": 1}


def test_sync_repeats_and_null_keys(spark):
    src = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "n"), ("2", "c")], "id string, v string")
    tgt = spark.createDataFrame([("2", "old")], "id string, v string")
    new, summary = wr.sync_incremental(src, tgt)
    assert sorted(map(tuple, new.collect())) == [("1", "a"), ("2", "old")]
    assert summary.first().inserted == 1


def test_tags_of_null_id(spark):
    df = spark.createDataFrame([(None, [1, 2])], "id long, tag_ids array<long>")
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "id long, slug string")
    assert jn.tag_lookup(df, "id", "tag_ids", dim).first().tags == "x,y"


def test_cutoff_of_null_listing(spark):
    df = spark.createDataFrame([(None, 1, "2024-02-01"), (None, 2, "2023-01-01"), (None, 3, "2024-02-01")], "listing string, pos int, ts string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert [r.pos for r in fl.newest_first_cutoff(df, ["listing"], "pos", "ts", "2024-01-01").collect()] == [1]


def test_publish_time_forms(spark):
    forms = ["2024", "2024-01", "20240105T101500", "2024-01-05T10:15:00+02:00", "2024-01-05", "2024-01-05 10:15:00Z"]
    df = spark.createDataFrame([(f,) for f in forms], "m string")
    got = [r.t and str(r.t) for r in df.select(publish_time_parse("m").alias("t")).collect()]
    assert got == [None, None, "2024-01-05 10:15:00", "2024-01-05 10:15:00", "2024-01-05 00:00:00", "2024-01-05 10:15:00"]
    two = spark.createDataFrame([(None, "January  5, 2024")], "m string, b string")
    assert str(two.select(publish_time_parse("m", "b").alias("t")).first().t) == "2024-01-05 00:00:00"


def test_no_round_robin_shuffle(spark):
    for name in ("pending_articles", "table_count", "exists_limit1", "insert_ignore", "tokenise", "page_fields", "title_fallback"):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "RoundRobin" not in plan, name


def test_workers_get_the_package(tmp_path):
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {here!r}); import __spark_entry__ as E; from newslake.session import build_session\n"
            f"s = build_session('local[2]', 2)\nprint('ROWS', sum(E.queries()[q](s, {SF!r}).count() for q in ('page_fields', 'harvest_counters')))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
