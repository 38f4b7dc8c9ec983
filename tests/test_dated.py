import datetime as dt

import pytest
from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.operators import filters as fl
from newslake.operators import windows as wn
from newslake.plans import marts as mt
from newslake.session import shared_path
from newslake.sources.dated import DatedTable

SF = "/root/testdata/sf0.001"


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def spoil(spark, path):
    """Replace every file of a folder by rubbish: whoever opens one fails."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 0
    for s in fs.listStatus(folder):
        if s.getPath().getName().startswith("part-"):
            out = fs.create(s.getPath(), True)
            out.write(bytearray(b"rubbish"))
            out.close()
            n += 1
    assert n


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("unit", [None, "month"])
def test_only_folders_of_the_window_are_opened(spark, unit):
    docs = fx.articles_from_documents(fx.load(spark, SF, "documents"))         # 2024-01-01 .. 2024-03-30
    table = DatedTable(spark, shared_path(spark, "t_dated"), unit=unit).save(docs)
    want = rows(fl.date_window(docs, days=7, as_of="2024-03-30"))
    assert rows(table.window(days=7).select(*docs.columns)) == want
    assert rows(table.window(days=7, as_of=fl.as_of_date(table.read())).select(*docs.columns)) == want
    assert rows(table.window(start="2024-03-23").select(*docs.columns)) == want
    for old in (["2024-01-01", "2024-02-10", "2024-03-22"] if unit is None else ["2024-01-01", "2024-02-01"]):
        spoil(spark, f"{table.path}/{table.part}={old}")
    assert rows(table.window(days=7).select(*docs.columns)) == want
    with pytest.raises(Exception):
        table.window(days=300).collect()
    text = plan(table.window(days=7))
    assert f"PartitionFilters: [isnotnull({table.part}" in text


def test_windows_and_trends_over_folders_equal_those_over_rows(spark):
    ev = fx.articles_from_events(fx.load(spark, SF, "events"))
    table = DatedTable(spark, shared_path(spark, "t_ev"), ev.schema).save(ev)
    recent = fl.date_window(ev, days=10, as_of=fl.as_of_date(ev))
    for f in (wn.rolling_7, wn.rolling_7_by_source, wn.week_over_week):
        assert rows(f(table.window(days=10))) == rows(f(recent))
    docs = fx.articles_from_documents(fx.load(spark, SF, "documents"))
    stored = DatedTable(spark, shared_path(spark, "t_docs")).save(docs)
    spoil(spark, f"{stored.path}/date=2024-03-01")
    got = mt.trending_terms(stored.read(), stored.latest(), k=50)
    assert rows(got) == rows(mt.trending_terms(docs, fl.as_of_date(docs), k=50))
    assert "PartitionFilters: [isnotnull(date" in plan(got)


def test_null_dates_empty_tables_and_appends(spark):
    schema = "id string, date date"
    table = DatedTable(spark, shared_path(spark, "t_null"), spark.createDataFrame([], schema).schema)
    assert table.latest_part() is None and table.read().count() == 0 and table.window(days=3).count() == 0
    day = dt.date(2024, 5, 5)
    table.save(spark.createDataFrame([("a", day), ("b", None)], schema))
    table.save(spark.createDataFrame([("c", dt.date(2024, 5, 1)), ("a", day)], schema))
    assert table.read().count() == 4 and table.latest_part() == day
    assert rows(table.window(days=3).select("id")) == rows(spark.createDataFrame([("a",), ("a",)], "id string"))
    with pytest.raises(ValueError):
        DatedTable(spark, "x", unit="week")


def test_a_folder_with_most_rows_is_written_by_several_tasks(spark):
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        hot = spark.range(60000).select(F.sha2(F.col("id").cast("string"), 256).alias("id"),
                                        F.date_add(F.lit(dt.date(2024, 1, 1)), F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(9).cast("int")).alias("date"))
        table = DatedTable(spark, shared_path(spark, "t_hot"), hot.schema).save(hot)
        files = table.read().where("date = '2024-01-10'").inputFiles()
        assert len([f for f in files if "2024-01-10" in f]) > 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
