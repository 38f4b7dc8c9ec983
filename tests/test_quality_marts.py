import datetime as dt

from pyspark.sql import functions as F

from newslake.operators import filters as fl
from newslake.operators import quality as dq
from newslake.plans import marts as mt
from newslake.schema import ARTICLE_SCHEMA


def _a(i, source="s", title="t", content="c", date=dt.date(2024, 1, 1), tags="a, b"):
    return (i, source, f"u{i}", "cat", title, None, date, None, content, tags)


def test_dq_report_counts_each_check(spark):
    # K2: numeric ids of two publishers collide; the report counts such ids.
    df = spark.createDataFrame([_a("1", "x"), _a("1", "y"), _a("2"), _a(None), _a("3", title=None)], ARTICLE_SCHEMA)
    got = {(r.check, r.column): r.failures for r in dq.dq_report(df, unique=["id"], not_null=["id", "title"]).collect()}
    assert got == {("not_null", "id"): 1, ("not_null", "title"): 1, ("unique", "id"): 1, ("single_source", "id"): 1}
    assert [tuple(r) for r in dq.dq_unique(df).collect()] == [("1", 2)]
    assert dq.dq_not_null(df).count() == 1


def test_staging_cuts_only_matching_rows_and_splits_tags(spark):
    # K8: staging = boilerplate cut where source and marker match, tags as an untrimmed array.
    df = spark.createDataFrame([_a("1", "inquirer", "T\n\nx", "Body\n\nmore Read Next junk"),
                                _a("2", "other", "T", "Body Read Next junk"),
                                _a("3", "inquirer", "T", "no marker")], ARTICLE_SCHEMA)
    got = {r.id: (r.title, r.content, r.tags) for r in mt.stg_articles(df).collect()}
    assert got["1"] == ("T x", "Body more", ["a", " b"])
    assert got["2"][1] == "Body Read Next junk" and got["3"][1] == "no marker"


def test_date_window_anchor(spark):
    # Relative windows take an explicit anchor (here the latest date in the data).
    df = spark.createDataFrame([_a(str(i), date=dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(40)],
                               ARTICLE_SCHEMA)
    by_data = fl.date_window(df, days=30, as_of=fl.as_of_date(df))
    by_literal = fl.date_window(df, days=30, as_of="2024-02-09")
    assert by_data.count() == by_literal.count() == 31
    assert fl.date_window(df, start="2024-02-05").agg(F.min("date")).first()[0] == dt.date(2024, 2, 5)
