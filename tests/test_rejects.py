import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.session import shared_path
from newslake.sources import listings as ls
from newslake.sources import rejects as rj

SF = "/root/testdata/sf0.001"


def test_records_in_equal_accepted_and_rejected(spark):
    rows = [("1", "2024-01-05", "2024-01-05 10:00:00", "t"), (None, "2024-01-05", None, "t"), ("None", None, None, "t"), ("2", "some day", "soon", None),
            ("3", "None", "", "None"), ("4", "2024-13-01", "2024-01-01T00:00:00", "t")]
    split = rj.load_records(spark.createDataFrame(rows, "id string, date string, publish_time string, title string"))
    assert split.accepted().count() + split.rejected().count() == len(rows)
    assert {r.id: (r.date, r.title) for r in split.accepted().collect()} == {"1": (dt.date(2024, 1, 5), "t"), "3": (None, None)}
    got = sorted((json.loads(r.raw)["_record"].get("id") or "", r.reasons) for r in split.rejected().collect())
    assert got == [("", ["id missing"]), ("2", ["date unreadable", "publish_time unreadable"]), ("4", ["date unreadable"]), ("None", ["id missing"])]
    assert split.accepted().columns == ls.ARTICLE_COLUMNS
    assert {r.reason: r.n for r in split.summary().collect()} == {None: 2, "id missing": 2, "date unreadable": 2, "publish_time unreadable": 1}
    raw = fx.raw_records(fx.load(spark, SF, "documents"))                 # clean records load as before
    assert rj.load_records(raw).rejected().count() == 0
    assert rj.load_records(raw).accepted().exceptAll(ls.load_normalise(raw)).count() == 0


def test_saved_outputs(spark):
    root = shared_path(spark, "t_split")
    split = rj.load_records(fx.faulty_records(fx.load(spark, SF, "documents")))
    split.save(root + "/good", root + "/bad")
    good, bad = spark.read.parquet(root + "/good"), spark.read.parquet(root + "/bad")
    assert good.count() + bad.count() == fx.load(spark, SF, "documents").count() and bad.count() > 0
    assert good.where("id IS NULL").count() == 0


def test_csv_lines(spark):
    path = shared_path(spark, "t_csv")
    lines = ["k,name,x", "1,a,1.5", "2,b", "3,c,2.5,more", "4,d,many", "five,e,1.0", "6,,", '7,"q,r",3']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    split = rj.read_csv(spark, path, "k long, name string, x double")
    assert {(r.k, r.name, r.x) for r in split.accepted().collect()} == {(1, "a", 1.5), (6, None, None), (7, "q,r", 3.0)}
    assert {json.loads(r.raw)[rj.BAD] for r in split.rejected().collect()} == {"2,b", "3,c,2.5,more", "4,d,many", "five,e,1.0"}
    # What counts as broken does not depend on the columns a query uses.
    assert split.accepted().select("k").count() == 3 and split.accepted().groupBy().count().first()[0] == 3


def test_listing_items_and_details(spark):
    item = {"_id": 1, "createdDateFull": "2024-01-05T10:00:00.000Z", "slugline_url": "s", "category": "c", "title": "t"}
    pages = [json.dumps({"listItem": [item, item | {"slugline_url": None}, item | {"createdDateFull": "soon"}, item | {"_id": None, "slugline_url": ""}]}),
             json.dumps({"listItem": []}), json.dumps({"listItem": None}), "{broken", None, json.dumps({"listItem": "no list"})]
    split = rj.listing_items(spark.createDataFrame([(p,) for p in pages], "value string"), "detail")
    assert [r._id for r in split.accepted().select("title", F.col("title").alias("_id")).collect()] == ["t"]
    assert sorted(r.reasons for r in split.rejected().collect()) == sorted(
        [["slug missing"], ["time unreadable"], ["id missing", "slug missing"], ["malformed page"], ["malformed page"], ["malformed page"]])
    assert any("{broken" in r.raw for r in split.rejected().collect())
    posts = [json.dumps([{"id": 1, "link": "https://x/y", "date": "2024-01-05T10:00:00"}, {"id": 2, "date": "2024-01-05 10:00"}]), "[{]", json.dumps([])]
    split = rj.listing_items(spark.createDataFrame([(p,) for p in posts], "value string"), "posts")
    assert sorted(r.reasons for r in split.rejected().collect()) == [["link missing", "time unreadable"], ["malformed page"]]
    assert [r.link for r in split.accepted().collect()] == ["https://x/y"]
    records = [json.dumps({"response": "success", "data": {"cms_article_id": 1}}), json.dumps({"response": "error", "data": {"cms_article_id": 2}}),
               json.dumps({"response": "success", "data": None}), "nothing", json.dumps({"response": "success", "data": {"cms_article_id": "x"}})]
    split = rj.listing_details(spark.createDataFrame([(p,) for p in records], "value string"), "sectioned")
    assert split.accepted().count() == 1
    assert sorted(r.reasons for r in split.rejected().collect()) == [["failed response"], ["id missing"], ["malformed record"], ["malformed record"]]
    with pytest.raises(ValueError):
        rj.listing_items(split.judged, "other")
