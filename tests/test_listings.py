"""Listing normalisers on inline JSON (cases the fixture tables cannot show)."""

import datetime as dt
import json

from newslake.sources import listings as ls


def _rows(spark, values, page=False):
    if page:
        return spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "page long, value string")
    return spark.createDataFrame([(json.dumps(v),) for v in values], "value string")


def test_listing_detail_shape(spark):
    pages = _rows(spark, [
        {"listItem": [
            {"_id": 3, "createdDateFull": "2024-03-05T10:20:30.123Z", "slugline_url": "news/a", "category": "news",
             "title": "A", "author": "x", "tags": "t"},
            {"_id": 4, "createdDateFull": "2024-03-04T00:00:00.000Z", "category": "news"},        # no slug
            {"_id": 5, "createdDateFull": "2024-03-03T09:00:00.5Z", "slugline_url": "s/b", "category": "sports"}]},
        {"listItem": [
            {"_id": 6, "createdDateFull": "2024-02-01T00:00:00.000Z", "slugline_url": "old", "category": "x"},
            {"_id": 7, "createdDateFull": "2024-03-09T00:00:00.000Z", "slugline_url": "after-old", "category": "x"}]},
    ], page=True)
    details = _rows(spark, [{"_id": 3, "data": {"body_html": "<p>Body</p>"}}, {"_id": 5}])
    out = {r.id: r for r in ls.norm_listing_detail(pages, details, start="2024-03-01", clean_content=False).collect()}
    assert set(out) == {"3", "5"}                      # 4: no slug; 6 is old and 7 comes after it
    a = out["3"]
    assert (a.source, a.url, a.category) == ("abs-cbn", "https://www.abs-cbn.com/news/a", "NEWS")
    assert a.date == dt.date(2024, 3, 5) and a.publish_time == dt.datetime(2024, 3, 5, 10, 20, 30)
    assert a.content == "<p>Body</p>" and out["5"].content == "No content found"


def test_sectioned_shape(spark):
    pages = _rows(spark, [
        {"response": "success", "data": [{"cms_article_id": 1, "publish_time": "2024-03-05 10:00:00"},
                                         {"cms_article_id": 2, "publish_time": ""},
                                         {"cms_article_id": 3, "publish_time": "2024-03-05 11:00:00"},
                                         {"cms_article_id": 4, "publish_time": "2024-03-05 12:00:00"}]},
        {"response": "error", "data": [{"cms_article_id": 9, "publish_time": "2024-03-05 10:00:00"}]}])
    details = _rows(spark, [
        {"response": "success", "data": {"cms_article_id": 1, "body": "", "summary": "Sum",
                                         "cf_article_tags": " a, ,b ", "link": "L1", "publish_time": "2024-03-05 10:00:00"}},
        {"response": "success", "data": {"cms_article_id": 2, "body": "B2", "publish_time": "2024-03-05 10:00:00"}},
        {"response": "error", "data": {"cms_article_id": 3, "body": "B3"}},
        {"response": "success", "data": {"cms_article_id": 4, "publish_time": "2024-03-05 12:00:00",
                                         "title": "T", "section_name": "Nation", "author_name": "Au"}},
        {"response": "success", "data": {"cms_article_id": 9, "body": "B9"}}])
    out = {r.id: r for r in ls.norm_sectioned(pages, details, clean_content=False).collect()}
    assert set(out) == {"1", "4"}       # 2: empty publish time; 3: failed detail; 9: failed listing page
    one, four = out["1"], out["4"]
    assert one.content == "Sum" and one.tags == "a,b" and one.title == "No title found"        # K7
    assert one.author == "Unknown" and one.category == "Unknown" and one.source == "manila_bulletin"
    assert four.content == "No content found" and four.tags == "" and four.category == "Nation"
    assert four.date == dt.date(2024, 3, 5) and four.publish_time == dt.datetime(2024, 3, 5, 12)


def test_nested_posts_shape(spark):
    pages = _rows(spark, [[
        {"id": 10, "link": "https://posts.example.com/nation/x/", "date": "2024-03-05T10:20:30",
         "title": {"rendered": "T"}, "content": {"rendered": "C"}, "tags": [2, 99, 1]},
        {"id": 11, "link": "https://posts.example.com/world/y/", "date": "2024-03-06T00:00:00", "tags": []}]])
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id long, slug string")
    out = {r.id: r for r in ls.norm_nested_posts(pages, dim, clean_content=False).collect()}
    assert out["10"].tags == "two,one" and out["10"].category == "nation" and out["10"].author is None
    assert out["11"].title == "No title found" and out["11"].content == "No content found" and out["11"].tags == ""
    assert out["10"].publish_time == dt.datetime(2024, 3, 5, 10, 20, 30)


def test_load_normalise_and_union(spark):
    recs = spark.createDataFrame([(7, "None", "2024-03-05 10:11:12", "2024-03-05 10:11:12", "body", None)],
                                 "id long, author string, date string, publish_time string, cleaned_content string, "
                                 "tags string")
    r = ls.load_normalise(recs).first()
    assert r.id == "7" and r.author is None and r.date == dt.date(2024, 3, 5) and r.content == "body"
    assert r.publish_time == dt.datetime(2024, 3, 5, 10, 11, 12)
    # Combining sources goes by column name, whatever the column order.
    a = spark.createDataFrame([("1", "s")], "id string, source string")
    b = spark.createDataFrame([("t", "2")], "source string, id string")
    got = sorted((x.id, x.source) for x in ls.union_sources(a, b).collect())
    assert got == [("1", "s"), ("2", "t")]


def test_known_ids_skipped_before_details(spark):
    pages = _rows(spark, [{"listItem": [
        {"_id": 1, "createdDateFull": "2024-03-05T00:00:00.000Z", "slugline_url": "a", "category": "c"},
        {"_id": 2, "createdDateFull": "2024-03-05T00:00:00.000Z", "slugline_url": "b", "category": "c"}]}], page=True)
    details = _rows(spark, [{"_id": 1, "data": {"body_html": "x"}}, {"_id": 2, "data": {"body_html": "y"}}])
    known = spark.createDataFrame([("2",)], "id string")
    assert [r.id for r in ls.norm_listing_detail(pages, details, known_ids=known).collect()] == ["1"]
    posts = _rows(spark, [[{"id": 1, "link": "https://h/n/", "date": "2024-03-05T00:00:00"},
                           {"id": 2, "link": "https://h/n/", "date": "2024-03-05T00:00:00"}]])
    dim = spark.createDataFrame([], "id long, slug string")
    assert [r.id for r in ls.norm_nested_posts(posts, dim, known_ids=known).collect()] == ["1"]
    sec = _rows(spark, [{"response": "success", "data": [{"cms_article_id": 1, "publish_time": "2024-03-05 00:00:00"},
                                                         {"cms_article_id": 2, "publish_time": "2024-03-05 00:00:00"}]}])
    det = _rows(spark, [{"response": "success", "data": {"cms_article_id": i, "publish_time": "2024-03-05 00:00:00"}}
                        for i in (1, 2)])
    assert [r.id for r in ls.norm_sectioned(sec, det, known_ids=known).collect()] == ["1"]


def test_clean_content_listing_path(spark):
    pages = _rows(spark, [[{"id": 1, "link": "https://h/n/", "date": "2024-03-05T00:00:00",
                            "content": {"rendered": "&lt;p&gt;Hello &lt;b&gt;world&lt;/b&gt;&lt;/p&gt;"
                                                    "<figure><img src='x'><figcaption>cap</figcaption></figure>"
                                                    "<p>Two  <a href='/l'>link</a></p>"}}]])
    dim = spark.createDataFrame([], "id long, slug string")
    r = ls.norm_nested_posts(pages, dim, clean_content=True).first()
    assert r.content == "Hello world\n\nTwo link"


def test_sectioned_walk_stops_at_old_rows_and_gaps(spark):
    def page(*items):
        return json.dumps({"response": "success", "data": [{"cms_article_id": i, "publish_time": t} for i, t in items]})
    new, old = "2024-03-05 10:00:00", "2024-02-01 10:00:00"
    pages = spark.createDataFrame([
        ("a", 1, page((1, new), (2, ""), (3, new))), ("a", 2, page((4, new), (5, old), (6, new))), ("a", 3, page((7, new))),
        ("b", 1, page((8, new))), ("b", 3, page((9, new))),                       # a gap ends the walk
        ("c", 1, page((10, new))), ("c", 2, page((11, new)))], "section string, page int, value string")   # c: all known
    details = spark.createDataFrame([(json.dumps({"response": "success", "data": {
        "cms_article_id": i, "body": f"<p>b{i}</p>", "publish_time": new}}),) for i in range(1, 12)], "value string")
    known = spark.createDataFrame([("10",), ("3",)], "id string")
    out = ls.norm_sectioned(pages, details, known_ids=known, start="2024-03-01").collect()
    assert sorted(int(r.id) for r in out) == [1, 4, 8]
    assert {r.content.strip() for r in out} == {"b1", "b4", "b8"}                 # bodies become text by default


def test_nested_posts_after(spark):
    posts = json.dumps([{"id": i, "link": "https://x.com/a/b", "date": t, "tags": []}
                        for i, t in ((1, "2024-03-01T00:00:00"), (2, "2024-03-01T00:00:01"))])
    pages = spark.createDataFrame([(posts,)], "value string")
    dim = spark.createDataFrame([], "id long, slug string")
    assert [r.id for r in ls.norm_nested_posts(pages, dim, after="2024-03-01").collect()] == ["2"]
