"""Frontier scans, sync by digests, bucketed tables, options of stopwords and zones, fetch times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from newslake import fixtures as fx
from newslake.functions import timeparse as tp
from newslake.operators import aggregates as ag
from newslake.operators import joins as jn
from newslake.operators import windows as wn
from newslake.operators import writes as wr
from newslake.plans import crawl as cw
from newslake.schema import ARTICLE_SCHEMA
from newslake.session import shared_path
from newslake.sources import rejects as rj

SF = "/root/testdata/sf0.001"


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def brute_frontier(rows, start):
    out = []
    for section in {r[0] for r in rows}:
        pages = {}
        for s, page, pos, ts, known in rows:
            if s == section:
                pages.setdefault(page, []).append((pos, ts, known))
        n = min(pages)
        while n in pages and min(pages) <= 1:
            taken, old = [], False
            for pos, ts, known in sorted(pages[n], key=lambda x: x[0]):
                if ts is None:
                    continue
                if ts < start:
                    old = True
                    break
                taken.append(known)
            fresh = sum(not k for k in taken)
            if not taken or not fresh:
                break
            out.append((section, n, len(taken), fresh, old))
            if old:
                break
            n += 1
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_frontier_equals_a_walk_and_scans_rows_twice(spark, seed):
    import random
    r = random.Random(seed)
    day = dt.datetime(2024, 1, 1)
    rows = []
    for s in range(12):
        pos, ts = 0, day + dt.timedelta(days=30)
        for page in range(r.choice([0, 1, 1, 1, 2]), r.randrange(2, 12)):
            if r.random() < 0.06:
                continue
            for _ in range(r.randrange(1, 5)):
                ts -= dt.timedelta(hours=r.randrange(0, 30))
                rows.append((f"s{s}", page, pos, None if r.random() < 0.1 else ts, r.random() < 0.5))
                pos += 1
    path = shared_path(spark, "t_rows")
    spark.createDataFrame(rows, "section string, page long, pos long, ts timestamp_ntz, known boolean").write.parquet(path)
    got = ag.listing_frontier(spark.read.parquet(path), "2024-01-20")
    assert sorted(tuple(x) for x in got.collect()) == brute_frontier(rows, dt.datetime(2024, 1, 20))
    assert path.rsplit("/", 1)[1] not in got._jdf.queryExecution().executedPlan().toString()      # rows are not scanned again


def test_sync_by_digest_equals_sync_and_prunes(spark):
    arts = fx.articles_from_documents(fx.load(spark, SF, "documents"))
    gone = F.col("id").isin("7", "8", "150")
    odd = arts.limit(2).withColumn("id", F.lit(None).cast("string")).unionByName(arts.filter("id = '8'").withColumn("title", F.lit("zz")))
    source, target = arts.unionByName(odd), arts.filter(~gone).unionByName(arts.filter("id = '20'").limit(1))
    synced, report = wr.sync_by_digest(source, target, ranges=512)
    want, _ = wr.sync_incremental(source, target)
    assert same(synced, want)
    assert 3 <= report.count() <= 5                                # ranges of 7, 8, 150 and of the target's repeat
    again, none = wr.sync_by_digest(source.filter("id IS NULL OR id <> '8' OR title <> 'zz'"), arts, ranges=512)
    assert none.count() == 0 and "Join" not in again._jdf.queryExecution().executedPlan().toString()
    assert same(wr.sync_by_digest(arts, arts.limit(0))[0], arts)
    assert wr.sync_by_digest(arts.limit(0), arts)[1].count() == 0


def test_bucketed_side_has_no_exchange(spark):
    v = fx.versions_from_conversations(fx.load(spark, SF, "conversations"))
    first = wr.upsert_two_phase(spark.createDataFrame([], ARTICLE_SCHEMA), v.filter("seq <= 1"))
    stored = wr.save_bucketed(first, "t_bucketed", "id", 8, shared_path(spark, "t_bucketed"))
    out = wr.upsert_two_phase(stored, v.filter("seq >= 2"))
    assert same(out, wr.upsert_two_phase(first, v.filter("seq >= 2")))
    final = out._jdf.queryExecution().executedPlan().toString()
    assert final.index("t_bucketed") < final.index("Exchange")     # the stored side, first in the plan, has none
    latest = wn.dedupe_latest(stored)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in latest
    layers = wr.layered_build(spark, [("t_arts", "bucketed", lambda s: first), ("t_one", "view", lambda s: s.table("t_arts").limit(1))], shared_path(spark, "t_layers"), buckets=4)
    assert layers["t_arts"].count() == first.count() and layers["t_one"].count() == 1


def test_stopwords_without_case(spark):
    toks = spark.createDataFrame([("The",), ("the",), ("I",), ("i",), ("News",)], "token string")
    assert {r.token for r in jn.stopword_anti(toks).collect()} == {"The", "I", "News"}
    assert {r.token for r in jn.stopword_anti(toks, case_sensitive=False).collect()} == {"News"}


def test_publish_times_in_a_zone(spark):
    values = ["2024-03-05T10:20:30+08:00", "2024-03-05T10:20:30Z", "2024-03-05 10:20:30", "2024-03-05T23:30:00-0500", "Tue, 05 Mar 2024 10:20:30 PHT",
              "Tue, 05 Mar 2024 10:20:30 GMT", "Tue, 05 Mar 2024 10:20:30", "n/a", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    at = lambda zone: [r.t for r in df.select("i", tp.publish_time_parse("v", zone=zone).alias("t")).orderBy("i").collect()]      # noqa: E731
    t = lambda d, h, m=20, s=30: dt.datetime(2024, 3, d, h, m, s)                                                              # noqa: E731
    assert at(None)[:4] == [t(5, 10), t(5, 10), t(5, 10), t(5, 23, 30, 0)]
    assert at("UTC") == [t(5, 2), t(5, 10), t(5, 10), t(6, 4, 30, 0), t(5, 2), t(5, 10), t(5, 10), None, None]
    assert at("Asia/Manila") == [t(5, 10), t(5, 18), t(5, 10), t(6, 12, 30, 0), t(5, 10), t(5, 18), t(5, 10), None, None]


def test_tags_keep_rows_apart_without_shuffling_lists(spark):
    df = spark.createDataFrame([("a", [1, 2]), ("a", [2, 1]), (None, [2]), ("a", [1, 2]), ("b", []), ("c", None), ("d", [9])], "id string, t array<int>")
    tags = spark.createDataFrame([(1, "one"), (2, "two")], "id int, slug string")
    out = jn.tag_lookup(df, "id", "t", tags)
    assert sorted((r.id or "", r.tags) for r in out.collect()) == [("", "two"), ("a", "one,two"), ("a", "one,two"), ("a", "two,one"), ("b", ""), ("c", ""), ("d", "")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k1" in plan and "hashpartitioning(id" not in plan


def test_latest_fetch_counts(spark):
    table = spark.createDataFrame([("h:1:s", "press", "https://h.press.example/1/s", "c", None, None, None, None, None, None)], ARTICLE_SCHEMA)
    fetched = spark.createDataFrame([("https://h.press.example/1/s", "<title>new and longer</title>", 2), ("https://h.press.example/1/s", "<title>a</title>", 1)],
                                    "url string, html string, at int")
    assert cw.resolve_articles(table, fetched, fetched_at="at").first().title == "new and longer"


def test_one_pass_over_what_is_counted(spark):
    plan = lambda name: E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan("listing_rejects").count("FileScan parquet") == 5        # each load once, not its two outcomes apart
    assert plan("top_terms").count("Exchange") == 1                      # texts travel, their tokens do not


def test_outcomes_count_accepted_and_rejected(spark):
    pages = spark.createDataFrame([('{"listItem": [{"_id": 1, "slugline_url": "a", "createdDateFull": "2024-01-01T00:00:00.000Z"}, {"_id": null}]}',),
                                   ("{",), (None,)], "value string")
    split = rj.listing_items(pages, "detail")
    got = {r.reasons: r.n for r in split.outcomes().collect()}
    want = {}
    for r in split.rejected().collect():
        want[", ".join(r.reasons)] = want.get(", ".join(r.reasons), 0) + 1
    assert got == {"": split.accepted().count(), **want} and got[""] == 1 and got["malformed page"] == 2


def test_landed_files_grow_with_the_input(spark, tmp_path):
    df = spark.range(0, 1000, 1, 16)
    assert spark.read.parquet(fx.land(df, str(tmp_path / "many"), 2)).count() == 1000
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 4
    fx.land(df.coalesce(1), str(tmp_path / "few"), 3)
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 3
