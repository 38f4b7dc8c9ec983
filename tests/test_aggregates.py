import datetime as dt
import random

from newslake.operators import aggregates as ag
from newslake.operators import windows as wn
from newslake.schema import ARTICLE_SCHEMA


def walk(rows, start):
    """The paged harvest loop, one record at a time."""
    out = []
    for section in sorted({r[0] for r in rows}):
        page = 1
        while True:
            items = sorted((r for r in rows if r[0] == section and r[1] == page), key=lambda r: r[2])
            if not items:
                break
            kept, old = [], False
            for _, _, _, ts, known in items:
                if ts is None:
                    continue
                if ts < start:
                    old = True
                    break
                kept.append(known)
            if not kept or all(kept):
                break
            out.append((section, page, len(kept), sum(1 for k in kept if not k), old))
            if old:
                break
            page += 1
    return sorted(out)


def test_listing_frontier_equals_walk(spark):
    start = dt.datetime(2024, 1, 10)
    for seed in range(4):
        rnd = random.Random(seed)
        rows = []
        for s in range(12):
            for p in range(1, rnd.randint(1, 8) + 1):
                for pos in range(rnd.randint(1, 6)):
                    ts = None if rnd.random() < 0.1 else dt.datetime(2024, 1, rnd.randint(1, 20))
                    rows.append((f"s{s}", p, p * 100 + pos, ts, rnd.random() < 0.4))
        df = spark.createDataFrame(rows, "section string, page int, pos int, ts timestamp_ntz, known boolean")
        got = sorted(tuple(r) for r in ag.listing_frontier(df, start).collect())
        assert got == walk(rows, start), seed


def test_harvest_counters(spark):
    links = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1), ("b", dt.date(2024, 1, 1), 2),
                                   ("a", dt.date(2024, 1, 2), 1), ("c", dt.date(2024, 1, 2), 2),
                                   ("c", dt.date(2024, 1, 2), 3)], "id string, date date, pos int")
    known = spark.createDataFrame([("b",)], "id string")
    got = sorted(tuple(r) for r in ag.harvest_counters(links, known, "date", ["pos"]).collect())
    assert got == [(dt.date(2024, 1, 1), 1, 1), (dt.date(2024, 1, 2), 1, 2)]


def test_rolling_is_rows_frame(spark):
    # Missing days are not filled; the mean runs over existing rows.
    days = [dt.date(2024, 1, d) for d in (1, 2, 10)]
    df = spark.createDataFrame([("x", "s", None, "c", None, None, d, None, None, None) for d in days for _ in range(days.index(d) + 1)],
                               ARTICLE_SCHEMA)
    got = {r.date: (r.daily_articles, r.rolling_7day_avg) for r in wn.rolling_7(df).collect()}
    assert got[dt.date(2024, 1, 10)] == (3, 2.0)


def test_week_over_week_lag_and_nulls(spark):
    d = dt.date
    rows = [(d(2024, 1, 1), "a")] * 2 + [(d(2024, 1, 15), "a")] * 3 + [(d(2024, 1, 8), "b")]
    df = spark.createDataFrame([("x", "s", None, c, None, None, dt_, None, None, None) for dt_, c in rows], ARTICLE_SCHEMA)
    got = {(r.category, r.week): (r.articles_last_week, r.percent_change) for r in wn.week_over_week(df).collect()}
    assert got[("a", d(2024, 1, 15))] == (2, 50.0)      # K14: previous *existing* week
    assert got[("a", d(2024, 1, 1))] == (None, None) and got[("b", d(2024, 1, 8))] == (None, None)
