"""Write operators against record-by-record replay in plain Python."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslake.operators import writes as wr
from newslake.schema import ARTICLE_COLUMNS, ARTICLE_SCHEMA, CONTENT_COLUMNS, KEY_COLUMNS

SEQ_SCHEMA = T.StructType(ARTICLE_SCHEMA.fields + [T.StructField("seq", T.LongType())])


def _records(seed, n=400, ids=60, stub_share=0.5):
    rnd = random.Random(seed)
    recs = []
    for seq in rnd.sample(range(10_000), n):
        i = rnd.randrange(ids)
        stub = rnd.random() < stub_share
        recs.append({
            "id": None if rnd.random() < 0.02 else f"id{i}", "source": rnd.choice(["a", "b"]),
            "url": f"u{seq}", "category": rnd.choice(["x", "y", None]),
            "title": None if stub else f"t{seq}", "author": None if stub else rnd.choice([None, f"w{seq}"]),
            "date": dt.date(2024, 1, 1 + seq % 28),
            "publish_time": None if stub else rnd.choice([None, dt.datetime(2024, 1, 1, seq % 24)]),
            "content": None if stub else rnd.choice([None, f"c{seq}"]), "tags": None if stub else "k", "seq": seq})
    return recs


def _df(spark, recs, with_seq=True):
    df = spark.createDataFrame([tuple(r[c] for c in ARTICLE_COLUMNS + ["seq"]) for r in recs], SEQ_SCHEMA)
    return df if with_seq else df.drop("seq")


def _collect(df):
    return {r["id"]: {c: r[c] for c in ARTICLE_COLUMNS} for r in df.collect()}


def replay_insert_ignore(table, batch):
    out = dict(table)
    for r in sorted(batch, key=lambda r: r["seq"]):
        if r["id"] is not None and r["id"] not in out:
            out[r["id"]] = {c: r[c] for c in ARTICLE_COLUMNS}
    return out


def replay_upsert(table, batch):
    out = {k: dict(v) for k, v in table.items()}
    for r in sorted(batch, key=lambda r: r["seq"]):
        if r["id"] is None:
            continue
        if r["title"] is None:
            if r["id"] not in out:
                out[r["id"]] = {c: (r[c] if c in KEY_COLUMNS else None) for c in ARTICLE_COLUMNS}
        elif r["id"] not in out:
            out[r["id"]] = {c: r[c] for c in ARTICLE_COLUMNS}
        else:
            out[r["id"]].update({c: r[c] for c in CONTENT_COLUMNS})   # K3: NULLs overwrite too
    return out


def test_insert_ignore_equals_replay(spark):
    for seed in (1, 2, 3):
        recs = _records(seed)
        first, rest = recs[:150], recs[150:]
        table = replay_insert_ignore({}, first)
        tdf = spark.createDataFrame([tuple(v[c] for c in ARTICLE_COLUMNS) for v in table.values()], ARTICLE_SCHEMA)
        got = _collect(wr.insert_ignore(tdf, _df(spark, rest)))
        assert got == replay_insert_ignore(table, rest)


def test_upsert_two_phase_equals_replay(spark):
    for seed in (4, 5, 6):
        recs = _records(seed)
        first, rest = recs[:150], recs[150:]
        table = replay_upsert({}, first)
        empty = spark.createDataFrame([], ARTICLE_SCHEMA)
        stored = wr.upsert_two_phase(empty, _df(spark, first))
        assert _collect(stored) == table
        got = _collect(wr.upsert_two_phase(stored, _df(spark, rest)))
        assert got == replay_upsert(table, rest)


def test_upsert_keeps_key_columns(spark):
    # K4: a later full record never changes source/url/category/date
    recs = [dict(id="a", source="s1", url="u1", category="c1", title=None, author=None, date=dt.date(2024, 1, 1),
                 publish_time=None, content=None, tags=None, seq=1),
            dict(id="a", source="s2", url="u2", category="c2", title="T", author=None, date=dt.date(2024, 2, 2),
                 publish_time=None, content=None, tags="x", seq=2)]
    out = _collect(wr.upsert_two_phase(spark.createDataFrame([], ARTICLE_SCHEMA), _df(spark, recs)))
    assert out["a"]["source"] == "s1" and out["a"]["url"] == "u1" and out["a"]["title"] == "T"


def test_null_ids_are_rejected(spark):
    recs = _records(7, n=50)
    recs[0]["id"] = None
    good, bad = wr.split_rejects(_df(spark, recs))
    assert bad.count() == sum(r["id"] is None for r in recs)
    assert None not in _collect(wr.insert_ignore(spark.createDataFrame([], ARTICLE_SCHEMA), _df(spark, recs)))


def test_insert_ignore_and_sync_idempotent(spark):
    recs = _records(8)
    batch = _df(spark, recs)
    empty = spark.createDataFrame([], ARTICLE_SCHEMA)
    once = wr.insert_ignore(empty, batch)
    twice = wr.insert_ignore(once, batch)
    assert _collect(once) == _collect(twice) and once.count() == twice.count()
    src = once
    tgt = once.filter(F.col("id") < "id3")
    new_tgt, summary = wr.sync_incremental(src, tgt)
    s = summary.first()
    assert s.inserted == src.count() - tgt.count() and s.target_total == src.count()
    again_tgt, again = wr.sync_incremental(src, new_tgt)
    a = again.first()
    assert a.inserted == 0 and a.skipped == a.source_total and again_tgt.count() == new_tgt.count()


def test_compact_prefers_titled_then_newest(spark):
    t = dt.datetime
    rows = [("a", None, t(2024, 1, 3)), ("a", "T1", t(2024, 1, 1)), ("a", "T2", t(2024, 1, 2)),
            ("b", None, None), ("b", None, t(2024, 1, 1)), ("c", "X", None), ("c", "Y", t(2024, 1, 1))]
    df = spark.createDataFrame([(i, "s", "u", "c", ti, None, None, p, None, None) for i, ti, p in rows], ARTICLE_SCHEMA)
    got = {r.id: (r.title, r.publish_time) for r in wr.compact(df).collect()}
    assert got == {"a": ("T2", t(2024, 1, 2)), "b": (None, t(2024, 1, 1)), "c": ("Y", t(2024, 1, 1))}


def test_conditional_update(spark):
    df = spark.createDataFrame([("inquirer", "a Read Next b"), ("other", "a Read Next b"), ("inquirer", None)],
                               "source string, content string")
    out = wr.conditional_update(df, (F.col("source") == "inquirer") & F.col("content").contains("Read Next"),
                                {"content": F.lit("cut")})
    assert [r.content for r in out.collect()] == ["cut", "a Read Next b", None]


def test_snapshot_commit_never_overwrites(spark, tmp_path):
    df = spark.range(3)
    p1 = wr.commit_snapshot(df, str(tmp_path))
    p2 = wr.commit_snapshot(spark.read.parquet(p1), str(tmp_path))
    assert p1 != p2 and spark.read.parquet(p2).count() == 3
    assert wr.latest_snapshot(spark, str(tmp_path)) == p2
    assert wr.latest_snapshot(spark, str(tmp_path / "none")) is None
