from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.operators.versions import FileTable
from newslake.operators.writes import upsert_two_phase
from newslake.streaming import ingest as st
from newslake.streaming import known as kn
from newslake.streaming.progress import ProgressLog, read_progress
from newslake.plans.catalog import _seq_schema
from newslake.session import shared_path

SF = "/root/testdata/sf0.001"


def test_ingest_final_table_and_replay_idempotent(spark):
    root = shared_path(spark, "t_ingest")
    first, again = fx.article_arrivals(fx.load(spark, SF, "documents"))
    fx.land(first, root + "/landing", 3)
    fx.land(again, root + "/landing", 2)
    with ProgressLog(spark, root + "/progress") as progress:
        q = st.stream_ingest(spark, root + "/landing", _seq_schema(), root + "/log", root + "/ckpt")
        q.awaitTermination()
        progress.wait(q)
    n_log = spark.read.parquet(root + "/log").count()
    table = st.current_table(spark, root + "/log", _seq_schema())
    assert table.count() == first.count()
    assert table.filter(F.col("title") == "again").count() == 0          # first arrival wins
    # Restarting with the same checkpoint re-reads nothing: exactly-once log.
    q2 = st.stream_ingest(spark, root + "/landing", _seq_schema(), root + "/log", root + "/ckpt")
    q2.awaitTermination()
    assert spark.read.parquet(root + "/log").count() == n_log
    assert read_progress(spark, root + "/progress").agg(F.sum("num_input_rows")).first()[0] == n_log


def test_known_ids_skips_stored_and_repeats(spark):
    root = shared_path(spark, "t_known")
    first, again = fx.event_arrivals(fx.load(spark, SF, "events"))
    fx.land(first, root + "/landing", 2)
    fx.land(again, root + "/landing", 1)
    stored = first.filter(F.col("seq") % 2 == 0).select("id")
    q = kn.stream_known_ids(spark, root + "/landing", _seq_schema(), stored, root + "/log", root + "/ckpt")
    q.awaitTermination()
    log = spark.read.parquet(root + "/log")
    assert log.count() == log.select("id").distinct().count()
    assert log.join(stored, "id").count() == 0
    assert log.filter(F.col("category") == "again").count() == 0
    assert log.count() == first.filter(F.col("seq") % 2 != 0).count()
    # A micro-batch reads what has landed and nothing else, however long the log is; the
    # state holds every id once.
    reports = sorted(q.recentProgress, key=lambda p: p["batchId"])
    assert sum(p["numInputRows"] for p in reports) == first.count() + again.count()
    assert all(len(p["sources"]) == 1 and "landing" in p["sources"][0]["description"] for p in reports)
    assert reports[-1]["stateOperators"][0]["numRowsTotal"] == first.count()
    # A restart goes on from the state: what was stored or logged stays known.
    fx.land(again.withColumn("seq", F.col("seq") + 1).unionByName(again.limit(1).withColumn("id", F.lit("new"))), root + "/landing", 1)
    kn.stream_known_ids(spark, root + "/landing", _seq_schema(), stored, root + "/log", root + "/ckpt").awaitTermination()
    assert spark.read.parquet(root + "/log").count() == log.count() + 1
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != kn._ROCKSDB


def test_known_ids_one_hot_id_nulls_and_ties(spark):
    root = shared_path(spark, "t_hot")
    schema = "id string, seq long, what string"
    rows = [("hot", i % 7 + 1, f"w{i % 5}") for i in range(5000)] + [(None, 1, "x"), ("a", None, "null order"), ("a", 0, "b"), ("b", 3, None), ("b", 3, "z")]
    df = spark.createDataFrame(rows, schema)
    df.repartition(4).write.parquet(root + "/landing")
    combined = kn.firsts_of_slices(df.coalesce(1), "id", ["seq", "what"])
    assert combined.where("id = 'hot'").count() <= 5          # one row an Arrow batch of 1,000
    q = kn.stream_known_ids(spark, root + "/landing", df.schema, df.select("id").limit(0), root + "/log", root + "/ckpt", files_per_trigger=None)
    q.awaitTermination()
    got = {r.id: (r.seq, r.what) for r in spark.read.parquet(root + "/log").collect()}
    assert got == {"hot": (1, "w0"), "a": (None, "null order"), "b": (3, None)}


def test_progress_is_kept_beyond_what_a_query_remembers_and_over_restarts(spark):
    root = shared_path(spark, "t_progress")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with ProgressLog(spark, root + "/progress") as log:
            for start in (0, 5):
                for k in range(start, start + 5):
                    spark.range(k + 1).selectExpr("cast(id as string) id", "id seq").coalesce(1).write.mode("append").parquet(root + "/landing")
                q = st.stream_ingest(spark, root + "/landing", spark.read.parquet(root + "/landing").schema, root + "/log", root + "/ckpt")
                q.awaitTermination()
                log.wait(q)
                assert len(q.recentProgress) <= 2
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    got = read_progress(spark, root + "/progress")
    assert [tuple(r) for r in got.orderBy("batch_id").select("batch_id", "num_input_rows").collect()] == [(k, k + 1) for k in range(10)]
    assert got.select("query_id").distinct().count() == 1 and got.select("run_id").distinct().count() == 2
    assert got.where("day IS NULL OR trigger_ms <= 0").count() == 0


def test_upsert_table_replays_a_batch_without_effect(spark):
    root = shared_path(spark, "t_upsert")
    table = FileTable(spark, root + "/table")
    records = fx.versions_from_conversations(fx.load(spark, SF, "conversations")).withColumn("seq", F.col("seq").cast("bigint"))
    drops = [records.filter("seq <= 2"), records.filter("seq > 2")]
    for drop in drops:
        fx.land(drop, root + "/landing", 2)
        st.stream_upsert_table(table, root + "/landing", _seq_schema(), root + "/ckpt", "s", files_per_trigger=None).awaitTermination()
    want = upsert_two_phase(spark.createDataFrame([], table.schema), records)
    assert table.read().exceptAll(want).count() == 0 and want.exceptAll(table.read()).count() == 0
    done = table.current()
    assert done.number == 1 and done.batches == {"s": 1}
    # The checkpoint lost the end of its last batch (a crash after the table's commit): it runs again.
    lost = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root + "/ckpt/commits/1")
    lost.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(lost, False)
    q = st.stream_upsert_table(table, root + "/landing", _seq_schema(), root + "/ckpt", "s", files_per_trigger=None)
    q.awaitTermination()
    assert [(p["batchId"], p["numInputRows"]) for p in q.recentProgress] == [(1, 0)]      # replayed, and not even read
    assert table.current() == done


def test_dedup_state_variant_emits_each_new_id_once(spark):
    root = shared_path(spark, "t_state")
    first, again = fx.event_arrivals(fx.load(spark, SF, "events"))
    fx.land(first, root + "/landing", 2)
    fx.land(again, root + "/landing", 1)
    stored = first.filter(F.col("seq") % 2 == 0).select("id")
    q = st.stream_dedup_state(spark, root + "/landing", _seq_schema(), stored, root + "/log", root + "/ckpt")
    q.awaitTermination()
    log = spark.read.parquet(root + "/log")
    expected = first.filter(F.col("seq") % 2 != 0).select("id")
    assert log.count() == expected.count()
    assert log.select("id").subtract(expected).count() == 0
