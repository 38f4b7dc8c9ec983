import pytest
from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.operators.versions import FileTable
from newslake.operators.writes import conditional_update, upsert_two_phase
from newslake.schema import ARTICLE_COLUMNS
from newslake.session import shared_path

SF = "/root/testdata/sf0.001"


def articles(spark):
    return fx.articles_from_documents(fx.load(spark, SF, "documents"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def loaded(spark, name, parts=5):
    """A table of five files, each with a range of ids."""
    table = FileTable(spark, shared_path(spark, name))
    arts = articles(spark)
    n = F.col("id").cast("int")
    for k in range(parts):
        table.append(arts.filter((n >= 40 * k) & (n < 40 * (k + 1))).coalesce(1))
    assert same(table.read(), arts)
    return table, arts


def test_update_rewrites_only_files_with_such_rows(spark):
    table, arts = loaded(spark, "t_update")
    files = set(table.current().files)
    pred = F.col("id").isin("45", "47", "130")
    done = table.update(pred, {"title": F.lit("new"), "content": F.col("url")})
    assert (done.rewritten, done.kept) == (2, len(files) - 2)
    assert len(files & set(table.current().files)) == done.kept
    assert same(table.read(), conditional_update(arts, pred, {"title": F.lit("new"), "content": F.col("url")}))
    assert table.update(F.col("id") == "none", {"title": F.lit("x")}).rewritten == 0
    assert table.update(F.col("author") == "x", {"title": F.lit("x")}).version == table.current()      # NULL is no match
    assert same(table.read(table.version(4)), arts)                              # older versions stay readable


def test_upsert_rewrites_only_files_of_its_ids(spark):
    table, arts = loaded(spark, "t_upsert_files")
    files = set(table.current().files)
    batch = spark.createDataFrame([("41", 5, "t1"), ("41", 6, None), ("new", 1, None), ("new", 2, "t2"), (None, 3, "lost"), ("43", 1, None)],
                                  "id string, seq long, title string")
    batch = batch.select("*", *[F.lit(None).cast(arts.schema[c].dataType).alias(c) for c in ARTICLE_COLUMNS if c not in batch.columns])
    done = table.upsert(batch)
    assert done.rewritten == 1 and done.kept == len(files) - 1
    assert same(table.read(), upsert_two_phase(arts, batch))
    assert same(table.read().filter("id NOT IN ('41', '43', 'new')"), arts.filter("id NOT IN ('41', '43')"))


def test_empty_tables_and_a_second_writer(spark):
    table = FileTable(spark, shared_path(spark, "t_empty"))
    assert table.current().number == -1 and table.read().count() == 0
    assert table.update(F.lit(True), {"title": F.lit("x")}).rewritten == 0
    table.append(articles(spark).limit(3))
    old = table.current()
    table.append(articles(spark).limit(2))
    with pytest.raises(RuntimeError, match="exists already"):
        table.commit([], old)
    assert table.read().count() == 5


def test_a_batch_counts_once(spark):
    table = FileTable(spark, shared_path(spark, "t_once"))
    batch = articles(spark).limit(4).withColumn("seq", F.lit(1))
    assert table.upsert_once(batch, "s", 0) is not None
    assert table.upsert_once(batch, "s", 0) is None
    table.update(F.lit(True), {"title": F.lit("kept")})
    assert table.current().batches == {"s": 0}                                   # later writes carry it on
    assert table.upsert_once(batch.limit(0), "s", 1).version.batches == {"s": 1}
