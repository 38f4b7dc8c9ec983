from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.operators import idfilter as idf
from newslake.operators import joins as jn
from newslake.operators.versions import FileTable
from newslake.operators.writes import insert_ignore, upsert_two_phase
from newslake.session import shared_path

SF = "/root/testdata/sf0.001"


def ids(spark, low, high, prefix="i"):
    return spark.range(low, high).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("id"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_stored_id_fails_and_few_others_pass(spark):
    blocks = idf.blocks_for(20_000)
    rows = idf.build(ids(spark, 0, 10_000), blocks).unionByName(idf.build(ids(spark, 10_000, 20_000), blocks))
    assert idf.passing(ids(spark, 0, 20_000), rows, blocks).count() == 20_000
    assert idf.passing(ids(spark, 0, 20_000, "other"), rows, blocks).count() < 300
    one = idf.merged(rows)
    assert one.count() <= blocks and idf.passing(ids(spark, 0, 20_000), one, blocks).count() == 20_000
    assert idf.passing(ids(spark, 0, 20_000, "other"), one, blocks).count() < 400


def test_joins_through_the_filter_equal_plain_ones(spark):
    stored = ids(spark, 0, 500).unionByName(spark.createDataFrame([(None,)], "id string"))
    probe = ids(spark, 400, 700).unionByName(ids(spark, 450, 460)).unionByName(spark.createDataFrame([(None,)], "id string")).withColumn("x", F.lit(1))
    blocks = idf.blocks_for(100)                       # far too small a filter: many pass, results stay exact
    rows = idf.build(stored, blocks)
    assert same(idf.new_only(probe, stored, rows, blocks), jn.new_only(probe, stored))
    assert same(idf.record_exists(probe, stored, rows, blocks), jn.record_exists(probe, stored, flag="exists"))
    empty = rows.limit(0)
    assert same(idf.new_only(probe, stored.limit(0), empty, blocks), probe)


def test_stored_ids_are_not_read_if_none_passes(spark):
    blocks = idf.blocks_for(100_000)
    rows = idf.build(ids(spark, 0, 1000), blocks)
    poisoned = ids(spark, 0, 1000).select(F.raise_error(F.lit("the stored ids were read")).cast("string").alias("id"))
    fresh = ids(spark, 5000, 5050)
    assert idf.passing(fresh, rows, blocks).count() == 0
    assert idf.new_only(fresh, poisoned, rows, blocks).count() == 50


def test_table_keeps_its_filter_up_with_every_write(spark):
    arts = fx.articles_from_documents(fx.load(spark, SF, "documents"))
    n = F.col("id").cast("int")
    table = FileTable(spark, shared_path(spark, "t_filter"), expected_ids=10_000)
    table.append(arts.filter(n % 3 == 0))
    batch = arts.filter(n % 3 != 2).withColumn("title", F.lit("new")).withColumn("seq", n.cast("long"))
    want = insert_ignore(arts.filter(n % 3 == 0), batch)
    done = table.insert(batch)
    assert done.rewritten == 0 and same(table.read(), want)
    late = arts.withColumn("title", F.lit("late")).withColumn("seq", F.lit(1))
    want = upsert_two_phase(want, late.filter(n < 20))
    table.upsert(late.filter(n < 20))
    assert same(table.read(), want)
    table.update(F.col("id") == "3", {"title": F.lit("set")})
    held = FileTable(spark, table.root)                    # another writer finds the filter in the version
    assert held.current().blocks == idf.blocks_for(10_000)
    assert idf.passing(table.read(), held.id_filter(), held.current().blocks).count() == table.read().count()
    again = held.insert(arts.withColumn("seq", n.cast("long")))
    assert again.version.number == 4 and table.read().count() == arts.count()
