"""Registered queries: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
test tables (through the adapters in :mod:`newslake.fixtures`).  The DuckDB
twin of each lives in :mod:`newslake.plans.oracle` under the same key.

Where an operator needs two inputs (a stored table and an incoming batch, a
source and a target), a rule on the id splits the whole table into the two
roles; the batch side is always the whole table, never a sample.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake import fixtures as fx
from newslake.functions import dates as dts
from newslake.functions import text as tx
from newslake.functions import timeparse as tp
from newslake.functions import urls as ur
from newslake.operators import aggregates as ag
from newslake.operators import filters as fl
from newslake.operators import html as hj
from newslake.operators import idfilter as idf
from newslake.operators import joins as jn
from newslake.operators import quality as dq
from newslake.operators import rules as ru
from newslake.operators import setops as so
from newslake.operators import topk as tk
from newslake.operators import windows as wn
from newslake.operators import writes as wr
from newslake.operators.versions import FileTable
from newslake.plans import crawl as cw
from newslake.plans import marts as mt
from newslake.schema import ARTICLE_COLUMNS, ARTICLE_SCHEMA
from newslake.session import checkpoint_root, shared_path
from newslake.sources import listings as ls
from newslake.sources import rejects as rj
from newslake.sources import sql as sq
from newslake.sources import tables as tb
from newslake.sources.dated import DatedTable
from newslake.streaming import ingest as st
from newslake.streaming.known import stream_known_ids
from newslake.streaming.progress import ProgressLog, read_progress

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _docs(spark, d):
    return fx.articles_from_documents(fx.load(spark, d, "documents"))


def _events(spark, d):
    return fx.articles_from_events(fx.load(spark, d, "events"))


def _versions(spark, d):
    return fx.versions_from_conversations(fx.load(spark, d, "conversations"))


# ---------------------------------------------------------------- sources
@register("src_articles_table")
def q_src_articles_table(spark, d):
    path = shared_path(spark, "articles")
    tb.open_articles(spark, path)                    # creates the empty table
    tb.save_articles(_docs(spark, d), path)          # first load
    return tb.open_articles(spark, path)


@register("src_scan")
def q_src_scan(spark, d):
    return tb.scan(spark, fx.table_path(d, "documents"), ["doc_id", "source", "n_chars"], F.col("lang") == "de")


SQL_ADHOC = """
select c_mktsegment as grp, count(*) as n
from orders join customer on o_custkey = c_custkey
group by c_mktsegment having count(*) > 10
union all
select o_orderstatus as grp, count(*) as n from orders group by o_orderstatus
"""


@register("sql_adhoc")
def q_sql_adhoc(spark, d):
    return sq.run_sql(spark, SQL_ADHOC, {"orders": fx.load(spark, d, "orders"),
                                         "customer": fx.load(spark, d, "customer")})


SQL_PARAMS = """
select o_orderpriority, count(*) as n, max(o_totalprice) as max_price, min(o_totalprice) as min_price
from orders where o_orderstatus = :status and o_totalprice > :min_price
group by o_orderpriority
"""


@register("sql_params")
def q_sql_params(spark, d):
    return sq.run_sql(spark, SQL_PARAMS, {"orders": fx.load(spark, d, "orders")},
                      args={"status": "F", "min_price": 100000.0})


def _nation_csv(spark, d) -> str:
    path = shared_path(spark, "nation_csv")
    fx.load(spark, d, "nation").write.mode("overwrite").option("header", True).csv(path)
    return path


@register("src_csv_query")
def q_src_csv_query(spark, d):
    return sq.query_csv(spark, _nation_csv(spark, d),
                        "select n_nationkey, n_name, n_regionkey from read_csv_auto")


@register("csv_category_count")
def q_csv_category_count(spark, d):
    return sq.csv_category_count(spark, _nation_csv(spark, d), "n_regionkey")


@register("sink_parquet")
def q_sink_parquet(spark, d):
    arts = _docs(spark, d)
    recent = fl.date_window(arts, days=30, as_of=fl.as_of_date(arts))
    return tb.export_parquet(recent, shared_path(spark, "export"))


@register("src_parquet_query")
def q_src_parquet_query(spark, d):
    return tb.query_parquet(spark, "select o_orderstatus, count(*) as n from {orders} group by o_orderstatus",
                            orders=fx.table_path(d, "orders"))


# ---------------------------------------------------------------- aggregates / windows
@register("by_source")
def q_by_source(spark, d):
    return ag.by_source(_docs(spark, d))


@register("source_comparison")
def q_source_comparison(spark, d):
    return ag.source_comparison(_docs(spark, d))


@register("daily_counts")
def q_daily_counts(spark, d):
    return ag.daily_counts(_events(spark, d), by=["source"])


@register("weekly_counts")
def q_weekly_counts(spark, d):
    return ag.weekly_counts(_events(spark, d))


@register("table_count")
def q_table_count(spark, d):
    return ag.table_count(fx.load(spark, d, "documents"))


@register("date_window")
def q_date_window(spark, d):
    """The last year of orders, stored in folders by month."""
    orders = fx.load(spark, d, "orders").withColumn("date", F.col("o_orderdate").cast("date")).select("o_orderkey", "date")
    table = DatedTable(spark, shared_path(spark, "orders_by_month"), orders.schema, unit="month").save(orders)
    return table.window(days=365).select("o_orderkey", "date")


def _events_by_day(spark, d) -> DatedTable:
    ev = _events(spark, d)
    return DatedTable(spark, shared_path(spark, "events_by_day"), ev.schema).save(ev)


@register("rolling_7")
def q_rolling_7(spark, d):
    return wn.rolling_7(_events_by_day(spark, d).window(days=30))


@register("rolling_7_by_source")
def q_rolling_7_by_source(spark, d):
    return wn.rolling_7_by_source(_events_by_day(spark, d).window(days=90))


@register("week_over_week")
def q_week_over_week(spark, d):
    return wn.week_over_week(_events_by_day(spark, d).window(days=14))


@register("ordered_report")
def q_ordered_report(spark, d):
    return tk.ordered_report(ag.daily_counts(_events(spark, d), by=["source"]), ["date", "source"], [True, False])


@register("dedupe_latest")
def q_dedupe_latest(spark, d):
    return wn.dedupe_latest(_versions(spark, d), "id", newest="seq")


@register("first_wins")
def q_first_wins(spark, d):
    pages = fx.load(spark, d, "pages").withColumn("host", F.try_parse_url("url", F.lit("AUTHORITY")))
    return wn.first_wins(pages.select("host", "page_id", "url"), "host", "page_id")


# ---------------------------------------------------------------- joins / sets / limits
def _label_ids(spark, d):
    return fx.load(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"))


@register("new_only")
def q_new_only(spark, d):
    return jn.new_only(_docs(spark, d), _label_ids(spark, d))


@register("record_exists")
def q_record_exists(spark, d):
    return jn.record_exists(_docs(spark, d).select("id", "source"), _label_ids(spark, d), flag="exists")


def _label_filter(spark, d):
    """Stored ids and their filter, written beside them."""
    stored = _label_ids(spark, d)
    blocks = idf.blocks_for(1_000_000)
    path = shared_path(spark, "label_filter")
    idf.build(stored, blocks).write.parquet(path)
    return stored, spark.read.parquet(path), blocks


@register("new_only_filtered")
def q_new_only_filtered(spark, d):
    return idf.new_only(_docs(spark, d), *_label_filter(spark, d))


@register("record_exists_filtered")
def q_record_exists_filtered(spark, d):
    return idf.record_exists(_docs(spark, d).select("id", "source"), *_label_filter(spark, d), flag="exists")


@register("exists_limit1")
def q_exists_limit1(spark, d):
    return tk.exists_limit1(_docs(spark, d), "id", "42")


@register("distinct_ids")
def q_distinct_ids(spark, d):
    return so.distinct_ids(_docs(spark, d), source="src3")


@register("missing_rows")
def q_missing_rows(spark, d):
    arts = _docs(spark, d)
    other = arts.filter(F.col("id").cast("bigint") % 3 != 0)
    return so.missing_rows(arts, other)


# ---------------------------------------------------------------- writes
def _w1_inputs(spark, d):
    arts = _docs(spark, d)
    n = F.col("id").cast("bigint")
    table = arts.filter(n % 2 == 0)
    batch = (arts.withColumn("seq", n)
             .unionByName(arts.filter(n % 5 == 0).withColumn("title", F.lit("v2")).withColumn("seq", n + 100000))
             .unionByName(arts.filter(n % 7 == 0).withColumn("title", F.lit("v0")).withColumn("seq", n - 100000)))
    return table, batch


@register("insert_ignore")
def q_insert_ignore(spark, d):
    table, batch = _w1_inputs(spark, d)
    return wr.insert_ignore(table, batch, "id", "seq")


@register("insert_filtered")
def q_insert_filtered(spark, d):
    """W1 into a stored table with an id filter."""
    rows, batch = _w1_inputs(spark, d)
    table = FileTable(spark, shared_path(spark, "file_table"), expected_ids=1_000_000)
    table.append(rows)
    table.insert(batch)
    return table.read()


@register("upsert_two_phase")
def q_upsert_two_phase(spark, d):
    v = _versions(spark, d)
    empty = spark.createDataFrame([], ARTICLE_SCHEMA)
    stored = wr.upsert_two_phase(empty, v.filter(F.col("seq") <= 1))
    return wr.upsert_two_phase(stored, v.filter(F.col("seq") >= 2))


@register("compact")
def q_compact(spark, d):
    v = _versions(spark, d)
    root = shared_path(spark, "compact")
    log = wr.commit_snapshot(v, root)
    compacted = wr.compact(spark.read.parquet(log), newest="seq")
    return spark.read.parquet(wr.commit_snapshot(compacted, root))


def _boilerplate_update():
    marker = " is "
    pred = (F.col("source") == "src3") & F.col("content").contains(marker)
    return pred, {"content": tx.boilerplate_cut(F.col("content"), marker), "title": tx.title_cut(F.col("title"))}


@register("conditional_update")
def q_conditional_update(spark, d):
    return wr.conditional_update(_docs(spark, d), *_boilerplate_update())


@register("update_touched_files")
def q_update_touched_files(spark, d):
    """W4 on a stored table clustered by source: only files with such rows are rewritten."""
    table = FileTable(spark, shared_path(spark, "file_table"), cluster=("source", "id"))
    table.append(_docs(spark, d))
    table.update(*_boilerplate_update())
    return table.read()


@register("upsert_touched_files")
def q_upsert_touched_files(spark, d):
    """W2 on a stored table: the first turns are loaded, all later ones folded in."""
    table = FileTable(spark, shared_path(spark, "file_table"))
    records = _versions(spark, d)
    table.upsert(records.filter(F.col("seq") <= 1))
    table.upsert(records.filter(F.col("seq") >= 2))
    return table.read()


@register("sync_incremental")
def q_sync_incremental(spark, d):
    arts = _docs(spark, d)
    n = F.col("id").cast("bigint")
    _, summary = wr.sync_incremental(arts, arts.filter(n % 2 == 0))
    return summary


@register("sync_digests")
def q_sync_digests(spark, d):
    """W5 by range digests: the target lacks one row in 97."""
    arts = _docs(spark, d)
    synced, _ = wr.sync_by_digest(arts, arts.filter(F.col("id").cast("bigint") % 97 != 0))
    return synced


@register("bucketed_upsert")
def q_bucketed_upsert(spark, d):
    """W2 into a catalog table bucketed by id: the stored side is not shuffled."""
    v = _versions(spark, d)
    name = "articles_" + uuid.uuid4().hex
    first = wr.upsert_two_phase(spark.createDataFrame([], ARTICLE_SCHEMA), v.filter(F.col("seq") <= 1))
    stored = wr.save_bucketed(first, name, "id", path=shared_path(spark, name))
    return wr.upsert_two_phase(stored, v.filter(F.col("seq") >= 2))


# ---------------------------------------------------------------- quality
@register("dq_unique")
def q_dq_unique(spark, d):
    return dq.dq_unique(fx.load(spark, d, "conversations"), "conv_id")


def _docs_null_ids(spark, d):
    arts = _docs(spark, d)
    return arts.withColumn("id", F.when(F.col("id").cast("bigint") % 17 == 0, F.lit(None)).otherwise(F.col("id")))


@register("dq_not_null")
def q_dq_not_null(spark, d):
    return dq.dq_not_null(_docs_null_ids(spark, d), "id")


@register("dq_report")
def q_dq_report(spark, d):
    return dq.dq_report(_docs_null_ids(spark, d), unique=["id", "category"], not_null=["id", "title"])


# ---------------------------------------------------------------- record normalisation
# Bodies of the stand-in listings are plain text, so their HTML clean-up is off.
@register("norm_listing_detail")
def q_norm_listing_detail(spark, d):
    pages, details = fx.listing_a(fx.load(spark, d, "documents"))
    return ls.norm_listing_detail(pages, details, start="2024-02-01", clean_content=False)


@register("norm_sectioned")
def q_norm_sectioned(spark, d):
    pages, details = fx.listing_b(fx.load(spark, d, "documents"))
    return ls.norm_sectioned(pages, details, clean_content=False)


@register("sectioned_walk")
def q_sectioned_walk(spark, d):
    pages, details = fx.listing_b(fx.load(spark, d, "documents"))
    return ls.norm_sectioned(pages, details, known_ids=_label_ids(spark, d), clean_content=False, start="2024-02-10")


@register("norm_nested_posts")
def q_norm_nested_posts(spark, d):
    pages, dim = fx.listing_c(fx.load(spark, d, "documents"))
    return ls.norm_nested_posts(pages, dim, clean_content=False)


@register("union_sources")
def q_union_sources(spark, d):
    docs = fx.load(spark, d, "documents")
    a = ls.norm_listing_detail(*fx.listing_a(docs), start="2024-02-01", clean_content=False)
    b = ls.norm_sectioned(*fx.listing_b(docs), clean_content=False)
    c = ls.norm_nested_posts(*fx.listing_c(docs), clean_content=False)
    return ls.union_sources(a, b, c)


@register("load_normalise")
def q_load_normalise(spark, d):
    return ls.load_normalise(fx.raw_records(fx.load(spark, d, "documents")))


@register("load_rejects")
def q_load_rejects(spark, d):
    """S11 with rejects: every record, accepted or with the reasons against it."""
    split = rj.load_records(fx.faulty_records(fx.load(spark, d, "documents")))
    accepted = split.accepted().select("id", "date", "publish_time", F.lit("").alias("reasons"), F.lit(None).cast("string").alias("url"))
    rejected = split.rejected().select(
        F.get_json_object("raw", "$._record.id").alias("id"), F.lit(None).cast("date").alias("date"), F.lit(None).cast("timestamp_ntz").alias("publish_time"),
        F.array_join("reasons", ", ").alias("reasons"), F.get_json_object("raw", "$._record.url").alias("url"))
    return accepted.unionByName(rejected)


@register("csv_rejects")
def q_csv_rejects(spark, d):
    """S5 with rejects: customer lines by outcome."""
    path = fx.faulty_csv(fx.load(spark, d, "customer"), shared_path(spark, "customer_csv"))
    split = rj.read_csv(spark, path, fx.CUSTOMER_CSV, header=False)
    accepted = split.accepted().withColumn("raw", F.lit(None).cast("string"))
    broken = split.rejected().select(F.get_json_object("raw", f"$.{rj.BAD}").alias("raw"))
    return accepted.unionByName(broken, allowMissingColumns=True)


@register("listing_bodies")
def q_listing_bodies(spark, d):
    """S7-S9 with the clean-up of bodies on: markup in, letters of the text out."""
    docs = fx.load(spark, d, "documents")
    a = ls.norm_listing_detail(*fx.listing_a(docs, markup=True))
    b = ls.norm_sectioned(*fx.listing_b(docs, markup=True))
    c = ls.norm_nested_posts(*fx.listing_c(docs, markup=True))
    words = F.trim(F.regexp_replace("content", r"\P{L}+", " "))
    return ls.union_sources(a, b, c).select("id", "source", F.md5(words).alias("words_md5"))


@register("listing_rejects")
def q_listing_rejects(spark, d):
    """S7-S9 with rejects: items and details of the three listing shapes by outcome."""
    docs = fx.load(spark, d, "documents")
    (a, da), (b, db), (c, _) = fx.listing_a(docs), fx.listing_b(docs), fx.listing_c(docs)
    splits = {"detail": rj.listing_items(fx.faulty_pages(a), "detail"), "detail record": rj.listing_details(da, "detail"),
              "sectioned": rj.listing_items(fx.faulty_pages(b), "sectioned"), "sectioned record": rj.listing_details(db, "sectioned"),
              "posts": rj.listing_items(fx.faulty_pages(c), "posts")}
    parts = [s.outcomes().withColumn("shape", F.lit(name)) for name, s in splits.items()]
    return functools.reduce(lambda x, y: x.unionByName(y), parts)


def _pages_parts(spark, d):
    pages = fx.load(spark, d, "pages")
    return pages.select("page_id", "url", ur.url_parts("url").alias("p"))


@register("url_parts")
def q_url_parts(spark, d):
    return _pages_parts(spark, d).select("page_id", "p.*")


@register("article_key")
def q_article_key(spark, d):
    return _pages_parts(spark, d).select("page_id", ur.article_key("p").alias("article_key"))


@register("url_absolute")
def q_url_absolute(spark, d):
    return _pages_parts(spark, d).select("page_id", ur.url_absolute(F.col("p.slug"), "https://www.example.com/")
                                         .alias("abs_url"))


@register("url_category")
def q_url_category(spark, d):
    return fx.load(spark, d, "pages").select("page_id", ur.url_category("url").alias("category"))


@register("publish_time_parse")
def q_publish_time_parse(spark, d):
    t = fx.formatted_times(fx.load(spark, d, "events"))
    return t.select("event_id", tp.publish_time_parse(F.col("meta"), F.col("body")).alias("publish_time"))


@register("api_time_parse")
def q_api_time_parse(spark, d):
    t = fx.api_times(fx.load(spark, d, "events"))
    parsed = (F.when(F.col("kind") == 0, tp.api_time_parse("text", tp.ISO_Z_FRACTION))
              .when(F.col("kind") == 1, tp.api_time_parse("text", tp.SPACE_SECONDS))
              .otherwise(tp.api_time_parse("text", tp.ISO_T_SECONDS)))
    return t.select("event_id", parsed.alias("t")).select("event_id", "t.date", "t.publish_time")


@register("tags_normalise")
def q_tags_normalise(spark, d):
    return fx.raw_tags(fx.load(spark, d, "part")).select("p_partkey", tx.tags_normalise("raw").alias("tags"))


@register("tags_to_array")
def q_tags_to_array(spark, d):
    return fx.raw_tags(fx.load(spark, d, "part")).select("p_partkey", tx.tags_to_array("raw").alias("tags"))


@register("fill_defaults")
def q_fill_defaults(spark, d):
    n = F.col("id").cast("bigint")
    arts = (_docs(spark, d)
            .withColumn("category", F.when(n % 6 == 0, F.lit(None)).otherwise(F.col("category")))
            .withColumn("content", F.when(n % 8 == 0, F.lit(None)).otherwise(F.col("content"))))
    return tx.fill_defaults(arts).select("id", "title", "author", "category", "content")


@register("whitespace_collapse")
def q_whitespace_collapse(spark, d):
    return fx.load(spark, d, "documents").select("doc_id", tx.whitespace_collapse("text").alias("text"))


@register("boilerplate_cut")
def q_boilerplate_cut(spark, d):
    return fx.load(spark, d, "documents").select("doc_id", tx.boilerplate_cut("text", " the ").alias("text"))


@register("date_to_text")
def q_date_to_text(spark, d):
    o = fx.load(spark, d, "orders")
    return o.select("o_orderkey", dts.date_to_text(F.col("o_orderdate").cast("date")).alias("date"))


@register("date_spine")
def q_date_spine(spark, d):
    o = fx.load(spark, d, "orders")
    bounds = o.groupBy("o_orderstatus").agg(F.min(F.col("o_orderdate").cast("date")).alias("start"),
                                            F.max(F.col("o_orderdate").cast("date")).alias("end"))
    return dts.date_spine(bounds)


# ---------------------------------------------------------------- filters
@register("pending_articles")
def q_pending_articles(spark, d):
    return fl.pending_articles(_docs(spark, d))


@register("unextracted_articles")
def q_unextracted_articles(spark, d):
    return fl.unextracted_articles(_docs(spark, d))


@register("category_allow")
def q_category_allow(spark, d):
    return fl.category_allow(_docs(spark, d), [" en", "FR"]).select("id", "category")


@register("https_only")
def q_https_only(spark, d):
    return fl.https_only(fx.load(spark, d, "pages")).select("page_id", "url")


@register("slug_block")
def q_slug_block(spark, d):
    parts = _pages_parts(spark, d).select("page_id", "p.subdomain", "p.slug")
    return fl.slug_block(parts, rules=[("5", None), ("1", "blog")])


@register("slug_block_rules")
def q_slug_block_rules(spark, d):
    """F6 with a rule table: pieces of every fortieth page's URL tail, half of them for its
    own subdomain only."""
    parts = _pages_parts(spark, d).select("page_id", "p.subdomain", "url")
    tail = F.substring("url", -7, 4)
    rules = parts.filter(F.col("page_id") % 40 == 0).select(tail.alias("needle"), F.when(F.col("page_id") % 80 == 0, F.col("subdomain")).alias("scope"))
    return ru.block_by_rules(parts, rules, "url", "subdomain").select("page_id", "subdomain")


@register("challenge_page_rules")
def q_challenge_page_rules(spark, d):
    """F7 with a table of phrases: pieces of every hundredth page's head."""
    pages = fx.load(spark, d, "pages")
    phrases = pages.filter(F.col("page_id") % 100 == 0).select(F.substring("html", 400, 14).alias("needle"))
    return ru.challenge_by_rules(pages, phrases).select("page_id", "is_challenge")


@register("challenge_page_flag")
def q_challenge_page_flag(spark, d):
    return (fl.challenge_page_flag(fx.load(spark, d, "pages"), phrases=["ad 1 -->", 'lang="de"'])
            .select("page_id", "is_challenge"))


@register("newest_first_cutoff")
def q_newest_first_cutoff(spark, d):
    """Listings newest first; every 97th row has no time, which ends nothing."""
    ev = fx.load(spark, d, "events").withColumn("pos", -F.unix_micros(F.col("ts").cast("timestamp")))
    ev = ev.withColumn("ts", F.when(F.col("event_id") % 97 != 0, F.col("ts")))
    return fl.newest_first_cutoff(ev, ["event_type"], "pos", "ts", "2024-01-15").select("event_id", "event_type")


@register("has_key")
def q_has_key(spark, d):
    n = F.col("id").cast("bigint")
    arts = (_docs(spark, d).withColumn("url", F.when(n % 13 == 0, F.lit("")).otherwise(F.col("url")))
            .withColumn("id", F.when(n % 17 == 0, F.lit(None)).otherwise(F.col("id"))))
    return fl.has_key(arts, ["id", "url"]).select("id", "url")


# ---------------------------------------------------------------- joins (listing side)
@register("listing_detail")
def q_listing_detail(spark, d):
    listing = fx.load(spark, d, "documents").select("doc_id", "source")
    detail = fx.load(spark, d, "labels").select("doc_id", F.col("quality").cast("string").alias("detail"))
    return jn.listing_detail(listing, detail, "doc_id", mode="left", defaults={"detail": "No content found"})


@register("tag_lookup")
def q_tag_lookup(spark, d):
    lists = fx.tag_lists(fx.load(spark, d, "lineitem"))
    part = fx.load(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("slug"))
    return jn.tag_lookup(lists, "id", "tag_ids", part).select("id", "tags")


@register("listing_frontier")
def q_listing_frontier(spark, d):
    return ag.listing_frontier(fx.paged_listing(fx.load(spark, d, "events")), "2024-01-25")


# ---------------------------------------------------------------- HTML jobs
def _pages_fields(spark, d):
    pages = fx.load(spark, d, "pages")
    return hj.page_fields(pages).withColumn("_u", ur.url_parts("url"))


def _articles_fields(spark, d):
    """Article pages of every layout, parsed once."""
    pages = fx.article_pages(fx.load(spark, d, "documents"))
    return hj.page_fields(pages).withColumn("_u", ur.url_parts("url"))


@register("page_fields")
def q_page_fields(spark, d):
    p = F.col("f")
    return _pages_fields(spark, d).select(
        "page_id", hj.text(p, "title").alias("title"), F.size(hj.attrs(p, "a", "href")).alias("n_links"),
        F.size(hj.select(p, "nav > ul > li a")).alias("n_list_links"), hj.attr(p, "html", "lang").alias("lang"),
        hj.attr(p, "meta[charset]", "charset").alias("charset"), F.size(hj.select(p, "div.ad")).alias("n_ads"))


@register("title_fallback")
def q_title_fallback(spark, d):
    return _articles_fields(spark, d).select("doc_id", hj.title_fallback("f", F.col("_u.subdomain")).alias("title"))


@register("page_titles")
def q_page_titles(spark, d):
    return _pages_fields(spark, d).select("page_id", hj.title_fallback("f", F.col("_u.subdomain")).alias("title"))


@register("author_fallback")
def q_author_fallback(spark, d):
    return _articles_fields(spark, d).select("doc_id", hj.author_fallback("f", F.col("_u.subdomain")).alias("author"))


@register("content_fallback")
def q_content_fallback(spark, d):
    block = hj.content_fallback("f", F.col("_u.subdomain"))
    return _articles_fields(spark, d).select("doc_id", F.md5(block).alias("block_md5"), F.length(block).cast("long").alias("n_chars"))


@register("article_details")
def q_article_details(spark, d):
    """Fields and clean text of article pages: letters of the text, so that markup counts."""
    rows = hj.article_details(fx.article_pages(fx.load(spark, d, "documents")))
    words = F.array_join(F.regexp_extract_all("content", F.lit(r"(\p{L}+)"), 1), " ")
    return rows.select("id", "source", "title", "author", "tags", "category", "date", F.md5(words).alias("words_md5"))


@register("tags_from_hrefs")
def q_tags_from_hrefs(spark, d):
    return _pages_fields(spark, d).select("page_id", tx.tags_from_hrefs(hj.attrs(F.col("f"), "a", "href"), "/t").alias("tags"))


@register("html_clean_text")
def q_html_clean_text(spark, d):
    cleaned = hj.html_clean_text(fx.load(spark, d, "pages"), "html", classes=["ad"])
    words = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), 1)
    return cleaned.select("page_id", F.array_join(words, " ").alias("words"), F.size(words).alias("n_words"),
                          (~F.col("text").rlike("<[A-Za-z/!]")).alias("markup_free"))


def _index_pages(spark, d):
    pages = fx.load(spark, d, "pages")
    return pages.withColumn("date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 7).cast("int")))


HARVEST_OPTS = {"nav_lists": True, "resolve_relative": True}


def _harvested(spark, d):
    """Links of all index pages, parsed once and written; those of every second page count
    as stored before."""
    path = shared_path(spark, "links")
    hj.harvested_links(_index_pages(spark, d), carry=("page_id",), **HARVEST_OPTS).write.parquet(path)
    links = spark.read.parquet(path)
    return links, links.filter(F.col("page_id") % 2 == 0).select("id")


@register("link_harvest")
def q_link_harvest(spark, d):
    return hj.new_stubs(*_harvested(spark, d))


@register("harvest_counters")
def q_harvest_counters(spark, d):
    return ag.harvest_counters(*_harvested(spark, d), "date", ["_page_url", "_sec", "_link"])


@register("two_phase_crawl")
def q_two_phase_crawl(spark, d):
    """Index pages -> stubs -> fetched article pages -> filled articles."""
    articles = fx.article_pages(fx.load(spark, d, "documents"))
    root = shared_path(spark, "crawl")
    stubs = cw.harvest_index(spark.createDataFrame([], ARTICLE_SCHEMA), fx.index_pages(articles))
    stored = spark.read.schema(ARTICLE_SCHEMA).parquet(wr.commit_snapshot(stubs, root))
    filled = cw.resolve_articles(stored, articles)
    words = F.array_join(F.regexp_extract_all("content", F.lit(r"(\p{L}+)"), 1), " ")
    return filled.select("id", "source", "url", "title", "author", "tags", "category", "date", F.md5(words).alias("words_md5"))


# ---------------------------------------------------------------- text trends
def _tokens(spark, d, keep_case=False, together=False):
    """``together``: the texts of a document travel to one task before they are cut into
    tokens, so that its tokens need not."""
    docs = fx.load(spark, d, "documents")
    if together:
        docs = docs.select("doc_id", "text").repartition("doc_id")
    return tx.tokenise(docs, "doc_id", "text", keep_case_col="raw" if keep_case else None)


@register("tokenise")
def q_tokenise(spark, d):
    return _tokens(spark, d)


@register("stopword_anti")
def q_stopword_anti(spark, d):
    return jn.stopword_anti(_tokens(spark, d, keep_case=True), "raw").select("doc_id", "pos", "token")


def _term_counts(spark, d):
    toks = jn.stopword_anti(_tokens(spark, d, keep_case=True, together=True), "raw")
    return ag.term_counts(toks, "doc_id", "token")


@register("term_counts")
def q_term_counts(spark, d):
    return _term_counts(spark, d)


@register("top_terms")
def q_top_terms(spark, d):
    return tk.top_terms(_term_counts(spark, d), 10, "doc_id", "token")


def _lemmas(spark, toks):
    """Stand-in lemma table from the corpus, plural-looking words -> stem, written
    once (reliable checkpoint in the shared folder)."""
    checkpoint_root(spark)
    return (toks.filter(F.col("token").rlike("^\\p{L}{3,}s$")).select(F.col("token").alias("word"))
            .distinct().withColumn("lemma", F.expr("substring(word, 1, length(word) - 1)"))).checkpoint()


@register("lemma_lookup")
def q_lemma_lookup(spark, d):
    toks = _tokens(spark, d)
    return jn.lemma_lookup(toks, _lemmas(spark, toks), "token").select("doc_id", "pos", "lemma")


@register("token_bag")
def q_token_bag(spark, d):
    """The ten most common lemmas of every article, stopwords left out, with its
    title and date."""
    words = jn.stopword_anti(_tokens(spark, d, keep_case=True), "raw")
    bag = ag.term_counts(jn.lemma_lookup(words, _lemmas(spark, _tokens(spark, d)), "token"), "doc_id", "lemma")
    heads = _docs(spark, d).select(F.col("id").cast("bigint").alias("doc_id"), "title", "date")
    return tk.top_terms(bag, 10, "doc_id", "lemma").join(heads, "doc_id")


@register("trending_terms")
def q_trending_terms(spark, d):
    """Over articles stored in folders by day: the text of the two weeks is read, no other."""
    table = DatedTable(spark, shared_path(spark, "articles_by_day")).save(_docs(spark, d))
    return mt.trending_terms(table.read(), table.latest(), window_days=7, k=20)


# ---------------------------------------------------------------- streaming
def _seq_schema():
    from pyspark.sql import types as T
    from newslake.schema import ARTICLE_SCHEMA
    return T.StructType(ARTICLE_SCHEMA.fields + [T.StructField("seq", T.LongType())])


def _run_ingest(spark, d):
    root = shared_path(spark, "ingest")
    first, again = fx.article_arrivals(fx.load(spark, d, "documents"))
    fx.land(first, root + "/landing", 4)
    fx.land(again, root + "/landing", 2)
    q = st.stream_ingest(spark, root + "/landing", _seq_schema(), root + "/log", root + "/ckpt", files_per_trigger=2)
    q.awaitTermination()
    return root, q


@register("stream_ingest")
def q_stream_ingest(spark, d):
    root, _ = _run_ingest(spark, d)
    return st.current_table(spark, root + "/log", _seq_schema())


@register("stream_upsert")
def q_stream_upsert(spark, d):
    root = shared_path(spark, "ingest_upsert")
    fx.land(_versions(spark, d).withColumn("seq", F.col("seq").cast("bigint")), root + "/landing", 4)
    q = st.stream_ingest(spark, root + "/landing", _seq_schema(), root + "/log", root + "/ckpt", files_per_trigger=2)
    q.awaitTermination()
    return st.current_table(spark, root + "/log", _seq_schema(), how="upsert")


@register("stream_upsert_table")
def q_stream_upsert_table(spark, d):
    """Versions of records, landed in three drops by their order, folded batch by batch
    into a table that rewrites only the files a batch touches."""
    root = shared_path(spark, "upsert_table")
    table = FileTable(spark, root + "/table")
    records = _versions(spark, d).withColumn("seq", F.col("seq").cast("bigint"))
    for low, high in ((0, 1), (2, 4), (5, 1 << 40)):
        fx.land(records.filter(F.col("seq").between(low, high)), root + "/landing", 3)
        st.stream_upsert_table(table, root + "/landing", _seq_schema(), root + "/ckpt", "records", files_per_trigger=None).awaitTermination()
    return table.read()


DROPS = 6


@register("stream_progress")
def q_stream_progress(spark, d):
    """Progress of an ingest that is stopped and started for each of six drops: one batch
    a drop, all recorded."""
    root = shared_path(spark, "progress")
    arrivals, _ = fx.event_arrivals(fx.load(spark, d, "events"))
    with ProgressLog(spark, root + "/progress") as log:
        for k in range(DROPS):
            fx.land(arrivals.filter(F.col("seq") % DROPS == k), root + "/landing", 2)
            q = st.stream_ingest(spark, root + "/landing", _seq_schema(), root + "/log", root + "/ckpt", files_per_trigger=None)
            q.awaitTermination()
            log.wait(q)
    return read_progress(spark, root + "/progress").select("batch_id", "num_input_rows")


@register("stream_known_ids")
def q_stream_known_ids(spark, d):
    root = shared_path(spark, "known")
    first, again = fx.event_arrivals(fx.load(spark, d, "events"))
    fx.land(first, root + "/landing", 3)
    fx.land(again, root + "/landing", 2)
    stored = first.filter(F.col("seq") % 3 == 0).select("id")
    # Two files per trigger: some repeats share a micro-batch with their first
    # arrival (within-batch first-wins), others arrive in a later batch (state).
    q = stream_known_ids(spark, root + "/landing", _seq_schema(), stored, root + "/log", root + "/ckpt", files_per_trigger=2)
    q.awaitTermination()
    return spark.read.schema(_seq_schema()).parquet(root + "/log")


# ---------------------------------------------------------------- marts
@register("stg_articles")
def q_stg_articles(spark, d):
    return mt.stg_articles(_docs(spark, d), marker=" is ", source="src3")


def _docs_with_versions(spark, d):
    arts = _docs(spark, d)
    n = F.col("id").cast("bigint")
    newer = (arts.filter(n % 5 == 0).withColumn("title", F.lit("newer"))
             .withColumn("publish_time", F.col("publish_time") + F.expr("interval 1 day")))
    return arts.unionByName(newer)


def _cleaned(spark, d):
    arts = _docs_with_versions(spark, d)
    pages = _docs(spark, d).select("url", F.col("content").alias("html"))
    return mt.int_articles_cleaned(mt.stg_articles(arts), pages=pages, challenge_phrases=[" und "])


@register("int_articles_cleaned")
def q_int_articles_cleaned(spark, d):
    return _cleaned(spark, d)


@register("fct_articles")
def q_fct_articles(spark, d):
    return mt.fct_articles(_cleaned(spark, d))


@register("dim_sources")
def q_dim_sources(spark, d):
    return mt.dim_sources(_docs(spark, d))


@register("agg_daily_trends")
def q_agg_daily_trends(spark, d):
    return mt.agg_daily_trends(_events(spark, d), fill_calendar=True)


@register("incremental_refresh")
def q_incremental_refresh(spark, d):
    ev = _events(spark, d)
    n = F.col("id").cast("bigint")
    old, new = ev.filter(n % 10 != 0), ev.filter(n % 10 == 0)

    def build(arts):
        return ag.daily_counts(arts, by=["source"])

    path = shared_path(spark, "mart_daily")
    mt.write_partitions(build(old), path)                 # the mart before the new rows
    mt.refresh_partitions(path, ev, new, build)           # only touched dates rewritten
    return spark.read.parquet(path)


@register("layered_build")
def q_layered_build(spark, d):
    layers = [
        ("stg_articles", "view", lambda s: mt.stg_articles(_docs(s, d))),
        ("int_articles_cleaned", "view", lambda s: mt.int_articles_cleaned(s.table("stg_articles"))),
        ("dim_sources", "table", lambda s: mt.dim_sources(s.table("int_articles_cleaned"))),
    ]
    return wr.layered_build(spark, layers, shared_path(spark, "layers"))["dim_sources"]


__all__ = ["REGISTRY", "ARTICLE_COLUMNS"]
