"""Adapters: present the driver's test tables in the shapes the operators take.

An adapter only reshapes rows into the schema a job expects; it does none of
the job's work.  The same reshaping is written as SQL in
:mod:`newslake.plans.oracle` so the DuckDB oracle starts from identical input.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.schema import conform_articles

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table."""
    return spark.read.parquet(table_path(sf_dir, name))


def articles_from_documents(documents: DataFrame) -> DataFrame:
    """Adapter A: documents as articles (10% stubs, 10% 'No title')."""
    d = documents
    title = (F.when(d.doc_id % 10 == 0, F.lit(None).cast("string"))
             .when(d.doc_id % 10 == 1, F.lit("No title"))
             .otherwise(F.split_part(d.text, F.lit("\n"), F.lit(1))))
    date = F.date_add(F.lit(_dt.date(2024, 1, 1)), (d.doc_id % 90).cast("int"))
    return conform_articles(d.select(
        d.doc_id.cast("string").alias("id"), d.source,
        F.concat(F.lit("https://"), d.source, F.lit(".example.com/"), d.doc_id.cast("string"), F.lit("/"),
                 d.lang).alias("url"),
        d.lang.alias("category"), title.alias("title"), F.lit(None).cast("string").alias("author"),
        date.alias("date"), date.cast("timestamp_ntz").alias("publish_time"), d.text.alias("content"),
        F.concat(d.lang, F.lit(","), d.source).alias("tags")))


def articles_from_events(events: DataFrame) -> DataFrame:
    """Adapter E: events as articles (4 sources x 5 categories x 30 days)."""
    e = events
    return e.select(e.event_id.cast("string").alias("id"),
                    F.concat(F.lit("u"), (e.user_id % 4).cast("string")).alias("source"),
                    e.event_type.alias("category"), e.ts.cast("date").alias("date"))


def versions_from_conversations(conversations: DataFrame) -> DataFrame:
    """Adapter V: conversation turns as versions of a record (``seq`` = turn,
    user turns are stubs)."""
    c = conversations
    return conform_articles(c.select(
        c.conv_id.cast("string").alias("id"), c.role.alias("source"),
        F.concat(F.lit("turn-"), c.turn.cast("string")).alias("url"),
        F.when(c.role == "user", F.lit(None).cast("string")).otherwise(_first_line(c)).alias("title"),
        c.text.alias("content"), c.turn.alias("seq")), extra=["seq"])


# ---- Adapter J: documents as JSON listings ----------------------------------
DOC_TS = "timestampadd(SECOND, -doc_id * 3607, timestamp_ntz'2024-03-01 00:00:00')"


def ts_text(ts, form: str):
    """Text of a ``timestamp_ntz`` without involving the session time zone
    (``date_format`` would route it through a zoned timestamp)."""
    base = F.substring(ts.cast("string"), 1, 19)                      # yyyy-MM-dd HH:mm:ss
    sec = F.date_part(F.lit("SECOND"), ts)
    frac = lambda digits: F.lpad(F.pmod(F.floor(sec * (10 ** digits)), F.lit(10 ** digits)).cast("string"),
                                 digits, "0")
    if form == "space":
        return base
    if form == "iso":
        return F.replace(base, F.lit(" "), F.lit("T"))
    if form == "iso_millis_z":
        return F.concat(F.replace(base, F.lit(" "), F.lit("T")), F.lit("."), frac(3), F.lit("Z"))
    if form == "space_micros":
        return F.concat(base, F.lit("."), frac(6))
    if form == "rfc":
        return F.concat(F.date_format(F.to_date(ts), "EEE, dd MMM yyyy"), F.lit(" "), F.substring(base, 12, 8))
    if form == "long_date":
        return F.date_format(F.to_date(ts), "MMMM d, yyyy")
    raise ValueError(form)


def _doc_ts():
    return F.expr(DOC_TS)


def _first_line(d):
    return F.substring_index(d.text, "\n", 1)


def _body(d, markup: bool):
    """Body of a listing record: the text, or markup of it, escaped once more as listings send it."""
    if not markup:
        return d.text
    return F.concat(F.lit("<p>"), _escaped(d.text, 2), F.lit("</p><figure>caption</figure><p>end <b>of</b> text</p>"))


def listing_a(documents: DataFrame, markup: bool = False) -> tuple[DataFrame, DataFrame]:
    """Shape A landing rows: (page, value) listing pages of 50 items, newest
    first, and one detail record per item (some items have none)."""
    d = documents
    item = F.struct(d.doc_id.alias("_id"),
                    ts_text(_doc_ts(), "iso_millis_z").alias("createdDateFull"),
                    F.when(d.doc_id % 13 == 0, F.lit(None).cast("string"))
                    .otherwise(F.concat(d.lang, F.lit("/"), d.doc_id.cast("string"))).alias("slugline_url"),
                    d.lang.alias("category"), _first_line(d).alias("title"), d.source.alias("author"),
                    F.concat(d.lang, F.lit(","), d.source).alias("tags"))
    pages = (d.select(F.expr("doc_id div 50").alias("page"), F.struct(d.doc_id.alias("k"), item.alias("it")).alias("x"))
             .groupBy("page")
             .agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["it"])
                                     .alias("listItem"))).alias("value")))
    details = d.filter(d.doc_id % 11 != 0).select(
        F.to_json(F.struct(d.doc_id.alias("_id"), F.struct(_body(d, markup).alias("body_html")).alias("data"))).alias("value"))
    return pages, details


def listing_b(documents: DataFrame, markup: bool = False) -> tuple[DataFrame, DataFrame]:
    """Shape B landing rows: per (section, page) summaries; detail records
    with absent keys, empty bodies and failed responses mixed in."""
    d = documents
    ptime = ts_text(_doc_ts(), "space")
    row = F.struct(d.doc_id.alias("cms_article_id"),
                   F.when(d.doc_id % 19 == 0, F.lit("")).otherwise(ptime).alias("publish_time"))
    pages = (d.select(d.source.alias("section"), F.expr("doc_id div 200").alias("page"),
                      F.struct(d.doc_id.alias("k"), row.alias("r")).alias("x"))
             .groupBy("section", "page")
             .agg(F.to_json(F.struct(F.lit("success").alias("response"),
                                     F.transform(F.array_sort(F.collect_list("x")), lambda x: x["r"]).alias("data")))
                  .alias("value")))
    data = F.struct(
        d.doc_id.alias("cms_article_id"),
        F.when(d.doc_id % 4 == 0, F.lit("")).otherwise(_body(d, markup)).alias("body"),
        F.when(d.doc_id % 8 == 0, F.lit(None).cast("string")).otherwise(_first_line(d)).alias("summary"),
        F.concat(F.lit(" "), d.lang, F.lit(" ,, "), d.source, F.lit(" ")).alias("cf_article_tags"),
        F.concat(F.lit("https://sections.example.com/"), d.lang, F.lit("/"), d.doc_id.cast("string")).alias("link"),
        F.when(d.doc_id % 6 == 0, F.lit(None).cast("string")).otherwise(F.upper(d.lang)).alias("section_name"),
        F.when(d.doc_id % 9 == 0, F.lit(None).cast("string")).otherwise(_first_line(d)).alias("title"),
        F.when(d.doc_id % 5 == 0, F.lit(None).cast("string")).otherwise(d.source).alias("author_name"),
        ptime.alias("publish_time"))
    details = d.select(F.to_json(F.struct(
        F.when(d.doc_id % 23 == 0, F.lit("error")).otherwise(F.lit("success")).alias("response"),
        data.alias("data"))).alias("value"))
    return pages, details


def _lang_code(d):
    return F.ascii(F.substring(d.lang, 1, 1)).cast("bigint") * 1000 + F.ascii(F.substring(d.lang, 2, 1))


def _source_num(d):
    return F.substring(d.source, 4, 10).cast("bigint")


def listing_c(documents: DataFrame, markup: bool = False) -> tuple[DataFrame, DataFrame]:
    """Shape C landing rows: pages of 10 posts with nested ``rendered``
    fields and tag-id arrays, plus the tag dimension (id, slug)."""
    d = documents
    post = F.struct(
        d.doc_id.alias("id"),
        F.concat(F.lit("https://posts.example.com/"), d.lang, F.lit("/"), d.doc_id.cast("string"), F.lit("/")).alias("link"),
        ts_text(_doc_ts(), "iso").alias("date"),
        F.when(d.doc_id % 9 == 0, F.lit(None)).otherwise(F.struct(_first_line(d).alias("rendered"))).alias("title"),
        F.struct(_body(d, markup).alias("rendered")).alias("content"),
        F.array(_lang_code(d), _source_num(d), F.lit(999999).cast("bigint")).alias("tags"))
    pages = (d.select(F.expr("doc_id div 10").alias("page"), F.struct(d.doc_id.alias("k"), post.alias("p")).alias("x"))
             .groupBy("page")
             .agg(F.to_json(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["p"])).alias("value")))
    dim = (d.select(_source_num(d).alias("id"), d.source.alias("slug"))
           .unionByName(d.select(_lang_code(d).alias("id"), d.lang.alias("slug"))).distinct())
    return pages, dim


def raw_records(documents: DataFrame) -> DataFrame:
    """Adapter for S11: untyped records as a buffered loader receives them."""
    d = documents
    stamp = ts_text(_doc_ts(), "space")
    return d.select(d.doc_id.alias("id"), d.source, d.lang.alias("category"),
                    F.concat(F.lit("https://example.com/"), d.doc_id.cast("string")).alias("url"),
                    _first_line(d).alias("title"),
                    F.when(d.doc_id % 3 == 0, F.lit("None")).otherwise(d.source).alias("author"),
                    stamp.alias("date"), stamp.alias("publish_time"), d.text.alias("cleaned_content"),
                    F.when(d.doc_id % 4 == 0, F.lit("None")).otherwise(d.lang).alias("tags"))


def faulty_records(documents: DataFrame) -> DataFrame:
    """:func:`raw_records` with ids, dates and times that are missing or unreadable."""
    n = F.col("id")
    return raw_records(documents).withColumns({
        "date": F.when(n % 7 == 2, F.lit("some day")).when(n % 5 == 1, F.lit("None")).otherwise(F.col("date")),
        "publish_time": F.when(n % 11 == 3, F.lit("soon")).otherwise(F.col("publish_time")),
        "id": F.when(n % 13 != 0, n)})


def faulty_pages(pages: DataFrame, page: str = "page") -> DataFrame:
    """Listing pages of which every seventh is cut short and every eleventh is missing."""
    return pages.withColumn("value", F.when(F.col(page) % 11 == 4, F.lit(None))
                            .when(F.col(page) % 7 == 3, F.expr("substring(value, 1, length(value) - 5)")).otherwise(F.col("value")))


CUSTOMER_CSV = "c_custkey long, c_name string, c_acctbal double"


def faulty_csv(customer: DataFrame, path: str) -> str:
    """Customers as CSV lines, some with a field too few or too many, or a word for a number."""
    k = customer.c_custkey
    line = (F.when(k % 9 == 1, F.concat_ws(",", k, customer.c_name))
            .when(k % 9 == 2, F.concat_ws(",", k, customer.c_name, customer.c_acctbal, F.lit("more")))
            .when(k % 9 == 3, F.concat_ws(",", k, customer.c_name, F.lit("plenty")))
            .otherwise(F.concat_ws(",", k, customer.c_name, customer.c_acctbal)))
    customer.select(line.alias("value")).write.text(path)
    return path


# ---- Adapter G: lineitem as tag-id lists, part as the tag dimension --------
def tag_lists(lineitem: DataFrame) -> DataFrame:
    """Per order: l_partkey list in (l_linenumber, l_partkey) order."""
    return (lineitem.groupBy(F.col("l_orderkey").cast("string").alias("id"))
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))),
                             lambda x: x["l_partkey"]).alias("tag_ids")))


# ---- Adapter L: events as a paged, newest-first listing ---------------------
def paged_listing(events: DataFrame, page_size: int = 25) -> DataFrame:
    """section = event_type; rows newest first (highest event_id first); the
    listing is cut into pages of ``page_size`` consecutive event ids, so a
    section's page may hold a few rows or none (a gap ends that section's
    walk).  Some rows lack a time; 'known' = stored before.  No window: page
    and position come from the id and a scalar max, so no section is
    gathered into one task."""
    newest = events.select(F.max("event_id")).scalar()
    back = newest - F.col("event_id")
    return events.select(F.col("event_type").alias("section"),
                         (F.floor(back / page_size) + 1).cast("long").alias("page"), back.alias("pos"),
                         F.col("event_id").cast("string").alias("id"),
                         F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("ts")).alias("ts"),
                         (F.col("user_id") < 75).alias("known"))


# ---- Adapter W: documents as article pages of every site layout -------------
def _escaped(c, times: int = 1):
    amp = "&" + "amp;" * times
    for sign, name in (("&", ""), ("<", "lt;"), (">", "gt;")):
        c = F.replace(c, F.lit(sign), F.lit(amp if not name else "&" + "amp;" * (times - 1) + name))
    return c


LAYOUT_HOSTS = ["newsinfo", "lifestyle", "pop", "cebudailynews", "bandera", "newsinfo", "newsinfo"]
LAYOUT_BLOCKS = ['div id="FOR_target_content"', 'div class="x elementor-widget-theme-post-content"', 'div id="TO_target_content"',
                 'div id="article-content"', 'div id="FOR_target_content"', 'div id="FOR_target_content"', 'div id="other"']


def article_pages(documents: DataFrame) -> DataFrame:
    """(doc_id, url, html, category, date): a page per document, in seven layouts by id; the
    last has none of the fields.  Titles, bylines, times, tags and blocks vary by row."""
    d = documents
    k = d.doc_id % 7
    title = F.concat(F.lit("Title "), d.doc_id, F.lit(" of "), d.source)
    author = F.concat(F.lit("Writer "), d.doc_id % 37)
    pick = lambda xs: F.element_at(F.array(*[x if not isinstance(x, str) else F.lit(x) for x in xs]), (k + 1).cast("int"))
    c = F.concat
    head = pick([c(F.lit('<meta property="og:title" content=" '), title, F.lit(' "><title>Site</title><meta name="author" content="'), author, F.lit('">')),
                 "", "", "", "", "", ""])
    byline = pick(["",
                   c(F.lit('<h1 class="a elementor-heading-title">'), title, F.lit('</h1><div class="elementor-widget-post-info"><ul class="elementor-post-info"><li>'
                     '<span class="elementor-post-info__terms-list"><a href="#">'), author, F.lit("</a></span></li></ul></div>")),
                   c(F.lit('<div class="single-post-banner-inner"><h1>'), title, F.lit('</h1></div><ul class="blog-meta-list"><li><a href="/x">no</a><a href="/byline/w">'),
                     author, F.lit('</a></li></ul><div class="tags-box"><span class="tags-links"><a href="https://pop/tag/'), d.lang, F.lit('">t</a></span></div>')),
                   c(F.lit('<div id="art-hgroup"><h1>'), title, F.lit('</h1></div><div id="m-pd2"><span>Posted</span><span>By: '), author, F.lit("</span></div>")),
                   c(F.lit('<div id="landing-headline"><h1>'), title, F.lit('</h1></div><div id="m-pd2"><span>'), author, F.lit(" - Bandera</span></div>")),
                   c(F.lit('<h1 class="entry-title">'), title, F.lit('</h1><div id="art_author" data-byline-strips="'), author,
                     F.lit('"></div><div id="article_tags"><a href="/tag/'), d.lang, F.lit('">p</a><a href="/other">o</a></div>')),
                   "<p>nothing here</p>"])
    block = c(F.lit("<"), pick(LAYOUT_BLOCKS), F.lit("><h2>Part</h2><p>"), _escaped(d.text), F.lit("</p><table><tr><td>c1</td><td>c2</td></tr></table></div>"))
    host = pick(LAYOUT_HOSTS)
    return d.select("doc_id", c(F.lit("https://"), host, F.lit(".press.example/"), d.doc_id, F.lit("/story")).alias("url"),
                    c(F.lit("<html><head>"), head, F.lit('</head><body><div class="ztoop">advert</div>'), byline, block, F.lit("<script>var a = 1;</script></body></html>")).alias("html"),
                    d.lang.alias("category"), F.date_add(F.lit(_dt.date(2024, 1, 1)), (d.doc_id % 90).cast("int")).alias("date"))


def index_pages(articles: DataFrame, links: int = 200) -> DataFrame:
    """(date, url, html): index pages of ``links`` consecutive articles at most, a heading and
    a list of links for each category."""
    a = articles.select("date", "category", "url", F.expr(f"doc_id div {links}").alias("part"), "doc_id")
    lists = a.groupBy("date", "part", "category").agg(F.array_sort(F.collect_list(F.struct("doc_id", "url"))).alias("ls"))
    lists = lists.select("date", "part", "category", F.concat(F.lit("<h4> "), F.col("category"), F.lit(" </h4><ul>"), F.array_join(F.transform(
        "ls", lambda x: F.concat(F.lit('<li><a href="'), x["url"], F.lit('">x</a></li>'))), ""), F.lit("</ul>")).alias("list"))
    return lists.groupBy("date", "part").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("category", "list"))), lambda x: x["list"]), "").alias("html")) \
        .select("date", F.concat(F.lit("https://press.example/index/"), F.col("date").cast("string"), F.lit("/"), F.col("part")).alias("url"), "html")


# ---- Adapter P: events.ts written in the text forms pages use ---------------
ZONES = ["PST", "PHT", "UTC", "GMT"]


def formatted_times(events: DataFrame) -> DataFrame:
    """(event_id, meta, body): meta in RFC-like / ISO forms, body date text,
    or garbage; the expected parse of each is derivable from ts."""
    e = events
    zone = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (e.event_id % 4 + 1).cast("int"))
    k = e.event_id % 5
    meta = (F.when(k == 0, F.concat(ts_text(e.ts, "rfc"), F.lit(" "), zone))
            .when(k == 1, F.concat(ts_text(e.ts, "iso"), F.lit("+08:00")))
            .when(k == 2, ts_text(e.ts, "space_micros"))
            .when(k == 4, F.lit("n/a")))
    body = F.when(k == 3, ts_text(e.ts, "long_date"))
    return e.select("event_id", meta.alias("meta"), body.alias("body"))


def api_times(events: DataFrame) -> DataFrame:
    """(event_id, kind, text): the three listing time formats."""
    e = events
    k = e.event_id % 3
    text = (F.when(k == 0, ts_text(e.ts, "iso_millis_z"))
            .when(k == 1, ts_text(e.ts, "space"))
            .otherwise(ts_text(e.ts, "iso")))
    return e.select("event_id", k.alias("kind"), text.alias("text"))


def raw_tags(part: DataFrame) -> DataFrame:
    """(p_partkey, raw): comma text with spaces and empty pieces; some NULL."""
    p = part
    raw = F.concat(F.lit(" "), p.p_brand, F.lit(" ,, "), F.replace(p.p_type, F.lit(" "), F.lit(" , ")), F.lit(", "))
    return p.select("p_partkey", F.when(p.p_partkey % 11 == 0, F.lit(None).cast("string")).otherwise(raw).alias("raw"))


# ---- landing files for the streaming jobs -----------------------------------
def land(df: DataFrame, path: str, files: int) -> str:
    """Write ``df`` as about ``files`` parquet files under ``path`` (append), or one for every
    four partitions of ``df`` if that is more, so that what a task writes or reads does not
    grow with ``df``."""
    df.repartition(max(files, df.rdd.getNumPartitions() // 4)).write.mode("append").parquet(path)
    return path


def article_arrivals(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first arrivals, later repeats) of documents-as-articles, with ``seq``."""
    arts = articles_from_documents(documents)
    n = F.col("id").cast("bigint")
    first = arts.withColumn("seq", n)
    again = arts.filter(n % 4 == 0).withColumn("title", F.lit("again")).withColumn("seq", n + 1_000_000)
    return first, again


def event_arrivals(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(first arrivals, later repeats) of events-as-articles, with ``seq``."""
    arts = conform_articles(articles_from_events(events))
    n = F.col("id").cast("bigint")
    first = arts.withColumn("seq", n)
    again = arts.filter(n % 5 == 0).withColumn("category", F.lit("again")).withColumn("seq", n + 1_000_000)
    return first, again
