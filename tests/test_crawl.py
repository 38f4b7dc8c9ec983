import datetime as dt

from pyspark.sql import functions as F

from newslake.plans import crawl
from newslake.schema import ARTICLE_SCHEMA

INDEX = """<h4>News</h4><ul><li><a href="https://newsinfo.inquirer.net/11/story-a">a</a></li>
<li><a href="https://newsinfo.inquirer.net/12/story-b">b</a></li></ul>"""
ARTICLE_A = ('<head><meta property="og:title" content="Story A"><meta name="author" content="Ann">'
             '<meta property="article:published_time" content="2024-03-05T08:00:00+08:00"></head>'
             '<div id="FOR_target_content"><p>Para one.</p><script>x()</script><p>Para two.</p></div>'
             '<div id="article_tags"><a href="/tag/politics">p</a></div>')
ARTICLE_B = "<p>no layout at all</p>"


def test_two_phase_crawl(spark):
    table = spark.createDataFrame([("newsinfo:12:story-b", "inquirer", "https://newsinfo.inquirer.net/12/story-b",
                                    "News", "Old", "x", dt.date(2024, 3, 1), None, "kept", None)], ARTICLE_SCHEMA)
    idx = spark.createDataFrame([(dt.date(2024, 3, 5), "https://www.inquirer.net/i", INDEX)],
                                "date date, url string, html string")
    t1 = crawl.harvest_index(table, idx)
    rows = {r.id: r for r in t1.collect()}
    assert rows["newsinfo:11:story-a"].title is None                    # new stub
    assert rows["newsinfo:12:story-b"].content == "kept"                # stored row untouched
    fetched = spark.createDataFrame([("https://newsinfo.inquirer.net/11/story-a", ARTICLE_A),
                                     ("https://newsinfo.inquirer.net/12/story-b", ARTICLE_B)], "url string, html string")
    t2 = {r.id: r for r in crawl.resolve_articles(t1, fetched).collect()}
    a = t2["newsinfo:11:story-a"]
    assert (a.title, a.author, a.tags, a.category, a.date) == ("Story A", "Ann", "politics", "News", dt.date(2024, 3, 5))
    assert a.publish_time == dt.datetime(2024, 3, 5, 8) and a.content == "Para one.\n\nPara two."
    assert t2["newsinfo:12:story-b"].title == "Old"                     # not pending: not refetched
    # Re-crawl of failed extractions overwrites the bad values (K3: NULLs too).
    bad = t1.withColumn("title", F.when(F.col("id") == "newsinfo:12:story-b", "No title").otherwise(F.col("title")))
    t3 = {r.id: r for r in crawl.resolve_articles(bad, fetched, work="unextracted").collect()}
    b = t3["newsinfo:12:story-b"]
    assert b.title == "No title" and b.content == "Cannot extract article content" and b.source == "inquirer"
