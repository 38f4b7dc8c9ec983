"""HTML jobs over inline pages (cases the driver's pages table lacks)."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from newslake.functions import urls as ur
from newslake.operators import html as hj
from newslake.operators import pageparse as pp

SF = "/root/testdata/sf0.001"

INDEX = """<html><body>
<h4> News </h4><p>intro paragraph</p>
<ul><li><a href="https://newsinfo.inquirer.net/1/first-story">a</a></li>
    <li><a href="http://newsinfo.inquirer.net/2/insecure">b</a></li>
    <li><a href="https://newsinfo.inquirer.net/3/lotto-results">c</a></li>
    <li><a href="https://cebudailynews.inquirer.net/4/daily-gospel-today">d</a></li>
    <li><a href="https://newsinfo.inquirer.net/1/first-story">again</a></li></ul>
<h4>Sports</h4><h4>Lifestyle</h4>
<ul><li><a href="https://lifestyle.inquirer.net/5/style">e</a></li>
    <li><a href="https://cebudailynews.inquirer.net/6/daily-news">f</a></li></ul>
</body></html>"""


def _pages(spark, rows):
    return spark.createDataFrame(rows, "url string, html string")


def test_sections_follow_first_sibling_list(spark):
    page = hj.page_fields(_pages(spark, [("u", INDEX)]))
    secs = page.select(hj.section_links(F.col("f")).alias("s")).first().s
    assert [s.heading for s in secs] == ["News", "Sports", "Lifestyle"]
    assert len(secs[0].hrefs) == 5
    assert secs[1].hrefs == secs[2].hrefs == ["https://lifestyle.inquirer.net/5/style",
                                              "https://cebudailynews.inquirer.net/6/daily-news"]


@pytest.mark.parametrize("selector,want", [
    ("p", ["1", "2", "4"]), (".a", ["1", "3"]), ("div .a", ["3"]), ("div > p", ["2"]), ("div p", ["2", "4"]), ("#m", ["m"]), ("div#m > *", ["2", "3"]),
    ("div.b.c p", ["2", "4"]), ("div.b p.x", ["4"]), ("[data-k]", ["4"]), ('p[data-k="v/w"]', ["4"]), ('p[data-k^="v"]', ["4"]), ('[data-k$="w"]', ["4"]),
    ('p[data-k*="/"]', ["4"]), ('p[data-k="v"]', []), ("span div", []), (".d-e", ["4"]), ("section > p", ["4"]), (".aa", []), ("div.b.x", [])])
def test_selectors(spark, selector, want):
    html = ('<p class="a" title="1">x</p><div id="m" class="b c" title="m"><p title="2">x</p><span class="a" title="3">x'
            '<section><p class="x d-e" data-k="v/w" title="4">x</section></span></div>')
    got = hj.page_fields(_pages(spark, [("u", html)])).select(hj.attrs(F.col("f"), selector, "title").alias("t")).first().t
    assert got == want


def test_one_parse_node_in_every_plan(spark):
    for key in ("link_harvest", "harvest_counters", "page_fields", "title_fallback", "author_fallback", "content_fallback", "article_details",
                "html_clean_text", "tags_from_hrefs"):
        plan = E.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == (0 if key in ("link_harvest", "harvest_counters") else 1), key


def test_clean_text_of_tables_lists_and_noscript(spark):
    page = ("<head><title>no</title></head><table><tr><th>h1</th><th>h2</th></tr><tr><td>c1<td>c2</tr></table><ol><li>one<li>two <b>b</b></ol>"
            "<ul><li>x<ol><li>y</ol></ul><noscript>shown</noscript><p>a<br>b</p>tail<p>&nbsp;&eacute; &amp;lt;b&amp;gt; 1 &lt; 2")
    text = hj.html_clean_text(spark.createDataFrame([(page,), (None,), ("",)], "html string"), "html").select("text").collect()
    assert text[0].text == "h1 | h2\nc1 | c2\n\n1. one\n2. two b\n\n* x\n\n1. y\n\nshown\n\na\nb\n\ntail\n\n\u00a0é &lt;b&gt; 1 < 2"
    assert text[1].text is None and text[2].text == ""


def test_outer_is_the_markup_as_it_stands(spark):
    html = "<body>\n<p>é😀</p>\n<DIV  id=FOR_target_content class='q'>\nx <br/> <b>y</DIV ><p>after"
    p = hj.page_fields(_pages(spark, [("u", html)]))
    assert p.select(hj.content_fallback("f", F.lit("any")).alias("c")).first().c == "<DIV  id=FOR_target_content class='q'>\nx <br/> <b>y</DIV >"
    open_end = hj.page_fields(_pages(spark, [("u", "<div id='FOR_target_content'>cut")]))
    assert open_end.select(hj.content_fallback("f", F.lit("any")).alias("c")).first().c == "<div id='FOR_target_content'>cut"


def test_link_harvest_rules(spark):
    idx = spark.createDataFrame([(dt.date(2024, 1, 1), "https://www.inquirer.net/i", INDEX)],
                                "date date, url string, html string")
    known = spark.createDataFrame([("lifestyle:5:style",)], "id string")
    got = {r.id: (r.category, r.source) for r in hj.link_harvest(idx, known).collect()}
    assert got == {"newsinfo:1:first-story": ("News", "inquirer"),
                   "cebudailynews:6:daily-news": ("Sports", "inquirer")}
    only_news = hj.link_harvest(idx, known, categories=["news"])
    assert [r.id for r in only_news.collect()] == ["newsinfo:1:first-story"]


def test_title_author_content_layouts(spark):
    pages = [
        ("https://newsinfo.inquirer.net/1/a", '<head><meta property="og:title" content="  OG T  "><title>X</title></head>'),
        ("https://newsinfo.inquirer.net/2/b", '<head><meta property="og:title" content=""><title>Plain</title></head>'),
        ("https://lifestyle.inquirer.net/3/c", '<h1 class="elementor-heading-title">LS</h1>'
         '<div class="elementor-widget-post-info"><ul class="elementor-post-info"><li>'
         '<span class="elementor-post-info__terms-list"><a href="#">Ann</a></span></li></ul></div>'
         '<div class="elementor-widget-theme-post-content"><p>Body</p></div>'),
        ("https://pop.inquirer.net/4/d", '<div class="single-post-banner-inner"><h1>Pop T</h1></div>'
         '<ul class="blog-meta-list"><li><a href="/byline/bo">Bo</a></li></ul><div id="TO_target_content">P</div>'
         '<div class="tags-box"><span class="tags-links"><a href="https://pop/tag/music">m</a></span></div>'),
        ("https://cebudailynews.inquirer.net/5/e", '<div id="art-hgroup"><h1>Cebu T</h1></div>'
         '<div id="m-pd2"><span>Posted</span><span>By: Jo Cruz</span></div><div id="article-content">C</div>'),
        ("https://bandera.inquirer.net/6/f", '<div id="landing-headline"><h1>Band</h1></div>'
         '<div id="m-pd2"><span>Ana Reyes - Bandera</span></div>'),
        ("https://newsinfo.inquirer.net/7/g", '<h1 class="entry-title">Def</h1><div id="art_author" '
         'data-byline-strips="By Lee"></div><div id="FOR_target_content">D</div>'
         '<div id="article_tags"><a href="/tag/politics">p</a><a href="/other">o</a></div>'),
        ("https://newsinfo.inquirer.net/8/h", '<div id="art_plat"><span>By</span><a>Kim</a><span>x</span></div>'),
        ("https://newsinfo.inquirer.net/9/i", "<p>nothing</p>"),
    ]
    df = hj.page_fields(_pages(spark, pages)).withColumn("_u", ur.url_parts("url"))
    sub = F.col("_u.subdomain")
    out = df.select(hj.title_fallback("f", sub).alias("t"), hj.author_fallback("f", sub).alias("a"),
                    hj.content_fallback("f", sub).alias("c"), hj.tags_fallback("f", sub).alias("g")).collect()
    assert [r.t for r in out] == ["OG T", "Plain", "LS", "Pop T", "Cebu T", "Band", "Def", "No title", "No title"]
    assert [r.a for r in out] == ["No author", "No author", "Ann", "Bo", "Jo Cruz", "Ana Reyes", "By Lee", "Kim",
                                  "No author"]
    assert out[2].c.startswith('<div class="elementor-widget-theme-post-content">') and "Body" in out[2].c
    assert out[8].c == "Cannot extract article content"
    assert out[3].g == "music" and out[6].g == "politics"


def test_publish_time_from_page(spark):
    pages = [("https://x.y/1", '<meta property="article:published_time" content="Tue, 05 Mar 2024 10:20:30 PHT">'),
             ("https://x.y/2", '<meta name="parsely-pub-date" content="2024-03-05T10:20:30+08:00">'),
             ("https://x.y/3", '<div class="bmhead-headline"><span class="bpdate">March 5, 2024</span></div>'),
             ("https://x.y/4", "<p/>")]
    out = hj.page_fields(_pages(spark, pages)).select(hj.publish_time_fallback("f").alias("p")).collect()
    assert [r.p for r in out] == [dt.datetime(2024, 3, 5, 10, 20, 30), dt.datetime(2024, 3, 5, 10, 20, 30),
                                  dt.datetime(2024, 3, 5), None]


def test_clean_text_drops_and_unescapes(spark):
    page = ('<div id="fb-root"><p>gone</p></div><div class="ztoop x"><span>gone too</span></div>'
            '<script>var a="<p>";</script><h2>Head</h2><p>Keep   <b>bold</b> <a href="/l">link</a>'
            ' <img src="i.png"></p>\n\n\n\n<p>&lt;em&gt;escaped&lt;/em&gt; &amp; done</p><ul><li>one</li></ul>')
    df = spark.createDataFrame([(page,)], "html string")
    text = hj.html_clean_text(df, "html").first().text
    assert "gone" not in text and "var a" not in text and "<" not in text
    assert "## Head" in text and "Keep bold link" in text and "* one" in text
    assert "escaped & done" in text and "\n\n\n" not in text
    listing = hj.html_clean_text(df, "html", ids=[], classes=[], tags=["img"], mode="listing").first().text
    assert "gone" in listing


def test_deeply_nested_unclosed_tags(spark):
    # Unclosed tags nest one level per occurrence; traversal must not recurse.
    page = "<div id='FOR_target_content'>" + "<p>word " * 5000 + "</div>"
    df = spark.createDataFrame([(page,)], "html string")
    text = hj.html_clean_text(df, "html").first().text
    assert text.split() == ["word"] * 5000


def test_parsed_pages_are_sent_on_a_few_at_a_time(spark):
    pages = ["<p>a</p>", None, ""] * 40
    got = list(pp.packs(iter([pa.array(pages), pa.array([], pa.string())])))
    assert [len(x) for x in got] == [32, 32, 32, 24]
    assert [x["pieces"] and [t["text"] for t in x["pieces"]] if x else x for x in pa.concat_arrays(got).to_pylist()] == [["a"], None, []] * 40
    df = spark.createDataFrame([(i, x) for i, x in enumerate(pages)], "i long, h string").coalesce(1)
    rows = df.select("i", "h", pp.parse_page(F.col("h")).alias("p")).collect()
    assert len(rows) == 120 and all((r.p is None) == (r.h is None) for r in rows)
