import datetime as dt

from pyspark.sql import functions as F

from newslake.functions import text as tx
from newslake.functions import timeparse as tp
from newslake.functions import urls as ur


def test_url_parts_and_key(spark):
    df = spark.createDataFrame([("https://newsinfo.inquirer.net/1234/some-slug/more/",),
                                ("https://user@host.example.com:8080/a",),
                                ("https://single/",), ("not a url",)], "url string")
    got = df.select(ur.url_parts("url").alias("p")).select("p.*", ur.article_key(F.struct(
        F.col("subdomain"), F.col("origin"), F.col("article_id"), F.col("slug"))).alias("k")).collect()
    assert tuple(got[0])[:4] == ("newsinfo", "inquirer", "1234", "some-slug/more")
    assert got[0]["k"] == "newsinfo:1234:some-slug/more"          # K1: key from URL parts
    assert got[1]["subdomain"] == "user@host" and got[1]["origin"] == "example"   # netloc keeps user info
    assert tuple(got[2])[:4] == ("single", "", "", "")
    assert got[3]["article_id"] == "not a url"                     # never fails, like urlparse


def test_url_category(spark):
    df = spark.createDataFrame([("https://posts.example.com/nation/x/",), ("https://h.com/",), ("https://h.com",)], "u string")
    assert [r[0] for r in df.select(ur.url_category("u")).collect()] == ["nation", "", None]


def test_publish_time_forms(spark):
    cases = [
        ("Tue, 05 Mar 2024 10:20:30 PST", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("Tue, 5 Mar 2024 10:20:30 PHT", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("Tue, 05 Mar 2024 10:20:30 GMT", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("Tue, 05 Mar 2024 10:20:30 UTC", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("2024-03-05T10:20:30+08:00", None, dt.datetime(2024, 3, 5, 10, 20, 30)),   # K16: wall clock kept
        ("2024-03-05T10:20:30", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("2024-03-05", None, dt.datetime(2024, 3, 5)),
        (None, "March 5, 2024", dt.datetime(2024, 3, 5)),
        (None, "- March 5, 2024 -", dt.datetime(2024, 3, 5)),
        ("garbage", None, None),
        ("Lundi, 05 Mar 2024 10:20:30", None, None),          # not an English weekday: no parse
        ("tue, 05 Mar 2024 10:20:30", None, dt.datetime(2024, 3, 5, 10, 20, 30)),
        ("garbage", "not a date", None),
    ]
    df = spark.createDataFrame([(m, b) for m, b, _ in cases], "m string, b string")
    got = [r[0] for r in df.select(tp.publish_time_parse(F.col("m"), F.col("b"))).collect()]
    assert got == [e for _, _, e in cases]


def test_publish_time_array_first_parse_wins(spark):
    df = spark.createDataFrame([(["bad", "2024-01-02T03:04:05", "2025-01-01"], None)], "m array<string>, b string")
    assert df.select(tp.publish_time_parse_array("m", "b")).first()[0] == dt.datetime(2024, 1, 2, 3, 4, 5)


def test_api_time_parse(spark):
    df = spark.createDataFrame([("2024-03-05T10:20:30.123Z", 0), ("2024-03-05 10:20:30", 1),
                                ("2024-03-05T10:20:30", 2), ("oops", 1)], "t string, k int")
    fmts = {0: tp.ISO_Z_FRACTION, 1: tp.SPACE_SECONDS, 2: tp.ISO_T_SECONDS}
    expr = F.when(F.col("k") == 0, tp.api_time_parse("t", fmts[0])).when(
        F.col("k") == 1, tp.api_time_parse("t", fmts[1])).otherwise(tp.api_time_parse("t", fmts[2]))
    got = [tuple(r[0]) if r[0] else None for r in df.select(expr).collect()]
    exp = (dt.date(2024, 3, 5), dt.datetime(2024, 3, 5, 10, 20, 30))
    assert got[:3] == [exp, exp, exp]
    assert got[3] == (None, None)


def test_tags(spark):
    df = spark.createDataFrame([(" a , b,, c ",), (None,), ("x",)], "t string")
    assert [r[0] for r in df.select(tx.tags_normalise("t")).collect()] == ["a,b,c", "", "x"]
    assert df.select(tx.tags_to_array("t")).first()[0] == [" a ", " b", "", " c "]   # staging: no trim
    h = spark.createDataFrame([(["/tag/one", "/x/y", "https://s/tag/two/tag/three", "/tag/"],)], "h array<string>")
    assert h.select(tx.tags_from_hrefs("h")).first()[0] == "one, two, "


def test_whitespace_and_boilerplate(spark):
    df = spark.createDataFrame([("  a  b\n\n\n\nc   ",)], "t string")
    assert df.select(tx.whitespace_collapse("t")).first()[0] == "a b\n\nc"
    d2 = spark.createDataFrame([("Body\n\ntext Read Next other", "  T\n\nx ")], "c string, t string")
    r = d2.select(tx.boilerplate_cut("c", "Read Next"), tx.title_cut("t")).first()
    assert tuple(r) == ("Body text", "T x")


def test_tokenise_rules(spark):
    df = spark.createDataFrame([(1, "The cat's co2 foo-bar don't RUN, 'quoted' word_x Été")], "id long, text string")
    got = [(r["pos"], r["raw"], r["token"]) for r in tx.tokenise(df, "id", "text", keep_case_col="raw").collect()]
    assert [t for _, _, t in got] == ["the", "cat", "do", "run", "quoted", "été"]
    assert got[0][1] == "The"                              # K11: case kept for stopword test
    assert [p for p, _, _ in got] == sorted(p for p, _, _ in got)


def test_parsing_ignores_session_time_zone(spark):
    # 02:30 on 2024-03-10 does not exist in New York; the wall clock must
    # still come back as written (K16: stored as wall-clock timestamp_ntz).
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("Sun, 10 Mar 2024 02:30:00 PST", "2024-03-10 02:30:45.5")], "m string, t string")
        r = df.select(tp.publish_time_parse("m").alias("a"),
                      tp.api_time_parse("t", "yyyy-MM-dd HH:mm:ss.S")["publish_time"].alias("b")).first()
        assert r.a == dt.datetime(2024, 3, 10, 2, 30) and r.b == dt.datetime(2024, 3, 10, 2, 30, 45)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
