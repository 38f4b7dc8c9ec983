"""Column functions against plain-Python brute force on generated inputs."""

import re
from urllib.parse import urlparse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from newslake.functions import text as tx
from newslake.functions import urls as ur

SEG = st.text(alphabet="abcXYZ019-._~;:@", min_size=0, max_size=6)
URLS = st.builds(
    lambda scheme, labels, port, segs, slash, q, frag: (
        f"{scheme}://{'.'.join(labels)}{port}/" + "/".join(segs) + ("/" if slash else "") + q + frag),
    st.sampled_from(["http", "https"]), st.lists(st.text(alphabet="abz09-", min_size=1, max_size=5), min_size=1,
                                                 max_size=4),
    st.sampled_from(["", ":8080"]), st.lists(SEG, max_size=4), st.booleans(),
    st.sampled_from(["", "?a=1&b=2", "?x"]), st.sampled_from(["", "#top", "#a/b"]))
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def expected_parts(url):
    parsed = urlparse(url)
    parts = parsed.netloc.split(".")
    path_parts = parsed.path.strip("/").split("/", 1)
    return (parts[0], parts[1] if len(parts) > 1 else "", path_parts[0] if path_parts else "",
            path_parts[1] if len(path_parts) > 1 else "")


@SETTINGS
@given(st.lists(URLS, min_size=1, max_size=60))
def test_url_parts_match_urlparse(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [tuple(r.p) for r in df.select(ur.url_parts("url").alias("p")).collect()]
    assert got == [expected_parts(u) for u in urls]


@SETTINGS
@given(st.lists(st.text(alphabet="ab ,\t", max_size=12), min_size=1, max_size=60))
def test_tags_normalise_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(tx.tags_normalise("t")).collect()]
    assert got == [",".join(t.strip() for t in v.split(",") if t.strip()) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="ab \n\t", max_size=20), min_size=1, max_size=60))
def test_whitespace_collapse_matches_python(spark, values):
    def py(v):
        v = re.sub(r"\n{3,}", "\n\n", v)
        v = re.sub(r" +", " ", v)
        return v.strip()
    df = spark.createDataFrame([(v,) for v in values], "t string")
    got = [r[0] for r in df.select(tx.whitespace_collapse("t")).collect()]
    assert got == [py(v) for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet="abÉéßçñ019 ,.'-_\n", max_size=40), min_size=1, max_size=40))
def test_tokenise_matches_python_regex(spark, texts):
    import regex
    from pyspark.sql import functions as F

    def py(doc_id, text):
        out = []
        for pos, piece in enumerate(regex.split(tx.TOKEN_SPLIT, text), start=1):
            if "'" in piece:
                piece = regex.sub(r"^'+", "", piece)
                piece = regex.sub(tx.CLITIC, "", piece)
                piece = regex.sub(r"'+$", "", piece)
            if regex.fullmatch(r"\p{L}+", piece):
                out.append((doc_id, pos, piece.lower()))
        return out

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in tx.tokenise(df, "doc_id", "text").select("doc_id", "pos", F.col("token")).collect())
    assert got == sorted(t for i, s in enumerate(texts) for t in py(i, s))


@SETTINGS
@given(st.lists(st.datetimes(min_value=__import__("datetime").datetime(1990, 1, 1),
                             max_value=__import__("datetime").datetime(2030, 12, 31)), min_size=1, max_size=40))
def test_publish_time_forms_round_trip(spark, stamps):
    import datetime as dt
    from pyspark.sql import functions as F
    from newslake.functions import timeparse as tp
    zones = ["PST", "PHT", "UTC", "GMT"]
    rows, expected = [], []
    for i, ts in enumerate(stamps):
        ts = ts.replace(microsecond=0)
        rows += [(ts.strftime("%a, %d %b %Y %H:%M:%S ") + zones[i % 4], None),
                 (ts.isoformat() + "+08:00", None), (None, ts.strftime("%B %-d, %Y"))]
        expected += [ts, ts, dt.datetime(ts.year, ts.month, ts.day)]
    df = spark.createDataFrame(rows, "m string, b string")
    got = [r[0] for r in df.select(tp.publish_time_parse(F.col("m"), F.col("b"))).collect()]
    assert got == expected


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["L1", "L2", "L3"]), st.integers(0, 10_000), st.integers(1, 30)),
                min_size=1, max_size=80, unique_by=lambda r: (r[0], r[1])))
def test_take_while_matches_python(spark, rows):
    import datetime as dt
    from newslake.operators import filters as fl
    data = [(lst, pos, dt.datetime(2024, 1, day)) for lst, pos, day in rows]
    start = dt.datetime(2024, 1, 10)
    expected = set()
    for lst in {r[0] for r in data}:
        for l_, pos, ts in sorted((r for r in data if r[0] == lst), key=lambda r: r[1]):
            if ts < start:
                break
            expected.add((l_, pos))
    df = spark.createDataFrame(data, "listing string, pos int, ts timestamp_ntz")
    got = {(r.listing, r.pos) for r in fl.newest_first_cutoff(df, ["listing"], "pos", "ts", start).collect()}
    assert got == expected
