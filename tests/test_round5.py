"""Cases of the third round's findings, third session."""

import itertools
import json
import random

import numpy as np
from pyspark.sql import functions as F

from newslake.functions.text import strip_ws, whitespace_collapse
from newslake.llm import lm_score, queries
from newslake.operators.html import html_clean_text
from newslake.operators.pageparse import page_of
from newslake.session import shared_path
from newslake.sources import listings as ls


def test_a_listing_record_is_parsed_once_a_use(spark):
    def rows(v):
        return spark.createDataFrame([(1, json.dumps(v))], "page long, value string")

    a = ls.norm_listing_detail(rows({"listItem": [{"_id": 1, "slugline_url": "x"}]}), rows({"_id": 1, "data": {"body_html": "<p>b</p>"}}))
    b = ls.norm_sectioned(rows({"response": "success", "data": [{"cms_article_id": 1, "publish_time": "2024-01-01 00:00:00"}]}),
                          rows({"response": "success", "data": {"cms_article_id": 1, "body": "<p>b</p>"}}))
    c = ls.norm_nested_posts(rows([{"id": 1, "content": {"rendered": "<p>b</p>"}}]), spark.createDataFrame([(1, "t")], "id long, slug string"))
    for df, parses in ((a, 2), (b, 2), (c, 2)):
        assert df._jdf.queryExecution().executedPlan().toString().count("from_json(") == parses
        assert [r.content for r in df.collect()] == ["b"]


def test_whitespace_as_the_plain_patterns_do(spark):
    r = random.Random(8)
    odd = [" ", " ", "\n", "\n", "\n", "\t", "\x0b", "\u0085", " ", " ", "é", "ab"]
    texts = ["".join(t) for n in range(4) for t in itertools.product([" ", "\n", " ", "a"], repeat=n)]
    texts += ["".join(r.choice(odd) for _ in range(r.randrange(4, 15))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    edge = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")                     # noqa: E731
    plain = edge(F.regexp_replace(F.regexp_replace("t", r"\n{3,}", "\n\n"), " +", " "))
    assert df.where(~strip_ws("t").eqNullSafe(edge(F.col("t"))) | ~whitespace_collapse("t").eqNullSafe(plain)).count() == 0


def test_blanks_of_a_text_are_one_space():
    got = [p["text"] for p in page_of("<p>a \t\r\n\f b  c  d\x0b e</p>", "page").pieces]
    assert got == ["a b c  d\x0b e"]


def test_spaces_around_breaks_go(spark):
    df = spark.createDataFrame([("<p>a <br> b<br>c </p> <p> d</p>",), (None,)], "h string")
    assert [r.t for r in html_clean_text(df, "h", "t").collect()] == ["a\nb\nc\n\nd", None]


def test_lm_score_cuts_a_text_into_words_once(spark, monkeypatch):
    root = shared_path(spark, "t_lm_once")
    words = [f"w{i}" for i in range(50)]
    docs = spark.createDataFrame([(i, " ".join(words[(i * k) % 50] for k in range(40))) for i in range(30)] + [(90, None), (91, "")], "doc_id long, text string")
    docs.coalesce(1).write.parquet(root + "/documents.parquet")
    got = queries.op2_lm_score(spark, root)
    assert "documents.parquet" not in "".join(got.inputFiles())             # the last pass reads codes
    want = lm_score.score(docs.coalesce(1), lm_score.learn(docs.coalesce(1))).select("rest.doc_id", "n_tokens", "log_likelihood", "score")
    got, want = ({r.doc_id: r for r in df.collect()} for df in (got, want))
    assert set(got) == set(want) and got[90].score is None and got[91].n_tokens == 0
    assert all(got[i].n_tokens == want[i].n_tokens and np.isclose(got[i].log_likelihood, want[i].log_likelihood) for i in want)
