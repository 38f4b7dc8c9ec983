"""Training-data operators against brute force, exact round trips and held-out rows."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from newslake.llm import (chat, components, embedding_dedup, langid, lm_score, main_text, mixing, pieces, queries, simhash,
                          substring_dedup, topk)

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \t\n", "one", "x " * 3000, "é" * 500, "a\x0bb\x1cc", "日本語 😀 ▁ <0x41>"]


def words(text):
    return (text or "").encode().split()


def odd_docs(spark):
    rows = [(i, t, None if i % 2 else "en", None if i % 3 else "s", None) for i, t in enumerate(ODD)]
    rows += [rows[4], (None, "null id", "en", None, 3)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_repeats(rows, window):
    count = Counter()
    for _, t in rows:
        w = words(t)
        count.update(tuple(w[k:k + window]) for k in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


@pytest.mark.parametrize("window", [5, 8])
def test_substring_dedup_brute_force(spark, window):
    r = random.Random(window)
    passage = [f"p{i}" for i in range(12)]
    rows = []
    for i in range(60):
        w = [r.choice("abcd") for _ in range(r.randrange(0, 40))]
        at = r.randrange(0, len(w) + 1)
        rows.append((i, " ".join(w[:at] + passage[r.randrange(4):] * (i % 3 == 0) + w[at:])))
    rows += [(60, rows[3][1]), (61, None), (62, ""), (62, "q " * 50)]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, id string")
    got = substring_dedup.remove_repeats(df, window=window).select("rest.doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(brute_repeats(rows, window))


def test_substring_dedup_edges(spark):
    assert substring_dedup.remove_repeats(empty(spark)).count() == 0
    got = {(x.rest.doc_id, x.n_removed) for x in substring_dedup.remove_repeats(odd_docs(spark)).collect()}
    assert (4, 3000) in got and len(got) == len(ODD) + 1


def brute_fingerprint(text, n=4):
    w = [x.lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


def test_simhash_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame([(10**6, None), (10**6 + 1, "A b"), (10**6 + 2, "a B"), (10**6 + 3, " ")], "doc_id long, text string"))
    rows = docs.collect()
    fp = {r.doc_id: brute_fingerprint(r.text) for r in rows}
    ids = sorted(fp)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:] if (fp[a] ^ fp[b]).bit_count() <= 4]
    low = brute_components(ids, linked)
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == {i: (fp[i], low[i]) for i in ids}
    assert simhash.simhash_components(empty(spark)).count() == 0


def test_simhash_links_find_every_pair(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(20)]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randrange(0, 6))) for b in base for _ in range(12)} | {0, 1 << 63, (1 << 64) - 1}
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    got = [tuple(x) for x in simhash.links(df, 4).collect()]
    want = {(a, b) for a in map(simhash._signed, fps) for b in map(simhash._signed, fps)
            if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == want


def test_near_copies_with_null_and_repeated_ids(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    rows = [(None, texts[0], "en", "s", 1), (None, texts[1], None, None, None), (7, texts[2], "en", "s", 1),
            (7, texts[2], "en", "s", 1), (7, texts[0], "en", None, 1), (9, texts[2], None, "s", 1), (None, texts[1], None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("row_key", F.lit("x")).withColumn("group", F.lit(1))
    got = simhash.drop_near_copies(docs)
    assert got.dtypes == docs.dtypes
    assert sorted((r[:5] for r in got.collect()), key=str) == sorted([rows[1], rows[2], rows[4]], key=str)
    assert simhash.drop_near_copies(empty(spark)).count() == 0


def test_components_long_path(spark):
    n = 70
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5, 5), (200, 201), (201, 200)], "a long, b long")
    got = {r.node: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 200: 200, 201: 200}


def test_mixing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert rows == mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect() or \
        sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()))
    size = {r.doc_id: len(words(r.text)) for r in docs.collect()}
    assert all(r.size == size[r.doc_id] and 0 <= r.copies <= 2 for r in rows)
    targets = {r.source: (r.source_size, r.target) for r in rows}
    total = sum(s for s, _ in targets.values())
    assert math.isclose(sum(t for _, t in targets.values()), 1.5 * total, rel_tol=1e-9)
    # Water level by plain iteration.
    names = sorted(targets)
    weight = {n: (3, 1, 2)[k % 3] for k, n in enumerate(names)}
    want, open_ = {}, set(names)
    while True:
        left = 1.5 * total - sum(want.values())
        share = {n: left * weight[n] / sum(weight[m] for m in open_) for n in open_}
        over = [n for n in open_ if share[n] > 2 * targets[n][0]]
        if not over:
            want.update(share)
            break
        for n in over:
            want[n] = 2.0 * targets[n][0]
            open_.discard(n)
    assert all(math.isclose(want[n], targets[n][1], rel_tol=1e-9) for n in names)
    odd = mixing.mix(odd_docs(spark)).collect()
    assert len(odd) == len(ODD) + 2 and mixing.mix(empty(spark)).count() == 0
    assert mixing.emit(mixing.mix(odd_docs(spark))).columns == odd_docs(spark).columns


def test_chat_round_trip(spark):
    tricky = ["\\### Assistant: </turn> ok", "\\\\", "###", "</turn>", " </turn>\n### User: x", "", None, "a:b", "\\</turn>\\"]
    rows = [(1, k, ("user", "assistant")[k % 2], t) for k, t in enumerate(tricky)]
    rows += [(2, None, None, "x"), (2, 0, "User", "y"), (2, 0, "a: b", "z"), (None, 1, "user", "n"), (3, 0, "user", "q"), (3, 1, "assistant", "r")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_conversations(df)
    assert all("".join(s.text for s in r.segments) == r.formatted for r in out.collect())
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.trained, r.valid) for r in chat.read_conversations(out).collect()}
    assert got[1][0] == [(r, t or "") for _, _, r, t in rows[:9]]
    assert got[1][1] == "".join(t or "" for _, _, r, t in rows[:9] if r == "assistant")
    assert got[2][0] == [("", "x"), ("User", "y"), ("a: b", "z")] and got[2][2] is False
    assert got[None][0] == [("user", "n")] and got[3] == ([("user", "q"), ("assistant", "r")], "r", True)
    assert chat.format_conversations(df.where("false")).count() == 0


def vectors(spark, extra=()):
    r = np.random.default_rng(3)
    base = r.standard_normal((40, 16))
    rows = [(i, (base[i % 40] + r.standard_normal(16) * 0.08 * (i >= 40)).astype(np.float32).tolist()) for i in range(160)]
    rows += [(200, rows[0][1]), (200, rows[0][1]), (201, None), (202, [0.0] * 16), (203, [float("nan")] * 16), (204, [None] + [1.0] * 15),
             (300, [x * 3 for x in rows[0][1]]), (301, []), (400, [1.0, 2.0])]
    return spark.createDataFrame(rows + list(extra), "vec_id long, embedding array<float>"), rows


def test_embedding_dedup_brute_force(spark):
    df, rows = vectors(spark)
    ok = [k for k, (i, v) in enumerate(rows) if v and None not in v and all(map(math.isfinite, v)) and any(v)]
    unit = {k: np.pad(np.array(rows[k][1], float), (0, 16 - len(rows[k][1]))) for k in ok}
    unit = {k: v / np.linalg.norm(v) for k, v in unit.items()}
    linked = [(a, b) for a in ok for b in ok if a < b and unit[a] @ unit[b] >= 0.95]
    n = Counter(x for p in linked for x in p)
    low = brute_components({r[0] for r in rows}, [(rows[a][0], rows[b][0]) for a, b in linked])
    want = sorted((rows[k][0], n[k], low[rows[k][0]], low[rows[k][0]] == rows[k][0]) for k in range(len(rows)))
    got = sorted(map(tuple, embedding_dedup.near_duplicates(df).collect()))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.97 * len(want)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("length", [1e-200, 1.0, 1e200])
def test_embedding_dedup_of_any_length(spark, length):
    r = np.random.default_rng(11)
    base = r.standard_normal((60, 12))
    unit = np.concatenate([base, base + r.standard_normal((60, 12)) * 0.02])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, (v * length).tolist()) for i, v in enumerate(unit)], "vec_id long, embedding array<double>") \
        .selectExpr("*", "1 AS rep", "2 AS copies", "3 AS keys", "4 AS v", "5 AS norm")
    want = ((unit @ unit.T >= 0.95).sum(1) - 1).tolist()
    assert [x.n_links for x in embedding_dedup.near_duplicates(df).sort("vec_id").collect()] == want


def test_embedding_dedup_finds_links_at_the_threshold(spark):
    r = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    found, planted = Counter(), Counter()
    a = unit(r.standard_normal((3000, 64)))
    side = r.standard_normal(a.shape)
    side = unit(side - (side * a).sum(1, keepdims=True) * a)
    c = r.uniform(0.9501, 0.97, (3000, 1))
    b = c * a + np.sqrt(1 - c * c) * side
    rows = [(2 * k + j, x.tolist()) for k in range(3000) for j, x in enumerate((a[k], b[k]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    # No two bases come near 0.95, so every link is a planted one.
    assert np.sort(a @ a.T, axis=1)[:, -2].max() < 0.8
    for x in embedding_dedup.near_duplicates(df, 0.95).where("vec_id % 2 = 0").collect():
        at = c[x.vec_id // 2, 0] >= 0.955
        planted[at] += 1
        found[at] += x.n_links
    print({("0.955-0.97" if at else "0.95-0.955"): (found[at], planted[at]) for at in planted})
    assert found[False] >= 0.985 * planted[False] and found[True] >= 0.995 * planted[True]


def brute_top_k(rows, k=10):
    most = topk.MOST
    ok = [(i, [max(-most, min(most, math.floor(1024 * float(x)))) for x in v] if v else []) for i, v in rows
          if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for q, x in ok:
        if q % 100 == 0:
            best = sorted((-max(-most, min(most, sum(a * b for a, b in zip(x, y)))), i) for i, y in ok if i != q)[:k]
            want += [(q, p + 1, i, -s) for p, (s, i) in enumerate(best)]
    return sorted(want)


def test_top_k_brute_force(spark):
    df, rows = vectors(spark, [(500, [5e30] * 16)])
    rows = rows + [(500, [5e30] * 16)]
    got = topk.exact_top_k(df, df.where("vec_id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows)
    assert topk.exact_top_k(df.where("false"), df.where("false")).count() == 0
    assert topk.exact_top_k(df, df.where("false")).count() == topk.exact_top_k(df.where("false"), df).count() == 0


def test_top_k_repeated_rows_and_clashing_names(spark):
    r = np.random.default_rng(4)
    rows = [(i % 150, r.standard_normal(6).tolist()) for i in range(320)]  # ids repeat with other vectors
    rows += [rows[0]] * 40 + [rows[7]] * 40 + [(None, [1.0] * 6), (100, []), (200, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>") \
        .selectExpr("*", "1 AS id", "2 AS v", "3 AS part", "4 AS block", "5 AS score", "6 AS copies")
    got = sorted(map(tuple, topk.exact_top_k(df, df.where("vec_id % 100 = 0")).collect()))
    assert got == brute_top_k(rows)


def test_top_k_with_large_components_equals_sql(spark):
    one = spark.createDataFrame([(0, [1.0]), (1, [200000.0]), (2, [300000.0])], "vec_id long, embedding array<double>")
    got = topk.exact_top_k(one, one.where("vec_id = 0"), k=2).collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, 1024 * 307200000), (1, 1024 * 204800000)]
    r = np.random.default_rng(5)
    rows = [(i, (r.standard_normal(8) * 10.0 ** r.integers(-2, 6)).tolist()) for i in range(300)]  # scores below 2^62
    embeddings = pd.DataFrame(rows, columns=["vec_id", "embedding"])
    con = duckdb.connect()
    con.register("embeddings", embeddings)
    want = con.execute(queries.ORACLE["op8_exact_top_k"]).fetch_df()[["query_id", "rank", "vec_id", "score"]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.exact_top_k(df, df.where("vec_id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == sorted(want.itertuples(index=False, name=None)) == brute_top_k(rows)


def test_top_k_search_stops_on_proof_and_reads_less():
    r = np.random.default_rng(6)
    m = np.floor(1024 * r.standard_normal((4000, 48)) / 7).astype(np.int64)
    m[7] = m[11] = 0  # of a query of zeros all scores are equal
    ids = np.arange(4000) // 2 * 2  # every id twice
    index = topk.ImpactIndex(ids, m, np.ones(4000, np.int64))
    for i in range(60):
        score = m @ m[i]
        order = np.lexsort((ids, -score))
        order = order[ids[order] != ids[i]][:10]
        got, scores = index.search(m[i], 10, int(ids[i]))
        assert got.tolist() == ids[order].tolist() and scores.tolist() == score[order].tolist()
        floor = int(score[order[4]])  # known from another block: what is below it is not asked for
        assert index.search(m[i], 10, int(ids[i]), floor)[1].tolist() == [x for x in score[order] if x >= floor]
    assert index.taken < 0.8 * 120 * m.size and index.scored < 0.25 * 120 * len(m)


@pytest.mark.parametrize("factor", [1, 2 ** 20, 2 ** 34, 2 ** 52])
def test_top_k_best_scores_carry_over_blocks(spark, monkeypatch, factor):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    r = np.random.default_rng(7)
    rows = [(i, (r.integers(-2, 3, 5) * float(factor)).tolist()) for i in range(0, 6000, 20)]  # few values: many scores are equal
    rows += rows[:30] + [(200, [float(factor)] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = topk.exact_top_k(df, df.where("vec_id % 100 = 0")).collect()
    assert sorted(map(tuple, got)) == brute_top_k(rows)


def test_language_parse_against_naive():
    sample = langid.Sample("abc", (("x", "abcab cab"), ("y", "ccc aab")))
    p = langid.CrossParser(sample)
    r = random.Random(2)
    for _ in range(60):
        t = "".join(r.choice("abcd ") for _ in range(r.randrange(1, 60)))
        s = p.symbols(t)
        known = {"a": 2, "b": 3, "c": 4, " ": 0}
        for k, (_, text) in enumerate(sample.texts):
            hay = bytes(known[c] for c in text)
            n = at = 0
            while at < len(s):
                end = at + 1
                while end < len(s) and bytes(s[at:end + 1]) in hay:
                    end += 1
                n, at = n + 1, end
            assert p.phrases([s])[k, 0] == n


def test_language_id(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op6_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got) and all(0 <= r.score <= 1 for r in got)
    odd = odd_docs(spark)
    sample = langid.learn(odd, F.lit(True))
    out = {r.doc_id: r.language_id.lang for r in langid.predict_language(odd, sample).collect()}
    assert out[0] == out[1] == out[2] == langid.UND and out[3] == "en"
    assert langid.predict_language(empty(spark), langid.learn(empty(spark), F.lit(True))).count() == 0


def test_sample_of_repeated_ids_and_no_labels(spark):
    rows = [(1, "same words here", "en", None, 0)] * 500 + [(1, f"other {chr(97 + i % 26) * (i // 26 + 1)}", "de", None, 0) for i in range(200)]
    df = spark.createDataFrame(rows, DOCS)
    texts = dict(langid.learn(df, F.lit(True)).texts)
    assert texts["en"] == "same words here" and texts["de"].count("other") == langid.SAMPLE_DOCS
    bare = spark.createDataFrame([(1, "zwei Worte", None, "s", 1), (2, " 12 ", None, "s", 1), (3, None, None, "s", 1), (4, "日本", None, None, 1)], DOCS)
    assert langid.learn(bare, F.lit(True)) == langid.Sample("", ())
    assert sorted(r.doc_id for r in corpus_pipeline.identify_language(spark, bare, SF).collect()) == [1, 4]


def test_piece_lattice_draws_by_weight():
    v = pieces.read_vocabulary()
    n = 20000
    ids, counts = pieces.Lattice(v).sample(["hello"] * n, np.random.default_rng(0).integers(-2**62, 2**62, n))
    ends = np.cumsum(counts)
    seen = Counter(tuple(ids[e - k:e].tolist()) for e, k in zip(ends, counts))

    def ways(t):
        if not t:
            return [((), 1.0)]
        return [((v.pieces[t[:k]],) + w, math.exp(v.weights[t[:k]]) * p) for k in range(1, len(t) + 1) if t[:k] in v.pieces
                for w, p in ways(t[k:])]
    every = ways("hello")
    mass = sum(p for _, p in every)
    assert set(seen) <= {w for w, _ in every}
    assert all(abs(seen[w] / n - p / mass) < 0.012 for w, p in every)


def test_piece_round_trip(spark):
    v = pieces.read_vocabulary()
    odd = odd_docs(spark)
    got = pieces.encode(odd, v, decoded=True).collect()
    assert all(r.decoded == r.text and (r.ids is None) == (r.text is None) for r in got) and len(got) == len(ODD) + 2
    assert sorted(map(str, got)) == sorted(map(str, pieces.encode(odd.repartition(3), v, decoded=True).collect()))
    assert pieces.encode(empty(spark), v).count() == 0
    back = pieces.decode(pieces.encode(odd, v).select("ids", F.col("text").alias("was")), v).collect()
    assert all(r.text == r.was for r in back)


PAGE = ("<html><head><title>t</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><a>menu</a></nav>"
        "<div class='cookie-notice'>we use</div>{body}<aside>side</aside><div id='comments'>c</div><footer>&copy; f</footer></body></html>")


def page(body):
    return PAGE.replace("{body}", body)


def test_main_text(spark):
    article = "<article><h1>A &amp; B</h1><p><b>x  y<br><p>same line</p><form>f</form></article>"
    rows = [(1, "http://h/a/1", page(article)), (2, "http://h/a/2", page(article.replace("x", "z"))),
            (3, "http://h/b/1", page("<div>Our site</div><p>first only</p>")), (4, "http://h/b/2", page("<div>Our site</div><p>second only</p>")),
            (5, None, None), (6, "", ""), (7, "http://lone/", "<p>a &lt;b&gt;<p>c"), (8, "http://h/a/1", page(article)), (9, "x", "<p>" * 3000 + "deep")]
    df = spark.createDataFrame([r + ("t",) for r in rows], "page_id long, url string, html string, text string")
    got = {r.rest.page_id: r.text for r in main_text.extract(df).collect()}
    assert got[1] == got[8] == "A & B\nx y\nsame line" and got[2] == "A & B\nz y\nsame line"
    assert got[3] == "first only" and got[4] == "second only"
    assert got[5] == got[6] == "" and got[7] == "a <b>\nc" and got[9] == "deep"
    assert main_text.extract(df.where("false")).count() == 0


def test_common_lines_is_longest():
    r = random.Random(5)
    for held in (1 << 28, 4):
        main_text.HELD_BITS, keep = held, main_text.HELD_BITS
        try:
            for _ in range(150):
                a, b = ([r.choice("abcd") for _ in range(r.randrange(12))] for _ in range(2))
                t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
                for i in range(len(a)):
                    for j in range(len(b)):
                        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
                got = main_text.common_lines(a, b)
                it = iter(b)
                assert len(got) == t[-1][-1] and all(a[i] in it for i in got)
        finally:
            main_text.HELD_BITS = keep


def test_pages_of_the_table(spark):
    """The tables' pages hold one article each: its blocks by a plain cut."""
    import html
    import re
    got = {r.page_id: r.text for r in queries.op10_html_main_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1|h2|ul|li|div|table|tr|td)\b[^>]*>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)


def test_lm_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    flat = lm_score.learn(docs)
    p = lm_score.views(flat)
    text = docs.where("length(text) between 300 and 900").first().text
    codes = lm_score.codes_of(text)
    naive = 0.0
    for i, c in enumerate(codes):
        h = p["shift"].astype(float)
        for k, o in enumerate(lm_score._OFFSETS):
            j = i + o
            h = h + p["context"][k][codes[j] if 0 <= j < len(codes) else lm_score.PAD]
        h = np.tanh(h)
        for logits, d in ((h @ p["first"] + p["first_b"], c // 64), (h @ p["second"] + p["second_b"][c // 64], c % 64)):
            naive += logits[d] - np.log(np.exp(logits - logits.max()).sum()) - logits.max()
    one = lm_score.score(spark.createDataFrame([(1, text)], "doc_id long, text string"), flat).first()
    assert one.n_tokens == len(codes) and math.isclose(one.log_likelihood, naive, rel_tol=1e-4)
    junk = " ".join(hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(200))
    bad = lm_score.score(spark.createDataFrame([(1, junk)], "doc_id long, text string"), flat).first()
    assert bad.score < one.score
    odd = {r.rest.doc_id: r for r in lm_score.score(odd_docs(spark), lm_score.learn(odd_docs(spark))).collect()}
    assert odd[0].n_tokens == odd[1].n_tokens == 0 and odd[0].score is None and odd[4].n_tokens == 3000
    assert lm_score.score(empty(spark), lm_score.learn(empty(spark))).count() == 0


def test_lm_score_learns_from_all_partitions(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").orderBy("doc_id").collect()
    held = lm_score.lay_out([lm_score.codes_of(r.text) for r in rows[:100]])[:2]
    mean = lambda flat: lm_score.log_chances(lm_score.views(flat), *held).mean()
    # Partitions of one size, more and more of them.
    got = []
    for parts in (1, 3, 9):
        texts = spark.sparkContext.parallelize([(r.text,) for r in rows[100:100 + 100 * parts]], parts).toDF("text string")
        start = lm_score.fresh(lm_score.corpus_counts(texts))
        got.append(mean(lm_score.learn(texts)) - mean(start))
    assert 0 < got[0] < got[1] < got[2] and got[2] > 8 * got[0]
    # The same texts in more partitions: still above the start.
    texts = spark.sparkContext.parallelize([(r.text,) for r in rows[100:]], 18).toDF("text string")
    assert mean(lm_score.learn(texts)) > mean(lm_score.fresh(lm_score.corpus_counts(texts)))


def test_lm_score_moves_by_what_all_texts_say(spark):
    """No text of these is among the 64th, by hash, that used to pick a round's move."""
    words = [f"w{i}" for i in range(40)]
    all_texts = [" ".join(words[(i * k) % 40] for k in range(60)) for i in range(300)]
    texts = spark.createDataFrame([(t,) for t in all_texts], "text string").where("pmod(xxhash64(text), 64) != 0")
    parts = [[r.text for r in texts.collect()][i::4] for i in range(4)]
    texts = spark.sparkContext.parallelize(parts, 4).flatMap(lambda x: [(t,) for t in x]).toDF("text string")
    start = lm_score.fresh(lm_score.corpus_counts(texts))
    move, tokens = np.zeros(lm_score.SIZE), 0
    for part in parts:
        own = start.copy()
        line, place, _ = lm_score.lay_out([lm_score.codes_of(t) for t in part])
        lm_score.train(own, np.full(lm_score.SIZE, 1e-4, np.float32), line, place)
        move, tokens = move + (own - start).astype(float) * len(place), tokens + len(place)
    got = lm_score.train_round(texts, start) - start
    along = move / tokens
    assert math.isclose(float(got @ along / (along @ along)), 2.0, rel_tol=1e-2)
    assert lm_score.reach_of(32, 1000) == 1 and lm_score.reach_of(1, 3) == 1 and lm_score.reach_of(1000, 64) == 2
    assert [list(np.frombuffer(r.codes, "<u2")) for r in lm_score.coded(texts).limit(1).collect()] == [list(lm_score.codes_of(parts[0][0]))]


def test_gradient():
    r = np.random.default_rng(0)
    codes = [r.integers(0, lm_score.CODES, 30)]
    line, place, _ = lm_score.lay_out(codes)
    flat = lm_score.fresh(np.ones(lm_score.CODES))
    before = lm_score.log_chances(lm_score.views(flat), line, place).sum()
    seen = np.full(lm_score.SIZE, 1e-4, np.float32)
    for _ in range(5):
        lm_score.train(flat, seen, line, place)
    assert lm_score.log_chances(lm_score.views(flat), line, place).sum() > before


def test_oracles(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")

    def plain(v):
        return float(f"{v:.9g}") if isinstance(v, float) else v

    for name, sql in queries.ORACLE.items():
        df = queries.QUERIES[name](spark, sf)
        cols = sorted(df.columns)
        rel = con.sql(sql)
        at = [rel.columns.index(c) for c in cols]
        got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr), name


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF).cache()
        assert now.dtypes == docs.dtypes, name
        if name == "simhash_near_dedup":
            keep = now.collect()
            assert len({r.doc_id for r in keep}) == len(keep)
            fp = sorted(brute_fingerprint(r.text) for r in keep)
            assert min((a ^ b).bit_count() for i, a in enumerate(fp) for b in fp[i + 1:]) > 4
        if name == "substring_dedup":
            brute = {i: (n, g, t) for i, n, g, t in brute_repeats([(r.doc_id, r.text) for r in keep], 35)}
            was = {r.doc_id: r.text for r in keep}
            assert {r.doc_id: r.text for r in now.collect()} == {i: t if g else was[i] for i, (n, g, t) in brute.items() if g < n or not n}
    last = corpus_pipeline.STAGES[-1][1](spark, now, SF)
    v = pieces.read_vocabulary()
    want = Counter((r.doc_id, r.text) for r in now.collect())
    assert Counter((r.doc_id, pieces.decode_ids(r.ids, v)) for r in last.collect()) == want
    assert corpus_pipeline.run(spark, SF).count() == sum(want.values())
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0
        assert stage(spark, odd_docs(spark), SF).count() >= 0
