"""Registered queries of the training-data operators, one per operator.

Each reads its whole table.  ``ORACLE`` holds the DuckDB twin where SQL can
express the result; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.llm import chat, clustering, embedding_dedup, langid, lm_score, main_text, mixing, pieces, prefix_trie, secret_scan, simhash, substring_dedup, topk
from newslake.llm.common import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left in every document after removing each repeated run of 35 words."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, window=35).select(
        "rest.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo log likelihood of every document under a network trained on all of them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = materialise(lm_score.coded_rows(docs), "lm_codes")
    return lm_score.score_coded(rows, lm_score.learn_coded(rows)).select("rest.doc_id", "n_tokens", "log_likelihood", "score")


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document, its source's words and target, and the words the mix takes."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("row.doc_id", "size", "source_size", "target",
                                   (F.col("size") * F.col("copies")).alias("taken"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and -7 whose texts hold control strings, formatted and read back."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    back = chat.read_conversations(chat.format_conversations(rows.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keeper of every vector at cosine 0.95."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return embedding_dedup.near_duplicates(vectors, 0.95).select("vec_id", "n_links", "component_id", "kept")


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text.extract(pages).select("rest.page_id", "rest.url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector among all others."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.exact_top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10, scale=1024)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; a third by id hash is never learned from."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    sample = langid.learn(docs, rest != 1)
    return langid.predict_language(docs.select("doc_id", "text"), sample).select(
        "doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), F.col("language_id.lang").alias("lang_pred"),
        F.col("language_id.score").alias("score"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every document as a digest (4 bytes an id, little end
    first), their number, and whether they decode to the text itself."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode(docs, pieces.read_vocabulary(), decoded=True, digest=True).select(
        "rest.doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids_sha256",
        F.sha2("decoded", 256).alias("decoded_sha256"), F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 4-word shingles, 4 bits."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.simhash_components(docs, shingle=4, max_bits=4).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all conversations, each rebuilt to start like every fifth one."""
    keys = prefix_trie.conversation_keys(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    c = F.col("conv_id")
    return prefix_trie.trie(prefix_trie.spliced(keys, c - c % 5, F.crc32(c.cast("string")) % 9))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all vectors after ten rounds."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return clustering.cluster(vectors, k=8, rounds=10, dimensions=64, scale=1024, seed=3).select(
        "rest.vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        clustering.centroid_digest(F.col("centroid")).alias("centroid_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [secret_scan.count_kind(F.col("base"), p.kind).alias(f"n_{p.kind}") for p in secret_scan.PATTERNS]
    return found.select("rest.doc_id", *kinds, F.sha2(secret_scan.span_list(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.span_list(F.array_sort(F.concat("base", "added"))).alias("spans"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_lm_score, op3_mix_sources, op4_chat_format,
                                  op5_embedding_near_dedup, op6_language_id, op7_simhash_near_dedup,
                                  op8_exact_top_k, op9_sentencepiece, op10_html_main_text,
                                  op11_conversation_trie, op12_centroid_clustering, op13_secret_scan)}

ORACLE = {
    "op1_substring_dedup": r"""
        WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        r AS (SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS run
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
        again AS (SELECT run FROM r GROUP BY run HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM r JOIN again USING (run)),
        p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
        k AS (SELECT p.doc_id, count(gone.p) AS n_removed,
                     string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY p.p) AS kept
              FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.p = gone.p GROUP BY p.doc_id)
        SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id
    """,
    "op3_mix_sources": r"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                          coalesce(doc_id::VARCHAR, '') || '/' || coalesce(md5(text), '') || '/' AS k FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
        w AS (SELECT *, [3, 1, 2][(place - 1) % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
        o AS (SELECT *, cap / weight AS reach, row_number() OVER (ORDER BY cap / weight, place) AS turn FROM w),
        l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                         - coalesce(sum(cap) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                        / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM o),
        t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, turn) FROM l WHERE level <= reach) * weight, cap)) AS target FROM l),
        r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
        u AS (SELECT d.doc_id, d.source, d.size, source_size, target, rate, n,
                     ('0x' || md5(k || (n // 4)::VARCHAR)[1 + 8 * (n % 4):8 + 8 * (n % 4)])::BIGINT / 4294967296.0::DOUBLE AS u
              FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, range(16) AS g(n)),
        c AS (SELECT *, floor(rate) + (u < rate - floor(rate))::INT AS copies FROM u),
        x AS (SELECT source, n, abs(sum(size * copies) - any_value(target)) AS off FROM c GROUP BY source, n),
        b AS (SELECT source, arg_min(n, (off, n)) AS n FROM x GROUP BY source)
        SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken
        FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source AND c.n = b.n
    """,
    "op4_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
        e AS (SELECT *, regexp_replace(text, '\\|###|</turn>', '\\\0', 'g') AS esc FROM c)
        SELECT conv_id, count(*)::BIGINT AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
               sum(4 + length(role) + 2 + length(esc) + 9)::BIGINT AS formatted_chars,
               coalesce(regexp_full_match(string_agg(CASE role WHEN 'assistant' THEN 'a' WHEN 'user' THEN 'u' WHEN 'system' THEN 's'
                   WHEN 'tool' THEN 't' ELSE 'x' END, '' ORDER BY turn, role, text), 's?(ua)(ua|t+a)*'), false) AS valid
        FROM e GROUP BY conv_id
    """,
    "op11_conversation_trie": r"""
        WITH t AS (SELECT conv_id, coalesce(turn, -9223372036854775808) AS o, turn IS NOT NULL AS late, coalesce(role, '') AS r, coalesce(text, '') AS x
                   FROM conversations WHERE conv_id IS NOT NULL),
        c AS (SELECT conv_id AS c, list({'k': md5(length(r)::VARCHAR || ':' || r || x), 'b': strlen(x)} ORDER BY late, o, r, md5(length(r)::VARCHAR || ':' || r || x)) AS w
              FROM t GROUP BY conv_id),
        h AS (SELECT c, w, c - c % 5 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten([[ascii(z), 0, 0, 0, 0, 0, 0, 0]::BIGINT[] FOR z IN string_split(c::VARCHAR, '')])),
                     LAMBDA x, y: xor(xor(x, y) >> 1, CASE WHEN xor(x, y) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 9 AS h FROM c),
        m AS MATERIALIZED (SELECT h.c, coalesce(b.w[1:h], []) || h.w[h + 1:] AS w FROM h LEFT JOIN c AS b ON b.c = h.base),
        p AS MATERIALIZED (SELECT c, w, len(w) AS n, unnest(range(0, len(w) + 1)) AS depth FROM m),
        q AS MATERIALIZED (SELECT c, n, depth, md5(array_to_string([x.k FOR x IN w[1:depth]], '')) AS k,
                     CASE WHEN depth > 0 THEN md5(array_to_string([x.k FOR x IN w[1:depth - 1]], '')) END AS pk,
                     [md5(array_to_string([x.k FOR x IN w[1:d]], '')) FOR d IN range(0, depth + 1)] AS path,
                     CASE WHEN depth > 0 THEN w[depth].b ELSE 0 END AS b FROM p),
        g AS MATERIALIZED (SELECT k, any_value(pk) AS pk, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(b) AS b, any_value(path) AS path,
                     coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = depth), '') AS ends FROM q GROUP BY k),
        d AS (SELECT pk AS k, count(*) AS n FROM g GROUP BY pk),
        u AS (SELECT unnest(g.path) AS k, (coalesce(d.n, 0) = 0)::INT AS leaf, (g.n_convs - 1) * g.b AS saved FROM g LEFT JOIN d ON d.k = g.k),
        s AS (SELECT k, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM u GROUP BY k)
        SELECT g.conv_id, g.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, g.n_convs, coalesce(d.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, sha256(g.ends) AS ends_sha256
        FROM g JOIN s ON s.k = g.k LEFT JOIN d ON d.k = g.k LEFT JOIN g AS a ON a.k = g.pk
    """,
    "op8_exact_top_k": r"""
        WITH v AS (SELECT vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        s AS (SELECT q.vec_id AS query_id, v.vec_id,
                     list_sum([p[1] * p[2] FOR p IN list_zip(q.e, v.e)])::BIGINT AS score
              FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op5_embedding_near_dedup": r"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
                     AND len([x FOR x IN embedding IF x <> 0]) > 0),
        l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
              ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
        r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
               vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
    """,
}


def _lloyd_sql(k: int, rounds: int) -> str:
    """Plain rounds, one pair of steps after another."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
        d{t} AS MATERIALIZED (SELECT v.i, v.vec_id, v.e, c.j, list_sum([(p[1] - p[2]) * (p[1] - p[2]) FOR p IN list_zip(v.e, c.e)])::BIGINT AS d
               FROM v, c{t} AS c),
        a{t} AS MATERIALIZED (SELECT i, arg_min(vec_id, (d, j)) AS vec_id, any_value(e) AS e, arg_min(j, (d, j)) AS j, min(d) AS d FROM d{t} GROUP BY i)""")
        if t < rounds:
            steps.append(f"""
        s{t} AS (SELECT j, p, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(e) AS x, generate_subscripts(e, 1) AS p FROM a{t}) GROUP BY j, p),
        m{t} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY p) AS e FROM s{t} GROUP BY j),
        c{t + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.e, c.e) AS e FROM c{t} AS c LEFT JOIN m{t} AS m ON c.j = m.j)""")
    return f"""
        WITH v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
                   WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), e) - 1 AS j, e FROM v
               QUALIFY j < {k}), {','.join(steps)}
        SELECT vec_id, a.j::INT AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} AS a JOIN c{rounds} AS c ON a.j = c.j
    """


ORACLE["op12_centroid_clustering"] = _lloyd_sql(8, 10)


def _secrets_sql(fdr: float = 0.05, alpha: float = 0.001) -> str:
    """Places by running lengths, characters of the tokens as rows, the battery by groups."""
    quoted = lambda s: "'" + s.replace("'", "''") + "'"          # noqa: E731
    values = ", ".join(f"({i}, '^{e.only}$', '{e.alphabet}', '{e.levels()}', {len(e.alphabet)}, {e.moments()[0]!r}::DOUBLE, {e.moments()[1]!r}::DOUBLE, {e.coincidence}::DOUBLE)"
                       for i, e in enumerate(secret_scan.ENCODINGS))
    kinds = " UNION ALL ".join(
        f"""SELECT r, {i} AS place, '{p.kind}' AS kind, {p.least} AS least, unnest(regexp_extract_all(t, {quoted(p.regex)}, {p.group})) AS token,
                   unnest(regexp_extract_all(t, {quoted(p.regex)})) AS whole, unnest(string_split_regex(t, {quoted(p.regex)})[1:len(regexp_extract_all(t, {quoted(p.regex)}))]) AS gap,
                   generate_subscripts(regexp_extract_all(t, {quoted(p.regex)}), 1) AS i FROM d"""
        for i, p in enumerate((*secret_scan.PATTERNS, secret_scan.Pattern("random", secret_scan.CANDIDATE, 0, 0))))
    return f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        m AS MATERIALIZED (SELECT *, (sum(length(gap) + length(whole)) OVER (PARTITION BY r, place ORDER BY i))::BIGINT AS e FROM ({kinds})),
        f AS (SELECT r, place, kind, e - length(whole) AS s, e, token FROM m WHERE length(token) >= least),
        enc(eno, rx, abc, lev, k, mean, var, ic) AS (VALUES {values}),
        c AS MATERIALIZED (SELECT r, s, e, arg_min(x, eno) AS x, min(eno) AS eno FROM (SELECT r, s, e, rtrim(token, '=') AS x FROM f WHERE place = 3) JOIN enc ON regexp_matches(x, rx)
              WHERE regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') GROUP BY r, s, e),
        z AS MATERIALIZED (SELECT r, s, e, c.eno, p, ch, lev[strpos(abc, ch)]::INT AS q FROM
              (SELECT *, unnest(string_split(x, '')) AS ch, unnest(range(1, length(x) + 1)) AS p FROM c) AS c JOIN enc ON enc.eno = c.eno),
        y AS (SELECT *, lag(q) OVER (PARTITION BY r, s ORDER BY p) AS o FROM z),
        w1 AS (SELECT r, s, eno, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS sq FROM (SELECT r, s, eno, ch, count(*) AS n FROM z GROUP BY ALL) GROUP BY ALL),
        w2 AS (SELECT r, s, 1 + sum(((q >= 2) <> (o >= 2))::INT) AS runs, sum((q - mean) * (o - mean)) / any_value(var) AS serial FROM y JOIN enc USING (eno) GROUP BY r, s),
        w AS (SELECT w1.r, w1.s, n, k, k * sq / n - n AS chi2, runs, serial, (n - 1) * (k * ic - 1) AS shift FROM w1 JOIN w2 ON w1.r = w2.r AND w1.s = w2.s JOIN enc USING (eno)),
        v AS (SELECT r, s, n, (chi2 - (k - 1)) / sqrt(2 * (k - 1) * (1 - 1 / n)) AS z1, (runs - (1 + (n - 1) / 2)) / (sqrt(n - 1) / 2) AS z2, serial / sqrt(n - 1) AS z3,
                     (chi2 - (k - 1) - shift) / sqrt(2 * (k - 1) + 4 * shift) AS below FROM w),
        b AS MATERIALIZED (SELECT r, s, least(1, 3 * least(CASE WHEN z1 > 0 THEN exp(-z1 * z1 / 2) ELSE 1 END, exp(-z2 * z2 / 2), exp(-z3 * z3 / 2))) AS p,
                     least({secret_scan.LAST_BIN}, floor({secret_scan.BINS} * CASE WHEN below < 0 THEN below * below / 2 + ln(2) ELSE 0 END)) AS bin, floor(log2(n)) AS class FROM v),
        l AS (SELECT class, bin, count(*) OVER (PARTITION BY class ORDER BY bin DESC) AS beyond, count(*) OVER (PARTITION BY class) AS n FROM b),
        h AS (SELECT class, min(bin) AS bin FROM l WHERE exp(-bin / {secret_scan.BINS}) <= {fdr} * beyond / n GROUP BY class),
        g AS (SELECT r, place, kind, s, e FROM f WHERE place < 3
              UNION ALL SELECT c.r, 3, 'random', c.s, c.e FROM c JOIN b ON b.r = c.r AND b.s = c.s JOIN h ON h.class = b.class AND b.bin >= h.bin WHERE b.p >= {alpha}),
        a AS (SELECT r, count(*) FILTER (WHERE place = 0) AS n0, count(*) FILTER (WHERE place = 1) AS n1, count(*) FILTER (WHERE place = 2) AS n2,
                     string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (WHERE place < 3) AS base,
                     string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans FROM g GROUP BY r)
        SELECT doc_id, coalesce(n0, 0)::BIGINT AS n_assign, coalesce(n1, 0)::BIGINT AS n_access, coalesce(n2, 0)::BIGINT AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN a ON a.r = d.r
    """


ORACLE["op13_secret_scan"] = _secrets_sql()
