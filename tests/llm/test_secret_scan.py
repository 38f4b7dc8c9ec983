"""Secret scans against Python's re and a plain battery."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from newslake.llm import secret_scan as ss

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
RX = [("assign", re.compile(r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
      ("access", re.compile("AKIA[A-Z0-9]+"), 0, 18), ("hex", re.compile("[0-9a-f]+"), 0, 16)]


def base(text):
    out = [(m.start(), i, kind, m.end()) for i, (kind, rx, g, least) in enumerate(RX) for m in rx.finditer(text or "") if len(m[g]) >= least]
    return sorted(out)


def battery(body):
    e = next(e for e in ss.ENCODINGS if re.fullmatch(e.only, body))
    n, k, v = len(body), len(e.alphabet), [e.alphabet.index(c) for c in body]
    half = k // 2
    q = [2 * (x >= half) + ((x % half) * 2 >= half) for x in v]
    every = [2 * (x >= half) + ((x % half) * 2 >= half) for x in range(k)]
    mean = sum(every) / k
    var = sum((x - mean) ** 2 for x in every) / k
    chi = k * sum(c * c for c in Counter(body).values()) / n - n
    runs = 1 + sum((a >= half) != (b >= half) for a, b in zip(v, v[1:]))
    serial = sum((a - mean) * (b - mean) for a, b in zip(q, q[1:])) / var
    z = [max(0, (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n))), (runs - (n + 1) / 2) / (math.sqrt(n - 1) / 2), serial / math.sqrt(n - 1)]
    p = min(1, 3 * min(math.exp(-x * x / 2) for x in z))
    shift = (n - 1) * (k * e.coincidence - 1)
    below = (chi - (k - 1) - shift) / math.sqrt(2 * (k - 1) + 4 * shift)
    return p, min(4000, math.floor(4 * (below * below / 2 + math.log(2)))) if below < 0 else 0, int(math.log2(n))


def added(texts, fdr=0.05, alpha=0.001):
    tests = []
    for d, text in enumerate(texts):
        for m in re.finditer(r"[A-Za-z0-9+/_-]{16,}={0,2}", text or ""):
            body = m[0].rstrip("=")
            if re.search("[0-9]", body) and re.search("[A-Za-z]", body) and any(re.fullmatch(e.only, body) for e in ss.ENCODINGS):
                tests.append((d, m.start(), m.end(), *battery(body)))
    limit = {}
    for c in {t[5] for t in tests}:
        bins = [t[4] for t in tests if t[5] == c]
        good = [b for b in set(bins) if math.exp(-b / 4) <= fdr * sum(x >= b for x in bins) / len(bins)]
        if good:
            limit[c] = min(good)
    out = [[] for _ in texts]
    for d, s, e, p, b, c in tests:
        if p >= alpha and c in limit and b >= limit[c]:
            out[d].append((s, 3, "random", e))
    return out


def scanned(spark, texts, **more):
    rows = ss.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), **more).collect()
    rows.sort(key=lambda r: r.rest.doc_id)
    return [[tuple(s) for s in r.base] for r in rows], [[tuple(s) for s in r.added] for r in rows]


def compared(spark, texts):
    got = scanned(spark, texts)
    assert got[0] == [base(t) for t in texts]
    assert got[1] == added(texts)
    return got


def words(r, n):
    return " ".join("".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(r.randrange(1, 12))) for _ in range(n))


def test_patterns_at_odd_places(spark):
    compared(spark, [
        None, "", "password=hunter2hunter2", "PassWord : 'abc.def=ghi-jkl' rest", "token=secret: abcdefghijklmnop", "token=password=abcdefghijklmnop",
        "api_key==abcdefghijklm", "APIKEY='0123456789abcdef0123456789abcdef'", "AKIAAKIAAKIAAKIA", "AKIA" + "B" * 14, "xAKIA" + "B" * 13, "AKIA" + "9" * 40 + "AKIA",
        "é😀 0123456789abcdef é 0123456789abcde 0123456789ABCDEF0123456789abcdef", "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop",
        "0123456789abcdef" * 2000, "password=" * 300, ("token = \"" + "a1" * 10 + "\"\n") * 700, "pass\nword=abcdefghijklmnop", "secret=\nabcdefghijklmnop"])


def test_running_sums_cross_blocks(spark):
    got = spark.range(1).select(ss.running_sums(F.sequence(F.lit(1).cast("long"), F.lit(2000).cast("long")), block=16).alias("a")).first().a
    assert got == [i * (i + 1) // 2 for i in range(1, 2001)]


def test_battery_and_discovery_limits_equal_a_plain_version(spark):
    r = random.Random(3)
    alphabets = [DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER.upper() + "234567", DIGITS + LOWER, DIGITS + LOWER + LOWER.upper(), DIGITS + LOWER + LOWER.upper() + "+/", DIGITS + LOWER + "-_"]
    texts = []
    for i in range(80):
        key = "".join(r.choice(alphabets[i % 7]) for _ in range(r.choice([16, 20, 33, 40, 64, 200])))
        slug = "-".join(words(r, 4).split()) + f"-{r.randrange(100)}"
        texts.append(f"{words(r, 20)} {key}{'=' * (i % 3)} {words(r, 5)} {slug} {words(r, 1).strip() * 4}7")
    compared(spark, texts)


def test_finds_keys_without_a_name_and_leaves_text(spark):
    r = random.Random(5)
    mixed = DIGITS + LOWER + LOWER.upper()
    texts = [f"see {''.join(r.choice(mixed) for _ in range(44))} there" for _ in range(40)]
    texts += ["/".join(words(r, 5).split()) + "/2024/05" for _ in range(200)] + ["a1" * 30, "0a1b2c3d4e5f6g7h8i9j" * 3, "abc123" * 12]
    _, found = scanned(spark, texts)
    assert sum(map(bool, found[:40])) >= 38
    assert not any(found[40:])


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "password=hunter2hunter2", "x", 2)] * 2 + [(None, None, None, None)], "doc_id long, text string, base string, rest int")
    rows = ss.scan(df).collect()
    assert sorted((str(r.rest.doc_id), len(r.base)) for r in rows) == [("1", 1), ("1", 1), ("None", 0)]
    assert [f.name for f in ss.scan(df).schema["rest"].dataType.fields] == ["doc_id", "base", "rest"]
    assert ss.scan(df.limit(0)).count() == 0
    long = " ".join(["password=hunter2hunter2 " + "Ab1" * 9] * 20_000)          # 20,000 matches in one text
    assert scanned(spark, [long])[0] == [base(long)]
