"""The conversation trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from newslake.llm import prefix_trie as pt

TURNS = "conv_id long, turn long, role string, text string"


def sequences(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, r or "", hashlib.md5(f"{len(r or '')}:{r or ''}{x or ''}".encode()).hexdigest(), x or ""))
    return {c: [(v[2], v[4]) for v in sorted(s)] for c, s in out.items()}


def brute(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def below(p):
        todo, leaves, saved = [p], 0, 0
        while todo:
            q = todo.pop()
            leaves += not children[q]
            saved += (len(members[q]) - 1) * len(q[-1][1].encode()) if q else 0
            todo += children[q]
        return leaves, saved

    out = []
    for p, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children[p]), *below(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_rows(seed, n, letters="ab", longest=7):
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"][:1 + seed % 2]), r.choice(letters) * r.choice([1, 3])) for c in range(n) for t in range(r.randrange(1, longest))]


@pytest.mark.parametrize("seed,partitions,fan", [(1, 1, 64), (2, 7, 2), (3, 40, 3), (4, 90, 64)])
def test_equals_brute_force_at_any_split(spark, seed, partitions, fan):
    rows = random_rows(seed, 160)
    keys = pt.conversation_keys(spark.createDataFrame(rows, TURNS))
    assert found(pt.trie(keys, fan=fan, partitions=partitions)) == brute(sequences(rows))


def test_hot_conversation_lies_in_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE_IDS", 3)
    rows = [(c, t, "user", "same" if c % 3 else f"x{c % 7}") for c in range(200) for t in range(3)] + [(500 + c, 0, "user", "same") for c in range(40)]
    keys = pt.conversation_keys(spark.createDataFrame(rows, TURNS))
    assert found(pt.trie(keys, fan=4, partitions=30)) == brute(sequences(rows))


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (2, 0, "user", "é😀"), (2, 0, "user", "é😀"), (3, 5, "a", "x" * 100_000), (None, 0, "user", "lost"),
            (4, 0, None, ""), (5, 1, "us", "er"), (6, 1, "user", ""), (-7, 0, "user", "é😀")] + [(9, t, "u", "deep") for t in range(300)] + [(10, t, "u", "deep") for t in range(250)]
    df = spark.createDataFrame(rows, TURNS).withColumn("key", F.lit(1)).withColumn("depth", F.lit("clash"))
    assert found(pt.trie(pt.conversation_keys(df), partitions=5, fan=2)) == brute(sequences(rows))
    assert pt.trie(pt.conversation_keys(spark.createDataFrame([], TURNS))).count() == 0


def test_spliced_conversations(spark):
    rows = random_rows(5, 60, longest=12)
    rows = [r for r in rows if r[0] not in (10, 25)]                   # absent bases
    seqs = sequences(rows)
    keys = pt.conversation_keys(spark.createDataFrame(rows, TURNS))
    c = F.col("conv_id")
    got = pt.trie(pt.spliced(keys, c - c % 5, F.crc32(c.cast("string")) % 9), partitions=9, fan=2)
    cut = {i: zlib.crc32(str(i).encode()) % 9 for i in seqs}
    assert found(got) == brute({i: seqs.get(i - i % 5, [])[:cut[i]] + s[cut[i]:] for i, s in seqs.items()})


def test_turnless_conversations_end_at_the_root(spark):
    keys = spark.createDataFrame([(4, b""), (3, b""), (None, b""), (5, None)], "conv_id long, key binary")
    assert found(pt.trie(keys)) == brute({3: [], 4: []})
