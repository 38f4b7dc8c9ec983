import random

from pyspark.sql import functions as F

from newslake.operators import rules as ru


def brute(texts, rules):
    seen = {(n, s) for n, s in rules if n}
    return sorted((i, n, s or "") for i, t, c in texts for n, s in seen if t is not None and n in t and (s is None or s == c))


def frames(spark, texts, rules):
    return (spark.createDataFrame(texts, "id long, slug string, subdomain string").repartition(3),
            spark.createDataFrame(rules, "needle string, scope string"))


def compared(spark, texts, rules):
    df, table = frames(spark, texts, rules)
    got = ru.rule_hits(df, table, F.col("slug"), F.col("subdomain"))
    want = brute(texts, rules)
    assert sorted((r.id, r.needle, r.scope or "") for r in got.collect()) == want
    left = ru.block_by_rules(df, table)
    assert sorted(r.id for r in left.collect()) == sorted(i for i, _, _ in texts if i not in {w[0] for w in want})
    return got, left


def test_equals_contains(spark):
    r = random.Random(4)
    texts = [(i, "".join(r.choice("abc-é😀") for _ in range(r.randrange(0, 30))), r.choice(["blog", "www", None])) for i in range(150)]
    rules = [("".join(r.choice("abc-é😀") for _ in range(r.randrange(0, 6))), r.choice([None, "blog", "www"])) for _ in range(60)]
    compared(spark, texts + [(900, None, "www"), (901, "", "www")], rules + [(None, None), ("", None), rules[0]])


def test_ten_thousand_rules_without_a_nested_loop(spark):
    r = random.Random(9)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))      # noqa: E731
    rules = [(word(r.choice([2, 4, 5, 8])), None if i % 3 else "blog") for i in range(10_000)]
    texts = [(i, "-".join(word(6) for _ in range(6)) + (rules[i][0] if i % 4 == 0 else ""), "blog" if i % 2 else "www") for i in range(400)]
    got, left = compared(spark, texts, rules)
    for df in (got, left):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_text_and_regex_characters(spark):
    texts = [(i, "same.slug(with)[all]*+?^$|\\{}", "a") for i in range(300)] + [(500, "line\nbreak and\ttab", "a")]
    compared(spark, texts, [(".slug(", None), ("*+?", "a"), ("\\{}", "b"), ("e\nb", None), ("k", None), ("$", None), ("nothing", None)])


def test_phrases_in_the_head_only(spark):
    pages = spark.createDataFrame([(1, "JUST a Moment ..."), (2, "x" * 2000 + "just a moment"), (3, None), (4, "")], "id long, html string")
    got = ru.challenge_by_rules(pages, spark.createDataFrame([("Just A moment",)], "needle string"))
    assert {r.id: r.is_challenge for r in got.collect()} == {1: True, 2: False, 3: False, 4: False}
    none = ru.challenge_by_rules(pages, spark.createDataFrame([], "needle string"))
    assert none.where("is_challenge").count() == 0 and none.count() == 4


def test_a_text_that_holds_every_rule_is_one_row(spark):
    word = "abcdefghijklmnopqrstuvwxyz" * 2
    rules = [(word[i:j], s) for i in range(26) for j in range(i + 1, 48, 3) for s in (None, "www")]
    df, table = frames(spark, [(i, word + str(i), "www") for i in range(40)] + [(90, "-", "www")], rules)
    assert ru.holders(df, F.col("slug"), table, F.col("subdomain")).count() == 40
    assert [r.id for r in ru.block_by_rules(df, table).collect()] == [90]


def test_needles_of_any_length_across_blocks(spark):
    r = random.Random(6)
    texts = [(i, "".join(r.choice("ab\n😀é") for _ in range(r.choice([0, 3, 900, 1030, 2500, 9000]))), r.choice(["blog", None])) for i in range(30)]
    long = [t for _, t, _ in texts if len(t) > 800]
    rules = [(t[i:i + n], r.choice([None, "blog"])) for t in long for n in (5, 31, 32, 63, 64, 700, 1500) for i in (0, 1000, 1023, 1025, len(t) - n) if i >= 0]
    compared(spark, texts, rules)
