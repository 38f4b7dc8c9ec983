"""Rule tables of substrings, joined by equality of whole needles.

A needle's width is the largest power of two that its length reaches.  For every width
that occurs, each place of a text gives its next ``2 * width - 1`` characters; where
these begin as some needle of that width does, they are cut to the lengths of the needles
that begin so, and a cut that equals a needle is a hit.  So rules are rows, as many as
there are, a text meets a needle only where it holds it, and rows grow with the places of
the texts.  Whether any rule holds is a semi-join: a text that holds many needles makes
no more rows than one that holds few.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.constants import CHALLENGE_SCAN_CHARS
from newslake.session import shared_path

#: Places of a text whose pieces are held at once (four widths, if that is more).
BLOCK = 1024
KEY = ["_h1", "_h2"]


def _keyed(df: DataFrame, text: Column, scope: Column | None) -> DataFrame:
    """``df`` with 128 bits that stand for text and scope (null for a null text), so that
    what is found travels without them."""
    own = [text] if scope is None else [text, scope.cast("string")]
    return df.withColumns({k: F.when(text.isNotNull(), F.xxhash64(F.lit(k), *own)) for k in KEY})


def rule_table(rules: DataFrame) -> DataFrame:
    """Distinct ``needle`` and ``scope`` (null: everywhere); rules without a needle are none."""
    scope = F.col("scope") if "scope" in rules.columns else F.lit(None)
    return rules.select(F.col("needle"), scope.cast("string").alias("scope")).where(F.length("needle") > 0).distinct()


def _written(rules: DataFrame) -> DataFrame:
    """The rule table with ``_width``, in files: its size is known when joins are planned."""
    spark = rules.sparkSession
    width = F.expr("cast(shiftleft(1, length(bin(length(needle))) - 1) as int)")
    table, path = rule_table(rules).withColumn("_width", width), shared_path(spark, "rules")
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def _runs(text: Column, width: int) -> Column:
    """From each place of a text its next characters, ``width`` to ``2 * width - 1``."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{width},{2 * width - 1}}}))."), F.lit(1))


def _blocks(text: Column, width: int) -> Column:
    """A text in blocks that hold the runs of all its places."""
    step = max(BLOCK, 4 * width)
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{step + 2 * width - 2}}})).{{1,{step}}}"), F.lit(1))


def _pieces(texts: DataFrame, text: Column, scope: Column | None, table: DataFrame) -> DataFrame:
    """``_h1, _h2, needle, scope``: pieces of the texts that begin like a needle and are as long
    as one that begins so, once for everywhere and once for the text's own scope."""
    own = F.lit(None).cast("string") if scope is None else scope.cast("string")
    rows = _keyed(texts.where(text.isNotNull()), text, scope).select(*KEY, own.alias("_own"), text.alias("_text"))
    widths = sorted(r[0] for r in table.select("_width").distinct().collect())          # powers of two: 31 rows at most

    def of(width: int) -> DataFrame:
        begins = (table.where(F.col("_width") == width).groupBy(F.substring("needle", 1, width).alias("_begin"))
                  .agg(F.collect_set(F.length("needle")).alias("_lengths")))
        runs = rows.select(*KEY, "_own", F.explode(_blocks(F.col("_text"), width)).alias("_block"))
        runs = runs.select(*KEY, "_own", F.explode(_runs(F.col("_block"), width)).alias("_run"))
        runs = runs.withColumn("_begin", F.substring("_run", 1, width)).join(begins, "_begin")
        cut = runs.select(*KEY, "_own", "_run", F.explode("_lengths").alias("_length")).where(F.length("_run") >= F.col("_length"))
        return cut.select(*KEY, "_own", F.substring(F.col("_run"), F.lit(1), F.col("_length")).alias("needle"))

    none = table.limit(0).select(*[F.lit(0).cast("long").alias(k) for k in KEY], F.lit("").alias("_own"), F.lit("").alias("needle"))
    pieces = functools.reduce(DataFrame.unionByName, map(of, widths)) if widths else none
    return pieces.select(*KEY, "needle", F.explode(F.array_distinct(F.array(F.lit(None).cast("string"), F.col("_own")))).alias("scope"))


def _is_rule(pieces: DataFrame, table: DataFrame) -> Column:
    return (pieces["needle"] == table["needle"]) & pieces["scope"].eqNullSafe(table["scope"])


def holders(texts: DataFrame, text: Column, rules: DataFrame, scope: Column | None = None) -> DataFrame:
    """``_h1, _h2`` of the texts for which some rule holds, one row each."""
    table = _written(rules)
    pieces = _pieces(texts, text, scope, table)
    return pieces.join(table, _is_rule(pieces, table), "left_semi").select(*KEY).distinct()


def rule_hits(df: DataFrame, rules: DataFrame, text: Column, scope: Column | None = None) -> DataFrame:
    """Every row with every rule that holds for it: the row's columns, ``needle``, ``scope``."""
    table = _written(rules)
    pieces = _pieces(df, text, scope, table)
    found = pieces.join(table, _is_rule(pieces, table), "left_semi").distinct()
    return _keyed(df, text, scope).join(found, KEY).drop(*KEY)


def block_by_rules(df: DataFrame, rules: DataFrame, text_col: str = "slug", scope_col: str | None = "subdomain") -> DataFrame:
    """F6 with a rule table: rows for which no rule holds (a null text holds none)."""
    text, scope = F.col(text_col), F.col(scope_col) if scope_col else None
    return _keyed(df, text, scope).join(holders(df, text, rules, scope), KEY, "left_anti").drop(*KEY)


def challenge_by_rules(pages: DataFrame, phrases: DataFrame, html_col: str = "html", scan_chars: int = CHALLENGE_SCAN_CHARS) -> DataFrame:
    """F7 with a table of phrases (``needle``): ``is_challenge`` for every page, by the first
    ``scan_chars`` characters in lower case."""
    head = F.lower(F.substring(F.col(html_col), 1, scan_chars))
    hit = holders(pages, head, phrases.select(F.lower("needle").alias("needle"))).withColumn("_hit", F.lit(True))
    return _keyed(pages, head, None).join(hit, KEY, "left").withColumn("is_challenge", F.coalesce("_hit", F.lit(False))).drop(*KEY, "_hit")


__all__ = ["block_by_rules", "challenge_by_rules", "holders", "rule_hits", "rule_table"]
