"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """Members and the smallest id each can reach: columns ``node, component``.

    ``edges`` has long columns ``a, b`` (any order, repeats and loops allowed).
    Nodes without an edge do not appear.  Every round points each node at the
    smallest neighbour it sees: first its larger neighbours (large star), then
    its smaller ones (small star).  The rounds needed grow with the logarithm of
    the longest path; each writes its edges to the shared scratch folder.  A hub
    is a key of an aggregate and of a join whose other side has one row for it,
    which adaptive execution can split.  Nothing is collected but one check row.
    """
    cur = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .distinct(), "edges")
    seen = None
    while True:
        mark = cur.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).first()
        if mark == seen:
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = mark
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        cur = materialise(small.unionByName(low2.select("u", F.col("m").alias("v"))).distinct(), "stars")
