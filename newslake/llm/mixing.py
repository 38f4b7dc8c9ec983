"""Mixing sources to target weights by repeating and dropping whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newslake.llm.common import materialise, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Independent draws of which each source takes the one nearest to its target.
DRAWS = 16
#: Bytes of the per-source table up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``.

    Sources in code point order (null last) weigh ``weights`` in turn and share
    ``share`` x all words.  A target stops at ``most`` x the source's words and the
    excess goes to the others by weight: with sources in order of cap / weight, the
    level (words a unit of weight) is that of the first source whose cap reaches
    the level left by the capped ones before it.  Works on one row a source.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    ranked = by.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).alias("weight"),
                       F.row_number().over(order).alias("place")) \
        .withColumn("cap", (F.col("source_size") * most).cast("double")).withColumn("reach", F.col("cap") / F.col("weight"))
    whole = Window.orderBy("reach", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy("reach", "place").rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*", ((F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
              / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level_here"),
        F.row_number().over(Window.orderBy("reach", "place")).alias("turn"))
    level = F.min_by(F.when(F.col("level_here") <= F.col("reach"), F.col("level_here")),
                     F.when(F.col("level_here") <= F.col("reach"), F.col("turn"))).over(
        Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.select("source", "source_size",
                         F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def _draws(doc_id, text) -> list:
    """Numbers from 0 to 1 (2^-32 steps) that depend on the id and the text alone."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.md5(text.cast("binary")), F.lit("")), F.lit("/"))
    return [F.conv(F.substring(F.md5(F.concat(key, F.lit(str(k // 4))).cast("binary")), 1 + 8 * (k % 4), 8), 16, 10).cast("double")
            / F.lit(float(1 << 32)) for k in range(DRAWS)]


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **rules) -> DataFrame:
    """``docs`` as a struct column ``row`` with ``size``, ``source_size``, ``target``, ``copies``.

    Each document goes into the mix floor(rate) times, rate = target / words of its
    source, and once more with probability rate - floor(rate): a draw seeded by the
    hash of its id and text.  Of 16 such draws each source uses the one that brings
    its total nearest to its target (ties: the first).  Equal rows draw alike.  A
    source without words has rate 0.  An empty table gives an empty result.
    """
    col = lambda c: F.col(f"`{c}`")
    sizes = materialise(docs.select(col(source_col).cast("string").alias("source"), word_count(col(text_col)).alias("size"),
                                    F.array(*_draws(col(id_col), col(text_col))).alias("u")), "mix_sizes")
    targets = materialise(source_targets(sizes, **rules), "mix_targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    part = rate - F.floor(rate)

    def with_source(rows: DataFrame, name: str, table: DataFrame) -> DataFrame:
        n = table.agg(F.count("*"), F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0))), F.lit(0))).first()
        table = table.withColumnRenamed("source", "source_")
        table = F.broadcast(table) if n[0] * 64 + n[1] <= BROADCAST_BYTES else table
        return rows.join(table, F.col(name).eqNullSafe(F.col("source_"))).drop("source_")

    taken = [F.sum(F.col("size") * (F.floor(rate) + F.when(F.col("u")[k] < part, 1).otherwise(0))).alias(f"t{k}") for k in range(DRAWS)]
    totals = with_source(sizes, "source", targets).groupBy("source", "source_size", "target").agg(*taken)
    off = F.array(*[F.abs(F.col(f"t{k}") - F.col("target")) for k in range(DRAWS)])
    chosen = materialise(totals.select("source", "source_size", "target",
                                       F.array_position(off, F.array_min(off)).cast("int").alias("draw")), "mix_draws")
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(source_col).cast("string").alias("src_"),
                       word_count(col(text_col)).alias("size"), F.array(*_draws(col(id_col), col(text_col))).alias("u_"))
    mixed = with_source(rows, "src_", chosen)
    copies = F.floor(rate) + F.when(F.element_at("u_", F.col("draw")) < part, 1).otherwise(0)
    return mixed.select("row", "size", "source_size", "target", copies.cast("int").alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: the columns of the documents, each row ``copies`` times."""
    return mixed.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("n")).select("row.*")
