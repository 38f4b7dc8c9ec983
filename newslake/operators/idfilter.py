"""Bloom filters of stored ids, as tables.

A filter is a table of blocks of eight 64-bit words.  An id sets one bit in each word of
one block, so building is one aggregate (``bit_or``, combined before its shuffle) and
asking is one equality join on the block, verified by the eight bits.  About
``BITS_PER_ID / 8`` bytes an id are read instead of the id columns of all data files,
and an id that fails is surely new.  More ids are added by appending rows: an id set at
one time has all its bits in one row.  Nothing is broadcast by hand: the filter grows
with the table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.operators.windows import first_wins
from newslake.session import shared_path

#: About one id in 200 that is not stored passes at 12 bits.
BITS_PER_ID = 12
WORDS = [f"w{i}" for i in range(8)]


def blocks_for(expected_ids: int) -> int:
    """Blocks of a filter for about so many ids (more ids let more strangers pass)."""
    return max(1, math.ceil(expected_ids * BITS_PER_ID / (64 * len(WORDS))))


def _place(key: str, blocks: int) -> tuple[Column, list[Column]]:
    """Block of an id, and its bit in each word (six bits of a second hash each)."""
    text = F.col(key).cast("string")
    bits = F.xxhash64(text, F.lit("bits"))
    masks = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
             for i in range(len(WORDS))]
    return F.pmod(F.xxhash64(text), F.lit(blocks)), masks


def build(ids: DataFrame, blocks: int, key: str = "id") -> DataFrame:
    """Filter rows (``block, w0 .. w7``) of the ids; null ids are none."""
    block, masks = _place(key, blocks)
    rows = ids.where(F.col(key).isNotNull()).select(block.alias("block"), *[m.alias(w) for m, w in zip(masks, WORDS)])
    return rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def merged(rows: DataFrame) -> DataFrame:
    """One row a block: filters that were built one after another, compacted."""
    return rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def passing(ids: DataFrame, rows: DataFrame, blocks: int, key: str = "id") -> DataFrame:
    """Distinct non-null ids that may be in the filter: all that are, and few others."""
    block, masks = _place(key, blocks)
    asked = ids.select(key).where(F.col(key).isNotNull()).distinct()
    asked = asked.select(key, block.alias("_block"), *[m.alias(f"_{w}") for m, w in zip(masks, WORDS)])
    held = rows.select(F.col("block").alias("_b"), *WORDS)
    same = F.col("_block") == F.col("_b")
    for w in WORDS:
        same = same & (F.col(w).bitwiseAND(F.col(f"_{w}")) == F.col(f"_{w}"))
    return asked.join(held, same, "left_semi").select(key)


def passing_written(ids: DataFrame, rows: DataFrame, blocks: int, key: str = "id") -> DataFrame:
    """:func:`passing`, written once (one narrow column), so that it can be asked whether
    any id passes and then be joined."""
    path = shared_path(ids.sparkSession, "passing_ids")
    passing(ids, rows, blocks, key).write.parquet(path)
    return ids.sparkSession.read.schema(ids.select(key).schema).parquet(path)


def known_ids(ids: DataFrame, stored: DataFrame, rows: DataFrame, blocks: int, key: str = "id") -> DataFrame:
    """Which of the ids are stored, exactly: those that pass the filter are looked up.  If
    none passes, ``stored`` is not read at all."""
    asked = passing_written(ids, rows, blocks, key)
    return asked if asked.isEmpty() else stored.select(key).join(asked, key, "left_semi").distinct()


def new_only(incoming: DataFrame, stored: DataFrame, rows: DataFrame, blocks: int, key: str = "id") -> DataFrame:
    """J1 through the filter: incoming rows whose id is not stored (null ids are not)."""
    return incoming.join(known_ids(incoming, stored, rows, blocks, key), key, "left_anti")


def record_exists(probe: DataFrame, stored: DataFrame, rows: DataFrame, blocks: int, key: str = "id", flag: str = "exists") -> DataFrame:
    """J2 through the filter: every probe row with a flag."""
    marked = known_ids(probe, stored, rows, blocks, key).withColumn(flag, F.lit(True))
    return probe.join(marked, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def fresh_rows(batch: DataFrame, stored: DataFrame, rows: DataFrame, blocks: int, key: str = "id", order: str = "seq") -> DataFrame:
    """W1 through the filter: the first arrival of every id that is not stored."""
    firsts = first_wins(batch.where(F.col(key).isNotNull()), key, order)
    return firsts.join(known_ids(batch, stored, rows, blocks, key), key, "left_anti")


__all__ = ["BITS_PER_ID", "WORDS", "blocks_for", "build", "fresh_rows", "known_ids", "merged", "new_only", "passing", "passing_written", "record_exists"]
