"""Table-write operators.

Parquet tables cannot be updated in place, so every write operator returns
the *next version* of the table as a DataFrame; :func:`commit_snapshot`
writes it to a new snapshot directory (never over the path being read).
All per-key decisions are aggregates (map-side partial), so one hot id never
lands whole in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newslake.operators.windows import dedupe_latest, first_wins
from newslake.schema import ARTICLE_COLUMNS, CONTENT_COLUMNS, KEY_COLUMNS
from newslake.session import shared_path


def split_rejects(batch: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows with a NULL key)."""
    return batch.filter(F.col(key).isNotNull()), batch.filter(F.col(key).isNull())


def insert_ignore(table: DataFrame, batch: DataFrame, key: str = "id", order: str = "seq") -> DataFrame:
    """Insert-if-absent.  Existing keys are untouched; inside the batch the
    first arrival (lowest ``order``) wins; NULL keys are rejected (see
    :func:`split_rejects`).  Returns the new table version."""
    good, _ = split_rejects(batch, key)
    cols = table.columns
    winners = first_wins(good, key, order).select(*cols)
    fresh = winners.join(table.select(key), on=key, how="left_anti").select(*cols)
    return table.unionByName(fresh)


def upsert_two_phase(table: DataFrame, batch: DataFrame, seq: str = "seq") -> DataFrame:
    """Two-phase upsert, equal to replaying the batch record by record in
    ``seq`` order.

    * a stub (title NULL) inserts its key columns only if the id is absent;
    * a full record inserts if absent, else replaces the five content columns
      together (NULLs included);
    * key columns (source, url, category, date) never change once stored.

    Per id this is: key columns of the first record, content of the last full
    record; then a full outer join with the table.
    """
    good, _ = split_rejects(batch, "id")
    key_payload = [c for c in KEY_COLUMNS if c != "id"]
    b = good.select("id", F.col(seq).alias("_seq"),
                    F.struct(*key_payload).alias("_k"), F.struct(*CONTENT_COLUMNS).alias("_c"),
                    F.col("title").isNotNull().alias("_full"))
    per_id = b.groupBy("id").agg(
        F.min(F.struct("_seq", "_k")).alias("_first"),
        F.max(F.when(F.col("_full"), F.struct("_seq", "_c"))).alias("_last_full"))
    t = table.select("id", F.struct(*key_payload).alias("_tk"), F.struct(*CONTENT_COLUMNS).alias("_tc"),
                     F.lit(True).alias("_in_table"))
    j = t.join(per_id, on="id", how="full_outer")
    k = F.when(F.col("_in_table"), F.col("_tk")).otherwise(F.col("_first._k"))
    c = F.when(F.col("_last_full").isNotNull(), F.col("_last_full._c")).otherwise(F.col("_tc"))
    out = j.select("id", k.alias("_K"), c.alias("_C"))
    return out.select(*[F.col(f"_K.{x}").alias(x) if x in key_payload else
                        F.col(f"_C.{x}").alias(x) if x in CONTENT_COLUMNS else F.col(x)
                        for x in ARTICLE_COLUMNS])


def compact(df: DataFrame, key: str = "id", newest: str = "publish_time") -> DataFrame:
    """Keep the N4 winner per id (titled first, then newest)."""
    return dedupe_latest(df, key, newest)


def conditional_update(df: DataFrame, predicate: Column, updates: dict[str, Column]) -> DataFrame:
    """Set columns where ``predicate`` holds, leave the rest unchanged."""
    pred = F.coalesce(predicate, F.lit(False))
    return df.withColumns({c: F.when(pred, v).otherwise(F.col(c)) for c, v in updates.items()})


def sync_incremental(source: DataFrame, target: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Copy rows of ``source`` missing from ``target``.

    Returns (new target version, one-row summary with source_total,
    inserted, skipped, target_total).  Only key columns of the target are
    read for the anti-join.  A key that repeats in ``source`` is inserted once (its
    smallest row), a row without a key never.  Running it again inserts nothing.
    """
    cols = target.columns
    fresh = source.join(target.select(key), on=key, how="left_anti").filter(F.col(key).isNotNull())
    # One row per missing key, whichever repeats there are; rows without a key stay out.
    first = F.min(F.struct(*[F.col(c) for c in cols])).alias("_row")
    missing = fresh.groupBy(F.col(key).alias("_key")).agg(first).select("_row.*")
    new_target = target.unionByName(missing)
    # Three tagged counts folded by one aggregate (no joins between them).
    tagged = (source.select(F.lit(1).alias("_s"), F.lit(0).alias("_i"), F.lit(0).alias("_t"))
              .unionByName(missing.select(F.lit(0).alias("_s"), F.lit(1).alias("_i"), F.lit(0).alias("_t")))
              .unionByName(target.select(F.lit(0).alias("_s"), F.lit(0).alias("_i"), F.lit(1).alias("_t"))))
    totals = tagged.agg(F.sum("_s").cast("bigint").alias("source_total"),
                        F.sum("_i").cast("bigint").alias("inserted"),
                        F.sum("_t").cast("bigint").alias("_before"))
    summary = totals.select(F.coalesce("source_total", F.lit(0)).alias("source_total"),
                            F.coalesce("inserted", F.lit(0)).alias("inserted"),
                            (F.coalesce("source_total", F.lit(0)) - F.coalesce("inserted", F.lit(0))).alias("skipped"),
                            (F.coalesce("_before", F.lit(0)) + F.coalesce("inserted", F.lit(0))).alias("target_total"))
    return new_target, summary


def _range_digests(keys: DataFrame, key: str, ranges: int, prefix: str) -> DataFrame:
    """Order-free digest of the keys of each hash range: their number and two sums of hashes
    (at most ``ranges`` rows, summed in every task first)."""
    h = F.xxhash64(key).cast("decimal(20,0)")
    g = F.xxhash64(F.lit("digest"), F.col(key)).cast("decimal(20,0)")
    return (keys.where(F.col(key).isNotNull()).groupBy(F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int").alias("_range"))
            .agg(F.count(F.lit(1)).alias(f"{prefix}n"), F.sum(h).alias(f"{prefix}h"), F.sum(g).alias(f"{prefix}g")))


def sync_by_digest(source: DataFrame, target: DataFrame, key: str = "id", ranges: int = 4096) -> tuple[DataFrame, DataFrame]:
    """W5 by range digests: as :func:`sync_incremental`, but only hash ranges of the key
    whose digests differ are compared row by row; rows of equal ranges are filtered out
    where they are scanned and never shuffled.

    Returns (new target version, one row per differing range: ``range``, ``source_n``,
    ``target_n``).  The driver gets the differing range numbers, ``ranges`` at most.
    """
    both = _range_digests(source.select(key), key, ranges, "s").join(_range_digests(target.select(key), key, ranges, "t"), "_range", "full_outer")
    differs = ~(F.col("sn").eqNullSafe(F.col("tn")) & F.col("sh").eqNullSafe(F.col("th")) & F.col("sg").eqNullSafe(F.col("tg")))
    found = both.where(differs & F.col("sn").isNotNull()).select(
        F.col("_range").alias("range"), F.col("sn").alias("source_n"), F.coalesce("tn", F.lit(0)).alias("target_n")).collect()
    spark = source.sparkSession
    report = spark.createDataFrame([tuple(r) for r in found], "range int, source_n long, target_n long")
    if not found:
        return target, report
    open_ = F.pmod(F.xxhash64(key), F.lit(ranges)).cast("int").isin([r.range for r in found])
    cols = target.columns
    fresh = source.where(F.col(key).isNotNull() & open_).join(target.select(key).where(open_), on=key, how="left_anti")
    missing = fresh.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*[F.col(c) for c in cols])).alias("_row")).select("_row.*")
    return target.unionByName(missing), report


def save_bucketed(df: DataFrame, table: str, key: str = "id", buckets: int = 64, path: str | None = None) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` sorted by ``key``: joins and aggregates on
    the key need no exchange of the stored side.  ``path``: its folder (default: the
    session's warehouse)."""
    w = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (w.option("path", path) if path else w).saveAsTable(table)
    return df.sparkSession.table(table)


def commit_snapshot(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as a new snapshot directory under ``root``; return its path.

    Names sort by commit time (``snap-<nanoseconds>-<random>``), so the newest
    complete snapshot is found by listing; a failed write leaves no
    ``_SUCCESS`` marker and is skipped by :func:`latest_snapshot`.
    """
    import time
    import uuid
    path = f"{root.rstrip('/')}/snap-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete snapshot under ``root`` (None if none)."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return None
    names = sorted((st.getPath().getName() for st in fs.listStatus(base)
                    if st.isDirectory() and st.getPath().getName().startswith("snap-")), reverse=True)
    for n in names:
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{n}/_SUCCESS")):
            return f"{root.rstrip('/')}/{n}"
    return None


def layered_build(spark: SparkSession, layers: list[tuple[str, str, object]], root: str | None = None,
                  keys: dict[str, str] | None = None, buckets: int = 64) -> dict:
    """Build layers in order.  Each layer is (name, kind, build) where ``kind`` is
    ``"view"`` (temp view), ``"table"`` (written to parquet and re-read) or ``"bucketed"``
    (a catalog table bucketed by ``keys[name]``, default ``id``) and ``build(spark)``
    returns a DataFrame that may read earlier layers by name.  Returns {name: DataFrame}."""
    root = root or shared_path(spark, "layers")
    built = {}
    for name, kind, build in layers:
        df = build(spark)
        path = root.rstrip("/") + "/" + name
        if kind == "bucketed":
            built[name] = save_bucketed(df, name, (keys or {}).get(name, "id"), buckets, path)
            continue
        if kind == "table":
            df.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path)
        df.createOrReplaceTempView(name)
        built[name] = df
    return built


__all__ = ["insert_ignore", "upsert_two_phase", "compact", "conditional_update", "sync_incremental",
           "commit_snapshot", "latest_snapshot", "layered_build", "save_bucketed", "split_rejects", "sync_by_digest"]
