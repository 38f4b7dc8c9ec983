"""Near-duplicate vectors by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import materialise
from newslake.llm.components import components

#: Tables, projections a table and width of a projection's cells.  Two vectors of
#: length 1 at cosine 0.95 share a cell with chance 0.75 a projection, hence one of
#: the 48 buckets with 0.993 (at 0.97: 0.9999), unrelated ones with 0.0014.
TABLES, PROJECTIONS, WIDTH, SEED = 48, 8, 1.0, 20_240

_rows: dict[int, np.ndarray] = {}


def _projection(dims: int) -> np.ndarray:
    """Gaussian directions; a component's row does not depend on how many there are."""
    for d in range(len(_rows), dims):
        _rows[d] = np.random.default_rng([SEED, d]).standard_normal(TABLES * PROJECTIONS)
    return np.stack([_rows[d] for d in range(dims)])


def bucket_keys(vectors: np.ndarray) -> np.ndarray:
    """One 32-bit bucket key a table for each row of ``vectors`` (normalised here)."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    shift = np.random.default_rng([SEED, 1 << 40]).random(TABLES * PROJECTIONS) * WIDTH
    cell = np.floor((unit @ _projection(vectors.shape[1]) + shift) / WIDTH).astype(np.int64).view(np.uint64)
    cell = cell.reshape(len(vectors), TABLES, PROJECTIONS)
    key = np.zeros((len(vectors), TABLES), np.uint64)
    for p in range(PROJECTIONS):
        key = (key ^ cell[:, :, p]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return (key >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _hash_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vectors = b.column("v").to_pylist()
        by_dims: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_dims.setdefault(len(v), []).append(i)
        keys, scaled = np.zeros((len(vectors), TABLES), np.int32), [[]] * len(vectors)
        norms = np.zeros(len(vectors))
        for rows in by_dims.values():
            m = np.array([vectors[i] for i in rows], np.float64)
            # A power of two takes the largest component below 1, without rounding, so
            # that no square or product is infinite or lost.
            m = np.ldexp(m, -np.frexp(np.abs(m).max(1, keepdims=True))[1])
            keys[rows] = bucket_keys(m)
            norms[rows] = np.linalg.norm(m, axis=1)
            for i, v in zip(rows, m, strict=True):
                scaled[i] = v
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1) * TABLES, pa.int32()), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([b.column("rep"), b.column("copies"), pa.array(scaled, b.column("v").type), pa.array(norms), lists],
                                         names=["rep", "copies", "v", "norm", "keys"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Two vectors link if they meet in a bucket of any table and their cosine in
    double precision is at least ``threshold``; no pair below it links.  Equal
    vectors are one node with its number of copies, so a group of copies costs no
    pairs.  ``n_links`` counts other rows linked directly, ``component_id`` is the
    smallest id reachable, ``kept`` says that it is the row's own.  Null, empty, zero
    vectors, such with null or non-finite components and rows without an id link with
    nothing.  Vectors of different lengths compare as if filled up with zeros.
    Buckets have no limit; a pair counts at the first table in which it meets.
    """
    v = F.col(f"`{vector_col}`")
    fit = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) \
        & F.exists(v, lambda x: x != 0) & F.col(f"`{id_col}`").isNotNull()
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.coalesce(fit, F.lit(False)).alias("fit"),
                          F.xxhash64(v).alias("h1"), F.xxhash64(F.lit(1), v).alias("h2"), v.alias("v"))
    classes = rows.where("fit").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("v").alias("v"))
    kind = "array<float>" if rows.schema["v"].dataType.simpleString() == "array<float>" else "array<double>"
    hashed = classes.select("rep", "copies", F.col("v").cast(kind)).mapInArrow(_hash_side, f"rep long, copies long, v {kind}, norm double, keys array<int>")
    spread = hashed.select("*", F.posexplode("keys").alias("t", "k"))
    a, b = spread.alias("a"), spread.alias("b")
    first = F.array_position(F.zip_with("a.keys", "b.keys", lambda x, y: x == y), True) == F.col("a.t") + 1
    dot = F.aggregate(F.zip_with("a.v", "b.v", lambda x, y: F.coalesce(x.cast("double") * y.cast("double"), F.lit(0.0))),
                      F.lit(0.0), lambda s, x: s + x)
    close = dot / F.col("a.norm") / F.col("b.norm") >= threshold
    met = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.k") == F.col("b.k")) & (F.col("a.rep") < F.col("b.rep")) & first & close)
    links = materialise(met.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b"), F.col("a.copies").alias("na"),
                                   F.col("b.copies").alias("nb")), "vector_links")
    more = links.select(F.col("a").alias("rep"), F.col("nb").alias("n")).unionByName(links.select(F.col("b").alias("rep"), F.col("na").alias("n"))) \
        .groupBy("rep").agg(F.sum("n").alias("n"))
    member = components(links.select("a", "b"))
    named = classes.select("h1", "h2", "rep", "copies").join(more, "rep", "left").join(member, F.col("rep") == F.col("node"), "left") \
        .select("h1", "h2", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", F.when(F.col("fit"), F.col("h1")).alias("h1"), F.when(F.col("fit"), F.col("h2")).alias("h2")) \
        .join(named, ["h1", "h2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
                      F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"))
