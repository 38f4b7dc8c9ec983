"""Centroid clustering of integer vectors: Lloyd's rounds with ns-bounds.

A vector keeps, for every centroid, the squared distance it was last measured at
and the round of that measurement.  Later rounds do not add up how far a centroid
drifted round by round: the history of all centroids is kept, and a stored distance
is loosened by the norm of the centroid's *total* displacement since its round.
Where the loosened bounds leave one centroid possible the vector stays unmeasured;
any other is measured again exactly, its own centroid first, then those whose lower
bound still reaches it.  All distances are integers, so ties are ties.

Every round maps one table of vectors and bounds to the next: no shuffle, nothing
held between rounds but ``rounds * centroids * dimensions`` numbers on the driver.
Only vectors that changed their centroid are summed, as differences to the sums
before.  The tables lie in the shared scratch folder; the one before last is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslake.llm.common import discard
from newslake.session import shared_path

#: Room for rounding in the bounds, relative to their size.
SLACK = 1e-9
#: Components must stay below this in size, so that they are exact as doubles.
LARGEST = float(1 << 52)


def whole_vectors(vectors: DataFrame, column: str, dimensions: int, scale: int) -> DataFrame:
    """``rest`` (all columns but the vector) and ``vector``, ``floor(scale * x)`` of every
    component, of the vectors with ``dimensions`` components, none null or non-finite.
    A component of 2**52 or more after scaling raises an error."""
    x = F.col(column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    kept = vectors.where((F.size(x) == dimensions) & finite)

    def whole(v: Column) -> Column:
        v = v.cast("double") * F.lit(float(scale))
        return F.when(F.abs(v) < LARGEST, F.floor(v).cast("long")).otherwise(
            F.raise_error(F.lit("component too large for exact distances")).cast("long"))

    others = [F.col(f"`{c}`") for c in vectors.columns if c != column]
    return kept.select(F.struct(*others).alias("rest"), F.transform(x, whole).alias("vector"))


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row of ``x`` to the row of ``c`` beside it (or to
    the one row ``c``), in Python integers where a long could overflow."""
    room = (2 ** 62 // max(1, x.shape[1])) ** 0.5 / 2
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) >= room:
        d = x.astype(object) - c.astype(object)
        return (d * d).sum(axis=1)
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def displacements(history: np.ndarray) -> np.ndarray:
    """How far every centroid stands now from where it stood in each round (a row a round)."""
    d = history.astype(float) - history[-1].astype(float)
    return np.sqrt((d * d).sum(axis=2))


def assign(x: np.ndarray, own: np.ndarray, seen: np.ndarray, at: np.ndarray, history: np.ndarray, final: bool) -> np.ndarray:
    """Nearest centroid of every row; ``seen`` and ``at`` (squared distance and round of
    the last measurement of each centroid) are brought up to date.  ``final`` also
    measures the distance to the nearest centroid of rows that needed no measuring."""
    now, k = len(history) - 1, history.shape[1]
    if now == 0:
        for j in range(k):
            seen[:, j] = squares(x, history[0, j])
        at[:] = 0
        return seen.argmin(axis=1)
    rows = np.arange(len(x))
    moved = displacements(history)[at, np.arange(k)]
    known = np.sqrt(seen.astype(float))
    low = known - moved - SLACK * (known + moved)
    high = (known + moved)[rows, own] * (1 + SLACK)
    low[rows, own] = np.inf
    open_ = np.flatnonzero((low <= high[:, None]).any(axis=1))
    if len(open_):
        mine = own[open_]
        seen[open_, mine] = squares(x[open_], history[-1][mine])
        at[open_, mine] = now
        high[open_] = np.sqrt(seen[open_, mine].astype(float)) * (1 + SLACK)
        for j in range(k):
            again = open_[low[open_, j] <= high[open_]]
            seen[again, j] = squares(x[again], history[-1, j])
            at[again, j] = now
        fresh = np.where(at[open_] == now, seen[open_], np.iinfo(np.int64).max)
        own = own.copy()
        own[open_] = fresh.argmin(axis=1)
    if final:
        old = np.flatnonzero(at[rows, own] != now)
        seen[old, own[old]] = squares(x[old], history[-1][own[old]])
        at[old, own[old]] = now
    return own


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = pa.array(np.arange(0, m.size + 1, m.shape[1]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), kind))


def _round(table: DataFrame, history: np.ndarray, final: bool) -> DataFrame:
    """One pass: ``cluster`` beside the one before (``was``), and the measurements."""
    k, dims, now = history.shape[1], history.shape[2], len(history) - 1

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column("vector"), dims)
            if now:
                was = b.column("cluster").to_numpy().astype(np.int64)
                seen, at = (_matrix(b.column(c), k).copy() for c in ("seen", "at"))
                measured = b.column("measured").to_numpy() + 0
            else:
                was = np.full(len(x), -1)
                seen, at = np.zeros((len(x), k), np.int64), np.full((len(x), k), -1, np.int32)
                measured = np.zeros(len(x), np.int64)
            before = at.copy()
            own = assign(x, was, seen, at, history, final)
            measured += (at != before).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column("rest"), b.column("vector"), pa.array(own, pa.int32()), pa.array(was, pa.int32()),
                 _lists(seen, pa.int64()), _lists(at, pa.int32()), pa.array(measured, pa.int64())],
                names=["rest", "vector", "cluster", "was", "seen", "at", "measured"])

    rest = table.schema["rest"].dataType.simpleString()
    return table.mapInArrow(step, f"rest {rest}, vector array<long>, cluster int, was int, seen array<long>, at array<int>, measured long")


def _changes(table: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """What the changed vectors add to each cluster's sums and count (they leave ``was``).
    Summed in every task first; the driver gets ``k * (dims + 1)`` numbers at most."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), object)
        for b in batches:
            x = _matrix(b.column("vector"), dims)
            x = np.concatenate([x, np.ones((len(x), 1), np.int64)], axis=1)
            if np.abs(x).max(initial=0) * max(1, len(x)) >= 2 ** 62:
                x = x.astype(object)
            for column, sign in (("cluster", 1), ("was", -1)):
                c = b.column(column).to_numpy()
                for j in np.unique(c[c >= 0]):
                    total[j] += sign * x[c == j].sum(axis=0).astype(object)
        j, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(j, pa.int32()), pa.array(i, pa.int32()), pa.array([str(v) for v in total[j, i]], pa.string())],
                                         names=["j", "i", "total"])

    parts = table.where("cluster <> was").select("vector", "cluster", "was").mapInArrow(step, "j int, i int, total string")
    out = np.zeros((k, dims + 1), object)
    for r in parts.groupBy("j", "i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        out[r.j, r.i] = int(r.total)
    return out[:, :-1], out[:, -1]


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, id_column: str = "vec_id", column: str = "embedding",
            dimensions: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """Clusters after ``rounds`` rounds: ``rest`` (the input's other columns), ``cluster``,
    ``distance`` (squared, to its centroid), ``cluster_inertia`` and ``inertia`` (distances
    summed over the cluster and over all), ``centroid`` (array of long) and ``measured``
    (exact distances this vector cost; plain rounds take ``k * (rounds + 1)``).

    The first centroids are the vectors with the ``k`` smallest SHA-256 of
    ``<seed>:<id>`` (ties: the smaller vector; a null id counts as empty).  A vector
    goes to the nearest centroid, ties to the smaller number; centroids become the
    floor of the mean, those without vectors stay.

    Defined cases: null vectors, other lengths, and null or non-finite components leave
    the row out; fewer vectors than ``k`` give fewer centroids; an empty table gives no
    row; repeated rows and ids each count and each come back; null ids stay; columns
    with the names of the outputs stay apart in ``rest``; a component of 2**52 or more
    after scaling, and a squared distance or inertia beyond a long, raise an error.
    """
    spark = vectors.sparkSession
    table = whole_vectors(vectors, column, dimensions, scale)
    name = F.coalesce(F.col(f"rest.`{id_column}`").cast("string"), F.lit(""))
    first = table.select("vector", F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("h")).orderBy("h", "vector").limit(k).collect()
    k = len(first)
    history = np.array([r.vector for r in first], np.int64).reshape(1, k, dimensions)
    sums, counts = np.zeros((k, dimensions), object), np.zeros(k, object)
    paths: list[str] = []
    for now in range(rounds + 1):
        if k:
            path = shared_path(spark, "llm", "clusters")
            _round(table, history, now == rounds).write.parquet(path)
            table = spark.read.parquet(path)
            paths.append(path)
            for old in paths[-3:-2]:
                discard(spark, old)
        if now == rounds or not k:
            break
        more, n = _changes(table, k, dimensions)
        sums, counts = sums + more, counts + n
        mean = [[s // n for s in row] if n else list(c) for row, n, c in zip(sums, counts, history[-1])]
        history = np.concatenate([history, np.array(mean, np.int64).reshape(1, k, dimensions)])
    if not k:
        rest = table.schema["rest"].dataType.simpleString()
        return spark.createDataFrame([], f"rest {rest}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>, measured long")
    out = table.select("rest", "cluster", F.get("seen", F.col("cluster")).alias("distance"), "measured")
    # One row a cluster: at most k of them, so the joined side is small at any input size.
    each = {r.cluster: int(r.s) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    ends = spark.createDataFrame([(j, s, sum(each.values()), [int(v) for v in history[-1, j]]) for j, s in each.items()],
                                 "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return out.join(F.broadcast(ends), "cluster").select("rest", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "measured")


def centroid_digest(centroid: Column) -> Column:
    """Lowercase hex SHA-256 of the components, as decimal integers joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda v: v.cast("string")), ","), 256)
