"""Exact top-k inner products over an impact-ordered index, score at a time.

Every component of every vector is a posting; postings lie in segments of one
quantised value.  A segment's impact for a query is what it adds more than the mean
of its component.  A query takes segments in order of falling impact, a round of
them at once, and adds to its accumulators how far they exceed the next segment of
their component.  That bounds every score from above; rounds end when the bounds
leave few vectors that can still be among the best, and these are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in an index block, queries in a query block, levels of a component's value.
BLOCK = 8192
QUERY_BLOCK = 1024
LEVELS = 64
#: Rounds that take all segments, each the same number of postings.
ROUNDS = 8
#: Largest component and score: what a long holds.
MOST = (1 << 63) - 1


class ImpactIndex:
    """Postings of one block of integer vectors by component and quantised value.

    Sums are taken in 64 bits where they must fit, else in integers of any size.
    ``taken`` and ``scored`` count the postings and vectors that searches have read.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.copies = ids[order], vectors[order], copies[order]
        if self.vectors.dtype != object and np.abs(self.vectors).max() >= 1 << 60:
            self.vectors = self.vectors.astype(object)
        self.low, self.high = self.vectors.min(0), self.vectors.max(0)
        self.step = (self.high - self.low) // LEVELS + 1
        level = ((self.vectors - self.low) // self.step).astype(np.int64)
        self.most = np.maximum(abs(self.low), abs(self.high)).astype(float)
        # The most that a query can add to a sum for each unit of a component.
        self.reach = self.most * 2 + self.step.astype(float) * 2
        self._wide: ImpactIndex | None = None
        self._floats: np.ndarray | None = None
        self.postings = np.argsort(level, axis=0, kind="stable").T.copy()
        self.starts = np.stack([np.searchsorted(x, np.arange(LEVELS + 1)) for x in np.sort(level, axis=0).T])
        self.filled = np.diff(self.starts, axis=1)
        # The least that a value of each level is above the component's lowest, or below its highest.
        lv, step = np.arange(LEVELS), self.step[:, None]
        span = (self.high - self.low)[:, None]
        self.rise, self.fall = lv * step, np.maximum(span + 1 - (lv + 1) * step, 0)
        self.mean = self.vectors.astype(float).mean(0)
        self.first = ROUNDS // 2
        self.taken = self.scored = 0

    def _scores(self, pick: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact scores; those beyond a long are the largest long, or its opposite."""
        self.scored += len(pick)
        if self.vectors.dtype == object:
            return np.array([max(-MOST, min(MOST, x)) for x in (self.vectors[pick] @ query).tolist()], np.int64)
        if np.abs(query.astype(float)) @ self.most >= float(1 << 52):
            return self.vectors[pick] @ query
        if self._floats is None:  # every sum is a whole number that a double holds
            self._floats = self.vectors.astype(float)
        return (self._floats[pick] @ query.astype(float)).astype(np.int64)

    def search(self, query: np.ndarray, k: int, own: int, floor: int = -MOST) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best (ties: smaller id), copies repeated, without
        the id ``own`` and scores below ``floor``."""
        if self.vectors.dtype != object and np.abs(query.astype(float)) @ self.reach >= float(1 << 62):
            if self._wide is None:
                self._wide = ImpactIndex(self.ids, self.vectors.astype(object), self.copies)
            return self._wide.search(query, k, own, floor)
        n = len(self.ids)
        query = query.astype(self.vectors.dtype)
        pick = np.flatnonzero(self.ids != own)
        if len(pick) > k:
            pick = self._possible(query, k, own, len(pick), floor)
        score = self._scores(pick, query)
        best = np.lexsort((self.ids[pick], -score))[:k]
        best = best[score[best] >= floor]
        best = np.repeat(best, np.minimum(self.copies[pick][best], k))[:k]
        return self.ids[pick][best], score[best]

    def _possible(self, query: np.ndarray, k: int, own: int, others: int, floor: int) -> np.ndarray:
        """Places of the vectors, all ``others`` without the id ``own``, that are not proved
        to be below ``floor`` or the ``k`` best."""
        n, dims = self.vectors.shape
        up, size = query >= 0, abs(query)
        impact = np.where(up[:, None], self.rise, self.fall) * size[:, None]
        above = impact.astype(float) - (size * np.where(up, self.mean - self.low, self.high - self.mean)).astype(float)[:, None]
        order = np.argsort(-above, axis=None)
        held = np.cumsum(self.filled.ravel()[order])
        # Accumulators start here; a posting may add less than a step more than its segment's least.
        base = int((query * np.where(up, self.low, self.high)).sum() + (size * (self.step - 1)).sum())
        round_ = self.first
        while True:
            last = order[np.searchsorted(held, n * dims * round_ // ROUNDS)] if round_ < ROUNDS else order[-1]
            met = above >= above.ravel()[last]
            # Of each component, a vector that is not met yet may gain the next segment's impact.
            rest = np.where(met | (self.filled == 0), 0, impact).max(1)
            gain = np.repeat((impact - rest[:, None])[met], self.filled[met])
            acc = np.zeros(n, self.vectors.dtype)
            levels, done = met.sum(1), 0
            for d in np.flatnonzero(levels).tolist():
                first = LEVELS - levels[d] if up[d] else 0
                places = self.postings[d, self.starts[d, first]:self.starts[d, first + levels[d]]]
                np.add.at(acc, places, gain[done:done + len(places)])
                done += len(places)
            self.taken += done
            top = base + int(rest.sum())
            acc[self.ids == own] = -1  # others have 0 at least
            lead = min(others, 4 * k)
            leaders = np.argpartition(acc, n - lead)[n - lead:]
            known = max(floor, int(np.partition(self._scores(leaders, query), lead - k)[lead - k]))
            if known <= -MOST:  # scores beyond a long are equal
                return np.flatnonzero(self.ids != own)
            pick = np.flatnonzero(acc >= max(0, known - top))
            if met.all() or len(pick) <= max(4 * k, n // 4):
                break
            round_ += 1
        # Queries of a block are alike: the next one starts where this one ended.
        self.first = max(1, round_ - (len(pick) < n // 16))
        return pick


def to_integers(embedding, scale: int):
    """floor(scale * x) of each component as long (beyond a long: the largest or, for
    negative ones, its opposite); null for a vector that is null or holds null or
    non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    whole = F.transform(embedding, lambda x: F.greatest(F.lit(-MOST), F.floor(x.cast("double") * scale).cast("long")))
    return F.when(embedding.isNotNull() & ~bad, whole)


def _pack(part: pd.DataFrame) -> pd.DataFrame:
    """One row of a block: ids, copies and components of its vectors as bytes.  The order
    depends on the rows alone, so a block that is made again is the same."""
    m = np.zeros((len(part), max(1, *map(len, part["v"]))), np.int64)
    for i, x in enumerate(part["v"]):
        m[i, :len(x)] = x
    ids, copies = part["id"].to_numpy(np.int64), part["copies"].to_numpy(np.int64)
    order = np.lexsort((*m.T[::-1], ids))
    wide = bool(np.abs(m).max() >= 1 << 31)
    return pd.DataFrame({"part": [part["part"].iloc[0]], "ids": [ids[order].tobytes()], "copies": [copies[order].tobytes()],
                         "wide": [wide], "v": [m[order].astype(np.int64 if wide else np.int32).tobytes()]})


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row.ids, np.int64)
    m = np.frombuffer(row.v, np.int64 if row.wide else np.int32).astype(np.int64)
    return ids, np.frombuffer(row.copies, np.int64), m.reshape(len(ids), -1)


def _widened(m: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dims - m.shape[1])))


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
                scale: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best of ``vectors`` for each row of ``queries``.

    Score: inner product of floor(scale * x) components; ties go to the smaller id;
    vectors with the query's own id are no candidates.  Scores are exact in a long; one
    beyond it is the largest long, or its opposite, and ranks as such.  Null ids, null
    vectors and such with null or non-finite components take no part; a shorter vector
    counts as filled up with zeros.  Rows that repeat an id are candidates, and as
    queries have lists, of their own; rows alike in id and vector are one vector with
    its number of copies until the result.  Empty tables give no rows; other columns
    are not read.

    Blocks of vectors (by hash) are the index.  Blocks of queries, the smaller side, go
    to each of them: a task reads a block's index once, then its queries one block
    after another, and keeps each query's ``k`` best scores, so that later blocks are held
    against them.  Every meeting yields the ``k`` best not below these, and the best of
    all are the result.
    """
    def packed(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
        ints = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), to_integers(F.col(f"`{vector_col}`").cast("array<double>"), scale).alias("v")) \
            .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        n = max(1, -(-ints.count() // size))
        # The vector is part of the key, so repeats of an id are spread too.
        counted = ints.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")).groupBy("part", "id", "v").agg(F.count("*").alias("copies"))
        return counted.groupBy("part").applyInPandas(_pack, "part int, ids binary, copies binary, wide boolean, v binary"), n

    index, n_index = packed(vectors, BLOCK)
    asked, _ = packed(queries, QUERY_BLOCK)
    places = F.sequence(F.lit(0), F.lit(n_index - 1))
    rows = index.select(F.col("part").alias("block"), F.lit(-1).alias("qpart"), "ids", "copies", "wide", "v").unionByName(
        asked.select(F.explode(places).alias("block"), F.col("part").alias("qpart"), "ids", "copies", "wide", "v"))

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, index_ = None, None
        tops: dict[int, np.ndarray] = {}  # of a query block: its queries' k best scores so far, least first
        for part in parts:
            for r in part.itertuples(index=False):
                ids, copies, m = _unpack(r)
                if r.qpart < 0:
                    block, index_ = r.block, ImpactIndex(ids, m, copies)
                    continue
                if r.block != block:  # no vector has this block's hash
                    continue
                dims = max(m.shape[1], index_.vectors.shape[1])
                if index_.vectors.shape[1] < dims:
                    index_ = ImpactIndex(index_.ids, _widened(index_.vectors, dims), index_.copies)
                top = tops.setdefault(r.qpart, np.full((len(ids), k), -MOST))
                found = []
                for pos, (qid, x) in enumerate(zip(ids.tolist(), _widened(m, dims), strict=True)):
                    best, score = index_.search(x, k, qid, int(top[pos, 0]))
                    top[pos] = np.sort(np.concatenate([top[pos], score]))[-k:]
                    found.append((best, score))
                pos = np.repeat(np.arange(len(ids)), [len(best) for best, _ in found])
                yield pd.DataFrame({"qpart": r.qpart, "pos": pos, "times": copies[pos], "query_id": ids[pos],
                                    "vec_id": np.concatenate([best for best, _ in found]), "score": np.concatenate([score for _, score in found])})

    found = rows.repartition("block").sortWithinPartitions("block", "qpart").select("block", "qpart", "ids", "copies", "wide", "v") \
        .mapInPandas(search, "qpart int, pos int, times long, query_id long, vec_id long, score long")
    best = Window.partitionBy("qpart", "pos").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("col")
