"""Centroid clustering against plain rounds in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newslake.llm import clustering


def lloyd(rows, k, rounds, seed=3):
    """Cluster and squared distance of every ``(id, integers)`` row, and the centroids."""
    order = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [list(v) for _, v in order[:k]]
    for now in range(rounds + 1):
        best = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs)) for _, v in rows]
        if now < rounds:
            for j in range(len(cs)):
                own = [v for (_, v), (_, b) in zip(rows, best) if b == j]
                if own:
                    cs[j] = [sum(col) // len(own) for col in zip(*own)]
    return [j for _, j in best], [d for d, _ in best], cs


def frame(spark, rows, kind="double"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)


def compared(spark, rows, k, rounds, dims, scale=1024, kind="double"):
    got = clustering.cluster(frame(spark, rows, kind), k=k, rounds=rounds, dimensions=dims, scale=scale).collect()
    whole = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
             if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    own, dist, cs = lloyd(whole, k, rounds)
    want = sorted(((i is None, i, j, d, tuple(cs[j])) for (i, _), j, d in zip(whole, own, dist)), key=str)
    assert sorted(((r.rest.vec_id is None, r.rest.vec_id, r.cluster, r.distance, tuple(r.centroid)) for r in got), key=str) == want
    for r in got:
        assert r.inertia == sum(dist)
        assert r.cluster_inertia == sum(d for j, d in zip(own, dist) if j == r.cluster)
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_rounds_and_measures_less(spark, seed):
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [x + r.gauss(0, 0.08) for x in r.choice(centres)]) for i in range(400)]
    got = compared(spark, rows, 5, 10, 6)
    assert sum(g.measured for g in got) < 0.7 * 5 * 11 * len(got)      # the bounds spare measurements


def test_ties_and_copies_on_a_small_grid(spark):
    r = random.Random(7)
    rows = [(i % 90, [float(r.randrange(0, 4)) for _ in range(2)]) for i in range(300)]
    compared(spark, rows, 6, 8, 2, scale=1)
    compared(spark, [(i, [0.5, -0.5]) for i in range(9)], 8, 4, 2)     # all alike: one cluster, empty ones stay


def test_odd_rows(spark):
    rows = [(1, [0.1, 0.2]), (2, None), (3, []), (4, [1.0]), (5, [None, 1.0]), (6, [float("nan"), 0.0]), (7, [float("inf"), 0.0]),
            (None, [0.3, 0.4]), (1, [0.1, 0.2]), (8, [-0.0001, 1.0])]
    assert len(compared(spark, rows, 8, 3, 2)) == 4
    assert clustering.cluster(frame(spark, [])).count() == 0
    assert clustering.cluster(frame(spark, [(1, [1.0])]), dimensions=2).columns[-1] == "measured"


def test_large_components_stay_exact_and_too_large_ones_raise(spark):
    rows = [(i, [float((-1) ** i * (2 ** 30 + i)), float(i)]) for i in range(12)]
    compared(spark, rows, 3, 4, 2, scale=1)
    with pytest.raises(Exception, match="component too large"):
        clustering.cluster(frame(spark, [(1, [1e30, 0.0])]), dimensions=2).count()


def test_columns_with_the_names_of_the_outputs(spark):
    df = frame(spark, [(i, [i / 10, 0.0]) for i in range(6)]).withColumn("cluster", F.lit("mine")).withColumn("rest", F.lit(1))
    got = clustering.cluster(df, k=2, rounds=2, dimensions=2)
    assert got.select("rest.cluster", "rest.rest").distinct().collect() == [("mine", 1)]
    assert {r.cluster for r in got.select("cluster").collect()} <= {0, 1}


def test_bounds_by_total_displacement():
    """A centroid that comes back leaves the bounds as tight as they were."""
    there = np.array([[[0, 0], [9, 0]], [[5, 0], [9, 0]], [[0, 0], [9, 0]]])
    assert clustering.displacements(there)[:, 0].tolist() == [0.0, 5.0, 0.0]
