"""Clusters: whole result against plain Lloyd rounds, Hilbert order, box bounds, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondage.llm import centroid_clusters as cc
from sondage.llm.centroid_clusters import Clusters, cluster


def plain(rows, p):
    """Every distance of every vector in every round, in Python's whole numbers."""
    kept = [(i, [math.floor(p.scale * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == p.size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{p.salt}{r[0]}".encode()).hexdigest(), r[1]))[: p.count]
    centroids = [v for _, v in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(p.rounds if kept else 0):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[k]) for x in zip(*groups[k], strict=True)] if k in groups else c for k, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = {k: sum(d for _, c, d in found if c == k) for k in range(len(centroids))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, own[c], sum(own.values()), digest[c]) for i, c, d in found), key=repr)


def got(frame, p):
    return sorted(map(tuple, cluster(frame, p).collect()), key=repr)


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


@pytest.mark.parametrize("block", [1, 7, 256])
def test_whole_result_against_plain_rounds(spark, block):
    rng = np.random.default_rng(3)
    p = Clusters(size=5, count=4, rounds=6, block=block)
    centres = rng.normal(size=(4, 5))
    rows = [(k, (centres[k % 4] + 0.1 * rng.normal(size=5)).tolist()) for k in range(300)]
    assert got(embeddings(spark, rows).repartition(5), p) == plain(rows, p)


def test_odd_vectors_ties_and_repeats(spark):
    p = Clusters(size=2, count=3, rounds=4, block=4)
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [nan, 0.0]), (7, [0.0, -inf]), (8, [0.0, 1.0, 2.0])]
    rows += [(None, [-1.0, 0.25]), (9, [-0.5, 0.5]), (10, [0.0, 0.5]), (11, [0.0, 0.5]), (12, [3.0, -2.0])]
    assert got(embeddings(spark, rows), p) == plain(rows, p)
    odd = embeddings(spark, rows).withColumn("cluster", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("v", F.lit(None).cast("int"))
    assert got(odd, p) == plain(rows, p)
    assert got(embeddings(spark, rows).where("vec_id = 2"), p) == []
    assert got(embeddings(spark, rows).where("false"), p) == []
    assert got(embeddings(spark, rows[:1]), p) == plain(rows[:1], p)  # fewer rows than centroids


def test_a_third_of_all_rows_are_one_vector_over_several_blocks(spark):
    rng = np.random.default_rng(4)
    p = Clusters(size=4, count=4, rounds=3, block=16)
    rows = [(k, [0.25] * 4 if k % 3 == 0 else rng.normal(size=4).tolist()) for k in range(600)]
    assert got(embeddings(spark, rows), p) == plain(rows, p)


def test_large_components_stay_exact_and_too_large_ones_are_refused(spark):
    p = Clusters(size=2, count=2, rounds=2, scale=1)
    rows = [(k, [float((k * 7919) % 1000 + 60_000_000), -60_000_000.0 + k]) for k in range(20)]
    assert got(embeddings(spark, rows), p) == plain(rows, p)
    with pytest.raises(ValueError):
        cluster(embeddings(spark, [(1, [1e30, 0.0])]), p)


def test_hilbert_order_visits_every_cell_by_steps_of_one():
    for axes, bits in [(2, 3), (3, 2), (4, 2)]:
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = cc.hilbert_keys(cells, bits)
        assert len(set(keys)) == len(cells)
        walk = cells[np.argsort(np.array([int.from_bytes(k) for k in keys]))]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_box_bounds_never_lose_the_nearest_and_leave_some_out():
    rng = np.random.default_rng(5)
    fewer = 0
    for _ in range(300):
        v = (rng.normal(size=(20, 3)) * rng.choice([1, 30]) + rng.normal(size=3) * 50).astype(np.int64)
        c = (rng.normal(size=(6, 3)) * 60).astype(np.int64)
        all_d = cc.squared(v, c)
        may = cc.candidates(v.min(axis=0), v.max(axis=0), c)
        fewer += len(may) < len(c)
        best, d = cc.assign(v, v.min(axis=0), v.max(axis=0), c)
        assert (best == all_d.argmin(axis=1)).all() and (d == all_d.min(axis=1)).all()
    assert fewer > 100
