"""Whitening: rank-one updates against dense decompositions, whole results against a plain version, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sondage.llm.whitening import Spectrum, Whitening, rank_one, secular_roots, whiten

SF = "/root/testdata/sf0.01"


def near(s, x):
    a = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))
    scale = max(np.abs(a).max(), 1e-300)
    assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0), atol=1e-9 * max(1, np.abs(x).max()))
    assert np.abs((s.u * s.d) @ s.u.T - a).max() / scale < 1e-12
    assert np.abs(s.u.T @ s.u - np.eye(len(s.d))).max() < 1e-11
    assert (np.diff(s.d) >= -1e-12 * scale).all()


@pytest.mark.parametrize("size", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["plain", "scaled", "copies", "few", "axes"])
def test_updates_give_the_scatter(size, kind):
    rng = np.random.default_rng(size)
    x = rng.normal(size=(150, size))
    if kind == "scaled":
        x *= 10.0 ** rng.integers(-3, 4, size)
    elif kind == "copies":
        x[::2] = x[0]
    elif kind == "few":
        x = np.repeat(x[:3], 50, axis=0)  # most eigenvalues are zero and coincide
    elif kind == "axes":
        x = np.concatenate([np.eye(size), -np.eye(size)] * 4)  # all eigenvalues coincide
    for block in (1, 7, 1000):
        s = Spectrum(size)
        for k in range(0, len(x), block):
            s.add(x[k : k + block])
        near(s, x)
    a, b = Spectrum(size), Spectrum(size)
    a.add(x[:40]), b.add(x[40:])
    a.join(b.n, b.mean, b.d, b.u)
    near(a, x)


def test_secular_roots_interlace_and_solve():
    d, z2, rho = np.array([0.0, 1.0, 1.0 + 1e-9, 5.0]), np.array([0.25, 1e-12, 0.25, 0.5]), 2.0
    z2 = z2 / z2.sum()
    origin, x = secular_roots(d, z2, rho)
    found = d[origin] + x
    assert (found >= d).all() and (found[:-1] <= d[1:]).all() and found[-1] <= d[-1] + rho
    wanted = np.linalg.eigvalsh(np.diag(d) + rho * np.outer(np.sqrt(z2), np.sqrt(z2)))
    assert np.allclose(found, wanted, atol=1e-14)


def test_a_vanishing_update_changes_nothing():
    d, u = np.array([1.0, 2.0]), np.eye(2)
    assert rank_one(d, u, np.zeros(2))[0] is d
    assert np.allclose(rank_one(d, u, np.array([0.0, 1e-30]))[0], d)


def plain(rows, p):
    """Covariance in whole numbers, one dense decomposition; None without rows."""
    kept = [(i, [math.floor(p.scale * float(c)) + p.shift for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    if not sizes:
        return []
    size = max(set(sizes), key=lambda s: (sizes.count(s), s))
    kept = [(i, v) for i, v in kept if len(v) == size]
    n, total = len(kept), [sum(v[k] for _, v in kept) for k in range(size)]
    gap = [[n * x - s for x, s in zip(v, total, strict=True)] for _, v in kept]
    cov = np.array([[sum(g[a] * g[b] for g in gap) / n**3 for b in range(size)] for a in range(size)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for (i, _), g in zip(kept, gap, strict=True):
        for k in range(min(p.components, size)):
            w = float(np.array(g) / n @ u[:, k] / math.sqrt(e[k])) if e[k] > 1e-12 * max(e.sum(), 0) else 0.0
            out.append((i, k + 1, n, sum(x * x for x in g), w, e[k] / e.sum() if e.sum() > 0 else 0.0))
    return out


def same(got, wanted):
    assert sorted((repr(r["vec_id"]), r["component"], r["n"], r["deviation"]) for r in got) == sorted((repr(w[0]), *w[1:4]) for w in wanted)
    for k in {w[1] for w in wanted}:
        mine = sorted((repr(r["vec_id"]), r["deviation"], abs(r["whitened"]), r["whitened"], r["explained"]) for r in got if r["component"] == k)
        his = sorted((repr(w[0]), w[3], abs(w[4]), w[4], w[5]) for w in wanted if w[1] == k)
        assert np.allclose([m[2] for m in mine], [h[2] for h in his], atol=1e-7)
        assert np.allclose([m[4] for m in mine], [h[4] for h in his], rtol=1e-9, atol=1e-12)
        a, b = np.array([m[3] for m in mine]), np.array([h[3] for h in his])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-6  # one sign for all rows


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")


def test_whole_result_against_the_plain_version(spark):
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.normal(size=(10, 10)))[0]
    x = rng.normal(size=(240, 10)) * np.arange(1, 11) @ turn + 3
    rows = list(enumerate(x.tolist()))
    p = Whitening(block=16, fan_in=2)
    got = whiten(embeddings(spark, rows).repartition(6), p).collect()
    same(got, plain(rows, p))
    assert got[0]["identity_error"] < 1e-10 and len({r["identity_error"] for r in got}) == 1


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 2.0]), (1, [0.5, 2.0]), (None, [1.0, 0.0]), (2, None), (3, []), (4, [1.0, None]), (5, [nan, 1.0]), (6, [1.0, inf]), (7, [1.0, 2.0, 3.0]), (8, [-3.0, 0.25])]
    p = Whitening(components=2)
    same(whiten(embeddings(spark, rows), p).collect(), plain(rows, p))
    clash = embeddings(spark, rows)
    for c in ("n", "x", "part", "whitened"):
        clash = clash.withColumn(c, F.lit("clash"))
    same(whiten(clash, p).collect(), plain(rows, p))
    none = whiten(embeddings(spark, rows).where("vec_id = 2"), p)
    assert none.count() == 0 and none.columns == whiten(embeddings(spark, rows), p).columns
    alone = whiten(embeddings(spark, rows[:2]), p).collect()  # no variance at all
    assert {(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone} == {(0, 0.0, 0.0, 0.0)}


def test_vectors_in_a_plane_have_two_components_and_no_more(spark):
    rng = np.random.default_rng(9)
    flat = [(k, [float(a), float(b), float(a)]) for k, (a, b) in enumerate(rng.integers(-5, 6, (60, 2)).tolist())]
    got = whiten(embeddings(spark, flat)).collect()
    assert {r["whitened"] for r in got if r["component"] == 3} == {0.0}
    assert got[0]["identity_error"] < 1e-10


def test_registered_query_on_all_embeddings(spark):
    from sondage.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op12_whitening"](spark, SF).collect()
    same(got, plain(rows, Whitening()))
    assert got[0]["identity_error"] < 1e-10
