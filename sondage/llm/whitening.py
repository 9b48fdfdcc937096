"""Whitening of embeddings by an incrementally updated eigendecomposition.

Every partition keeps the spectrum of the scatter of the vectors it has seen and updates it
by rank-one terms: the eigenvalues of ``diag(d) + rho * z z'`` are the roots of the secular
equation ``1 + rho * sum(z_i^2 / (d_i - x)) = 0``, found for all at once inside their
brackets; entries of z that vanish and eigenvalues that coincide are deflated first, and z
is computed anew from the roots so that the eigenvectors stay orthogonal. A block of
vectors is centred on its own mean and reduced by orthogonal factors to at most as many
rows as there are dimensions, with the same scatter; these rows, and the shift between the
block's mean and the partition's, are the rank-one terms. Spectra of partitions are
combined the same way: one spectrum's weighted eigenvectors are the other's updates.

The combined eigenvectors are the basis of a Rayleigh-Ritz step over all vectors: their
covariance in that basis is nearly diagonal, and its eigenvectors turn the basis into
those of the covariance to the precision of doubles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import kept_table

#: Sums of products are sent as whole multiples of this, so that their total does not depend on the order.
_UNIT = 2**40
_EPS = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Whitening:
    """``components`` returned at most; a component c becomes floor(scale * c) + shift;
    ``block``: vectors condensed at once; ``fan_in``: spectra combined by one task;
    ``no_variance``: an eigenvalue up to this share of the trace counts as none."""

    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    block: int = 1024
    fan_in: int = 16
    no_variance: float = 1e-13


# --- the spectrum of a scatter and its rank-one updates


def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z2 / (d - x)) for rising, distinct d and z2 > 0 of sum 1.

    Each is given by the number of its nearest pole and its distance from it, which keeps
    the differences to all poles exact. A step solves the equation in which the poles
    below and above are replaced by the two next to the root (with matching slopes); a
    step that would leave the bracket halves it instead.
    """
    n = len(d)
    above = np.append(d[1:], d[-1] + rho)
    middle = (above - d) / 2
    terms = z2 / (d[None, :] - (d + middle)[:, None])
    below_middle = 1 + rho * terms.sum(axis=1) >= 0  # the root lies in the lower half
    k = np.arange(n)
    origin = np.where(below_middle | (k == n - 1), k, k + 1)
    poles = d[None, :] - d[origin][:, None]
    low = np.where(origin == k, np.where(below_middle, 0, middle), -middle)
    high = np.where(origin == k, np.where(below_middle, middle, 2 * middle), 0.0)
    x = (low + high) / 2
    left = np.tril(np.ones((n, n), bool))
    a, b = d - d[origin], above - d[origin]  # poles next to the root
    for _ in range(60):
        gap = poles - x[:, None]
        term = rho * z2 / gap
        slope = term / gap
        f = 1 + term.sum(axis=1)
        size = 1 + np.abs(term).sum(axis=1)
        done = np.abs(f) <= 4 * _EPS * size
        low, high = np.where(f < 0, np.maximum(low, x), low), np.where(f >= 0, np.minimum(high, x), high)
        if done.all():
            break
        under, over = (slope * left).sum(axis=1), (slope * ~left).sum(axis=1)
        da, db = a - x, b - x
        p = (da + db) * f - da * db * (under + over)
        q = da * db * f
        c = f - da * under - db * over
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(done, x, np.where(inside, new, (low + high) / 2))
        if (high - low <= 2 * _EPS * np.abs(x)).all():
            break
    return origin, x


def rank_one(d: np.ndarray, u: np.ndarray, v: np.ndarray, rho: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Rising eigenvalues and eigenvectors of u diag(d) u' + rho * v v', for rho > 0."""
    z = u.T @ v
    norm2 = float(z @ z)
    rho *= norm2
    if rho <= 0 or not np.isfinite(rho):
        return d, u
    z = z / np.sqrt(norm2)
    tol = 8 * _EPS * max(abs(d[0]), abs(d[-1]), rho)
    u = u.copy()
    starts = np.flatnonzero(np.append(True, np.diff(d) > tol))
    for s, e in zip(starts, np.append(starts[1:], len(d)), strict=True):
        if e - s > 1 and np.abs(z[s : e - 1]).max() * rho > tol:  # coinciding eigenvalues: turn their space so that one entry of z is left
            h = z[s:e].copy()
            length = np.sqrt(h @ h)
            h[-1] += np.copysign(length, h[-1])
            h /= np.sqrt(h @ h)
            u[:, s:e] -= 2 * np.outer(u[:, s:e] @ h, h)
            z[s : e - 1], z[e - 1] = 0, -np.copysign(length, z[e - 1])
    keep = np.flatnonzero(np.abs(z) * rho > tol)
    if not len(keep):
        return d, u
    poles, w = d[keep], z[keep]
    if len(keep) > 1 and (np.diff(poles) <= 0).any():
        poles = poles + np.arange(len(poles)) * tol / len(poles)
    origin, x = secular_roots(poles, w * w / (w @ w), rho * float(w @ w))
    gap = (poles[origin][None, :] - poles[:, None]) + x[None, :]  # root j less pole i
    n = len(poles)
    other = poles[None, :] - poles[:, None]  # pole j less pole i
    below = np.tril(np.ones((n, n), bool), -1)
    ratio = np.ones((n, n))
    ratio[below] = gap[below] / other[below]
    if n > 1:
        upper = np.triu(np.ones((n, n - 1), bool))
        part = ratio[:, : n - 1]
        part[upper] = gap[:, : n - 1][upper] / other[:, 1:][upper]
        ratio[:, : n - 1] = part
    ratio[: n, n - 1] = gap[:, n - 1]
    exact = np.sqrt(np.abs(ratio.prod(axis=1))) * np.where(w < 0, -1.0, 1.0)
    with np.errstate(divide="ignore"):
        q = exact[:, None] / -gap
    at_pole = ~np.isfinite(q)
    if at_pole.any():
        q[:, at_pole.any(axis=0)] = 0
        q[at_pole] = 1
    q /= np.sqrt((q * q).sum(axis=0))
    u[:, keep] = u[:, keep] @ q
    out = d.copy()
    out[keep] = poles[origin] + x
    order = np.argsort(out, kind="stable")
    return out[order], u[:, order]


class Spectrum:
    """Count, mean, eigenvalues and eigenvectors of the scatter around the mean."""

    def __init__(self, size: int) -> None:
        self.n, self.mean, self.d, self.u = 0, np.zeros(size), np.zeros(size), np.eye(size)

    def _shifted(self, n: int, mean: np.ndarray) -> None:
        """The rank-one term of joining ``n`` vectors of another mean, and the new mean."""
        if self.n:
            gap = mean - self.mean
            self.d, self.u = rank_one(self.d, self.u, gap, self.n * n / (self.n + n))
            mean = self.mean + gap * (n / (self.n + n))
        self.n, self.mean = self.n + n, mean

    def add(self, x: np.ndarray) -> None:
        """Vectors, one a row."""
        if not len(x):
            return
        mean = x.mean(axis=0)
        centred = x - mean
        for row in np.linalg.qr(centred, mode="r") if len(x) > x.shape[1] else centred:
            self.d, self.u = rank_one(self.d, self.u, row)
        self._shifted(len(x), mean)

    def join(self, n: int, mean: np.ndarray, d: np.ndarray, u: np.ndarray) -> None:
        """Another spectrum, one of its weighted eigenvectors after the other."""
        for value, vector in zip(d, u.T, strict=True):
            if value > 0:
                self.d, self.u = rank_one(self.d, self.u, vector, float(value))
        self._shifted(n, mean)


# --- over tables


def kept_vectors(rows: DataFrame, vec_id: str, vector: str, p: Whitening) -> DataFrame:
    """vec_id and x (array of bigint) of the rows whose vector is not null and all finite."""
    right = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    whole = F.transform(vector, lambda c: F.floor(F.lit(float(p.scale)) * c.cast("double")) + F.lit(p.shift))
    return rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & right).select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _packed(key: int, s: Spectrum) -> pa.RecordBatch:
    lists = [pa.array([x.tolist()], pa.list_(pa.float64())) for x in (s.mean, s.d, s.u.ravel())]
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([s.n], pa.int64()), *lists], names=["part", "n", "mean", "d", "u"])


SPECTRUM = "part bigint, n bigint, mean array<double>, d array<double>, u array<double>"


def spectra(vectors: DataFrame, size: int, start: np.ndarray, p: Whitening) -> DataFrame:
    """One spectrum for each task; vectors count from ``start`` so that their means are small."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, task = Spectrum(size), TaskContext.get()
        for batch in batches:
            x = _matrix(batch, size) - start
            for k in range(0, len(x), p.block):
                s.add(x[k : k + p.block])
        if s.n:
            yield _packed(task.partitionId() if task else 0, s)

    return vectors.select("x").mapInArrow(update, SPECTRUM)


def combined(parts: DataFrame, size: int, p: Whitening) -> np.ndarray:
    """Eigenvectors of all spectra together, from the greatest eigenvalue down.

    They are joined ``fan_in`` at a time in rounds that are written to the shared folder;
    one row of the last comes to the driver.
    """

    def join(group: pa.Table) -> pa.Table:
        s = Spectrum(size)
        group = group.sort_by("part")
        for n, mean, d, u in zip(*(group.column(c).to_pylist() for c in ("n", "mean", "d", "u")), strict=True):
            s.join(n, np.array(mean), np.array(d), np.array(u).reshape(size, size))
        return pa.Table.from_batches([_packed(group.column("part")[0].as_py() // p.fan_in, s)])

    parts = kept_table(parts, "spectra")
    most = parts.agg(F.max("part")).first()[0]
    while True:
        group = F.floor(F.col("part") / p.fan_in)
        parts = kept_table(parts.withColumn("group", group).groupBy("group").applyInArrow(lambda t: join(t.drop(["group"])), SPECTRUM), "spectra")
        most //= p.fan_in
        if most == 0:
            break
    row = parts.first()
    return np.array(row["u"]).reshape(size, size)[:, ::-1].copy()


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """(n * x - total) / n, the numerator in whole numbers."""
    s = np.array(total, object)
    if n * max(int(np.abs(x).max(initial=0)), 1) < 2**62:
        return (n * x - s.astype(np.int64)) / n
    return ((n * x.astype(object) - s) / n).astype(float)


def covariance(vectors: DataFrame, basis: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """Covariance of the centred vectors in the basis, whose vectors are columns.

    A task adds up its products; what it sends are whole multiples of a small unit, so the
    result is the same in whatever order tasks end.
    """
    size, width = basis.shape
    sent = vectors.sparkSession.sparkContext.broadcast((basis, total))
    rows, columns = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, s = sent.value
        h, mean = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            y = centred(_matrix(batch, size), n, s) @ base
            h += y.T @ y
            mean += y.sum(axis=0)
        at = np.concatenate([rows * width + columns, width * width + np.arange(width)])
        values = [Decimal(round(float(v) * _UNIT)) for v in np.concatenate([h[rows, columns], mean])]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(values, pa.decimal128(38, 0))], names=["at", "value"])

    summed = vectors.select("x").mapInArrow(products, "at bigint, value decimal(38,0)").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.zeros(width * width + width)
    for r in summed.collect():
        flat[r["at"]] = int(r["value"]) / _UNIT / n
    h, mean = np.zeros((width, width)), flat[width * width :]
    h[rows, columns] = flat[rows * width + columns]
    h = np.where(h == 0, h.T, h)
    return h - np.outer(mean, mean)


def exact_deviation(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over components of (n * x - total) ** 2 in whole numbers; None where no long holds it."""
    s = np.array(total, object)
    gap = n * x.astype(object) - s
    if max(abs(int(gap.max())), abs(int(gap.min()))) < int((2**62 / x.shape[1]) ** 0.5):
        gap = gap.astype(np.int64)
    return [int(v) if v < 2**63 else None for v in (gap * gap).sum(axis=1)]


def whiten(rows: DataFrame, params: Whitening = Whitening(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each vector and component.

    Rows whose vector is null or empty or holds null or non-finite entries are left out, and
    so are those whose number of entries is not the commonest among the rest (of equally
    common ones the greater). Each entry c becomes floor(scale * c) + shift; covariances are
    over all remaining vectors, with divisor n. Components are numbered from 1 by falling
    eigenvalue; one without variance has whitened 0 and does not count for identity_error,
    the greatest entry of the whitened vectors' covariance less the identity. deviation is
    null where no long holds it. Repeated rows, equal or null ids are vectors of their own.
    No rows, no result; columns beyond the two named are not read.
    """
    p = params
    kind = dict(rows.select(F.col(vec_id).alias("vec_id")).dtypes)["vec_id"]
    ddl = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    vectors = kept_vectors(rows, vec_id, vector, p)
    sizes = vectors.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], ddl)
    size, n = sizes["size"], sizes["n"]
    vectors = kept_table(vectors.where(F.size("x") == size), "vectors")

    def place(k: int) -> Column:
        return F.sum(F.element_at("x", k + 1).cast("decimal(38,0)"))

    total = [int(v) for v in vectors.agg(*[place(k).alias(f"s{k}") for k in range(size)]).first()]
    start = np.array([t // n for t in total], np.int64)
    basis = combined(spectra(vectors, size, start, p), size, p)
    basis = np.linalg.qr(basis)[0]
    values, turn = np.linalg.eigh(covariance(vectors, basis, n, total))
    values, vectors_of = values[::-1], basis @ turn[:, ::-1]
    trace = float(values.sum())
    most = min(p.components, size)
    e, base = np.maximum(values[:most], 0), vectors_of[:, :most]
    some = e > p.no_variance * max(trace, 0)
    scaled = base * np.where(some, 1 / np.sqrt(np.where(some, e, 1)), 0)
    error = float(np.abs((covariance(vectors, scaled, n, total) - np.eye(most))[np.ix_(some, some)]).max(initial=0))
    explained = e / trace if trace > 0 else np.zeros(most)
    sent = vectors.sparkSession.sparkContext.broadcast((scaled, explained, total, error))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by, part, s, wrong = sent.value
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                piece = batch.slice(k, 1000)
                x = _matrix(piece, size)
                m = len(x)
                each = np.repeat(np.arange(m), most)
                deviation = pa.array(exact_deviation(x, n, s), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, most + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * most, n, np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array((centred(x, n, s) @ by).ravel()),
                        pa.array(np.tile(part, m)),
                        pa.array(np.full(m * most, wrong)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.mapInArrow(project, ddl)
