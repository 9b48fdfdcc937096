"""Exact centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors of whole numbers are put in the order of a Hilbert curve and written once as
blocks: a matrix of vectors with the least and greatest value of each component (its box)
and its sums. In a round, the distances from a centroid to the nearest and the farthest
point of a box bound those to all its vectors; a centroid whose nearest point is farther
than some other's farthest point can't win a vector of the block and is left out. A block
with one candidate is counted by its stored sums, the others compare their vectors with
their candidates. All distances and sums are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondage.llm.texts import kept_table

#: Components below this in size have products that sum exactly in doubles; twice the square of LARGEST times the number of components fits 63 bits.
EXACT_IN_DOUBLES = 1 << 22
LARGEST = 1 << 27


@dataclass(frozen=True)
class Clusters:
    """``size``: components of a vector; ``count``: centroids; ``scale``: a component x
    becomes floor(scale * x); ``salt``: text before the id whose hash picks the first
    centroids; ``bits``: of each component in the Hilbert order; ``block``: vectors of a
    block at most."""

    size: int = 64
    count: int = 8
    rounds: int = 10
    scale: int = 1024
    salt: str = "3:"
    bits: int = 4
    block: int = 256


def whole_vectors(rows: DataFrame, p: Clusters, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (array of bigint) of the rows with exactly ``size`` finite components."""
    # written out by place, so that the arithmetic stays in generated code
    parts = [F.get(vector, F.lit(k)).cast("double") for k in range(p.size)]
    right = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where((F.size(vector) == p.size) & right).select(F.col(vec_id).alias("vec_id"), F.array(*[F.floor(F.lit(float(p.scale)) * x) for x in parts]).alias("v"))


def hilbert_keys(values: np.ndarray, bits: int) -> list[bytes]:
    """Place of each row of ``values`` (whole numbers of ``bits`` bits) on the Hilbert curve, as bytes that sort like it.

    The axes are turned into the transposed index by exchanging and inverting low bits from
    the highest bit down and then Gray-coding, for all rows at once.
    """
    x = values.astype(np.uint32).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = np.uint32(q - 1)
        for k in range(n):
            invert = (x[k] & np.uint32(q)) != 0
            swap = np.where(invert, np.uint32(0), (x[0] ^ x[k]) & low)
            x[0] ^= np.where(invert, low, swap)
            x[k] ^= swap
        q >>= 1
    for k in range(1, n):
        x[k] ^= x[k - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & np.uint32(q)) != 0, np.uint32(q - 1), np.uint32(0))
        q >>= 1
    x ^= turn
    planes = np.stack([(x >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)])  # bit, axis, row
    packed = np.packbits(planes.reshape(bits * n, -1).astype(np.uint8), axis=0).T
    return [row.tobytes() for row in np.ascontiguousarray(packed)]


def _matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def ordered(vectors: DataFrame, p: Clusters) -> DataFrame:
    """vec_id, v and key; refuses components too large for exact distances in 63 bits."""
    each = [F.element_at("v", k + 1) for k in range(p.size)]
    ends = vectors.agg(F.array(*map(F.min, each)).alias("low"), F.array(*map(F.max, each)).alias("high")).first()
    low = np.array(ends["low"] if ends["low"][0] is not None else [0] * p.size, float)
    high = np.array(ends["high"] if ends["high"][0] is not None else [0] * p.size, float)
    if max(abs(low).max(), abs(high).max()) > LARGEST // p.size**0.5:
        raise ValueError("components are too large: squared distances would not fit a long")
    step = np.maximum(high - low, 1) / ((1 << p.bits) - 0.5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.clip((_matrix(batch, "v", p.size) - low) / step, 0, (1 << p.bits) - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(values, p.bits), pa.binary())], names=["vec_id", "v", "key"])

    return vectors.mapInArrow(place, f"vec_id {dict(vectors.dtypes)['vec_id']}, v array<bigint>, key binary")


def blocks(vectors: DataFrame, p: Clusters) -> DataFrame:
    """One row per block in Hilbert order: ids, v (matrix, row by row), low, high, sums, n.

    Vectors are dealt out by ranges of the key and, within one key, of a hash of the id:
    equal vectors, however many, spread over tasks.
    """
    kind = dict(vectors.dtypes)["vec_id"]
    tie = F.xxhash64("vec_id")
    dealt = ordered(vectors, p).withColumn("tie", tie).repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("vec_id", "v")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, p.block):
                part = batch.slice(k, p.block)
                v = _matrix(part, "v", p.size)
                lists = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (v.ravel(), v.min(axis=0), v.max(axis=0), v.sum(axis=0))]
                ids = pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.concat_arrays([part.column("vec_id")]))
                yield pa.RecordBatch.from_arrays([ids, *lists, pa.array([len(v)], pa.int64())], names=["ids", "v", "low", "high", "sums", "n"])

    many = "array<bigint>"
    return dealt.mapInArrow(gather, f"ids array<{kind}>, v {many}, low {many}, high {many}, sums {many}, n bigint")


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of v to all rows of c, exact, as long."""
    if max(np.abs(v).max(initial=0), np.abs(c).max(initial=0)) < EXACT_IN_DOUBLES:
        x, y = v.astype(float), c.astype(float)  # sums of products stay below 2 ** 53 and so are exact
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ y.T) + (y * y).sum(axis=1)).astype(np.int64)
    return np.stack([((v - row) ** 2).sum(axis=1) for row in c], axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector inside the box, in rising order."""
    nearest = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    farthest = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    nearest, farthest = (nearest**2).sum(axis=1), (farthest**2).sum(axis=1)
    return np.flatnonzero(nearest <= farthest.min())


def assign(v: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of each row and the squared distance; of equal ones the smaller number."""
    may = candidates(low, high, centroids)
    d = squared(v, centroids[may])
    best = d.argmin(axis=1)
    return may[best], d[np.arange(len(v)), best]


def _box(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, ...]:
    return tuple(batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("low", "high", "sums"))


def sums_of(made: DataFrame, centroids: np.ndarray, p: Clusters, distances: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of each cluster, their sums by component and, if asked for, their summed distances.

    A task adds its blocks up and sends one row for each cluster and component.
    """
    sent = made.sparkSession.sparkContext.broadcast(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = sent.value
        n, inertia, sums = np.zeros(len(c), np.int64), np.zeros(len(c), np.int64), np.zeros((len(c), p.size), np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                low, high, total = _box(batch, k)
                may = candidates(low, high, c)
                if len(may) == 1 and not distances:
                    n[may[0]] += batch.column("n")[k].as_py()
                    sums[may[0]] += total
                    continue
                v = batch.column("v")[k].values.to_numpy(zero_copy_only=False).reshape(-1, p.size)
                best, d = assign(v, low, high, c)
                n += np.bincount(best, minlength=len(c))
                for j in may:
                    sums[j] += v[best == j].sum(axis=0)
                    inertia[j] += d[best == j].sum()
        cluster, component = np.divmod(np.arange(len(c) * (p.size + 2)), p.size + 2)
        yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(component), pa.array(np.column_stack([sums, n, inertia]).ravel())], names=["cluster", "component", "total"])

    columns = ["low", "high", "sums", "n", "v"]
    rows = made.select(*columns).mapInArrow(add, "cluster bigint, component bigint, total bigint")
    # summed as decimals: inertia over all rows may pass a long
    found = rows.groupBy("cluster", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    table = np.zeros((len(centroids), p.size + 2), object)
    for r in found:
        table[r["cluster"], r["component"]] = int(r["total"])
    return table[:, p.size], table[:, : p.size], table[:, p.size + 1]


def first_centroids(vectors: DataFrame, p: Clusters) -> np.ndarray:
    """The vectors of the smallest hashes of salt and id, in that order; rows with a null id come last, equal ids by vector."""
    hashed = F.sha2(F.concat(F.lit(p.salt), F.col("vec_id").cast("string")), 256)
    picked = vectors.select(hashed.alias("hash"), "v").orderBy(F.asc_nulls_last("hash"), "v").limit(p.count).collect()
    return np.array([r["v"] for r in picked], np.int64).reshape(-1, p.size)


def cluster(rows: DataFrame, params: Clusters = Clusters(), vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 for each kept row.

    Rows whose vector is null, has another number of components or a null or non-finite one
    are left out. Each component x becomes floor(scale * x); the first ``count`` centroids
    are the vectors of smallest sha256 of salt and id (fewer if fewer rows are kept); each
    of ``rounds`` rounds assigns all vectors to the nearest centroid, of equal ones the
    smaller number, and moves every non-empty centroid to floor(sum / count) of its vectors;
    then vectors are assigned once more. Rows that repeat an id are vectors of their own; a
    null id is answered too. Components beyond 2 ** 24 in size raise an error. No rows, no
    result; columns beyond the two named are not read.
    """
    p = params
    vectors = whole_vectors(rows, p, vec_id, vector)
    kind = dict(vectors.dtypes)["vec_id"]
    made = kept_table(blocks(vectors, p), "blocks")
    centroids = first_centroids(vectors, p)
    for _ in range(p.rounds if len(centroids) else 0):
        n, sums, _ = sums_of(made, centroids, p)
        centroids = np.array([(s // k if k else c).tolist() for k, s, c in zip(n, sums, centroids, strict=True)], np.int64)
    inertia = sums_of(made, centroids, p, distances=True)[2].tolist() if len(centroids) else []
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sent = made.sparkSession.sparkContext.broadcast((centroids, inertia, digests))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, by_cluster, names = sent.value
        own, of_all, digest = np.array(by_cluster, np.int64), sum(by_cluster), np.array(names, object)
        for batch in batches:
            for k in range(batch.num_rows):
                low, high, _ = _box(batch, k)
                best, d = assign(batch.column("v")[k].values.to_numpy(zero_copy_only=False).reshape(-1, p.size), low, high, c)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[k].values, pa.array(best.astype(np.int32)), pa.array(d), pa.array(own[best]), pa.array(np.full(len(d), of_all)), pa.array(digest[best], pa.string())],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    ddl = f"vec_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return made.select("ids", "v", "low", "high", "sums").mapInArrow(answer, ddl)
