"""Centroid clustering of integer vectors, with bounds that loosen by geometric drift.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound of the distance to all others.
When centroids move, the lower bound need not lose the whole drift of the centroid that moved most.  The vectors of a
cluster lie in a sphere about its centroid, and how much closer another centroid can come to any point of that sphere
depends only on the plane through the sphere's centre and the centroid's way: at each place of the way the distance
to a point shrinks by the cosine of the angle between the way and the point, and over the sphere that angle is at
least the centre's angle less the sphere's angular radius.  Summed over pieces of the way, each taken where it begins
(the angle only grows along it), this bounds what the lower bound loses; it is at most the drift, and may be a gain.

A vector whose upper bound stays below its lower bound keeps its cluster without a look at the centroids; after one
exact distance to its own centroid, more do.  All others are ambiguous and are compared with every centroid in exact
integers.  So bounds, which are floating point and a little widened, only decide what need not be computed.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import removed, written

K = 16
ROUNDS = 3
WIDTH = 64
SCALE = 64
SEED = 1
#: Pieces of a centroid's way.
PIECES = 8
#: Bounds are widened by this share, far more than floating point can be off.
SLACK = 1e-9
#: Below the first, products of components add up exactly in doubles; below the second, squares do in 64-bit integers.
EXACT_DOUBLE = 1 << 20
EXACT_LONG = 1 << 27
LONG_END = (1 << 63) - 1

Centroids = list[list[int]]


def _distance(a: list[float], b: list[float]) -> float:
    return math.sqrt(float(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))))


def approach(center: list[int], radius: float, old: list[int], new: list[int]) -> float:
    """A bound of d(x, old) - d(x, new) over all x within ``radius`` of ``center``."""
    way = _distance(old, new)
    if way == 0.0:
        return 0.0
    reach = _distance(center, old)
    along = float(sum((q - a) * (b - a) for q, a, b in zip(center, old, new, strict=True))) / way
    across = math.sqrt(max(0.0, reach * reach - along * along))
    radius = radius * (1 + SLACK)
    total = 0.0
    for piece in range(PIECES):
        x = along - way * piece / PIECES
        far = math.hypot(x, across)
        if radius >= far:
            total += 1.0
        else:
            total += math.cos(max(0.0, math.atan2(across, x) - math.asin(radius / far)))
    return min(way, total * way / PIECES) + SLACK * (way + reach + radius)


def loosening(old: Centroids, new: Centroids, radii: dict[int, float]) -> tuple[list[float], list[float]]:
    """By cluster: what its upper bounds gain and its lower bounds lose."""
    drift = [_distance(a, b) * (1 + SLACK) for a, b in zip(old, new, strict=True)]
    loss = []
    for i, center in enumerate(old):
        others = [approach(center, radii[i], old[j], new[j]) for j in range(len(old)) if j != i and i in radii]
        loss.append(max(others, default=0.0))
    return drift, loss


def distances(v: np.ndarray, centroids: Centroids) -> np.ndarray:
    """Squared distances, exact: an array of integers, or of Python integers where 64 bits may not do."""
    c = np.array(centroids, dtype=object)
    top = max(int(abs(v.max(initial=0))), int(abs(v.min(initial=0))), max((abs(x) for row in centroids for x in row), default=0))
    if top < EXACT_DOUBLE:
        x, y = v.astype(np.float64), c.astype(np.float64)
        found = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * (x @ y.T)
        return found.astype(np.int64)
    if top < EXACT_LONG:
        whole = c.astype(np.int64)
        return np.stack([((v - row) ** 2).sum(axis=1) for row in whole], axis=1)
    wide = v.astype(object)
    return np.stack([((wide - row) ** 2).sum(axis=1) for row in c], axis=1)


def _own(v: np.ndarray, cluster: np.ndarray, centroids: Centroids) -> np.ndarray:
    """Squared distances to the vectors' own centroids."""
    found = np.empty(len(v), object)
    for i in np.unique(cluster).tolist():
        here = cluster == i
        found[here] = distances(v[here], [centroids[i]])[:, 0]
    return found


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def assign(v: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Clusters and bounds for ``centroids`` from bounds that hold for them, and how many vectors were scanned.

    A cluster below zero says that nothing is known.
    """
    cluster, upper, lower = cluster.copy(), upper.copy(), lower.copy()
    open_ = np.flatnonzero((cluster < 0) | (upper >= lower))
    known = open_[cluster[open_] >= 0]
    if len(known):
        upper[known] = _roots(_own(v[known], cluster[known], centroids)) * (1 + SLACK)
        open_ = open_[(cluster[open_] < 0) | (upper[open_] >= lower[open_])]
    if len(open_):
        found = distances(v[open_], centroids)
        # The first of equal distances is the smaller number.
        best = np.argmin(found, axis=1)
        rows = np.arange(len(open_))
        upper[open_] = _roots(found[rows, best]) * (1 + SLACK)
        found = _roots(found)
        found[rows, best] = np.inf
        lower[open_] = found.min(axis=1, initial=np.inf) * (1 - SLACK)
        cluster[open_] = best
    return cluster, upper, lower, len(open_)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigned(rows: DataFrame, centroids: Centroids, drift: list[float], loss: list[float]) -> DataFrame:
    """Rows (id, v, cluster, upper, lower) with clusters and bounds for ``centroids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, cluster = _vectors(batch.column("v")), batch.column("cluster").to_numpy()
            # What is unknown has cluster -1, which reads the last cluster's shift and ignores it.
            upper = batch.column("upper").to_numpy() + np.array(drift)[cluster]
            lower = batch.column("lower").to_numpy() - np.array(loss)[cluster]
            cluster, upper, lower, _ = assign(v, cluster, upper, lower, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(cluster, pa.int32()), pa.array(upper), pa.array(lower)],
                names=["id", "v", "cluster", "upper", "lower"],
            )

    return rows.mapInArrow(run, rows.schema)


def _totals(state: DataFrame, k: int) -> tuple[dict[int, int], dict[int, float], dict[int, list[int]]]:
    """Rows, radius and sums of components by cluster; each task sends one row a cluster and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, radius, sums = dict.fromkeys(range(k), 0), dict.fromkeys(range(k), 0.0), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            v, cluster, upper = _vectors(batch.column("v")), batch.column("cluster").to_numpy(), batch.column("upper").to_numpy()
            safe = max(int(v.max()), -int(v.min())) < (1 << 62) // len(v)
            for i in np.unique(cluster).tolist():
                here = cluster == i
                part = v[here] if safe else v[here].astype(object)
                rows[i] += int(here.sum())
                radius[i] = max(radius[i], float(upper[here].max()))
                sums[i] = sums.get(i, 0) + part.sum(axis=0).astype(object)
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([i], pa.int32()),
                    pa.array([rows[i]], pa.int64()),
                    pa.array([radius[i]]),
                    pa.array([[Decimal(int(x)) for x in total]], pa.list_(pa.decimal128(38, 0))),
                ],
                names=["cluster", "n", "radius", "sums"],
            )

    parts = state.select("v", "cluster", "upper").mapInArrow(run, "cluster int, n long, radius double, sums array<decimal(38,0)>")
    found = (
        parts.select("cluster", "n", "radius", F.posexplode("sums").alias("at", "x"))
        .groupBy("cluster", "at")
        .agg(F.sum("n").alias("n"), F.max("radius").alias("radius"), F.sum("x").cast("decimal(38,0)").alias("x"))
        # At most k x width rows.
        .collect()
    )
    sums: dict[int, dict[int, int]] = {}
    for r in found:
        sums.setdefault(r["cluster"], {})[r["at"]] = int(r["x"])
    return (
        {r["cluster"]: r["n"] for r in found},
        {r["cluster"]: r["radius"] for r in found},
        {i: [x for _, x in sorted(parts.items())] for i, parts in sums.items()},
    )


def quantised(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(id, v) of the vectors with ``width`` components, all finite: floor(scale * component) as integers."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return vectors.where((F.size(x) == width) & finite).select(F.col(key).alias("id"), F.transform(x, lambda c: F.floor(scale * c)).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> Centroids:
    """The k vectors whose ids have the smallest hashes; ties by the vectors, rows without an id last."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [r["v"] for r in rows.orderBy(F.asc_nulls_last(order), "v").select("v").limit(k).collect()]


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH) -> tuple[DataFrame, Centroids]:
    """(id, cluster, distance) of every vector that takes part, and the final centroids.

    Each round assigns every vector to its nearest centroid (ties to the smaller number) and moves every centroid that
    has vectors to the componentwise floor of their mean; then vectors are assigned once more.  Vectors that are null,
    of another length, or hold null or non-finite components take no part.  Components beyond 64-bit integers stay at
    their ends, and so do squared distances.  With fewer than ``k`` vectors there are fewer centroids; without any the
    result is empty.  Repeated rows are kept, as are rows without an id; other columns are not read.

    To the driver come k vectors and sums of k x width components.  Each round writes the vectors with their bounds to
    the shared folder, from which a lost task starts again, and removes the table before it.
    """
    rows = quantised(vectors, key, vector, width)
    centroids = first_centroids(rows, k, seed)
    nothing = [0.0] * max(1, len(centroids))
    state = rows.select("id", "v", F.lit(-1).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower"))
    drift, loss, last = nothing, nothing, None
    if centroids:
        for _ in range(rounds):
            state = written(_assigned(state, centroids, drift, loss))
            if last is not None:
                removed(last)
            last = state
            counts, radii, sums = _totals(state, len(centroids))
            moved = [[x // counts[i] for x in sums[i]] if i in counts else row for i, row in enumerate(centroids)]
            drift, loss = loosening(centroids, moved, radii)
            centroids = moved

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("cluster").to_numpy()
            far = _own(_vectors(batch.column("v")), own, centroids)
            far = pa.array([min(int(x), LONG_END) for x in far], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), far], names=["id", "cluster", "distance"])

    final = _assigned(state, centroids, drift, loss) if centroids else state.where("false")
    kind = rows.schema["id"].dataType.simpleString()
    found = written(final.select("id", "v", "cluster").mapInArrow(measured, f"id {kind}, cluster int, distance long"))
    if last is not None:
        removed(last)
    return found, centroids


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: Centroids) -> DataFrame:
    """``found`` with the squared distances summed over each cluster and over all, and digests of the centroids."""
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row a centroid.
    sums = {r["cluster"]: int(r["x"]) for r in found.groupBy("cluster").agg(total.alias("x")).collect()}
    whole = min(sum(sums.values()), LONG_END)
    rows = [(i, min(sums[i], LONG_END), whole, digest(centroids[i])) for i in sorted(sums)]
    told = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster")
