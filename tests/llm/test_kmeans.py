import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweir.llm import kmeans


def plain_clusters(rows, k, rounds, seed, width):
    """Every vector against every centroid in Python integers."""
    kept = []
    for vec_id, vector in rows:
        if vector is None or len(vector) != width or any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [max(-(2**63), min(2**63 - 1, math.floor(64 * x) if math.isfinite(64 * x) else (2**63 if x > 0 else -(2**63)))) for x in vector]
        kept.append((vec_id, v))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(v):
        return min(range(len(centroids)), key=lambda i: (far(v, centroids[i]), i))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v), []).append(v)
        for i, members in groups.items():
            centroids[i] = [sum(column) // len(members) for column in zip(*members, strict=True)]
    return sorted(((r, nearest(v), min(far(v, centroids[nearest(v)]), 2**63 - 1)) for r, v in kept), key=repr), centroids


def compared(spark, rows, kind="float", k=4, rounds=3, width=3):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    found, centroids = kmeans.cluster(frame.repartition(3), k=k, rounds=rounds, width=width)
    want, told = plain_clusters(rows, k, rounds, 1, width)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert centroids == told
    return found, centroids


def test_clusters_of_odd_vectors(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randint(-40, 40) / 8 for _ in range(3)]) for i in range(200)]
    rows += [(5, [0.0, 0.0, 0.0])] * 60  # repeated rows of a repeated id
    rows += [(1000, None), (1001, [1.0, None, 2.0]), (1002, [1.0, float("nan"), 2.0]), (1003, [1.0, float("inf"), 0.0]), (1004, [1.0]), (1005, []), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    found, centroids = compared(spark, rows)
    told = kmeans.with_inertia(found, centroids).collect()
    assert {r["inertia"] for r in told} == {sum(r["distance"] for r in told)}
    for i in range(4):
        here = [r for r in told if r["cluster"] == i]
        assert {r["cluster_inertia"] for r in here} <= {sum(r["distance"] for r in here)}
        assert {r["centroid_sha256"] for r in here} <= {hashlib.sha256(",".join(map(str, centroids[i])).encode()).hexdigest()}


@pytest.mark.parametrize("size", [1.0, 2.0**17, 2.0**30, 2.0**57, 1e300, 1.7e308])
def test_clusters_of_every_magnitude_are_exact(spark, size):
    rng = random.Random(int(math.log2(size)))
    compared(spark, [(i, [rng.uniform(-size, size) for _ in range(3)]) for i in range(60)], "double")


def test_few_vectors_and_none(spark):
    compared(spark, [(1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0])])
    compared(spark, [(None, [1.0, 2.0, 3.0])])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, cluster int, id string, v int, upper int")
    found, centroids = kmeans.cluster(empty)
    assert found.count() == 0 and centroids == [] and kmeans.with_inertia(found, centroids).count() == 0


def test_columns_that_clash_are_not_read(spark):
    rows = [(i, [float(i % 7), float(i % 3)], "x", 9, i, 0.5) for i in range(30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id string, cluster int, v long, upper double")
    found, _ = kmeans.cluster(frame, k=3, width=2)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_clusters([r[:2] for r in rows], 3, 3, 1, 2)[0]


points = st.lists(st.integers(-50, 50), min_size=3, max_size=3)


@settings(max_examples=400, deadline=None)
@given(points, points, points, st.floats(0, 60), st.lists(st.floats(-1, 1), min_size=3, max_size=3))
def test_no_point_of_the_sphere_comes_closer_than_the_bound(center, old, new, radius, direction):
    length = math.hypot(*direction) or 1.0
    point = [c + radius * d / length for c, d in zip(center, direction, strict=True)]
    closer = math.dist(point, old) - math.dist(point, new)
    bound = kmeans.approach(center, radius, old, new)
    assert closer <= bound + 1e-12
    assert bound <= math.dist(old, new) * (1 + 1e-6) + 1e-5


def test_bounds_loosen_less_than_drift_and_leave_most_vectors_alone():
    rng = np.random.default_rng(3)
    centers = rng.integers(-400, 400, (8, 16))
    v = np.concatenate([c + rng.integers(-30, 30, (300, 16)) for c in centers]).astype(np.int64)
    centroids = [v[i * 300].tolist() for i in range(8)]
    cluster, upper, lower = np.full(len(v), -1, np.int32), np.zeros(len(v)), np.zeros(len(v))
    cluster, upper, lower, scanned = kmeans.assign(v, cluster, upper, lower, centroids)
    assert scanned == len(v)
    for _ in range(3):
        moved = [(v[cluster == i].sum(axis=0) // (cluster == i).sum()).tolist() for i in range(8)]
        radii = {i: float(upper[cluster == i].max()) for i in range(8)}
        drift, loss = kmeans.loosening(centroids, moved, radii)
        centroids = moved
        if max(drift) > 0:
            assert max(loss) < max(drift)
        cluster, upper, lower, scanned = kmeans.assign(v, cluster, upper + np.array(drift)[cluster], lower - np.array(loss)[cluster], centroids)
        exact = kmeans.distances(v, centroids)
        assert (cluster == exact.argmin(axis=1)).all() and scanned < 0.05 * len(v)
        others = exact.astype(float)
        others[np.arange(len(v)), cluster] = np.inf
        assert (lower <= np.sqrt(others.min(axis=1))).all() and (upper >= np.sqrt(exact.min(axis=1))).all()
