import math
import random

from logweir.llm import bitslice


def brute(rows, k):
    good = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, values in (g for g in good if g[0] % 5 == 0):
        scores = sorted(((-sum(a * b for a, b in zip(values, v, strict=True)), i) for i, v in good if i != q and len(v) == len(values)))
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def run(spark, rows, k, kind="array<double>"):
    frame = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], f"vec_id long, embedding {kind}, length int, values string")
    found = bitslice.search(frame, frame.where("vec_id % 5 = 0"), k)
    return sorted(tuple(r) for r in found.select("query_id", "rank", "vec_id", "score").collect())


def test_equals_brute_force_with_ties_nulls_lengths_and_large_components(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(7)]) for i in range(150)]
    rows += [(200 + i, [rng.choice([-0.5, 0.0, 0.25]) for _ in range(7)]) for i in range(80)]
    rows += [(300 + i, [0.1] * 7) for i in range(60)]  # equal vectors: ties by id
    rows += [(400 + i, [float(i), -float(i)]) for i in range(11)]
    rows += [(500, None), (505, [None] * 7), (510, [math.nan] * 7), (515, [math.inf] * 7), (None, [0.1] * 7), (520, []), (521, [])]
    rows += [(600 + i, [rng.uniform(-3e7, 3e7), 2.0, -3e7]) for i in range(12)]
    rng.shuffle(rows)
    for k in (1, 20):
        assert run(spark, rows, k) == brute(rows, k)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(5)]) for i in range(300)]
    monkeypatch.setattr(bitslice, "BLOCK_ROWS", 70)
    monkeypatch.setattr(bitslice, "BLOCK_QUERIES", 13)
    assert run(spark, rows, 6) == brute(rows, 6)


def test_floats_and_empty_tables(spark):
    rows = [(i, [0.5, -0.25 * i]) for i in range(11)]
    assert run(spark, rows, 3, "array<float>") == brute(rows, 3)
    assert run(spark, [], 3) == []
    assert run(spark, [(1, [0.5])], 3) == [] and run(spark, [(5, [0.5])], 3) == []


def test_a_repeated_query_is_answered_as_often(spark):
    rows = [(5, [0.5]), (5, [0.5]), (1, [0.25]), (2, [0.75])]
    assert run(spark, rows, 5) == sorted([(5, 1, 2, 1536), (5, 2, 1, 512)] * 2)


def held(rows, k):
    """Brute force with scores held at the ends of a long."""
    good = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows]
    out = []
    for q, values in (g for g in good if g[0] % 5 == 0):
        scores = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(values, v, strict=True)))), i) for i, v in good if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_sums_beyond_a_long_are_held_at_its_ends(spark):
    near = float(2**29 - 1) / 64
    rows = [(0, [near] * 64), (1, [near] * 64), (2, [near] * 63 + [-near]), (3, [-near] * 64), (5, [-near] * 64), (6, [1.0] * 64), (7, [near] * 30 + [0.0] * 34)]
    assert run(spark, rows, 20) == held(rows, 20)
    assert max(r[3] for r in held(rows, 20)) == 2**63 - 1


def test_several_pairs_of_blocks_may_share_a_task(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(5)]) for i in range(200)]
    for name, value in (("BLOCK_ROWS", 30), ("BLOCK_QUERIES", 10), ("MOST_TASKS", 3)):
        monkeypatch.setattr(bitslice, name, value)
    assert run(spark, rows, 6) == brute(rows, 6)
