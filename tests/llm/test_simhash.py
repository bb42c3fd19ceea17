import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.llm import simhash
from logweir.llm.graph import components


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.translate(dict.fromkeys([9, 10, 11, 12, 13], " ")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ABcdé \t\n\x0b\x1c\xa0日", max_size=60))
def test_fingerprint_equals_the_definition(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4))
def test_every_pair_in_reach_shares_a_key(fp, flips):
    other = fp
    for bit in flips:
        other ^= 1 << bit
    assert any(fp & mask == other & mask for mask, _ in simhash.KEYS)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4))
def test_every_pair_in_reach_shares_a_chain_of_keys(fp, flips):
    other = fp
    for bit in flips:
        other ^= 1 << bit
    ways = []
    for (mask, _), box in zip(simhash.KEYS, simhash._FIRST, strict=True):
        if fp & mask == other & mask:
            longer = [any(fp & m == other & m for m in simhash.submasks(box, n)) for n in range(3, 6)]
            ways.append(all(longer))
    assert any(ways)


def brute(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_links_of_a_dense_group_and_of_random_ones(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base}
    for _ in range(400):
        fp = base
        for bit in rng.sample(range(64), rng.randint(1, 7)):
            fp ^= 1 << bit
        fps.add(fp)
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, 1, 2**63, 2**64 - 1}
    fps = sorted(fps)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f, 1 + i % 3) for i, f in enumerate(signed)], "fp long, copies long")
    found = {r["node"]: r["root"] for r in simhash.links(frame).collect()}
    mine, want = {}, {}
    roots = brute(fps)
    for f, s in zip(fps, signed, strict=True):
        mine.setdefault(found.get(s, s), set()).add(f)
        want.setdefault(roots[f], set()).add(f)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def near_copies(rng, count, flips):
    base = rng.getrandbits(64)
    fps = {base}
    while len(fps) < count:
        fp = base
        for bit in rng.sample(range(64), rng.randint(1, flips)):
            fp ^= 1 << bit
        fps.add(fp)
    return sorted(fps)


def linked(spark, fps):
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    found = {r["node"]: r["root"] for r in simhash.links(spark.createDataFrame([(f, 1) for f in signed], "fp long, copies long")).collect()}
    mine = {}
    for f, s in zip(fps, signed, strict=True):
        mine.setdefault(found.get(s, s), set()).add(f)
    return sorted(map(sorted, mine.values()))


def by_numpy(fps):
    """Components by comparing every fingerprint with all others."""
    every, root = np.array(fps, np.uint64), np.arange(len(fps))
    near = [np.flatnonzero(np.bitwise_count(every ^ f) <= 4) for f in every]
    while True:
        least = np.array([root[n].min() for n in near])
        least = least[least]
        if (least == root).all():
            break
        root = least
    found = {}
    for f, r in zip(fps, root.tolist(), strict=True):
        found.setdefault(r, []).append(f)
    return sorted(found.values())


def test_buckets_split_by_every_segment_give_the_same_components(spark, monkeypatch):
    fps = near_copies(random.Random(3), 150, 9)
    monkeypatch.setattr(simhash, "FANS", {2: 1, 3: 1, 4: 1})
    assert linked(spark, fps) == by_numpy(fps)


def test_ten_thousand_near_copies_make_rows_in_proportion(spark, monkeypatch):
    made = []
    met, split = simhash._met, simhash._split

    def counted(opened):
        rows = opened.agg(F.count("*"), F.sum(F.when(F.col("comp") != F.col("main"), F.lit(1)).otherwise(0))).first()
        pairs = opened.groupBy("key").agg((F.count("*") * F.first("minors")).alias("p")).agg(F.sum("p")).first()[0] or 0
        made.append(pairs / max(1, rows[0]))
        return met(opened)

    monkeypatch.setattr(simhash, "_met", counted)
    monkeypatch.setattr(simhash, "_split", lambda members, length: (made.append(-1), split(members, length))[1])
    fps = near_copies(random.Random(4), 10_000, 8)
    assert linked(spark, fps) == by_numpy(fps)
    assert -1 in made and max(made) <= simhash.FANS[2]


def test_components_of_a_long_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(200, 260)] + [(5000, 5000), (None, 4)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, **{i: 200 for i in range(201, 260)}, 1000: 200}


def test_groups_of_odd_rows(spark, odd_documents, no_documents):
    rows = simhash.groups(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by_id = {r["id"]: r for r in rows if r["id"] not in (None, 3)}
    assert {by_id[i]["component_id"] for i in (0, 1, 2)} == {0} and by_id[0]["fp"] == 0
    assert by_id[4]["component_id"] == by_id[5]["component_id"] == 4
    assert by_id[9]["component_id"] == 8
    assert simhash.groups(no_documents).count() == 0


def test_one_document_of_each_group_stays(spark, odd_documents, no_documents):
    kept = simhash.deduplicate(odd_documents)
    assert kept.columns == odd_documents.columns
    texts = sorted(r["text"] or "" for r in kept.collect())
    roots = {r["root"] for r in simhash.groups(odd_documents).collect()}
    assert len(texts) == len(roots) and texts.count("the same text twice over here") == 1 and "no id at all here" in texts
    assert simhash.deduplicate(no_documents).count() == 0


def test_an_id_in_several_components_keeps_one_row_of_each(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = spark.createDataFrame([(5, a), (5, b), (3, b), (7, a), (7, c), (7, c), (None, b)], "doc_id long, text string")
    kept = simhash.deduplicate(docs).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(3, b), (5, a), (7, c)]
