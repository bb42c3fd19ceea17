import random

from pyspark.sql import functions as F

from logweir.llm import revisit

SCHEMA = "id long, url string, time long, status int, etag string, last_modified string, headers map<string,string>, body string, piece int, outcome string"


def records(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def brute(rows):
    out = []
    for r in rows:
        if r[3] != 304:
            continue
        earlier = [x for x in rows if x[3] == 200 and x[1] is not None and x[2] is not None and r[1] == x[1] and r[2] is not None and x[2] < r[2]]
        if r[1] is None or r[2] is None:
            out.append((r[0], None, "unusable"))
        elif not earlier:
            out.append((r[0], None, "unmatched"))
        else:
            x = max(earlier, key=lambda x: (x[2], x[0]))
            same = all(a is None or b is None or a == b for a, b in ((r[4], x[4]), (r[5], x[5])))
            out.append((r[0], x[0], "resolved" if same else "mismatch"))
    return sorted(out, key=repr)


def test_equals_brute_force_with_a_hot_url_and_ties(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        url = "h.org/hot" if rng.random() < 0.5 else rng.choice(["a.org/1", "a.org/2", "b.org", None, f"c.org/{i}"])
        rows.append((i, url, rng.choice([None, *range(40)]), rng.choice([200, 304, 304, 404]), rng.choice([None, "e1", "e2"]), rng.choice([None, "m1"]), {"Date": str(i)}, f"body {i}"))
    for size in (250_000, 50):
        monkeypatch.setattr(revisit, "PIECE_ROWS", size)
        found = revisit.resolve(records(spark, rows)).collect()
        assert sorted(((r["id"], r["source_id"], r["outcome"]) for r in found), key=repr) == brute(rows)
        assert all((r["body"] == f"body {r['source_id']}") == (r["outcome"] == "resolved") for r in found)


def test_headers_are_merged(spark):
    rows = [
        (1, "http://WWW.A.org:80/x/?b=2&a=1&utm_source=q#top", 1, 200, "e", None, {"Content-Length": "9", "Date": "old", "Server": "s"}, "full"),
        (2, "https://a.org/x?a=1&b=2", 5, 304, "e", "m", {"content-length": "0", "DATE": "new", "ETag": "e"}, None),
    ]
    (row,) = revisit.resolve(records(spark, rows)).collect()
    assert row["canonical"] == "a.org/x?a=1&b=2" and row["body"] == "full"
    assert row["headers"] == {"content-length": "9", "date": "new", "server": "s", "etag": "e"}


def test_null_headers_repeated_rows_and_empty_tables(spark):
    rows = [(1, "a.org", 1, 200, None, None, None, None), (1, "a.org", 1, 200, None, None, None, None), (2, "a.org", 2, 304, None, None, None, None), (2, "a.org", 2, 304, None, None, None, None), (None, "a.org", 3, 304, None, None, None, None), (3, "", None, 304, "e", None, None, "x" * 100_000)]
    found = revisit.resolve(records(spark, rows))
    assert sorted(((r["id"], r["source_id"], r["outcome"], r["headers"]) for r in found.collect()), key=repr) == sorted([(2, 1, "resolved", {}), (2, 1, "resolved", {}), (None, 1, "resolved", None), (3, None, "unusable", None)], key=repr)
    assert revisit.resolve(records(spark, rows).limit(0)).count() == 0
    assert revisit.resolve(records(spark, rows).where(F.col("status") == 304)).where("outcome = 'resolved'").count() == 0


def test_a_burst_of_times_is_cut_by_rows(spark, monkeypatch):
    monkeypatch.setattr(revisit, "PIECE_ROWS", 100)
    rows = [(0, "hot.org", 0, 200, None, None, None, "b")]
    rows += [(i, "hot.org", 1_700_000_000 + i // 2, 200 if i % 50 == 0 else 304, None, None, None, "b" if i % 50 == 0 else None) for i in range(1, 2000)]
    rows += [(5000 + i, f"u{i}.org", 1_700_000_000 + i, 200, None, None, None, "b") for i in range(500)]
    slim = records(spark, rows).select(revisit.canonical(F.col("url")).alias("canonical"), "time")
    sizes = [r["count"] for r in revisit._pieces(slim).groupBy("piece").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 250
    found = revisit.resolve(records(spark, rows)).collect()
    assert sorted(((r["id"], r["source_id"], r["outcome"]) for r in found), key=repr) == brute(rows)


def test_of_repeated_ids_the_smallest_body_counts(spark):
    rows = [(1, "a.org", 1, 200, None, None, {"Server": s}, b) for s, b in (("x", "b2"), ("z", "b1"), ("y", "b1"))] + [(2, "a.org", 2, 304, None, None, {"Date": d}, None) for d in "21"]
    found = revisit.resolve(records(spark, rows)).collect()
    assert [(r["body"], r["headers"]) for r in found] == [("b1", {"server": "y", "date": "1"})] * 2
