import random
import re

from pyspark.sql import functions as F

from logweir.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    own, hit, found = words(text), set(), set()
    for item, benchmark in items:
        theirs = words(benchmark)
        m = min(13, len(theirs))
        spans = {tuple(theirs[i : i + m]) for i in range(len(theirs) - m + 1)} if theirs else set()
        for i in range(len(own) - m + 1):
            if m and tuple(own[i : i + m]) in spans:
                hit |= set(range(i, i + m))
                found |= {str(item)} if item is not None else set()
    return len(own), len(hit), sorted(found)


def test_equals_brute_force_with_short_items_repeats_and_planted_spans(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "über", "a"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([30, 13, 14, 5, 1, 0, 60, 12, 40])]
    items += [(6, items[6][1]), (20, items[0][1]), (None, text(25)), (30, None), (31, "... !"), (40, "same " * 30)]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 80))
        if i % 2:
            span = items[rng.randrange(len(items))][1] or ""
            parts = span.split()
            cut = rng.randint(0, max(0, len(parts) - 13))
            body += ", " + " ".join(parts[cut : cut + rng.randint(5, 30)]).upper() + ". " + text(20)
        docs.append((i, body))
    docs += [(100, "same " * 50), (None, items[0][1]), (7, items[6][1]), (7, items[6][1]), (8, None), (9, "")]
    bench = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, words string")
    found = decontam.matches(spark.createDataFrame([(*x, 1) for x in docs], "doc_id long, text string, row int"), bench).collect()
    mine = sorted((str(r["id"]), r["n_words"], r["n_hit"], tuple(r["items"])) for r in found)
    want = sorted((str(i), *(tuple(x) if isinstance(x, list) else x for x in brute(t, items))) for i, t in docs)
    assert mine == want
    assert sum(r["n_hit"] > 0 for r in found) > 20
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]


def test_any_shared_span_of_the_window_is_found(spark):
    rng = random.Random(4)
    item = [f"u{i}" for i in range(200)]
    docs = []
    for i in range(80):
        cut = rng.randint(0, 187)
        docs.append((i, " ".join([f"v{i}x{k}" for k in range(rng.randint(0, 30))] + item[cut : cut + 13] + [f"z{i}"] * 9)))
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = decontam.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert found.where("n_hit = 13").count() == 80


def test_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, "the same text twice over here")], "item_id long, text string")
    found = decontam.matches(odd_documents, bench)
    assert found.count() == odd_documents.count()
    assert found.where(decontam.contaminated()).count() == 4
    left = decontam.clean(odd_documents, bench)
    assert left.columns == odd_documents.columns and left.count() == odd_documents.count() - 4
    assert decontam.matches(no_documents, bench).count() == 0
    assert decontam.clean(odd_documents, bench.limit(0)).count() == odd_documents.count()
    assert decontam.matches(odd_documents, bench.limit(0)).where(F.col("n_hit") > 0).count() == 0


def test_no_filter_makes_hashes_anew_for_every_element(spark):
    frame = spark.createDataFrame([("one two three four five six seven " * 4,)], "text string").select(decontam.words_of(F.col("text")).alias("words"))
    for made in (decontam._each(decontam._kept(frame, [3]), "kept", "hash"), decontam._spans(spark.createDataFrame([(1, "a b c " * 9)], "item_id int, text string"), "item_id", "text")):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert not any("lambda" in line for line in plan.splitlines() if line.strip(" +-:").startswith("Filter") and "xxhash64" in line)
