import hashlib
import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain(doc_id, text, seed=42, cut=50, spm=80):
    text = text or ""
    found = UNITS.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(found)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (found[:low], found[low:high], found[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= cut:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def compared(spark, frame, rows, **options):
    made = infill.transform(frame, **options)
    found = made.withColumn("text", infill.restored(F.col("output"), F.col("form"))).collect()
    want = [plain(*r, *options.values()) for r in rows]
    assert sorted(map(repr, (tuple(r)[:6] for r in found))) == sorted(map(repr, want))
    assert sorted(r["text"] for r in found) == sorted(t or "" for _, t in rows)
    return found


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x0c\r\x1c\x85\xa0é日😀\x00<>PSM", max_size=25), max_size=6))
def test_units_are_those_of_the_pattern(texts):
    lists = infill.units(pa.array([t.encode() for t in texts], pa.large_binary())).to_pylist()
    assert [[u.decode() for u in x if u] for x in lists] == [UNITS.findall(t) for t in texts]


def test_random_texts_equal_the_plain_version(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["a", "bé", " ", "\n", "\t ", "日", "<P", ">", "<", "S>", "<M>" if i % 9 == 0 else "x"]) for _ in range(rng.randint(0, 60)))) for i in range(600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = compared(spark, frame, rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    compared(spark, frame, rows, seed=7, cut=100, suffix_first=0)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    compared(spark, odd_documents, rows)
    compared(spark, odd_documents, rows, seed=1, cut=100, suffix_first=100)
    assert infill.transform(no_documents).count() == 0


def test_a_very_long_text(spark):
    text = ("word after word, " * 400_000) + " " * 1000
    rows = [(i, text[i:]) for i in range(4)]
    compared(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows, seed=3, cut=100, suffix_first=50)
