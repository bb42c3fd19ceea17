import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from logweir.llm import bpe, skipchain
from .test_decontam import brute as contamination
from .test_simhash import plain_fingerprint


def by_hand(documents, benchmark, field):
    """(doc_id, text) after all stages but the last."""
    rows = [r for r in documents if r["text"] and any(c.isalpha() for c in r["text"])]
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    rows = [r for r in rows if find(r["doc_id"]) == r["doc_id"]]
    kept = []
    for r in rows:
        n, hit, _ = contamination(r["text"], benchmark)
        if not (hit and 20 * hit >= n):
            kept.append((r["doc_id"], skipchain.replaced(r["text"], field.spans(r["text"]))))
    return sorted(kept)


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def test_the_result_equals_the_stages_by_hand(spark, small, docs):
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    kept = docs
    for _, stage in pipeline.STAGES[:3]:
        kept = spark.createDataFrame(stage(spark, kept, small).collect(), docs.schema)
    want = by_hand(docs.collect(), bench, skipchain.train(kept))
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(file.read()), special_tokens={})
    rows = pipeline.run(spark, small).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == want
    assert all(list(r["ids"]) == library.encode_ordinary(r["text"]) and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert 0 < len(rows) < docs.count()


def test_stages_keep_the_columns_of_documents(spark, small, docs):
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns


def test_odd_rows_pass_all_stages(spark, small, docs):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "...", "en", "s", 3), (3, "some words here", None, "s", 1), (3, "some words here", None, "s", 1), (None, "no id here at all", "fr", None, None), (4, "z" * 50_000, "en", "s", 2)], docs.schema)
    for frame, rows in ((odd, 3), (odd.limit(0), 0)):
        for _, stage in pipeline.STAGES:
            frame = stage(spark, frame, small)
        assert frame.count() == rows
        assert frame.where(F.col("n_tokens") <= 0).count() == 0
