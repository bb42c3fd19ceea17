"""Language, toxicity and model scores: their algorithms against plain ones, and accuracy on rows held out."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.llm import langid, lmscore, mil
from logweir.llm.common import held_out


def is_held_out(key):
    return zlib.crc32(str(key).encode()) % 3 == 1


def test_the_fold_is_that_of_crc32(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r["h"] == (r["doc_id"] is not None and is_held_out(r["doc_id"])) for r in rows)


def plain_phrases(text, corpus):
    """Greedy parsing into the longest pieces that stand in one of the corpus's texts."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and any(text[at : end + 1] in t for t in corpus) and any(text[at:end] in t for t in corpus):
            end += 1
        count += 1
        at = end
    return count


def test_phrases_equal_greedy_parsing():
    rng = random.Random(6)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 6)))
    corpora = {"one": [" ".join(word("abcde") for _ in range(60)) for _ in range(3)], "two": [" ".join(word("cdefé") for _ in range(60))]}
    parser = langid.Parser({k: [langid.symbols_of(t) for t in v] for k, v in corpora.items()})
    texts = [" ".join(word("abcdefgé") for _ in range(rng.randint(1, 40))) for _ in range(40)] + ["a", "zzz", "q a q"]
    found = parser.phrases([langid.symbols_of(t) for t in texts])
    for k, language in enumerate(parser.languages):
        assert found[k].tolist() == [plain_phrases(t, corpora[language]) for t in texts]


def test_long_texts_are_parsed_whole(monkeypatch):
    parser = langid.Parser({"a": [langid.symbols_of("one two three " * 30)], "b": [langid.symbols_of("uno dos tres " * 30)]})
    text = "uno dos tres " * 3000 + "one two three " * 9000
    whole = parser.entropies([text])
    assert whole.argmin() == 0
    monkeypatch.setattr(langid, "CHUNK", 5_000)
    assert np.allclose(parser.entropies([text]), whole)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(docs, langid.learn(docs)).join(docs, F.col("id") == F.col("doc_id")).where(held_out("id"))
    right, rows = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert rows > 200 and right >= 0.98 * rows


def test_long_and_copied_texts_take_their_share_only(spark):
    own = lambda i: f" {chr(0x4E00 + i)} abc def" * 300
    docs = [(i, own(i), "x") for i in range(100)] + [(i, own(200), "x") for i in range(100, 400)]
    docs += [(i, own(201 + i % 3) * 50, "x") for i in range(400, 420)] + [(i, f"{own(300)}{own(301 + i)}{own(500)}", "y") for i in range(20)]
    found = langid.samples(spark.createDataFrame(docs, "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    symbols = {k: collections.Counter(int(c) for t in v for c in t if c > 0x4DFF) for k, v in found.items()}
    assert all(0.9 * langid.SAMPLE_SYMBOLS < sum(map(len, v)) <= langid.SAMPLE_SYMBOLS for v in found.values())
    assert len(symbols["x"]) == langid.SAMPLE_ROWS and max(symbols["x"].values()) < 2 * min(symbols["x"].values())
    # All places of a text are learned from, and fewer texts have larger shares.
    assert {0x4E00 + 300, 0x4E00 + 500} < set(symbols["y"]) and len(symbols["y"]) > 10


def test_odd_texts_have_a_defined_language(odd_documents, no_documents):
    models = langid.learn(odd_documents)
    rows = {r["id"]: r for r in langid.identify(odd_documents, models).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (0, 1, 2))
    assert rows[7]["lang_pred"] in models.languages and 0 <= rows[7]["score"] <= 1
    assert langid.identify(odd_documents, langid.learn(no_documents)).where("lang_pred <> 'und'").count() == 0
    kept = langid.accepted(odd_documents, models)
    assert kept.columns == odd_documents.columns and kept.where("lang is null").count() == 0
    assert kept.count() == odd_documents.where("text rlike '\\\\p{L}'").count()
    assert langid.identify(no_documents, models).count() == 0


def toxic_table(spark, n=1500):
    rng = random.Random(8)
    words = ["table", "river", "green", "letter", "window", "market", "summer", "garden", "paper", "stone"]
    docs, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(8)) for _ in range(rng.randint(1, 60))]
        toxic = int(rng.random() < 0.15)
        if toxic:
            sentences.insert(rng.randrange(len(sentences) + 1), f"you are a {rng.choice(['grumbus', 'snarkel', 'vloxify', 'vloxing'])} thing")
        docs.append((i, ". ".join(sentences) + ".", "x"))
        labels.append((i, toxic))
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_sentences_are_found_in_held_out_documents(spark):
    docs, labels = toxic_table(spark)
    found = mil.score(docs, mil.train(docs, labels)).join(labels, F.col("id") == F.col("doc_id")).join(docs.select("doc_id", "text"), "doc_id")
    rows = [r for r in found.collect() if is_held_out(r["id"])]
    caught = [r for r in rows if r["score"] >= 0.7]
    assert all(r["toxic"] for r in caught) and len(caught) >= 0.95 * sum(r["toxic"] for r in rows)
    for r in caught:
        pieces = [r["text"][s["start"] : s["end"]] for s in r["sentences"]]
        assert any(w in p for p in pieces for w in ("grumbus", "snarkel", "vlox")) and len(pieces) == 1


def test_labels_of_held_out_rows_are_not_learned(spark):
    docs, labels = toxic_table(spark, 600)
    lies = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = mil.train(docs, labels), mil.train(docs, lies)
    assert a.features == b.features and np.allclose(a.weights, b.weights)


def test_odd_texts_have_a_defined_toxicity(spark, odd_documents, no_documents):
    docs, labels = toxic_table(spark, 600)
    model = mil.train(docs, labels)
    rows = mil.score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] < 0.7 for r in rows)
    assert mil.score(no_documents, model).count() == 0
    empty = mil.train(no_documents, labels.limit(0))
    assert mil.score(odd_documents, empty).where("score > 0.7").count() == 0


def test_places_survive_letters_that_change_their_length():
    model = mil.Model([" bad "])
    model.weights[:] = 20
    text = "İİİ fine. İ so bad İ! end"
    bad = model.score(text)[1]
    (span,) = mil._spans(text, bad)
    assert text[span["start"] : span["end"]] == "İ so bad İ!"


def plain_losses(docs, marked, known):
    def pairs(text):
        tokens = [known.get(w, lmscore.OTHER) for w in (text or "").lower().encode().translate(lmscore._WORD_BYTE).split()]
        return list(zip([lmscore.START, *tokens], tokens, strict=False))

    tables = []
    for some in ([t for i, t in docs if i in marked], [t for _, t in docs]):
        counted = np.zeros((lmscore.VOCABULARY,) * 2)
        for text in some:
            for a, b in pairs(text):
                counted[a, b] += 1
        tables.append(lmscore.losses(counted))
    return [(i, len(pairs(t)), *(sum(float(x[p]) for p in pairs(t)) / max(1, len(pairs(t))) for x in tables)) for i, t in docs]


def test_losses_equal_plain_counts(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 40)))) for i in range(60)] + [(70, None), (70, ""), (3, "a b c"), (None, "a b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    marked = spark.createDataFrame([(i,) for i in [*range(20), 3, None]], "doc_id long")
    found = lmscore.score(frame, marked).collect()
    known = lmscore.vocabulary(frame)
    want = plain_losses(docs, set(range(20)), known)
    key = lambda r: (str(r[0]), r[1], round(r[2], 3))
    for mine, theirs in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert mine[:2] == theirs[:2] and mine[2:4] == pytest.approx(theirs[2:], abs=1e-4) and mine[4] == pytest.approx(theirs[2] - theirs[3], abs=1e-4)


def test_losses_of_odd_rows_and_empty_tables(spark, odd_documents, no_documents):
    marked = odd_documents.select("doc_id")
    assert lmscore.score(odd_documents, marked).count() == odd_documents.count()
    assert lmscore.score(no_documents, marked).count() == 0
    assert lmscore.score(odd_documents, marked.limit(0)).where("n_tokens = 0 and score = 0").count() == 4


def test_rare_words_are_words_of_the_models(spark, monkeypatch):
    rng = random.Random(9)
    docs = [(i, " ".join(f"w{rng.randrange(rng.choice([20, 6000]))}" for _ in range(40))) for i in range(300)]
    docs += [(300, " ".join(f"only{i}" for i in range(30))), (301, " ".join(f"rare{i}" for i in range(30)))]
    marked = {*range(0, 300, 3), 300}
    pairs = {i: list(zip([None, *t.split()[:-1]], t.split(), strict=True)) for i, t in docs}
    size = len({w for p in pairs.values() for _, w in p}) + 2
    assert size > 2 * lmscore.VOCABULARY
    bits = []
    for some in (marked, set(pairs)):
        pair = collections.Counter(p for i in some for p in pairs[i])
        word = collections.Counter(w for i in some for _, w in pairs[i])
        history = collections.Counter(a for i in some for a, _ in pairs[i])
        total = sum(word.values())
        loss = lambda a, b: -math.log2((pair[a, b] + lmscore.PRIOR * (word[b] + 1) / (total + size)) / (history[a] + lmscore.PRIOR))  # noqa: B023, E731
        bits.append({i: sum(loss(*x) for x in p) / len(p) for i, p in pairs.items()})
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    names = spark.createDataFrame([(i,) for i in marked], "doc_id int")
    for block in (4_000_000, 5_000):
        monkeypatch.setattr(lmscore, "BLOCK_BYTES", block)
        found = {r["id"]: r for r in lmscore.score(frame, names).collect()}
        assert len(found) == len(docs)
        for i, row in found.items():
            assert (row["target_loss"], row["background_loss"]) == pytest.approx((bits[0][i], bits[1][i]), abs=1e-9)
        # Words that stand once score by the document they stand in.
        assert found[300]["score"] < 0 < found[301]["score"]


def plain_loss(theta, documents, leak):
    """The weighted likelihood of the noisy-or, sentence by sentence."""
    toxic = sum(label for _, label in documents)
    total = mil.PENALTY / 2 * sum(w * w for w in theta[:-1])
    for rows, label in documents:
        clean = 1 - leak
        for row in rows:
            clean *= 1 - 1 / (1 + math.exp(-(theta[-1] + sum(theta[i] for i in row))))
        total += -0.5 / toxic * math.log(1 - clean) if label else -0.5 / (len(documents) - toxic) * math.log(clean)
    return total


def test_the_fit_follows_the_gradient_of_the_plain_loss(monkeypatch):
    rng = random.Random(5)
    documents = [([sorted(rng.sample(range(4), rng.randint(1, 3))) for _ in range(rng.randint(1, 4))], float(rng.random() < 0.4)) for _ in range(40)] + [([], 0.0), ([], 1.0)]
    rounds = 8
    monkeypatch.setattr(mil, "ROUNDS", rounds)
    model = mil.Model(["a", "b", "c", "d"])
    model.fit(documents)
    theta, first, second = [0.0] * 4 + [-4.0], [0.0] * 5, [0.0] * 5
    held = [d for d in documents if d[0]]
    for step in range(1, rounds + 1):
        gradient = []
        for i in range(5):
            up, down = ([*theta[:i], theta[i] + d, *theta[i + 1 :]] for d in (1e-5, -1e-5))
            gradient.append((plain_loss(up, held, model.leak) - plain_loss(down, held, model.leak)) / 2e-5)
        for i, g in enumerate(gradient):
            first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
            theta[i] -= mil.RATE * (first[i] / (1 - 0.9**step)) / (math.sqrt(second[i] / (1 - 0.999**step)) + 1e-10)
    assert np.allclose([*model.weights, model.bias], theta, atol=1e-4)
    assert model.leak == 1.5 / 52


def test_scores_are_the_noisy_or_of_plain_sentences():
    rng = random.Random(6)
    model = mil.Model([" bad ", "ugly ", " so", " dé"])
    model.weights, model.bias, model.leak = np.array([3.0, 2.0, 1.0, -1.0]), -2.0, 0.01
    for _ in range(200):
        text = "".join(rng.choice(["bad", "Bad", "ugly", "fugly", "sorry", "so", "nice", " ", " ", ". ", "!", "\n", "dét"]) for _ in range(rng.randint(0, 30)))
        clean = 0.99
        for sentence in re.split(r"(?<=[.!?\n])", text):
            # A sentence's sign ends its line, so features never reach over it.
            found = mil.features_of(sentence) & {" bad ", "ugly ", " so", " dé"}
            words = mil._line(sentence)[0].split()
            weights = [w for f, w in zip(model.features, model.weights, strict=True) if f in found or any(f in f" {word} " for word in words)]
            if weights:
                clean *= 1 - 1 / (1 + math.exp(-(model.bias + sum(weights))))
        assert math.isclose(model.score(text)[0], 1 - clean, rel_tol=1e-9), text


def test_a_column_of_the_helpers_name_stays(spark):
    docs = spark.createDataFrame([(1, "eins zwei drei und noch mehr", None, "x"), (2, "123", "de", "y")], "doc_id long, text string, lang string, _language string")
    kept = langid.accepted(docs, langid.learn(spark.createDataFrame([(i, f"{text} {i}", lang) for i in range(20) for text, lang in (("eins zwei drei vier", "de"), ("one two three four", "en"))], "doc_id long, text string, lang string")))
    assert [(r["doc_id"], r["_language"]) for r in kept.collect()] == [(1, "x")]
