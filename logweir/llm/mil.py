"""Toxicity by multiple-instance learning: sentences are scored, a document is toxic if some sentence is (noisy-or).

A sentence's probability is logistic in the distinct features it holds: words, and word beginnings and endings of 3
to 6 letters.  Only document labels are known, so the weights are fitted by the likelihood of the noisy-or of each
document's sentences and a leak.  The features are those that mark toxic documents in a bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import held_out, in_small_batches, thinned

#: Labelled documents of each label that are learned from, and features kept: the documented bounds of the sample.
SAMPLE_ROWS = 4_000
FEATURES = 512
#: A feature stands in at least this share of the toxic documents of the sample, and in more of them than the other
#: documents let expect by this many standard deviations.
LEAST_SHARE, DEVIATIONS = 0.01, 5.0
AFFIXES = range(3, 7)
ROUNDS, RATE, PENALTY = 300, 0.15, 0.0001
#: A sentence is reported if its probability reaches this.
OFFENDING = 0.5

_WORD_BYTE = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?\n")] = True


def _line(text: str | None) -> tuple[str, np.ndarray]:
    """The words of a text in lower case, one character a byte, between blanks; and the place each sentence ends."""
    raw = b" " + (text or "").lower().encode() + b" "
    ends = np.flatnonzero(_ENDS[np.frombuffer(raw, np.uint8)])
    return raw.translate(_WORD_BYTE).decode("latin-1"), np.append(ends, len(raw))


def features_of(text: str | None) -> set[str]:
    """All features of a text: ' word ', ' beginning' and 'ending ', as they stand in the line of words."""
    found = set()
    for word in set(_line(text)[0].split()):
        found.add(f" {word} ")
        for n in AFFIXES:
            if n < len(word):
                found.add(" " + word[:n])
                found.add(word[-n:] + " ")
    return found


class Model:
    """Weights of the chosen features, the bias of a sentence that has some, and the leak.

    The leak is the probability that a document is toxic for reasons that no feature tells: sentences without
    features add nothing, however many there are.
    """

    def __init__(self, features: list[str]):
        self.features = features
        self.weights = np.zeros(len(features))
        self.bias = -4.0
        self.leak = 0.0
        self.automaton = ahocorasick.Automaton()
        for i, feature in enumerate(features):
            self.automaton.add_word(feature, i)
        if features:
            self.automaton.make_automaton()

    def sentences(self, text: str | None) -> tuple[dict[int, set[int]], np.ndarray]:
        """(features by the sentences that have some, where each sentence ends)."""
        line, ends = _line(text)
        found: dict[int, set[int]] = {}
        if self.features:
            hits = list(self.automaton.iter(line))
            if hits:
                # A feature may end on the blank after its word, which belongs to that word's sentence.
                for (_, i), at in zip(hits, np.searchsorted(ends, [p for p, _ in hits]).tolist(), strict=True):
                    found.setdefault(at, set()).add(i)
        return found, ends

    def fit(self, documents: list[tuple[list[list[int]], float]]) -> None:
        """Documents as (features of each sentence that has some, label)."""
        bare = [label for rows, label in documents if not rows]
        self.leak = (sum(bare) + 0.5) / (len(bare) + 50)
        documents = [x for x in documents if x[0]]
        if not documents:
            return
        owners = np.array([d for d, (rows, _) in enumerate(documents) for _ in rows], np.int64)
        flat = [row for rows, _ in documents for row in rows]
        at = np.repeat(np.arange(len(flat)), [len(x) for x in flat])
        which = np.array([i for row in flat for i in row], np.int64)
        label = np.array([d[1] for d in documents], float)
        share = np.where(label > 0, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
        theta, first, second = np.append(self.weights, self.bias), 0.0, 0.0
        for step in range(1, ROUNDS + 1):
            logits = np.bincount(at, theta[which], len(flat)) + theta[-1]
            p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            # The logarithm of the probability that no sentence is toxic.
            none = np.bincount(owners, np.log1p(-np.minimum(p, 1 - 1e-12)), len(documents)) + np.log1p(-self.leak)
            # The loss is -log(1 - exp(none)) for toxic documents and -none for others; none falls by p with a logit.
            slope = share * np.where(label > 0, np.exp(none) / -np.expm1(none), -1.0)
            by_sentence = -slope[owners] * p
            gradient = np.append(np.bincount(which, by_sentence[at], len(theta) - 1), by_sentence.sum())
            gradient[:-1] += PENALTY * theta[:-1]
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            theta = theta - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-10)
        self.weights, self.bias = theta[:-1], float(theta[-1])

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) of the offending stretches of its line."""
        found, ends = self.sentences(text)
        none = np.log1p(-self.leak)
        bad = []
        for k, features in found.items():
            p = 1 / (1 + np.exp(-min(30.0, max(-30.0, self.bias + self.weights[list(features)].sum()))))
            none += np.log1p(-min(p, 1 - 1e-12))
            if p >= OFFENDING:
                bad.append((int(ends[k - 1]) if k else 0, int(ends[k]), float(p)))
        return float(-np.expm1(none)) + 0.0, bad


def _spans(text: str, bad: list[tuple[int, int, float]]) -> list[dict]:
    """Stretches of the line as code points of the text, without blanks at their ends."""
    if not bad:
        return []
    raw = text.encode()
    if len(text.lower().encode()) != len(raw):
        # Lower case has other lengths: places are kept by lowering piece by piece.
        sizes = np.cumsum([0, 1, *(len(c.lower().encode()) for c in text), 1])
    else:
        sizes = np.cumsum([0, 1, *(len(c.encode()) for c in text), 1])
    spans = []
    for start, end, p in sorted(bad):
        a, b = (int(np.searchsorted(sizes, x)) - 1 for x in (start, min(end + 1, int(sizes[-1]))))
        a, b = max(0, a), min(len(text), max(0, b))
        piece = text[a:b]
        a += len(piece) - len(piece.lstrip(" \t\n.!?"))
        spans.append({"start": a, "end": max(a, a + len(text[a:b].rstrip())), "probability": p})
    return spans


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature, toxic documents and other documents of a task with it."""
    counts = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[toxic].update(features_of(text))
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield _as_batch(counts)
            counts = Counter(), Counter()
    yield _as_batch(counts)


def _as_batch(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
    names = list(counts[0].keys() | counts[1].keys())
    columns = [pa.array([n.encode("latin-1") for n in names], pa.binary()), *(pa.array([counts[k][n] for n in names], pa.int64()) for k in (1, 0))]
    return pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "other"])


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """The model of a bounded sample: SAMPLE_ROWS documents of each label, by the smallest hash of their ids.

    Held-out ids and null labels are not learned from; of several labels of an id the largest counts.
    """
    marks = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("toxic")).where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
    marks = marks.groupBy("id").agg(F.max("toxic").alias("toxic"))
    marks = thinned(marks.withColumn("hash", F.xxhash64(F.col("id").cast("string"))), "toxic", "hash", SAMPLE_ROWS)
    first = Window.partitionBy("toxic").orderBy("hash", "id")
    chosen = marks.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_ROWS).select("id", "toxic")
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text")).where("text is not null")
    # At most twice SAMPLE_ROWS ids.
    rows = in_small_batches(texts).join(F.broadcast(chosen), "id").select("text", "toxic")
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not total.get(1) or not total.get(0):
        return Model([])
    counted = rows.mapInArrow(_counted, "feature binary, toxic long, other long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    expected = (F.col("other") + 0.5) * (total[1] / total[0])
    deviation = (F.col("toxic") - expected) / F.sqrt(expected + 1)
    marked = counted.where((F.col("toxic") >= LEAST_SHARE * total[1]) & (deviation >= DEVIATIONS)).orderBy(deviation.desc(), "feature").limit(FEATURES)
    model = Model([bytes(r["feature"]).decode("latin-1") for r in marked.select("feature").collect()])
    shared = documents.sparkSession.sparkContext.broadcast(model.features)

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(shared.value)
        for batch in batches:
            found = [[sorted(x) for x in own.sentences(value)[0].values()] for value in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.list_(pa.int32()))), batch.column(1).cast(pa.float64())], ["rows", "label"])

    bags = rows.mapInArrow(seen, "rows array<array<int>>, label double")
    model.fit([(r["rows"], r["label"]) for r in bags.orderBy("label", "rows").collect()])
    return model


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, score, sentences) of every row: the noisy-or of its sentences, and those that offend as (start, end, probability).

    Only the text is an input.  Null and empty texts have no sentences and score the leak.  Repeated rows are kept.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.features, model.weights, model.bias, model.leak))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, bias, leak = shared.value
        own = Model(features)
        own.weights, own.bias, own.leak = weights, bias, leak
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        for batch in batches:
            scores, spans = [], []
            for value in batch.column(1):
                value = value.as_py()
                found, bad = own.score(value)
                scores.append(found)
                spans.append(_spans(value or "", bad))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, kind)], ["id", "score", "sentences"])

    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, score double, sentences array<struct<start:int,end:int,probability:double>>")
