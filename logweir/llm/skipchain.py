"""Personal data: exact base patterns, and a skip-chain conditional random field over the tokens that hold data.

The base patterns give spans that always stand.  The field labels the tokens with a digit or an at sign: tokens that
a base span touches keep its kind, the others are inferred.  Neighbouring tokens share a chain potential; a token and
the next one with the same or a similar form, however distant, share a skip potential, and so do a token without a
base span and the nearest earlier one of that form with a base span (the first later one if there is none): what a
base span tells reaches every repeat in one hop, so that labels agree across a document.  Marginals come from loopy
sum-product messages, passed until they settle.  A span is added where they are sure.

The potentials are trained piecewise, each by the counts of what it joins, on a bounded sample of documents that the
base patterns label.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from logweir.llm.common import in_small_batches, thinned, worker_state

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Documents learned from (the documented bound), the weight of what was not seen, and rounds of messages at most, far
#: more than they take to settle but where they never do.
SAMPLE_ROWS = 4_000
SMOOTHING = 0.5
ROUNDS, DAMPING, SETTLED = 1_000, 0.5, 1e-4
#: A span is added where the label's marginal reaches this.
SURE = 0.9
#: Numbers with this many digits are similar if the last ones of them agree.
SIMILAR_DIGITS = 7

# The base patterns.  A run of digits that fails as a whole fails from any of its digits, and so does
# what stands before an at sign, so the searches may begin at a run's start only.
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DATA = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S*?[0-9@]\S*")
_EDGES = "\"'.,;:!?|<>[]{}*#$%&=~`"


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) << (i & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for found in _AT.finditer(text):
        start = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            yield start, found.end()
            done = found.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, kinds by number, in order."""
    spans = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for found in _IP.finditer(text):
        parts = (p.lstrip(".").lstrip("0") for p in found.groups())
        if all(len(p) < 4 and int(p or 0) <= 255 for p in parts):
            spans.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        digits = _digits(found[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append((found.start(), 2, found.end()))
    if "+" in text:
        spans += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(spans)


def _shape(token: str) -> str:
    """What a token looks like: one of a bounded number of forms."""
    digits = _digits(token)
    size = next((str(n) for n in (0, 1, 2, 3, 4, 6, 9, 13, 19) if len(digits) <= n), "more")
    marks = "".join(f"{c}{min(4, token.count(c))}" for c in "@.+(-" if c in token)
    letters = "a" if any(c.isalpha() for c in token) else ""
    proof = "l" if 14 <= len(digits) <= 19 and _luhn(digits) else ""
    return f"{size} {marks} {letters}{proof}"


def _forms(token: str) -> list[str]:
    """Keys that a token shares with the same and similar ones."""
    if "@" in token:
        name, _, host = token.lower().partition("@")
        return [f"@{name}@{host.split('.')[0]}"]
    if any(c.isalpha() for c in token):
        return [token.lower()]
    digits = _digits(token)
    found = [f"={digits}.{token.count('.')}" if len(digits) > 3 else ""]
    if len(digits) >= SIMILAR_DIGITS and "." not in token:
        found.append(f"~{digits[-SIMILAR_DIGITS:]}")
    return [x for x in found if x]


class Graph:
    """The tokens of one document: places, shapes, base labels (or -1), chain and skip edges.

    ``tied`` are the edges to a token with a base span that are not skip edges, at most one a token and form.
    """

    def __init__(self, text: str, spans: list[tuple[int, int, int]]):
        self.places, self.given, shapes, chain, skip, last = [], [], [], [], [], {}
        at, before, sure, waiting, tied = 0, None, {}, {}, []
        for found in _TOKEN.finditer(text):
            start, end = found.span()
            while start < end and text[start] in _EDGES:
                start += 1
            while end > start and text[end - 1] in _EDGES:
                end -= 1
            token = text[start:end]
            if not _DATA.search(token):
                continue
            while at < len(spans) and spans[at][2] <= start:
                at += 1
            kind = next((k + 1 for a, k, b in spans[at : at + 8] if a < end and b > start), -1)
            n = len(self.places)
            if before is not None and found.start() - before <= 1:
                chain.append((n - 1, n))
            before = found.end()
            for form in _forms(token):
                if form in last:
                    skip.append((last[form], n))
                last[form] = n
                if kind >= 0:
                    tied += [(m, n) for m in waiting.pop(form, ())]
                    sure[form] = n
                elif form in sure:
                    tied.append((sure[form], n))
                else:
                    waiting.setdefault(form, []).append(n)
            self.places.append((start, end))
            self.given.append(kind)
            shapes.append(_shape(token))
        self.shapes = shapes
        self.chain, self.skip = chain, list(dict.fromkeys(skip))
        self.tied = sorted(set(tied) - set(skip))


class Field:
    """Potentials in logarithms: by shape, and of the two kinds of edges."""

    def __init__(self, counts: dict[tuple[str, str, int, int], int]):
        size = len(LABELS)
        unary: dict[str, np.ndarray] = {}
        pairs = {"chain": np.zeros((size, size)), "skip": np.zeros((size, size))}
        total = np.zeros(size)
        for (part, shape, a, b), n in counts.items():
            if part == "shape":
                unary.setdefault(shape, np.zeros(size))[a] += n
                total[a] += n
            else:
                pairs[part][a, b] += n
        # A shape not seen is no personal data but for the smoothing.
        prior = np.full(size, 0.02)
        prior[0] = 1.0
        self.unknown = np.log(prior / prior.sum())
        self.unary = {s: np.log((c + SMOOTHING * prior) / (c + SMOOTHING * prior).sum()) for s, c in unary.items()}
        self.pairs = {}
        for part, joint in pairs.items():
            joint = joint + joint.T if part == "skip" else joint
            joint = joint + SMOOTHING * (0.02 + np.eye(size))
            share = joint / joint.sum()
            self.pairs[part] = np.log(share / np.outer(share.sum(1), share.sum(0)))

    def marginals(self, graph: Graph) -> np.ndarray:
        """The probability of each label of each token, by loopy sum-product messages."""
        size, n = len(LABELS), len(graph.places)
        own = np.array([self.unary.get(s, self.unknown) for s in graph.shapes])
        for i, kind in enumerate(graph.given):
            if kind >= 0:
                # Out of reach of any number of edges.
                own[i] = np.where(np.arange(size) == kind, 0.0, -1e6)
        edges = [(a, b, self.pairs["chain"]) for a, b in graph.chain] + [(a, b, self.pairs["skip"]) for a, b in graph.skip + graph.tied]
        belief = own
        if edges:
            source = np.array([a for a, _, _ in edges] + [b for _, b, _ in edges])
            target = np.array([b for _, b, _ in edges] + [a for a, _, _ in edges])
            weight = np.array([p for _, _, p in edges] + [p.T for _, _, p in edges])
            back = np.concatenate((np.arange(len(edges)) + len(edges), np.arange(len(edges))))
            messages = np.zeros((len(source), size))
            for _ in range(ROUNDS):
                belief = own.copy()
                np.add.at(belief, target, messages)
                out = (belief[source] - messages[back])[:, :, None] + weight
                top = out.max(axis=1)
                out = np.log(np.exp(out - top[:, None, :]).sum(axis=1)) + top
                out -= out.max(axis=1, keepdims=True)
                moved = np.abs(out - messages).max()
                messages = DAMPING * messages + (1 - DAMPING) * out
                if moved < SETTLED:
                    break
            belief = own.copy()
            np.add.at(belief, target, messages)
        belief = np.exp(belief - belief.max(axis=1, keepdims=True))
        return belief / belief.sum(axis=1, keepdims=True) if n else belief

    def spans(self, text: str) -> list[tuple[int, int, int, bool, float]]:
        """(start, kind, end, base, probability) of the base spans and the added ones, in order."""
        if not _DATA.search(text):
            return []
        base = base_spans(text)
        found = [(a, k, b, True, 1.0) for a, k, b in base]
        graph = Graph(text, base)
        if any(k < 0 for k in graph.given):
            marginals = self.marginals(graph)
            best, sure = marginals.argmax(axis=1), marginals.max(axis=1)
            joined = {b for a, b in graph.chain}
            open_at = -1
            for i, (start, end) in enumerate(graph.places):
                if graph.given[i] >= 0 or not best[i] or sure[i] < SURE:
                    open_at = -1
                    continue
                kind = int(best[i]) - 1
                # Neighbours of one label are one span, unless each is a whole address or card number.
                whole = kind < 2 or len(_digits(text[start:end])) >= 14
                if open_at >= 0 and i in joined and found[open_at][1] == kind and not whole:
                    a, _, _, _, p = found[open_at]
                    found[open_at] = (a, kind, end, False, min(p, float(sure[i])))
                else:
                    found.append((start, kind, end, False, float(sure[i])))
                    open_at = len(found) - 1
        return sorted(found)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            graph = Graph(text, base_spans(text))
            label = [max(0, k) for k in graph.given]
            counts.update(("shape", s, k, 0) for s, k in zip(graph.shapes, label, strict=True))
            counts.update(("chain", "", label[a], label[b]) for a, b in graph.chain)
            counts.update(("skip", "", label[a], label[b]) for a, b in graph.skip)
    rows = list(counts)
    columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int32()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([counts[r] for r in rows], pa.int64())], ["part", "shape", "a", "b", "n"])


def train(documents: DataFrame, text: str = "text") -> Field:
    """The field of the different texts with a digit or an at sign that have the smallest hashes.

    They are SAMPLE_ROWS and half as many again, within the chance of hashes; each task counts its own.

    What comes to the driver are counts by shape, of which there is a bounded number.
    """
    rows = in_small_batches(documents).select(F.col(text).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    rows = thinned(rows.select("text", F.xxhash64("text").alias("hash"), F.lit(1).alias("all")), "all", "hash", SAMPLE_ROWS, copies=True)
    copies = Window.partitionBy("hash").orderBy("text")
    sample = rows.withColumn("n", F.row_number().over(copies)).where("n = 1").select("text")
    counts = sample.mapInArrow(_counted, "part string, shape string, a int, b int, n long").groupBy("part", "shape", "a", "b").agg(F.sum("n").alias("n"))
    return Field({(r["part"], r["shape"], r["a"], r["b"]): r["n"] for r in counts.collect()})


def find(documents: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, spans) of every row: (kind, start, end, base, probability) in order of start, then kind.

    Places are code points, the end exclusive.  A null text counts as empty.  Repeated rows are kept.
    """
    shared = documents.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"kind": KINDS[k], "start": a, "end": b, "base": base, "probability": p} for a, k, b, base, p in shared.value.spans(text.as_py() or "")]
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["id", "spans"])

    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    return chosen.mapInArrow(
        run, f"id {chosen.schema['id'].dataType.simpleString()}, spans array<struct<kind:string,start:int,end:int,base:boolean,probability:double>>"
    )


def redact(documents: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows with each stretch of touching spans replaced by its first kind, as in [email]; other columns stay."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf(StringType())
    def cleaned(texts: pa.Array) -> pa.Array:
        worker_state("skipchain")
        return pa.array([None if t is None else replaced(t, shared.value.spans(t)) for t in (x.as_py() for x in texts)], pa.string())

    return in_small_batches(documents).withColumn(text, cleaned(F.col(text)))


def replaced(text: str, spans: list[tuple[int, int, int, bool, float]]) -> str:
    out, at = [], 0
    for start, kind, end, _, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text
