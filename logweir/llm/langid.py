"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds all substrings of a bounded sample of labelled text.  A text is parsed
against each: the longest match from the current place is one phrase, then the next begins.  The phrases times the
bits that name a place in the sample, by character, are the cross-parsing entropy; the language with the least wins.

Letters count in lower case; everything else is one separator.  A text is parsed in pieces of at most PIECE symbols,
the same for all languages, so that many pieces advance together through the transition tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from logweir.llm.common import held_out, in_small_batches, thinned, worker_state

#: Different texts and symbols learned from for each language: the documented bound of the sample.
SAMPLE_ROWS = 40
SAMPLE_SYMBOLS = 24_000
#: Places of a long text that its share of the symbols comes from.
PLACES = 3
PIECE = 2_048
UNKNOWN = "und"
#: Symbols parsed at a time, which bounds memory.
CHUNK = 2_000_000

_PLANE = 0x110000


def symbols_of(text: str) -> np.ndarray:
    """Lower-case letters as code points, runs of other characters as a single 32; empty without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[codes], codes, 32)
    if not (points != 32).any():
        return points[:0]
    return points[np.concatenate(([True], (points[1:] != 32) | (points[:-1] != 32)))]


_letter_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _letter_table
    if _letter_table is None:
        _letter_table = np.fromiter((chr(c).isalpha() for c in range(_PLANE)), bool, _PLANE)
    return _letter_table


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings; state 0 is the start."""
    edges, link, length, last = [{}], [-1], [0], 0
    for symbol in symbols:
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        current, p = len(edges) - 1, last
        while p >= 0 and symbol not in edges[p]:
            edges[p][symbol] = current
            p = link[p]
        if p >= 0:
            q = edges[p][symbol]
            if length[p] + 1 == length[q]:
                link[current] = q
            else:
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                clone = len(edges) - 1
                while p >= 0 and edges[p].get(symbol) == q:
                    edges[p][symbol] = clone
                    p = link[p]
                link[q] = link[current] = clone
        last = current
    return edges


class Parser:
    """The automata of all languages as one table, ready for many pieces at once.

    A table entry is the offset of the next state's row, times two, plus one where a new phrase begins.
    """

    def __init__(self, samples: dict[str, list[np.ndarray]]):
        self.languages = sorted(samples)
        points = sorted({int(c) for texts in samples.values() for t in texts for c in t})
        self.code = np.ones(_PLANE, np.uint8 if len(points) < 250 else np.uint16)
        self.code[points] = np.arange(2, len(points) + 2)
        self.width = len(points) + 2
        tables, self.starts, self.bits, base = [], [], [], 0
        for language in self.languages:
            text = [c for t in samples[language] for c in (*self.code[t].tolist(), -1)]
            # A place's code needs the logarithm of the sample's length.
            self.bits.append(np.log2(max(2, len(text))))
            edges = suffix_automaton(text)
            # No way on: a phrase ends, and the next one begins with this symbol.  The last row is the start of a
            # text, where every symbol begins a phrase; an unknown symbol is a phrase of its own and leads there.
            begin = np.full(self.width, (len(edges) + base) << 1 | 1, np.int64)
            for symbol, to in edges[0].items():
                if symbol > 0:
                    begin[symbol] = (to + base) << 1 | 1
            table = np.tile(begin, (len(edges) + 1, 1))
            for state, out in enumerate(edges[1:], 1):
                for symbol, to in out.items():
                    if symbol > 0:
                        table[state, symbol] = (to + base) << 1
            tables.append(table)
            self.starts.append((len(edges) + base) * self.width)
            base += len(edges) + 1
        flat = np.concatenate([np.zeros((0, self.width), np.int64), *tables]).ravel()
        kind = np.int32 if base * self.width < 1 << 30 else np.int64
        self.table = ((flat >> 1) * self.width << 1 | flat & 1).astype(kind)

    def phrases(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases of each piece in each language, (languages, pieces)."""
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        longest = len(pieces[order[0]])
        padded = np.zeros((longest, len(pieces)), self.code.dtype)
        for column, at in enumerate(order):
            padded[: len(pieces[at]), column] = self.code[pieces[at]]
        alive = (padded != 0).sum(axis=1)
        counts = np.zeros((len(self.languages), len(pieces)), np.int32)
        states = np.repeat(np.array(self.starts, self.table.dtype)[:, None], len(pieces), axis=1)
        for step in range(longest):
            n = alive[step]
            found = self.table.take(states[:, :n] + padded[step, :n])
            counts[:, :n] += (found & 1).astype(np.int32)
            states[:, :n] = found >> 1
        result = np.empty_like(counts)
        result[:, order] = counts
        return result

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Bits by symbol of each text in each language, (texts, languages); NaN for texts without letters."""
        result = np.full((len(texts), len(self.languages)), np.nan)
        pieces, owners, size, lengths, totals = [], [], 0, np.zeros(len(texts)), np.zeros((len(self.languages), len(texts)))

        def flush() -> None:
            if pieces:
                found = self.phrases(pieces)
                for k in range(len(self.languages)):
                    np.add.at(totals[k], owners, found[k])

        for i, text in enumerate(texts):
            symbols = symbols_of(text or "")
            lengths[i] = len(symbols)
            for at in range(0, len(symbols), PIECE):
                pieces.append(symbols[at : at + PIECE])
                owners.append(i)
                size += len(pieces[-1])
                if size >= CHUNK:
                    flush()
                    pieces, owners, size = [], [], 0
        flush()
        known = lengths > 0
        result[known] = (totals[:, known] * np.array(self.bits)[:, None] / lengths[known]).T
        return result


def samples(documents: DataFrame, key: str, text: str, label: str) -> dict[str, list[np.ndarray]]:
    """At most SAMPLE_ROWS different texts and SAMPLE_SYMBOLS symbols of every language, from rows that are not held out.

    The texts are those with the smallest hashes; copies count once.  Each has an equal share of the symbols, a long
    one from PLACES places from its start to its end.  Held-out rows, null labels and texts without letters are left
    out.  The result is bounded by the number of languages.
    """
    rows = documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"), F.col(label).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out("id"))
    rows = thinned(rows.select("lang", F.xxhash64("text").alias("hash"), "text"), "lang", "hash", SAMPLE_ROWS, copies=True)
    copies = Window.partitionBy("lang", "hash").orderBy("text")
    rows = rows.withColumn("n", F.row_number().over(copies)).where("n = 1")
    first = Window.partitionBy("lang").orderBy("hash")
    rows = rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_ROWS)
    rows = rows.withColumn("share", F.floor(F.lit(SAMPLE_SYMBOLS) / F.count("*").over(Window.partitionBy("lang"))).cast("int"))
    # Characters become fewer symbols, so twice as many are brought.
    size, width = F.char_length("text"), F.floor(2 * F.col("share") / PLACES).cast("int")
    cut = [F.substring(F.col("text"), 1 + F.floor((size - width) * i / (PLACES - 1)).cast("int"), width) for i in range(PLACES)]
    pieces = F.when(size <= 2 * F.col("share"), F.array("text")).otherwise(F.array(*cut))
    found: dict[str, list[np.ndarray]] = {}
    for row in rows.select("lang", "n", "share", pieces.alias("pieces")).orderBy("lang", "n").collect():
        texts = found.setdefault(row["lang"], [])
        for piece in row["pieces"]:
            symbols = symbols_of(piece)[: row["share"] // len(row["pieces"])]
            if len(symbols):
                texts.append(symbols)
    return {k: v for k, v in found.items() if v}


def learn(documents: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> Parser:
    """The automata of the bounded samples of ``documents``; without usable rows there are none."""
    return Parser(samples(documents, key, text, label))


def _decided(models: Parser, texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
    """The language and the score of each text."""
    worker_state("langid")
    names = np.array([*models.languages, UNKNOWN], object)
    bits = models.entropies(texts)
    known = ~np.isnan(bits).any(axis=1) & bool(models.languages)
    best, score = np.full(len(bits), len(models.languages)), np.zeros(len(bits))
    if known.any():
        ranked = np.sort(bits[known], axis=1)
        best[known] = bits[known].argmin(axis=1)
        score[known] = 1 - ranked[:, 0] / ranked[:, 1] if ranked.shape[1] > 1 else 1.0
    return pa.array(names[best], pa.string()), pa.array(score)


def identify(documents: DataFrame, models: Parser, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row of ``documents``; only the text is an input.

    ``lang_pred`` is UNKNOWN and the score 0 if the text is null or has no letter, or if no model was learned.  The
    score is 1 less the ratio of the least entropy to the next (1 with a single language).  Equal entropies go to the
    smaller label.  Repeated rows are kept; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *_decided(shared.value, batch.column(1).to_pylist())], ["id", "lang_pred", "score"])

    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, lang_pred string, score double")


def accepted(documents: DataFrame, models: Parser, text: str = "text", label: str = "lang") -> DataFrame:
    """The rows whose language is known, with all columns; a null ``label`` is filled with the language found."""
    shared = documents.sparkSession.sparkContext.broadcast(models)

    @F.arrow_udf(StringType())
    def language(texts: pa.Array) -> pa.Array:
        return _decided(shared.value, texts.to_pylist())[0]

    names, own = documents.columns, "_language"
    while own in names:
        own += "_"
    found = in_small_batches(documents).withColumn(own, language(F.col(text).cast("string"))).where(F.col(own) != UNKNOWN)
    return found.withColumn(label, F.coalesce(F.col(label), F.col(own))).select(*names)
