"""Byte-level BPE: encoding and decoding by recursive DuckDB queries inside each partition.

Spark deals out the documents.  In a task every new word (a match of the splitting pattern) becomes rows of byte
tokens.  A recursive query joins neighbouring tokens with the merge table and contracts each word's smallest-rank
pair, leftmost first and without overlap, until no word has a pair left; an ordered aggregation gathers a word's
ids.  A task's words are kept for its later batches up to a bound, then forgotten.  The bytes of a document come
from another ordered aggregation, over all its ids joined with the vocabulary.

A long word is contracted in pieces whose seams are mended.  Tokens are a word's encoding exactly if each two
neighbours are the encoding of their own bytes: a merge across a boundary would happen in those two alone as well.
So the tokens around a seam are encoded anew, more of them until the outermost ones come out unchanged; from there
on all neighbours are old ones.  Pieces are joined by twos, so the work grows with the word's length.

Contracting all non-overlapping places of the smallest rank at once, as wide seams do, equals one at a time for
vocabularies in which every token encodes to itself, as those trained by merging do (a test checks the file used).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.common import in_small_batches, release_memory, worker_state

#: Words a worker remembers, bytes of new words and ids in one query, characters of texts at a time: bounds on memory, without effect on results.
KEPT_WORDS = 300_000
QUERY_BYTES = 300_000
QUERY_TOKENS = 150_000
QUERY_CHARS = 2_000_000

#: Stretches up to this many bytes contract one pair in a round; longer ones all places of their smallest rank.
SHORT = 64
#: Words over SHORT bytes are cut into pieces of so many; a seam takes so many tokens of either side at first.
PIECE_BYTES, SEAM_TOKENS = 32, 4

_SHORT = """
WITH RECURSIVE state(word, toks) AS (
    SELECT word, list(tok ORDER BY pos) FROM start GROUP BY word
    UNION ALL
    SELECT s.word, s.toks[:b.best % 64] || [(b.best // 64)::INTEGER] || s.toks[b.best % 64 + 3:]
    FROM state s JOIN (
        SELECT word, min(m.rank::BIGINT * 64 + p.pos) AS best
        FROM (
            SELECT word, unnest(toks[:-2]) AS tok, unnest(toks[2:]) AS nxt, generate_subscripts(toks[2:], 1) - 1 AS pos
            FROM state
        ) p JOIN merges m ON m.pair = p.tok::BIGINT * 4294967296 + p.nxt
        GROUP BY word
    ) b ON b.word = s.word
)
SELECT word, arg_min(toks, len(toks)) AS ids FROM state GROUP BY word ORDER BY word
"""

_LONG = """
WITH RECURSIVE state(word, pos, tok, live) AS (
    SELECT word, pos, tok, true FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN hit THEN low ELSE tok END, low IS NOT NULL
    FROM (
        SELECT *, coalesce(lag(hit) OVER (PARTITION BY word ORDER BY pos), false) AS gone
        FROM (
            SELECT word, pos, tok, low,
                   coalesce(rank = low, false)
                   AND (nth - coalesce(max(CASE WHEN rank = low THEN NULL ELSE nth END) OVER (PARTITION BY word ORDER BY pos), 0)) % 2 = 1 AS hit
            FROM (
                SELECT p.word, p.pos, p.tok, p.nth, m.rank, min(m.rank) OVER (PARTITION BY p.word) AS low
                FROM (
                    SELECT word, pos, tok, lead(tok) OVER (PARTITION BY word ORDER BY pos) AS nxt,
                           row_number() OVER (PARTITION BY word ORDER BY pos) AS nth
                    FROM state WHERE live
                ) p LEFT JOIN merges m ON m.pair = p.tok::BIGINT * 4294967296 + p.nxt
            )
        )
    )
    WHERE NOT gone
)
SELECT word, list(tok ORDER BY pos) AS ids FROM state WHERE NOT live GROUP BY word ORDER BY word
"""

# A byte is the character of its number, so an aggregated text is a sequence of bytes.
_DECODE = """
SELECT array_to_string(list(v.plain ORDER BY nth), '') AS plain FROM given t JOIN vocabulary v ON v.id = t.id
"""


def ranks_of(content: bytes) -> dict[bytes, int]:
    """Token bytes -> rank, from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines()) if token}


class Coder:
    """The vocabulary of one worker in an in-memory database, and the words it has seen."""

    def __init__(self, content: bytes, pattern: str, kept_words: int = KEPT_WORDS):
        self.split, self.kept_words = regex.compile(pattern).findall, kept_words
        ranks = ranks_of(content)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = [
            (ranks[token[:cut]] << 32 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.db = duckdb.connect(config={"threads": "1", "memory_limit": "100MB"})
        self._table("merges", pair=[p for p, _ in pairs], rank=pa.array([r for _, r in pairs], pa.int32()))
        self._table("vocabulary", id=pa.array(list(ranks.values()), pa.int32()), plain=[t.decode("latin-1") for t in ranks])
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int32)
        self.lengths[list(ranks.values())] = [len(t) for t in ranks]
        #: Words of two generations: those of the last one that come again move to the new one, the rest is forgotten.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _table(self, name: str, **columns) -> None:
        given = pa.table(columns)
        self.db.register("given_table", given)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given_table")
        self.db.unregister("given_table")

    def _contract(self, raw: list[bytes], query: str) -> pa.Array:
        """The ids of each stretch of bytes, in one query."""
        lengths = np.array([len(x) for x in raw])
        size, starts = int(lengths.sum()), np.cumsum(lengths) - lengths
        rows = pa.table(
            {
                "word": np.repeat(np.arange(len(raw), dtype=np.int32), lengths),
                "pos": (np.arange(size) - np.repeat(starts, lengths)).astype(np.int32),
                "tok": self.byte_ids[np.frombuffer(b"".join(raw), np.uint8)],
            }
        )
        self.db.register("start", rows)
        lists = self.db.sql(query).to_arrow_table().column("ids").combine_chunks()
        self.db.unregister("start")
        return lists

    def _contracted(self, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of each stretch of bytes, a bounded number of bytes a query."""
        found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(raw)
        order = sorted((i for i in range(len(raw)) if raw[i]), key=lambda i: len(raw[i]))
        at = 0
        while at < len(order):
            end, size = at, 0
            short = len(raw[order[at]]) <= SHORT
            while end < len(order) and (end == at or size < QUERY_BYTES and (len(raw[order[end]]) <= SHORT) == short):
                size += len(raw[order[end]])
                end += 1
            lists = self._contract([raw[i] for i in order[at:end]], _SHORT if short else _LONG)
            ids, cuts = lists.flatten().to_numpy(zero_copy_only=False).astype("<i4"), np.asarray(lists.offsets).tolist()
            for i, first, last in zip(order[at:end], cuts, cuts[1:], strict=False):
                found[i] = ids[first:last]
            at = end
        return found

    def _joined(self, pairs: list[tuple[bytes, np.ndarray, bytes, np.ndarray]]) -> list[tuple[bytes, np.ndarray]]:
        """The bytes and the ids of each two neighbouring stretches as one, from those of both."""
        out: list[tuple[bytes, np.ndarray]] = [(b"", np.zeros(0, np.int32))] * len(pairs)
        todo = dict.fromkeys(range(len(pairs)), SEAM_TOKENS)
        while todo:
            seams = []
            for i, n in todo.items():
                left, a, right, b = pairs[i]
                before, after = int(self.lengths[a[-n:]].sum()), int(self.lengths[b[:n]].sum())
                seams.append(left[len(left) - before :] + right[:after])
            wider = {}
            for (i, n), seam in zip(todo.items(), self._contracted(seams), strict=True):
                left, a, right, b = pairs[i]
                if (n >= len(a) or seam[0] == a[-n]) and (n >= len(b) or seam[-1] == b[n - 1]):
                    out[i] = left + right, np.concatenate([a[: max(0, len(a) - n)], seam, b[n:]])
                else:
                    wider[i] = 2 * n
            todo = wider
        return out

    def _whole(self, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of long words: pieces are contracted, then neighbours joined until a word is one stretch."""
        cut = [[x[i : i + PIECE_BYTES] for i in range(0, len(x), PIECE_BYTES)] for x in raw]
        ids = iter(self._contracted(list(chain.from_iterable(cut))))
        parts = [[(x, next(ids)) for x in pieces] for pieces in cut]
        while any(len(p) > 1 for p in parts):
            joined = iter(self._joined([(*p[i], *p[i + 1]) for p in parts for i in range(0, len(p) - 1, 2)]))
            parts = [[next(joined) if i + 1 < len(p) else p[i] for i in range(0, len(p), 2)] for p in parts]
        return [p[0][1] for p in parts]

    def learn(self, words: list[str]) -> None:
        """Encode words not known."""
        for fits, found in ((lambda x: len(x) <= SHORT, self._contracted), (lambda x: len(x) > SHORT, self._whole)):
            chosen = [(w, x) for w, x in ((w, w.encode()) for w in words) if fits(x)]
            for (word, _), ids in zip(chosen, found([x for _, x in chosen]), strict=True):
                self.known[word] = ids.tobytes()

    def encode(self, texts: list[str]) -> tuple[pa.Array, pa.Array]:
        """The ids of each text, and the bytes they decode to."""
        if len(self.known) > self.kept_words:
            self.known, self.older = {}, self.known
        split = [self.split(text) for text in texts]
        known, older = self.known, self.older
        fresh = set(chain.from_iterable(split)).difference(known)
        again = fresh.intersection(older)
        known.update((word, older[word]) for word in again)
        self.learn(list(fresh - again))
        lists, lengths = [], [0]
        for words in split:
            lists.append(b"".join(map(known.__getitem__, words)))
            lengths.append(lengths[-1] + len(lists[-1]) // 4)
        coded = pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.frombuffer(b"".join(lists), "<i4")))
        return coded, pa.array(self.decode(coded), pa.binary())

    def decode(self, lists: pa.Array) -> list[bytes]:
        """The bytes of each list of ids: those of all lists in their order, so many ids a query, cut by length."""
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
        known = (ids >= 0) & (ids < len(self.lengths))
        ends = np.concatenate([[0], np.cumsum(np.where(known, self.lengths[np.where(known, ids, 0)], 0))])[np.cumsum(sizes)].tolist()
        parts = []
        for at in range(0, len(ids), QUERY_TOKENS):
            chosen = ids[at : at + QUERY_TOKENS]
            self.db.register("given", pa.table({"id": chosen, "nth": np.arange(len(chosen), dtype=np.int32)}))
            parts.append(self.db.sql(_DECODE).fetchall()[0][0] or "")
            self.db.unregister("given")
        whole = "".join(parts).encode("latin-1")
        return [whole[at:end] for at, end in zip([0, *ends], ends, strict=False)]


def _coder(content: Broadcast, pattern: str, kept_words: int = KEPT_WORDS) -> Coder:
    return worker_state("bpe", (hash(content.value), pattern, kept_words), lambda: Coder(content.value, pattern, kept_words))


def _vocabulary(spark: SparkSession, path: str) -> Broadcast:
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    documents: DataFrame,
    path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    kept_words: int = KEPT_WORDS,
    query_chars: int = QUERY_CHARS,
) -> DataFrame:
    """(id, ids, decoded) of every row: the token ids of the whole text, and the bytes that decoding them gives.

    ``path`` is a rank file on the driver (its size is that of a vocabulary, so it is broadcast), ``pattern`` the
    expression whose matches are encoded separately.  There are no special tokens.  ``kept_words`` bounds what a worker
    remembers (about 0.3 kB a word, twice over), ``query_chars`` how much text is split at a time; neither changes the result.  A null or empty text has no ids.
    Repeated rows are kept; other columns are not read.
    """
    vocabulary = _vocabulary(documents.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern, kept_words)
        for batch in batches:
            keys, texts, size, at = batch.column(0), [], 0, 0
            for i, text in enumerate(batch.column(1), 1):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= query_chars or i == len(batch):
                    yield pa.RecordBatch.from_arrays([keys.slice(at, len(texts)), *coder.encode(texts)], ["id", "ids", "decoded"])
                    texts, size, at = [], 0, i
        release_memory()

    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, ids array<int>, decoded binary")


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "id", ids: str = "ids") -> DataFrame:
    """(id, decoded) of every row of any id sequences; unknown ids give no bytes, null or empty lists none at all."""
    vocabulary = _vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coder.decode(batch.column(1)), pa.binary())], ["id", "decoded"])

    chosen = in_small_batches(encoded).select(F.col(key).alias("id"), F.col(ids).cast("array<int>").alias("ids"))
    return chosen.mapInArrow(run, f"id {chosen.schema['id'].dataType.simpleString()}, decoded binary")
