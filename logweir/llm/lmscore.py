"""Documents scored by cross-entropy difference between a target and a background n-gram model.

Both models are bigram models over all words of all documents, with the same smoothing; the target model counts the
documents that are marked, the background model all documents.  Vocabulary and counts grow with the corpus and are
never gathered: documents are dealt into blocks of about BLOCK_BYTES by their ids.  A block names each of its words,
histories and pairs once, with its own counts, to the bucket that the name's hash falls into; a bucket adds up all
blocks and answers each with the sums of what it named; the block then scores its documents.  A frequent word is one
entry of every block, however often it stands there; a block sends nothing where it names nothing, so there are no more
pieces than names.  The totals of all buckets are added up beside, as one row.  Nothing but the size of the texts comes to the driver.

Names are 63 bits of hashes: among a billion distinct ones, two share a sum with a probability of about 5 %.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import in_small_batches, worker_state
from logweir.llm.decontam import words_of

#: The least number of places that a unigram model spreads its smoothing over: a start, an unknown word, all words.
VOCABULARY = 1_024
START, OTHER = 0, 1
#: Weight of the unigram model within the bigram model, in tokens of a history.
PRIOR = 8.0
#: Bytes of text in a block and for each bucket, which bound the memory of a task; the least number of buckets.
BLOCK_BYTES = 4_000_000
BUCKET_BYTES = 32_000_000
BUCKETS = 64
#: Words whose hashes a worker remembers.
REMEMBERED = 300_000

_WORD_BYTE = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))
_START_HASH = np.uint64(0x9E3779B97F4A7C15)
_SENT = "block int, bucket int, n long, keys binary, target binary, background binary"
_ANSWER = "block int, bucket int, n long, target binary, background binary"
_TOTALS = "words long, target_tokens long, background_tokens long"


class _Hashes(dict):
    """Word to hash; forgets everything when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 1)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _named(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted names of a block; the places in them of each token's pair, word and history; each text's tokens.

    The places are (3, tokens).  Words have odd names, pairs and histories even ones.
    """
    hashes = worker_state("lmscore", make=_Hashes)
    parts, lengths = [], []
    for value in texts.cast(pa.large_binary()):
        words = (value.as_py() or b"").lower().translate(_WORD_BYTE).split()
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        lengths.append(len(words))
    lengths = np.array(lengths, np.int64)
    word = np.concatenate([np.zeros(0, np.uint64), *parts])
    before = np.concatenate(([_START_HASH], word[:-1])) if len(word) else word
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = _START_HASH
    once = _mixed(before)
    even = ~np.uint64(1)
    names, places = np.unique(np.concatenate((_mixed(once + word) & even, word | np.uint64(1), once & even)), return_inverse=True)
    return names, places.reshape(3, -1), lengths


def _packed(values: np.ndarray) -> bytes:
    """64-bit numbers by the planes of their bytes, most of which are zeros."""
    return pa.compress(np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def _rows(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({name: pa.array([r[i] for r in rows], kinds[kind]) for i, (name, kind) in enumerate(fields)})


def _summed(pieces: pa.Table) -> pa.Table:
    """A bucket's sums, answered to each block in the order of the names that it sent."""
    rows = pieces.to_pylist()
    names, places = np.unique(np.concatenate([np.cumsum(_unpacked(r["keys"], r["n"]), dtype=np.uint64) for r in rows]), return_inverse=True)
    sums = np.zeros((2, len(names)), np.int64)
    ends = np.cumsum([r["n"] for r in rows])
    for row, end in zip(rows, ends, strict=True):
        # A block sends a name once.
        at = places[end - row["n"] : end]
        for own, kind in zip(sums, ("target", "background"), strict=True):
            own[at] += _unpacked(row[kind], row["n"]).astype(np.int64)
    found = []
    for row, end in zip(rows, ends, strict=True):
        some = sums[:, places[end - row["n"] : end]]
        found.append((row["block"], row["bucket"], row["n"], _packed(some[0]), _packed(some[1])))
    return _rows(_ANSWER, found)


def _totalled(pieces: pa.Table) -> pa.Table:
    """A bucket's distinct words and tokens."""
    names, tokens = [], [0, 0]
    for row in pieces.to_pylist():
        own = np.cumsum(_unpacked(row["keys"], row["n"]), dtype=np.uint64)
        words = (own & np.uint64(1)).astype(bool)
        names.append(own[words])
        for i, kind in enumerate(("target", "background")):
            tokens[i] += int(_unpacked(row[kind], row["n"])[words].sum())
    return _rows(_TOTALS, [(len(np.unique(np.concatenate(names))), *tokens)])


def bits(pair: np.ndarray, word: np.ndarray, history: np.ndarray, total: float, places: int) -> np.ndarray:
    """Bits of a word after a history: bigram counts with the smoothed unigram model as their prior."""
    return -np.log2((pair + PRIOR * (word + 1.0) / (total + places)) / (history + PRIOR))


def vocabulary(documents: DataFrame, text: str = "text") -> dict[bytes, int]:
    """The words of a small table with their numbers, for a dense form of the models that tests compare with."""
    counts = documents.select(F.explode(words_of(F.col(text))).alias("word")).groupBy("word").count()
    return {row["word"].encode(): i for i, row in enumerate(counts.orderBy(F.desc("count"), "word").collect(), 2)}


def losses(counted: np.ndarray) -> np.ndarray:
    """Bits of each word after each word, from a dense table of bigram counts."""
    return bits(counted, counted.sum(axis=0), counted.sum(axis=1, keepdims=True), counted.sum(), len(counted)).astype(np.float32)


def score(documents: DataFrame, marked: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) of every row.

    ``marked`` (column ``key``) names the target's documents; repeated and null names count once and not at all.
    Losses are bits by token, the score is the target's loss less the background's: the lower, the closer to the
    target.  A text without words has no tokens and zeros.  Repeated rows are kept and count as often as they stand;
    rows of one id, or of one text without an id, share a block.
    """
    chosen = in_small_batches(documents.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text")))
    size = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = size // BLOCK_BYTES + 1, max(BUCKETS, size // BUCKET_BYTES + 1)
    kind = chosen.schema["id"].dataType
    names = marked.select(F.col(key).try_cast(kind).alias("id")).where("id is not null").distinct()
    edges = np.array([((i << 64) + buckets - 1) // buckets for i in range(1, buckets)], np.uint64)

    def block_of(frame: DataFrame, by: list) -> DataFrame:
        return frame.withColumn("block", F.pmod(F.xxhash64(F.coalesce(*by)), F.lit(blocks)).cast("int"))

    texts = block_of(chosen, [F.col("id").cast("string"), F.col("text")]).groupBy("block")

    def count(own: pa.Table, target: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _rows(_SENT, [])
        block = own["block"][0].as_py()
        found, places, lengths = _named(own["text"])
        chosen = np.repeat(pc.is_in(own["id"], target["id"].combine_chunks()).to_numpy(), lengths)
        both = [np.bincount(p.ravel(), minlength=len(found)) for p in (places[:, chosen], places)]
        cuts = [0, *np.searchsorted(found, edges).tolist(), len(found)]
        rows = []
        for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if a == b:
                continue
            rows.append((block, bucket, b - a, _packed(np.diff(found[a:b], prepend=np.uint64(0))), *(_packed(x[a:b]) for x in both)))
        return _rows(_SENT, rows)

    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        found, places, lengths = _named(own["text"])
        rows = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
        if sum(r["n"] for r in rows) != len(found):
            raise ValueError("the counts are not those of this block's texts")
        # A block without words has no answers and needs no totals.
        totals = rows[0]["totals"] if rows else {"words": 0, "target_tokens": 0, "background_tokens": 0}
        size = max(VOCABULARY, totals["words"] + 2)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        each = []
        for kind in ("target", "background"):
            sums = np.concatenate([np.zeros(0), *(_unpacked(r[kind], r["n"]) for r in rows)])
            lost = bits(*sums[places], totals[f"{kind}_tokens"], size)
            each.append(np.bincount(owner, lost, len(lengths)) / np.maximum(lengths, 1))
        return pa.table([own["id"], pa.array(lengths), *(pa.array(x) for x in (*each, each[0] - each[1]))], ["id", "n_tokens", "target_loss", "background_loss", "score"])

    sent = texts.cogroup(block_of(names, [F.col("id").cast("string")]).groupBy("block")).applyInArrow(count, _SENT)
    bucketed = sent.groupBy("bucket")
    # Both read the same exchange; the totals are one row.
    sums = [F.coalesce(F.sum(c.split()[0]), F.lit(0)).alias(c.split()[0]) for c in _TOTALS.split(", ")]
    totals = bucketed.applyInArrow(_totalled, _TOTALS).agg(*sums).select(F.struct("*"))
    answers = bucketed.applyInArrow(_summed, _ANSWER).withColumn("totals", totals.scalar())
    return texts.cogroup(answers.groupBy("block")).applyInArrow(
        run, f"id {kind.simpleString()}, n_tokens long, target_loss double, background_loss double, score double"
    )
