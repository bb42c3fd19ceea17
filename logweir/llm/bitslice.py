"""Exact top-k search by a bit-sliced index.

The index cuts the rows into blocks of one vector length.  In a block each component is a bit-sliced attribute: less
its smallest value, its bits are bitmaps over the block's rows, most of them short.  A query weighs the attributes:
a negative weight takes the complement (the largest value less the component), so that all weights are positive up
to a constant.  The weighted slices are added by bitmap arithmetic (carry-save adders: three bitmaps of one weight
become a sum and a carry) until one bitmap for each power of two is left: the scores of all rows, bit by bit.

The top rows are chosen from the most significant slice downward: the rows certain to be among the k best, and the
rows that tie with the boundary so far.  Rows still tied at the end have equal scores and are taken by id.

Blocks of rows meet blocks of queries, each pair once; the best k of each pair are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import written

#: Rows of a block and queries of a block.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 1_024
#: Components of larger size are not sliced: their products are summed as whole numbers of any size.
LARGE = 1 << 30
LONGEST = (1 << 63) - 1
#: From this size on, sums of products leave 64-bit arithmetic; half a long, as both signs may add up.
EXACT = 2.0**61
#: Tasks of a search at most.
MOST_TASKS = 100_000

_INDEX = "rows long, ids binary, lows binary, widths binary, slices binary, wide binary"


def _sliced(values: np.ndarray, ids: np.ndarray) -> dict:
    """One block: ids, each attribute's smallest value and number of slices, and its slices, least bit first."""
    order = np.argsort(ids, kind="stable")
    values, ids = values[order], ids[order]
    n, length = values.shape
    rest = {"rows": n, "ids": ids.astype("<i8").tobytes()}
    if not length:
        return rest | {"lows": b"", "widths": b"", "slices": b"", "wide": None}
    lows, highs = values.min(axis=0), values.max(axis=0)
    if max(abs(int(lows.min())), abs(int(highs.max()))) >= LARGE:
        return rest | {"lows": b"", "widths": b"", "slices": b"", "wide": values.astype("<i8").tobytes()}
    words = -(-n // 64)
    widths = np.array([int(h - l).bit_length() for l, h in zip(lows, highs, strict=True)])
    slices = np.zeros((int(widths.sum()), words * 64), np.uint8)
    at = 0
    for column in range(length):
        shifted = values[:, column] - lows[column]
        for bit in range(widths[column]):
            slices[at, :n] = (shifted >> bit) & 1
            at += 1
    packed = np.packbits(slices, axis=1, bitorder="little")
    return rest | {"lows": lows.astype("<i8").tobytes(), "widths": widths.astype("<i4").tobytes(), "slices": packed.tobytes(), "wide": None}


def _add(levels: list[np.ndarray]) -> list[np.ndarray]:
    """Bitmaps by weight 2**level, (n, words) each, added up to one bitmap for each level."""
    result, level = [], 0
    while level < len(levels):
        here = levels[level]
        while len(here) > 1:
            third = len(here) // 3
            if third:
                a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
                half = a ^ b
                total, carry = half ^ c, (a & b) | (half & c)
                here = np.concatenate((total, here[3 * third :]))
            else:
                total, carry = here[:1] ^ here[1:], here[:1] & here[1:]
                here = total
            if level + 1 == len(levels):
                levels.append(carry)
            else:
                levels[level + 1] = np.concatenate((levels[level + 1], carry))
        result.append(here[0] if len(here) else None)
        level += 1
    return result


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _places(bitmap: np.ndarray, most: int | None = None) -> np.ndarray:
    found = np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
    return found if most is None else found[:most]


class Block:
    """The slices of one block, ready for queries."""

    def __init__(self, row: dict):
        self.n = row["rows"]
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.wide = None if row["wide"] is None else np.frombuffer(row["wide"], "<i8").reshape(self.n, -1)
        words = -(-self.n // 64)
        self.all = np.zeros(words * 64, np.uint8)
        self.all[: self.n] = 1
        self.all = np.packbits(self.all, bitorder="little").view("<u8")
        if self.wide is None:
            self.lows = np.frombuffer(row["lows"], "<i8")
            self.widths = np.frombuffer(row["widths"], "<i4").astype(np.int64)
            slices = np.frombuffer(row["slices"], "<u8").reshape(-1, words)
            # A complement follows each slice.
            self.slices = np.concatenate((slices, slices ^ self.all))
            self.first = np.cumsum(self.widths) - self.widths
            self.highs = self.lows + (1 << self.widths) - 1
            self.attribute = np.repeat(np.arange(len(self.widths)), self.widths)
            self.bit = np.arange(len(self.attribute)) - self.first[self.attribute]

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, list[int]]:
        """(places, scores) of the k best rows other than the id ``own``, best first, ties to the smaller id."""
        allowed = self.all
        if own is not None:
            a, b = np.searchsorted(self.ids, own), np.searchsorted(self.ids, own, "right")
            if b > a:
                mask = np.unpackbits(self.all.view(np.uint8), bitorder="little")
                mask[a:b] = 0
                allowed = np.packbits(mask, bitorder="little").view("<u8")
        large = query.dtype == object or (len(query) and int(np.abs(query).max()) >= LARGE)
        if self.wide is not None or large:
            return self._top_wide(query, k, allowed)
        magnitude = np.abs(query)
        # What sums and constants can reach; beyond 62 bits they are made of Python's integers.
        reach = magnitude.astype(np.float64) * np.maximum(np.abs(self.lows.astype(np.float64)), np.abs(self.highs.astype(np.float64)))
        if reach.sum() >= EXACT:
            return self._top_wide(query, k, allowed)
        constant = int((query * np.where(query < 0, self.highs, self.lows)).sum()) if len(query) else 0
        offset = np.where(query < 0, len(self.attribute), 0)
        levels: list[np.ndarray] = []
        weights = magnitude[self.attribute]
        rows = np.arange(len(self.attribute)) + offset[self.attribute]
        for level in range(int(magnitude.max()).bit_length() + int(self.widths.max()) if len(query) else 0):
            place = level - self.bit
            taken = (place >= 0) & ((weights >> np.clip(place, 0, 62)) & 1 == 1)
            levels.append(self.slices[rows[taken]])
        sums = _add(levels)
        sure, tied, need = np.zeros_like(self.all), allowed, min(k, _ones(allowed))
        for bitmap in reversed(sums):
            if bitmap is None:
                continue
            with_bit = tied & bitmap
            count = _ones(with_bit)
            if count > need:
                tied = with_bit
            else:
                # Their bit is set, the others' is not: they are among the best.
                sure, tied, need = sure | with_bit, tied & ~bitmap, need - count
                if not need:
                    break
        places = np.concatenate((_places(sure), _places(tied, need))) if need else _places(sure)
        scores = np.zeros(len(places), np.int64)
        for level, bitmap in enumerate(sums):
            if bitmap is not None:
                scores += ((bitmap[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << level
        order = np.lexsort((self.ids[places], -scores))
        return places[order], [int(s) + constant for s in scores[order]]

    def _top_wide(self, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, list[int]]:
        places = _places(allowed)
        if self.wide is not None:
            values = self.wide[places].astype(object)
        else:
            bits = np.unpackbits(self.slices[: len(self.attribute)].view(np.uint8), axis=1, bitorder="little")[:, places]
            values = np.tile(self.lows, (len(places), 1)).astype(object)
            for i, (a, b) in enumerate(zip(self.attribute, self.bit, strict=True)):
                values[:, a] += bits[i].astype(object) << int(b)
        scores = [max(-LONGEST - 1, min(LONGEST, int(s))) for s in values @ query.astype(object)]
        order = sorted(range(len(places)), key=lambda i: (-scores[i], self.ids[places[i]]))[:k]
        return places[order], [scores[i] for i in order]


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, values) of the vectors without null or non-finite components; values are floor(scale * x) as longs."""
    values = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(x * scale).cast("long"))
    finite = F.forall(F.col(vector).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias(vector)).where(F.col("id").isNotNull() & F.col(vector).isNotNull())
    return rows.where(finite).select("id", values.alias("values"))


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` with length, their block's number and the number of blocks, about ``size`` rows of a length in each.

    ``rows`` are a written table, so a row's place in it is stable; blocks are even whatever the ids are.
    """
    sized = rows.withColumn("length", F.size("values")).withColumn("place", F.monotonically_increasing_id())
    counts = sized.groupBy("length").agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))
    return sized.join(counts, "length").withColumn("block", F.pmod(F.xxhash64("place"), F.col("blocks"))).drop("place")


def _index(key: tuple, group: pa.Table) -> pa.Table:
    values = group.column("values").combine_chunks()
    matrix = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(group), -1)
    row = _sliced(matrix, group.column("id").to_numpy().astype(np.int64))
    length, block = (k.as_py() for k in key)
    return pa.table({"length": pa.array([length], pa.int32()), "block": pa.array([block], pa.int64()), **_columns([row])})


def _columns(rows: list[dict]) -> dict[str, pa.Array]:
    return {
        "rows": pa.array([r["rows"] for r in rows], pa.int64()),
        **{c: pa.array([r[c] for r in rows], pa.binary()) for c in ("ids", "lows", "widths", "slices", "wide")},
    }


def index(vectors: DataFrame) -> DataFrame:
    """The bit-sliced index of a table (id, values): one row for each block."""
    dealt = _dealt(vectors, BLOCK_ROWS)
    return dealt.groupBy("length", "block").applyInArrow(_index, f"length int, block long, {_INDEX}")


def search(
    vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 64
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest integer inner products.

    Components x count as floor(scale * x).  Vectors that are null or hold a null or non-finite component take no
    part, nor do rows without an id.  Only vectors of the query's length are compared.  Rows that share the query's
    id are no candidates for it; ties go to the smaller id; fewer candidates than k give fewer rows.  A query row
    that is repeated gets its answer as often.  Scores beyond a long are held at its ends.
    """
    rows = written(quantised(vectors, key, vector, scale))
    asked = written(quantised(queries, key, vector, scale))
    blocks = written(index(rows))
    grouped = _dealt(asked, BLOCK_QUERIES).withColumnRenamed("block", "part").groupBy("length", "part")
    parts = written(grouped.agg(F.collect_list(F.struct("id", "values")).alias("asked")))

    # Every block of rows meets every block of queries of its length, by the numbers of both.
    sizes = blocks.groupBy("length").agg(F.count("*").alias("blocks")).join(parts.groupBy("length").agg(F.count("*").alias("parts")), "length")
    numbers = parts.select("length", "part").join(blocks.select("length", "block"), "length")
    pairs = sizes.agg(F.sum(F.col("blocks") * F.col("parts"))).first()[0] or 1
    meet = ["length", "block", "part"]
    # A task takes one pair of blocks, or several where there are very many.
    tasks = min(pairs, MOST_TASKS)
    left = blocks.join(numbers, ["length", "block"]).repartition(tasks, *meet)
    right = parts.join(numbers, ["length", "part"]).repartition(tasks, *meet)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, out = Block(row), []
                for n, query in enumerate(row["asked"]):
                    places, scores = block.top(np.array(query["values"], np.int64), k, query["id"])
                    out += [(row["part"], n, query["id"], int(block.ids[p]), max(-LONGEST - 1, min(LONGEST, s))) for p, s in zip(places, scores, strict=True)]
                columns = list(zip(*out, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "n", "query_id", "vec_id", "score"])

    found = left.join(right, meet).drop("length", "block").mapInArrow(best, "part long, n long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id", "part", "n").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
