"""SimHash near-duplicates: fingerprints, and their links by pigeonring filtering.

Two fingerprints of 64 bits are linked if at most ``LIMIT`` bits differ.  The bits lie in ``BOXES`` segments on a
ring.  If the differences of all segments add up to at most LIMIT, then some segment starts a chain whose first l
segments differ in at most floor(l * LIMIT / BOXES) bits, for every l.  With 4 bits and 5 segments the budgets are
0, 1, 2, 3 and 4: the first segment is equal, the next has at most one bit changed, and so on.  The first two
budgets make the join key (both segments, one bit of the second left out: 64 keys a fingerprint, about 25 bits
each); the longer chains are checked before the full distance.

A bucket of a key is never expanded into all pairs.  Its members are first tied to one hub; then only members
outside the bucket's main component (the minor ones) have to meet the others, which finds every link between
components and so loses none.  Where the minor members of a bucket are more than the keys that the next segment of the
chain gives (``FANS``), the bucket is split by that segment instead: the cumulative budget of the longer chain says
how many of its bits may differ, and every choice of so many bits is left out once.  So a member costs at most as many
rows as the next segment has keys, however large its group is; once all segments are in the key, only ten bits are
left out of it and a bucket has at most 2^10 different members.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from logweir.llm.common import in_small_batches, worker_state, written
from logweir.llm.graph import components

LIMIT = 4
WIDTHS = (13, 13, 13, 13, 12)
BOXES = len(WIDTHS)
SHINGLE = 4
SEED = 42
#: Shingle hashes whose bits are counted at a time, which bounds the memory of a long text.
BLOCK = 1 << 15
#: Fingerprints that one task makes keys of.
TASK_ROWS = 8_192
#: Tasks at most; beyond, a task makes more keys.
MOST_TASKS = 50_000

_STARTS = tuple(int(x) for x in np.cumsum((0, *WIDTHS[:-1])))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _box(i: int) -> int:
    return ((1 << WIDTHS[i % BOXES]) - 1) << _STARTS[i % BOXES]


def _keys() -> list[tuple[int, int]]:
    """(mask, mark) of each key: a segment and the next one without one of its bits; the mark tells keys apart.

    The mark stands in bits that the mask leaves free.  Should two keys still agree, their buckets merge, which adds
    candidates and loses none.
    """
    found = []
    for i in range(BOXES):
        following = (i + 1) % BOXES
        for bit in range(_STARTS[following], _STARTS[following] + WIDTHS[following]):
            found.append((_box(i) | (_box(i + 1) & ~(1 << bit)), len(found) << _STARTS[(i + 2) % BOXES]))
    return found


KEYS = _keys()
#: The segment in which the chain of each key starts.
_FIRST = [i for i in range(BOXES) for _ in range(WIDTHS[(i + 1) % BOXES])]


def _budget(length: int) -> int:
    """Differing bits in a chain of ``length`` segments, at most."""
    return length * LIMIT // BOXES


def submasks(box: int, length: int) -> list[int]:
    """Masks over the last segment of the chain of ``length`` segments from ``box``, its budget's bits left out."""
    at = (box + length - 1) % BOXES
    bits = [1 << b for b in range(_STARTS[at], _STARTS[at] + WIDTHS[at])]
    return [_box(at) & ~sum(out) for out in combinations(bits, _budget(length))]


#: Keys that one more segment gives a member, by the length of the chain in the key; a full chain is not split.
FANS = {length: comb(max(WIDTHS), _budget(length + 1)) for length in range(2, BOXES)}


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a text's UTF-8 bytes as an unsigned integer; 0 for a text without words or null."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words) + b" "
    ends = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = np.concatenate(([0], ends[: -SHINGLE] + 1)).tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), BLOCK):
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at : at + BLOCK], ends[at : at + BLOCK], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(ends), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def fingerprint_of(texts: pa.Array) -> pa.Array:
    """The fingerprint of each text as a signed long."""
    worker_state("simhash")
    found = np.array([fingerprint(x.as_py()) for x in texts.cast(pa.binary())], np.uint64)
    return pa.array(found.view(np.int64))


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp) of every row; other columns are not read."""
    return in_small_batches(documents).select(F.col(key).alias("id"), fingerprint_of(F.col(text)).alias("fp"))


def _keyed(fps: DataFrame) -> DataFrame:
    """A row for each fingerprint and key, with the segment the key starts at."""
    keys = [F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseOR(F.lit(_signed(mark))) for mask, mark in KEYS]
    made = F.array(*[F.struct(k.alias("key"), F.lit(box).cast("byte").alias("box")) for k, box in zip(keys, _FIRST, strict=True)])
    return fps.select("fp", F.explode(made).alias("k")).select("fp", "k.key", "k.box")


def _distance(a: Column | str, b: Column | str, mask: int = (1 << 64) - 1) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b).bitwiseAND(F.lit(_signed(mask))))


def _near(a: str, b: str) -> Column:
    """Some chain keeps its budgets at every length, and so does the whole ring.

    The budget of the whole ring is the Hamming limit; it is checked last.
    """
    some = F.lit(False)
    for i in range(BOXES):
        kept, mask = F.lit(True), 0
        for length in range(1, BOXES):
            mask |= _box(i + length - 1)
            kept = kept & (_distance(a, b, mask) <= length * LIMIT // BOXES)
        some = some | kept
    return some & (_distance(a, b) <= LIMIT)


def _tied(members: DataFrame) -> DataFrame:
    """The links between each bucket's members and its hub, the member with most copies."""
    hub = members.groupBy("key").agg(F.max_by("fp", "copies").alias("hub"))
    near = (_distance("fp", "hub") <= LIMIT) & (F.col("fp") != F.col("hub"))
    return members.join(hub, "key").where(near).select(F.col("fp").alias("a"), F.col("hub").alias("b"))


def _opened(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with several components: their own, the bucket's main one, and how many are outside it."""
    placed = written(members.join(found, members["fp"] == found["node"], "left").select(*members.columns, F.coalesce("root", "fp").alias("comp")))
    main = (
        placed.groupBy("key", "comp")
        .agg(F.count("*").alias("of"))
        .groupBy("key")
        .agg(F.max_by("comp", "of").alias("main"), (F.sum("of") - F.max("of")).alias("minors"))
        .where("minors > 0")
    )
    return written(placed.join(main, "key"))


def _met(opened: DataFrame) -> DataFrame:
    """The links between the minor members of each bucket and all its members of other components."""
    other = opened.select("key", F.col("fp").alias("b"), F.col("comp").alias("other"))
    minor = opened.where("comp <> main").select("key", F.col("fp").alias("a"), "comp")
    return minor.join(other, "key").where((F.col("comp") != F.col("other")) & _near("a", "b")).select("a", "b").distinct()


def _split(members: DataFrame, length: int) -> DataFrame:
    """Members by the keys of a chain of ``length`` segments, for those that share such a key."""
    masks = [(box, _signed(mask)) for box in range(BOXES) for mask in submasks(box, length)]
    table = members.sparkSession.createDataFrame(masks, "box byte, mask long")
    # At most a few thousand masks, whatever the input.
    parts = members.join(F.broadcast(table), "box")
    finer = parts.select(F.xxhash64("key", "mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "box", "fp", "copies")
    finer = written(finer)
    shared = finer.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return written(finer.join(shared, "key", "left_semi"))


def _joined(found: DataFrame, new: DataFrame) -> DataFrame:
    return written(components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(new)))


def links(fps: DataFrame) -> DataFrame:
    """(node, root): the components of distinct fingerprints (columns fp, copies), for those with a link.

    ``copies`` only steers which member becomes a hub; the result does not depend on it.
    """
    # A task makes a bounded number of keys, most of them alone, which a partial aggregation would only hold.
    keyed = _keyed(fps.repartition(min(fps.count() // TASK_ROWS + 1, MOST_TASKS)))
    buckets = written(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
    edges = buckets.where((F.col("n") == 2) & _near("a", "b")).select("a", "b")
    # Both sides grow with the input, so the join is a merge join at every size.
    large = keyed.join(buckets.where("n > 2").select("key").hint("merge"), "key", "left_semi")
    members = written(large.join(fps.select("fp", "copies"), "fp").select("key", "box", "fp", "copies"))
    found = written(components(edges.unionByName(_tied(members))))
    for length in range(2, BOXES + 1):
        opened = _opened(members, found)
        few = opened.where(F.col("minors") <= FANS[length]) if length in FANS else opened
        found = _joined(found, _met(few))
        many = opened.where(F.col("minors") > FANS.get(length, 1 << 62)).select("key", "box", "fp", "copies")
        if many.isEmpty():
            break
        members = _split(many, length + 1)
        found = _joined(found, _tied(members))
    return found


def groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, root, component_id) of every row of ``documents``.

    ``root`` is the smallest fingerprint of the component, ``component_id`` the smallest id.  Equal texts and all
    texts without words (null too) share a fingerprint and so a component.  Repeated rows are kept.  Null ids take
    part; component_id is null only if all ids of the component are.  An empty table gives an empty result.
    """
    marked = written(fingerprints(documents, key, text))
    distinct = written(marked.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("copies")))
    found = links(distinct)
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(least, "root").select("fp", "root", "component_id"))
    return marked.join(named, "fp").select("id", "fp", "root", "component_id")


def deduplicate(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays, with all its columns: the one with the smallest id.

    Among rows that share this id (or have none) any one stays.
    """
    grouped = written(groups(documents, key, text).where(F.col("id").eqNullSafe(F.col("component_id"))))
    heads = written(grouped.groupBy("root").agg(F.min("id").alias("_head"), F.count("*").alias("_rows")))
    # A head's id tells its row only if no other row has it, in whatever component.
    repeated = written(documents.groupBy(F.col(key).alias("_head")).count().where("count > 1 and _head is not null").select("_head"))
    named = heads.where("_rows = 1 and _head is not null")
    alone = named.join(repeated, "_head", "left_anti").select("_head")
    single = documents.join(alone, documents[key] == alone["_head"], "left_semi")
    shared = heads.where("_rows > 1 or _head is null").unionByName(named.join(repeated, "_head", "left_semi")).select("root", "_head")
    if shared.isEmpty():
        return single
    # Rows that repeat an id: they are told apart by id and fingerprint.
    names = {name: f"c{i}" for i, name in enumerate(documents.columns)}
    plain = documents.toDF(*names.values())
    marked = plain.join(shared, plain[names[key]].eqNullSafe(shared["_head"]), "left_semi").withColumn(
        "fp", fingerprint_of(F.col(names[text]))
    )
    places = grouped.join(shared, "root", "left_semi").select("fp", "root", F.col("id").alias("_head")).distinct()
    here = (marked["fp"] == places["fp"]) & marked[names[key]].eqNullSafe(places["_head"])
    chosen = marked.join(places, here).dropDuplicates(["root"])
    return single.unionByName(chosen.select(*[F.col(b).alias(a) for a, b in names.items()]))
