"""Benchmark decontamination by winnowing, in DataFrame functions only.

Words are hashed, ``GRAM`` consecutive word hashes make a gram hash, and of every ``WINDOW - GRAM + 1`` consecutive
grams the smallest is kept.  Any span of WINDOW words holds one such run of grams, so two texts that share a span
share a kept hash.  Kept hashes of documents meet those of the benchmark; only documents with a common one are read
again.  There each hit is extended to the spans of WINDOW words around it, which meet the benchmark's spans word for
word.  An item shorter than WINDOW is one span; documents keep every gram of the few such lengths that occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import ascii_lower, written

WINDOW = 13
GRAM = 5
#: A document is contaminated if at least one word in SHARE is hit.
SHARE = 20


def words_of(text: Column) -> Column:
    """The words of a text in lower case; an empty array for null."""
    split = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(split, lambda w: w != "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _grams(hashes: Column, length: int) -> Column:
    """The hash of each run of ``length`` words, by its start; empty if there are fewer words."""
    last = F.size(hashes) - length
    each = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(length)]))
    return F.when(last >= 0, each).otherwise(F.array().cast("array<bigint>"))


def _minima(grams: Column, run: int) -> Column:
    """The distinct smallest hashes of all runs of ``run`` grams."""
    last = F.size(grams) - run
    least = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.array_min(F.slice(grams, i, run)))
    return F.when(last >= 0, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def _kept(frame: DataFrame, short: list[int]) -> DataFrame:
    """``frame`` (with words) and kept: the kept hashes of the long spans and of each short length."""
    # Each array is a column of its own: inside the next one's lambda it would be made anew for every element.
    frame = frame.withColumn("hashes", _hashes(F.col("words"))).withColumn("grams", _grams(F.col("hashes"), GRAM))
    kept = [_minima(F.col("grams"), WINDOW - GRAM + 1)]
    kept += [F.array_distinct(_grams(F.col("hashes"), length)) for length in short]
    return frame.withColumn("kept", F.array_distinct(F.flatten(F.array(*kept))) if short else kept[0])


def _each(frame: DataFrame, array: Column | str, name: str) -> DataFrame:
    """A row for each element.

    Of a plain explode Spark infers a filter on the array's size and moves it below the projections that make it, which
    writes the whole expression into its own lambdas; an outer one leaves them as they are.
    """
    return frame.withColumn(name, F.explode_outer(array)).where(F.col(name).isNotNull())


def _spans(benchmark: DataFrame, key: str, text: str) -> DataFrame:
    """(item, length, span) of every distinct span of every item; span is its words, space-joined."""
    words = benchmark.select(F.col(key).cast("string").alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(WINDOW))
    starts = _each(words.withColumn("length", length), F.sequence(F.lit(1), F.size("words") - F.col("length") + 1), "at")
    return starts.select("item", "length", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("span")).distinct()


def _candidates(hit: DataFrame, short: list[int]) -> DataFrame:
    """(row, at, length, span) of the spans around the hits; at counts words from 0."""

    def around(length: int) -> Column:
        gram = GRAM if length == WINDOW else length
        grams = _grams(F.col("hashes"), gram)
        places = F.filter(
            F.transform(grams, lambda g, i: F.when(F.array_contains(F.col("common"), g), i)), lambda i: i.isNotNull()
        )
        last = F.size("words") - length
        if length == WINDOW:
            places = F.flatten(F.transform(places, lambda i: F.sequence(F.greatest(i - (WINDOW - GRAM), F.lit(0)), i)))
        kept = F.filter(F.array_distinct(places), lambda i: i <= last)
        return F.transform(kept, lambda i: F.struct(i.alias("at"), F.lit(length).alias("length")))

    every = F.concat(*[around(length) for length in [*short, WINDOW]])
    return (
        _each(hit.withColumn("hashes", _hashes(F.col("words"))), every, "place")
        .select("row", "place.at", "place.length", F.array_join(F.slice("words", F.col("place.at") + 1, F.col("place.length")), " ").alias("span"))
    )


def matches(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every row of ``documents``: id, row (hash of id and text), n_words, n_hit, items (sorted strings), spans.

    A word is hit if it lies in an occurrence of a benchmark span: WINDOW consecutive words of an item, or all words
    of a shorter one.  ``spans`` are the merged hit stretches as (start, end) word positions, end exclusive.
    Null texts have no words.  Rows that repeat an id and a text get equal results; rows that share an id with
    different texts are told apart.  Items without words match nothing; an item with a null id marks words but is
    not listed.  Empty tables give empty or unhit results.  Other columns are not read.
    """
    spans = written(_spans(benchmark, item_key, item_text))
    short = sorted(r["length"] for r in spans.where(F.col("length") < WINDOW).select("length").distinct().collect())

    docs = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    row = F.xxhash64(F.col("id").cast("string"), "text")
    base = written(
        _kept(docs.select("id", row.alias("row"), words_of(F.col("text")).alias("words")), short).select(
            "id", "row", F.size("words").alias("n_words"), "kept"
        ),
        "none",
    )
    items = benchmark.select(words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    wanted = written(_each(_kept(items, short), "kept", "hash").select("hash").distinct(), "none")
    common = written(_each(base, "kept", "hash").select("row", "hash").distinct().join(wanted, "hash").groupBy("row").agg(F.collect_set("hash").alias("common")))

    again = docs.withColumn("row", row).join(common, "row")
    found = written(
        _candidates(again.select("row", "common", words_of(F.col("text")).alias("words")), short).join(
            spans.select("length", "span").distinct(), ["length", "span"]
        ).distinct()
    )
    before = Window.partitionBy("row").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.col("at") > F.coalesce(F.max("end").over(before), F.lit(-1))
    hit = (
        found.select("row", "at", "length", (F.col("at") + F.col("length")).alias("end"))
        .withColumn("fresh", fresh.cast("int"))
        .withColumn("stretch", F.sum("fresh").over(upto))
        .groupBy("row", "stretch")
        .agg(F.min("at").alias("start"), F.max("end").alias("end"))
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    listed = (
        found.select("row", "length", "span")
        .distinct()
        .join(spans, ["length", "span"])
        .select("row", "item")
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    n_hit = F.aggregate("spans", F.lit(0), lambda acc, s: acc + s["end"] - s["start"])
    both = hit.join(listed, "row", "left")
    return base.select("id", "row", "n_words").join(both, "row", "left").select(
        "id",
        "row",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )


def contaminated() -> Column:
    """The rule on the columns of ``matches``: some word is hit, and at least one in SHARE."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))


def clean(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, that are not contaminated."""
    bad = written(matches(documents, benchmark, key, text).where(contaminated()).select(F.col("row").alias("_bad")).distinct())
    row = F.xxhash64(documents[key].cast("string"), documents[text])
    return documents.join(bad, row == bad["_bad"], "left_anti")
