"""Not-modified revisits of a web archive, resolved to the latest earlier full response.

Records have a url, a time, a status, validators (etag, last_modified) and headers.  A revisit (status 304) is joined
as of its time to the latest earlier full response (status 200) of the same canonical url.  If a validator that both
have differs, the revisit is not resolved; otherwise its permitted headers replace those of the response.

A url may hold most of the records, so no url is gathered in one place: records in order of url and time are cut
into pieces of about as many rows each, however unevenly their times lie; each piece is searched by itself, and where
a piece has no earlier response the latest one of the url's pieces before it counts.  Only validators and places travel with the search; bodies and headers are joined after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import ascii_lower, written

FULL, NOT_MODIFIED = 200, 304
#: Records of a piece, but for one time that more records of a url have.
PIECE_ROWS = 1_000_000

# Headers that a not-modified response must not change, since they describe the stored body.
KEPT_HEADERS = ("content-encoding", "content-length", "content-range", "content-type", "transfer-encoding")
# Query parameters that do not change what a url names.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref)="


def canonical(url: Column) -> Column:
    """The url in one spelling: host in lower case without www., no scheme, fragment, tracking or final slash.

    Query parameters are sorted.  Null stays null.
    """
    plain = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(plain, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(ascii_lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"^www\d*\.", "")
    host = F.regexp_replace(host, r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    asked = F.filter(F.split(F.regexp_extract(bare, r"\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(asked), "&")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def _agree(a: str, b: str) -> Column:
    """Both known and equal, or one of them unknown."""
    return F.coalesce(F.col(a) == F.col(b), F.lit(True))


def _pieces(records: DataFrame) -> DataFrame:
    """``records`` in order of url and time, with the piece of each; rows of one url and time share a piece.

    Pieces are partitions of a range exchange, which Spark cuts by sampled quantiles: write the rows before using them.
    """
    return records.repartitionByRange(max(1, -(-records.count() // PIECE_ROWS)), "canonical", "time").withColumn("piece", F.spark_partition_id())


def _one(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """The first row of each key."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def as_of(records: DataFrame) -> DataFrame:
    """The revisits of ``records`` (id, url, time, status, etag, last_modified) with their response's columns.

    Adds canonical, source_id, source_time, source_etag, source_modified and outcome: `resolved`, `unmatched` (no
    earlier response), `mismatch` (a validator differs) or `unusable` (no url or time).  Of responses at one time the
    one with the largest id counts; a response at the revisit's own time is not earlier.
    """
    slim = records.select("id", canonical(F.col("url")).alias("canonical"), F.col("time").cast("long").alias("time"), "status", "etag", "last_modified")
    usable = _pieces(slim.where(F.col("canonical").isNotNull() & F.col("time").isNotNull() & F.col("status").isin(FULL, NOT_MODIFIED)))
    response = F.when(F.col("status") == FULL, F.struct("time", "id", "etag", "last_modified"))
    usable = written(usable.withColumn("response", response))

    # The latest response of each piece, then of all pieces before: a row for each piece of a url.
    latest = usable.where("response is not null").groupBy("canonical", "piece").agg(F.max("response").alias("response"))
    asked = usable.where(F.col("status") == NOT_MODIFIED).select("canonical", "piece").distinct()
    steps = asked.join(latest, ["canonical", "piece"], "full")
    before = Window.partitionBy("canonical").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = steps.withColumn("carried", F.last("response", ignorenulls=True).over(before)).select("canonical", "piece", "carried")

    # Within a piece: responses strictly earlier in time.
    within = Window.partitionBy("canonical", "piece").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    best = F.max(F.col("response")).over(within)
    inside = usable.withColumn("inside", best).where(F.col("status") == NOT_MODIFIED)
    found = inside.join(carried, ["canonical", "piece"], "left").withColumn("found", F.coalesce("inside", "carried"))
    found = found.select(
        "id", "canonical", "time", "etag", "last_modified",
        F.col("found.id").alias("source_id"), F.col("found.time").alias("source_time"),
        F.col("found.etag").alias("source_etag"), F.col("found.last_modified").alias("source_modified"),
    )
    outcome = (
        F.when(F.col("source_id").isNull(), "unmatched")
        .when(_agree("etag", "source_etag") & _agree("last_modified", "source_modified"), "resolved")
        .otherwise("mismatch")
    )
    found = found.withColumn("outcome", outcome)
    lost = slim.where((F.col("status") == NOT_MODIFIED) & (F.col("canonical").isNull() | F.col("time").isNull()))
    return found.unionByName(lost.select("id", "canonical", "time", "etag", "last_modified").withColumn("outcome", F.lit("unusable")), allowMissingColumns=True)


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The response's headers with those of the revisit put in place, but for the ones that describe the body.

    Names are compared in lower case; null counts as no headers.
    """
    empty = F.create_map().cast("map<string,string>")
    lower = [F.transform_keys(F.coalesce(m, empty), lambda k, _: F.lower(k)) for m in (stored, fresh)]
    allowed = F.map_filter(lower[1], lambda k, _: ~k.isin(*KEPT_HEADERS))
    rest = F.map_filter(lower[0], lambda k, _: ~F.map_contains_key(allowed, k))
    return F.map_concat(rest, allowed)


def resolve(records: DataFrame) -> DataFrame:
    """``as_of`` with the headers and the body of a resolved revisit.

    ``records`` has id, url, time, status, etag, last_modified, headers (map) and body; other columns are not read.
    Ids name records: of rows that repeat one, the one with the smallest body, then headers, gives both; null is smallest.
    """
    found = written(as_of(records))
    full = records.where(F.col("status") == FULL).select(F.col("id").alias("source_id"), F.col("headers").alias("stored"), "body")
    fresh = records.where(F.col("status") == NOT_MODIFIED).select("id", F.col("headers").alias("fresh"))
    entries = {name: F.array_sort(F.map_entries(name)) for name in ("fresh", "stored")}
    wanted = found.where("outcome = 'resolved'").select("id", "source_id").distinct().join(_one(fresh, "id", entries["fresh"]), "id")
    bodies = wanted.join(_one(full, "source_id", F.col("body"), entries["stored"]), "source_id")
    bodies = bodies.select(F.col("id").alias("_id"), merged_headers(F.col("stored"), F.col("fresh")).alias("headers"), "body")
    return found.join(bodies, (found["id"] == bodies["_id"]) & (found["outcome"] == "resolved"), "left").drop("_id")
