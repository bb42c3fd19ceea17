"""Streaming queries, run until everything that has arrived is counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.catalog.registry import Tables, query
from logweir.streaming import counts
from logweir.streaming.rollup import Rollup


def _arriving(t: Tables) -> DataFrame:
    schema = t.raw("events").schema
    files = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return files.parquet(t.sf_dir).withColumnRenamed("ts", "itime")


@query(
    "m1_stream_counts",
    "SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS hits FROM events GROUP BY 1, 2",
)
def _(t):
    folder = t.folder()
    counted = counts.hourly_counts(_arriving(t), ["event_type"])
    counts.upsert_files(counted, f"{folder}/state", f"{folder}/out").awaitTermination()
    return counts.latest_counts(t.spark, f"{folder}/out", ["event_type"])


@query(
    "m2_closed_windows",
    "SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS hits FROM events GROUP BY 1, 2 "
    "HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)",
)
def _(t):
    folder = t.folder()
    counted = counts.hourly_counts(_arriving(t), ["event_type"], late="2 days")
    counts.write_once(counted, f"{folder}/state", "append", path=f"{folder}/out").awaitTermination()
    return t.spark.read.parquet(f"{folder}/out")


def _in_two_files(t: Tables) -> Rollup:
    """Events as two files that arrive one after the other: every third with the newest first, then the rest."""
    folder = t.folder()
    rollup = Rollup(t.spark, f"{folder}/rollup", ["event_type"])
    events = t.raw("events").withColumnRenamed("ts", "itime")
    for name, rows in (("first", F.col("event_id") % 3 == 0), ("second", F.col("event_id") % 3 != 0)):
        events.where(rows).write.mode("append").option("compression", "snappy").parquet(f"{folder}/in/part={name}")
        arrived = t.spark.readStream.schema(events.schema).parquet(f"{folder}/in/part=*")
        rollup.follow(arrived, f"{folder}/state").awaitTermination()
    return rollup


@query(
    "m2_late_rows",
    "WITH f AS (SELECT max(ts) - INTERVAL 2 DAY AS closed FROM events WHERE event_id % 3 = 0) "
    "SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS hits FROM events, f WHERE event_id % 3 <> 0 AND "
    "date_trunc('hour', ts) + INTERVAL 1 HOUR <= closed GROUP BY ALL",
)
def _(t):
    return _in_two_files(t).late_rows()


@query(
    "m1_rollup",
    "SELECT date_trunc('hour', ts) AS bucket, event_type, count(*) AS hits FROM events GROUP BY 1, 2",
)
def _(t):
    rollup = _in_two_files(t)
    rollup.compact()
    return rollup.counts()
