"""Timelines and root-cause chains: one stream of timed events per case.

A case may hold any number of events, so no step ranks a whole case in one task:
order is a distributed sort, first and count are merged aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.coercion import event_order, first_truthy

ORDER = ("time_rank", "time_epoch", "time_text")


def _present(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names if n in df.columns]


def events(
    df: DataFrame,
    case: str,
    source: str,
    reference: Sequence[str],
    times: Sequence[str],
    text: Sequence[str],
    fallback: str,
) -> DataFrame:
    """Rows as events: case, time, source, reference and description.

    The time is the first of ``times`` that says anything; without one a row cannot
    be placed and is left out.
    """
    ref = F.coalesce(_first(df, reference), F.lit("?"))
    described = F.concat(F.lit(f"{source} "), ref, F.lit(": "), F.coalesce(_first(df, text), F.lit(fallback)))
    moment, keys = _when(df, times)
    return df.select(
        F.col(case).cast("string").alias("case_id"),
        moment.alias("timestamp"),
        F.lit(source).alias("source"),
        ref.alias("reference"),
        described.alias("description"),
        *keys,
    ).where(F.col("timestamp").isNotNull())


def _first(df: DataFrame, names: Sequence[str]) -> Column:
    present = _present(df, names)
    return first_truthy(*present) if present else F.lit(None).cast("string")


def _when(df: DataFrame, names: Sequence[str]) -> tuple[Column, list[Column]]:
    """The event's time as text, and its sort keys.

    Stored timestamps give their epoch as they are; only other spellings are parsed.
    """
    present = _present(df, names)
    kinds = {type(df.schema[n].dataType) for n in names if n in df.columns}
    if not kinds or kinds - {T.TimestampType, T.TimestampNTZType}:
        moment = _first(df, names)
        return moment, event_order(moment)
    moment = F.coalesce(*present)
    epoch = F.unix_timestamp(moment.cast("timestamp")).cast("double")
    keys = (F.lit(0), F.coalesce(epoch, F.lit(0.0)), F.lit(""))
    return moment.cast("string"), [k.alias(n) for k, n in zip(keys, ORDER, strict=True)]


def incident_events(df: DataFrame, case: str = "incid", chain: bool = False) -> DataFrame:
    times = ["timestamp", "createtime", "alerttime" if chain else "lastupdate"]
    return events(df, case, "incident", ["incid"], times, ["name", "description"], "created")


def alert_events(df: DataFrame, case: str = "alertid") -> DataFrame:
    return events(
        df, case, "alert", ["alertid"], ["timestamp", "alerttime", "createtime"], ["name", "description"], "raised"
    )


def log_events(df: DataFrame, case: str) -> DataFrame:
    return events(
        df, case, "log", ["logid", "id"], ["itime", "timestamp", "eventtime"], ["logdesc", "msg", "subtype"], "event"
    )


def unite(*streams: DataFrame) -> DataFrame:
    """Event streams as one."""
    merged = streams[0]
    for stream in streams[1:]:
        merged = merged.unionByName(stream, allowMissingColumns=True)
    return merged


def ordered(stream: DataFrame) -> DataFrame:
    """Oldest first within each case; a large case spreads over many tasks."""
    return stream.orderBy("case_id", *ORDER, "source", "reference")


def earliest(stream: DataFrame) -> DataFrame:
    """Per case: its first event and how many events it has.

    The least time and the count are merged by hashing; only the events at
    that time, a few of each case, are compared by their text.
    """
    least = stream.groupBy("case_id").agg(F.min("time_epoch").alias("_least"), F.count(F.lit(1)).alias("event_count"))
    # A case without any known time has no least one: all its events are at it.
    least = least.withColumnRenamed("case_id", "_case")
    same = stream["case_id"].eqNullSafe(least["_case"]) & stream["time_epoch"].eqNullSafe(least["_least"])
    at_least = stream.join(least, same)
    first = F.min(F.struct(*ORDER, "source", "reference", "timestamp", "description")).alias("_first")
    return at_least.groupBy("case_id", "event_count").agg(first).select(
        "case_id",
        F.col("_first.timestamp").alias("timestamp"),
        F.col("_first.source").alias("source"),
        F.col("_first.reference").alias("reference"),
        F.col("_first.description").alias("description"),
        "event_count",
    )
