"""Counts over alerts, incidents, endpoints, users, rules and IPS rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.coercion import as_int
from logweir.plans import fixed_values as fv
from logweir.plans.conditions import has_value
from logweir.plans.errors import PlanError
from logweir.plans.timewindow import TimeWindow

# Grouped alert counts by name; the key columns each one counts by.
ALERT_COUNTS = {
    "severity": ("severity",),
    "trigger": ("triggername",),
    "severity-timescale": ("severity", "bucket"),
    "eventtype": ("eventtype",),
    "mgmt-state": ("mgmt_state",),
    "severity-devtype": ("severity", "devtype"),
}
TIMESCALES = ("hour", "month")


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, True))


def rows() -> Column:
    return F.count(F.lit(1))


def time_bucket(df: DataFrame, column: str, timescale: str) -> Column:
    """The hour or month a row falls into, as naive time."""
    if timescale not in TIMESCALES:
        raise PlanError(f"unknown timescale '{timescale}'; known: {', '.join(TIMESCALES)}")
    return F.date_trunc(timescale, F.col(column)).cast(T.TimestampNTZType())


def alert_count(alerts: DataFrame) -> DataFrame:
    """One row: all alerts, and those nobody acknowledged."""
    open_ = ~F.coalesce(F.col("acknowledged"), F.lit(False))
    return alerts.agg(rows().alias("total"), count_where(open_).alias("unacknowledged"))


def alert_counts(alerts: DataFrame, kind: str, timescale: str = "hour", time_column: str = "alerttime") -> DataFrame:
    """Alerts counted by one of the named key sets."""
    keys = ALERT_COUNTS.get(kind)
    if keys is None:
        raise PlanError(f"unknown count '{kind}'; known: {', '.join(ALERT_COUNTS)}")
    if "bucket" in keys:
        alerts = alerts.withColumn("bucket", time_bucket(alerts, time_column, timescale))
    return alerts.groupBy(*keys).agg(rows().alias("alerts"))


def group_counts(df: DataFrame, kind: str, dimension: str) -> DataFrame:
    """Alerts or incidents by one of the dimensions their statistics serve."""
    known = {"alert": fv.ALERT_GROUPS, "incident": fv.INCIDENT_GROUPS}[kind]
    if dimension not in known:
        raise PlanError(f"{kind}s are grouped by {', '.join(known)}")
    return df.groupBy(dimension).agg(rows().alias("hits"))


def alert_incident_buckets(
    alerts: DataFrame,
    incidents: DataFrame,
    timescale: str = "month",
    alert_time: str = "alerttime",
    incident_time: str = "createtime",
) -> DataFrame:
    """Alerts and incidents per hour or month and severity."""
    parts = [
        df.select(F.lit(name).alias("source"), time_bucket(df, moment, timescale).alias("bucket"), "severity")
        for name, df, moment in (("alert", alerts, alert_time), ("incident", incidents, incident_time))
    ]
    return parts[0].unionByName(parts[1]).groupBy("source", "bucket", "severity").agg(rows().alias("hits"))


def incident_stats(incidents: DataFrame, items: Sequence[str] = ("total", "severity", "status")) -> DataFrame:
    """``(item, value, hits)`` for any of the incident statistics, from one scan."""
    columns = {
        "total": F.lit("all"),
        "severity": F.col("severity"),
        "category": F.col("category"),
        "status": F.col("status"),
        "outbreak": F.lower(F.coalesce(F.col("category"), F.lit(""))).contains("outbreak").cast("string"),
    }
    strange = [i for i in items if i not in columns]
    if strange or not items:
        raise PlanError(f"incident statistics are {', '.join(columns)}")
    pairs = F.array(*(F.struct(F.lit(i).alias("item"), columns[i].alias("value")) for i in items))
    return incidents.select(F.inline(pairs)).groupBy("item", "value").agg(rows().alias("hits"))


def severity_label(column: str = "severity") -> Column:
    text = F.col(column)
    return F.when(has_value(text), F.lower(text)).otherwise(F.lit("unknown"))


def severity_histogram(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per lowercased severity; a missing one counts as unknown."""
    return df.groupBy(*keys, severity_label().alias("severity")).agg(rows().alias("hits"))


def vulnerability_counters(df: DataFrame, key: str = "epid", column: str = "vuln_stats") -> DataFrame:
    """``(key, severity, hits)`` from the counters an endpoint carries.

    Counters may be numbers or digit text; zero, negative and other values are
    dropped, unknown counters keep their own name.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StructType):
        entries = F.array(
            *(
                F.struct(F.lit(f.name).alias("key"), as_int(F.col(f"{column}.`{f.name}`"), f.dataType).alias("hits"))
                for f in dtype.fields
            )
        )
        pairs = df.select(key, F.inline(entries))
    else:
        pairs = df.select(key, F.explode(column)).select(key, "key", as_int(F.col("value")).alias("hits"))
    labels = F.create_map(*(F.lit(x) for pair in fv.VULN_COUNTER_LABELS.items() for x in pair))
    known = F.element_at(labels, F.col("key"))
    return pairs.where((F.col("hits") > 0) & F.col("key").startswith("cnt_")).select(
        key, F.coalesce(known, F.col("key")).alias("severity"), "hits"
    )


def endpoint_stats(endpoints: DataFrame, window: TimeWindow, first_seen: str = "first_seen") -> DataFrame:
    """One row: all endpoints, those first seen in the window, with and without a user."""
    identified = F.coalesce(F.size("user") > 0, F.lit(False))
    return endpoints.agg(
        rows().alias("total"),
        count_where(window.on(endpoints, first_seen)).alias("new"),
        count_where(identified).alias("identified"),
        count_where(~identified).alias("unidentified"),
    )


def enduser_stats(
    users: DataFrame, window: TimeWindow, items: Sequence[str] = ("total-count", "new-count"), first_seen: str = "first_seen"
) -> DataFrame:
    """One row with the requested user counts."""
    known = {"total-count": rows(), "new-count": count_where(window.on(users, first_seen))}
    strange = [i for i in items if i not in known]
    if strange or not items:
        raise PlanError(f"user statistics are {', '.join(known)}")
    return users.agg(*(known[i].alias(i.replace("-", "_")) for i in items))


def ips_summary(attacks: DataFrame) -> DataFrame:
    """One row: matching IPS rows, and those with a packet capture."""
    return attacks.agg(
        rows().alias("count"), count_where(has_value(F.col("pcapurl"))).alias("pcap_available_count")
    )


def pcap_list(attacks: DataFrame) -> DataFrame:
    """The short form of IPS rows that have a packet capture."""
    date, time = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("date", "time"))
    plain = ["attack", "severity", "action", "srcip", "dstip", "srcport", "dstport", "cve"]
    return attacks.where(has_value(F.col("pcapurl"))).select(
        F.col("sessionid").alias("session_id"),
        *plain,
        F.trim(F.concat(date, F.lit(" "), time)).alias("timestamp"),
    )


def rule_catalogue(basic: DataFrame, correlation: DataFrame) -> DataFrame:
    """Both kinds of alert rule as one labelled table."""
    labelled = [df.withColumn("handler_class", F.lit(n)) for n, df in (("basic", basic), ("correlation", correlation))]
    return labelled[0].unionByName(labelled[1], allowMissingColumns=True)


def rule_counts(catalogue: DataFrame, rules: str = "rule") -> DataFrame:
    """Handlers and rules per class; a handler without a rule list adds none."""
    size = F.greatest(F.coalesce(F.size(rules), F.lit(0)), F.lit(0))
    return catalogue.groupBy("handler_class").agg(
        rows().alias("handler_count"), F.sum(size).cast("bigint").alias("rule_count")
    )


def section_counts(sections: dict[str, DataFrame]) -> DataFrame:
    """Rows per section of a composed analysis."""
    merged: DataFrame | None = None
    for name, df in sections.items():
        one = df.agg(rows().alias("rows")).select(F.lit(name).alias("section"), "rows")
        merged = one if merged is None else merged.unionByName(one)
    return merged
