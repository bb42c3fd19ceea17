"""The ready-made rankings, declared as dimension, measures and sort column."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.paging import Page, top_k
from logweir.plans import fixed_values as fv
from logweir.plans.errors import PlanError

# Chosen here: the weight of one detection in the threat ranking.
THREAT_WEIGHTS = {"critical": 50, "high": 30, "medium": 10, "low": 5, "info": 0}
# Chosen here: what counts as a stopped attack.
STOPPED = ["blocked", "dropped", "reset", "clear_session"]


def _bytes(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _volume(df: DataFrame) -> dict[str, Column]:
    return {
        "sessions": F.count(F.lit(1)),
        "bandwidth": (_bytes("sentbyte") + _bytes("rcvdbyte")),
        "traffic_out": _bytes("sentbyte"),
        "traffic_in": _bytes("rcvdbyte"),
    }


def _labelled(column: Column, labels: Mapping[str, int]) -> Column:
    value = F.lit(0)
    for label, points in labels.items():
        value = F.when(F.lower(column) == label, F.lit(points)).otherwise(value)
    return value


def _threat(df: DataFrame) -> dict[str, Column]:
    stopped = F.lower("action").isin(STOPPED)
    hits = F.count(F.lit(1))
    blocked = F.count(F.when(stopped, True))
    linked = F.col("incid").isNotNull() if "incid" in df.columns else F.lit(False)
    weight = _labelled(F.col("severity"), THREAT_WEIGHTS)
    return {
        "threattype": F.col("threattype") if "threattype" in df.columns else F.lit("attack"),
        "threatlevel": F.max(weight).cast("bigint"),
        "threatweight": F.sum(weight).cast("bigint"),
        "threat_block": blocked,
        "threat_pass": hits - blocked,
        "incidents": F.count(F.when(linked, True)),
        "incident_block": F.count(F.when(linked & stopped, True)),
        "incident_pass": F.count(F.when(linked & ~stopped, True)),
    }


def _sessions(df: DataFrame) -> dict[str, Column]:
    zero = F.lit(0).cast("bigint")
    return {
        "sessions": F.count(F.lit(1)),
        "bandwidth": F.max(zero),
        "traffic_out": F.max(zero),
        "traffic_in": F.max(zero),
    }


def _hits(df: DataFrame) -> dict[str, Column]:
    return {"counts": F.count(F.lit(1))}


def _tunnel(df: DataFrame) -> dict[str, Column]:
    return {
        "first_seen": F.min("itime"),
        "last_seen": F.max("itime"),
        "sessions": F.count(F.lit(1)),
        "bandwidth": _bytes("sentbyte") + _bytes("rcvdbyte"),
    }


@dataclass(frozen=True)
class View:
    """One ranking: its rows, its key columns, its measures and its default sort."""

    population: str
    keys: Mapping[str, Callable[[], Column]]
    measures: Callable[[DataFrame], dict[str, Column]]
    rows: Callable[[], Column] | None = None
    required: tuple[str, ...] = field(default=())
    #: Measures that are the largest text of a group.
    largest: tuple[str, ...] = field(default=())


def _of(name: str, column: str | None = None) -> dict[str, Callable[[], Column]]:
    return {name: lambda: F.col(column or name)}


VIEWS: dict[str, View] = {
    "top-sources": View("traffic", _of("srcip"), _volume),
    "top-destinations": View("traffic", _of("dstip"), _volume),
    "top-applications": View("traffic", _of("app_group", "appcat"), _volume),
    "top-websites": View("webfilter", _of("catdesc"), _volume),
    "top-threats": View("attack", _of("threat", "attack"), _threat, largest=("threattype",)),
    "top-cloud-applications": View("app-ctrl", _of("app"), _sessions),
    "top-countries": View("traffic", _of("dstcountry"), _volume),
    "policy-hits": View("traffic", _of("policyid"), _hits),
    "policy-line": View(
        "traffic",
        {"bucket": lambda: F.window(F.col("itime"), "1 hour")["start"], **_of("policyid")},
        _hits,
    ),
    "site-to-site-ipsec": View(
        "event", _of("tunnel"), _tunnel, rows=lambda: F.lower("subtype") == "vpn"
    ),
}


def view_groups(df: DataFrame, name: str, width: str = "1 hour") -> DataFrame:
    """Every group of a view with its measures; one partial and one final aggregation."""
    spec = VIEWS.get(name)
    if spec is None:
        raise PlanError(f"unknown view '{name}'; known: {', '.join(sorted(VIEWS))}")
    rows = df if spec.rows is None else df.where(spec.rows())
    keys = {n: make() for n, make in spec.keys.items()}
    if "bucket" in keys:
        keys["bucket"] = F.window(F.col("itime"), width)["start"]
    measures = spec.measures(rows)
    texts = {n: measures[n] for n in spec.largest}
    numbers = [c.alias(n) for n, c in measures.items() if n not in texts]
    groups = rows.groupBy(*(c.alias(n) for n, c in {**keys, **texts}.items())).agg(*numbers)
    if not texts:
        return groups
    # The text is grouped by first, so that rows are merged by hashing; only the groups meet its maximum.
    merged = {n: F.max(n) if n in texts or n == "threatlevel" else F.sum(n) for n in measures}
    return groups.groupBy(*keys).agg(*(c.alias(n) for n, c in merged.items()))


def view(
    df: DataFrame, name: str, sort_by: str | None = None, limit: int | None = None, descending: bool = True
) -> Page:
    """The groups of a view by its own sort column or the caller's; the first ones with a ``limit``."""
    groups = view_groups(df, name)
    lead = sort_by or fv.VIEW_SORT.get(name)
    if lead is not None and lead not in groups.columns:
        raise PlanError(f"the view '{name}' has no column '{lead}'")
    if lead is None and name == "policy-line":
        lead, descending = "bucket", False
    return top_k(groups, lead, limit, descending)


def rollup(df: DataFrame, keys: list[str], time_column: str = "itime") -> DataFrame:
    """Hourly sums that additive views can be answered from instead of raw logs."""
    hour = F.date_trunc("hour", F.col(time_column)).alias("hour")
    return df.groupBy(hour, *keys).agg(
        F.count(F.lit(1)).alias("sessions"),
        _bytes("sentbyte").alias("traffic_out"),
        _bytes("rcvdbyte").alias("traffic_in"),
    )
