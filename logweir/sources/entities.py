"""Entity tables: alerts, incidents, endpoints, users, vulnerabilities, devices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.plans.conditions import Condition, compile_conditions
from logweir.plans.timewindow import TimeWindow
from logweir.plans.vocabulary import Projection, project, vocabulary

# Table -> (identifier column, time column the window filters).
ENTITY_KEYS = {
    "alert": ("alertid", "alerttime"),
    "incident": ("incid", "createtime"),
    # The window on endpoints and users is on when they were first seen.
    "endpoint": ("epid", "first_seen"),
    "enduser": ("euid", "first_seen"),
    "vulnerability": ("epid", "detected"),
    "device": ("name", None),
    "task": ("id", None),
    "report": ("tid", "timestamp"),
}


def entities(
    df: DataFrame,
    kind: str,
    ids: Sequence | None = None,
    window: TimeWindow | None = None,
    conditions: Sequence[Condition] = (),
    fields: Sequence[str] | None = ("*",),
) -> Projection:
    """Rows of one entity table by id list, window and conditions."""
    vocab = vocabulary(kind)
    key, moment = ENTITY_KEYS[kind]
    if ids is not None:
        df = df.where(F.col(key).isin(list(ids)))
    if window is not None and moment is not None:
        df = window.filter(df, moment)
    compiled = compile_conditions(conditions, vocab, df)
    shown = project(compiled.filter(df), vocab, fields)
    return Projection(shown.df, (*compiled.warnings, *shown.warnings))


def by_detector(df: DataFrame, detector: str | None = None) -> DataFrame:
    """Findings of one detector; none named means all of them together."""
    return df if detector is None else df.where(F.lower("detectby") == detector.strip().lower())


def unite_detectors(findings: dict[str, DataFrame]) -> DataFrame:
    """One table from several detectors' findings, in the order of their names."""
    merged: DataFrame | None = None
    for name in sorted(findings):
        labelled = findings[name].withColumn("detectby", F.lit(name))
        merged = labelled if merged is None else merged.unionByName(labelled, allowMissingColumns=True)
    return merged


def report_history(
    reports: DataFrame, window: TimeWindow | None = None, title: str | None = None, time_column: str = "timestamp"
) -> DataFrame:
    """Generated reports in a window, by part of their title."""
    rows = reports if window is None else window.filter(reports, time_column)
    if title is not None:
        rows = rows.where(F.lower("title").contains(title.lower()))
    return rows


def export(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """A result as data files, one per task: CSV, XML, JSON or Parquet."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "xml":
        writer.option("rootTag", "report").option("rowTag", "row").xml(path)
    elif fmt in ("json", "parquet"):
        writer.format(fmt).save(path)
    else:
        raise ValueError(f"unknown report format '{fmt}'")
