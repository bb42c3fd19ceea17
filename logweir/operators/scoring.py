"""Percentile ranks, risk, anomaly and triage verdicts, reputations, headlines."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.functions.derived import stripped
from logweir.operators.stats import severity_label
from logweir.plans import fixed_values as fv


#: Distinct values that one task sums up.
RANGE_VALUES = 100_000


def percentile_ranks(values: DataFrame, column: str, pieces: int | None = None) -> DataFrame:
    """``(column, population, percentile)`` for each distinct value: the share of the
    population at or below it, in percent to one place; NULL for fewer than two.

    Equal values are counted first, so a value shared by a third of the rows is one
    row.  Distinct values are then cut into ranges at approximate quantiles: ranges
    sum up on their own and only their totals, one row of each range, meet in one
    task.  There are as many ranges as hold RANGE_VALUES values each, unless ``pieces``
    says otherwise.  The cuts are plain numbers in the plan and need not be exact.
    """
    scored = values.where(F.col(column).isNotNull())
    counted = scored.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    if pieces is None:
        distinct = scored.agg(F.approx_count_distinct(column)).first()[0]
        pieces = max(2, -(-distinct // RANGE_VALUES))
    shares = [i / pieces for i in range(1, pieces)]
    cuts = sorted(set(counted.approxQuantile(column, shares, 1.0 / (2 * pieces)))) if shares else []
    piece = F.lit(0)
    if cuts:
        marks = F.array(*(F.lit(float(c)) for c in cuts))
        piece = F.size(F.filter(marks, lambda m: m < F.col(column).cast("double")))
    placed = counted.withColumn("_piece", piece)
    inside = Window.partitionBy("_piece").orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("_inside", F.sum("_n").over(inside))
    totals = placed.groupBy("_piece").agg(F.sum("_n").alias("_size"))
    # One row per piece from here on: the single-task window is over those rows only.
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_piece",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(everything).alias("population"),
    )
    at_or_below = F.col("_before") + F.col("_inside")
    # Tenths are rounded half to even on an exact decimal.
    share = F.bround(F.lit(100.0) * at_or_below / F.col("population"), 1)
    return running.join(F.broadcast(offsets), "_piece").select(
        column, "population", F.when(F.col("population") >= 2, share).alias("percentile")
    )


def _points(points: Mapping[str, int], prefix: str) -> Column:
    summed = reduce(
        lambda a, b: a + b, (F.coalesce(F.col(f"{prefix}_{s}"), F.lit(0)) * p for s, p in points.items())
    )
    return F.least(F.lit(100), summed).cast("bigint")


def _by_severity(findings: DataFrame, key: str, points: Mapping[str, int], prefix: str) -> DataFrame:
    counts = [F.count(F.when(severity_label() == s, True)).alias(f"{prefix}_{s}") for s in points]
    return findings.where(F.col(key).isNotNull()).groupBy(key).agg(*counts)


def risk(
    entities: DataFrame,
    vulnerabilities: DataFrame | None,
    threats: DataFrame | None,
    failures: DataFrame | None,
    key: str = "epid",
) -> DataFrame:
    """Composite risk of every entity from three capped scores.

    Each table carries ``key``; it is summed to one row per entity before it is
    joined.  A table that is not there scores 0 and is named in ``unavailable``.
    """
    scored = entities
    missing = []
    for name, df, points in (
        ("vulnerability", vulnerabilities, fv.VULNERABILITY_POINTS),
        ("threat", threats, fv.THREAT_POINTS),
    ):
        if df is None:
            missing.append(name)
            scored = scored.withColumn(f"{name}_score", F.lit(0).cast("bigint"))
            continue
        scored = scored.join(_by_severity(df, key, points, f"_{name}"), key, "left")
        scored = scored.withColumn(f"{name}_score", _points(points, f"_{name}")).drop(
            *(f"_{name}_{s}" for s in points)
        )
    if failures is None:
        missing.append("auth")
        scored = scored.withColumn("auth_score", F.lit(0).cast("bigint"))
    else:
        counted = failures.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_failures"))
        capped = F.least(F.lit(100), F.coalesce("_failures", F.lit(0)) * fv.POINTS_PER_FAILURE)
        scored = scored.join(counted, key, "left").withColumn("auth_score", capped.cast("bigint")).drop("_failures")
    return scored.withColumn("composite", composite()).withColumn("risk_band", band(F.col("composite"))).withColumn(
        "unavailable", F.lit(",".join(missing))
    )


def composite() -> Column:
    """The weighted score in whole points, halves to even, on exact decimals."""
    weighted = reduce(
        lambda a, b: a + b, (F.col(f"{n}_score") * w for n, w in fv.RISK_WEIGHTS.items())
    )
    return F.bround(weighted.cast("decimal(12,2)") / F.lit(100).cast("decimal(3,0)"), 0).cast("int")


def band(score: Column) -> Column:
    label = F.lit("low")
    for name, floor in sorted(fv.RISK_BANDS.items(), key=lambda item: item[1]):
        label = F.when(score >= floor, F.lit(name)).otherwise(label)
    return label


def _detection_basis(detections: Column) -> Column:
    said = fv.EVIDENCE
    return (
        F.when(detections.isNull(), F.lit(said["detections unknown"]))
        .when(detections > 0, F.format_string(said["detections"], detections.cast("string")))
        .otherwise(F.lit(said["no detections"]))
    )


def endpoint_anomaly(df: DataFrame, threshold: float = fv.ANOMALY_PERCENTILE) -> DataFrame:
    """Verdict and basis from ``percentile``, ``population``, ``critical``, ``high``
    and ``detections``; any one flag is enough."""
    percentile, detections = F.col("percentile"), F.col("detections")
    hit = percentile >= threshold
    critical, high = (F.coalesce(F.col(c), F.lit(0)) for c in ("critical", "high"))
    serious = (critical > 0) | (high > 0)
    said, population = fv.EVIDENCE, F.coalesce(F.col("population"), F.lit(0)).cast("string")
    verdict = F.when(hit, said["anomalous"]).otherwise(said["normal"])
    ranked = F.format_string(said["ranked"], percentile.cast("string"), population, F.lit(str(threshold)), verdict)
    unranked = F.format_string(said["unranked"], population)
    detail = F.concat_ws(
        ", ",
        F.when(critical > 0, F.concat(critical.cast("string"), F.lit(" critical"))),
        F.when(high > 0, F.concat(high.cast("string"), F.lit(" high"))),
    )
    carried = F.format_string(said["serious"], detail)
    basis = F.array(
        F.when(percentile.isNull(), unranked).otherwise(ranked),
        F.when(serious, carried).otherwise(F.lit(said["not serious"])),
        _detection_basis(detections),
    )
    flagged = F.coalesce(hit, F.lit(False)) | serious | F.coalesce(detections > 0, F.lit(False))
    return df.withColumn("anomalous", flagged).withColumn("basis", basis)


def enduser_anomaly(df: DataFrame) -> DataFrame:
    """Verdict and basis from ``importance`` and ``detections``."""
    importance, detections = F.col("importance"), F.col("detections")
    important = F.coalesce(F.lower(importance).isin("high", "critical"), F.lit(False))
    shown = F.concat(F.lit("importance is '"), importance, F.lit("'"))
    first = (
        F.when(importance.isNull(), F.lit("end-user carries no 'importance'"))
        .when(important, F.concat(shown, F.lit(" -> ANOMALOUS")))
        .otherwise(shown)
    )
    flagged = important | F.coalesce(detections > 0, F.lit(False))
    return df.withColumn("anomalous", flagged).withColumn("basis", F.array(first, _detection_basis(detections)))


def triage(df: DataFrame, subject_type: str) -> DataFrame:
    """Priority from severity, with the evidence it rests on."""
    severity = F.lower(F.col("severity").cast("string"))
    labels = F.create_map(*(F.lit(x) for pair in fv.PRIORITY_BY_SEVERITY.items() for x in pair))
    priority = F.coalesce(F.element_at(labels, F.coalesce(severity, F.lit(""))), F.lit("informational"))
    by_severity = F.when(
        F.coalesce(severity, F.lit("")) != "",
        F.concat(F.lit(f"{subject_type} severity is '"), severity, F.lit("' -> priority '"), priority, F.lit("'")),
    ).otherwise(F.lit(f"{subject_type} has no severity field -> priority 'informational'"))
    parts = [by_severity]
    if "acknowledged" in df.columns:
        state = F.when(F.coalesce(F.col("acknowledged"), F.lit(False)), "True").otherwise("False")
        parts.append(F.concat(F.lit("alert acknowledged: "), state))
    elif "ackflag" in df.columns:
        parts.append(F.concat(F.lit("alert ackflag: '"), F.col("ackflag").cast("string"), F.lit("'")))
    if "status" in df.columns:
        stated = F.concat(F.lit(f"{subject_type} status: '"), F.col("status").cast("string"), F.lit("'"))
        parts.append(F.when(F.coalesce(F.col("status"), F.lit("")) != "", stated))
    return df.withColumn("priority", priority).withColumn("basis", F.array_compact(F.array(*parts)))


# Two shapes of one reputation source inside ``detail``: engine statistics under
# ``attributes``, or a list of answers under ``response``.
SOURCE_SCHEMA = (
    "array<struct<source: string, data: struct<"
    "attributes: struct<last_analysis_stats: map<string, string>, reputation: string, web_category: string>,"
    "links: struct<self: string>,"
    "response: array<struct<wf_cate: string, ioc_cate: string, av_cate: string, confidence: string,"
    " malware_name: string, reference_url: string>>>>>"
)


def reputation_sources(df: DataFrame, detail: str = "detail") -> DataFrame:
    """One row per reputation source: its name, verdict, confidence, malware and link."""
    carried = [c for c in df.columns if c != detail]
    entries = df.select(*carried, F.explode(F.from_json(detail, SOURCE_SCHEMA)).alias("entry"))
    entries = entries.where(F.col("entry.data").isNotNull())
    data = F.col("entry.data")
    link = data["links"]["self"]
    engines = data["attributes"].isNotNull() | F.coalesce(link.contains("virustotal.com"), F.lit(False))
    stats = data["attributes"]["last_analysis_stats"]
    counts = F.transform(F.map_values(stats), lambda v: F.coalesce(v.try_cast("bigint"), F.lit(0)))
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, v: a + v)
    flagged = reduce(
        lambda a, b: a + b,
        (F.coalesce(F.element_at(stats, F.lit(k)).try_cast("bigint"), F.lit(0)) for k in ("malicious", "suspicious")),
    )
    ratio = F.when(
        total > 0, F.concat(flagged.cast("string"), F.lit("/"), total.cast("string"), F.lit(" engines flagged"))
    )
    first = F.get(data["response"], F.lit(0))

    def given(name: str) -> Column:
        text = stripped(first[name])
        return F.when(text != "", text)

    verdict = F.coalesce(given("wf_cate"), given("ioc_cate"), given("av_cate"))
    fallback = F.when(engines, "VirusTotal").otherwise("unknown")
    return entries.select(
        *carried,
        F.coalesce(F.when(F.col("entry.source") != "", F.col("entry.source")), fallback).alias("source"),
        F.when(engines, ratio).otherwise(verdict).alias("verdict"),
        F.when(~engines, given("confidence")).alias("confidence"),
        F.when(~engines, given("malware_name")).alias("malware"),
        F.when(engines, link).otherwise(given("reference_url")).alias("link"),
    )


def malicious_count(enriched: DataFrame) -> DataFrame:
    """One row: indicators, and those whose reputation is malicious."""
    bad = F.lower(F.coalesce("reputation", F.lit(""))) == "malicious"
    return enriched.agg(
        F.count(F.lit(1)).alias("indicators"), F.count(F.when(bad, True)).alias("malicious")
    )


def headline(subject: Column, *parts: tuple[Column, str]) -> Column:
    """``subject; part; part`` where a part whose value is NULL is left out.

    A part is a value and a pattern with one ``{}`` for it.
    """
    written = []
    for value, pattern in parts:
        before, _, after = pattern.partition("{}")
        written.append(F.concat(F.lit(before), value.cast("string"), F.lit(after)))
    return F.concat_ws("; ", subject, *written)
