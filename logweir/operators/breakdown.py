"""Exact groups, independent breakdowns, residuals, bounded samples, policies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.derived import DERIVED, dimension
from logweir.functions.predicates import policy_scope
from logweir.operators.paging import first_per_group, newest_first
from logweir.plans import fixed_values as fv
from logweir.plans.errors import NoExactView, PlanError, WrongPopulation
from logweir.plans.timewindow import TimeWindow, slice_count, slice_id, slices
from logweir.plans.vocabulary import Vocabulary, dimensions


def exact_dimensions(population: str) -> list[str]:
    """The dimensions some view groups this population by."""
    if population == "alert":
        return sorted(fv.ALERT_GROUPS)
    if population == "incident":
        return sorted(fv.INCIDENT_GROUPS)
    return sorted(d for d, (_, serves) in fv.GROUP_VIEWS.items() if serves == population)


def check_exact(vocab: Vocabulary, name: str, filters: Sequence[str] = ()) -> tuple[str, str | None]:
    """``(dimension, view)``, or the reason why no view answers exactly."""
    dim, _ = vocab.resolve(name, strict=False)
    supported = exact_dimensions(vocab.name)
    if dim in supported:
        view = None if vocab.name in ("alert", "incident") else fv.GROUP_VIEWS[dim][0]
        strange = [f for f in filters if view and fv.VIEW_FILTERS.get(view) != f]
        if strange:
            raise PlanError(f"the view '{view}' does not filter by {', '.join(strange)}")
        return dim, view
    if dim in fv.GROUP_VIEWS and vocab.name not in ("alert", "incident"):
        raise WrongPopulation(name, vocab.name, *fv.GROUP_VIEWS[dim], supported)
    raise NoExactView(name, vocab.name, supported)


def check_mode(
    group_by: str | None, sample_by: Sequence[str] | None, count_only: bool, fields: Sequence[str] | None
) -> list[str]:
    """At most one way of aggregating; naming fields with one is pointless."""
    chosen = [n for n, on in (("group_by", group_by), ("sample_by", sample_by), ("count_only", count_only)) if on]
    if len(chosen) > 1:
        raise PlanError(f"choose one of {' and '.join(chosen)}")
    return [f"fields are ignored with {chosen[0]}"] if chosen and fields else []


def group_by(df: DataFrame, vocab: Vocabulary, name: str, strict: bool = False, *measures: Column) -> DataFrame:
    """Exact rows per value of one column.  Any column is exact here; ``strict``
    keeps to the dimensions a view serves."""
    dim = check_exact(vocab, name)[0] if strict else vocab.resolve(name, strict=False)[0]
    value = F.col(f"`{dim}`") if dim in df.columns else F.lit(None).cast("string")
    return df.groupBy(value.alias(dim)).agg(F.count(F.lit(1)).alias("hits"), *measures)


def buckets(df: DataFrame, dims: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, dimension, value, hits)`` for every dimension from one scan.

    Each row becomes one small pair per dimension and is counted before the
    shuffle.  A NULL value counts the rows that belong to no bucket.
    """
    pairs = F.array(*(F.struct(F.lit(d).alias("dimension"), dimension(df, d).alias("value")) for d in dims))
    named = [F.col(f"`{k}`") for k in keys]
    return (
        df.select(*named, F.inline(pairs))
        .groupBy(*named, "dimension", "value")
        .agg(F.count(F.lit(1)).alias("hits"))
    )


def top_buckets(counted: DataFrame, top_n: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """The largest buckets per dimension, ties by value; 0 keeps them all."""
    real = F.col("value").isNotNull()
    if top_n <= 0:
        return counted.where(real)
    # The excluded rows sort last and go afterwards: a filter before the ranking would
    # sink below the counting, and residuals could not share its shuffle.
    order = [F.col("value").isNull(), F.col("hits").desc(), F.col("value")]
    return first_per_group(counted, [*keys, "dimension"], order, top_n).where(real).drop("position")


def residuals(counted: DataFrame, top_n: int = 10, keys: Sequence[str] = ()) -> DataFrame:
    """What a breakdown left out, per dimension."""
    by = [*keys, "dimension"]
    real = F.col("value").isNotNull()
    whole = counted.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(~real, F.col("hits"))), F.lit(0)).alias("excluded_rows"),
        F.count(F.when(real, True)).alias("distinct_values"),
        F.coalesce(F.sum(F.when(real, F.col("hits"))), F.lit(0)).alias("hits_total"),
    )
    if top_n <= 0:
        return whole.withColumn("buckets_truncated", F.lit(False)).withColumn(
            "hits_shown", F.col("hits_total")
        )
    shown = top_buckets(counted, top_n, keys).groupBy(*by).agg(F.sum("hits").alias("hits_shown"))
    return whole.join(shown, by, "left").select(
        *by,
        "excluded_rows",
        "distinct_values",
        (F.col("distinct_values") > top_n).alias("buckets_truncated"),
        F.coalesce("hits_shown", F.lit(0)).alias("hits_shown"),
        "hits_total",
    )


@dataclass(frozen=True)
class Breakdown:
    buckets: DataFrame
    residuals: DataFrame
    warnings: tuple[str, ...] = ()


def breakdowns(df: DataFrame, vocab: Vocabulary, names: Sequence[str], top_n: int = 10) -> Breakdown:
    """Independent counts per dimension, never a cross table."""
    dims, warnings = dimensions(vocab, names, DERIVED)
    counted = buckets(df, dims)
    return Breakdown(top_buckets(counted, top_n), residuals(counted, top_n), tuple(warnings))


def bounded_sample(
    df: DataFrame, limit: int, parts: Sequence[TimeWindow], time_column: str = "itime", keys: Sequence[str] = ()
) -> DataFrame:
    """At most ``limit`` newest rows per slice (and key), the slice in ``slice``."""
    cut = df.withColumn("slice", slice_id(df, parts, time_column)).where(F.col("slice").isNotNull())
    order = newest_first(df, time_column)
    return first_per_group(cut, [*keys, "slice"], order, limit).drop("position")


def sample_proof(
    df: DataFrame, limit: int, parts: Sequence[TimeWindow], time_column: str = "itime", keys: Sequence[str] = ()
) -> DataFrame:
    """Whether a bounded sample is the whole: totals per key over all slices.

    A slice that fills its limit counts as cut, even where nothing was left.
    Rows observed follow from the totals, so nothing is sampled here.
    """
    named = [F.col(f"`{k}`") for k in keys]
    per_slice = (
        df.select(*named, slice_id(df, parts, time_column).alias("slice"))
        .where(F.col("slice").isNotNull())
        .groupBy(*named, "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    observed = F.least(F.col("rows"), F.lit(limit))
    summed = per_slice.groupBy(*named).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_hits"),
        F.coalesce(F.sum(observed), F.lit(0)).cast("bigint").alias("observed_hits"),
        F.count(F.when(F.col("rows") >= limit, True)).alias("truncated_slices"),
    )
    exact = F.col("truncated_slices") == 0
    return summed.select(
        *named,
        "total_hits",
        "observed_hits",
        F.lit(len(parts)).cast("bigint").alias("slices_scanned"),
        "truncated_slices",
        exact.alias("is_exact"),
    )


@dataclass(frozen=True)
class PolicyTraffic:
    buckets: DataFrame
    residuals: DataFrame
    summary: DataFrame


def policy_traffic(
    df: DataFrame,
    vocab: Vocabulary,
    window: TimeWindow,
    policy_ids: Sequence[int],
    names: Sequence[str] = ("port", "service", "app"),
    action: str | None = None,
    top_n: int = 10,
    limit: int | None = None,
    time_column: str = "itime",
) -> PolicyTraffic:
    """Breakdowns per policy, all policies in one job.

    Without ``limit`` every row counts and the result is complete.  With it, each
    slice of each policy contributes its newest ``limit`` rows and the summary
    says whether that was everything.  The summary has a row for every policy asked
    for: one without any rows had none, and is complete.
    """
    dims, warnings = dimensions(vocab, names, DERIVED)
    if warnings:
        raise PlanError("; ".join(warnings))
    rows = window.filter(df, time_column).where(policy_scope(policy_ids, action))
    parts = slices(window, slice_count(window, len(policy_ids)))
    whole = limit is None
    scanned = rows if whole else bounded_sample(rows, limit, parts, time_column, ["policyid"])
    counted = buckets(scanned, dims, ["policyid"])
    proof = sample_proof(rows, limit or 2**62, parts, time_column, ["policyid"])
    kind = df.schema["policyid"].dataType
    asked = F.array(*(F.lit(p).cast(kind) for p in sorted(set(policy_ids))))
    named = df.sparkSession.range(1).select(F.explode(asked).alias("policyid"))
    proof = named.join(proof, "policyid", "left").select(
        "policyid",
        *(
            (F.coalesce(F.col(c), F.lit(len(parts) if c == "slices_scanned" else 0)) if c != "is_exact" else F.coalesce(F.col(c), F.lit(True)))
            .cast(proof.schema[c].dataType)
            .alias(c)
            for c in proof.columns
            if c != "policyid"
        ),
    )
    mode = F.when(F.col("is_exact"), "complete").otherwise("bounded_sample")
    return PolicyTraffic(
        top_buckets(counted, top_n, ["policyid"]),
        residuals(counted, top_n, ["policyid"]),
        proof.withColumn("analysis_mode", mode),
    )
