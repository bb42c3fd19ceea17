"""Pages, totals, drift between reads, top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions.coercion import event_order
from logweir.plans import fixed_values as fv
from logweir.plans.errors import PlanError


@dataclass(frozen=True)
class Page:
    df: DataFrame
    limit: int | None
    offset: int
    warnings: tuple[str, ...]


def at_least_one(limit: int | None) -> tuple[int | None, list[str]]:
    """A limit of the caller's, which may be none at all but not below one."""
    if limit is None or limit >= 1:
        return limit, []
    return 1, [f"limit {limit} was set to 1"]


def _orderable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def newest_first(df: DataFrame, time_column: str = "itime") -> list[Column]:
    """Newest first, ties broken by every column: equal rows are interchangeable."""
    rest = [c for c in _orderable(df) if c != time_column]
    return [F.col(f"`{time_column}`").desc_nulls_last(), *(F.col(f"`{c}`") for c in rest)]


def page(
    df: DataFrame,
    limit: int | None = 100,
    offset: int = 0,
    time_column: str = "itime",
) -> Page:
    """One page, newest first.  Each task keeps ``offset + limit`` rows.

    Without a limit every row follows, sorted only if an offset makes the order matter.
    Deep pages are cheaper through ``page_after``, which skips nothing.
    """
    limit, warnings = at_least_one(limit)
    if offset < 0:
        raise PlanError("offset cannot be negative")
    if limit is None and not offset:
        return Page(df, limit, offset, tuple(warnings))
    ordered = df.orderBy(*newest_first(df, time_column)).offset(offset)
    return Page(ordered if limit is None else ordered.limit(limit), limit, offset, tuple(warnings))


def page_after(
    df: DataFrame, cursor: Mapping[str, object] | None, limit: int = 100, time_column: str = "itime", ties: Sequence[str] = ("logid",)
) -> DataFrame:
    """The next page after a cursor: the time and tie columns of the last row seen.

    The cursor is a filter on the time, which reaches the scan, so a page costs the
    same however deep it lies and is not moved by rows that arrive later.  The ties
    must tell rows of one time apart; rows without a time come last.
    """
    order = [F.col(time_column).desc_nulls_last(), *(F.col(t).asc_nulls_first() for t in ties)]
    if cursor is not None:
        df = df.where(_follows(df, cursor, time_column, ties))
    return df.orderBy(*order).limit(limit)


def _follows(df: DataFrame, cursor: Mapping[str, object], time_column: str, ties: Sequence[str]) -> Column:
    def at(name: str) -> Column:
        return F.lit(cursor[name]).cast(df.schema[name].dataType)

    later: Column = F.lit(False)
    for name in reversed(ties):
        column = F.col(name)
        same = column.eqNullSafe(at(name))
        beyond = column.isNotNull() if cursor[name] is None else column > at(name)
        later = F.coalesce(beyond, F.lit(False)) | (same & later)
    moment = F.col(time_column)
    if cursor[time_column] is None:
        return moment.isNull() & later
    # The first part is a plain range that the scan can use.
    return ((moment <= at(time_column)) | moment.isNull()) & ((moment < at(time_column)) | moment.isNull() | later)


def cursor_of(row: Row, time_column: str = "itime", ties: Sequence[str] = ("logid",)) -> dict[str, object]:
    """The cursor behind a row of a page."""
    return {c: row[c] for c in (time_column, *ties)}


def total(df: DataFrame, name: str = "total") -> DataFrame:
    """One row: how many rows match."""
    return df.agg(F.count(F.lit(1)).alias(name))


def page_status(df: DataFrame, limit: int, offset: int) -> DataFrame:
    """One row: total, rows on the page, whether more follow, and where."""
    all_rows = F.col("total")
    count = F.greatest(F.least(all_rows - offset, F.lit(limit)), F.lit(0))
    more = (F.col("page_rows") > 0) & (all_rows > offset + F.col("page_rows"))
    return (
        total(df)
        .withColumn("page_rows", count.cast("bigint"))
        .withColumn("has_more", more)
        .withColumn("next_offset", F.when(more, (F.lit(offset) + F.col("page_rows")).cast("bigint")))
        .withColumn(
            "high_volume",
            more & (all_rows >= max(10 * limit, fv.HIGH_VOLUME_FLOOR)),
        )
    )


def has_more(offset: int, count: int, limit: int, known_total: int | None) -> bool:
    """Whether rows follow a page; without a total, a full page suggests so."""
    if count == 0:
        return False
    return count >= limit if known_total is None else offset + count < known_total


@dataclass(frozen=True)
class Drift:
    """A later page's total held against the first page's."""

    total: int | None
    page_total: int | None
    stability: str
    delta: int | None
    paging_total: int | None


def drift(first: int | None, now: int | None) -> Drift:
    if first is None or now is None:
        return Drift(first, now, "unknown", None, now if first is None else first)
    label = "stable" if first == now else "drifted"
    return Drift(first, now, label, now - first, max(first, now))


def count_drift(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two reads of one window compared: rows per key, and what arrived in between.

    Both sides are counted first, so the join sees one row per key.
    """
    counted = [
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        for df, name in ((before, "total"), (after, "page_total"))
    ]
    matched = [F.col(f"b.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys]
    joined = counted[0].alias("b").join(counted[1].alias("a"), matched, "full_outer")
    first, now = (F.coalesce(F.col(c), F.lit(0)) for c in ("total", "page_total"))
    return joined.select(
        *(F.coalesce(F.col(f"b.{k}"), F.col(f"a.{k}")).alias(k) for k in keys),
        first.alias("total"),
        now.alias("page_total"),
        (now - first).alias("total_delta"),
        F.when(first == now, "stable").otherwise("drifted").alias("stability"),
    )


def top_k(groups: DataFrame, sort_by: str | None, limit: int | None, descending: bool = True) -> Page:
    """The first ``limit`` groups by one measure, ties by the other columns; all without one."""
    limit, warnings = at_least_one(limit)
    ties = [F.col(f"`{c}`") for c in _orderable(groups) if c != sort_by]
    if sort_by is not None:
        lead = F.col(f"`{sort_by}`")
        ties = [lead.desc_nulls_last() if descending else lead.asc_nulls_last(), *ties]
    ordered = groups.orderBy(*ties)
    return Page(ordered if limit is None else ordered.limit(limit), limit, 0, tuple(warnings))


def first_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "position"
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark itself drops later rows before the shuffle while ``n`` is within
    ``spark.sql.optimizer.windowGroupLimitThreshold``, so a hot key sends at most ``n``
    rows per task; raise that setting for larger ``n``.
    """
    within = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(within)).where(F.col(rank) <= n)


def first_with_total(df: DataFrame, order: Sequence[Column], limit: int | None) -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` rows (all of them without one), and one row with how many matched."""
    return df if limit is None else df.orderBy(*order).limit(limit), total(df, "matched_total")


def by_event_time(df: DataFrame, column: str, *ties: str) -> DataFrame:
    """Ascending by a time in any of its spellings; what is no time comes last."""
    return df.orderBy(*event_order(F.col(column)), *(F.col(t) for t in ties))


def distinct_keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row per key, the one with the lowest ordinal; merged before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min(F.struct(F.col(ordinal), *(F.col(c) for c in rest if c != ordinal))).alias("_first")
    kept = df.groupBy(*keys).agg(first)
    return kept.select(*keys, *(F.col(f"_first.{c}").alias(c) for c in rest))
