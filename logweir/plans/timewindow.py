"""Time windows over naive event time, both ends inclusive to the second."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.plans import fixed_values as fv
from logweir.plans.errors import PlanError

_LAYOUTS = {19: "%Y-%m-%d %H:%M:%S", 16: "%Y-%m-%d %H:%M", 10: "%Y-%m-%d"}
_EPOCH = datetime(1970, 1, 1)
# The partition column that ``write_logs`` adds.
DAY = "log_date"


@dataclass(frozen=True)
class TimeWindow:
    """A resolved window.  One value is passed to every part of a query."""

    start: datetime
    end: datetime
    source: str = "custom"
    clock_skew_seconds: int | None = None
    capped: bool = False

    @property
    def seconds(self) -> int:
        return int((self.end - self.start).total_seconds()) + 1

    def on(self, df: DataFrame, column: str = "itime") -> Column:
        """The predicate, typed like ``column`` so that it reaches the scan.

        The upper bound is exclusive one second later: the last second counts in
        full whatever fraction the stored time carries.
        """
        dtype = df.schema[column].dataType
        after = self.end + timedelta(seconds=1)
        col = F.col(column)
        if isinstance(dtype, T.IntegralType):
            lo, hi = (int((t - _EPOCH).total_seconds()) for t in (self.start, after))
            return (col >= F.lit(lo)) & (col < F.lit(hi))
        kind = dtype if isinstance(dtype, T.TimestampType) else T.TimestampNTZType()
        lo, hi = (F.lit(str(t)).cast(kind) for t in (self.start, after))
        return (col >= lo) & (col < hi)

    def filter(self, df: DataFrame, column: str = "itime") -> DataFrame:
        return df.where(self.on(df, column))


def _side(text: str, is_end: bool) -> datetime:
    layout = _LAYOUTS.get(len(text))
    if layout is None:
        raise PlanError(f"'{text}' is not 'YYYY-MM-DD[ HH:MM[:SS]]'")
    try:
        moment = datetime.strptime(text, layout)
    except ValueError:
        raise PlanError(f"'{text}' is not 'YYYY-MM-DD[ HH:MM[:SS]]'") from None
    whole_day = is_end and len(text) == 10
    return moment + timedelta(hours=23, minutes=59, seconds=59) if whole_day else moment


def custom_window(text: str) -> TimeWindow:
    """``start|end`` in one of three precisions; a date-only end covers its day."""
    first, _, last = (part.strip() for part in text.partition("|"))
    if not first or not last:
        raise PlanError(f"a custom window is 'start|end', got '{text}'")
    window = TimeWindow(_side(first, False), _side(last, True))
    if window.start > window.end:
        raise PlanError(f"the window '{text}' starts after it ends")
    return window


def preset_window(name: str, anchor: datetime, source: str = "anchor") -> TimeWindow:
    """A preset that ends at ``anchor``."""
    minutes = fv.PRESET_MINUTES.get(name)
    if minutes is None:
        raise PlanError(f"unknown window '{name}'; known: {', '.join(fv.PRESET_MINUTES)}")
    end = anchor.replace(tzinfo=None, microsecond=0)
    return TimeWindow(end - timedelta(minutes=minutes), end, source)


@dataclass(frozen=True)
class Anchor:
    """Where relative windows end, and how that was decided."""

    moment: datetime
    source: str
    clock_skew_seconds: int | None


def choose_anchor(candidates: Sequence[tuple[str, datetime | None]], now: datetime) -> Anchor:
    """The first plausible candidate; else ``now``."""
    oldest = now - timedelta(days=fv.ANCHOR_MAX_PAST_DAYS)
    newest = now + timedelta(days=fv.ANCHOR_MAX_FUTURE_DAYS)
    for source, moment in candidates:
        if moment is not None and oldest <= moment <= newest:
            return Anchor(moment, source, int((moment - now).total_seconds()))
    return Anchor(now, "clock", 0)


def newest_log_time(df: DataFrame, column: str = "itime") -> DataFrame:
    """One row: the newest event time.  Only the time column is read."""
    return df.agg(F.max(column).alias("newest"))


def data_anchor(df: DataFrame, now: datetime, column: str = "itime") -> Anchor:
    """The data's own clock.  Brings one row to the driver.

    Of a table partitioned by day only the newest day that is not in the future is read.
    """
    if DAY in df.columns and isinstance(df.schema[DAY].dataType, T.DateType):
        limit = (now + timedelta(days=fv.ANCHOR_MAX_FUTURE_DAYS)).date()
        day = df.where(F.col(DAY) <= F.lit(limit)).agg(F.max(DAY)).first()[0]
        if day is not None:
            df = df.where(F.col(DAY) == F.lit(day))
    newest = newest_log_time(df, column).first()["newest"]
    if isinstance(newest, int):
        newest = _EPOCH + timedelta(seconds=newest)
    if newest is not None:
        newest = newest.replace(microsecond=0)
    return choose_anchor([("newest_log", newest)], now)


def shared_anchor(tables: Sequence[DataFrame], now: datetime, column: str = "itime") -> Anchor:
    """One clock for several tables: the newest plausible row of any of them."""
    found = [data_anchor(df, now, column) for df in tables]
    known = [a for a in found if a.source != "clock"]
    return max(known, key=lambda a: a.moment) if known else Anchor(now, "clock", 0)


def anchored_window(text: str, anchor: Anchor, now: datetime) -> TimeWindow:
    """A custom window as written, or a preset on a clock decided before."""
    if "|" in text:
        return custom_window(text)
    return replace(preset_window(text, anchor.moment, anchor.source), clock_skew_seconds=anchor.clock_skew_seconds)


def resolve_window(text: str, df: DataFrame, now: datetime, column: str = "itime") -> TimeWindow:
    """A custom window as written, or a preset on the data's clock."""
    if "|" in text:
        return custom_window(text)
    if text not in fv.PRESET_MINUTES:
        return preset_window(text, now)
    anchor = data_anchor(df, now, column)
    return replace(
        preset_window(text, anchor.moment, anchor.source),
        clock_skew_seconds=anchor.clock_skew_seconds,
    )


def _bounded(text: str, limit: str, widen: bool) -> tuple[str, bool]:
    minutes = fv.PRESET_MINUTES.get(text)
    bound = fv.PRESET_MINUTES[limit]
    if minutes is None or (minutes >= bound if widen else minutes <= bound):
        return text, False
    return limit, True


def cap_window(text: str, widest: str = fv.SWEEP_WIDEST) -> tuple[str, bool]:
    """Narrow a preset wider than ``widest``; custom windows pass."""
    return _bounded(text, widest, widen=False)


def floor_window(text: str, narrowest: str = fv.VPN_NARROWEST) -> str:
    """Widen a preset narrower than ``narrowest``; custom windows pass."""
    return _bounded(text, narrowest, widen=True)[0]


def report_period(text: str) -> str:
    """The report spelling of a window: ``last-N-hours`` and the like, or ``other``."""
    parts = text.split("-")
    if parts[0] == "last" and parts[-1] in ("hours", "days", "weeks", "months"):
        return text
    if "|" in text:
        return "other"
    if text not in fv.REPORT_PRESETS:
        raise PlanError(f"unknown report window '{text}'; known: {', '.join(fv.REPORT_PRESETS)}")
    return f"last-{parts[0]}-{parts[1]}s"


def slice_count(window: TimeWindow, policies: int) -> int:
    """How many slices one policy's scan gets in a bounded analysis."""
    if window.seconds - 1 <= 24 * 3600:
        return 1
    share = fv.POLICY_QUERY_BUDGET // max(policies, 1)
    return min(fv.POLICY_MAX_SLICES, max(1, share))


def slices(window: TimeWindow, count: int) -> list[TimeWindow]:
    """Contiguous inclusive slices whose lengths differ by at most a second."""
    if count <= 1 or window.end <= window.start:
        return [window]
    total = window.seconds
    count = min(count, total)
    edges = [window.start + timedelta(seconds=total * i // count) for i in range(count + 1)]
    return [
        replace(window, start=lo, end=hi - timedelta(seconds=1))
        for lo, hi in zip(edges, edges[1:], strict=False)
    ]


def slice_id(df: DataFrame, parts: Sequence[TimeWindow], column: str = "itime") -> Column:
    """The index of the slice a row falls into; NULL outside all of them."""
    label = F.when(parts[0].on(df, column), F.lit(0))
    for index, part in enumerate(parts[1:], start=1):
        label = label.when(part.on(df, column), F.lit(index))
    return label
