"""One object over a set of tables: the questions an analyst asks, by name.

Tables are DataFrames under the names of log types ("traffic", "attack", ...) and
entities ("alert", "incident", "attachment", "endpoint", "enduser", "vulnerability",
"indicator", "enrichment", "device", "task", "report", "basic_rule",
"correlation_rule").  Every answer is lazy; relative windows end at the newest log.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions import predicates as P
from logweir.functions.tokens import Tokenizer
from logweir.operators import breakdown, linkage, masking, paging, stats, views
from logweir.plans import fixed_values as fv
from logweir.plans import timewindow as tw
from logweir.plans.conditions import Condition, compile_conditions
from logweir.plans.errors import PlanError
from logweir.plans.vocabulary import project, vocabulary
from logweir.sources import entities, logs


@dataclass(frozen=True)
class QueryResult:
    """Rows, and lazy one-row or small frames that say what they are a part of."""

    df: DataFrame
    meta: Mapping[str, DataFrame] = field(default_factory=dict)
    warnings: tuple[str, ...] = ()
    window: tw.TimeWindow | None = None
    mode: str = "rows"

    def masked(self, tokens: Tokenizer, **options: Any) -> QueryResult:
        """The same answer with its identifiers replaced."""
        hidden = masking.mask_table(self.df, tokens, **options)
        return QueryResult(hidden, self.meta, self.warnings, self.window, self.mode)


def _conditions(filters: Sequence[Condition | tuple | Mapping]) -> list[Condition]:
    made = []
    for f in filters:
        if isinstance(f, Condition):
            made.append(f)
        elif isinstance(f, Mapping):
            made.append(Condition(f["field"], f.get("op", "eq"), f["value"]))
        else:
            made.append(Condition(*f))
    return made


@dataclass(frozen=True)
class Workbench:
    tables: Mapping[str, DataFrame]
    now: datetime | None = None

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise PlanError(f"no table '{name}'; there are {', '.join(sorted(self.tables))}")
        return self.tables[name]

    def _window(self, time_range: str | None, df: DataFrame, column: str = "itime") -> tw.TimeWindow | None:
        if time_range is None:
            return None
        return tw.resolve_window(time_range, df, self.now or datetime.now(), column)

    # --- logs ----------------------------------------------------------------

    def query_logs(
        self,
        logtype: str = "traffic",
        filters: Sequence = (),
        time_range: str | None = None,
        device: str | None = None,
        where: Column | None = None,
        fields: Sequence[str] | None = None,
        limit: int = 100,
        offset: int = 0,
        group_by: str | None = None,
        sample_by: Sequence[str] | None = None,
        count_only: bool = False,
        sort_by: str | None = None,
        descending: bool = True,
        top_n: int = 10,
        sample_limit: int | None = None,
        strict: bool = False,
    ) -> QueryResult:
        """Rows, an exact group, breakdowns, or a count, of one log type.

        ``filters`` and ``where`` say the same thing in two ways; give one.  ``strict``
        groups only by what a view serves and shows that view's measures.
        """
        if filters and where is not None:
            raise PlanError("give filters or where, not both")
        notes = breakdown.check_mode(group_by, sample_by, count_only, fields)
        name = logs.log_type(logtype)
        vocab, df = vocabulary(name), self.table(name)
        window = self._window(time_range, df)
        compiled = compile_conditions(_conditions(filters), vocab, df)
        rows = df if window is None else window.filter(df)
        rows = rows.where(compiled.column if where is None else where).where(P.device_scope(device))
        warnings = [*notes, *compiled.warnings]
        if count_only:
            return QueryResult(paging.total(rows), {}, tuple(warnings), window, "count")
        if group_by is not None:
            return self._grouped(rows, vocab, group_by, sort_by, limit, descending, strict, warnings, window, filters)
        if sample_by is not None:
            return self._sampled(rows, vocab, sample_by, top_n, sample_limit, warnings, window)
        page = paging.page(rows, limit, offset)
        shown = project(page.df, vocab, fields)
        status = paging.page_status(rows, page.limit, page.offset)
        return QueryResult(shown.df, {"page": status}, (*warnings, *page.warnings, *shown.warnings), window)

    def _grouped(self, rows, vocab, group_by, sort_by, limit, descending, strict, warnings, window, filters) -> QueryResult:
        if strict:
            dim, name = breakdown.check_exact(vocab, group_by, [vocab.resolve(c.field)[0] for c in _conditions(filters)])
            groups = views.view_groups(rows, name) if name else breakdown.group_by(rows, vocab, dim)
            lead = sort_by or (fv.VIEW_SORT.get(name) if name else "hits")
        else:
            groups, lead = breakdown.group_by(rows, vocab, group_by), sort_by or "hits"
        page = paging.top_k(groups, lead, limit, descending)
        truncated = paging.total(groups, "groups").withColumn("groups_truncated", F.col("groups") >= page.limit)
        return QueryResult(page.df, {"groups": truncated}, (*warnings, *page.warnings), window, "exact_groups")

    def _sampled(self, rows, vocab, sample_by, top_n, sample_limit, warnings, window) -> QueryResult:
        meta: dict[str, DataFrame] = {}
        if sample_limit is not None:
            if window is None:
                raise PlanError("a bounded sample needs a window")
            parts = [window]
            meta["proof"] = breakdown.sample_proof(rows, sample_limit, parts)
            rows = breakdown.bounded_sample(rows, sample_limit, parts).drop("slice")
        found = breakdown.breakdowns(rows, vocab, sample_by, top_n)
        meta["residuals"] = found.residuals
        mode = "exact" if sample_limit is None else "bounded_sample"
        return QueryResult(found.buckets, meta, (*warnings, *found.warnings), window, mode)

    def fetch_more_logs(self, before: DataFrame, now: DataFrame, limit: int, offset: int) -> QueryResult:
        """The next page of a window that logs may still be arriving in, and how far its
        total has moved since the first read."""
        page = paging.page(now, limit, offset)
        first, later = paging.total(before), paging.total(now, "page_total")
        moved = later.withColumn("total", first.scalar())
        moved = moved.withColumn("total_delta", F.col("page_total") - F.col("total")).withColumn(
            "stability", F.when(F.col("page_total") == F.col("total"), "stable").otherwise("drifted")
        )
        return QueryResult(page.df, {"drift": moved}, page.warnings)

    def log_stats(self, logtype: str = "traffic") -> DataFrame:
        return logs.freshness(self.table(logs.log_type(logtype)))

    def log_fields(self, logtype: str = "traffic", name_filter: str | None = None) -> DataFrame:
        return logs.field_catalogue(self.table(logs.log_type(logtype)), name_filter)

    def view(
        self,
        name: str,
        time_range: str | None = None,
        filters: Sequence = (),
        device: str | None = None,
        sort_by: str | None = None,
        limit: int = 100,
        descending: bool = True,
    ) -> QueryResult:
        """One of the ready-made rankings."""
        if name not in views.VIEWS:
            raise PlanError(f"unknown view '{name}'; known: {', '.join(sorted(views.VIEWS))}")
        population = views.VIEWS[name].population
        df = self.table(population)
        window = self._window(time_range, df)
        compiled = compile_conditions(_conditions(filters), vocabulary(population), df)
        rows = (df if window is None else window.filter(df)).where(compiled.column).where(P.device_scope(device))
        page = views.view(rows, name, sort_by, limit, descending)
        return QueryResult(page.df, {}, (*compiled.warnings, *page.warnings), window, "view")

    def policy_traffic(
        self,
        policy_ids: Sequence[int],
        time_range: str = "24-hour",
        sample_by: Sequence[str] = ("port", "service", "app"),
        action: str | None = None,
        top_n: int = 10,
        limit: int | None = None,
    ) -> QueryResult:
        """Breakdowns of several policies in one job."""
        df = self.table("traffic")
        window = self._window(time_range, df)
        found = breakdown.policy_traffic(df, vocabulary("traffic"), window, policy_ids, sample_by, action, top_n, limit)
        return QueryResult(found.buckets, {"residuals": found.residuals, "summary": found.summary}, (), window, "policies")

    def search_ips_logs(self, time_range: str | None = None, limit: int = 100, **wanted: Any) -> QueryResult:
        df = self.table("attack")
        window = self._window(time_range, df)
        rows = (df if window is None else window.filter(df)).where(P.ips_search(df, **wanted))
        page = paging.page(rows, limit)
        return QueryResult(page.df, {"summary": stats.ips_summary(rows)}, page.warnings, window)

    def list_pcaps(self, time_range: str | None = None, **wanted: Any) -> DataFrame:
        df = self.table("attack")
        window = self._window(time_range, df)
        rows = df if window is None else window.filter(df)
        return stats.pcap_list(rows.where(P.ips_search(df, has_pcap=True, **wanted)))

    # --- entities ------------------------------------------------------------

    def entities(
        self,
        kind: str,
        ids: Sequence | None = None,
        time_range: str | None = None,
        filters: Sequence = (),
        fields: Sequence[str] | None = None,
        limit: int | None = None,
        offset: int = 0,
    ) -> QueryResult:
        """Alerts, incidents, endpoints, users, devices, tasks or reports."""
        df, moment = self.table(kind), entities.ENTITY_KEYS[kind][1]
        window = self._window(time_range, df, moment) if moment else None
        found = entities.entities(df, kind, ids, window, _conditions(filters))
        rows, warnings = found.df, list(found.warnings)
        if limit is not None:
            page = paging.page(rows, limit, offset, moment or entities.ENTITY_KEYS[kind][0])
            rows, warnings = page.df, [*warnings, *page.warnings]
        shown = project(rows, vocabulary(kind), fields)
        return QueryResult(shown.df, {"total": paging.total(found.df)}, (*warnings, *shown.warnings), window)

    def alert_count(self, time_range: str | None = None) -> DataFrame:
        return stats.alert_count(self._in_window("alert", time_range))

    def alert_counts(self, kind: str, timescale: str = "hour", time_range: str | None = None) -> DataFrame:
        return stats.alert_counts(self._in_window("alert", time_range), kind, timescale)

    def alert_logs(self, alert_ids: Sequence[str], logtype: str = "traffic", limit: int = 20) -> DataFrame:
        alerts = self.table("alert").where(F.col("alertid").isin(list(alert_ids)))
        return linkage.alert_logs(alerts, self.table(logs.log_type(logtype)), limit)

    def alert_incident_stats(self, time_range: str | None = None, timescale: str = "month") -> DataFrame:
        alerts, incidents = self._in_window("alert", time_range), self._in_window("incident", time_range)
        return stats.alert_incident_buckets(alerts, incidents, timescale)

    def alert_rules(self) -> DataFrame:
        return stats.rule_counts(stats.rule_catalogue(self.table("basic_rule"), self.table("correlation_rule")))

    def incident_count(self, time_range: str | None = None, filters: Sequence = ()) -> DataFrame:
        rows = self._in_window("incident", time_range)
        return paging.total(compile_conditions(_conditions(filters), vocabulary("incident"), rows).filter(rows))

    def incident_stats(self, time_range: str | None = None, items: Sequence[str] = ("total", "severity", "status")) -> DataFrame:
        return stats.incident_stats(self._in_window("incident", time_range), items)

    def endpoint_vulnerabilities(self, epids: Sequence | None = None, detectby: str | None = None) -> DataFrame:
        records = entities.by_detector(self.table("vulnerability"), detectby)
        if epids is not None:
            records = records.where(F.col("epid").isin(list(epids)))
        return linkage.flat_vulnerabilities(records)

    def endpoint_stats(self, time_range: str = "7-day", filters: Sequence = ()) -> DataFrame:
        df = self.table("endpoint")
        window = self._window(time_range, df, "first_seen")
        return stats.endpoint_stats(compile_conditions(_conditions(filters), vocabulary("endpoint"), df).filter(df), window)

    def enduser_stats(self, time_range: str = "7-day", items: Sequence[str] = ("total-count", "new-count")) -> DataFrame:
        df = self.table("enduser")
        return stats.enduser_stats(df, self._window(time_range, df, "first_seen"), items)

    def indicator_enrichment(self, indicators: DataFrame | None = None, ordinal: str = "ordinal") -> DataFrame:
        wanted, _ = linkage.canonical_indicators(self.table("indicator") if indicators is None else indicators, ordinal)
        return linkage.enrich(wanted, self.table("enrichment"))

    def report_history(self, time_range: str | None = None, title: str | None = None) -> DataFrame:
        return entities.report_history(self._in_window("report", time_range), None, title)

    def _in_window(self, kind: str, time_range: str | None) -> DataFrame:
        df, moment = self.table(kind), entities.ENTITY_KEYS[kind][1]
        window = self._window(time_range, df, moment)
        return df if window is None else window.filter(df, moment)
