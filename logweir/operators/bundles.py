"""Composed analyses: named sections over a set of subjects.

A section that cannot be planned becomes a gap with its reason; the whole fails only
when its subject, or every section, does.  Sections are lazy and each is one plan for
all subjects.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions import predicates as P
from logweir.functions.coercion import as_float
from logweir.operators import linkage, paging, scoring, stats, timeline, views
from logweir.plans import fixed_values as fv
from logweir.plans import timewindow as tw
from logweir.plans.conditions import Condition, compile_conditions
from logweir.plans.errors import PlanError
from logweir.plans.vocabulary import Vocabulary
from logweir.sources.entities import report_history


#: How a frame that several sections read is held: written as a table, persisted, or (the default) planned again.
Keep = Callable[[DataFrame], DataFrame]


def _planned_again(df: DataFrame) -> DataFrame:
    return df


class SubjectMissing(RuntimeError):
    """The subject of an analysis, or all of its sections, could not be planned."""


@dataclass
class Bundle:
    sections: dict[str, DataFrame] = field(default_factory=dict)
    gaps: dict[str, str] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def add(self, name: str, plan: Callable[[], DataFrame]) -> Bundle:
        try:
            self.sections[name] = plan()
        except (PlanError, AnalysisException) as problem:
            self.gaps[name] = f"{type(problem).__name__}: {problem}"
        return self

    def gap(self, name: str, reason: str) -> Bundle:
        self.gaps[name] = reason
        return self

    def include(self, other: Bundle, prefix: str) -> Bundle:
        self.sections |= {f"{prefix}.{n}": df for n, df in other.sections.items()}
        self.gaps |= {f"{prefix}.{n}": why for n, why in other.gaps.items()}
        self.warnings += [f"{prefix}: {w}" for w in other.warnings]
        return self

    def done(self, subject: str | None = None) -> Bundle:
        if subject in self.gaps:
            raise SubjectMissing(self.gaps[subject])
        if not self.sections:
            raise SubjectMissing("; ".join(self.gaps.values()) or "nothing to plan")
        return self

    def counts(self) -> DataFrame:
        """Rows per section."""
        return stats.section_counts(self.sections)

    def __getitem__(self, name: str) -> DataFrame:
        return self.sections[name]


def incidents(
    incidents: DataFrame, alerts: DataFrame, attachments: DataFrame, window: tw.TimeWindow | None = None, keep: Keep = _planned_again
) -> Bundle:
    """Incidents of a window with the alerts that belong to them."""
    chosen = incidents if window is None else window.filter(incidents, "createtime")
    pairs = keep(linkage.correlate(chosen, alerts, attachments))
    return (
        Bundle()
        .add("incidents", lambda: linkage.incident_records(chosen, pairs))
        .add("correlated_alerts", lambda: pairs.join(alerts, "alertid"))
        .done("incidents")
    )


def reports(history: DataFrame, window: tw.TimeWindow | None = None, title: str | None = None) -> Bundle:
    return Bundle().add("reports", lambda: report_history(history, window, title)).done("reports")


def log_search(
    logs: DataFrame, vocab: Vocabulary, conditions: Sequence[Condition], limit: int | None = None, offset: int = 0
) -> Bundle:
    """Matching rows as they are, one page of them with a limit, and how many there are."""
    compiled = compile_conditions(conditions, vocab, logs)
    matching = compiled.filter(logs)
    page = paging.page(matching, limit, offset)
    out = Bundle(warnings=[*compiled.warnings, *page.warnings])
    return out.add("logs", lambda: page.df).add("total", lambda: paging.total(matching)).done("logs")


def asset_lookup(
    endpoints: DataFrame,
    findings: DataFrame | None,
    hostname: str | None = None,
    ip: str | None = None,
    epids: DataFrame | None = None,
    limit: int | None = None,
) -> Bundle:
    """Endpoints by name, address or id with their vulnerabilities."""
    matched = endpoints.where(P.endpoint_match(hostname, ip))
    if epids is not None:
        matched = matched.join(epids.select("epid").distinct(), "epid", "left_semi")
    first, total = paging.first_with_total(matched, [F.col("epid")], limit)
    out = Bundle().add("endpoints", lambda: first).add("matched_total", lambda: total)
    if findings is None:
        return out.gap("vulnerabilities", "no vulnerability table").done("endpoints")
    out.add("vulnerabilities", lambda: linkage.endpoint_vulnerabilities(matched, findings))
    return out.add("orphans", lambda: linkage.orphan_findings(findings)).done("endpoints")


def identity_lookup(users: DataFrame, name: str | None = None, euids: DataFrame | None = None, limit: int | None = None) -> Bundle:
    """End users by part of their name or by id."""
    matched = users if name is None else users.where(P.name_search("euname", name))
    if euids is not None:
        matched = matched.join(euids.select("euid").distinct(), "euid", "left_semi")
    first, total = paging.first_with_total(matched, [F.col("euid")], limit)
    return Bundle().add("users", lambda: first).add("matched_total", lambda: total).done("users")


def alert_rules(basic: DataFrame, correlation: DataFrame, name: str | None = None, limit: int | None = None) -> Bundle:
    """The rule catalogue, by part of a name, with counts of all that match."""
    catalogue = stats.rule_catalogue(basic, correlation)
    matched = catalogue if name is None else catalogue.where(P.name_search("name", name))
    first, total = paging.first_with_total(matched, [F.col("handler_class"), F.col("name"), F.col("id")], limit)
    return (
        Bundle()
        .add("handlers", lambda: first)
        .add("matched_total", lambda: total)
        .add("counts", lambda: stats.rule_counts(matched))
        .done("handlers")
    )


def threat_intel(
    indicators: DataFrame, stored: DataFrame, attacks: DataFrame | None = None, ordinal: str = "ordinal", threats: int | None = 10
) -> Bundle:
    """Reputation of indicators, per source where it is told, and the threat ranking."""
    wanted, skipped = linkage.canonical_indicators(indicators, ordinal)
    enriched = linkage.enrich(wanted, stored)
    details = stored.join(wanted.select(F.col("value").alias("lookup"), "type"), ["lookup", "type"], "left_semi")
    out = (
        Bundle()
        .add("indicators", lambda: enriched)
        .add("sources", lambda: scoring.reputation_sources(details.select("lookup", "type", "detail")))
        .add("skipped", lambda: skipped)
        .add("malicious", lambda: scoring.malicious_count(enriched))
    )
    if attacks is None:
        return out.gap("threat_landscape", "not asked for").done("indicators")
    return out.add("threat_landscape", lambda: views.view(attacks, "top-threats", limit=threats).df).done("indicators")


def identity_profile(
    users: DataFrame, endpoints: DataFrame, events: DataFrame, names: Sequence[str] | None = None, limit: int | None = None
) -> Bundle:
    """Users by exact name in any case, their endpoints and their activity, with
    ``limit`` the newest rows of each."""
    chosen = users if names is None else users.where(F.lower("euname").isin([n.lower() for n in names]))
    active = events.where(P.identity_activity()).withColumn("_user", F.lower("user"))
    keyed = chosen.select("euid", F.lower("euname").alias("_user")).where(F.col("_user") != "")
    recent = active.join(keyed.select("_user").distinct(), "_user", "left_semi")
    if limit is not None:
        recent = paging.first_per_group(recent, ["_user"], paging.newest_first(active), limit)
    return (
        Bundle()
        .add("users", lambda: chosen)
        .add("endpoints", lambda: linkage.user_endpoints(chosen, endpoints))
        .add("recent_activity", lambda: keyed.join(recent, "_user").drop("_user"))
        .done("users")
    )


def app_usage(
    traffic: DataFrame,
    webfilter: DataFrame,
    appctrl: DataFrame,
    dlp: DataFrame | None = None,
    limit: int = 10,
    dlp_limit: int | None = None,
) -> Bundle:
    """Top applications, web categories and cloud applications, and data-leak rows."""
    out = Bundle()
    for name, df in (("top-applications", traffic), ("top-websites", webfilter), ("top-cloud-applications", appctrl)):
        out.add(name, lambda df=df, name=name: views.view(df, name, limit=limit).df)
    if dlp is None:
        out.gap("dlp", "no such log type")
    else:
        out.add("dlp", lambda: paging.page(dlp, dlp_limit).df)
    return out.done()


def network_context(
    traffic: DataFrame, events: DataFrame, time_range: str, now: datetime, vpn_range: str | None = None, limit: int = 10
) -> Bundle:
    """Top sources, destinations, countries and tunnels.

    Tunnels show only over a long window, so theirs is widened unless it is named.
    Both windows end at the newest row of either table.
    """
    anchor = tw.shared_anchor([traffic, events], now)
    window = tw.anchored_window(time_range, anchor, now)
    rows = window.filter(traffic)
    vpn = tw.anchored_window(vpn_range or tw.floor_window(time_range), anchor, now)
    out = Bundle()
    for name in ("top-sources", "top-destinations", "top-countries"):
        out.add(name, lambda name=name: views.view(rows, name, "bandwidth", limit).df)
    return out.add(
        "site-to-site-ipsec", lambda: views.view(vpn.filter(events), "site-to-site-ipsec", limit=limit).df
    ).done()


def risk_assessment(
    entities: DataFrame, vulnerabilities: DataFrame | None, threats: DataFrame | None, failures: DataFrame | None, key: str = "epid"
) -> Bundle:
    """Composite risk of every entity of a set."""
    given = {"vulnerability": vulnerabilities, "threat": threats, "auth": failures}
    out = Bundle(warnings=[f"{n} dimension unavailable; its score is 0" for n, df in given.items() if df is None])
    return out.add("risk", lambda: scoring.risk(entities, vulnerabilities, threats, failures, key)).done("risk")


def triage_alerts(
    subjects: DataFrame,
    alerts: DataFrame,
    incidents: DataFrame,
    attachments: DataFrame,
    logs: DataFrame | None = None,
    window: tw.TimeWindow | None = None,
    per_alert: int | None = None,
) -> Bundle:
    """Alerts with priority, triggering logs, the incidents they belong to and the
    counts around them."""
    chosen = alerts.join(subjects.select("alertid").distinct(), "alertid", "left_semi")
    around = [
        df if window is None else window.filter(df, moment)
        for df, moment in ((alerts, "alerttime"), (incidents, "createtime"))
    ]
    named = linkage.link_key(chosen, fv.ALERT_INCIDENT_KEYS)

    def related() -> DataFrame:
        attached = attachments.where(F.col("attachtype") == "alertevent").select(
            F.col("attachsrcid").alias("alertid"), "incid"
        )
        if named is None:
            return attached.join(chosen.select("alertid"), "alertid", "left_semi").distinct().join(incidents, "incid")
        # An alert that names incidents is related to those; attachments decide for the rest.
        declared = chosen.select("alertid", F.explode_outer(linkage.id_set(chosen, [named])).alias("incid"))
        silent = declared.where(F.col("incid").isNull()).select("alertid")
        pairs = declared.where(F.col("incid").isNotNull()).unionByName(
            attached.join(silent, "alertid", "left_semi")
        )
        return pairs.distinct().join(incidents, "incid")

    out = Bundle().add("subject", lambda: scoring.triage(chosen, "alert")).add("related", related)
    if logs is None:
        out.gap("triggering_logs", "no log table")
    else:
        out.add("triggering_logs", lambda: linkage.alert_logs(chosen, logs, per_alert))
    return out.add("context_stats", lambda: stats.alert_incident_buckets(*around)).done("subject")


def triage_incidents(
    subjects: DataFrame,
    incidents: DataFrame,
    alerts: DataFrame,
    attachments: DataFrame,
    window: tw.TimeWindow | None = None,
    keep: Keep = _planned_again,
) -> Bundle:
    """Incidents with priority, their alerts and the counts around them."""
    chosen = incidents.join(subjects.select("incid").distinct(), "incid", "left_semi")
    around = [
        df if window is None else window.filter(df, moment)
        for df, moment in ((alerts, "alerttime"), (incidents, "createtime"))
    ]
    pairs = keep(linkage.correlate(chosen, alerts, attachments))
    return (
        Bundle()
        .add("subject", lambda: scoring.triage(chosen, "incident"))
        .add("related", lambda: pairs.join(alerts, "alertid"))
        .add("context_stats", lambda: stats.alert_incident_buckets(*around))
        .done("subject")
    )


def incident_summary(
    subjects: DataFrame,
    incidents: DataFrame,
    alerts: DataFrame,
    attachments: DataFrame,
    logs: DataFrame,
    attacks: DataFrame | None = None,
    per_alert: int | None = None,
    keep: Keep = _planned_again,
    threats: int | None = 10,
) -> Bundle:
    """Per incident: alerts, their logs, the threat ranking and one timeline."""
    chosen = incidents.join(subjects.select("incid").distinct(), "incid", "left_semi")
    pairs = keep(linkage.correlate(chosen, alerts, attachments))
    linked = pairs.join(alerts, "alertid")
    out = (
        Bundle()
        .add("incident", lambda: linkage.incident_records(chosen, pairs))
        .add("alerts", lambda: linked)
        .add("evidence_logs", lambda: linkage.alert_logs(pairs, logs, per_alert))
        .add(
            "timeline",
            lambda: timeline.ordered(
                timeline.unite(timeline.incident_events(chosen), timeline.alert_events(linked, "incid"))
            ),
        )
    )
    if attacks is None:
        return out.gap("threat_landscape", "not asked for").done("incident")
    return out.add("threat_landscape", lambda: views.view(attacks, "top-threats", limit=threats).df).done("incident")


@dataclass(frozen=True)
class Estate:
    """The tables an investigation draws on."""

    alerts: DataFrame
    incidents: DataFrame
    attachments: DataFrame
    endpoints: DataFrame
    users: DataFrame
    findings: DataFrame
    indicators: DataFrame
    stored: DataFrame
    logs: Mapping[str, DataFrame]


def linked_indicators(indicators: DataFrame, alerts: DataFrame, incidents: DataFrame, keep: Keep = _planned_again) -> DataFrame:
    """The indicators that name one of these alerts or incidents; PlanError if none can.

    With ``keep`` the ids of the owners are held first, so that a task which meets them with the indicators
    does not sort the rows they come from as well.
    """
    parts = [
        indicators.join(keep(owners.select(F.col(key).cast("string").alias(key)).distinct()), key, "left_semi")
        for key, owners in (("alertid", alerts), ("incid", incidents))
        if key in indicators.columns
    ]
    if not parts:
        raise PlanError("the indicators name neither alerts nor incidents")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).distinct()


def _ids_of(carriers: Sequence[DataFrame], single: str) -> DataFrame | None:
    """The distinct whole-number ids that rows carry, or None where no column could."""
    parts = [
        rows.select(F.explode(linkage.entity_ids(rows, [f"{single}s", single])).alias(single))
        for rows in carriers
        if {single, f"{single}s"} & set(rows.columns)
    ]
    return _united(parts)


def _values_of(carriers: Sequence[DataFrame], column: str) -> DataFrame | None:
    """The distinct texts in a column of any of the carriers, or None where none has it."""
    return _united([rows.select(column).where(F.coalesce(column, F.lit("")) != "") for rows in carriers if column in rows.columns])


def _united(parts: list[DataFrame]) -> DataFrame | None:
    if not parts:
        return None
    return (parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])).distinct()


def investigate(
    subjects: DataFrame,
    estate: Estate,
    trigger_logs: str = "traffic",
    kind: str = "alert",
    window: tw.TimeWindow | None = None,
    keep: Keep = _planned_again,
) -> Bundle:
    """Alerts or incidents from triage to reputation, endpoints and users, with a
    headline each.

    ``subjects`` has ``alertid`` or, with ``kind`` incident, ``incid``.  The incidents
    of an alert, or the incident itself, are summed up with their alerts, logs and
    timeline.  ``window`` bounds the logs and the counts around the subject, the same
    for all parts.
    """
    e, out = estate, Bundle()
    logs = {n: df if window is None else window.filter(df) for n, df in e.logs.items()}
    trigger, attacks = logs.get(trigger_logs), logs.get("attack")
    if kind == "alert":
        triage = triage_alerts(subjects, e.alerts, e.incidents, e.attachments, trigger, window)
        alerts, cases = triage["subject"], keep(triage["related"].select("incid").distinct())
        subject, key = alerts, "alertid"
    elif kind == "incident":
        triage = triage_incidents(subjects, e.incidents, e.alerts, e.attachments, window, keep)
        alerts, cases = triage["related"], subjects.select("incid").distinct()
        subject, key = triage["subject"], "incid"
    else:
        raise PlanError(f"an investigation starts from an alert or an incident, not from '{kind}'")
    out.include(triage, "triage")
    if trigger is None:
        summary = Bundle().gap("evidence_logs", "no log table")
    else:
        summary = incident_summary(cases, e.incidents, e.alerts, e.attachments, trigger, attacks, keep=keep)
    out.include(summary, "summary")
    try:
        linked = linked_indicators(e.indicators, alerts, cases, keep)
    except PlanError as problem:
        out.gap("threat_intel", str(problem))
    else:
        out.include(threat_intel(linked, e.stored), "threat_intel")
    carriers = [subject] if kind == "alert" else [subject, alerts]
    epids, euids = (_ids_of(carriers, c) for c in ("epid", "euid"))
    if epids is None:
        out.gap("assets", "the subject carries no endpoint ids")
    else:
        out.include(asset_lookup(e.endpoints, e.findings, epids=epids), "assets")
    if euids is None:
        out.gap("identities", f"the {kind}s carry no user ids")
    else:
        out.include(identity_lookup(e.users, euids=euids), "identities")
    ids = linkage.entity_ids(subject, ["epids", "epid"])
    told = scoring.headline(
        F.concat(F.lit(f"{kind} "), F.col(key), F.lit(": priority "), F.col("priority")),
        (F.when(F.size(ids) > 0, F.size(ids)), "{} linked endpoints"),
    )
    return out.add("headline", lambda: subject.select(key, told.alias("headline"))).done()


def hunt_indicators(indicators: DataFrame, logs: Mapping[str, DataFrame], stored: DataFrame | None = None) -> Bundle:
    """Indicators swept over all log types."""
    out = Bundle()
    matches = linkage.sweep(indicators, logs)
    totals = linkage.sweep_totals(matches)
    line = scoring.headline(
        F.concat(F.lit("indicator "), F.col("value")),
        (F.col("total_matches"), f"sweep: {{}} matches across {len(logs)} searches"),
    )
    out.add("matches", lambda: matches).add("totals", lambda: totals)
    out.add("headline", lambda: totals.select("value", line.alias("headline")))
    if stored is None:
        out.gap("threat_intel", "no reputation table")
    else:
        out.include(threat_intel(indicators, stored), "threat_intel")
    return out.done("matches")


def hunt_condition(logs: Mapping[str, DataFrame], condition: Column | None = None, ttp: str | None = None, limit: int | None = None) -> Bundle:
    """A condition or technique swept over log types: rows, with ``limit`` the newest, and totals."""
    out, totals = Bundle(), {}
    for name, df in logs.items():
        pivot = P.indicator_pivot(df, condition=condition, ttp=ttp)
        if pivot is None:
            raise PlanError("a hunt needs an indicator, a condition or a technique")
        out.add(name, lambda df=df, pivot=pivot: paging.page(df.where(pivot), limit).df)
        totals[name] = df.where(pivot)
    return out.add("totals", lambda: stats.section_counts(totals)).done()


def hunt_entities(
    alerts: DataFrame,
    endpoints: DataFrame | None = None,
    users: DataFrame | None = None,
    window: tw.TimeWindow | None = None,
    threshold: float = fv.ANOMALY_PERCENTILE,
) -> Bundle:
    """Anomaly verdicts for whole estates of endpoints or users."""
    rows = alerts if window is None else window.filter(alerts, "alerttime")
    out = Bundle()
    if endpoints is not None:
        out.add("endpoints", lambda: _endpoint_verdicts(endpoints, rows, threshold))
        if window is not None:
            out.add("endpoint_stats", lambda: stats.endpoint_stats(endpoints, window))
    if users is not None:
        out.add("users", lambda: _user_verdicts(users, rows))
        if window is not None:
            out.add("user_stats", lambda: stats.enduser_stats(users, window))
    return out.done()


def _endpoint_verdicts(endpoints: DataFrame, alerts: DataFrame, threshold: float) -> DataFrame:
    dtype = endpoints.schema["risk_score"].dataType
    scored = endpoints.withColumn("score", as_float(F.col("risk_score"), dtype))
    # Percentiles are over the whole estate, whatever window the alerts come from.
    ranked = scored.join(scoring.percentile_ranks(scored, "score"), "score", "left")
    serious = stats.vulnerability_counters(endpoints).groupBy("epid").agg(
        *(F.sum(F.when(F.col("severity") == s, F.col("hits"))).alias(s) for s in ("critical", "high"))
    )
    found = linkage.behavioural_alerts(linkage.entity_pivots(endpoints), alerts)
    found = found.select(F.col("entity_ref").alias("_ref"), "detections")
    joined = ranked.join(serious, "epid", "left").join(found, F.col("epid").cast("string") == F.col("_ref"), "left")
    judged = scoring.endpoint_anomaly(
        joined.withColumn("detections", F.coalesce("detections", F.lit(0))), threshold
    )
    return judged.drop("_ref", "score")


def _user_verdicts(users: DataFrame, alerts: DataFrame) -> DataFrame:
    found = linkage.behavioural_alerts(linkage.entity_pivots(users=users), alerts)
    found = found.select(F.col("entity_ref").alias("_ref"), "detections")
    joined = users.join(found, F.col("euid").cast("string") == F.col("_ref"), "left").drop("_ref")
    return scoring.enduser_anomaly(joined.withColumn("detections", F.coalesce("detections", F.lit(0))))


def entity_of(text: str) -> tuple[str, int | str]:
    """``epid:N``, ``euid:N`` or a bare address as (kind, id)."""
    wanted = text.strip()
    kind, _, rest = wanted.partition(":")
    if kind.lower() in ("epid", "euid"):
        if not rest.strip().isdigit():
            raise PlanError(f"'{kind}:' takes a number")
        return kind.lower(), int(rest)
    if " " not in wanted and ("." in wanted or ":" in wanted):
        return "ip", wanted
    raise PlanError("an entity is 'epid:N', 'euid:N' or an address")


def investigate_deep(
    subjects: DataFrame | str,
    estate: Estate,
    time_range: str = "7-day",
    now: datetime | None = None,
    trigger_logs: str = "traffic",
    per_entity: int | None = None,
    kind: str = "alert",
    widest: str | None = None,
    keep: Keep = _planned_again,
) -> Bundle:
    """An investigation, the chain back to the earliest signal, and what the entities
    it touches did elsewhere.

    ``subjects`` are alerts or incidents, or the text of one entity (see ``entity_of``),
    which is only followed forward.  One window, that of ``time_range`` on the newest
    row of all log types, holds for every part; ``widest`` narrows wider presets.
    """
    e, out = estate, Bundle()
    if widest is not None:
        time_range, narrowed = tw.cap_window(time_range, widest)
        if narrowed:
            out.warnings.append(f"the window was narrowed to '{time_range}'")
    moment = now or datetime.now()
    window = tw.anchored_window(time_range, tw.shared_anchor(list(e.logs.values()), moment), moment)
    logs = {n: window.filter(df) for n, df in e.logs.items()}
    if isinstance(subjects, str):
        pivots, line = _entity_pivots(subjects, e)
        return _impact(out, pivots, logs, per_entity).add("headline", lambda: line).done()

    base = investigate(subjects, e, trigger_logs, kind, window, keep)
    out.include(base, "base")
    judged, related = base["triage.subject"], base["triage.related"]
    if kind == "alert":
        streams = [timeline.alert_events(judged)]
        streams.append(timeline.incident_events(related.select("alertid", *[c for c in e.incidents.columns if c != "alertid"]), "alertid", chain=True))
        alerts = judged
        if "triage.triggering_logs" in base.sections:
            streams.append(timeline.log_events(base["triage.triggering_logs"], "alertid"))
    else:
        alerts = related
        streams = [timeline.incident_events(judged, chain=True), timeline.alert_events(related, "incid")]
        if "summary.evidence_logs" in base.sections:
            evidence = related.select("incid", "alertid").join(base["summary.evidence_logs"], "alertid")
            streams.append(timeline.log_events(evidence, "incid"))
    chain = timeline.unite(*streams)
    first = timeline.earliest(chain)
    out.add("root_cause.chain", lambda: timeline.ordered(chain)).add("root_cause.earliest", lambda: first)

    carriers = [judged] if kind == "alert" else [judged, alerts]
    epids, euids = (_ids_of(carriers, c) for c in ("epid", "euid"))
    touched = None if epids is None else e.endpoints.join(epids, "epid", "left_semi")
    users = None if euids is None else e.users.join(euids, "euid", "left_semi")
    names, ips = (_values_of(carriers, c) for c in ("euname", "epip"))
    if names is not None:
        # Alerts that name their user, whether or not others carry an id.
        named = names.select(F.lower("euname").alias("_user")).distinct()
        called = e.users.withColumn("_user", F.lower("euname")).join(named, "_user", "left_semi").drop("_user")
        users = called if users is None else users.unionByName(called.join(euids, "euid", "left_anti"))
    ips = None if ips is None else ips.withColumnRenamed("epip", "ip")
    if touched is None and users is None and ips is None:
        out.gap("impact", "the subject names no endpoint, user or address")
    else:
        _impact(out, linkage.entity_pivots(touched, users, ips), logs, per_entity)
    line = scoring.headline(
        F.concat(F.lit(f"{kind} "), F.col("case_id")),
        (F.col("event_count"), "root cause: {} events"),
        (F.concat_ws(" ", "source", "reference"), "earliest {}"),
    )
    return out.add("headline", lambda: first.select("case_id", line.alias("headline"))).done()


def _entity_pivots(text: str, estate: Estate) -> tuple[DataFrame, DataFrame]:
    """What one entity is searched by, and its headline."""
    kind, ref = entity_of(text)
    if kind == "epid":
        pivots = linkage.entity_pivots(endpoints=estate.endpoints.where(F.col("epid") == ref))
    elif kind == "euid":
        pivots = linkage.entity_pivots(users=estate.users.where(F.col("euid") == ref))
    else:
        spark = estate.endpoints.sparkSession
        pivots = linkage.entity_pivots(ips=spark.createDataFrame([(ref,)], "ip string"))
    line = F.concat(F.col("entity_type"), F.lit(" "), F.col("entity_ref"), F.lit(": forward only"))
    return pivots, pivots.select("entity_ref", line.alias("headline"))


def _impact(out: Bundle, pivots: DataFrame, logs: Mapping[str, DataFrame], per_entity: int | None) -> Bundle:
    """What entities did in each log type: counts, rows by address and by user, and gaps."""
    out.add("impact.counts", lambda: linkage.lateral_counts(pivots, logs))
    for name, df in logs.items():
        out.add(f"impact.{name}", lambda df=df: linkage.lateral_rows(pivots, df, per_entity))
        if "user" in df.columns:
            out.add(f"impact.{name}.users", lambda df=df: linkage.lateral_rows(pivots, df, per_entity, "user", "user"))
    return out.add("impact.gaps", lambda: linkage.pivot_gaps(pivots))
