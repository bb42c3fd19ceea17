"""Queries that score, rank and order: percentiles, risk, anomalies, timelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweir.catalog.links import _ENRICHED, SNAPSHOT
from logweir.catalog.registry import query
from logweir.catalog.views import nested_endpoints
from logweir.functions.coercion import as_float
from logweir.operators import linkage, scoring, stats, timeline

_RANKS = (
    "SELECT cast(risk_score AS DOUBLE) AS score, count(*) OVER () AS population, "
    "round_even(100.0::DOUBLE * (cume_dist() OVER (ORDER BY cast(risk_score AS DOUBLE))) , 1) AS percentile, epid FROM endpoint"
)


def _scored(t):
    return t.endpoint.withColumn("score", as_float(F.col("risk_score")))


def _ranked(t):
    df = _scored(t)
    return df.join(scoring.percentile_ranks(df, "score"), "score", "left")


@query("i1_percentile", f"SELECT epid, score, population, percentile FROM ({_RANKS})", "endpoint")
def _(t):
    return _ranked(t).select("epid", "score", "population", "percentile")


@query(
    "i3_earliest",
    "SELECT epid, min(alerttime) AS first_alert, arg_min(alertid, (alerttime, alertid)) AS alertid FROM alert GROUP BY 1",
    "alert",
)
def _(t):
    first = F.min(F.struct("alerttime", "alertid")).alias("f")
    return t.alert.groupBy("epid").agg(first).select("epid", F.col("f.alerttime").alias("first_alert"), "f.alertid")


_RISK = """WITH v AS (SELECT epid, least(100, 25 * count(*) FILTER (lower(severity) = 'critical') + 10 * count(*) FILTER (lower(severity) = 'high')
      + 3 * count(*) FILTER (lower(severity) = 'medium') + count(*) FILTER (lower(severity) = 'low')) AS s FROM vulnerability WHERE epid IS NOT NULL GROUP BY 1),
    h AS (SELECT user_id AS epid, least(100, 25 * count(*) FILTER (severity = 'critical') + 10 * count(*) FILTER (severity = 'high')
      + 3 * count(*) FILTER (severity = 'medium')) AS s FROM attack GROUP BY 1),
    f AS (SELECT user_id AS epid, least(100, 5 * count(*)) AS s FROM event WHERE action = 'failure' GROUP BY 1),
    r AS (SELECT e.epid, cast(coalesce(v.s, 0) AS BIGINT) AS vulnerability_score, cast(coalesce(h.s, 0) AS BIGINT) AS threat_score,
      cast(coalesce(f.s, 0) AS BIGINT) AS auth_score FROM endpoint e LEFT JOIN v USING (epid) LEFT JOIN h USING (epid) LEFT JOIN f USING (epid)),
    scored AS (SELECT *, cast(round_even(cast(40 * vulnerability_score + 35 * threat_score + 25 * auth_score AS DOUBLE) / 100, 0) AS INTEGER) AS composite FROM r),
    risk AS (SELECT *, CASE WHEN composite >= 75 THEN 'critical' WHEN composite >= 50 THEN 'high' WHEN composite >= 25 THEN 'medium' ELSE 'low' END AS risk_band,
      '' AS unavailable FROM scored)"""


def _risk(t):
    threats = t.attack.withColumn("epid", F.col("user_id"))
    failures = t.event.where(F.col("action") == "failure").withColumn("epid", F.col("user_id"))
    return scoring.risk(t.endpoint.select("epid"), t.vulnerability, threats, failures)


@query("j1_risk", f"{_RISK} SELECT * FROM risk", "vulnerability", "attack", "event", "endpoint")
def _(t):
    return _risk(t)


@query(
    "j1_risk_partial",
    "SELECT epid, cast(0 AS BIGINT) AS vulnerability_score, cast(0 AS BIGINT) AS threat_score, cast(least(100, 5 * n) AS BIGINT) AS auth_score, "
    "cast(round_even(cast(25 * least(100, 5 * n) AS DOUBLE) / 100, 0) AS INTEGER) AS composite, CASE WHEN round_even(cast(25 * least(100, 5 * n) AS DOUBLE) / 100, 0) >= 25 THEN 'medium' ELSE 'low' END "
    "AS risk_band, 'vulnerability,threat' AS unavailable FROM (SELECT epid, (SELECT count(*) FROM event WHERE action = 'failure' "
    "AND user_id = epid) AS n FROM endpoint)",
    "event",
    "endpoint",
)
def _(t):
    failures = t.event.where(F.col("action") == "failure").withColumn("epid", F.col("user_id"))
    return scoring.risk(t.endpoint.select("epid"), None, None, failures)


_DETECTED = "(SELECT epip, count(*) AS n FROM alert WHERE contains(lower(alerttype), 'botnet') GROUP BY 1)"


def _endpoint_signals(t):
    counters = stats.vulnerability_counters(nested_endpoints(t.endpoint)).where(
        F.col("severity").isin("critical", "high")
    )
    wide = counters.groupBy("epid").agg(
        *(F.sum(F.when(F.col("severity") == s, F.col("hits"))).alias(s) for s in ("critical", "high"))
    )
    pivots = linkage.entity_pivots(t.endpoint)
    found = linkage.behavioural_alerts(pivots, t.alert).select(F.col("entity_ref").cast("bigint").alias("epid"), "detections")
    joined = _ranked(t).join(wide, "epid", "left").join(found, "epid", "left")
    return joined.withColumn("detections", F.coalesce("detections", F.lit(0)))


@query(
    "j2_endpoint_anomaly",
    f"""WITH ranked AS ({_RANKS}), s AS (SELECT r.epid, r.population, r.percentile, cast(e.cnt_cri AS BIGINT) AS c, cast(e.cnt_hig AS BIGINT) AS h,
      coalesce(d.n, 0) AS d FROM ranked r JOIN endpoint e USING (epid) LEFT JOIN {_DETECTED} d USING (epip))
    SELECT epid, percentile >= 90 OR c > 0 OR h > 0 OR d > 0 AS anomalous,
      concat('risk_score at ', percentile, 'th percentile of ', population, ' scored endpoints (threshold 90.0) -> ',
        CASE WHEN percentile >= 90 THEN 'ANOMALOUS' ELSE 'normal' END, ' | ',
        CASE WHEN c > 0 OR h > 0 THEN concat('carries serious vulnerabilities (', concat_ws(', ', CASE WHEN c > 0 THEN concat(c, ' critical') END,
          CASE WHEN h > 0 THEN concat(h, ' high') END), ') -> ANOMALOUS') ELSE 'no critical/high vuln-stats' END, ' | ',
        CASE WHEN d > 0 THEN concat(d, ' behavioural/IOC detection(s) in the window -> ANOMALOUS') ELSE 'no behavioural/IOC detections in the window' END) AS basis
    FROM s""",
    "endpoint",
    "alert",
)
def _(t):
    judged = scoring.endpoint_anomaly(_endpoint_signals(t))
    return judged.select("epid", "anomalous", F.concat_ws(" | ", "basis").alias("basis"))


@query(
    "j3_user_anomaly",
    """SELECT u.euid, coalesce(u.importance = 'high', false) OR coalesce(d.n, 0) > 0 AS anomalous,
      concat(CASE WHEN u.importance IS NULL THEN 'end-user carries no ''importance''' WHEN u.importance = 'high' THEN 'importance is ''high'' -> ANOMALOUS'
        ELSE concat('importance is ''', u.importance, '''') END, ' | ', CASE WHEN coalesce(d.n, 0) > 0
        THEN concat(d.n, ' behavioural/IOC detection(s) in the window -> ANOMALOUS') ELSE 'no behavioural/IOC detections in the window' END) AS basis
    FROM enduser u LEFT JOIN (SELECT euname, count(*) AS n FROM alert WHERE contains(lower(alerttype), 'botnet') GROUP BY 1) d USING (euname)""",
    "enduser",
    "alert",
)
def _(t):
    found = linkage.behavioural_alerts(linkage.entity_pivots(users=t.enduser), t.alert)
    found = found.select(F.col("entity_ref").cast("bigint").alias("euid"), "detections")
    joined = t.enduser.join(found, "euid", "left").withColumn("detections", F.coalesce("detections", F.lit(0)))
    judged = scoring.enduser_anomaly(joined)
    return judged.select("euid", "anomalous", F.concat_ws(" | ", "basis").alias("basis"))


_PRIORITY = "CASE severity WHEN 'critical' THEN 'urgent' WHEN 'info' THEN 'informational' ELSE severity END"


@query(
    "j4_triage",
    f"SELECT alertid, {_PRIORITY} AS priority, concat('alert severity is ''', severity, ''' -> priority ''', {_PRIORITY}, ''' | alert acknowledged: ', "
    "CASE WHEN acknowledged THEN 'True' ELSE 'False' END, ' | alert status: ''', status, '''') AS basis FROM alert",
    "alert",
)
def _(t):
    judged = scoring.triage(t.alert, "alert")
    return judged.select("alertid", "priority", F.concat_ws(" | ", "basis").alias("basis"))


@query(
    "j5_headline",
    f"SELECT alertid, concat('alert ', alertid, ': priority ', {_PRIORITY}, CASE WHEN incids IS NULL THEN '' ELSE concat('; incident ', incids) END) AS headline FROM alert",
    "alert",
)
def _(t):
    judged = scoring.triage(t.alert, "alert")
    subject = F.concat(F.lit("alert "), F.col("alertid"), F.lit(": priority "), F.col("priority"))
    return judged.select("alertid", scoring.headline(subject, (F.col("incids"), "incident {}")).alias("headline"))


@query(
    "j6_reputation",
    "SELECT lookup, CASE WHEN ordinal % 2 = 0 THEN 'VT' ELSE 'unknown' END AS source, CASE WHEN ordinal % 2 = 0 THEN "
    "concat(ordinal % 7 + 1, '/', ordinal % 7 + 61, ' engines flagged') ELSE concat('c', ordinal % 4) END AS verdict, "
    "CASE WHEN ordinal % 2 = 1 THEN 'high' END AS confidence, CASE WHEN ordinal % 2 = 1 THEN 'm' END AS malware, "
    "CASE WHEN ordinal % 2 = 0 THEN 'https://www.virustotal.com/x' END AS link FROM enrichment",
    "enrichment",
)
def _(t):
    return scoring.reputation_sources(t.enrichment.select("lookup", "detail"))


@query(
    "j7_malicious_count",
    f"{_ENRICHED} SELECT count(*) AS indicators, count(*) FILTER (lower(reputation) = 'malicious') AS malicious FROM enriched",
    "indicator",
    "enrichment",
)
def _(t):
    wanted, _skipped = linkage.canonical_indicators(t.indicator, "ordinal")
    return scoring.malicious_count(linkage.enrich(wanted, t.enrichment))


# --- timelines ---------------------------------------------------------------


def _attached_events(t):
    attached = linkage.attached_alerts(t.attachment, SNAPSHOT).select(
        "incid", "alertid", F.col("alert.timestamp").alias("timestamp")
    )
    return timeline.alert_events(attached, "incid")


_EVENTS = """WITH chain AS (
    SELECT incid AS case_id, strftime(createtime, '%Y-%m-%d %H:%M:%S') AS timestamp, 'incident' AS source, incid AS reference,
      concat('incident ', incid, ': ', name) AS description, epoch(createtime) AS time_epoch FROM incident
    UNION ALL SELECT incid, json_extract_string(data, '$.timestamp'), 'alert', attachsrcid, concat('alert ', attachsrcid, ': raised'),
      cast(json_extract_string(data, '$.timestamp') AS DOUBLE) FROM attachment WHERE attachtype = 'alertevent'
      AND data NOT LIKE '{broken%' AND json_extract_string(data, '$.timestamp') IS NOT NULL)"""


@query(
    "k1_timeline",
    f"{_EVENTS} SELECT case_id, timestamp, source, reference, description, time_epoch FROM chain",
    "incident",
    "attachment",
)
def _(t):
    stream = timeline.unite(timeline.incident_events(t.incident), _attached_events(t))
    return timeline.ordered(stream).select("case_id", "timestamp", "source", "reference", "description", "time_epoch")


@query(
    "k2_root_cause",
    """WITH chain AS (SELECT alertid AS case_id, strftime(alerttime, '%Y-%m-%d %H:%M:%S') AS timestamp, 'alert' AS source, alertid AS reference,
        concat('alert ', alertid, ': ', name) AS description, epoch(alerttime) AS moment FROM alert
      UNION ALL SELECT a.attachsrcid, strftime(i.createtime, '%Y-%m-%d %H:%M:%S'), 'incident', i.incid, concat('incident ', i.incid, ': ', i.name), epoch(i.createtime)
        FROM attachment a JOIN incident i USING (incid) WHERE a.attachtype = 'alertevent'
      UNION ALL SELECT alertid, strftime(itime, '%Y-%m-%d %H:%M:%S'), 'log', logid, concat('log ', logid, ': event'), epoch(itime) FROM traffic)
    SELECT case_id, arg_min(timestamp, (moment, source, reference, timestamp, description)) AS timestamp, arg_min(source, (moment, source, reference, timestamp, description)) AS source,
      arg_min(reference, (moment, source, reference, timestamp, description)) AS reference, arg_min(description, (moment, source, reference, timestamp, description)) AS description,
      count(*) AS event_count FROM chain GROUP BY 1""",
    "alert",
    "incident",
    "attachment",
    "traffic",
)
def _(t):
    related = (
        t.attachment.where(F.col("attachtype") == "alertevent")
        .select("incid", F.col("attachsrcid").alias("subject"))
        .join(t.incident, "incid")
    )
    logs = t.traffic.select("alertid", "logid", "itime")
    stream = timeline.unite(
        timeline.alert_events(t.alert), timeline.incident_events(related, "subject", chain=True), timeline.log_events(logs, "alertid")
    )
    return timeline.earliest(stream)
