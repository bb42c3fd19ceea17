"""Queries that correlate alerts, incidents, logs, endpoints, users, indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweir.catalog.registry import query
from logweir.catalog.views import nested_endpoints, nested_vulnerabilities
from logweir.operators import linkage, paging
from logweir.plans import fixed_values as fv
from logweir.sources import logs

SNAPSHOT = "alertid string, severity string, timestamp string"
_SWEPT = ("traffic", "attack", "appctrl", "dns")


def _swept(t):
    return {"traffic": t.traffic, "attack": t.attack, "app-ctrl": t.appctrl, "dns": t.dns}


# Attached pairs, then linkage pairs for incidents without any, as one SQL text.
_PAIRS = """WITH attached AS (SELECT DISTINCT incid, attachsrcid AS alertid FROM attachment
    WHERE attachtype = 'alertevent' AND incid IN (SELECT incid FROM incident)),
  bare AS (SELECT * FROM incident WHERE incid NOT IN (SELECT incid FROM attached)),
  linked AS (SELECT incid, trim(unnest(string_split(alertids, ','))) AS alertid, 0 AS place FROM bare
    UNION ALL SELECT b.incid, a.alertid, 1 FROM bare b JOIN alert a ON a.incids = b.incid),
  pairs AS (SELECT incid, alertid, 'incident.attachments.alertevent' AS basis FROM attached UNION ALL
    SELECT incid, alertid, CASE WHEN min(place) = 0 THEN 'incident.alertids' ELSE 'alert.incids' END FROM linked
    WHERE alertid IN (SELECT alertid FROM alert) GROUP BY 1, 2)"""
_PAIR_VIEWS = ("incident", "alert", "attachment")


@query(
    "h1_id_set",
    "SELECT incid, trim(unnest(string_split(alertids, ','))) AS alertid FROM incident WHERE alertids IS NOT NULL",
    "incident",
)
def _(t):
    df = t.incident
    return df.select("incid", F.explode(linkage.id_set(df, fv.INCIDENT_ALERT_KEYS)).alias("alertid"))


@query(
    "h2_attachments",
    "SELECT incid, attachsrcid AS alertid, CASE WHEN data LIKE '{broken%' THEN NULL ELSE json_extract_string(data, '$.severity') END "
    "AS severity, CASE WHEN data LIKE '{broken%' THEN NULL ELSE json_extract_string(data, '$.timestamp') END AS timestamp "
    "FROM attachment WHERE attachtype = 'alertevent'",
    "attachment",
)
def _(t):
    return linkage.attached_alerts(t.attachment, SNAPSHOT).select("incid", "alertid", "alert.severity", "alert.timestamp")


@query("h3_linkage_fallback", f"{_PAIRS} SELECT * FROM pairs", *_PAIR_VIEWS)
def _(t):
    return linkage.correlate(t.incident, t.alert, t.attachment)


@query(
    "h4_incident_records",
    f"{_PAIRS} SELECT i.incid, i.status, count(p.alertid) AS alert_count, max(p.basis) AS correlation_basis "
    "FROM incident i LEFT JOIN pairs p USING (incid) GROUP BY 1, 2",
    *_PAIR_VIEWS,
)
def _(t):
    pairs = linkage.correlate(t.incident, t.alert, t.attachment)
    return linkage.incident_records(t.incident.select("incid", "status"), pairs)


@query(
    "h5_alert_logs",
    "SELECT alertid, position, itime, sessionid, srcip, dstip, sentbyte FROM (SELECT *, cast(row_number() OVER (PARTITION BY alertid "
    "ORDER BY itime DESC, sessionid, srcip, dstip, sentbyte) AS INTEGER) AS position FROM traffic) WHERE position <= 2 AND alertid IN "
    "(SELECT alertid FROM alert WHERE severity = 'critical')",
    "traffic",
    "alert",
)
def _(t):
    logs = t.traffic.select("alertid", "itime", "sessionid", "srcip", "dstip", "sentbyte")
    return linkage.alert_logs(t.alert.where(F.col("severity") == "critical"), logs, per_alert=2)


_FLAT = "(SELECT epid, coalesce(lower(severity), 'unknown') AS severity FROM vulnerability)"


@query(
    "h6_endpoint_vulns",
    f"SELECT cast(e.epid AS VARCHAR) AS epid, v.severity, count(v.severity) AS hits FROM endpoint e LEFT JOIN {_FLAT} v "
    "ON v.epid = e.epid GROUP BY 1, 2",
    "endpoint",
    "vulnerability",
)
def _(t):
    flat = linkage.flat_vulnerabilities(nested_vulnerabilities(t.vulnerability))
    return linkage.endpoint_vulnerabilities(t.endpoint, flat)


@query(
    "h6_orphans",
    "SELECT vulnid, severity, detectby FROM vulnerability WHERE epid IS NULL",
    "vulnerability",
)
def _(t):
    flat = linkage.flat_vulnerabilities(nested_vulnerabilities(t.vulnerability))
    return linkage.orphan_findings(flat).select("vulnid", "severity", "detectby")


@query(
    "h7_user_endpoints",
    "SELECT DISTINCT u.euid, e.epid FROM enduser u JOIN endpoint e ON e.euid = u.euid OR lower(e.euname) = lower(u.euname)",
    "enduser",
    "endpoint",
)
def _(t):
    return linkage.user_endpoints(t.enduser, nested_endpoints(t.endpoint))


_SWEEP = """WITH wanted AS (SELECT DISTINCT value, type FROM indicator), seen AS (
    SELECT 'traffic' AS logtype, 'IP' AS type, srcip AS v, count(*) AS n FROM traffic GROUP BY ALL
    UNION ALL SELECT 'attack', 'IP', srcip, count(*) FROM attack GROUP BY ALL
    UNION ALL SELECT 'app-ctrl', 'IP', srcip, count(*) FROM appctrl GROUP BY ALL
    UNION ALL SELECT 'dns', 'IP', srcip, count(*) FROM dns GROUP BY ALL
    UNION ALL SELECT 'attack', 'Domain', hostname, count(*) FROM attack GROUP BY ALL
    UNION ALL SELECT 'app-ctrl', 'Domain', hostname, count(*) FROM appctrl GROUP BY ALL
    UNION ALL SELECT 'dns', 'Domain', hostname, count(*) FROM dns GROUP BY ALL
    UNION ALL SELECT 'attack', 'Hash', checksum, count(*) FROM attack GROUP BY ALL),
  matches AS (SELECT w.value, w.type, s.logtype, cast(sum(s.n) AS BIGINT) AS hits FROM wanted w JOIN seen s ON s.type = w.type
    AND CASE WHEN w.type = 'Hash' THEN contains(s.v, w.value) ELSE lower(s.v) = lower(w.value) END GROUP BY ALL)"""


@query("h8_indicator_sweep", f"{_SWEEP} SELECT * FROM matches", "indicator", *_SWEPT)
def _(t):
    return linkage.sweep(t.indicator, _swept(t))


_FEW = "(SELECT value, type FROM indicator QUALIFY row_number() OVER (PARTITION BY type ORDER BY value) <= 4)"


@query("h8_sweep_layout", _SWEEP.replace("SELECT DISTINCT value, type FROM indicator", f"SELECT DISTINCT value, type FROM {_FEW}") + " SELECT * FROM matches", "indicator", *_SWEPT)
def _(t):
    # Logs written by address within a day, then swept for the first few indicators of each type.
    folder, pivots = t.folder(), ["srcip", "hostname"]
    for name, df in _swept(t).items():
        logs.write_logs(df.withColumn("logtype", F.lit(name)), f"{folder}/{name}", cluster="srcip", pivots=pivots)
    few = linkage.first_per_group(t.indicator, ["type"], [F.col("value")], 4)
    return linkage.sweep(few, {n: logs.read_logs(t.spark, f"{folder}/{n}", n, keys=True) for n in _swept(t)})


@query(
    "h8_sweep_totals",
    f"{_SWEEP} SELECT value, type, cast(sum(hits) AS BIGINT) AS total_matches FROM matches GROUP BY ALL",
    "indicator",
    *_SWEPT,
)
def _(t):
    return linkage.sweep_totals(linkage.sweep(t.indicator, _swept(t)))


@query(
    "h9_lateral",
    """WITH pivots AS (SELECT 'endpoint' AS entity_type, cast(epid AS VARCHAR) AS entity_ref, 'srcip' AS field, epip AS value FROM endpoint
      UNION ALL SELECT 'enduser', cast(euid AS VARCHAR), 'user', euname FROM enduser),
    seen AS (SELECT 'traffic' AS logtype, 'srcip' AS field, srcip AS v FROM traffic UNION ALL SELECT 'traffic', 'user', "user" FROM traffic
      UNION ALL SELECT 'attack', 'srcip', srcip FROM attack UNION ALL SELECT 'attack', 'user', "user" FROM attack
      UNION ALL SELECT 'event', 'srcip', srcip FROM event UNION ALL SELECT 'event', 'user', "user" FROM event)
    SELECT entity_type, entity_ref, logtype, count(*) AS hits FROM pivots p JOIN seen s ON p.field = s.field AND p.value = s.v GROUP BY ALL""",
    "endpoint",
    "enduser",
    "traffic",
    "attack",
    "event",
)
def _(t):
    pivots = linkage.entity_pivots(t.endpoint, t.enduser)
    return linkage.lateral_counts(pivots, {"traffic": t.traffic, "attack": t.attack, "event": t.event})


@query(
    "h9_lateral_rows",
    "SELECT 'endpoint' AS entity_type, cast(epid AS VARCHAR) AS entity_ref, itime, srcip, sessionid, dstip, sentbyte, position FROM endpoint JOIN "
    "(SELECT itime, srcip, sessionid, dstip, sentbyte, cast(row_number() OVER (PARTITION BY srcip ORDER BY itime DESC, srcip, sessionid, dstip, sentbyte) "
    "AS INTEGER) AS position FROM traffic) ON srcip = epip WHERE position <= 3",
    "endpoint",
    "traffic",
)
def _(t):
    logs = t.traffic.select("itime", "srcip", "sessionid", "dstip", "sentbyte")
    return linkage.lateral_rows(linkage.entity_pivots(t.endpoint), logs, 3)


@query(
    "h9_pivot_gaps",
    "SELECT 'enduser' AS entity_type, cast(epid AS VARCHAR) AS entity_ref FROM endpoint WHERE euname = ''",
    "endpoint",
)
def _(t):
    users = t.endpoint.select(F.col("epid").alias("euid"), "euname")
    return linkage.pivot_gaps(linkage.entity_pivots(users=users))


_ENRICHED = """WITH best AS (SELECT lookup, type, reputation, confidence, status, value AS stored_value FROM enrichment
    QUALIFY row_number() OVER (PARTITION BY lookup, type ORDER BY value <> lookup, ordinal) = 1),
  wanted AS (SELECT value, CASE lower(type) WHEN 'ip' THEN 'IP' WHEN 'url' THEN 'URL' WHEN 'domain' THEN 'Domain' END AS kind, min(ordinal) AS ordinal
    FROM indicator GROUP BY ALL HAVING kind IS NOT NULL),
  enriched AS (SELECT w.value, w.kind AS type, w.ordinal, b.reputation, b.confidence, b.status, b.stored_value FROM wanted w
    LEFT JOIN best b ON b.lookup = w.value AND b.type = w.kind)"""


@query("h10_enrichment", f"{_ENRICHED} SELECT * FROM enriched", "indicator", "enrichment")
def _(t):
    wanted, _skipped = linkage.canonical_indicators(t.indicator, "ordinal")
    return linkage.enrich(wanted, t.enrichment)


@query(
    "h10_skipped",
    "SELECT value, type FROM indicator WHERE lower(type) NOT IN ('ip', 'url', 'domain')",
    "indicator",
)
def _(t):
    return linkage.canonical_indicators(t.indicator, "ordinal")[1].select("value", "type")


@query(
    "h11_reverse_membership",
    "SELECT incid, status FROM incident WHERE incid IN (SELECT incid FROM attachment WHERE attachtype = 'alertevent' AND attachsrcid IN "
    "(SELECT alertid FROM alert WHERE severity = 'high'))",
    "incident",
    "attachment",
    "alert",
)
def _(t):
    high = t.alert.where(F.col("severity") == "high")
    return linkage.incidents_of_alerts(high, t.attachment, t.incident).select("incid", "status")


@query(
    "h12_behavioural_join",
    "SELECT 'endpoint' AS entity_type, cast(e.epid AS VARCHAR) AS entity_ref, count(*) AS detections FROM endpoint e JOIN alert a ON a.epip = e.epip "
    "WHERE contains(lower(a.alerttype), 'botnet') GROUP BY ALL UNION ALL "
    "SELECT 'enduser', cast(u.euid AS VARCHAR), count(*) FROM enduser u JOIN alert a ON a.euname = u.euname "
    "WHERE contains(lower(a.alerttype), 'botnet') GROUP BY ALL",
    "endpoint",
    "enduser",
    "alert",
)
def _(t):
    return linkage.behavioural_alerts(linkage.entity_pivots(t.endpoint, t.enduser), t.alert)


@query(
    "h13_entity_ids",
    "SELECT alertid, epid AS id FROM alert WHERE status <> 'P' UNION ALL SELECT alertid, unnest([epid, epid + 1]) FROM alert WHERE status = 'P'",
    "alert",
)
def _(t):
    listed = F.when(F.col("status") == "P", F.array(F.col("epid").cast("string"), (F.col("epid") + 1).cast("string"), F.lit("x")))
    df = t.alert.withColumn("epids", listed)
    return df.select("alertid", F.explode(linkage.entity_ids(df, ["epids", "epid"])).alias("id"))


# --- sets --------------------------------------------------------------------


@query(
    "s1_union_streams",
    "SELECT 'alert' AS source, alertid AS id, alerttime AS at FROM alert UNION ALL SELECT 'incident', incid, createtime FROM incident",
    "alert",
    "incident",
)
def _(t):
    alerts = t.alert.select(F.lit("alert").alias("source"), F.col("alertid").alias("id"), F.col("alerttime").alias("at"))
    incidents = t.incident.select(F.lit("incident").alias("source"), F.col("incid").alias("id"), F.col("createtime").alias("at"))
    return alerts.unionByName(incidents, allowMissingColumns=True)


@query(
    "s2_dedupe",
    "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1",
)
def _(t):
    rows = t.raw("events").select("user_id", "event_type", "event_id", "value")
    return paging.distinct_keep_first(rows, ["user_id", "event_type"], "event_id")


@query(
    "s4_intersection",
    "SELECT DISTINCT epid FROM endpoint WHERE epid IN (SELECT epid FROM alert WHERE severity = 'critical')",
    "endpoint",
    "alert",
)
def _(t):
    critical = t.alert.where(F.col("severity") == "critical")
    return linkage.overlapping(t.endpoint.select("epid"), critical, "epid")
