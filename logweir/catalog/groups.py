"""Queries over groups: breakdowns, samples, policies, views, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from logweir.catalog.registry import query
from logweir.catalog.views import nested_endpoints
from logweir.functions.predicates import policy_scope
from logweir.operators import breakdown, paging, stats, views
from logweir.plans import timewindow as tw
from logweir.plans.vocabulary import vocabulary

TRAFFIC = vocabulary("traffic")
YEAR = tw.custom_window("1996-01-01|1996-12-31")
IN_YEAR = "itime >= TIMESTAMP '1996-01-01' AND itime < TIMESTAMP '1997-01-01'"

# The labels of three dimensions in SQL, as the oracle of every breakdown.
_PORT = "CASE WHEN dstport <> '0' THEN concat(proto, '/', dstport) END"
_SERVICE = "CASE WHEN lower(service) IN ('', 'n/a', 'null', 'none', 'unknown') THEN NULL ELSE service END"
_APP = "CASE WHEN lower(app) IN ('', 'n/a', 'null', 'none', 'unknown') THEN NULL ELSE app END"


def _counted(rows: str, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{d}' AS dimension, {label} AS value, count(*) AS hits FROM {rows} GROUP BY ALL"
        for d, label in (("port", _PORT), ("service", _SERVICE), ("app", _APP))
    )


def _top(n: int, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead}dimension, value, hits FROM counted WHERE value IS NOT NULL "
        f"QUALIFY row_number() OVER (PARTITION BY {lead}dimension ORDER BY hits DESC, value) <= {n}"
    )


def _residual(n: int, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    return (
        f"SELECT {lead}dimension, cast(coalesce(sum(hits) FILTER (value IS NULL), 0) AS BIGINT) AS excluded_rows, "
        f"count(value) AS distinct_values, count(value) > {n} AS buckets_truncated, "
        f"cast(coalesce(sum(hits) FILTER (value IS NOT NULL AND place <= {n}), 0) AS BIGINT) AS hits_shown, "
        f"cast(coalesce(sum(hits) FILTER (value IS NOT NULL), 0) AS BIGINT) AS hits_total FROM "
        f"(SELECT *, row_number() OVER (PARTITION BY {lead}dimension ORDER BY value IS NULL, hits DESC, value) AS place "
        f"FROM counted) GROUP BY ALL"
    )


# --- groups and breakdowns ---------------------------------------------------


@query("f1_group_exact", "SELECT dstip, count(*) AS hits FROM traffic GROUP BY 1", "traffic")
def _(t):
    return breakdown.group_by(t.traffic, TRAFFIC, "destination_ip", strict=True)


@query(
    "f1_group_any",
    "SELECT service, count(*) AS hits, cast(sum(sentbyte) AS BIGINT) AS sent FROM traffic GROUP BY 1",
    "traffic",
)
def _(t):
    return breakdown.group_by(t.traffic, TRAFFIC, "service", False, F.sum("sentbyte").alias("sent"))


@query("f5_breakdowns", f"WITH counted AS ({_counted('traffic')}) {_top(5)}", "traffic")
def _(t):
    return breakdown.breakdowns(t.traffic, TRAFFIC, ["port", "service", "application", "app"], 5).buckets


@query("f6_residuals", f"WITH counted AS ({_counted('traffic')}) {_residual(5)}", "traffic")
def _(t):
    return breakdown.breakdowns(t.traffic, TRAFFIC, ["port", "service", "app"], 5).residuals


@query(
    "e6_topn",
    "WITH counted AS (SELECT 'srcip' AS dimension, srcip AS value, count(*) AS hits FROM traffic GROUP BY ALL UNION ALL "
    f"SELECT 'dstcountry', dstcountry, count(*) FROM traffic GROUP BY ALL) {_top(10)}",
    "traffic",
)
def _(t):
    return breakdown.top_buckets(breakdown.buckets(t.traffic, ["srcip", "dstcountry"]), 10)


_SLICES = (
    "SELECT *, cast(floor((cast(date_diff('second', TIMESTAMP '1996-01-01', itime) AS BIGINT) + 1) * 4 / 31622400.0 - 1e-12) AS INTEGER) AS slice "
    f"FROM traffic WHERE {IN_YEAR}"
)


@query(
    "f7_bounded_sample",
    f"WITH cut AS ({_SLICES}) SELECT slice, itime, sessionid, srcip, dstip, sentbyte FROM cut QUALIFY row_number() OVER "
    "(PARTITION BY slice ORDER BY itime DESC, sessionid, srcip, dstip, sentbyte) <= 40",
    "traffic",
)
def _(t):
    rows = YEAR.filter(t.traffic).select("itime", "sessionid", "srcip", "dstip", "sentbyte")
    return breakdown.bounded_sample(rows, 40, tw.slices(YEAR, 4))


@query(
    "f7_sample_proof",
    f"WITH cut AS ({_SLICES}), n AS (SELECT slice, count(*) AS r FROM cut GROUP BY 1) "
    "SELECT cast(sum(r) AS BIGINT) AS total_hits, cast(sum(least(r, 2100)) AS BIGINT) AS observed_hits, "
    "cast(4 AS BIGINT) AS slices_scanned, count(*) FILTER (r >= 2100) AS truncated_slices, "
    "count(*) FILTER (r >= 2100) = 0 AS is_exact FROM n",
    "traffic",
)
def _(t):
    return breakdown.sample_proof(YEAR.filter(t.traffic), 2100, tw.slices(YEAR, 4))


_POLICY_ROWS = f"(SELECT * FROM traffic WHERE {IN_YEAR} AND policyid IN (1, 3, 7) AND action = 'accept')"


def _policies(t, limit=None):
    return breakdown.policy_traffic(t.traffic, TRAFFIC, YEAR, [1, 3, 7], action="accept", top_n=4, limit=limit)


@query(
    "f8_policy_traffic",
    f"WITH counted AS ({_counted(_POLICY_ROWS, 'policyid')}) {_top(4, 'policyid')}",
    "traffic",
)
def _(t):
    return _policies(t).buckets


@query(
    "f8_policy_residuals",
    f"WITH counted AS ({_counted(_POLICY_ROWS, 'policyid')}) {_residual(4, 'policyid')}",
    "traffic",
)
def _(t):
    return _policies(t).residuals


@query(
    "f8_policy_summary",
    f"WITH cut AS (SELECT * FROM ({_SLICES}) WHERE policyid IN (1, 3, 7) AND action = 'accept'), "
    "n AS (SELECT policyid, slice, count(*) AS r FROM cut GROUP BY ALL) "
    "SELECT policyid, cast(sum(r) AS BIGINT) AS total_hits, cast(sum(least(r, 150)) AS BIGINT) AS observed_hits, "
    "cast(4 AS BIGINT) AS slices_scanned, count(*) FILTER (r >= 150) AS truncated_slices, "
    "count(*) FILTER (r >= 150) = 0 AS is_exact, "
    "CASE WHEN count(*) FILTER (r >= 150) = 0 THEN 'complete' ELSE 'bounded_sample' END AS analysis_mode FROM n GROUP BY 1",
    "traffic",
)
def _(t):
    return _policies(t, limit=150).summary


@query(
    "f8_policy_asked",
    "SELECT cast(p.id AS INTEGER) AS policyid, count(t.policyid) AS total_hits, count(t.policyid) AS observed_hits, 'complete' AS analysis_mode "
    f"FROM (SELECT unnest(range(1, 41)) AS id) p LEFT JOIN (SELECT policyid FROM traffic WHERE {IN_YEAR}) t ON t.policyid = p.id GROUP BY 1",
    "traffic",
)
def _(t):
    found = breakdown.policy_traffic(t.traffic, TRAFFIC, YEAR, list(range(1, 41)))
    return found.summary.select("policyid", "total_hits", "observed_hits", "analysis_mode")


# --- views -------------------------------------------------------------------

_VOLUME = (
    "count(*) AS sessions, cast(sum(sentbyte) + sum(rcvdbyte) AS BIGINT) AS bandwidth, "
    "cast(sum(sentbyte) AS BIGINT) AS traffic_out, cast(sum(rcvdbyte) AS BIGINT) AS traffic_in"
)


def _volume_sql(key: str, source: str, tail: str = "ORDER BY bandwidth DESC, 1 LIMIT 100", where: str = "") -> str:
    return f"SELECT {key}, {_VOLUME} FROM {source} {where} GROUP BY 1 {tail}"


@query(
    "f9_top_sources",
    _volume_sql("srcip", "traffic", where=f"WHERE {IN_YEAR} AND policyid IN (1, 2, 3) AND lower(action) = 'accept'"),
    "traffic",
)
def _(t):
    rows = YEAR.filter(t.traffic).where(policy_scope([1, 2, 3], "accept"))
    return views.view(rows, "top-sources", limit=100).df


@query("f9_top_destinations", _volume_sql("dstip", "traffic"), "traffic")
def _(t):
    return views.view(t.traffic, "top-destinations", limit=100).df


@query("f10_top_applications", _volume_sql("appcat AS app_group", "traffic"), "traffic")
def _(t):
    return views.view(t.traffic, "top-applications", limit=100).df


@query("f11_top_websites", _volume_sql("catdesc", "webfilter"), "webfilter")
def _(t):
    return views.view(t.webfilter, "top-websites", limit=100).df


@query(
    "f12_top_threats",
    "SELECT attack AS threat, 'attack' AS threattype, cast(max(w) AS BIGINT) AS threatlevel, cast(sum(w) AS BIGINT) AS threatweight, "
    "count(*) FILTER (action = 'blocked') AS threat_block, count(*) FILTER (action <> 'blocked') AS threat_pass, "
    "count(incid) AS incidents, count(incid) FILTER (action = 'blocked') AS incident_block, "
    "count(incid) FILTER (action <> 'blocked') AS incident_pass FROM (SELECT *, CASE severity WHEN 'critical' THEN 50 "
    "WHEN 'high' THEN 30 WHEN 'medium' THEN 10 WHEN 'low' THEN 5 ELSE 0 END AS w FROM attack) GROUP BY 1 "
    "ORDER BY threatweight DESC, 1 LIMIT 20",
    "attack",
)
def _(t):
    return views.view(t.attack, "top-threats", limit=20).df


@query(
    "f13_top_cloud_apps",
    "SELECT app, count(*) AS sessions, cast(0 AS BIGINT) AS bandwidth, cast(0 AS BIGINT) AS traffic_out, "
    "cast(0 AS BIGINT) AS traffic_in FROM appctrl GROUP BY 1",
    "appctrl",
)
def _(t):
    return views.view(t.appctrl, "top-cloud-applications").df


@query("f14_top_countries", _volume_sql("dstcountry", "traffic", tail=""), "traffic")
def _(t):
    return views.view(t.traffic, "top-countries").df


@query("f15_policy_hits", "SELECT policyid, count(*) AS counts FROM traffic GROUP BY 1", "traffic")
def _(t):
    return views.view(t.traffic, "policy-hits").df


@query(
    "f16_policy_line",
    "SELECT date_trunc('hour', itime) AS bucket, policyid, count(*) AS counts FROM traffic GROUP BY 1, 2",
    "traffic",
)
def _(t):
    return views.view(t.traffic, "policy-line").df


@query(
    "f17_vpn_tunnels",
    "SELECT tunnel, min(itime) AS first_seen, max(itime) AS last_seen, count(*) AS sessions, "
    "cast(sum(sentbyte) + sum(rcvdbyte) AS BIGINT) AS bandwidth FROM event WHERE subtype = 'vpn' GROUP BY 1",
    "event",
)
def _(t):
    return views.view(t.event, "site-to-site-ipsec").df


@query(
    "f_rollup",
    "SELECT date_trunc('hour', itime) AS hour, tunnel, count(*) AS sessions, cast(sum(sentbyte) AS BIGINT) AS traffic_out, "
    "cast(sum(rcvdbyte) AS BIGINT) AS traffic_in FROM event GROUP BY 1, 2",
    "event",
)
def _(t):
    return views.rollup(t.event, ["tunnel"]).withColumn("hour", F.col("hour").cast("timestamp_ntz"))


# --- statistics --------------------------------------------------------------


@query(
    "f18_alert_count",
    "SELECT count(*) AS total, count(*) FILTER (NOT acknowledged) AS unacknowledged FROM alert",
    "alert",
)
def _(t):
    return stats.alert_count(t.alert)


@query(
    "f19_alert_severity_timescale",
    "SELECT severity, date_trunc('month', alerttime) AS bucket, count(*) AS alerts FROM alert GROUP BY 1, 2",
    "alert",
)
def _(t):
    return stats.alert_counts(t.alert, "severity-timescale", "month")


for _kind, _keys in stats.ALERT_COUNTS.items():
    if "bucket" not in _keys:
        _name = "f19_alert_" + _kind.replace("-", "_")
        _sql = f"SELECT {', '.join(_keys)}, count(*) AS alerts FROM alert GROUP BY ALL"
        query(_name, _sql, "alert")(lambda t, kind=_kind: stats.alert_counts(t.alert, kind))


@query("f20_alert_groups", "SELECT status, count(*) AS hits FROM alert GROUP BY 1", "alert")
def _(t):
    return stats.group_counts(t.alert, "alert", "status")


@query("f20_incident_groups", "SELECT category, count(*) AS hits FROM incident GROUP BY 1", "incident")
def _(t):
    return stats.group_counts(t.incident, "incident", "category")


@query(
    "f21_time_buckets",
    "SELECT 'alert' AS source, date_trunc('month', alerttime) AS bucket, severity, count(*) AS hits FROM alert GROUP BY ALL "
    "UNION ALL SELECT 'incident', date_trunc('month', createtime), severity, count(*) FROM incident GROUP BY ALL",
    "alert",
    "incident",
)
def _(t):
    return stats.alert_incident_buckets(t.alert, t.incident, "month")


@query(
    "f22_incident_stats",
    "SELECT 'total' AS item, 'all' AS value, count(*) AS hits FROM incident UNION ALL "
    "SELECT 'severity', severity, count(*) FROM incident GROUP BY ALL UNION ALL "
    "SELECT 'status', status, count(*) FROM incident GROUP BY ALL UNION ALL "
    "SELECT 'category', category, count(*) FROM incident GROUP BY ALL UNION ALL "
    "SELECT 'outbreak', CASE WHEN contains(lower(category), 'outbreak') THEN 'true' ELSE 'false' END, count(*) FROM incident GROUP BY ALL",
    "incident",
)
def _(t):
    return stats.incident_stats(t.incident, ["total", "severity", "status", "category", "outbreak"])


@query(
    "f23_incident_count",
    "SELECT count(*) AS total FROM incident WHERE createtime >= TIMESTAMP '1996-01-01' AND createtime < TIMESTAMP '1997-01-01' AND status = 'open'",
    "incident",
)
def _(t):
    return paging.total(YEAR.filter(t.incident, "createtime").where(F.col("status") == "open"))


@query(
    "f24_severity_hist",
    "SELECT coalesce(lower(severity), 'unknown') AS severity, count(*) AS hits FROM vulnerability GROUP BY 1",
    "vulnerability",
)
def _(t):
    return stats.severity_histogram(t.vulnerability)


@query(
    "f25_vuln_stats",
    "SELECT epid, severity, hits FROM (SELECT epid, 'critical' AS severity, cast(cnt_cri AS BIGINT) AS hits FROM endpoint UNION ALL "
    "SELECT epid, 'high', cast(cnt_hig AS BIGINT) FROM endpoint UNION ALL SELECT epid, 'low', cast(cnt_low AS BIGINT) FROM endpoint "
    "UNION ALL SELECT epid, 'cnt_new', cast(cnt_new AS BIGINT) FROM endpoint) WHERE hits > 0",
    "endpoint",
)
def _(t):
    return stats.vulnerability_counters(nested_endpoints(t.endpoint))


@query(
    "f26_endpoint_stats",
    "SELECT count(*) AS total, count(*) FILTER (first_seen >= TIMESTAMP '1996-01-01' AND first_seen < TIMESTAMP '1997-01-01') AS new, "
    "count(*) FILTER (euid IS NOT NULL OR euname <> '') AS identified, count(*) FILTER (NOT (euid IS NOT NULL OR euname <> '')) AS unidentified FROM endpoint",
    "endpoint",
)
def _(t):
    return stats.endpoint_stats(nested_endpoints(t.endpoint), YEAR)


@query(
    "f27_enduser_stats",
    "SELECT count(*) AS total_count, count(*) FILTER (first_seen >= TIMESTAMP '2024-01-01' AND first_seen < TIMESTAMP '2024-01-02') AS new_count FROM enduser",
    "enduser",
)
def _(t):
    return stats.enduser_stats(t.enduser, tw.custom_window("2024-01-01|2024-01-01"))


@query(
    "f28_ips_summary",
    "SELECT count(*) AS count, count(*) FILTER (pcapurl <> '') AS pcap_available_count FROM attack",
    "attack",
)
def _(t):
    return stats.ips_summary(t.attack)


@query(
    "f29_rule_counts",
    "SELECT CASE WHEN is_basic THEN 'basic' ELSE 'correlation' END AS handler_class, count(*) AS handler_count, "
    "cast(sum(rules) AS BIGINT) AS rule_count FROM handler GROUP BY 1",
    "handler",
)
def _(t):
    ruled = t.handler.withColumn(
        "rule", F.when(F.col("rules") > 0, F.sequence(F.lit(1), F.col("rules").cast("int")))
    )
    basic = ruled.where("is_basic").select("name", "rule")
    return stats.rule_counts(stats.rule_catalogue(basic, ruled.where("NOT is_basic").select("name", "id", "rule")))


@query(
    "f30_section_counts",
    "SELECT 'alerts' AS section, count(*) AS rows FROM alert UNION ALL SELECT 'incidents', count(*) FROM incident",
    "alert",
    "incident",
)
def _(t):
    return stats.section_counts({"alerts": t.alert, "incidents": t.incident})
