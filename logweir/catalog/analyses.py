"""Composed analyses over whole tables, checked by the rows of each section."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.catalog.links import _ENRICHED, _PAIR_VIEWS, _PAIRS, _SWEEP, _SWEPT, _swept
from logweir.catalog.registry import Tables, query
from logweir.catalog.scores import _RISK
from logweir.catalog.views import nested_endpoints, nested_vulnerabilities
from logweir.operators import bundles, linkage
from logweir.plans.conditions import Condition
from logweir.plans.timewindow import custom_window
from logweir.plans.vocabulary import vocabulary

YEAR = custom_window("1996-01-01|1996-12-31")


def _sections(**queries: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS section, cast(({sql}) AS BIGINT) AS rows" for n, sql in queries.items())


def _items(bundle: bundles.Bundle, **columns: str) -> DataFrame:
    """The rows of several sections as text, one column of them: what each section's twin lists."""
    merged = None
    for name, wanted in columns.items():
        section = bundle[name.replace("__", ".")]
        part = section.select(F.lit(name).alias("section"), F.concat_ws("|", *(F.col(c).cast("string") for c in wanted.split())).alias("item"))
        merged = part if merged is None else merged.unionByName(part)
    return merged


def _listed(**queries: str) -> str:
    """``name="columns FROM ..."`` as the twin of ``_items``."""
    return " UNION ALL ".join(f"SELECT '{n}' AS section, concat_ws('|', {sql.split(' FROM ', 1)[0]}) AS item FROM {sql.split(' FROM ', 1)[1]}" for n, sql in queries.items())


def _count(source: str, where: str = "true") -> str:
    return f"SELECT count(*) FROM {source} WHERE {where}"


def _critical(t: Tables) -> DataFrame:
    return t.alert.where(F.col("severity") == "critical")


@query(
    "n1_incidents",
    f"{_PAIRS} " + _listed(
        incidents="incid, status, n, basis FROM (SELECT i.incid, i.status, count(p.alertid) AS n, max(p.basis) AS basis FROM incident i LEFT JOIN pairs p USING (incid) GROUP BY 1, 2)",
        correlated_alerts="incid, alertid, basis, severity FROM pairs JOIN alert USING (alertid)",
    ),
    *_PAIR_VIEWS,
)
def _(t):
    found = bundles.incidents(t.incident, t.alert, t.attachment, keep=t.kept)
    return _items(found, incidents="incid status alert_count correlation_basis", correlated_alerts="incid alertid basis severity")


@query(
    "n2_reports",
    "SELECT state, count(*) AS reports FROM report WHERE timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1997-01-01' "
    "AND contains(lower(title), 'weekly') GROUP BY 1",
    "report",
)
def _(t):
    return bundles.reports(t.report, YEAR, "weekly")["reports"].groupBy("state").agg(F.count(F.lit(1)).alias("reports"))


@query(
    "n3_log_search",
    _listed(logs="sessionid, logid, service, srcip FROM traffic WHERE service = 'DNS'", total="count(*) FROM traffic WHERE service = 'DNS'"),
    "traffic",
)
def _(t):
    found = bundles.log_search(t.traffic, vocabulary("traffic"), [Condition("service", "eq", "dns")])
    return _items(found, logs="sessionid logid service srcip", total="total")


@query(
    "n4_asset_lookup",
    "SELECT e.epid, e.epname, v.severity, count(v.severity) AS hits FROM endpoint e LEFT JOIN (SELECT epid, coalesce(lower(severity), 'unknown') "
    "AS severity FROM vulnerability) v USING (epid) WHERE contains(e.epname, '#00000001') GROUP BY ALL",
    "endpoint",
    "vulnerability",
)
def _(t):
    flat = linkage.flat_vulnerabilities(nested_vulnerabilities(t.vulnerability))
    found = bundles.asset_lookup(t.endpoint, flat, hostname="customer#00000001", limit=1000)
    named = found["endpoints"].select("epid", "epname")
    rated = found["vulnerabilities"].withColumn("epid", F.col("epid").cast("bigint"))
    return named.join(rated, "epid").select("epid", "epname", "severity", "hits")


@query(
    "n5_identity_lookup",
    _listed(users="euid, euname, importance FROM enduser WHERE contains(euname, 'user1')", matched_total="count(*) FROM enduser WHERE contains(euname, 'user1')"),
    "enduser",
)
def _(t):
    return _items(bundles.identity_lookup(t.enduser, "User1"), users="euid euname importance", matched_total="matched_total")


@query(
    "n6_alert_rules",
    "SELECT CASE WHEN is_basic THEN 'basic' ELSE 'correlation' END AS handler_class, count(*) AS handler_count, cast(sum(rules) AS BIGINT) AS rule_count "
    "FROM handler WHERE contains(lower(name), 'bolt') GROUP BY 1",
    "handler",
)
def _(t):
    ruled = t.handler.withColumn("rule", F.when(F.col("rules") > 0, F.sequence(F.lit(1), F.col("rules").cast("int"))))
    basic, other = ruled.where("is_basic"), ruled.where("NOT is_basic")
    return bundles.alert_rules(basic.select("name", "id", "rule"), other.select("name", "id", "rule"), "BOLT", 5)["counts"]


@query(
    "n7_threat_intel",
    f"{_ENRICHED} " + _listed(
        indicators="value, type, ordinal, reputation, confidence, stored_value FROM enriched",
        skipped="ordinal, value, type FROM indicator WHERE type IN ('Hash', 'asn')",
        malicious="count(*) FROM enriched WHERE lower(reputation) = 'malicious'",
        threat_landscape="attack, n FROM (SELECT attack, count(*) AS n FROM attack GROUP BY 1 ORDER BY sum(CASE severity WHEN 'critical' THEN 50 "
        "WHEN 'high' THEN 30 WHEN 'medium' THEN 10 WHEN 'low' THEN 5 ELSE 0 END) DESC, 1 LIMIT 10)",
    ),
    "indicator",
    "enrichment",
    "attack",
)
def _(t):
    found = bundles.threat_intel(t.indicator, t.enrichment, t.attack)
    threats = found["threat_landscape"]
    found.sections["threat_landscape"] = threats.withColumn("n", F.col("threat_block") + F.col("threat_pass"))
    return _items(found, indicators="value type ordinal reputation confidence stored_value", skipped="ordinal value type", malicious="malicious", threat_landscape="threat n")


@query(
    "n8_identity_profile",
    _listed(
        users="euid, euname FROM enduser",
        endpoints="euid, epid FROM (SELECT DISTINCT u.euid, e.epid FROM enduser u JOIN endpoint e ON e.euid = u.euid OR lower(e.euname) = lower(u.euname))",
        recent_activity="u.euid, logid, action, subtype FROM enduser u JOIN event e ON lower(u.euname) = lower(e.user) WHERE e.action = 'failure' OR e.subtype = 'vpn'",
    ),
    "enduser",
    "endpoint",
    "event",
)
def _(t):
    found = bundles.identity_profile(t.enduser, nested_endpoints(t.endpoint), t.event)
    return _items(found, users="euid euname", endpoints="euid epid", recent_activity="euid logid action subtype")


@query(
    "n9_app_usage",
    "WITH top AS (SELECT 'applications' AS section, appcat AS k, sum(sentbyte + rcvdbyte) AS v FROM traffic GROUP BY 2 UNION ALL "
    "SELECT 'websites', catdesc, sum(sentbyte + rcvdbyte) FROM webfilter GROUP BY 2 UNION ALL SELECT 'cloud', app, count(*) FROM appctrl GROUP BY 2) "
    "SELECT section, concat_ws('|', k, cast(v AS BIGINT)) AS item FROM top QUALIFY row_number() OVER (PARTITION BY section ORDER BY v DESC, k NULLS FIRST) <= 5 "
    "UNION ALL SELECT 'dlp', concat_ws('|', qname, srcip) FROM dns",
    "traffic",
    "webfilter",
    "appctrl",
    "dns",
)
def _(t):
    found = bundles.app_usage(t.traffic, t.webfilter, t.appctrl, dlp=t.dns, limit=5)
    names = {"top-applications": "applications", "top-websites": "websites", "top-cloud-applications": "cloud"}
    found.sections = {names.get(n, n): df for n, df in found.sections.items()}
    return _items(found, applications="app_group bandwidth", websites="catdesc bandwidth", cloud="app sessions", dlp="qname srcip")


@query(
    "n10_network_context",
    "WITH t AS (SELECT * FROM traffic WHERE itime >= TIMESTAMP '1996-03-01' AND itime < TIMESTAMP '1996-04-01'), "
    "top AS (SELECT 'top_sources' AS section, srcip AS k, sum(sentbyte + rcvdbyte) AS v FROM t GROUP BY 2 UNION ALL "
    "SELECT 'top_destinations', dstip, sum(sentbyte + rcvdbyte) FROM t GROUP BY 2 UNION ALL SELECT 'top_countries', dstcountry, sum(sentbyte + rcvdbyte) FROM t GROUP BY 2) "
    "SELECT section, concat_ws('|', k, cast(v AS BIGINT)) AS item FROM top QUALIFY row_number() OVER (PARTITION BY section ORDER BY v DESC, k) <= 10 "
    "UNION ALL SELECT 'site_to_site_ipsec', concat_ws('|', tunnel, count(*)) FROM event WHERE subtype = 'vpn' GROUP BY tunnel",
    "traffic",
    "event",
)
def _(t):
    found = bundles.network_context(t.traffic, t.event, "1996-03-01|1996-03-31", datetime(2024, 1, 31), vpn_range="2000-01-01|2030-01-01")
    found.sections = {n.replace("-", "_"): df for n, df in found.sections.items()}
    return _items(
        found, top_sources="srcip bandwidth", top_destinations="dstip bandwidth", top_countries="dstcountry bandwidth", site_to_site_ipsec="tunnel sessions"
    )


@query("n11_risk_assessment", f"{_RISK} SELECT epid, composite, risk_band FROM risk", "vulnerability", "attack", "event", "endpoint")
def _(t):
    threats = t.attack.withColumn("epid", F.col("user_id"))
    failures = t.event.where(F.col("action") == "failure").withColumn("epid", F.col("user_id"))
    found = bundles.risk_assessment(t.endpoint.select("epid"), t.vulnerability, threats, failures)
    return found["risk"].select("epid", "composite", "risk_band")


_RELATED = """WITH crit AS (SELECT * FROM alert WHERE severity IN ('critical', 'low')), related AS (
    SELECT alertid, incids AS incid FROM crit WHERE incids IS NOT NULL UNION SELECT attachsrcid, incid FROM attachment WHERE attachtype = 'alertevent'
    AND attachsrcid IN (SELECT alertid FROM crit WHERE incids IS NULL))"""


def _subjects(t: Tables) -> DataFrame:
    return t.alert.where(F.col("severity").isin("critical", "low"))


@query(
    "n12_triage",
    f"{_RELATED} " + _listed(
        subject="alertid, severity, CASE severity WHEN 'critical' THEN 'urgent' ELSE 'low' END FROM crit",
        related="alertid, incid, category FROM related JOIN incident USING (incid)",
        triggering_logs="alertid, sessionid FROM traffic WHERE alertid IN (SELECT alertid FROM crit)",
    ),
    *_PAIR_VIEWS,
    "traffic",
)
def _(t):
    found = bundles.triage_alerts(_subjects(t), t.alert, t.incident, t.attachment, t.traffic)
    return _items(found, subject="alertid severity priority", related="alertid incid category", triggering_logs="alertid sessionid")


@query(
    "n12_triage_incidents",
    f"{_PAIRS} " + _listed(subject="incid, severity, category FROM incident", related="incid, alertid, basis, severity FROM pairs JOIN alert USING (alertid)"),
    *_PAIR_VIEWS,
)
def _(t):
    found = bundles.triage_incidents(t.incident, t.incident, t.alert, t.attachment, keep=t.kept)
    return _items(found, subject="incid severity category", related="incid alertid basis severity")


_SUMMARY = dict(
    incident="incid, n, basis FROM (SELECT i.incid, count(p.alertid) AS n, max(p.basis) AS basis FROM incident i LEFT JOIN pairs p USING (incid) GROUP BY 1)",
    alerts="incid, alertid, basis FROM pairs JOIN alert USING (alertid)",
    evidence_logs="alertid, sessionid FROM traffic WHERE alertid IN (SELECT alertid FROM pairs)",
    timeline="incid, 'incident', incid FROM incident UNION ALL SELECT 'timeline', concat_ws('|', incid, 'alert', alertid) FROM pairs WHERE alertid IN (SELECT alertid FROM alert)",
)


@query("n13_incident_summary", f"{_PAIRS} " + _listed(**_SUMMARY), *_PAIR_VIEWS, "traffic")
def _(t):
    found = bundles.incident_summary(t.incident, t.incident, t.alert, t.attachment, t.traffic, keep=t.kept)
    return _items(found, incident="incid alert_count correlation_basis", alerts="incid alertid basis", evidence_logs="alertid sessionid", timeline="case_id source reference")


def _estate(t: Tables) -> bundles.Estate:
    endpoints = nested_endpoints(t.endpoint)
    flat = linkage.flat_vulnerabilities(nested_vulnerabilities(t.vulnerability))
    logs = {"traffic": t.traffic, "attack": t.attack, "event": t.event}
    # The address each alert is about is its indicator.
    linked = t.alert.select("alertid", F.col("epip").alias("value"), F.lit("IP").alias("type"), F.col("epid").alias("ordinal"))
    return bundles.Estate(t.alert, t.incident, t.attachment, endpoints, t.enduser, flat, linked, t.enrichment, logs)


# What the alerts of a subject lead to: ``held`` are those alerts, ``cases`` the incidents.
_LEADS = """best AS (SELECT lookup, reputation FROM enrichment WHERE type = 'IP' QUALIFY row_number() OVER (PARTITION BY lookup ORDER BY value <> lookup, ordinal) = 1),
  told AS (SELECT DISTINCT h.epip AS value, b.reputation FROM held h LEFT JOIN best b ON b.lookup = h.epip),
  counted AS (SELECT c.incid, count(p.alertid) AS n FROM cases c LEFT JOIN pairs p USING (incid) GROUP BY 1),
  proof AS (SELECT alertid, sessionid FROM traffic WHERE alertid IN (SELECT alertid FROM pairs WHERE incid IN (SELECT incid FROM cases)))"""
_FOUND = dict(
    threat_intel__indicators="value, reputation FROM told", summary__incident="incid, n FROM counted", summary__evidence_logs="alertid, sessionid FROM proof"
)
_FOUND_COLUMNS = dict(threat_intel__indicators="value reputation", summary__incident="incid alert_count", summary__evidence_logs="alertid sessionid")
_ESTATE_VIEWS = (*_PAIR_VIEWS, "traffic", "enrichment", "endpoint")


@query(
    "n14_investigate",
    f"""{_PAIRS}, held AS (SELECT * FROM alert WHERE severity = 'critical'), related AS (SELECT DISTINCT attachsrcid AS alertid, incid FROM attachment
        WHERE attachtype = 'alertevent' AND attachsrcid IN (SELECT alertid FROM held) AND incid IN (SELECT incid FROM incident)),
      cases AS (SELECT DISTINCT incid FROM related), {_LEADS} """
    + _listed(
        headline="alertid, concat('alert ', alertid, ': priority urgent; 1 linked endpoints') FROM held",
        triage__related="alertid, incid FROM related",
        assets__endpoints="epid, epname FROM endpoint WHERE epid IN (SELECT epid FROM held)",
        **_FOUND,
    ),
    *_ESTATE_VIEWS,
)
def _(t):
    found = bundles.investigate(_critical(t), _estate(t), keep=t.kept)
    return _items(found, headline="alertid headline", triage__related="alertid incid", assets__endpoints="epid epname", **_FOUND_COLUMNS)


@query(
    "n14_investigate_incident",
    f"""{_PAIRS}, cases AS (SELECT * FROM incident WHERE severity = 'high'),
      held AS (SELECT * FROM alert WHERE alertid IN (SELECT alertid FROM pairs WHERE incid IN (SELECT incid FROM cases))), {_LEADS} """
    + _listed(
        triage__subject="incid, severity FROM cases",
        triage__related="alertid, incid FROM pairs WHERE alertid IN (SELECT alertid FROM held) AND incid IN (SELECT incid FROM cases)",
        assets__endpoints="epid, epname FROM endpoint WHERE epid IN (SELECT epid FROM held UNION SELECT epid FROM cases)",
        **_FOUND,
    ),
    *_ESTATE_VIEWS,
)
def _(t):
    found = bundles.investigate(t.incident.where(F.col("severity") == "high"), _estate(t), kind="incident", keep=t.kept)
    return _items(found, triage__subject="incid severity", triage__related="alertid incid", assets__endpoints="epid epname", **_FOUND_COLUMNS)


@query(
    "n15_hunt_indicators",
    f"{_SWEEP} SELECT value, concat('indicator ', value, '; sweep: ', cast(sum(hits) AS BIGINT), ' matches across 4 searches') AS headline FROM matches GROUP BY value, type",
    "indicator",
    *_SWEPT,
)
def _(t):
    return bundles.hunt_indicators(t.indicator, _swept(t), t.enrichment)["headline"]


@query(
    "n15_hunt_ttp",
    "SELECT 'attack' AS section, count(*) AS rows FROM attack WHERE contains(lower(attack), 'sig-4') UNION ALL SELECT 'dns', 0",
    "attack",
)
def _(t):
    return bundles.hunt_condition({"attack": t.attack, "dns": t.dns}, ttp="Sig-4")["totals"]


@query(
    "n15_hunt_entities",
    """WITH d AS (SELECT epip, count(*) AS n FROM alert WHERE contains(lower(alerttype), 'botnet') AND alerttime >= TIMESTAMP '1996-01-01'
        AND alerttime < TIMESTAMP '1997-01-01' GROUP BY 1),
      r AS (SELECT epid, epip, cnt_cri, cnt_hig, cume_dist() OVER (ORDER BY cast(risk_score AS DOUBLE)) AS p FROM endpoint)
    SELECT r.epid, round_even(100.0::DOUBLE * p, 1) >= 90 OR cnt_cri > '0' OR cnt_hig > '0' OR d.n IS NOT NULL AS anomalous FROM r LEFT JOIN d USING (epip)""",
    "alert",
    "endpoint",
)
def _(t):
    found = bundles.hunt_entities(t.alert, nested_endpoints(t.endpoint), t.enduser, window=YEAR)
    return found["endpoints"].select("epid", "anomalous")


_IN_1996 = "itime >= TIMESTAMP '1996-01-01' AND itime < TIMESTAMP '1997-01-01'"
# Rows of the window by address and by user, as the impact of an investigation counts them.
_SEEN = "seen AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS logtype, '{field}' AS field, lower({column}) AS v FROM {name} WHERE {_IN_1996}"
    for name in ("traffic", "attack", "event")
    for field, column in (("srcip", "srcip"), ("user", '"user"'))
) + ")"
_IMPACT = "SELECT entity_type, entity_ref, logtype, count(*) AS hits FROM pivots p JOIN seen s ON s.field = p.field AND s.v = lower(p.value) GROUP BY ALL"
_OF_HELD = """pivots AS (SELECT 'endpoint' AS entity_type, cast(epid AS VARCHAR) AS entity_ref, 'srcip' AS field, epip AS value FROM endpoint WHERE epid IN (SELECT epid FROM held)
    UNION ALL SELECT 'enduser', cast(euid AS VARCHAR), 'user', euname FROM enduser WHERE lower(euname) IN (SELECT lower(euname) FROM held)
    UNION ALL SELECT DISTINCT 'ip', epip, 'srcip', epip FROM held)"""
_DEEP_VIEWS = ("alert", "traffic", "attack", "event", "endpoint", "enduser")
_YEAR_TEXT = "1996-01-01|1996-12-31"


@query("n16_investigate_deep", f"WITH held AS (SELECT * FROM alert WHERE severity = 'critical'), {_SEEN}, {_OF_HELD} {_IMPACT}", *_DEEP_VIEWS)
def _(t):
    return bundles.investigate_deep(_critical(t), _estate(t), _YEAR_TEXT)["impact.counts"]


@query(
    "n16_impact_rows",
    f"""WITH held AS (SELECT * FROM alert WHERE severity = 'critical'), {_OF_HELD}
      SELECT entity_type, entity_ref, sessionid FROM pivots p JOIN traffic t ON p.field = 'srcip' AND t.srcip = p.value WHERE {_IN_1996}""",
    *_DEEP_VIEWS,
)
def _(t):
    return bundles.investigate_deep(_critical(t), _estate(t), _YEAR_TEXT)["impact.traffic"].select("entity_type", "entity_ref", "sessionid")


@query(
    "n16_incident_chain",
    f"""{_PAIRS}, cases AS (SELECT * FROM incident WHERE severity = 'high'), tied AS (SELECT incid, a.* FROM pairs p JOIN alert a USING (alertid) WHERE incid IN (SELECT incid FROM cases))
      SELECT incid AS case_id, 'incident' AS source, incid AS reference FROM cases UNION ALL SELECT incid, 'alert', alertid FROM tied
      UNION ALL SELECT l.incid, 'log', t.logid FROM tied l JOIN traffic t USING (alertid) WHERE {_IN_1996}""",
    *_PAIR_VIEWS,
    "traffic",
)
def _(t):
    found = bundles.investigate_deep(t.incident.where(F.col("severity") == "high"), _estate(t), _YEAR_TEXT, kind="incident", keep=t.kept)
    return found["root_cause.chain"].select("case_id", "source", "reference")


@query(
    "n16_entity",
    f"WITH {_SEEN}, pivots AS (SELECT 'endpoint' AS entity_type, cast(epid AS VARCHAR) AS entity_ref, 'srcip' AS field, epip AS value FROM endpoint WHERE epid = 7) {_IMPACT}",
    *_DEEP_VIEWS,
)
def _(t):
    return bundles.investigate_deep("epid:7", _estate(t), _YEAR_TEXT)["impact.counts"]


@query(
    "n16_root_cause",
    """WITH crit AS (SELECT * FROM alert WHERE severity = 'critical'), related AS (SELECT attachsrcid AS alertid, incid FROM attachment
        WHERE attachtype = 'alertevent' AND attachsrcid IN (SELECT alertid FROM crit)),
      chain AS (SELECT alertid AS c, epoch(alerttime) AS m, 'alert' AS s, alertid AS r FROM crit UNION ALL
        SELECT x.alertid, epoch(i.createtime), 'incident', i.incid FROM related x JOIN incident i USING (incid) UNION ALL
        SELECT alertid, epoch(itime), 'log', logid FROM traffic WHERE alertid IN (SELECT alertid FROM crit)
        AND itime >= TIMESTAMP '1996-01-01' AND itime < TIMESTAMP '1997-01-01')
      SELECT c AS case_id, concat('alert ', c, '; root cause: ', count(*), ' events; earliest ', arg_min(s, (m, s, r)), ' ', arg_min(r, (m, s, r))) AS headline
      FROM chain GROUP BY 1""",
    "alert",
    "attachment",
    "incident",
    "traffic",
)
def _(t):
    return bundles.investigate_deep(_critical(t), _estate(t), _YEAR_TEXT)["headline"]


# --- sections of bundles that the queries above leave out --------------------

_THREATS = (
    "attack, n FROM (SELECT attack, count(*) AS n FROM attack GROUP BY 1 ORDER BY sum(CASE severity WHEN 'critical' THEN 50 "
    "WHEN 'high' THEN 30 WHEN 'medium' THEN 10 WHEN 'low' THEN 5 ELSE 0 END) DESC, 1 LIMIT {})"
)
_BUCKETS = (
    "source, bucket, severity, n FROM (SELECT 'alert' AS source, date_trunc('month', alerttime) AS bucket, severity, count(*) AS n FROM alert {a} GROUP BY ALL "
    "UNION ALL SELECT 'incident', date_trunc('month', createtime), severity, count(*) FROM incident {i} GROUP BY ALL)"
)


def _within(moment: str) -> str:
    return f"WHERE {moment} >= TIMESTAMP '1996-01-01' AND {moment} < TIMESTAMP '1997-01-01'"


def _counted(section: DataFrame) -> DataFrame:
    return section.withColumn("n", F.col("threat_block") + F.col("threat_pass"))


@query(
    "n6_alert_rule_rows",
    _listed(
        handlers="handler_class, name, id FROM (SELECT CASE WHEN is_basic THEN 'basic' ELSE 'correlation' END AS handler_class, name, id FROM handler "
        "WHERE contains(lower(name), 'bolt') ORDER BY 1, 2, 3 LIMIT 5)",
        matched_total="count(*) FROM handler WHERE contains(lower(name), 'bolt')",
    ),
    "handler",
)
def _(t):
    ruled = t.handler.withColumn("rule", F.when(F.col("rules") > 0, F.sequence(F.lit(1), F.col("rules").cast("int"))))
    basic, other = (ruled.where(w).select("name", "id", "rule") for w in ("is_basic", "NOT is_basic"))
    return _items(bundles.alert_rules(basic, other, "BOLT", 5), handlers="handler_class name id", matched_total="matched_total")


@query(
    "n7_sources",
    f"{_ENRICHED}, told AS (SELECT e.* FROM enrichment e SEMI JOIN wanted w ON e.lookup = w.value AND e.type = w.kind) SELECT lookup, "
    "CASE WHEN ordinal % 2 = 0 THEN 'VT' ELSE 'unknown' END AS source, CASE WHEN ordinal % 2 = 0 THEN "
    "concat(ordinal % 7 + 1, '/', ordinal % 7 + 61, ' engines flagged') ELSE concat('c', ordinal % 4) END AS verdict, "
    "CASE WHEN ordinal % 2 = 1 THEN 'high' END AS confidence, CASE WHEN ordinal % 2 = 1 THEN 'm' END AS malware, "
    "CASE WHEN ordinal % 2 = 0 THEN 'https://www.virustotal.com/x' END AS link FROM told",
    "indicator",
    "enrichment",
)
def _(t):
    return bundles.threat_intel(t.indicator, t.enrichment)["sources"].select("lookup", "source", "verdict", "confidence", "malware", "link")


@query("n12_context", _listed(context_stats=_BUCKETS.format(a=_within("alerttime"), i=_within("createtime"))), "alert", "incident")
def _(t):
    found = bundles.triage_alerts(_subjects(t), t.alert, t.incident, t.attachment, window=YEAR)
    return _items(found, context_stats="source bucket severity hits")


@query("n12_context_incidents", _listed(context_stats=_BUCKETS.format(a="", i="")), "alert", "incident")
def _(t):
    return _items(bundles.triage_incidents(t.incident, t.incident, t.alert, t.attachment), context_stats="source bucket severity hits")


@query("n13_landscape", _listed(threat_landscape=_THREATS.format(3)), "attack")
def _(t):
    found = bundles.incident_summary(t.incident, t.incident, t.alert, t.attachment, t.traffic, t.attack, threats=3)
    found.sections["threat_landscape"] = _counted(found["threat_landscape"])
    return _items(found, threat_landscape="threat n")


@query(
    "n15_hunt_users",
    "WITH d AS (SELECT euname, count(*) AS n FROM alert WHERE contains(lower(alerttype), 'botnet') AND alerttime >= TIMESTAMP '1996-01-01' "
    "AND alerttime < TIMESTAMP '1997-01-01' GROUP BY 1) "
    + _listed(
        users="euid, coalesce(u.importance = 'high', false) OR coalesce(d.n, 0) > 0, coalesce(d.n, 0) FROM enduser u LEFT JOIN d USING (euname)",
        user_stats="count(*), count(*) FILTER (first_seen >= TIMESTAMP '1996-01-01' AND first_seen < TIMESTAMP '1997-01-01') FROM enduser",
        endpoint_stats="count(*), count(*) FILTER (first_seen >= TIMESTAMP '1996-01-01' AND first_seen < TIMESTAMP '1997-01-01'), "
        "count(*) FILTER (euid IS NOT NULL OR euname <> ''), count(*) FILTER (NOT (euid IS NOT NULL OR euname <> '')) FROM endpoint",
    ),
    "alert",
    "enduser",
    "endpoint",
)
def _(t):
    found = bundles.hunt_entities(t.alert, nested_endpoints(t.endpoint), t.enduser, window=YEAR)
    return _items(found, users="euid anomalous detections", user_stats="total_count new_count", endpoint_stats="total new identified unidentified")


@query(
    "n16_named_users",
    f"""WITH held AS (SELECT *, CASE WHEN epid % 2 = 0 THEN epid END AS uid FROM alert WHERE severity = 'critical'), {_SEEN},
      pivots AS (SELECT 'enduser' AS entity_type, cast(euid AS VARCHAR) AS entity_ref, 'user' AS field, euname AS value FROM enduser
        WHERE lower(euname) IN (SELECT lower(euname) FROM held) OR euid IN (SELECT uid FROM held)) {_IMPACT}""",
    *_DEEP_VIEWS,
)
def _(t):
    # Every other alert carries a user's id; all name a user, and both are followed.
    known = t.alert.withColumn("euid", F.when(F.col("epid") % 2 == 0, F.col("epid")))
    estate = replace(_estate(t), alerts=known)
    found = bundles.investigate_deep(known.where(F.col("severity") == "critical"), estate, _YEAR_TEXT)
    return found["impact.counts"].where("entity_type = 'enduser'")
