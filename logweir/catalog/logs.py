"""Queries over log rows: sources, windows, conditions, projections, pages."""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import functions as F

from logweir.catalog.registry import Tables, query
from logweir.catalog.views import nested_endpoints
from logweir.functions import coercion, derived
from logweir.functions import predicates as P
from logweir.functions.net import in_network
from logweir.operators import paging, snapshot, stats
from logweir.plans import timewindow as tw
from logweir.plans.conditions import Condition, compile_conditions
from logweir.plans.vocabulary import project, vocabulary
from logweir.sources import entities as E
from logweir.sources import logs as S

TRAFFIC = vocabulary("traffic")
# The anchor is held against this day rather than the day of the run.
TODAY = datetime(2001, 11, 10)
SHORT = ["itime", "sessionid", "srcip", "dstip", "service", "action", "sentbyte", "rcvdbyte"]
COLS = ", ".join(SHORT)


def _where(t: Tables, *conditions: Condition):
    df = t.traffic
    return compile_conditions(conditions, TRAFFIC, df).filter(df).select(*SHORT)


def _filtered(name: str, predicate: str, *conditions: Condition) -> None:
    query(name, f"SELECT {COLS} FROM traffic WHERE {predicate}", "traffic")(lambda t: _where(t, *conditions))


# --- sources -----------------------------------------------------------------


@query(
    "a1_scan_logtype",
    "WITH logs AS (SELECT 'attack' AS logtype, itime, srcip FROM attack UNION ALL "
    "SELECT 'dns', itime, srcip FROM dns UNION ALL SELECT 'event', itime, srcip FROM event) "
    "SELECT logtype, itime, srcip FROM logs WHERE logtype = 'attack'",
    "attack",
    "dns",
    "event",
)
def _(t):
    folder = t.folder()
    S.write_logs(S.union_logs({"attack": t.attack, "dns": t.dns, "event": t.event}, ["itime", "srcip"]), folder)
    return S.read_logs(t.spark, folder, "anomaly").select("logtype", "itime", "srcip")


@query(
    "a2_entity_alerts",
    "SELECT alertid, severity, status, epid FROM alert WHERE alerttime >= TIMESTAMP '1997-01-01' "
    "AND alerttime < TIMESTAMP '1998-01-01' AND lower(severity) IN ('critical', 'high')",
    "alert",
)
def _(t):
    window = tw.custom_window("1997-01-01|1997-12-31")
    wanted = [Condition("severity", "in", ["Critical", "High"])]
    return E.entities(t.alert, "alert", window=window, conditions=wanted, fields=["alertid", "severity", "status", "endpoint_id"]).df


@query("a2_entity_by_id", "SELECT epid, epname, epip FROM endpoint WHERE epid IN (3, 5, 8, 13, 21)", "endpoint")
def _(t):
    return E.entities(t.endpoint, "endpoint", ids=[3, 5, 8, 13, 21], fields=["epid", "epname", "epip"]).df


@query(
    "a3_field_catalogue",
    "SELECT unnest([{'name': 'appcat', 'type': 'string', 'filled_rows': count(appcat)}, {'name': 'app', 'type': 'string', 'filled_rows': count(app)}], "
    "recursive := true), cast(2 AS BIGINT) AS field_count, cast(20 AS BIGINT) AS total_field_count FROM traffic",
    "traffic",
)
def _(t):
    return S.field_catalogue(t.traffic, "APP", filled=True)


@query(
    "a3_nested_fields",
    "WITH n AS (SELECT count(*) FILTER (euid IS NOT NULL OR euname <> '') AS filled_rows FROM endpoint) "
    "SELECT name, type, filled_rows, cast(4 AS BIGINT) AS field_count, cast(11 AS BIGINT) AS total_field_count FROM n, (VALUES "
    "('user', 'array<struct<euid:bigint,euname:string,lastseen:string>>'), ('user.euid', 'bigint'), ('user.euname', 'string'), "
    "('user.lastseen', 'string')) f(name, type)",
    "endpoint",
)
def _(t):
    return S.field_catalogue(nested_endpoints(t.endpoint), "user", filled=True)


@query(
    "a4_freshness",
    "SELECT devid, devname, vd, min(itime) AS first_log_time, max(itime) AS last_log_time, "
    "count(*) AS log_count, cast(date_diff('second', min(itime), max(itime)) + 1 AS BIGINT) AS span_seconds, "
    "count(*) / (date_diff('second', min(itime), max(itime)) + 1) AS log_rate FROM traffic GROUP BY 1, 2, 3",
    "traffic",
)
def _(t):
    return S.freshness(t.traffic)


@query(
    "a5_detector_union",
    "SELECT detectby, severity, count(*) AS findings FROM vulnerability GROUP BY 1, 2",
    "vulnerability",
)
def _(t):
    parts = {n: E.by_detector(t.vulnerability, n).drop("detectby") for n in ("scanner", "agent")}
    return E.unite_detectors(parts).groupBy("detectby", "severity").agg(F.count(F.lit(1)).alias("findings"))


@query(
    "a7_report_history",
    "SELECT tid, title, state FROM report WHERE lower(title) LIKE '%urgent%' "
    "AND timestamp >= TIMESTAMP '1996-01-01' AND timestamp < TIMESTAMP '1997-01-01'",
    "report",
)
def _(t):
    window = tw.custom_window("1996-01-01|1996-12-31")
    return E.report_history(t.report, window, "Urgent").select("tid", "title", "state")


@query("a6_report_export", "SELECT tid, title, state FROM report", "report")
def _(t):
    rows = t.report.select("tid", "title", "state")
    folder = t.folder()
    E.export(rows, folder, "csv")
    return t.spark.read.schema(rows.schema).option("header", True).csv(folder)


# --- windows -----------------------------------------------------------------


@query(
    "b1_preset_window",
    f"SELECT {COLS} FROM traffic WHERE itime >= (SELECT max(itime) - INTERVAL 30 DAY FROM traffic)",
    "traffic",
)
def _(t):
    df = t.traffic
    return tw.resolve_window("30-day", df, TODAY).filter(df).select(*SHORT)


@query(
    "b2_custom_window",
    f"SELECT {COLS} FROM traffic WHERE itime >= TIMESTAMP '1996-03-01 00:00:00' AND itime < TIMESTAMP '1996-04-01 00:00:00'",
    "traffic",
)
def _(t):
    df = t.traffic
    return tw.custom_window("1996-03-01 00:00|1996-03-31").filter(df).select(*SHORT)


@query("b3_anchor", "SELECT max(itime) AS newest FROM event", "event")
def _(t):
    return tw.newest_log_time(t.event)


@query(
    "b5_slices",
    "SELECT cast(floor(((epoch(itime) - epoch(TIMESTAMP '1996-01-01')) + 1) * 4 / 31622400.0 - 1e-12) AS INTEGER) AS slice, "
    "count(*) AS hits FROM traffic WHERE itime >= TIMESTAMP '1996-01-01' AND itime < TIMESTAMP '1997-01-01' GROUP BY 1",
    "traffic",
)
def _(t):
    df, window = t.traffic, tw.custom_window("1996-01-01|1996-12-31")
    parts = tw.slices(window, tw.slice_count(window, 6))
    cut = window.filter(df).select(tw.slice_id(df, parts).alias("slice"))
    return cut.groupBy("slice").agg(F.count(F.lit(1)).alias("hits"))


@query(
    "b9_first_seen",
    "SELECT epid, first_seen FROM endpoint WHERE first_seen >= TIMESTAMP '1995-02-01' AND first_seen < TIMESTAMP '1996-02-01'",
    "endpoint",
)
def _(t):
    window = tw.custom_window("1995-02-01|1996-01-31")
    return E.entities(t.endpoint, "endpoint", window=window).df.select("epid", "first_seen")


# --- conditions --------------------------------------------------------------

_filtered(
    "c1_eq_range",
    "lower(service) = 'https' AND sentbyte > 20000 AND sentbyte <= 40000 AND rcvdbyte >= 1000000 "
    "AND rcvdbyte < 9000000 AND cast(dstport AS INTEGER) >= 443",
    Condition("service", "eq", "https"),
    Condition("bytes_sent", "gt", 20000),
    Condition("bytes_sent", "lte", "40000"),
    Condition("rcvdbyte", "gte", 1000000),
    Condition("rcvdbyte", "lt", 9000000),
    Condition("dst_port", "gte", 443),
)
_filtered("c2_ne", "lower(service) <> 'dns'", Condition("service", "ne", "DNS"))
query(
    "c2_ne_null",
    "SELECT sessionid, appcat FROM traffic WHERE appcat IS DISTINCT FROM 'group-3'",
    "traffic",
)(
    lambda t: compile_conditions([Condition("appcat", "ne", "Group-3")], TRAFFIC, t.traffic)
    .filter(t.traffic)
    .select("sessionid", "appcat")
)
_filtered("c3_contains", "contains(lower(service), 'icmp/')", Condition("service", "contains", "ICMP/"))


@query(
    "c4_not_contains",
    "SELECT count(*) AS total, count(*) FILTER (contains(lower(appcat), 'p-1')) AS matching, "
    "count(*) FILTER (NOT coalesce(contains(lower(appcat), 'p-1'), false)) AS complement FROM traffic",
    "traffic",
)
def _(t):
    df = t.traffic
    yes, no = (
        compile_conditions([Condition("appcat", op, "P-1")], TRAFFIC, df).column
        for op in ("contains", "not_contains")
    )
    return df.agg(
        stats.rows().alias("total"), stats.count_where(yes).alias("matching"), stats.count_where(no).alias("complement")
    )


_filtered("c5_in", "lower(action) IN ('deny', 'close')", Condition("action", "in", ["Deny", "close"]))
_filtered(
    "c6_not_in",
    "NOT coalesce(appcat IN ('group-1', 'group-2'), false) AND policyid NOT IN (1, 2)",
    Condition("appcat", "not_in", ["GROUP-1", "group-2"]),
    Condition("policy_id", "not_in", [1, 2]),
)


@query("c8_enum_code", "SELECT name, sn, conn_status FROM device WHERE conn_status = 1", "device")
def _(t):
    wanted = [Condition("connection_status", "eq", "Up")]
    return E.entities(t.device, "device", conditions=wanted, fields=["name", "serial", "conn_status"]).df


@query(
    "c11_inventory",
    "SELECT id, title, state FROM task WHERE state IN (1, 4, 5) AND NOT coalesce(contains(lower(title), 'job 1'), false)",
    "task",
)
def _(t):
    wanted = [Condition("status", "in", ["running", "done", "error"]), Condition("title", "not_contains", "JOB 1")]
    return E.entities(t.task, "task", conditions=wanted, fields=["id", "title", "state"]).df


@query(
    "c12_device_scope",
    "SELECT 'serial' AS scope, count(*) AS hits FROM traffic WHERE devid = 'FG000000000001' UNION ALL "
    "SELECT 'name', count(*) FROM traffic WHERE devname = 'fw-2' UNION ALL "
    "SELECT 'domain', count(*) FROM traffic WHERE devname = 'fw-2' AND vd = 'dmz' UNION ALL "
    "SELECT 'all', count(*) FROM traffic",
    "traffic",
)
def _(t):
    scopes = {"serial": "FG000000000001", "name": "fw-2", "domain": "fw-2[dmz]", "all": "All_Devices"}
    counted = t.traffic.agg(*(stats.count_where(P.device_scope(d)).alias(s) for s, d in scopes.items()))
    return counted.unpivot([], list(scopes), "scope", "hits")


@query(
    "c13_policy_action",
    f"SELECT {COLS} FROM traffic WHERE policyid IN (2, 5) AND lower(action) = 'accept'",
    "traffic",
)
def _(t):
    return t.traffic.where(P.policy_scope([2, 5], "Accept")).select(*SHORT)


@query(
    "c14_ips_filter",
    "SELECT itime, sessionid, attack, severity, cve FROM attack WHERE lower(severity) IN ('critical', 'high') "
    "AND contains(lower(attack), 'sig-') AND lower(action) IN ('blocked', 'dropped') AND cve <> '' AND pcapurl <> '' "
    "AND dstport = 443",
    "attack",
)
def _(t):
    df = t.attack
    wanted = P.ips_search(
        df,
        severity=["critical", "high"],
        attack_contains="SIG-",
        action=["blocked", "dropped"],
        has_cve=True,
        has_pcap=True,
        dstport=443,
    )
    return df.where(wanted).select("itime", "sessionid", "attack", "severity", "cve")


@query(
    "c15_cidr",
    f"SELECT {COLS} FROM traffic WHERE regexp_matches(srcip, '^10\\.[0-3]\\.') AND "
    "cast(split_part(srcip, '.', 3) AS INTEGER) BETWEEN 0 AND 255 AND dstip LIKE '192.168.0.%' "
    "AND cast(split_part(dstip, '.', 4) AS INTEGER) BETWEEN 64 AND 95",
    "traffic",
)
def _(t):
    inside = in_network(F.col("srcip"), "10.0.0.0/14") & in_network(F.col("dstip"), "192.168.0.64/27")
    return t.traffic.where(inside).select(*SHORT)


@query(
    "c16_indicator_pivot",
    "SELECT 'ip' AS pivot, count(*) AS hits FROM attack WHERE srcip = '10.0.7.1' UNION ALL "
    "SELECT 'domain', count(*) FROM attack WHERE lower(hostname) = 'host7' UNION ALL "
    "SELECT 'hash', count(*) FROM attack WHERE contains(checksum, md5('file7')) UNION ALL "
    "SELECT 'ttp', count(*) FROM attack WHERE contains(lower(attack), 'sig-4')",
    "attack",
)
def _(t):
    df = t.attack
    digest = hashlib.md5(b"file7").hexdigest()
    pivots = {
        "ip": P.indicator_pivot(df, indicator=("10.0.7.1", "IP")),
        "domain": P.indicator_pivot(df, indicator=("HOST7", "Domain")),
        "hash": P.indicator_pivot(df, indicator=(digest, "Hash")),
        "ttp": P.indicator_pivot(df, ttp="SIG-4"),
    }
    counted = df.agg(*(stats.count_where(c).alias(n) for n, c in pivots.items()))
    return counted.unpivot([], list(pivots), "pivot", "hits")


@query(
    "c17_identity_activity",
    "SELECT \"user\", action, subtype, itime FROM event WHERE (action = 'failure' OR subtype = 'vpn') AND lower(\"user\") = 'user3'",
    "event",
)
def _(t):
    return t.event.where(P.identity_activity("User3")).select("user", "action", "subtype", "itime")


@query(
    "c18_endpoint_match",
    "SELECT epid, epname, epip FROM endpoint WHERE contains(lower(epname), 'customer#00000000') AND epip = '10.0.5.1'",
    "endpoint",
)
def _(t):
    return t.endpoint.where(P.endpoint_match("CUSTOMER#00000000", "10.0.5.1")).select("epid", "epname", "epip")


@query(
    "c19_behavioural",
    "SELECT alertid FROM alert WHERE regexp_matches(lower(concat_ws(' ', alerttype, eventtype, triggername, name)), "
    "'botnet|compromised|ioc|beacon|c2|command-and-control|anomaly|lateral|exfil')",
    "alert",
)
def _(t):
    df = t.alert
    return df.where(P.is_behavioural(df)).select("alertid")


@query("c20_name_search", "SELECT euid, euname FROM enduser WHERE contains(lower(euname), 'user1')", "enduser")
def _(t):
    return t.enduser.where(P.name_search("euname", "USER1")).select("euid", "euname")


# --- projections and derived columns -----------------------------------------


@query(
    "d1_curated",
    "SELECT devname, srcip, dstip, dstport, proto, action, service, app, policyid, sentbyte, rcvdbyte, "
    "\"user\", sessionid, dstcountry FROM traffic",
    "traffic",
)
def _(t):
    return project(t.traffic, TRAFFIC).df


@query("d2_projection", "SELECT srcip, dstip, policyid FROM traffic", "traffic")
def _(t):
    return project(t.traffic, TRAFFIC, ["source_ip", "dest_ip", "src_ip", "policy_id", "no_such_field"]).df


@query("d3_struct_whole", "SELECT srcip, concat_ws('|', app, dstport) AS detail FROM traffic", "traffic")
def _(t):
    nested = t.traffic.select("srcip", F.struct(F.col("app"), F.col("dstport").alias("port")).alias("detail"))
    # Only whole top-level fields are selected; a part of one is refused with a warning.
    found = project(nested, TRAFFIC, ["srcip", "detail", "detail.app"])
    return found.df.select("srcip", F.concat_ws("|", "detail.app", "detail.port").alias("detail"))


@query(
    "d5_port",
    "SELECT CASE WHEN dstport <> '0' THEN concat(proto, '/', dstport) END AS port, count(*) AS hits FROM traffic GROUP BY 1",
    "traffic",
)
def _(t):
    return t.traffic.groupBy(derived.dimension(t.traffic, "port").alias("port")).agg(stats.rows().alias("hits"))


@query(
    "d6_icmp",
    "SELECT CASE WHEN upper(service) = 'PING' THEN 'type=8/code=0' WHEN regexp_full_match(service, 'icmp/[^/]*/[^/]*') "
    "THEN concat('type=', split_part(service, '/', 2), '/code=', split_part(service, '/', 3)) ELSE 'type=unknown' END "
    "AS icmp_type_code, count(*) AS hits FROM traffic WHERE proto = '1' GROUP BY 1",
    "traffic",
)
def _(t):
    label = derived.dimension(t.traffic, "icmp_type_code").alias("icmp_type_code")
    return t.traffic.select(label).where(F.col("icmp_type_code").isNotNull()).groupBy("icmp_type_code").agg(stats.rows().alias("hits"))


@query(
    "d7_bucket_norm",
    "SELECT CASE WHEN lower(trim(app)) IN ('', 'n/a', 'null', 'none', 'unknown') THEN NULL ELSE trim(app) END AS app, "
    "count(*) AS hits FROM traffic GROUP BY 1",
    "traffic",
)
def _(t):
    return t.traffic.groupBy(derived.dimension(t.traffic, "app").alias("app")).agg(stats.rows().alias("hits"))


@query(
    "d8_pcap_list",
    "SELECT sessionid AS session_id, attack, severity, action, srcip, dstip, srcport, dstport, cve, "
    "trim(concat(date, ' ', time)) AS timestamp FROM attack WHERE pcapurl <> ''",
    "attack",
)
def _(t):
    return stats.pcap_list(t.attack)


# --- pages -------------------------------------------------------------------


@query(
    "e1_page",
    f"SELECT {COLS} FROM traffic ORDER BY itime DESC, sessionid, srcip, dstip, service, action, sentbyte, rcvdbyte "
    "LIMIT 50 OFFSET 100",
    "traffic",
)
def _(t):
    return paging.page(t.traffic.select(*SHORT), limit=50, offset=100).df


@query(
    "e2_page_status",
    "SELECT count(*) AS total, cast(100 AS BIGINT) AS page_rows, count(*) > 300 AS has_more, "
    "cast(CASE WHEN count(*) > 300 THEN 300 END AS BIGINT) AS next_offset, count(*) > 300 AND count(*) >= 10000 AS high_volume FROM traffic "
    "WHERE action = 'deny'",
    "traffic",
)
def _(t):
    return paging.page_status(t.traffic.where(F.lower("action") == "deny"), limit=100, offset=200)


@query(
    "e3_drift",
    "WITH a AS (SELECT devname, count(*) AS n FROM traffic WHERE itime < TIMESTAMP '2001-01-01' GROUP BY 1), "
    "b AS (SELECT devname, count(*) AS n FROM traffic GROUP BY 1) "
    "SELECT devname, coalesce(a.n, 0) AS total, coalesce(b.n, 0) AS page_total, coalesce(b.n, 0) - coalesce(a.n, 0) AS total_delta, "
    "CASE WHEN coalesce(a.n, 0) = coalesce(b.n, 0) THEN 'stable' ELSE 'drifted' END AS stability FROM a FULL JOIN b USING (devname)",
    "traffic",
)
def _(t):
    df = t.traffic
    early = df.where(F.col("itime") < F.lit("2001-01-01").cast("timestamp_ntz"))
    return paging.count_drift(early, df, ["devname"])


def _grown(t: Tables):
    """Events as a table, the reference of a snapshot of it, and rows with old times that arrive later."""
    folder = t.folder()
    event = t.event.select("itime", "logid", "devname", "user", F.lit("event").alias("logtype"))
    S.write_logs(event, f"{folder}/event")
    asked = [Condition("action", "ne", "nothing")]
    read = lambda: compile_conditions(asked, vocabulary("event"), event).filter(S.read_logs(t.spark, f"{folder}/event", "event"))
    page, reference = snapshot.first_page(read(), folder, 25)
    last = page.collect()[-1]
    late = event.where(F.col("devname") == last["devname"]).withColumn("logid", F.concat(F.lit("late-"), "logid"))
    S.write_logs(late, f"{folder}/event")
    return read(), snapshot.cursor(last, reference), reference


@query(
    "e3_snapshot_page",
    "SELECT itime, logid, devname, \"user\" FROM event ORDER BY itime DESC, logid LIMIT 25 OFFSET 25",
    "event",
)
def _(t):
    # The second page, read after rows with the same times have arrived.
    df, cursor, _ = _grown(t)
    return snapshot.next_page(df, cursor, 25).select("itime", "logid", "devname", "user")


@query(
    "e3_snapshot_drift",
    "WITH l AS (SELECT devname FROM event ORDER BY itime DESC, logid LIMIT 1 OFFSET 24), "
    "n AS (SELECT count(*) AS total, count(*) FILTER (devname = (SELECT devname FROM l)) AS more FROM event) "
    "SELECT total, total + more AS page_total, more AS total_delta, more AS new_rows, 0::bigint AS lost_files, 'drifted' AS stability, true AS complete FROM n",
    "event",
)
def _(t):
    df, _, reference = _grown(t)
    return snapshot.drift(df, reference).select("total", "page_total", "total_delta", "new_rows", "lost_files", "stability", "complete")


@query("e4_count", "SELECT count(*) AS total FROM traffic WHERE lower(service) = 'dns'", "traffic")
def _(t):
    df = t.traffic
    return paging.total(compile_conditions([Condition("service", "eq", "dns")], TRAFFIC, df).filter(df))


@query(
    "e5_top_k",
    "SELECT srcip, count(*) AS hits FROM traffic GROUP BY 1 ORDER BY hits DESC, srcip LIMIT 25",
    "traffic",
)
def _(t):
    return paging.top_k(t.traffic.groupBy("srcip").agg(stats.rows().alias("hits")), "hits", 25).df


@query(
    "e7_mixed_time",
    "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS time_rank, "
    "CASE o_orderkey % 4 WHEN 0 THEN 0.0 WHEN 1 THEN cast(o_orderkey AS DOUBLE) ELSE epoch(o_orderdate) END AS time_epoch, "
    "CASE WHEN o_orderkey % 4 = 0 THEN 'no time' ELSE '' END AS time_text FROM orders",
)
def _(t):
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    spelled = (
        F.when(key % 4 == 0, "no time")
        .when(key % 4 == 1, key.cast("string"))
        .when(key % 4 == 2, day)
        .otherwise(F.replace(day, F.lit(" "), F.lit("T")))
    )
    mixed = t.raw("orders").select(key.alias("id"), spelled.alias("seen"))
    return mixed.select("id", *coercion.event_order(F.col("seen")))


@query(
    "e8_first_with_total",
    "SELECT euid, euname, (SELECT count(*) FROM enduser WHERE contains(euname, 'user1')) AS matched_total FROM enduser "
    "WHERE contains(euname, 'user1') ORDER BY euid LIMIT 10",
    "enduser",
)
def _(t):
    found = t.enduser.where(P.name_search("euname", "user1")).select("euid", "euname")
    first, total = paging.first_with_total(found, [F.col("euid")], 10)
    return first.withColumn("matched_total", total.scalar())
