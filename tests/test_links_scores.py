"""Correlation, scores and timelines over small frames, beside brute force."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from logweir.operators import bundles, linkage, paging, scoring, timeline
from logweir.plans import fixed_values as fv
from logweir.sources import logs

SNAPSHOT = "alertid string, severity string, name string, timestamp string"


@pytest.fixture(scope="module")
def estate(spark):
    incidents = spark.createDataFrame(
        [("I1", None, "one", "100"), ("I2", "a3, a4,", "two", "200"), ("I3", None, None, None), ("I4", "a9", "four", "2026-07-08 10:22:41")],
        "incid string, alertids string, name string, createtime string",
    )
    alerts = spark.createDataFrame(
        [("a1", "I1,I3", "high"), ("a2", None, "low"), ("a3", "I2", "critical"), ("a4", None, None), ("a5", "I2", "info")],
        "alertid string, incids string, severity string",
    )
    attachments = spark.createDataFrame(
        [
            ("I1", "alertevent", "a2", '{"alertid":"a2","name":"n","timestamp":"50"}'),
            ("I1", "alertevent", "a7", "{broken"),
            ("I1", "alertevent", "a8", '{"severity":"low"}'),
            ("I2", "note", "a5", "{}"),
            ("I9", "alertevent", "a1", "{}"),
        ],
        "incid string, attachtype string, attachsrcid string, data string",
    )
    return incidents, alerts, attachments


def test_attachments_carry_the_alert(estate):
    found = linkage.attached_alerts(estate[2], SNAPSHOT)
    assert values(found, "incid", "alertid", "alert.alertid", "alert.severity") == [
        ("I1", "a2", "a2", None),
        ("I1", "a7", "a7", None),
        ("I1", "a8", "a8", "low"),
        ("I9", "a1", "a1", None),
    ]


def test_linkage_only_where_nothing_is_attached(estate):
    assert values(linkage.correlate(*estate)) == [
        ("I1", "a2", linkage.ATTACHED),
        ("I1", "a7", linkage.ATTACHED),
        ("I1", "a8", linkage.ATTACHED),
        ("I2", "a3", "incident.alertids"),
        ("I2", "a4", "incident.alertids"),
        ("I2", "a5", "alert.incids"),
        ("I3", "a1", "alert.incids"),
    ]


def test_linkage_without_any_key(spark):
    pairs = linkage.correlate(spark.createDataFrame([("I1",)], "incid string"), spark.createDataFrame([("a1",)], "x string"), None)
    assert pairs.count() == 0


def test_incident_records_keep_every_incident(estate):
    found = linkage.incident_records(estate[0], linkage.correlate(*estate))
    assert values(found, "incid", "alert_count") == [("I1", 3), ("I2", 3), ("I3", 1), ("I4", 0)]


def test_id_sets(spark):
    df = spark.createDataFrame([("a, b,", ["x", "x"], 5), (None, None, None), ("solo", [], 7)], "t string, l array<string>, n int")
    got = df.select(*(linkage.id_set(df, [c]).alias(c) for c in ("t", "l", "n"))).collect()
    assert [tuple(map(sorted, r)) for r in got] == [(["a", "b"], ["x"], ["5"]), ([], [], []), (["solo"], [], ["7"])]
    assert df.select(linkage.id_set(df, ["no", "t"])).first()[0] == ["a", "b"]
    assert df.select(linkage.id_set(df, ["no"])).first()[0] == []


def test_entity_ids_are_whole_numbers(spark):
    df = spark.createDataFrame([(["1", "x", "3"], 9, True), (["x"], 9, False), (None, None, True)], "epids array<string>, epid int, euid boolean")
    got = df.select(linkage.entity_ids(df, ["epids", "epid"]), linkage.entity_ids(df, ["euid"])).collect()
    assert [tuple(r) for r in got] == [([1, 3], []), ([9], []), ([], [])]


def test_nested_findings_flatten(spark):
    schema = "epid int, vuln_group array<struct<vuln:array<struct<vulnid:string,severity:string>>,vulnid:string,severity:string>>, vuln array<struct<vulnid:string,severity:string>>, vulnid string, severity string"
    data = [
        (1, [([("v1", "High"), ("v2", None)], None, None), (None, "v3", "low")], None, None, None),
        (2, None, [("v4", "critical")], None, None),
        (3, None, None, "v5", "medium"),
        (None, None, None, "v6", "high"),
    ]
    flat = linkage.flat_vulnerabilities(spark.createDataFrame(data, schema))
    assert values(flat, "epid", "vulnid", "severity") == sorted(
        [(1, "v1", "High"), (1, "v2", None), (1, "v3", "low"), (2, "v4", "critical"), (3, "v5", "medium"), (None, "v6", "high")], key=repr
    )
    endpoints = spark.createDataFrame([(1,), (4,)], "epid int")
    assert values(linkage.endpoint_vulnerabilities(endpoints, flat)) == [("1", "high", 1), ("1", "low", 1), ("1", "unknown", 1), ("4", None, 0)]
    assert linkage.orphan_findings(flat).count() == 1


def test_users_match_endpoints_by_id_or_name(spark):
    users = spark.createDataFrame([(1, "Ann"), (2, ""), (3, None)], "euid int, euname string")
    listed = "epid int, user array<struct<euid:int,euname:string>>"
    endpoints = spark.createDataFrame([(10, [(1, "x"), (None, "ANN")]), (11, [(None, "ann")]), (12, [(2, "")]), (13, None)], listed)
    assert values(linkage.user_endpoints(users, endpoints)) == [(1, 10), (1, 11), (2, 12)]


def made_by(df, node):
    """Rows that the scans or generators of a plan gave, after it has run."""
    df.collect()
    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        plan = left.pop()
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(plan.executedPlan())
        elif "QueryStage" in name:
            left.append(plan.plan())
        if name.startswith(node):
            total += plan.metrics().apply("numOutputRows").value()
        left += [plan.children().apply(i) for i in range(plan.children().size())]
    return total


def test_hashes_of_any_length_are_found_once_a_row(spark):
    rng = random.Random(8)
    sums = ["".join(rng.choices("ab", k=rng.randint(0, 60))) for _ in range(300)] + ["x" * 64, "", None, "ABAB" * 9]
    wanted = {"".join(rng.choices("ab", k=n)) for n in (1, 2, 3, 5, 8, 14, 15, 16, 23)} | {"x" * 15, "x" * 64, "x" * 65, "", "md5:ü", "aB" * 8}
    indicators = spark.createDataFrame([(w, "Hash") for w in sorted(wanted)], "value string, type string")
    logs = {"attack": spark.createDataFrame([(s,) for s in sums], "checksum string")}
    found = {(r["value"], r["hits"]) for r in linkage.sweep(indicators, logs).collect()}
    want = {(w, sum(w.lower() in s.lower() for s in sums if s is not None)) for w in wanted if w}
    assert found == {(w, n) for w, n in want if n}


def test_a_checksum_gives_an_eighth_of_its_letters_as_rows(spark):
    rng = random.Random(9)
    sums = ["".join(rng.choices("0123456789abcdefxyz:", k=64)) for _ in range(500)]
    indicators = spark.createDataFrame([(sums[7][3:43], "Hash"), (sums[9][:20], "Hash")], "value string, type string")
    found = linkage._checksum_counts({"attack": spark.createDataFrame([(s,) for s in sums], "checksum string")}, indicators.select(F.lower("value").alias("seen")))
    assert made_by(found, "Generate") <= 500 * 64 / linkage.GRAM + 2 * linkage.GRAM
    assert found.count() == 2


def test_an_investigation_meets_indicators_with_the_ids_it_holds(spark, tmp_path):
    alerts = spark.createDataFrame(
        [("a1", "critical", 1, "10.0.0.1"), ("a2", "low", 2, "10.0.0.2"), ("a3", "critical", 3, None), ("a1", "critical", 1, "10.0.0.1"), (None, "critical", 4, "10.0.0.4")],
        "alertid string, severity string, epid long, epip string",
    )
    incidents = spark.createDataFrame([("I1", "high"), ("I2", "low"), (None, "low")], "incid string, severity string")
    attachments = spark.createDataFrame([("I1", "alertevent", "a1"), ("I2", "alertevent", "a2"), (None, "alertevent", "a3")], "incid string, attachtype string, attachsrcid string")
    indicators = alerts.select("alertid", F.col("epip").alias("value"), F.lit("IP").alias("type"), F.col("epid").alias("ordinal"))
    stored = spark.createDataFrame([("10.0.0.1", "10.0.0.1", "IP", "bad", "9", "done", 1, None)], "lookup string, value string, type string, reputation string, confidence string, status string, ordinal long, detail string")
    traffic = spark.createDataFrame([("a1", 1), ("a2", 2), ("a2", 3), (None, 4)], "alertid string, sessionid long")
    endpoints = alerts.select("epid", F.lit("host").alias("epname"), "epip")
    estate = bundles.Estate(alerts, incidents, attachments, endpoints, endpoints.select(F.col("epid").alias("euid")), endpoints, indicators, stored, {"traffic": traffic})
    held = []

    def keep(df):
        folder = str(tmp_path / str(len(held)))
        held.append(df.columns)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    subjects = alerts.where("severity = 'critical'")
    found, again = bundles.investigate(subjects, estate, keep=keep), bundles.investigate(subjects, estate)
    assert ["alertid"] in held and ["incid"] in held
    # What the held ids came from is not planned again beside the indicators or the incidents.
    for name in ("threat_intel.indicators", "summary.evidence_logs", "summary.incident"):
        assert "critical" not in found[name]._jdf.queryExecution().optimizedPlan().toString()
        assert values(found[name]) == values(again[name])
    assert values(found["threat_intel.indicators"], "value", "reputation") == [("10.0.0.1", "bad")]
    assert values(found["summary.evidence_logs"], "sessionid") == [(1,)]


def test_logs_are_read_once_to_be_written_by_value(spark, tmp_path, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(i):
        read.add(1)
        return f"row {i}"

    monkeypatch.setattr(logs, "SLICE", 500)
    hot = F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("a"), F.lpad((F.col("id") * 7 % 1000).cast("string"), 4, "0")))
    day = F.when(F.col("id") < 3000, F.timestamp_seconds(F.col("id"))).when(F.col("id") < 3100, F.lit("1970-01-03").cast("timestamp"))
    rows = spark.range(4000).select(hot.alias("srcip"), day.alias("itime"), F.lit("traffic").alias("logtype"), told("id").alias("msg"))
    logs.write_logs(rows, str(tmp_path / "traffic"), cluster="srcip", pivots=["srcip"])
    assert read.value == 4000
    table = logs.read_logs(spark, str(tmp_path / "traffic"), "traffic")
    assert values(table, "srcip", "itime", "msg") == values(rows, "srcip", "itime", "msg")
    # Each row is in one range of its day: six for the first day, one for the second, two for rows without a time.
    dated = rows.drop("msg").withColumns({"log_date": F.col("itime").cast("date"), "_key_srcip": F.lower("srcip")})
    ranged = logs._sliced(dated, "_key_srcip", "itime").groupBy("log_date", "_slice").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_key_srcip", "itime")).alias("low"), F.max(F.struct("_key_srcip", "itime")).alias("high"))
    found = ranged.orderBy("log_date", "_slice").collect()
    assert sum(r["n"] for r in found) == 4000 and len({r["log_date"] for r in found}) == 3
    first = [r for r in found if str(r["log_date"]) == "1970-01-01"]
    assert len(first) == min(6, int(spark.conf.get("spark.sql.shuffle.partitions"))) and max(r["n"] for r in first) < 2000
    assert all(tuple(a["high"]) < tuple(b["low"]) for a, b in zip(first, first[1:]))


def test_ten_indicators_read_few_rows_of_a_written_table(spark, tmp_path):
    rows = spark.range(400_000).select(
        F.concat(F.lit("10."), (F.col("id") % 200).cast("string"), F.lit(".0."), (F.hash("id") % 100 + 100).cast("string")).alias("srcip"),
        F.concat(F.lit("User"), (F.col("id") % 9_973).cast("string")).alias("user"),
        F.lit("2026-01-01 00:00:00").cast("timestamp_ntz").alias("itime"),
        F.lit("traffic").alias("logtype"),
    )
    small = {"parquet.block.size": str(1 << 18), "parquet.page.row.count.limit": "1000"}
    for name, value in small.items():
        spark.sparkContext._jsc.hadoopConfiguration().set(name, value)
    try:
        logs.write_logs(rows, str(tmp_path / "traffic"), cluster="srcip", pivots=["srcip", "user"])
    finally:
        for name in small:
            spark.sparkContext._jsc.hadoopConfiguration().unset(name)
    table = logs.read_logs(spark, str(tmp_path / "traffic"), "traffic", keys=True)
    asked = [r["srcip"] for r in rows.select("srcip").distinct().orderBy(F.hash("srcip")).limit(10).collect()]
    wanted = spark.createDataFrame([("IP", a) for a in asked], "kind string, seen string")
    counted = linkage.value_counts({"traffic": table}, {"IP": "srcip"}, wanted)
    want = {(r["srcip"], r["count"]) for r in rows.where(F.col("srcip").isin(asked)).groupBy("srcip").count().collect()}
    assert {(r["seen"], r["hits"]) for r in counted.collect()} == want
    assert made_by(counted, "Scan") < 400_000 / 10
    plain = logs.read_logs(spark, str(tmp_path / "traffic"), "traffic")
    assert plain.columns == ["srcip", "user", "itime", "logtype", "log_date"] and plain.count() == 400_000
    # Folded spellings meet, and a table without keys gives the same.
    users = spark.createDataFrame([("user", "user7"), ("user", "user9972")], "kind string, seen string")
    told = [sorted(tuple(r) for r in linkage.value_counts({"traffic": df}, {"user": "user"}, users).collect()) for df in (table, plain)]
    assert told[0] == told[1] and len(told[0]) == 2


def test_sweep_finds_hashes_inside_checksums(spark):
    digest = "d41d8cd98f00b204e9800998ecf8427e"
    indicators = spark.createDataFrame([("10.0.0.1", "IP"), ("WEB", "Domain"), (digest.upper(), "Hash"), ("ort", "Hash"), ("x", "asn")], "value string, type string")
    logs = {
        "attack": spark.createDataFrame([("10.0.0.1", "web", f"md5:{digest}:7"), ("10.0.0.1", None, digest), (None, "other", "short")], "srcip string, hostname string, checksum string"),
        "traffic": spark.createDataFrame([("10.0.0.1",)], "srcip string"),
    }
    found = linkage.sweep(indicators, logs)
    assert values(found, "type", "logtype", "hits") == [
        ("Domain", "attack", 1), ("Hash", "attack", 1), ("Hash", "attack", 2), ("IP", "attack", 2), ("IP", "traffic", 1)
    ]
    assert values(linkage.sweep_totals(found), "type", "total_matches") == [("Domain", 1), ("Hash", 1), ("Hash", 2), ("IP", 3)]


def test_enrichment_prefers_the_very_value(spark):
    wanted = spark.createDataFrame([("a", "ip", 1), ("A", "url", 2), ("a", "IP", 0), ("h", "hash", 3), ("", "ip", 4), ("b", "Domain", 5)], "value string, type string, n int")
    kept, skipped = linkage.canonical_indicators(wanted, "n")
    assert values(kept, "value", "type", "n") == [("A", "URL", 2), ("a", "IP", 0), ("b", "Domain", 5)]
    assert values(skipped, "n") == [(3,), (4,)]
    stored = spark.createDataFrame(
        [(2, "a", "a", "IP", "clean"), (1, "a", "other", "IP", "Malicious"), (1, "A", "www", "URL", "MALICIOUS")],
        "ordinal int, lookup string, value string, type string, reputation string",
    ).selectExpr("*", "'1' AS confidence", "'done' AS status")
    found = linkage.enrich(kept, stored)
    assert values(found, "value", "reputation") == [("A", "MALICIOUS"), ("a", "clean"), ("b", None)]
    assert tuple(scoring.malicious_count(found).first()) == (3, 1)


def test_lateral_rows_and_gaps(spark):
    endpoints = spark.createDataFrame([(1, "10.0.0.1"), (2, None)], "epid int, epip string")
    pivots = linkage.entity_pivots(endpoints, ips=spark.createDataFrame([("10.0.0.9",)], "ip string"))
    logs = spark.createDataFrame([("10.0.0.1", i) for i in range(5)] + [("10.0.0.9", 9)], "srcip string, itime int")
    assert values(linkage.lateral_counts(pivots, {"traffic": logs})) == [("endpoint", "1", "traffic", 5), ("ip", "10.0.0.9", "traffic", 1)]
    assert values(linkage.lateral_rows(pivots, logs, 2), "entity_ref", "itime") == [("1", 3), ("1", 4), ("10.0.0.9", 9)]
    assert values(linkage.pivot_gaps(pivots)) == [("endpoint", "2")]


def test_dedupe_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, n int, v string")
    assert values(paging.distinct_keep_first(df, ["k"], "n")) == [("a", 1, "y"), ("b", 3, "z")]


@pytest.mark.parametrize("pieces", [1, 4, 256])
def test_percentiles_against_brute_force(spark, pieces):
    rng = random.Random(7)
    scores = [50.0] * 200 + [round(rng.expovariate(0.1), 2) for _ in range(400)] + [None, None]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    real = sorted(s for s in scores if s is not None)
    got = {r["score"]: r["percentile"] for r in scoring.percentile_ranks(df, "score", pieces).collect()}
    assert set(got) == set(real)
    for score, rank in got.items():
        assert rank == pytest.approx(100.0 * sum(v <= score for v in real) / len(real), abs=0.0501)
    assert got[real[-1]] == 100.0


def test_one_scored_endpoint_has_no_percentile(spark):
    one = spark.createDataFrame([(1.0,), (None,)], "score double")
    assert values(scoring.percentile_ranks(one, "score")) == [(1.0, 1, None)]


def test_risk_of_the_worked_example(spark):
    vulns = [("critical",)] + [("high",)] + [("medium",)] + [("low",)]
    threats = [("Critical",), ("high",)]
    entity = spark.createDataFrame([(1,), (2,)], "epid int")
    found = scoring.risk(
        entity,
        spark.createDataFrame([(1, *v) for v in vulns], "epid int, severity string"),
        spark.createDataFrame([(1, *v) for v in threats], "epid int, severity string"),
        spark.createDataFrame([(1,)] * 4, "epid int"),
    )
    columns = ["epid", "vulnerability_score", "threat_score", "auth_score", "composite", "risk_band", "unavailable"]
    assert values(found, *columns) == [(1, 39, 35, 20, 33, "medium", ""), (2, 0, 0, 0, 0, "low", "")]


def test_scores_are_capped_and_halves_go_to_even(spark):
    entity = spark.createDataFrame([(1,), (2,), (3,)], "epid int")
    many = spark.createDataFrame([(1, "critical")] * 9, "epid int, severity string")
    # 25 % of 10 is 2.5 and of 30 is 7.5.
    failures = spark.createDataFrame([(2,)] * 2 + [(3,)] * 6, "epid int")
    found = scoring.risk(entity, many, None, failures)
    assert values(found, "epid", "vulnerability_score", "composite", "unavailable") == [(1, 100, 40, "threat"), (2, 0, 2, "threat"), (3, 0, 8, "threat")]


@pytest.mark.parametrize(("score", "label"), [(0, "low"), (24, "low"), (25, "medium"), (49, "medium"), (50, "high"), (74, "high"), (75, "critical"), (100, "critical")])
def test_bands(spark, score, label):
    assert spark.range(1).select(scoring.band(F.lit(score))).first()[0] == label


def test_endpoint_verdicts(spark):
    schema = "epid int, percentile double, population long, critical long, high long, detections long"
    data = [(1, 90.0, 40, None, None, 0), (2, 89.9, 40, 0, 2, 0), (3, None, 1, None, None, 0), (4, 10.0, 40, None, None, None), (5, 10.0, 40, None, None, 3)]
    judged = {r["epid"]: r for r in scoring.endpoint_anomaly(spark.createDataFrame(data, schema)).collect()}
    assert {e: r["anomalous"] for e, r in judged.items()} == {1: True, 2: True, 3: False, 4: False, 5: True}
    assert judged[1]["basis"][0] == "risk_score at 90.0th percentile of 40 scored endpoints (threshold 90.0) -> ANOMALOUS"
    assert judged[2]["basis"][1] == "carries serious vulnerabilities (2 high) -> ANOMALOUS"
    assert "too small to rank, 1 scored" in judged[3]["basis"][0]
    assert judged[4]["basis"][2] == "behavioural detections unavailable; that flag not applied"
    assert judged[5]["basis"][2].startswith("3 behavioural")


def test_user_verdicts(spark):
    data = [(1, "HIGH", 0), (2, "normal", 1), (3, None, 0), (4, "low", None)]
    judged = {r["euid"]: r for r in scoring.enduser_anomaly(spark.createDataFrame(data, "euid int, importance string, detections long")).collect()}
    assert {e: r["anomalous"] for e, r in judged.items()} == {1: True, 2: True, 3: False, 4: False}
    assert judged[1]["basis"][0] == "importance is 'HIGH' -> ANOMALOUS"


def test_triage_evidence(spark):
    df = spark.createDataFrame([("Critical", True, "open"), (None, None, ""), ("odd", False, None)], "severity string, acknowledged boolean, status string")
    judged = scoring.triage(df, "alert").collect()
    assert [r["priority"] for r in judged] == ["urgent", "informational", "informational"]
    assert judged[0]["basis"] == ["alert severity is 'critical' -> priority 'urgent'", "alert acknowledged: True", "alert status: 'open'"]
    assert judged[1]["basis"][0] == "alert has no severity field -> priority 'informational'"


def test_reputation_shapes(spark):
    engine = '[{"source":"VT","data":{"attributes":{"last_analysis_stats":{"malicious":3,"suspicious":1,"harmless":6}},"links":{"self":"l"}}}]'
    answer = '[{"data":{"response":[{"wf_cate":"","ioc_cate":"bot","confidence":"high","malware_name":"m","reference_url":"u"}]}}]'
    empty = '[{"data":{"links":{"self":"https://www.virustotal.com/x"}}},{"nothing":1}]'
    df = spark.createDataFrame([(1, engine), (2, answer), (3, empty), (4, "broken"), (5, None)], "id int, detail string")
    found = scoring.reputation_sources(df)
    assert values(found, "id", "source", "verdict", "confidence", "malware", "link") == [
        (1, "VT", "4/10 engines flagged", None, None, "l"),
        (2, "unknown", "bot", "high", "m", "u"),
        (3, "VirusTotal", None, None, None, "https://www.virustotal.com/x"),
    ]


def test_headline_leaves_out_what_is_missing(spark):
    df = spark.createDataFrame([("a", 2, None)], "s string, n int, m int")
    line = scoring.headline(F.col("s"), (F.col("n"), "{} endpoints"), (F.col("m"), "{} users"))
    assert df.select(line).first()[0] == "a; 2 endpoints"


def test_timeline_order_and_fallbacks(estate):
    incidents, _, attachments = estate
    attached = linkage.attached_alerts(attachments, SNAPSHOT).select("incid", "alertid", "alert.name", "alert.timestamp")
    stream = timeline.unite(timeline.incident_events(incidents), timeline.alert_events(attached, "incid"))
    told = [(r["case_id"], r["description"]) for r in timeline.ordered(stream).collect()]
    assert told == [("I1", "alert a2: n"), ("I1", "incident I1: one"), ("I2", "incident I2: two"), ("I4", "incident I4: four")]
    first = {r["case_id"]: (r["source"], r["event_count"]) for r in timeline.earliest(stream).collect()}
    assert first == {"I1": ("alert", 2), "I2": ("incident", 1), "I4": ("incident", 1)}


def test_empty_and_zero_times_fall_through(spark):
    df = spark.createDataFrame([("a", "0", "", "9"), ("b", "", None, "0")], "alertid string, timestamp string, alerttime string, createtime string")
    assert values(timeline.alert_events(df), "reference", "timestamp") == [("a", "9")]


def test_bundles_turn_failing_sections_into_gaps(spark):
    traffic = spark.createDataFrame([("g", 1, 2)], "appcat string, sentbyte long, rcvdbyte long")
    web = spark.createDataFrame([("no columns",)], "x string")
    apps = spark.createDataFrame([("a",)], "app string")
    found = bundles.app_usage(traffic, web, apps)
    assert set(found.sections) == {"top-applications", "top-cloud-applications"}
    assert set(found.gaps) == {"top-websites", "dlp"}
    assert values(found.counts()) == [("top-applications", 1), ("top-cloud-applications", 1)]
    with pytest.raises(bundles.SubjectMissing):
        bundles.app_usage(web, web, web)
    with pytest.raises(bundles.SubjectMissing):
        bundles.risk_assessment(web, None, None, traffic)


def test_sweep_covers_every_log_type(spark):
    logs = {f"t{i}": spark.createDataFrame([("10.0.0.1",)], "srcip string") for i in range(7)}
    found = bundles.hunt_indicators(spark.createDataFrame([("10.0.0.1", "IP")], "value string, type string"), logs)
    assert values(found["headline"], "headline") == [("indicator 10.0.0.1; sweep: 7 matches across 7 searches",)]


def test_markers_match_case_insensitively(spark):
    from logweir.functions.predicates import is_behavioural

    df = spark.createDataFrame([("Default-BOTNET-x", None), ("x", "C2 seen"), ("plain", "y")], "alerttype string, name string")
    assert [r[0] for r in df.select(is_behavioural(df)).collect()] == [True, True, False]
    assert len(fv.BEHAVIOUR_MARKERS) == 9
