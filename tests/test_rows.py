"""Conditions, derived columns, projections and pages over small frames."""

import ipaddress

import pytest
from conftest import values
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweir.functions import coercion, derived
from logweir.functions import predicates as P
from logweir.functions.net import in_network
from logweir.operators import breakdown, paging, snapshot, stats
from logweir.plans import timewindow as tw
from logweir.plans.conditions import OPS, Condition, compile_conditions
from logweir.plans.errors import PlanError
from logweir.plans.vocabulary import project, vocabulary
from logweir.sources import entities as E
from logweir.sources import logs as S

TRAFFIC = vocabulary("traffic")


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (1, "HTTPS", "443", 10, "10.0.0.1", "accept"),
        (2, "http", "80", 200, "10.0.0.2", "deny"),
        (3, None, "9", None, None, None),
        (4, "icmp/3/3", "0", 5, "10.0.1.1", "Deny"),
        (5, "100%_x", "x", 7, "192.168.0.1", "close"),
    ]
    return spark.createDataFrame(data, "policyid int, service string, dstport string, sentbyte long, srcip string, action string")


def matched(rows, field, op, value, **more):
    found = compile_conditions([Condition(field, op, value)], TRAFFIC, rows, **more)
    return [r[0] for r in found.filter(rows).select("policyid").orderBy("policyid").collect()]


@pytest.mark.parametrize(
    ("field", "op", "value", "ids"),
    [
        ("service", "eq", "https", [1]),
        ("service", "ne", "HTTP", [1, 3, 4, 5]),
        ("service", "contains", "TTP", [1, 2]),
        ("service", "not_contains", "ttp", [3, 4, 5]),
        ("service", "contains", "%_", [5]),
        ("service", "in", ["HTTP", "https"], [1, 2]),
        ("service", "not_in", ["HTTP", "https"], [3, 4, 5]),
        ("dst_port", "gt", 9, [1, 2]),
        ("dst_port", "lt", "81", [2, 3, 4]),
        ("dst_port", "eq", 443, [1]),
        ("bytes_sent", "gte", "10", [1, 2]),
        ("sentbyte", "ne", 10, [2, 3, 4, 5]),
        ("sentbyte", "eq", "many", []),
        ("sentbyte", "not_in", [10, 200], [3, 4, 5]),
        ("action", "eq", "DENY", [2, 4]),
        ("source_ip", "eq", "10.0.0.2", [2]),
        ("nosuch", "eq", 1, []),
        ("nosuch", "ne", 1, [1, 2, 3, 4, 5]),
    ],
)
def test_conditions(rows, field, op, value, ids):
    assert matched(rows, field, op, value) == ids


def test_case_sensitive_on_request(rows):
    assert matched(rows, "service", "eq", "https", case_sensitive=True) == []


@pytest.mark.parametrize(
    ("op", "value"),
    [("eq", [1]), ("in", 1), ("in", []), ("eq", True), ("in", [1, True]), ("like", "x"), ("gt", "x")],
)
def test_wrong_values_are_errors(rows, op, value):
    with pytest.raises(PlanError):
        compile_conditions([Condition("sentbyte", op, value)], TRAFFIC, rows)


def test_substring_of_a_code_is_refused(spark):
    tasks = spark.createDataFrame([(1, 1), (2, 10)], "id int, state int")
    task = vocabulary("task")
    with pytest.raises(PlanError, match="holds codes"):
        compile_conditions([Condition("status", "contains", "run")], task, tasks)
    found = compile_conditions([Condition("status", "eq", "running")], task, tasks).filter(tasks)
    assert values(found, "id") == [(1,)]


def test_warnings_only_for_exact_ops(rows):
    warned = compile_conditions([Condition("action", "eq", "denied")], TRAFFIC, rows).warnings
    quiet = compile_conditions([Condition("action", "contains", "den")], TRAFFIC, rows).warnings
    assert len(warned) == 1 and quiet == ()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(needle=st.text("aHtP/%_.0", max_size=4))
def test_contains_and_its_complement_make_the_whole(rows, needle):
    assert len(matched(rows, "service", "contains", needle)) + len(matched(rows, "service", "not_contains", needle)) == 5


def test_address_predicates_reach_the_scan(spark, tmp_path, rows):
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    found = compile_conditions([Condition("srcip", "eq", "10.0.0.1")], TRAFFIC, stored).filter(stored)
    assert "EqualTo(srcip,10.0.0.1)" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("network", ["10.0.0.0/8", "10.0.0.0/23", "10.1.2.3", "10.1.2.3/32", "0.0.0.0/0", "192.168.7.128/25", "128.0.0.0/1"])
def test_networks_against_brute_force(spark, network):
    seen = ["10.0.0.1", "10.0.1.255", "10.0.2.0", "10.1.2.3", "192.168.7.127", "192.168.7.128", "9.255.255.255", "200.1.1.1", "10.0.0.999", "x", "", "10.0.0", "fe80::1"]
    df = spark.createDataFrame([(s,) for s in seen], "ip string")

    def inside(text):
        try:
            return ipaddress.ip_address(text) in ipaddress.ip_network(network)
        except ValueError:
            return False

    assert values(df.where(in_network(F.col("ip"), network))) == sorted((s,) for s in seen if inside(s))


def test_network_errors():
    for wrong in ("10.0.0.0/40", "host", "fe80::/200"):
        with pytest.raises(PlanError):
            in_network(F.lit("10.0.0.1"), wrong)


@pytest.mark.parametrize(
    ("proto", "service", "label"),
    [
        ("1", "PING", "type=8/code=0"),
        ("1", " ping ", "type=8/code=0"),
        ("1", "icmp/3/3", "type=3/code=3"),
        ("1", "ICMP/3/3", "type=3/code=3"),
        ("1", "icmp/9", "type=unknown"),
        ("1", "DNS", "type=unknown"),
        ("1", "", "type=unknown"),
        ("1", None, "type=unknown"),
        ("6", "PING", None),
        (None, "PING", None),
    ],
)
def test_icmp_labels(spark, proto, service, label):
    df = spark.createDataFrame([(proto, service)], "proto string, service string")
    assert df.select(derived.dimension(df, "icmp_type_code")).first()[0] == label


@pytest.mark.parametrize(
    ("proto", "dstport", "label"),
    [("6", "443", "6/443"), (" 6 ", " 443 ", "6/443"), ("1", "0", None), ("6", "", None), (None, "1", None), ("6", None, None)],
)
def test_port_labels(spark, proto, dstport, label):
    df = spark.createDataFrame([(proto, dstport)], "proto string, dstport string")
    assert df.select(derived.dimension(df, "port")).first()[0] == label


def test_bucket_labels(spark):
    df = spark.createDataFrame([(" a ", 1, [1], (1,)), ("N/A", 0, [], (2,)), ("None", None, None, None)], "s string, n int, l array<int>, t struct<x:int>")
    labels = [derived.dimension(df, c).alias(c) for c in ("s", "n", "l", "t", "absent")]
    assert [tuple(r) for r in df.select(*labels).collect()] == [
        ("a", "1", None, None, None),
        (None, "0", None, None, None),
        (None, None, None, None, None),
    ]


def test_breakdown_and_residuals(spark):
    data = [("6", "443", "a", "HTTPS"), ("6", "443", "b", "HTTPS"), ("6", "80", "N/A", "HTTP"), ("1", "0", None, "PING")]
    df = spark.createDataFrame(data, "proto string, dstport string, app string, service string")
    found = breakdown.breakdowns(df, TRAFFIC, ["port", "service", "application", "icmp_type_code"], 1)
    assert values(found.buckets, "dimension", "value", "hits") == [
        ("app", "a", 1),
        ("icmp_type_code", "type=8/code=0", 1),
        ("port", "6/443", 2),
        ("service", "HTTPS", 2),
    ]
    columns = ["dimension", "excluded_rows", "distinct_values", "buckets_truncated", "hits_shown", "hits_total"]
    assert values(found.residuals, *columns) == [
        ("app", 2, 2, True, 1, 2),
        ("icmp_type_code", 3, 1, False, 1, 1),
        ("port", 1, 2, True, 2, 3),
        ("service", 0, 3, True, 2, 4),
    ]
    everything = breakdown.breakdowns(df, TRAFFIC, ["service"], 0)
    assert everything.buckets.count() == 3
    assert values(everything.residuals, "hits_shown", "buckets_truncated") == [(4, False)]


def test_unknown_dimension_warns_in_breakdowns_and_fails_for_policies(spark):
    df = spark.createDataFrame([(1, "x")], "policyid int, service string").withColumn("itime", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    found = breakdown.breakdowns(df, TRAFFIC, ["odd_field"], 5)
    assert len(found.warnings) == 1 and values(found.residuals, "excluded_rows", "hits_total") == [(1, 0)]
    with pytest.raises(PlanError):
        breakdown.policy_traffic(df, TRAFFIC, tw.custom_window("2026-01-01|2026-01-01"), [1], ["odd_field"])


def test_a_full_slice_counts_as_cut(spark):
    df = spark.range(10).select(F.lit("2026-01-01 10:00:00").cast("timestamp_ntz").alias("itime"), "id")
    parts = [tw.custom_window("2026-01-01|2026-01-01")]
    full = breakdown.sample_proof(df, 10, parts).first()
    spare = breakdown.sample_proof(df, 11, parts).first()
    assert (full["is_exact"], full["truncated_slices"], full["observed_hits"]) == (False, 1, 10)
    assert (spare["is_exact"], spare["total_hits"]) == (True, 10)


def test_projection(rows):
    shown = project(rows, TRAFFIC)
    assert shown.df.columns == ["srcip", "dstport", "action", "service", "policyid", "sentbyte"]
    assert shown.fields_returned == sorted(shown.df.columns)
    named = project(rows, TRAFFIC, ["source_ip", "srcip", "nosuch"])
    assert named.df.columns == ["srcip"] and len(named.warnings) == 2
    assert project(rows, TRAFFIC, ["*"]).df.columns == rows.columns
    for wrong in ([], ["*", "srcip"]):
        with pytest.raises(PlanError):
            project(rows, TRAFFIC, wrong)
    full = project(rows, vocabulary("report"))
    assert full.df.columns == rows.columns and full.warnings


def test_pages(spark):
    df = spark.range(25).select((F.lit(1000) + F.col("id") % 5).alias("itime"), "id")
    page = paging.page(df, 10, 5)
    assert [tuple(r) for r in page.df.collect()][:2] == [(1003, 3), (1003, 8)]
    assert paging.page(df, 5000).limit == 5000 and paging.page(df, 0).warnings and paging.page(df, None).df.count() == df.count()
    with pytest.raises(PlanError):
        paging.page(df, 1, -1)
    assert tuple(paging.page_status(df, 10, 20).first()) == (25, 5, False, None, False)
    assert tuple(paging.page_status(df, 10, 0).first()) == (25, 10, True, 10, False)


@pytest.mark.parametrize("n", [3, 1500])
def test_first_per_group_with_a_hot_key(spark, n):
    # One key holds most rows; both ways of cutting must agree with a plain sort.
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"), "id")
    kept = paging.first_per_group(df.repartition(4), ["k"], [F.col("id").desc()], n)
    found = {}
    for r in kept.collect():
        found.setdefault(r["k"], []).append(r["id"])
    expected = {}
    for i in reversed(range(6000)):
        expected.setdefault("hot" if i % 3 == 0 else str(i % 50), []).append(i)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v[:n]) for k, v in expected.items()}


def test_times_in_any_spelling_sort_together(spark):
    seen = ["2026-07-08 10:22:41", "1704067300", "later", "2026-07-08T10:22:40", "0", "about"]
    df = spark.createDataFrame([(s,) for s in seen], "t string")
    assert [r[0] for r in paging.by_event_time(df, "t").collect()] == ["0", "1704067300", "2026-07-08T10:22:40", "2026-07-08 10:22:41", "about", "later"]


def test_numbers_in_any_spelling(spark):
    df = spark.createDataFrame([("7",), (" -3 ",), ("1.5",), ("x",), (None,), ("1e3",), ("inf",), ("nan",)], "v string")
    got = [tuple(r) for r in df.select(coercion.as_int(F.col("v")), coercion.as_float(F.col("v")), coercion.as_finite(F.col("v"))).collect()]
    assert [g[0] for g in got] == [7, -3, None, None, None, None, None, None]
    assert [g[2] for g in got] == [7.0, -3.0, 1.5, None, None, 1000.0, None, None]


def test_window_counts_the_last_second_in_full(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00.999",), ("2026-01-01 10:00:01",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("itime"))
    window = tw.custom_window("2026-01-01 09:00:00|2026-01-01 10:00:00")
    assert window.filter(df).count() == 1
    epochs = spark.createDataFrame([(1767261600,), (1767261601,)], "itime long")
    assert window.filter(epochs).count() == 1


def test_device_scopes(spark):
    df = spark.createDataFrame([("FG100FTK19001333", "hq", "root"), ("FG200FTK19001333", "hq", "dmz")], "devid string, devname string, vd string")
    for device, count in (("FG100FTK19001333", 1), ("hq", 2), ("hq[dmz]", 1), ("All_Anything", 2), (None, 2), ("FGT-HQ-01", 0)):
        assert df.where(P.device_scope(device)).count() == count


def test_policy_scope_checks():
    for wrong in ([], [0], [True]):
        with pytest.raises(PlanError):
            P.policy_scope(wrong)
    with pytest.raises(PlanError):
        P.policy_scope([1], "denied")


def test_indicator_pivot_prefers_the_callers_condition(spark):
    df = spark.createDataFrame([("10.0.0.1", "sig")], "srcip string, attack string")
    assert df.where(P.indicator_pivot(df, condition=F.col("srcip") == "x", ttp="sig")).count() == 0
    assert df.where(P.indicator_pivot(df, indicator=("h", "Domain"))).count() == 0
    assert P.indicator_pivot(df) is None


def test_freshness_and_catalogue(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "devid string, s int").withColumn("itime", F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)"))
    row = S.freshness(df).first()
    assert (row["log_count"], row["span_seconds"], row["log_rate"]) == (2, 2, 1.0)
    nested = spark.createDataFrame([], "a int, t array<struct<name:string,value:string>>, s struct<name:string>")
    found = S.field_catalogue(nested, "NAME")
    assert values(found, "name", "field_count", "total_field_count") == [("s.name", 2, 6), ("t.name", 2, 6)]


def test_logs_by_partition(spark, tmp_path):
    df = spark.createDataFrame([("traffic", "2026-01-01 10:00:00"), ("traffic", "2026-01-05 10:00:00"), ("dns", "2026-01-01 10:00:00")], "logtype string, t string")
    logs = df.select("logtype", F.col("t").cast("timestamp_ntz").alias("itime"))
    S.write_logs(logs, str(tmp_path / "logs"))
    window = tw.custom_window("2026-01-01|2026-01-02")
    found = S.read_logs(spark, str(tmp_path / "logs"), "traffic", window)
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(logtype" in plan and "date" in plan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "xml"])
def test_report_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    path = str(tmp_path / fmt)
    E.export(df, path, fmt)
    reader = spark.read.schema(df.schema)
    back = {"csv": lambda: reader.option("header", True).csv(path), "json": lambda: reader.json(path), "parquet": lambda: reader.parquet(path), "xml": lambda: reader.option("rowTag", "row").xml(path)}[fmt]()
    assert values(back, "id", "name") == [(1, "a"), (2, "b")]


def test_statistics_refuse_strangers(spark):
    df = spark.createDataFrame([("high",)], "severity string")
    for call in (
        lambda: stats.alert_counts(df, "colour"),
        lambda: stats.incident_stats(df, ["colour"]),
        lambda: stats.group_counts(df, "alert", "category"),
        lambda: stats.time_bucket(df, "severity", "day"),
    ):
        with pytest.raises(PlanError):
            call()


def test_vulnerability_counters_from_structs_and_maps(spark):
    as_struct = spark.createDataFrame([(1, (2, 0, "x"))], "epid int, vuln_stats struct<cnt_cri:int,cnt_hig:int,scan_time:string>")
    as_map = spark.createDataFrame([(1, {"cnt_cri": "2", "cnt_odd": "4", "cnt_low": "-1"})], "epid int, vuln_stats map<string,string>")
    assert values(stats.vulnerability_counters(as_struct)) == [(1, "critical", 2)]
    assert values(stats.vulnerability_counters(as_map)) == [(1, "cnt_odd", 4), (1, "critical", 2)]


def test_ipv6_networks_whatever_the_spelling(spark):
    import ipaddress

    from logweir.functions.net import in_network

    seen = ["fe80::1", "FE80:0:0:0:0:0:0:1", "fe80::1%eth0", "::1", "::", "2001:db8::ffff", "2001:db8:0:1::5", "::ffff:10.0.0.1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "10.0.0.1", "x:y", "1::2::3", ":1", "12345::", None, ""]
    df = spark.createDataFrame([(s,) for s in seen], "a string")
    for network in ("fe80::/10", "2001:db8::/64", "::/0", "::ffff:a00:1", "fe80::1", "1:2:3:4:5:6:7:0/113", "::1/128"):
        wanted = ipaddress.ip_network(network)

        def inside(text):
            try:
                return text is not None and ipaddress.ip_address(text.split("%")[0]) in wanted
            except (ValueError, TypeError):
                return False

        got = {r["a"] for r in df.where(in_network(F.col("a"), network)).collect()}
        assert got == {s for s in seen if inside(s)}, network


def test_pages_by_cursor_equal_pages_by_offset(spark):
    rows = [(None if i % 9 == 0 else 100 + i % 4, None if i % 7 == 0 else f"id{i:03d}" if i % 7 != 1 else f"id{i:03d}") for i in range(60)]
    df = spark.createDataFrame(sorted(set(rows), key=repr), "itime long, logid string")
    seen, cursor = [], None
    while True:
        page = paging.page_after(df, cursor, 7).collect()
        if not page:
            break
        seen += [tuple(r) for r in page]
        cursor = paging.cursor_of(page[-1])
    assert len(seen) == df.count() and len(set(seen)) == len(seen)
    assert [s[0] for s in seen if s[0] is not None] == sorted((s[0] for s in seen if s[0] is not None), reverse=True)
    plan = paging.page_after(df, {"itime": 102, "logid": "id001"}, 7)._jdf.queryExecution().optimizedPlan().toString()
    assert "<= 102" in plan


def test_logs_are_written_from_epochs_and_keep_their_own_date(spark, tmp_path):
    logs = spark.createDataFrame([("traffic", 1767225600, "own"), ("traffic", 1767312000, "text")], "logtype string, itime long, date string")
    S.write_logs(logs, str(tmp_path / "epoch"))
    window = tw.custom_window("2026-01-01|2026-01-01")
    assert [r["date"] for r in S.read_logs(spark, str(tmp_path / "epoch"), "traffic", window).collect()] == ["own"]
    S.write_logs(logs.withColumn("itime", F.col("itime").cast("string")), str(tmp_path / "text"))
    assert sorted(str(r["log_date"]) for r in spark.read.parquet(str(tmp_path / "text")).collect()) == ["2026-01-01", "2026-01-02"]
    bare = str(tmp_path / "bare")
    logs.drop("logtype").write.parquet(bare)
    with pytest.raises(PlanError):
        S.read_logs(spark, bare, "traffic")
    logs.drop("logtype").write.parquet(str(tmp_path / "traffic"))
    assert S.read_logs(spark, str(tmp_path / "traffic"), "traffic").count() == 2


def test_pages_of_a_snapshot_stay_while_rows_arrive_and_files_go(spark, tmp_path):
    def put(first, count, day):
        rows = spark.range(first, first + count).select(F.concat(F.lit("id"), F.col("id").cast("string")).alias("logid"), (F.col("id") % 50).cast("int").alias("s"))
        rows.withColumn("itime", F.expr(f"timestamp_ntz'2026-01-{day:02d} 00:00:00' + make_dt_interval(0, 0, 0, s)")).withColumn("logtype", F.lit("dns")).repartition(2).write.mode("append").parquet(str(tmp_path / "dns"))

    put(0, 200, 5)
    put(200, 100, 6)
    read = lambda: S.read_logs(spark, str(tmp_path / "dns"), "dns").where("s <> 7")
    want = [tuple(r) for r in read().orderBy(F.desc("itime"), "logid").collect()]
    page, reference = snapshot.first_page(read(), str(tmp_path / "store"), 70)
    got, rows = [], page.collect()
    while rows:
        got += [tuple(r) for r in rows]
        put(1000 + len(got), 60, 6)  # among the times of pages still to come
        rows = snapshot.next_page(read(), snapshot.cursor(rows[-1], reference), 70).collect()
    assert got == want
    told = snapshot.drift(read(), reference).first()
    assert (told["total"], told["lost_rows"], told["stability"], told["complete"]) == (len(want), 0, "drifted", True)
    assert told["page_total"] == read().count() and told["new_rows"] == told["total_delta"] > 0
    assert snapshot.total(spark, reference).first()[0] == len(want)
    # A file of the manifest is gone: said, not hidden.
    gone = sorted((tmp_path / "dns").glob("part-*.parquet"), key=lambda p: p.stat().st_mtime)[0]
    gone.unlink()
    told = snapshot.drift(read(), reference).first()
    assert not told["complete"] and told["lost_files"] == 1 and told["lost_rows"] > 0


def test_a_snapshot_of_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], "itime timestamp_ntz, logid string, file_path string, _here int, _there string, rows int")
    empty.write.parquet(str(tmp_path / "t"))
    page, reference = snapshot.first_page(spark.read.parquet(str(tmp_path / "t")), str(tmp_path / "store"), 5)
    assert page.count() == 0 and snapshot.total(spark, reference).first()[0] == 0
    assert snapshot.drift(spark.read.parquet(str(tmp_path / "t")), reference).first()["stability"] == "stable"
