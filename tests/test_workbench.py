"""The analyst's questions over the test tables."""

from datetime import datetime

import pytest
from conftest import values
from pyspark.sql import functions as F

from logweir.catalog.registry import Tables
from logweir.catalog.views import nested_endpoints, nested_vulnerabilities
from logweir.functions.tokens import Tokenizer
from logweir.plans.errors import NoExactView, PlanError
from logweir.workbench import Workbench


@pytest.fixture(scope="module")
def bench(spark, small):
    t = Tables(spark, small)
    ruled = t.handler.withColumn("rule", F.sequence(F.lit(0), F.col("rules").cast("int")))
    names = "traffic event attack dns alert incident attachment enduser indicator enrichment device task report".split()
    tables = {n: getattr(t, n) for n in names}
    tables |= {
        "endpoint": nested_endpoints(t.endpoint),
        "vulnerability": nested_vulnerabilities(t.vulnerability),
        "basic_rule": ruled.where("is_basic"),
        "correlation_rule": ruled.where("NOT is_basic"),
    }
    return Workbench(tables, now=datetime(2001, 11, 20))


def test_rows(bench):
    found = bench.query_logs("traffic", [("service", "eq", "dns")], limit=5, fields=["srcip", "service"])
    assert found.df.columns == ["srcip", "service"] and found.df.count() == 5
    page = found.meta["page"].first()
    assert page["has_more"] and page["next_offset"] == 5
    assert found.mode == "rows" and found.window is None


def test_window_is_on_the_datas_clock(bench):
    found = bench.query_logs("traffic", time_range="7-day", count_only=True)
    newest = bench.table("traffic").agg(F.max("itime")).first()[0]
    assert found.window.end == newest and found.window.source == "newest_log"
    assert 0 < found.df.first()[0] < bench.table("traffic").count()


def test_groups(bench):
    exact = bench.query_logs("traffic", group_by="source_ip", limit=3, strict=True)
    assert exact.df.columns[0] == "srcip" and "bandwidth" in exact.df.columns and exact.df.count() == 3
    assert exact.meta["groups"].first()["groups_truncated"]
    free = bench.query_logs("traffic", group_by="service")
    assert sum(r["hits"] for r in free.df.collect()) == bench.table("traffic").count()
    with pytest.raises(NoExactView):
        bench.query_logs("traffic", group_by="service", strict=True)


def test_breakdowns_add_up(bench):
    found = bench.query_logs("traffic", sample_by=["proto", "icmp_type_code", "app"], top_n=0)
    total = bench.table("traffic").count()
    for row in found.meta["residuals"].collect():
        assert row["excluded_rows"] + row["hits_total"] == total
        assert row["hits_shown"] <= row["hits_total"]
    hits = {(r["dimension"], r["value"]): r["hits"] for r in found.df.collect()}
    assert sum(h for (d, _), h in hits.items() if d == "icmp_type_code") == hits[("proto", "1")]


def test_bounded_sample(bench):
    found = bench.query_logs("traffic", time_range="1996-01-01|1996-12-31", sample_by=["service"], sample_limit=20)
    proof = found.meta["proof"].first()
    assert not proof["is_exact"] and proof["observed_hits"] == 20
    assert sum(r["hits"] for r in found.df.collect()) == 20


def test_modes_exclude_each_other(bench):
    for wrong in ({"group_by": "srcip", "count_only": True}, {"filters": [("a", "eq", 1)], "where": F.lit(True)}, {"logtype": "utm"}):
        with pytest.raises(PlanError):
            bench.query_logs(**{"logtype": "traffic", **wrong})


def test_views_and_policies(bench):
    assert bench.view("top-threats", limit=5).df.count() == 5
    assert bench.view("policy-hits", filters=[("policyid", "eq", 2)]).df.count() == 1
    found = bench.policy_traffic([1, 2], "1996-01-01|1996-12-31")
    assert {r["policyid"] for r in found.df.collect()} == {1, 2}
    assert {r["analysis_mode"] for r in found.meta["summary"].collect()} == {"complete"}
    with pytest.raises(PlanError):
        bench.view("top-everything")


def test_drift(bench):
    later = bench.table("traffic")
    first = later.where(F.col("itime") < F.lit("2001-01-01").cast("timestamp_ntz"))
    moved = bench.fetch_more_logs(first, later, 10, 10).meta["drift"].first()
    assert moved["stability"] == "drifted" and moved["total_delta"] == later.count() - first.count()


def test_entities(bench):
    found = bench.entities("alert", filters=[("severity", "eq", "CRITICAL")], limit=7)
    assert found.df.count() == 7 and "alertid" in found.df.columns
    assert found.meta["total"].first()[0] > 7
    up = bench.entities("device", filters=[{"field": "connection_status", "value": "up"}], fields=["name", "conn_status"])
    assert {r["conn_status"] for r in up.df.collect()} == {1}
    assert bench.entities("endpoint", ids=[1, 2]).df.count() == 2


def test_statistics(bench):
    assert bench.alert_count().first()["total"] == bench.table("alert").count()
    assert sum(r["alerts"] for r in bench.alert_counts("severity").collect()) == bench.table("alert").count()
    assert bench.incident_count(filters=[("status", "eq", "open")]).first()[0] > 0
    assert {r["item"] for r in bench.incident_stats().collect()} == {"total", "severity", "status"}
    assert bench.alert_incident_stats().count() > 0
    assert {r["handler_class"] for r in bench.alert_rules().collect()} == {"basic", "correlation"}
    assert bench.endpoint_stats("1995-01-01|1995-12-31").first()["new"] > 0
    assert bench.enduser_stats("2024-01-01|2024-12-31").first()["total_count"] > 0
    assert bench.report_history("1996-01-01|1996-12-31", "urgent").count() > 0


def test_the_rest_of_the_questions(bench):
    assert bench.log_stats().count() == 8
    assert bench.log_fields("traffic", "port").first()["name"] == "dstport"
    assert bench.search_ips_logs(severity=["critical"], has_pcap=True, limit=3).df.count() <= 3
    assert bench.list_pcaps(severity=["high"]).columns[0] == "session_id"
    assert bench.endpoint_vulnerabilities([1, 2], "Agent").select("epid").distinct().count() <= 2
    assert bench.indicator_enrichment().count() > 0
    one = bench.table("alert").first()["alertid"]
    assert bench.alert_logs([one], limit=2).count() <= 2


def test_masked_answers(bench, spark):
    found = bench.query_logs("traffic", limit=5, fields=["srcip", "user", "service"])
    hidden = found.masked(Tokenizer.of(spark, b"k"))
    assert all(r["srcip"].startswith("ip-") and r["user"].startswith("user-") for r in hidden.df.collect())
    assert values(hidden.df, "service") == values(found.df, "service")
