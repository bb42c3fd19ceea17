"""Every registered query beside its SQL twin, and the shape of its plan."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare
from logweir.catalog import ORACLES, QUERIES


# Two have no query of their own: i2 runs inside e6, f7 and h5, s3 is a5.
OPERATORS = (
    "a1 a2 a3 a4 a5 a6 a7 b1 b2 b3 b5 b9 c1 c2 c3 c4 c5 c6 c8 c11 c12 c13 c14 c15 c16 c17 c18 c19 c20 d1 d2 d3 d5 d6 d7 d8 "
    "e1 e2 e3 e4 e5 e6 e7 e8 f1 f5 f6 f7 f8 f9 f10 f11 f12 f13 f14 f15 f16 f17 f18 f19 f20 f21 f22 f23 f24 f25 f26 f27 f28 "
    "f29 f30 h1 h2 h3 h4 h5 h6 h7 h8 h9 h10 h11 h12 h13 i1 i3 s1 s2 s4 j1 j2 j3 j4 j5 j6 j7 k1 k2 l1 l2 l3 l4 l5 l6 l7 l8 l9 "
    "l10 l11 l12 l13 l14 m1 m2 n1 n2 n3 n4 n5 n6 n7 n8 n9 n10 n11 n12 n13 n14 n15 n16"
).split()


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, small, oracle, name):
    df = QUERIES[name](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas", plan)
    ok, told = compare(oracle, df, ORACLES.get(name))
    assert ok, told


def test_every_operator_has_a_query():
    covered = {name.split("_")[0] for name in QUERIES}
    assert [o for o in OPERATORS if o not in covered] == []


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["h3_linkage_fallback", "h5_alert_logs", "h8_indicator_sweep", "h9_lateral", "j1_risk", "k2_root_cause", "l11_unmask"])
def test_results_hold_without_broadcasts(spark, small, oracle, name):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ok, told = compare(oracle, QUERIES[name](spark, small), ORACLES.get(name))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert ok, told


@pytest.mark.parametrize("name", ["f12_top_threats", "f9_top_sources", "f16_policy_line", "h8_indicator_sweep", "h9_lateral", "f21_time_buckets"])
def test_logs_are_not_sorted_to_be_aggregated(spark, small, name):
    plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    # A text maximum may sort the few groups that a hash aggregation has made, never the rows of a scan.
    assert plan.count("HashAggregate") >= plan.count("SortAggregate"), name
    if name != "f12_top_threats":
        assert "SortAggregate" not in plan


def test_sweeps_filter_before_they_shuffle(spark, small):
    plan = QUERIES["h8_indicator_sweep"](spark, small)._jdf.queryExecution().executedPlan().toString()
    counted = plan.index("partial_count")
    assert "LeftSemi" in plan[counted:]


def test_windows_reach_the_scan(spark, small):
    plan = QUERIES["f9_top_sources"](spark, small)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(l_shipdate" in pushed and "LessThan(l_shipdate" in pushed and "l_linenumber" in pushed
    assert "l_tax" not in plan and "l_discount" not in plan


def test_top_n_is_cut_before_the_shuffle(spark, small):
    for name in ("e6_topn", "f5_breakdowns", "f7_bounded_sample", "h5_alert_logs"):
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan and "WindowGroupLimit" in plan, name


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from logweir.catalog.registry import Tables
    from logweir.plans.errors import PlanError

    def session(master, named=None):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=lambda *_: named, set=lambda *_: None))

    with pytest.raises(PlanError):
        Tables(session("spark://host:7077"), "").folder()
    assert Tables(session("spark://host:7077", "file:///shared/"), "").folder().startswith("file:///shared/run-")
    assert Tables(session("local[2]"), "").folder()
