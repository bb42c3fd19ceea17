import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import TABLES, compare
from logweir.llm.queries import ORACLES, QUERIES


def test_all_thirteen_and_the_pipeline_are_registered():
    names = contract.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, small, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    ok, told = compare(con, QUERIES[name](spark, small), ORACLES[name])
    assert ok, told


def test_the_native_query_runs_no_python(spark, small):
    plan = QUERIES["op6_decontamination"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
