import datetime as dt
import json
import os
import subprocess
import sys

import __spark_entry__ as contract
import duckdb
import pytest
from millrace.plans.wiring import lineitem_summary
from millrace.sources import SCHEMAS

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# The queries of the subpackage llm have tests of their own.
OWN = sorted(q for q in contract.queries() if not q.startswith("op") and q != "pipeline")
# Queries that SQL cannot express; none so far.
WITHOUT_SQL: set[str] = set()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
    "BOOLEAN": "boolean",
}


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted([tuple(r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_oracle(spark, sf_dir, duck, name):
    result = contract.queries()[name](spark, sf_dir)
    oracle = duck.sql(contract.oracle_sql()[name])
    assert sorted_rows(result.columns, result.collect()) == sorted_rows(
        oracle.columns, oracle.fetchall()
    )
    assert dict(result.dtypes) == {
        c: KINDS[str(t)] for c, t in zip(oracle.columns, oracle.types)
    }


def test_queries_and_oracles_are_the_same_set():
    assert {q for q in contract.oracle_sql() if q in OWN} == set(OWN) - WITHOUT_SQL
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("price, discount", [(0.124, 0.05), (1.0, 0.005)])
def test_values_that_would_be_rounded_are_refused(spark, tmp_path, price, discount):
    row = dict(l_orderkey=1, l_partkey=1, l_suppkey=1, l_linenumber=1, l_tax=0.0, l_returnflag="A",
               l_linestatus="F", l_quantity=1.0, l_extendedprice=price, l_discount=discount,
               l_shipdate=dt.datetime(1998, 1, 1))
    path = str(tmp_path / "lineitem.parquet")
    spark.createDataFrame([row], SCHEMAS["lineitem"]).write.parquet(path)
    with pytest.raises(Exception, match="more than two decimals"):
        lineitem_summary(spark, str(tmp_path)).collect()
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{path}/*.parquet')")
        with pytest.raises(duckdb.Error, match="more than two decimals"):
            con.sql(contract.oracle_sql()["wiring_lineitem_summary"]).fetchall()


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.schema == second.schema
    assert first.count() > 0


def test_filter_and_columns_reach_the_scan(spark):
    plan = lineitem_summary(
        spark, "/root/testdata/sf0.001"
    )._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "LessThanOrEqual(l_shipdate," in scan
    read = scan.split("ReadSchema: struct<")[1]
    for column in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_tax"):
        assert column not in read
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan


def test_edges_on_a_small_fixture(spark, tmp_path):
    cut = dt.datetime(1998, 9, 2)
    line = dict(l_orderkey=1, l_partkey=1, l_suppkey=1, l_linenumber=1, l_tax=0.0)
    rows = [
        # On the cut-off, just after it, and with no ship date at all.
        dict(line, l_returnflag="A", l_linestatus="F", l_quantity=1.0,
             l_extendedprice=0.1, l_discount=0.05, l_shipdate=cut),
        dict(line, l_returnflag="A", l_linestatus="F", l_quantity=2.0,
             l_extendedprice=0.2, l_discount=0.0, l_shipdate=cut),
        dict(line, l_returnflag="A", l_linestatus="F", l_quantity=4.0, l_extendedprice=1.0,
             l_discount=0.0, l_shipdate=cut + dt.timedelta(microseconds=1)),
        dict(line, l_returnflag="A", l_linestatus="F", l_quantity=8.0,
             l_extendedprice=1.0, l_discount=0.0, l_shipdate=None),
        # A null key is a group of its own; null values are not summed.
        dict(line, l_returnflag=None, l_linestatus="O", l_quantity=None,
             l_extendedprice=3.0, l_discount=None, l_shipdate=cut),
    ]
    spark.createDataFrame(rows, SCHEMAS["lineitem"]).write.parquet(
        str(tmp_path / "lineitem.parquet")
    )
    got = {tuple(r) for r in lineitem_summary(spark, str(tmp_path)).collect()}
    assert got == {("A", "F", 3.0, 0.3, 0.295, 2), (None, "O", None, 3.0, None, 1)}


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES=",".join(OWN))
    out = subprocess.run(
        [sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True,
        text=True, timeout=300, check=True,
    ).stdout
    report = json.loads(out.strip().splitlines()[-1])
    assert set(report["queries"]) == set(OWN)
    assert report["unit"] == "sec" and report["sf"] == "0.001"
    assert report["value"] > 0
