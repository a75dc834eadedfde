"""Every registered query against its SQL counterpart, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from ledgertie.plans import oracle
from ledgertie.plans.queries import orders_feeds, registry
from test_plans import NEVER

FOLDER = "/root/testdata/sf0.001"

# DuckDB type of each Spark type that results have.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "decimal(18,2)": "DECIMAL(18,2)",
    "decimal(38,2)": "DECIMAL(38,2)",
    "decimal(38,0)": "DECIMAL(38,0)",
}


# Checks that run over planted faults, so an empty result would prove nothing.
FINDS = {
    "append_twice",
    "batches_retried",
    "branch_overlap",
    "expected_breaks_split",
    "form_differences",
    "grade_missed",
    "load_checks",
    "multiset_diff_tree",
    "offset_pairs_dollar",
    "offset_pairs_wide",
    "refresh_twice",
    "register_missing_modes",
    "register_unbalanced",
    "tieout_detail_split",
    "tieout_filed_split",
    "trend_agreement",
    "trend_mismatches",
    "two_sided_timing",
    "universe_gaps",
    "unmatched_scenarios",
    "what_if_split",
}


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_agrees_with_sql(spark, sql, name):
    result = contract.queries()[name](spark, FOLDER)
    statement = contract.oracle_sql()[name]
    assert differences(result, sql, statement) == ""
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in NEVER)
    answer = sql.sql(statement)
    kinds = dict(zip(answer.columns, map(str, answer.types), strict=True))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema} == kinds
    assert name not in FINDS or answer.limit(1).fetchall()


def test_every_query_has_a_counterpart():
    assert set(registry()) == set(oracle.statements())
    assert set(registry()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["entity", "product", "quarter"]


def test_unmatched_scenarios_are_those_the_whole_ledger_lacks(spark, tmp_path):
    tables = {
        "region(r_regionkey, r_name)": "(3, 'EUROPE'), (4, 'MIDDLE EAST')",
        "nation(n_nationkey, n_regionkey)": "(30, 3), (40, 4)",
        "customer(c_custkey, c_nationkey)": "(300, 30), (400, 40)",
        "orders(o_orderkey, o_custkey, o_orderpriority, o_orderdate, o_totalprice)": """
          (1, 400, '1-URGENT', DATE '1992-11-15', 10.5::DOUBLE),
          (2, 400, '2-HIGH', DATE '1992-11-15', 20.5),
          (3, 300, '1-URGENT', DATE '1995-08-15', 30.5),
          (4, 300, '2-HIGH', DATE '1995-08-15', 40.5),
          (5, 300, '1-URGENT', DATE '1998-11-15', 50.5)""",
    }
    writer = connect(str(tmp_path))
    for table, rows in tables.items():
        path = tmp_path / f"{table.split('(')[0]}.parquet"
        writer.execute(f"COPY (FROM (VALUES {rows}) AS {table}) TO '{path}'")
    folder, sql = str(tmp_path), connect(str(tmp_path))
    gl = orders_feeds(spark, folder).gl
    assert gl.filter("entity = 'EUROPE' AND product = '1-URGENT'").count() == 2
    found = registry()["unmatched_scenarios"](spark, folder)
    assert [tuple(row) for row in found.collect()] == [
        ("MIDDLE EAST", "1-URGENT", "1992Q4", "mapping_error")
    ]
    assert differences(found, sql, oracle.statements()["unmatched_scenarios"]) == ""
