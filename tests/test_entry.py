"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__
from checks.compare import difference, duck
from checks.oracle import ORACLE_SQL as SQL
from checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")



@pytest.fixture(scope="module")
def connection():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF), connection, SQL[name]) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_no_query_pairs_all_rows(spark):
    for name in ("gold_oee", "gold_kpis_machines", "sensors_enriched", "quality_report", "run_summary"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
