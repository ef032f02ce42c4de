"""Every query with a SQL counterpart gives the same rows on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(contract.oracle_sql())

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, con, name):
    fault = compare(name, contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name])
    assert fault is None, fault


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 4


PLANNED = ["a1_descriptive_rows", "a9_frequency_table", "a17_value_counts", "a20_spearman", "v10_missing_timestamps", "j3_complete_panel", "x5_fold_labels", "g4_calinski_harabasz"]


@pytest.mark.parametrize("name", PLANNED)
def test_plans_have_no_cross_product(spark, name):
    plan = contract.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pruned_scan_reaches_the_file(spark):
    plan = contract.queries()["s3_pruned_scan"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,100000.0)" in plan
