"""Every registered query against its oracle, and what their plans must not contain."""

import re

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, SF, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", list(QUERIES))
def test_oracle_finds_something(con, name):
    assert con.execute(f"select count(*) from ({ORACLES[name]})").fetchall()[0][0] > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_python_and_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|CartesianProduct|BroadcastNestedLoopJoin|InPandas", plan)


def test_hot_ids_are_cut_off_before_the_shuffle(spark):
    plan = QUERIES["user_timeline_newest"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_n_is_not_a_full_sort(spark):
    plan = QUERIES["top_errors"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


# Trace lines and standalone lines are two inputs of one union.
@pytest.mark.parametrize("name,times", [("reconcile_cobrand", 2), ("trace_incremental", 1)])
def test_lines_are_read_back_once(spark, name, times):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS _parsed") == times


@pytest.mark.parametrize("name", ["trace_errors", "span_context", "trace_fields", "trace_flatten"])
def test_orders_are_spread_before_they_become_lines(spark, name):
    """A file of one split is rendered and parsed by more than one task."""
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[o_orderkey", plan)
