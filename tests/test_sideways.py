"""The cohort found first: the same rows, and only its facts in the aggregates."""

import pytest

from tenura.checks.registry import EVERYWHERE, GRID, WINDOW
from tenura.operators import activity, contracts
from tenura.operators.activity import PAGE_VIEW
from tenura.operators.sideways import among, small_keys
from tenura.plans.dataset import dataset
from tenura.plans.specs import get_spec
from tenura.sources.testdata import star_schema_tables

from tests.conftest import frame, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def world(spark):
    return star_schema_tables(spark, SF)


def nodes(plan):
    """The nodes of an executed plan, through adaptive execution and its stages."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        children = [plan.executedPlan()]
    elif kind.endswith("QueryStageExec"):
        children = [plan.plan()]
    else:
        children = [plan.children().apply(i) for i in range(plan.children().size())]
    yield plan
    for child in children:
        yield from nodes(child)


def semi_join_rows(df):
    """Rows that left each semi join with a broadcast table, after a run."""
    df.collect()
    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "BroadcastHashJoinExec"]
    return [n.metrics().apply("numOutputRows").value() for n in found if n.joinType().toString() == "LeftSemi"]


def test_only_the_cohorts_facts_are_aggregated(spark, world):
    """By the metrics of the run: what passes the semi join below the aggregate are the cohort's facts, not all facts."""
    product, ref = "Accounting", GRID[:1]
    df = activity.pageviews(world.with_cohort_first(), ref, WINDOW, EVERYWHERE, product)
    facts = activity._facts(world, ref, WINDOW, EVERYWHERE, [PAGE_VIEW])
    accounts = contracts.cohort(world, ref, EVERYWHERE, product).select("environment", "account_code").distinct()
    expected = facts.join(accounts, ["environment", "account_code"], "left_semi").count()
    assert semi_join_rows(df) == [expected]
    assert 0 < expected < facts.count()
    assert semi_join_rows(activity.pageviews(world, ref, WINDOW, EVERYWHERE, product)) == []


@pytest.mark.parametrize("most_bytes", [2 ** 20, 1])
def test_measures_are_the_same(spark, world, most_bytes):
    """Also where the keys are too large to be sent: then all facts are aggregated, as without."""
    other = world.with_cohort_first(most_bytes)
    for operator, product in ((activity.active_users_divisions, "Wholesale distribution"), (activity.mobile_use, "Manufacturing"),
                              (activity.active_days, "Accountancy")):
        got = operator(other, GRID, WINDOW, EVERYWHERE, product)
        assert rows(got) == rows(operator(world, GRID, WINDOW, EVERYWHERE, product)) != []
        assert bool(semi_join_rows(got)) == (most_bytes > 1)


@pytest.mark.parametrize("name", ["accounting_onboarding", "wholesale_distribution", "professional_services"])
def test_datasets_are_the_same(spark, world, name):
    spec = get_spec("churn", name)
    df = dataset(world.with_cohort_first(), GRID, spec)
    assert rows(df) == rows(dataset(world, GRID, spec)) != []
    assert len(semi_join_rows(df)) >= 3  # activity, snapshots, changes


def test_small_keys(spark):
    facts = frame(spark, "a string, b string, n int", [("x", "1", 1), ("x", "1", 2), ("y", None, 3), (None, "1", 4), ("z", "9", 5), (None, None, 6)])
    wanted = frame(spark, "b string, a string, more int", [("1", "x", 1), ("1", "x", 2), (None, "y", 3), ("1", None, 4)])
    keys = small_keys(wanted, ["a", "b"], 66)  # one whole key of two bytes
    assert rows(keys) == [("x", "1")]
    assert rows(among(facts, keys), "n") == [(1,), (2,)]
    assert small_keys(wanted, ["a", "b"], 65) is None
    assert among(facts, None) is facts
    none = small_keys(wanted.limit(0), ["a", "b"], 1)  # nobody in the cohort: no facts
    assert rows(among(facts, none)) == []
