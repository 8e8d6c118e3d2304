"""Tables in buckets by account: the same rows, and no shuffle where accounts, summary, contracts and activity meet by account."""

import re

import pytest

from tenura.checks.registry import EVERYWHERE, GRID, WINDOW, in_buckets
from tenura.operators import activity, contracts
from tenura.operators.grid import ACCOUNT
from tenura.plans.dataset import dataset
from tenura.plans.specs import get_spec
from tenura.sources.sinks import write_bucketed
from tenura.sources.testdata import star_schema_tables
from tests.conftest import frame, rows
from tests.test_plan_quality import plan_text

SF = "/root/testdata/sf0.001"
BY_ACCOUNT_SHUFFLE = re.compile(r"Exchange hashpartitioning\((?:reference_date#\d+, )?environment#\d+, account_code#\d+, ")


@pytest.fixture(scope="module")
def world(spark):
    return star_schema_tables(spark, SF)


@pytest.fixture(scope="module")
def bucketed(world):
    return in_buckets(world, 5)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("refs", [GRID, GRID[:1]])
def test_tables_meet_without_a_shuffle(spark, world, bucketed, no_broadcast, refs):
    """Joins of accounts, summary, newest contract and upgrade, and their aggregates, read buckets as they lie."""
    for tables, shuffled in ((bucketed, False), (world, True)):
        plan = plan_text(spark, contracts.contract_base(tables, refs, EVERYWHERE, "Accounting", 91, 30))
        assert bool(BY_ACCOUNT_SHUFFLE.search(plan)) == shuffled
        assert plan.count("SortMergeJoin") >= 3
        measures = activity.activity_measures(tables, refs, WINDOW, EVERYWHERE, ("pageviews",))
        assert ("Exchange" in plan_text(spark, measures)) == shuffled


def test_the_same_rows(world, bucketed):
    for run in (lambda t: contracts.contract_base(t, GRID, EVERYWHERE, "Accounting", 91, 30),
                lambda t: contracts.latest_contract(t, GRID),
                lambda t: dataset(t, GRID, get_spec("churn", "accounting_established"))):
        assert rows(run(bucketed)) == rows(run(world)) != []


def test_written_again(spark):
    """A table of the name is replaced; a bucket is one file; rows with a NULL key stay."""
    df = frame(spark, "environment string, account_code string, n int", [("nl", f"a{k % 7}", k) for k in range(50)] + [(None, None, 50)])
    for some in (df, df.where("n >= 10")):
        write_bucketed(some, "twice_bucketed", contracts.CONTRACT_KEY, 3)
        table = spark.table("twice_bucketed")
        assert rows(table) == rows(some)
        assert len(table.inputFiles()) <= 3


def test_unknown_table(world):
    with pytest.raises(ValueError, match="unknown tables"):
        world.with_catalog({"acounts": "x"})


def test_records_of_a_day(spark, world):
    """Of several records of one day the largest counts, for each reference date."""
    ref, other = GRID[0], GRID[1]
    facts = [("nl", "a", ref, "p1", "new"), ("nl", "a", ref, "p2", "new"), ("nl", "a", ref, "p2", "cup"), ("nl", "a", other, "p9", None),
             ("nl", "a", other, None, "new"), ("nl", "b", other, "p3", "new"), ("nl", "c", None, "p4", "new"), (None, "d", ref, "p5", "new")]
    table = frame(spark, "environment string, account_code string, date date, package_code string, event_type string", facts)
    for refs in ([ref, other], [ref]):
        got = contracts.latest_contract(world.with_table("activity_daily_contracts", table), refs)
        expected = {(ref, "a"): "p2", (ref, "b"): "p3", (other, "a"): "p9", (other, "b"): "p3"}
        found = {(r["reference_date"], r["account_code"]): r["package_code"] for r in got.collect() if r["environment"]}
        assert found == {k: v for k, v in expected.items() if k[0] in refs}
        assert got.groupBy(*ACCOUNT).count().where("count > 1").isEmpty()
