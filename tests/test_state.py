"""As-of states carried on month by month: the same rows as from the whole history, and at most a month of it read."""

import datetime as dt
import random
import re

import pytest

from tenura.operators import contracts, divisions
from tenura.operators.states import STATES
from tenura.sources.state import StateStore, month_end
from tenura.sources.testdata import star_schema_tables
from tests.conftest import d, rows
from tests.test_plan_quality import plan_text

SF = "/root/testdata/sf0.001"
REFS = [d("2024-01-30"), d("2023-11-30"), d("2023-11-02"), d("2022-05-31")]
NAMES = list(STATES)


@pytest.fixture(scope="module")
def world(spark):
    return star_schema_tables(spark, SF)


def kept(spark, world, tmp_path, days):
    store = StateStore(spark, str(tmp_path), STATES)
    for name in NAMES:
        for day in days:
            store.advance(world, name, day)
    return store


def same_as_history(world, store, refs):
    on_state = world.with_state(store)
    for operator in (contracts.latest_contract, contracts.last_upgrade):
        assert rows(operator(on_state, refs)) == rows(operator(world, refs)) != []
    assert rows(divisions._states(on_state, refs, "NL,BE")) == rows(divisions._states(world, refs, "NL,BE")) != []


def test_month_end():
    assert [month_end(d(day)) for day in ("2024-02-28", "2024-02-29", "2024-03-01", "2023-12-31")] == \
        [d("2024-01-31"), d("2024-02-29"), d("2024-02-29"), d("2023-12-31")]


def test_same_rows(spark, world, tmp_path):
    """Dates before the first state, in one month, on its last day, long after the newest state."""
    store = kept(spark, world, tmp_path, [d("2023-10-31"), d("2023-11-30"), d("2024-01-15")])
    assert list(store.watermarks(NAMES[0])) == [d("2023-10-31"), d("2023-11-30"), d("2023-12-31")]
    same_as_history(world, store, REFS)
    same_as_history(world, store, [d("2023-11-30")])
    same_as_history(world, store, [d("2024-06-10")])


def test_nothing_is_read_twice(spark, world, tmp_path):
    store = kept(spark, world, tmp_path, [d("2023-10-31")])
    assert store.advance(world, NAMES[0], d("2023-11-29")) == []
    assert store.advance(world, NAMES[0], d("2023-09-10")) == []


def test_late_facts(spark, world, tmp_path):
    """Facts of a closed month that come late are taken in from their month on; without them the state stays as it was."""
    name = NAMES[0]
    early = world.with_table(name, world.get(name).where("pmod(hash(account_code, date), 2) = 0"))
    store = kept(spark, early, tmp_path, [d("2023-08-31"), d("2023-10-31"), d("2023-11-30")])
    same_as_history(early, store, REFS[:1])
    assert rows(contracts.latest_contract(world.with_state(store), REFS[:1])) != rows(contracts.latest_contract(world, REFS[:1]))
    assert store.advance(world, name, d("2023-11-30"), late_since=d("1990-01-01")) == [d("2023-08-31"), d("2023-10-31"), d("2023-11-30")]
    assert rows(contracts.latest_contract(world.with_state(store), REFS)) == rows(contracts.latest_contract(world, REFS))


def test_a_month_that_was_not_listed_is_not_read(spark, world, tmp_path):
    """A run that dies between writing a month and listing it leaves nothing that is read."""
    store = kept(spark, world, tmp_path, [d("2023-10-31")])
    part = spark.read.parquet(f"{tmp_path}/{NAMES[0]}").selectExpr("* EXCEPT (package_code, part)", "'wrong' AS package_code", "'2023-11-30-dead' AS part")
    part.write.mode("append").partitionBy("part").parquet(f"{tmp_path}/{NAMES[0]}")
    same_as_history(world, store, REFS[:2])


def test_at_most_a_month_of_history(spark, world, tmp_path):
    lake = {name: world.get(name) for name in NAMES}
    for name, frame in lake.items():
        frame.write.parquet(f"{tmp_path}/lake/{name}")
    stored = world
    for name in NAMES:
        stored = stored.with_table(name, spark.read.parquet(f"{tmp_path}/lake/{name}"))
    refs = [d("2024-01-30"), d("2023-10-31")]
    store = kept(spark, stored, tmp_path / "state", [d("2023-09-30"), d("2023-12-31")])
    for name, df in ((NAMES[0], contracts.latest_contract(stored.with_state(store), refs)),
                     (NAMES[1], divisions._states(stored.with_state(store), refs, "NL,BE"))):
        plan = plan_text(spark, df)
        facts = [line for line in plan.splitlines() if "FileScan" in line and f"/lake/{name}" in line]
        state = [line for line in plan.splitlines() if "FileScan" in line and f"/state/{name}" in line]
        assert facts and state
        for line in facts:
            pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", line)[1]
            assert "GreaterThanOrEqual(date,2024-01-01)" in pushed and "LessThanOrEqual(date,2024-01-30)" in pushed
            assert "GreaterThanOrEqual(date,2023-10-01)" in pushed and "LessThanOrEqual(date,2023-10-31)" in pushed
        assert all(re.search(r"PartitionFilters: \[[^\]]*part#", line) for line in state)


@pytest.mark.parametrize("refs", [REFS, REFS[:1]])
def test_no_record_is_sorted_above_a_fact_scan(spark, world, refs):
    """First and last days come from hash aggregates; records are compared on the rows of those days."""
    for df in (contracts.latest_contract(world, refs), contracts.contract_base(world, refs, "NL,BE", "Accounting", 91, 30),
               divisions.growth_statistics(world, refs, 91, "NL,BE", "Wholesale distribution")):
        assert "SortAggregate" not in plan_text(spark, df)


def test_random_history(spark, tmp_path):
    """Ties on a day, missing values, upgrades older than the newest record."""
    random.seed(8)
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=random.randrange(400)) for _ in range(40)]
    facts = [("nl", f"a{random.randrange(12)}", random.choice(days), random.choice(["p1", "p2", None]), random.choice(["cup", "new", None]),
              "id", random.choice([1, 2, None]), 1, None, 1.5) for _ in range(300)]
    names = "environment string, account_code string, date date, package_code string, event_type string, account_id string, " \
            "number_of_users int, number_of_administrations int, accountant_or_linked boolean, mrr double"
    table = spark.createDataFrame(facts, names)
    world = star_schema_tables(spark, SF).with_table(NAMES[0], table)
    store = StateStore(spark, str(tmp_path), STATES)
    for day in (d("2023-03-31"), d("2023-07-31"), d("2023-12-31")):
        store.advance(world, NAMES[0], day)
    refs = [d("2024-01-20"), d("2023-08-05"), d("2023-04-30"), d("2023-02-10")]
    for operator in (contracts.latest_contract, contracts.last_upgrade):
        assert rows(operator(world.with_state(store), refs)) == rows(operator(world, refs)) != []
