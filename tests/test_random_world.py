"""Random tables with hot keys, NULLs and ties: every operator against plain SQL."""

import datetime as dt
import random

import duckdb
import pytest

from tenura.checks import oracle as sql
from tenura.operators import activity, contracts, divisions, monitoring
from tenura.plans.dataset import dataset
from tenura.plans.specs import SPECS
from tenura.sources.tables import SCHEMAS, Tables, column_names, column_type
from tests.conftest import d

REFS = [d("2024-01-31"), d("2023-11-01"), d("2023-12-15")]
START = d("2023-01-01")
ENV = "NL,BE"
PRODUCTS = ["Accounting", "Accountancy", "Manufacturing", "Professional services", "Wholesale distribution"]


def world(seed: int) -> dict[str, list[tuple]]:
    rnd = random.Random(seed)

    def day(span=500, null=0.0):
        return None if rnd.random() < null else START + dt.timedelta(days=rnd.randrange(span))

    def pick(values, hot=0.33):
        return values[0] if rnd.random() < hot else rnd.choice(values)

    def small(null=0.2):
        return None if rnd.random() < null else rnd.randrange(-3, 12)

    accounts = [f"a{i}" for i in range(160)]
    env = {a: rnd.choice(["nl", "nl", "be", "de"]) for a in accounts}
    division_of = {f"d{i}": pick(accounts) for i in range(250)}
    ids = [1, 1, 1, 2, 8, 5017, 5003, 5004, 5175, 5044, 77]
    packages = [(e, f"p{i}") for e in ("nl", "be", "de") for i in range(8)]
    users = [f"u{i}" for i in range(60)]
    out = {
        "accounts": [(env[a], a, f"id-{a}", rnd.choice([None, "Trade co", "Shop"]), rnd.random() < 0.5,
                      rnd.choice([None, "G", "M"]), rnd.choice(["EOL", "ACC", "KPN"]),
                      rnd.choice(["Accountant", "Company", None])) for a in accounts[:155]],
        "users": [(u, f"id-{pick(accounts)}") for u in users[:55]],
        "activity_daily": [],
        "activity_daily_contracts": [
            (env[a], a, f"id-{a}", f"p{rnd.randrange(9)}", rnd.choice(["cup", "cdn", "cnw"]), rnd.randrange(9),
             rnd.randrange(4), rnd.random() < 0.5, None, day())
            for a in (pick(accounts) for _ in range(1200))],
        "package_classification": [(e, p, PRODUCTS[int(p[1:]) % 5].replace(" ", "").lower(),
                                    rnd.choice([None, "Basic", "Advanced"]), None) for e, p in packages],
        "accounts_contract_summary": [
            (env[a], a, rnd.choice([1, 1, 1, 0]), day(300), day(900), *((s, s + dt.timedelta(days=rnd.randrange(40)))
             if (s := day(300, 0.5)) else (None, None)), day(800, 0.7)) for a in accounts[:157]],
        "contracts": [(env[a], a, f"p{rnd.randrange(8)}", day(60) + dt.timedelta(days=340),
                       rnd.choice(["cdn", "cdn", "cup"]), rnd.choice(["package", "package", "module"]),
                       rnd.choice(["inflow", "outflow"])) for a in (pick(accounts) for _ in range(900))],
        "divisions": [(env[a], div, f"id-{a}", rnd.choice([None, None, None, *REFS]), rnd.choice([0, 0, 99, 100]),
                       day(300, 0.1)) for div, a in division_of.items()],
        "division_statistics_daily": [], "division_statistics_daily_changes": [],
        "division_statistics_summary": [(env[a], div, day(600, 0.3)) for div, a in list(division_of.items())[:235]],
        "divisions_master_data_setup": [
            (env[division_of[div]], div, f"id-{division_of[div]}",
             rnd.choice([*contracts.SETUP_CATEGORIES, None, "TemporaryDivision", "Other thing"]), "Done", None)
            for div in (pick(list(division_of)) for _ in range(400))],
        "health_score": [], "is_usage_score": [],
    }
    for _ in range(5000):
        a = pick(accounts)
        out["activity_daily"].append((
            env[a], a, f"id-{a}", None if rnd.random() < 0.03 else pick(users), f"d{rnd.randrange(6)}",
            rnd.choice(ids), day(420), small(0.05)))
    divisions_ = list(division_of)
    for _ in range(3000):
        div = pick(divisions_)
        e = env[division_of[div]]
        out["division_statistics_daily"].append((
            e, div, day(420), *[rnd.choice([None, 0, 0, 1]) for _ in range(4)], small(), *[small() for _ in range(10)]))
        out["division_statistics_daily_changes"].append((e, div, day(420), *[small() for _ in range(17)]))
    runs = [d("2023-10-01"), d("2023-10-20"), d("2024-01-10")]
    for table in ("health_score", "is_usage_score"):
        out[table] = [(env[a], a, f"p{rnd.randrange(9)}", rnd.randrange(101), run,
                       dt.datetime.combine(run, dt.time(rnd.randrange(24))), rnd.choice(["all", "established"]))
                      for run in runs for a in accounts[:100]]
    return out


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    data = world(request.param)
    connection = duckdb.connect()
    for name, rows in data.items():
        columns = ", ".join(f"{c} {column_type(name, c).replace('string', 'varchar')}" for c in column_names(name))
        connection.execute(f"CREATE TABLE t_{name} ({columns})")
        connection.executemany(f"INSERT INTO t_{name} VALUES ({', '.join('?' * len(column_names(name)))})", rows)
    frames = {name: spark.createDataFrame(rows, SCHEMAS[name]).repartition(3) for name, rows in data.items()}
    return Tables.from_frames(spark, frames), connection


def comparable(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, dt.datetime):
        return value.date()
    if value is None or isinstance(value, (str, dt.date)):
        return value
    return round(float(value), 6)


def check(df, connection, body):
    cursor = connection.execute(body)
    names = [c[0] for c in cursor.description]
    expected = sorted((tuple(comparable(v) for v in row) for row in cursor.fetchall()), key=repr)
    got = sorted((tuple(comparable(v) for v in row) for row in df.select(*names).collect()), key=repr)
    assert got == expected
    assert expected


WINDOWED = {
    "pageviews": (activity.pageviews, sql.pageviews, "Accounting"),
    "active_days": (activity.active_days, sql.active_days, "Accountancy"),
    "mobile": (activity.mobile_use, sql.mobile, "Manufacturing"),
    "active_users": (activity.active_users_divisions, sql.active_users, "Accounting"),
    "financial": (divisions.financial_statistics, sql.financial, "Accounting"),
    "growth": (divisions.growth_statistics, sql.growth, "Accounting"),
    "projects": (divisions.project_statistics, sql.projects, "Accounting"),
}


@pytest.mark.parametrize("name", WINDOWED)
def test_windowed(both, name):
    tables, connection = both
    operator, builder, product = WINDOWED[name]
    for window in (30, 91):
        check(operator(tables, REFS, window, ENV, product), connection,
              sql.union_refs(REFS, lambda ref: builder(ref, window, ENV, product)))


def test_activity_mix(both):
    tables, connection = both
    check(activity.accountancy_activity(tables, REFS, 91, ENV), connection, sql.union_refs(
        REFS, lambda ref: sql.activity_mix(ref, 91, ENV, "Accountancy", activity.ACCOUNTANCY_SUMS)))


def test_roles_and_linked_companies(both):
    tables, connection = both
    check(activity.user_role_days(tables, REFS, 91, ENV), connection,
          sql.union_refs(REFS, lambda ref: sql.role_days(ref, 91, ENV)))
    check(activity.linked_companies(tables, REFS, 91, ENV), connection,
          sql.union_refs(REFS, lambda ref: sql.linked_companies(ref, 91, ENV)))


def test_contracts(both):
    tables, connection = both
    check(contracts.last_upgrade(tables, REFS), connection, sql.union_refs(REFS, sql.last_upgrade))
    check(contracts.setup_type(tables, REFS, ENV, "Accounting"), connection,
          sql.union_refs(REFS, lambda ref: sql.setup(ref, ENV, "Accounting")))
    check(contracts.downgrade_events(tables, ENV, "Accounting", d("2023-01-01"), d("2025-01-01")), connection,
          sql.downgrades(ENV, "Accounting", "DATE '2023-01-01'", "DATE '2025-01-01'"))


def test_old_scores(both):
    tables, connection = both
    for found, body in ((monitoring.old_churn_scores(tables, d("2023-10-20"), ENV, "Accounting", "All"),
                         sql.old_churn_scores(d("2023-10-20"), ENV, "Accounting", "All")),
                        (monitoring.old_downgrade_scores(tables, d("2024-01-31"), ENV, "Accounting"),
                         sql.old_downgrade_scores(d("2024-01-31"), ENV, "Accounting"))):
        check(found, connection, f"SELECT {', '.join(found.columns)} FROM ({body})")


@pytest.mark.parametrize("category,name", [(c, n) for c, specs in SPECS.items() for n in specs])
def test_datasets(both, category, name):
    tables, connection = both
    spec = SPECS[category][name].everywhere(ENV)
    check(dataset(tables, REFS, spec), connection, sql.union_refs(REFS, lambda ref: sql.dataset(ref, spec)))
