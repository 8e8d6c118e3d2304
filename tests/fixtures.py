"""A small world with the edge rows: blanks and case in keys, ties, inclusive
edges, missing matches, NULL dates."""

from tests.conftest import d
from tenura.sources.tables import SCHEMAS, Tables

REF = d("2024-01-31")


def _contract(account, package, event, date, linked=False, env=" NL ", account_id=None):
    return (env, account, account_id or f"ID-{account}", package, event, 3, 1, linked, None, d(date))


CLASSIFICATION = [
    ("nl", "P-ACC", "Accounting", "Advanced", "Core"),
    ("NL", "p-basic", "Accountancy", "Basic", None),
    ("NL", "p-adv", "Accountancy", None, None),
    ("NL", "P-MAN", "Manufacturing", "Advanced", None),
    ("NL", "P-PS", " Professional services", "Advanced", None),
    ("NL", "P-WD", "Wholesale distribution ", "Advanced", None),
    ("BE", "P-ACC", "Accounting", "Advanced", None),
]
CONTRACTS_DAILY = [
    _contract("A1 ", "P-ACC", "CNW", "2022-01-01"),
    _contract("a1", "P-ACC", "CUP", "2023-03-01"),
    _contract("A1", "P-WD", "CUP", "2024-02-15"),  # after the reference date
    _contract("A2", "P-ACC", "CNW", "2023-06-01", linked=True),
    _contract("A2", "P-MAN", "CNW", "2023-06-01"),  # tie with the row above
    _contract("A3", "P-LOST", "CNW", "2023-01-01"),  # package not classified
    _contract("A5", "p-basic", "CNW", "2023-01-01"),
    _contract("A6", "p-adv", "CNW", "2023-01-01"),
    _contract("B1", "P-ACC", "CNW", "2023-12-15", env="be"),
    _contract("A7", "P-ACC", "CNW", "2024-01-31"),  # exactly on the reference date
    _contract("A8", "P-ACC", "CNW", "2021-01-01"),
]
ACCOUNTS = [
    ("NL", "A1", "ID-A1", "Alpha Trading", False, "G", "EOL", "Company"),
    ("nl", "a2", "id-a2", None, False, None, "ACC", "Accountant"),
    ("NL", "A3", "ID-A3", "Gamma", False, "M", "EOL", "Company"),
    ("NL", "A4", "ID-A4", "No contract", False, "M", "EOL", "Company"),
    ("NL", "A5", "ID-A5", "Basic one", False, "M", "EOL", "Company"),
    ("NL", "A6", "ID-A6", "No edition", False, "M", "JBO", "Company"),
    ("BE", "B1", "ID-B1", "Internationaal", True, "M", "EO1", "Company"),
    ("NL", "A7", "ID-A7", "Seven", False, "M", "KPN", "Company"),  # class not in the list
    ("NL", "A8", "ID-A8", "Eight", False, "M", "AC7", "Company"),
]
SUMMARY = [
    ("NL", "A1", 1, d("2022-01-01"), d("2024-04-30"), None, None, None),  # ends on the horizon
    ("NL", "A2", 1, d("2023-06-01"), d("2025-01-01"), d("2023-05-01"), d("2023-05-31"), None),
    ("NL", "A3", 1, d("2023-01-01"), d("2025-01-01"), None, None, None),
    ("NL", "A5", 1, d("2023-01-01"), d("2025-01-01"), None, None, None),
    ("NL", "A6", 1, d("2024-01-01"), d("2025-01-01"), d("2023-12-01"), d("2023-12-31"), d("2024-05-01")),
    ("BE", "B1", 1, d("2023-12-15"), d("2025-01-01"), d("2023-10-01"), d("2023-12-20"), d("2024-03-01")),
    ("NL", "A7", 1, d("2024-01-31"), d("2025-01-01"), None, None, None),
    ("NL", "A8", 1, d("2021-01-01"), d("2025-01-01"), None, None, d("2024-01-31")),  # cancelled that day
]
USERS = [("U-A1 ", "ID-A1"), ("u-a2", "id-a2"), ("U-B1", "ID-B1"), ("U-A5", "ID-A5")]


def _activity(account, user, division, activity, date, quantity, env="NL"):
    return (env, account, f"ID-{account}", user, division, activity, d(date), quantity)


ACTIVITY = [
    _activity("A1", "u-a1", "D1", 1, "2023-11-01", 5),  # ref - 91, included
    _activity("A1", "u-a1", "D1", 1, "2023-10-31", 100),  # one day too early
    _activity("A1", "u-a1", "D2", 1, "2024-01-31", 7),  # ref, included
    _activity("A1", "u-a1", "D2", 1, "2024-02-01", 100),  # one day too late
    _activity("A1", "u-a2", "D1", 1, "2024-01-10", 2),  # user of an accountant account
    _activity("a1 ", "U-A2 ", "D1", 1, "2024-01-10", 2),
    _activity("A1", "u-b1", "D1", 1, "2024-01-11", 1),  # user of another company
    _activity("A1", "u-unknown", "D1", 1, "2024-01-12", 4),
    _activity("A1", "u-a1", "D1", 2, "2024-01-10", 1),
    _activity("A1", "u-a1", "D2", 2, "2024-01-10", 1),  # same day, counts again
    _activity("A1", "u-a1", "D1", 8, "2024-01-10", 3),
    _activity("A5", "u-a5", "D9", 5017, "2024-01-10", 4),
    _activity("A5", "u-a5", "D9", 5003, "2024-01-10", -6),
    _activity("A6", "u-a6", "D9", 9999, "2024-01-10", 1),
    _activity("B1", "u-b1", "D7", 1, "2024-01-20", 9, env="BE"),
]
DIVISIONS = [
    ("NL", "D1", "ID-A1", None, 0, d("2022-01-01")),
    ("NL", "D2", "ID-A1", d("2024-01-31"), 99, d("2022-02-01")),  # deleted on the reference date
    ("NL", "D3", "ID-A1", None, 100, d("2022-02-01")),  # blocked
    ("NL", "D4", "ID-A1", d("2024-01-30"), 0, d("2022-02-01")),  # deleted before
    ("NL", "D6", "ID-A6", None, 0, d("2022-02-01")),
]


def _snapshot(division, date, big3=(0, 0, 0), link=0, currency=0, quote=None, env="NL"):
    return (env, division, d(date), *big3, link, currency, quote, *[1] * 9)


SNAPSHOTS = [
    _snapshot("D1", "2023-01-01", link=1, currency=9, quote=50),
    _snapshot("D1", "2023-12-01", (0, 1, 0), 0, 2, quote=None),
    _snapshot("D1", "2024-01-15", (0, 0, 0), 0, None, quote=12),
    _snapshot("D1", "2024-02-10", (1, 1, 1), 1, 99, quote=999),  # later
    _snapshot("D2", "2024-01-20", (0, 0, 3), 1, 1, quote=4),
    _snapshot("D3", "2024-01-20", (1, 1, 1), 1, 50),
    _snapshot("D4", "2024-01-20", (1, 1, 1), 1, 60),
]


def _change(division, date, value, time=None, cost=None, htb=None, env="NL"):
    return (env, division, d(date), *[value] * 10, time, cost, 1, 2, None, -3, htb)


CHANGES = [
    _change("D1", "2023-11-01", 3, time=5, cost=2, htb=-1),
    _change("D1", "2024-01-31", -1, time=None, cost=1, htb=4),
    _change("D1", "2023-10-31", 1000, time=1000, cost=1000, htb=1000),
    _change("D2", "2024-01-10", 10, time=1, cost=1, htb=1),
    _change("D6", "2024-01-10", 8),
]
DIVISION_SUMMARY = [
    ("NL", "D1", d("2024-01-31")), ("NL", "D2", None), ("NL", "D3", d("2020-01-01")), ("NL", "D4", d("2020-01-01")),
]


def _line(account, package, date, flow, event="CDN", item="Package", env="NL"):
    return (env, account, package, d(date), event, item, flow)


CONTRACT_LINES = [
    _line("A1", "P-WD", "2024-02-10", "Outflow"), _line("A1", "P-ACC", "2024-02-10", "Inflow"),
    _line("A1", "P-WD", "2024-03-10", "Outflow"), _line("A1", "P-ACC", "2024-03-10", "Inflow"),
    _line("A2", "P-ACC", "2024-02-10", "Inflow"),  # nothing left
    _line("A3", "P-WD", "2024-02-10", "Outflow"), _line("A3", "P-MAN", "2024-02-10", "Inflow"),
    _line("A4", "P-WD", "2024-02-10", "Outflow", item="Module"), _line("A4", "P-ACC", "2024-02-10", "Inflow"),
    _line("A5", "P-WD", "2024-05-01", "Outflow"), _line("A5", "P-ACC", "2024-05-01", "Inflow"),  # after the period
    _line("A6", "P-WD", "2024-04-30", "Outflow"), _line("A6", "P-ACC", "2024-04-30", "Inflow"),  # last day
    _line("A7", "P-WD", "2024-02-10", "Outflow", event="CUP"), _line("A7", "P-ACC", "2024-02-10", "Inflow", event="CUP"),
]
SETUP = [
    ("NL", "D1", "ID-A1", "Manual", "Done", None),
    ("NL", "D2", "ID-A1", "Demo", "Done", None),
    ("NL", "D4", "ID-A1", None, "Done", None),
    ("NL", "D3", "ID-A1", "TemporaryDivision", "Done", None),
    ("NL", "D6", "ID-A6", "SomethingNew", "Done", None),
]
SCORES = [
    ("NL", "A1", "P-ACC", 90, d("2023-09-30"), None, "All"),
]


def tables(spark, **replaced) -> Tables:
    data = {
        "accounts": ACCOUNTS, "users": USERS, "activity_daily": ACTIVITY,
        "activity_daily_contracts": CONTRACTS_DAILY, "package_classification": CLASSIFICATION,
        "accounts_contract_summary": SUMMARY, "contracts": CONTRACT_LINES, "divisions": DIVISIONS,
        "division_statistics_daily": SNAPSHOTS, "division_statistics_daily_changes": CHANGES,
        "division_statistics_summary": DIVISION_SUMMARY, "divisions_master_data_setup": SETUP,
        "health_score": [], "is_usage_score": [], **replaced,
    }
    return Tables.from_frames(spark, {
        name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in data.items()})
