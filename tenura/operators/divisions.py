"""Features of division snapshots and daily changes, brought to account level.

Snapshots and changes are each reduced to one row per division in one pass, the
divisions are summed up per account id, and only those sums meet the contracts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenura.functions import guarded_log, has_value, in_list, not_negative, not_negative_sql
from tenura.operators.contracts import cohort
from tenura.operators.grid import (
    ACCOUNT, REF, LatestInt, Refs, as_of_latest, as_of_parts, day, in_look_back, look_back_windows,
    rows_of_days, unfold,
)
from tenura.operators.sideways import among, small_keys
from tenura.sources.tables import Tables

BLOCKED_FROM = 100  # fixed value: blocking status of a closed division
DIVISION = ["environment", "division_code"]

BANKS = ("abnamro_bank_accounts", "ing_bank_accounts", "rabo_bank_accounts")
# state of the newest snapshot -> its value; several snapshots of one day count as
# one with the largest values
SNAPSHOT_STATE = {
    "big3_bank_account": "CASE WHEN " + " OR ".join(f"{bank} > 0" for bank in BANKS) + " THEN 1 ELSE 0 END",
    "bank_link": "automatic_bank_link",
    "currency_count": "currency_count",
}
GROWTH = ("quote_count", "customer_count", "supplier_count", "sales_invoice_count",
          "stock_count_entry_count", "sales_order_entry_count", "purchase_order_entry_count",
          "delivery_entry_count", "item_count", "sales_price_list_count")
# output -> counter of the daily changes
FINANCIAL = {
    "gl_transactions": "gl_transactions_count",
    "sales_invoice": "sales_invoice_count",
    "purchase_entry_count": "purchase_entry_count",
    "stock_count_entry": "stock_count_entry_count",
    "bank_entry_count": "bank_entry_count",
    "cash_entry_count": "cash_entry_count",
    "sales_entry_count": "sales_entry_count",
    "general_journal_entry_count": "general_journal_entry_count",
    "account_count": "account_count",
    "project_total_time_entries": "project_total_time_entries",
}
PROJECT_TYPES = ("project_type_fixed_price", "project_type_time_and_material", "project_type_non_billable",
                 "project_type_prepaid_retainer", "project_type_prepaid_htb")
PROJECTS = {"project_total_cost_entries_count": "project_total_cost_entries",
            **{name: name for name in PROJECT_TYPES}}
FINANCIAL_FLAGS = ("big3_bank_account", "bank_link", "ever_sent_invoice", "currency_count")
LOGGED_FINANCIAL = ("gl_transactions", "purchase_entry_count", "bank_entry_count", "sales_entry_count",
                    "account_count", "cash_entry_count", "general_journal_entry_count",
                    "num_activated_divisions")


def _states(tables: Tables, refs: Refs, countries: str, keys: DataFrame | None = None) -> DataFrame:
    """Per division: packed state of the newest snapshot on or before each reference date."""
    rows = among(tables.newest("division_statistics_daily", refs).where(in_list("environment", countries)), keys)
    aggregates = [part for name, value in SNAPSHOT_STATE.items()
                  for part in as_of_parts(refs, name, LatestInt.pack(value))]
    return as_of_latest(rows.groupBy(*DIVISION).agg(*aggregates), refs, *SNAPSHOT_STATE)


def compact_snapshots(rows: DataFrame) -> DataFrame:
    """The rows that any later reference date can need: of each division the newest day, with its largest values."""
    columns = (*BANKS, "automatic_bank_link", "currency_count")
    newest = rows.where("date IS NOT NULL").groupBy(*DIVISION).agg(*[F.expr(f"max({LatestInt.pack(c)}) AS {c}") for c in columns])
    return newest.selectExpr(*DIVISION, f"{LatestInt.day(columns[0])} AS date", *[f"{LatestInt.unpack(c)} AS {c}" for c in columns])


def _growth(tables: Tables, refs: Refs, window: int, countries: str, keys: DataFrame | None = None) -> DataFrame:
    """Per division: last minus first snapshot inside each window, as one struct.

    An aggregate of its own: it only reads the windows, where the state needs the
    whole history. First and last day come from an aggregate of dates alone; only
    snapshots of those two days are compared, by their values."""
    rows = (tables.get("division_statistics_daily", windows=look_back_windows(refs, window))
            .where(in_list("environment", countries)))
    tagged = in_look_back(among(rows, keys), refs, window)
    ends = tagged.groupBy(REF, *DIVISION).agg(F.min("date").alias("_first_day"), F.max("date").alias("_last_day"))
    values = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in GROWTH]
    near = rows_of_days(tagged.select(REF, *DIVISION, "date", *values), ends, [REF, *DIVISION], ["_first_day", "_last_day"])
    order = ["date", *GROWTH]
    group = Window.partitionBy(REF, *DIVISION)
    ranked = near.withColumns({"_first": F.row_number().over(group.orderBy(*order)),
                               "_last": F.row_number().over(group.orderBy(*[F.col(c).desc() for c in order]))})
    grown = [F.expr(f"max(CASE WHEN _last = 1 THEN {c} END) - max(CASE WHEN _first = 1 THEN {c} END) AS {c}") for c in GROWTH]
    return (ranked.where("_first = 1 OR _last = 1").groupBy(REF, *DIVISION).agg(*grown)
            .select(REF, *DIVISION, F.struct(*GROWTH).alias("growth")))


def _changes(tables: Tables, refs: Refs, window: int, countries: str, counters: Sequence[str],
             keys: DataFrame | None = None) -> DataFrame:
    """Sum of each counter per division and look-back window."""
    rows = (tables.get("division_statistics_daily_changes", windows=look_back_windows(refs, window))
            .where(in_list("environment", countries)))
    return (in_look_back(among(rows, keys), refs, window).groupBy(REF, *DIVISION)
            .agg(F.expr("count(1) AS _change_rows"), *[F.expr(f"sum({c}) AS _sum_{c}") for c in counters]))


def _open_divisions(tables: Tables, countries: str, refs: Refs) -> DataFrame:
    return (tables.get("divisions")
            .where(in_list("environment", countries))
            .where(f"blocking_status_code < {BLOCKED_FROM} AND (deleted IS NULL OR deleted >= {day(min(refs))})")
            .select(*DIVISION, "account_id", "deleted"))


def division_measures(tables: Tables, refs: Refs, window: int, countries: str, financial: bool = False,
                      growth: bool = False, projects: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Measures per (reference date, account id).

    A measure is NULL for an account without a division that qualifies for it:
    a division deleted on the reference date still counts for the financial
    measures and no longer for growth and projects; financial measures need a
    snapshot and a summary row, growth a snapshot in the window, projects a change.

    Given account ids, the open divisions of those are found first, and their keys
    keep the facts of others out of the aggregates.

    Divisions grow with the facts, and a row for each reference date takes many times
    its stored bytes, by which a broadcast would be chosen: they meet by merge.
    """
    divisions = among(_open_divisions(tables, countries, refs), ids)
    keys = small_keys(divisions, DIVISION, tables.cohort_bytes) if ids is not None else None
    counters = list(dict.fromkeys([*(FINANCIAL.values() if financial else ()),
                                   *(PROJECTS.values() if projects else ())]))
    if financial:
        summary = (tables.get("division_statistics_summary")
                   .selectExpr(*DIVISION, "sales_invoice_first_date", "true AS _has_summary"))
        divisions = divisions.join(summary.hint("merge"), DIVISION, "left")
        divisions = divisions.join(_states(tables, refs, countries, keys).hint("merge"), DIVISION, "left")
        rows = unfold(divisions, refs, *SNAPSHOT_STATE)
        if not (growth or projects):
            rows = rows.where("big3_bank_account IS NOT NULL")
    else:
        rows = unfold(divisions, refs)
    rows = rows.where(f"deleted IS NULL OR deleted >= {REF}")
    if counters:
        changes = _changes(tables, refs, window, countries, counters, keys)
        rows = rows.join(changes.hint("merge"), [REF, *DIVISION], "left" if financial or growth else "inner")
    if growth:
        grown = _growth(tables, refs, window, countries, keys)
        rows = rows.join(grown.hint("merge"), [REF, *DIVISION], "left" if financial or projects else "inner")

    still_open = f"(deleted IS NULL OR deleted > {REF})"
    aggregates: list[Column] = []

    def measure(function: str, valid: str, value: str, name: str) -> None:
        aggregates.append(F.expr(f"{function}(CASE WHEN {valid} THEN {value} END) AS {name}"))

    if financial:
        # every snapshot has a packed flag, so a NULL one means there is no snapshot
        valid = "big3_bank_account IS NOT NULL AND _has_summary"
        aggregates.append(F.expr(f"count(DISTINCT CASE WHEN {valid} THEN division_code END) AS num_activated_divisions"))
        for name in SNAPSHOT_STATE:
            measure("max", valid, LatestInt.unpack(name), name)
        measure("max", valid, f"CASE WHEN sales_invoice_first_date <= {REF} THEN 1 ELSE 0 END", "ever_sent_invoice")
        measure("count", valid, "1", "_financial")
        for out, c in FINANCIAL.items():
            measure("sum", valid, f"_sum_{c}", f"fin_{out}")
    if growth:
        valid = f"{still_open} AND growth IS NOT NULL"
        for c in GROWTH:
            measure("sum", valid, f"growth.{c}", f"growth_{c}")
        measure("count", valid, "1", "_growth")
    if projects:
        valid = f"{still_open} AND _change_rows IS NOT NULL"
        for out, c in PROJECTS.items():
            measure("sum", valid, f"_sum_{c}", f"project_{out}")
        measure("count", valid, "1", "_projects")
    measures = rows.groupBy(REF, "account_id").agg(*aggregates)
    if financial:
        measures = measures.withColumn(
            "num_activated_divisions", F.expr("CASE WHEN _financial > 0 THEN num_activated_divisions END"))
    return measures


def _per_account(measures: DataFrame, accounts: DataFrame) -> DataFrame:
    """Account-id level measures for each account code of the cohort. Divisions
    know the account id only, not the contract's environment."""
    return (accounts.select(*ACCOUNT, "account_id")
            .join(measures, [REF, "account_id"]).drop("account_id"))


def _cohort(tables: Tables, refs: Refs, product: str) -> DataFrame:
    return cohort(tables, refs, None, product)


def financial_statistics(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    measures = division_measures(tables, refs, window, countries, financial=True)
    rows = _per_account(measures.where("_financial > 0"), _cohort(tables, refs, product))
    return rows.selectExpr(*ACCOUNT, "num_activated_divisions", *FINANCIAL_FLAGS,
                           *[f"fin_{out} AS {out}" for out in FINANCIAL])


def growth_statistics(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    """Last minus first snapshot of the window, summed over divisions."""
    measures = division_measures(tables, refs, window, countries, growth=True)
    rows = _per_account(measures.where("_growth > 0"), _cohort(tables, refs, product))
    return rows.selectExpr(*ACCOUNT, *[f"growth_{c} AS {c}" for c in GROWTH])


def project_statistics(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    measures = division_measures(tables, refs, window, countries, projects=True)
    rows = _per_account(measures.where("_projects > 0"), _cohort(tables, refs, product))
    return rows.selectExpr(*ACCOUNT, *[f"project_{out} AS {out}" for out in PROJECTS])


def with_financial_features(df: DataFrame) -> DataFrame:
    flags = ("big3_bank_account", "bank_link", "sales_invoice", "currency_count")
    return df.withColumns({**{f"has_{c}": has_value(c) for c in flags},
                           **{f"log_{c}": guarded_log(c) for c in LOGGED_FINANCIAL}})


def with_growth_logs(df: DataFrame) -> DataFrame:
    return df.withColumns({f"log_{c}": guarded_log(c) for c in GROWTH})


def with_project_features(df: DataFrame) -> DataFrame:
    clipped = ("project_total_time_entries", "project_total_cost_entries_count", *PROJECT_TYPES)
    entries = " + ".join(not_negative_sql(c) for c in clipped[:2])
    count = " + ".join(not_negative_sql(c) for c in PROJECT_TYPES)
    return df.withColumns({
        **{c: not_negative(c) for c in clipped},
        "project_time_cost_entries_count": F.expr(entries),
        "projects_count": F.expr(count),
        "log_project_time_cost_entries_count": guarded_log(f"({entries})"),
        "log_projects_count": guarded_log(f"({count})"),
    })


# fixed values: entries a new administration starts with, per country
DEFAULT_ENTRIES = {
    "nl": {"bank_entry_count": 18, "cash_entry_count": 2, "sales_entry_count": 56,
           "purchase_entry_count": 88, "general_journal_entry_count": 145, "account_count": 25},
    "be": {"bank_entry_count": 3, "cash_entry_count": 1, "sales_entry_count": 25,
           "purchase_entry_count": 25, "general_journal_entry_count": 6, "account_count": 7},
}
DEFAULT_ENTRIES_BELOW_MONTHS = 3


def without_default_entries(df: DataFrame) -> DataFrame:
    """Subtract the opening entries of accounts younger than three months that have
    at least as many of every kind, by the thresholds of their own country."""
    columns = {}
    for name in DEFAULT_ENTRIES["nl"]:
        branches = []
        for country, defaults in DEFAULT_ENTRIES.items():
            reached = " AND ".join(f"{other} >= {threshold}" for other, threshold in defaults.items())
            branches.append(f"WHEN environment = '{country}' AND tenure_in_months < {DEFAULT_ENTRIES_BELOW_MONTHS} "
                            f"AND {reached} THEN {name} - {defaults[name]}")
        columns[name] = F.expr(f"CASE {' '.join(branches)} ELSE {name} END")
    return (df.withColumns(columns)
            .withColumns({f"log_{name}": guarded_log(name) for name in columns}))
