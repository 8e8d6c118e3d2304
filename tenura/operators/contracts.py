"""Contract state as of a reference date, contract events, setup type."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import add_period, guarded_log, in_list, label_text, quoted, whole_months
from tenura.operators.grid import ACCOUNT, REF, Refs, as_of_latest, as_of_parts, by_ref, day, in_horizon, unfold, with_records
from tenura.sources.tables import Tables

UPGRADE_EVENT = "cup"  # fixed values: contract event types
DOWNGRADE_EVENT = "cdn"
DOWNGRADE_TARGET = "accounting"  # a downgrade ends in this product
# fixed values: account classes that take part
ACCOUNT_CLASSES = ("EOL", "ACC", "AC1", "AC7", "AC8", "JBO", "EO1")

# fixed values: setup type -> (rank, category); the lowest rank of an account wins
SETUP_CATEGORIES = {
    "Conversion": (1, "Other Software"),
    "XML/CSV_Import": (1, "Other Software"),
    "AccountantTemplate": (2, "Accountant Related"),
    "DivisionTransfer": (2, "Accountant Related"),
    "ExactTemplate": (3, "Exact Template"),
    "Demo": (4, "Demo"),
    "DivisionCopy": (5, "Other"),
    "Manual": (5, "Other"),
    "Empty": (5, "Other"),
}
TEMPORARY_SETUP = "TemporaryDivision"

CONTRACT_KEY = ("environment", "account_code")
CONTRACT_FIELDS = ("date", "package_code", "event_type", "account_id", "number_of_users",
                   "number_of_administrations", "accountant_or_linked", "mrr")


def _contract_state(tables: Tables, refs: Refs, fields: tuple[str, ...] = (), upgrades: bool = False) -> DataFrame:
    """Per (environment, account), for every reference date: the newest contract
    record and the date of the newest upgrade.

    A record starts with the date and holds every column used later, so rows of one
    date have one answer.
    """
    facts = tables.newest("activity_daily_contracts", refs)
    aggregates, names = [], []
    if fields:
        aggregates += as_of_parts(refs, "day", "date")
        names.append("day")
    if upgrades:
        aggregates += as_of_parts(refs, "upgrade", "date", f"event_type = '{UPGRADE_EVENT}'")
        names.append("upgrade")
    ends = as_of_latest(facts.groupBy(*CONTRACT_KEY).agg(*aggregates), refs, *names)
    return with_records(ends, facts, CONTRACT_KEY, refs, "day", "latest", fields) if fields else ends


def compact_contracts(rows: DataFrame) -> DataFrame:
    """The rows that any later reference date can need: of each account the newest record and the newest upgrade."""
    def newest(some: DataFrame) -> DataFrame:
        ends = some.groupBy(*CONTRACT_KEY).agg(F.max("date").alias("day_0"))
        return with_records(ends, some, CONTRACT_KEY, [dt.date.max], "day", "latest", CONTRACT_FIELDS).selectExpr(*CONTRACT_KEY, "latest_0.*")

    dated = rows.where("date IS NOT NULL")
    return newest(dated).unionByName(newest(dated.where(f"event_type = '{UPGRADE_EVENT}'")))


def latest_contract(tables: Tables, refs: Refs) -> DataFrame:
    """Newest contract row on or before each reference date."""
    return (unfold(_contract_state(tables, refs, CONTRACT_FIELDS), refs, "latest").where("latest IS NOT NULL")
            .selectExpr(*ACCOUNT, *[f"latest.{c}" for c in CONTRACT_FIELDS]))


def last_upgrade(tables: Tables, refs: Refs) -> DataFrame:
    """Date of the newest upgrade event on or before each reference date."""
    return (unfold(_contract_state(tables, refs, upgrades=True), refs, "upgrade").where("upgrade IS NOT NULL")
            .selectExpr(*ACCOUNT, "upgrade AS last_contract_upgrade_date"))


def packages(tables: Tables, product: str) -> DataFrame:
    """Packages of one product."""
    return tables.get("package_classification").where(f"product = {quoted(label_text(product))}")


def cohort(tables: Tables, refs: Refs, countries: str | None, product: str) -> DataFrame:
    """Accounts whose newest contract on the reference date is of the product."""
    folded = _contract_state(tables, refs, ("date", "package_code", "account_id"))
    if countries is not None:
        folded = folded.where(in_list("environment", countries))
    rows = unfold(folded, refs, "latest").selectExpr(*ACCOUNT, "latest.package_code", "latest.account_id")
    return rows.join(packages(tables, product).select("environment", "package_code"),
                     ["environment", "package_code"]).select(*ACCOUNT, "account_id", "package_code")


def valid_days(days: int) -> str:
    """Days of the look-back window covered by the commercial contract, plus those
    of a trial that ended before it."""
    start = f"date_sub({REF}, {days})"
    return (f"datediff({REF}, greatest(first_comm_start_date, {start})) + 1 + "
            f"CASE WHEN latest_trial_final_date <= first_comm_start_date AND latest_trial_final_date >= {start} "
            f"THEN datediff(latest_trial_final_date, greatest(first_trial_start_date, {start})) + 1 ELSE 0 END")


def contract_base(tables: Tables, refs: Refs, countries: str, product: str,
                  window_contract: int, window_activities: int,
                  account_classes=ACCOUNT_CLASSES) -> DataFrame:
    """One row per live account and reference date: account, contract, package,
    summary dates, tenure and valid days.

    The three large tables meet on (environment, account) while every reference
    date is still folded into one row; only the surviving accounts are unfolded.
    """
    classes = ", ".join(quoted(c) for c in account_classes)
    accounts = (tables.get("accounts")
                .where(in_list("environment", countries))
                .where(f"account_classification_code IN ({classes})")
                .selectExpr("environment", "account_code", "name AS account_name", "is_anonymized",
                            "account_classification_code", "sector_code"))
    # a cancellation on or before the first reference date, or an end by then, excludes all of them
    summary = (tables.get("accounts_contract_summary")
               .where(f"had_comm_contract = 1 AND first_comm_start_date < {day(max(refs))} "
                      f"AND latest_comm_final_date > {day(min(refs))} "
                      f"AND (full_cancellation_request_date IS NULL "
                      f"OR full_cancellation_request_date > {day(min(refs))})")
               .drop("had_comm_contract"))
    state = _contract_state(tables, refs, CONTRACT_FIELDS, upgrades=True)
    folded = (state.join(accounts, ["environment", "account_code"])
              .join(summary, ["environment", "account_code"]))
    rows = unfold(folded, refs, "latest", "upgrade").where(
        f"first_comm_start_date < {REF} AND latest_comm_final_date > {REF} "
        f"AND (full_cancellation_request_date IS NULL OR full_cancellation_request_date > {REF}) "
        "AND latest IS NOT NULL")
    rows = rows.selectExpr(
        *[c for c in rows.columns if c not in ("latest", "upgrade")],
        *[f"latest.{c}" for c in CONTRACT_FIELDS if c != "date"],
        "coalesce(upgrade, first_comm_start_date) AS last_contract_upgrade_date")
    rows = rows.join(packages(tables, product), ["environment", "package_code"])
    rows = rows.withColumns({
        "tenure_in_months": whole_months(REF, "first_comm_start_date"),
        "tenure_in_months_upgrade": whole_months(REF, "last_contract_upgrade_date"),
        "valid_contract_days": F.expr(valid_days(window_contract)),
        "valid_activity_days": F.expr(valid_days(window_activities)),
    })
    return rows.withColumns({
        "log_tenure_in_months": guarded_log("tenure_in_months"),
        "log_tenure_in_months_upgrade": guarded_log("tenure_in_months_upgrade"),
    })


def downgrade_events(tables: Tables, countries: str, product: str,
                     since: dt.date | None, until: dt.date | None) -> DataFrame:
    """Distinct (account, date) on which a package of the product left and one of
    the downgrade target came in, in one contract event.

    The lines of an event are brought together by one aggregate over their common
    key instead of joining the line table with itself.
    """
    left_product = quoted(label_text(product))
    lines = (tables.get("contracts", since, until)
             .where(in_list("environment", countries))
             .where(f"account_code IS NOT NULL AND event_date IS NOT NULL AND event_type = '{DOWNGRADE_EVENT}' "
                    "AND item_type = 'package' AND inflow_outflow IN ('inflow', 'outflow')"))
    wanted = (tables.get("package_classification")
              .where(f"product IN ({left_product}, '{DOWNGRADE_TARGET}')")
              .select("environment", "package_code", "product"))
    return (lines.join(wanted, ["environment", "package_code"])
            .groupBy("environment", "account_code", F.col("event_date").alias("downgrade_date"))
            .agg(F.expr(f"bool_or(inflow_outflow = 'inflow' AND product = '{DOWNGRADE_TARGET}') AS _came"),
                 F.expr(f"bool_or(inflow_outflow = 'outflow' AND product = {left_product}) AS _left"))
            .where("_came AND _left").drop("_came", "_left"))


def first_downgrade(tables: Tables, refs: Refs, countries: str, product: str, period: int) -> DataFrame:
    """First downgrade of each account in [ref, ref + period months]."""
    ends = {ref: add_period(ref, period) for ref in refs}
    events = downgrade_events(tables, countries, product, min(refs), max(ends.values()))
    return (in_horizon(events, ends, "downgrade_date")
            .groupBy(*ACCOUNT).agg(F.min("downgrade_date").alias("downgrade_date")))


def best_setup(tables: Tables, countries: str) -> DataFrame:
    """Best-ranked division setup category of each account id.

    An unlisted setup type has no rank and no category, and precedes the ranked ones.
    """
    def lookup(position: int) -> str:
        branches = " ".join(f"WHEN {quoted(name)} THEN {entry[position]!r}"
                            for name, entry in SETUP_CATEGORIES.items())
        return f"CASE master_data_setup_type {branches} END"

    events = (tables.get("divisions_master_data_setup")
              .where(f"master_data_setup_type IS NOT NULL AND master_data_setup_type != '{TEMPORARY_SETUP}'")
              .select("environment", "division_code", "account_id", "master_data_setup_type"))
    created = tables.get("divisions").select("environment", "division_code", "division_created")
    record = f"struct({lookup(0)} AS rank, division_created, {lookup(1)} AS category, environment)"
    return (events.join(created, ["environment", "division_code"])
            .groupBy("account_id").agg(F.expr(f"min({record}) AS best"))
            .where(in_list("best.environment", countries))
            .selectExpr("account_id", "best.category AS master_data_setup_type"))


def setup_type(tables: Tables, refs: Refs, countries: str, product: str) -> DataFrame:
    """Setup category of each account of the product's cohort."""
    accounts = cohort(tables, refs, None, product).select(*ACCOUNT, "account_id")
    return accounts.join(best_setup(tables, countries), "account_id").drop("account_id")


def churned(end: str) -> Column:
    """1.0 when the contract was cancelled or ended by the end of the period."""
    return F.expr(f"CASE WHEN full_cancellation_request_date <= {end} OR latest_comm_final_date <= {end} "
                  "THEN 1.0D ELSE 0.0D END")


def downgraded() -> Column:
    return F.expr("CASE WHEN downgrade_date IS NOT NULL THEN 1.0D ELSE 0.0D END")


def with_churn_label(df: DataFrame, refs: Refs, period: int) -> DataFrame:
    return df.withColumn("churned", churned(by_ref(refs, lambda ref: day(add_period(ref, period)))))
