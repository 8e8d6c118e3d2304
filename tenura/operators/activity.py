"""Features of the daily activity facts.

One aggregate per product computes every activity measure it needs, so the
facts are scanned once whatever the number of features.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.functions import guarded_log, in_list, not_negative, not_negative_sql, null_safe_sum_sql
from tenura.operators.contracts import CONTRACT_KEY, cohort
from tenura.operators.grid import ACCOUNT, REF, DistinctDays, Refs, in_look_back, look_back_windows
from tenura.operators.sideways import among, small_keys
from tenura.sources.sinks import cut_lineage
from tenura.sources.tables import Tables

# fixed values: activity codes
PAGE_VIEW = 1
LOGIN = 2
MOBILE = 8
CONTINUOUS_MONITORING = (5017, 5018, 5019)
SCANNING = (5003, 5005)
PROCESS_MANAGEMENT = (5004,)
MANUFACTURING_BASIC = (5175, 5060, 5061, 5062, 5058, 5173, 5261, 5259)
MANUFACTURING_ADVANCED = (5044, 5045, 5046, 5056, 5168)

SUMS: dict[str, tuple[int, ...]] = {
    "pageviews": (PAGE_VIEW,),
    "use_mobile": (MOBILE,),
    "continuous_monitoring": CONTINUOUS_MONITORING,
    "scanning": SCANNING,
    "process_management": PROCESS_MANAGEMENT,
    "manufacturing_basic": MANUFACTURING_BASIC,
    "manufacturing_advanced": MANUFACTURING_ADVANCED,
}
ACCOUNTANCY_SUMS = ("continuous_monitoring", "scanning", "process_management")
MANUFACTURING_SUMS = ("manufacturing_basic", "manufacturing_advanced")


def _facts(tables: Tables, refs: Refs, window: int, countries: str | None, ids=None, keys: DataFrame | None = None) -> DataFrame:
    """Activity rows of the look-back windows, tagged with their reference date; of the accounts among `keys` only."""
    rows = tables.get("activity_daily", windows=look_back_windows(refs, window))
    if countries is not None:
        rows = rows.where(in_list("environment", countries))
    if ids is not None:
        rows = rows.where(f"activity_id IN ({', '.join(map(str, ids))})")
    return in_look_back(among(rows, keys), refs, window)


def _sum_of(measure: str) -> Column:
    ids = ", ".join(map(str, SUMS[measure]))
    return F.expr(f"sum(CASE WHEN activity_id IN ({ids}) THEN quantity END) AS {measure}")


def _logins() -> Column:
    return F.expr(f"count(CASE WHEN activity_id = {LOGIN} THEN date END) AS active_days")


def activity_measures(tables: Tables, refs: Refs, window: int, countries: str | None,
                      sums: tuple[str, ...] = (), logins: bool = False, actives: bool = False,
                      every_activity: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Requested measures per account. `every_activity` keeps accounts whose only
    activity is of other kinds (their sums are NULL). Facts of accounts that are
    not among `keys` may be left out."""
    ids = {i for measure in sums for i in SUMS[measure]} | ({LOGIN} if logins else set()) \
        | ({PAGE_VIEW} if actives else set())
    facts = _facts(tables, refs, window, countries, None if every_activity else sorted(ids), keys)
    aggregates = [_sum_of(m) for m in sums] + ([_logins()] if logins else [])
    if not actives:
        return facts.groupBy(*ACCOUNT).agg(*aggregates)
    # Reduce to one row per account, user and division first: the distinct counts
    # then work on that, not on the facts.
    viewed = F.expr(f"bool_or(activity_id = {PAGE_VIEW}) AS _viewed")
    reduced = facts.groupBy(*ACCOUNT, "user_id", "division_code").agg(viewed, *aggregates)
    again = [F.sum(m).alias(m) for m in [*sums, *(["active_days"] if logins else [])]]
    return reduced.groupBy(*ACCOUNT).agg(
        F.expr("count(DISTINCT CASE WHEN _viewed THEN user_id END) AS active_users"),
        F.expr("count(DISTINCT CASE WHEN _viewed THEN division_code END) AS active_divisions"),
        *again)


def _of_cohort(measures: Callable[[DataFrame | None], DataFrame], tables: Tables, refs: Refs, countries: str, product: str) -> DataFrame:
    """Measures of the product's accounts. Where the tables allow the keys some bytes, the cohort is found first and
    keeps the facts of other accounts out of the aggregate."""
    accounts = cohort(tables, refs, countries, product).select(*ACCOUNT)
    keys = None
    if tables.cohort_bytes:
        accounts = cut_lineage(accounts, "cohort")
        keys = small_keys(accounts, CONTRACT_KEY, tables.cohort_bytes)
    return measures(keys).join(accounts, ACCOUNT)


def _measured(tables: Tables, refs: Refs, window: int, countries: str, product: str, sums: tuple[str, ...] = (), **wanted) -> DataFrame:
    """activity_measures of the product's accounts."""
    return _of_cohort(lambda keys: activity_measures(tables, refs, window, countries, sums, keys=keys, **wanted),
                      tables, refs, countries, product)


def pageviews(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    return _measured(tables, refs, window, countries, product, ("pageviews",))


def active_days(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    """Number of login records per account."""
    return _measured(tables, refs, window, countries, product, logins=True)


def mobile_use(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    return _measured(tables, refs, window, countries, product, ("use_mobile",))


def accountancy_activity(tables: Tables, refs: Refs, window: int, countries: str,
                         product: str = "Accountancy") -> DataFrame:
    return _measured(tables, refs, window, countries, product, ACCOUNTANCY_SUMS, every_activity=True)


def manufacturing_activity(tables: Tables, refs: Refs, window: int, countries: str,
                           product: str = "Manufacturing") -> DataFrame:
    return _measured(tables, refs, window, countries, product, MANUFACTURING_SUMS, every_activity=True)


def active_users_divisions(tables: Tables, refs: Refs, window: int, countries: str, product: str) -> DataFrame:
    return _measured(tables, refs, window, countries, product, actives=True)


def user_roles(tables: Tables, refs: Refs, window: int, countries: str, keys: DataFrame | None = None) -> DataFrame:
    """Page views, and the days on which an account's own users (entrepreneur) and
    users of an accountant account (accountant) viewed pages in it.

    Facts are reduced to one row per account and user before the users are looked
    up, so the joins carry no fact rows. Users of unknown accounts count for the
    page views only. Facts of accounts that are not among `keys` may be left out.
    """
    own, other, days = (DistinctDays(name, window) for name in ("own", "other", "days"))
    by_user = (_facts(tables, refs, window, countries, [PAGE_VIEW], keys)
               .groupBy(*ACCOUNT, "account_id", "user_id")
               .agg(F.sum("quantity").alias("_views"), *days.of_rows()))
    homes = (tables.get("accounts").where("account_id IS NOT NULL").groupBy("account_id")
             .agg(F.expr("bool_or(is_accountant = 'Accountant') AS _accountant")))
    users = (tables.get("users").join(homes, "account_id")
             .selectExpr("user_id", "account_id AS _home", "_accountant"))
    # rows without a user would all meet in one task: each account's go their own way, and match nobody
    nobody = F.concat(F.lit("\0"), "environment", "account_code")
    by_user = by_user.withColumn("user_id", F.coalesce("user_id", nobody))
    merged = (by_user.join(users, "user_id", "left").groupBy(*ACCOUNT)
              .agg(F.sum("_views").alias("pageviews"), F.count("_home").alias("_known"),
                   *own.merged("account_id = _home", days),
                   *other.merged("account_id != _home AND _accountant", days)))
    return merged.selectExpr(
        *ACCOUNT, "pageviews", "_known",
        f"nullif(CAST({own.count()} AS BIGINT), 0L) AS entrepreneur_days_active",
        f"nullif(CAST({other.count()} AS BIGINT), 0L) AS accountant_days_active")


def user_role_days(tables: Tables, refs: Refs, window: int, countries: str) -> DataFrame:
    """Accounts with at least one known user; a role that was not active is NULL."""
    return (user_roles(tables, refs, window, countries).where("_known > 0")
            .select(*ACCOUNT, "entrepreneur_days_active", "accountant_days_active"))


def linked_companies(tables: Tables, refs: Refs, window: int, countries: str) -> DataFrame:
    """Work of an account's users in other accounts: days, divisions, page views."""
    days = DistinctDays("days", window)
    by_place = (_facts(tables, refs, window, None, [PAGE_VIEW])
                .groupBy(REF, "user_id", F.col("account_id").alias("_visited"), "division_code")
                .agg(F.sum("quantity").alias("_views"), *days.of_rows()))
    homes = (tables.get("accounts").where(in_list("environment", countries))
             .select("environment", "account_code", "account_id"))
    users = tables.get("users").join(homes, "account_id")
    visits = by_place.join(users, "user_id").where("account_id != _visited")
    # per division first, so the distinct count is a plain count of groups
    per_division = (visits.groupBy(*ACCOUNT, "division_code")
                    .agg(F.sum("_views").alias("_views"), *days.merged()))
    merged = per_division.groupBy(*ACCOUNT).agg(
        F.count("division_code").alias("num_active_linked_companies"),
        F.sum("_views").alias("pageviews_on_linked_companies"), *days.merged())
    return merged.selectExpr(*ACCOUNT, f"CAST({days.count()} AS BIGINT) AS active_days_on_linked_companies",
                             "num_active_linked_companies", "pageviews_on_linked_companies")


def accountant_status() -> Column:
    """Active, Inactive (linked but not seen) or NotLinked."""
    return F.expr("CASE WHEN coalesce(accountant_days_active, 0) > 0 THEN 'Active' "
                  "WHEN accountant_or_linked THEN 'Inactive' ELSE 'NotLinked' END")


def with_accountancy_total(df: DataFrame) -> DataFrame:
    total = "(" + " + ".join(not_negative_sql(c) for c in ACCOUNTANCY_SUMS) + ")"
    return df.withColumns({**{c: not_negative(c) for c in ACCOUNTANCY_SUMS},
                           "other_accountancy_activities": F.expr(total),
                           "log_other_accountancy_activities": guarded_log(total)})


def with_manufacturing_total(df: DataFrame) -> DataFrame:
    total = null_safe_sum_sql(*MANUFACTURING_SUMS)
    return df.withColumns({**{c: F.expr(f"coalesce({c}, 0)") for c in MANUFACTURING_SUMS},
                           "log_manufacturing_activities": guarded_log(total)})
