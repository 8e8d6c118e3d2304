"""Feature sets of the products, for any list of reference dates.

The contract base fixes the rows. Each fact table is aggregated once, with every
measure the product needs, and left-joined to the base: activity on the account,
division measures on the account id. Reference dates are part of every key, so a
training set over several windows is one plan, not one plan per window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.functions import (
    guarded_log, has_value, has_wholesale_name, is_holiday_season, null_safe_sum_sql, quoted, sector_bucket,
)
from tenura.operators import activity, contracts, divisions
from tenura.operators.grid import ACCOUNT, REF, Refs
from tenura.operators.sideways import small_keys
from tenura.plans.specs import KEYS, ProductSpec
from tenura.sources.sinks import cut_lineage
from tenura.sources.tables import Tables


@dataclass(frozen=True)
class Recipe:
    """Which blocks a product is made of."""

    sums: tuple[str, ...] = ()
    logins: bool = False
    actives: bool = False
    roles: bool = False
    linked: bool = False
    growth: bool = False
    projects: bool = False
    setup: bool = False


RECIPES = {
    "accounting_established": Recipe(roles=True),
    "accounting_onboarding": Recipe(roles=True, setup=True),
    "accountancy": Recipe(sums=activity.ACCOUNTANCY_SUMS, logins=True, linked=True),
    "manufacturing": Recipe(sums=("use_mobile", *activity.MANUFACTURING_SUMS), logins=True),
    "professional_services": Recipe(sums=("use_mobile",), logins=True, projects=True),
    "wholesale_distribution": Recipe(sums=("use_mobile",), logins=True, actives=True, growth=True),
}

# fixed values: professional services starts from these instead of NULL
PROFESSIONAL_SERVICES_DEFAULTS = {
    "sector_code": "Unknown",
    **{c: 0 for c in (
        "use_mobile", "num_activated_divisions", "big3_bank_account", "bank_link", "ever_sent_invoice",
        "currency_count", "gl_transactions", "sales_invoice", "purchase_entry_count", "stock_count_entry",
        "bank_entry_count", "cash_entry_count", "sales_entry_count", "general_journal_entry_count",
        "account_count")},
}


def base_accounts(tables: Tables, refs: Refs, spec: ProductSpec) -> DataFrame:
    base = contracts.contract_base(tables, refs, spec.countries, spec.product,
                                   spec.window_contract, spec.window_activities, spec.account_classes)
    if spec.min_tenure is not None:
        base = base.where(f"tenure_in_months >= {spec.min_tenure}")
    if spec.below_tenure is not None:
        base = base.where(f"tenure_in_months < {spec.below_tenure}")
    if spec.excluded_edition is not None:
        base = base.where(f"NOT (edition <=> {quoted(spec.excluded_edition)})")
    return base


def with_activity(df: DataFrame, tables: Tables, refs: Refs, spec: ProductSpec, recipe: Recipe,
                  keys: DataFrame | None = None) -> DataFrame:
    window, countries = spec.window_activities, spec.countries
    if recipe.roles:
        roles = activity.user_roles(tables, refs, window, countries, keys).drop("_known")
        df = df.join(roles, ACCOUNT, "left").withColumns({
            "accountant_days_active": F.expr("coalesce(accountant_days_active, 0)"),
            "accountant": activity.accountant_status(),
            "entrepreneur_active": has_value("entrepreneur_days_active"),
            "log_pageviews": guarded_log("pageviews"),
        })
    if recipe.sums or recipe.logins or recipe.actives:
        measures = activity.activity_measures(tables, refs, window, countries, recipe.sums,
                                              recipe.logins, recipe.actives, keys=keys)
        df = df.join(measures, ACCOUNT, "left")
    if recipe.logins:
        days = "coalesce(active_days, 0)"
        df = df.withColumns({"active_days": F.expr(days),
                             "login_freq": F.expr(f"try_divide({days}, valid_activity_days)")})
    if "use_mobile" in recipe.sums:
        df = df.withColumn("recent_use_mobile", F.expr("use_mobile IS NOT NULL"))
    if recipe.actives:
        df = df.withColumns({c: F.expr(f"coalesce({c}, 0)") for c in ("active_users", "active_divisions")})
    if recipe.linked:
        linked = activity.linked_companies(tables, refs, window, countries)
        df = df.join(linked, ACCOUNT, "left").withColumns({
            f"log_{c}": guarded_log(c) for c in ("num_active_linked_companies", "pageviews_on_linked_companies")})
    if set(activity.ACCOUNTANCY_SUMS) <= set(recipe.sums):
        df = activity.with_accountancy_total(df)
    if set(activity.MANUFACTURING_SUMS) <= set(recipe.sums):
        df = activity.with_manufacturing_total(df)
    return df


def with_divisions(df: DataFrame, tables: Tables, refs: Refs, spec: ProductSpec, recipe: Recipe,
                   ids: DataFrame | None = None) -> DataFrame:
    measures = divisions.division_measures(
        tables, refs, spec.window_activities, spec.countries, financial=True,
        growth=recipe.growth, projects=recipe.projects, ids=ids)
    names = {**{f"fin_{c}": c for c in divisions.FINANCIAL},
             **({f"growth_{c}": c for c in divisions.GROWTH} if recipe.growth else {}),
             **({f"project_{c}": c for c in divisions.PROJECTS} if recipe.projects else {})}
    measures = measures.withColumnsRenamed(names).drop("_financial", "_growth", "_projects")
    df = divisions.with_financial_features(df.join(measures, [REF, "account_id"], "left"))
    return divisions.with_growth_logs(df) if recipe.growth else df


def with_label(df: DataFrame, tables: Tables, refs: Refs, spec: ProductSpec) -> DataFrame:
    if spec.category == "churn":
        return contracts.with_churn_label(df, refs, spec.period)
    events = contracts.first_downgrade(tables, refs, spec.countries, spec.product, spec.period)
    return df.join(events, ACCOUNT, "left").withColumn(spec.label, contracts.downgraded())


def features(tables: Tables, refs: Refs, spec: ProductSpec, label: bool = True) -> DataFrame:
    """Every feature of the product, one row per account and reference date."""
    recipe = RECIPES[spec.name]
    df = base_accounts(tables, refs, spec)
    keys = ids = None
    if tables.cohort_bytes:  # the base is found first; facts of other accounts stay out of every aggregate
        df = cut_lineage(df, "base")
        keys = small_keys(df, contracts.CONTRACT_KEY, tables.cohort_bytes)
        ids = small_keys(df, ["account_id"], tables.cohort_bytes)
    df = with_divisions(df, tables, refs, spec, recipe, ids)
    df = with_activity(df, tables, refs, spec, recipe, keys)
    if recipe.setup:
        setup = contracts.best_setup(tables, spec.countries)
        df = df.join(setup, "account_id", "left").withColumn(
            "master_data_setup_type", F.expr("coalesce(master_data_setup_type, 'Unknown')"))
        df = divisions.without_default_entries(df)
    if spec.name == "accountancy":
        df = df.fillna(0, ["sales_invoice", "project_total_time_entries"])
        df = df.withColumn("log_time_sales_invoice_entry", guarded_log(
            null_safe_sum_sql("sales_invoice", "project_total_time_entries")))
    elif spec.name == "manufacturing":
        df = df.withColumn("log_stock_count_entry_count", guarded_log("stock_count_entry"))
    elif spec.name == "professional_services":
        df = divisions.with_project_features(df.fillna(PROFESSIONAL_SERVICES_DEFAULTS))
    elif spec.name == "wholesale_distribution":
        df = df.withColumns({"sector": sector_bucket("sector_code"),
                             "has_wholesale_name": has_wholesale_name("account_name")})
    df = df.withColumn("is_holiday_season", is_holiday_season(REF))
    return with_label(df, tables, refs, spec) if label else df


def model_columns(spec: ProductSpec, label: bool = True) -> list[str]:
    """Keys, predictors and label, always in this order."""
    keys = [REF, *KEYS]
    return [*keys, *[p for p in spec.predictors if p not in keys], *([spec.label] if label else [])]


def dataset(tables: Tables, refs: Sequence, spec: ProductSpec, label: bool = True) -> DataFrame:
    """Model input: columns the model does not use are pruned from every scan."""
    return features(tables, list(refs), spec, label).select(*model_columns(spec, label))
