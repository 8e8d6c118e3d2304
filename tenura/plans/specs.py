"""Product specifications: what a model of one product is trained on."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace

from tenura.operators.contracts import ACCOUNT_CLASSES

KEYS = ("environment", "account_code", "package_code")
TRAINING_WINDOWS = 4


@dataclass(frozen=True)
class ProductSpec:
    category: str  # churn or downgrade
    name: str
    product: str
    phase: str
    countries: str
    predictors: tuple[str, ...]
    accepted_auc: float
    window_activities: int
    window_contract: int = 91
    period: int = 3
    algorithm: str = "LogisticRegression"
    min_tenure: int | None = None  # whole months, included
    below_tenure: int | None = None
    excluded_edition: str | None = None
    account_classes: tuple[str, ...] = ACCOUNT_CLASSES

    def __post_init__(self):
        if self.category not in LABELS:
            raise ValueError(f"unknown category {self.category!r}")
        if self.name not in FAMILIES:
            raise ValueError(f"unknown product specification {self.name!r}")
        if len(set(self.predictors)) != len(self.predictors) or not self.predictors:
            raise ValueError("predictors must be distinct and not empty")

    @property
    def label(self) -> str:
        return LABELS[self.category]

    @property
    def model_name(self) -> str:
        return f"{self.category}_{self.name}"

    def everywhere(self, countries: str) -> ProductSpec:
        return replace(self, countries=countries)


LABELS = {"churn": "churned", "downgrade": "downgraded"}
FAMILIES = ("accounting_established", "accounting_onboarding", "accountancy", "manufacturing",
            "professional_services", "wholesale_distribution")

# Restrictions that are part of the product, not of a configuration file.
COHORTS: dict[str, dict] = {
    "accounting_established": {"min_tenure": 6},
    "accounting_onboarding": {"below_tenure": 6},
    "accountancy": {"excluded_edition": "Basic"},
}

# fixed values: configuration of the published models
CHURN = {
    "accounting_established": ProductSpec(
        "churn", "accounting_established", "Accounting", "Established", "NL,BE",
        ("log_pageviews", "log_bank_entry_count", "log_cash_entry_count", "accountant",
         "log_sales_entry_count", "log_purchase_entry_count", "log_general_journal_entry_count",
         "entrepreneur_active", "log_tenure_in_months_upgrade", "environment"),
        accepted_auc=0.80, window_activities=91, min_tenure=6),
    "accounting_onboarding": ProductSpec(
        "churn", "accounting_onboarding", "Accounting", "Onboarding", "NL,BE",
        ("tenure_in_months", "accountant", "master_data_setup_type", "log_bank_entry_count",
         "log_cash_entry_count", "log_account_count", "log_pageviews", "log_sales_entry_count",
         "log_purchase_entry_count", "has_currency_count", "log_general_journal_entry_count",
         "entrepreneur_active", "environment"),
        accepted_auc=0.75, window_activities=91, below_tenure=6),
    "accountancy": ProductSpec(
        "churn", "accountancy", "Accountancy", "All", "NL,BE",
        ("login_freq", "log_bank_entry_count", "log_cash_entry_count", "log_sales_entry_count",
         "log_purchase_entry_count", "log_general_journal_entry_count", "log_other_accountancy_activities",
         "tenure_in_months_upgrade", "log_num_activated_divisions", "log_num_active_linked_companies",
         "log_pageviews_on_linked_companies", "log_time_sales_invoice_entry"),
        accepted_auc=0.80, window_activities=91, excluded_edition="Basic"),
    "manufacturing": ProductSpec(
        "churn", "manufacturing", "Manufacturing", "All", "NL",
        ("tenure_in_months_upgrade", "recent_use_mobile", "login_freq", "has_bank_link",
         "log_bank_entry_count", "has_sales_invoice", "log_sales_entry_count", "log_purchase_entry_count",
         "log_manufacturing_activities"),
        accepted_auc=0.83, window_activities=30),
    "professional_services": ProductSpec(
        "churn", "professional_services", "Professional services", "All", "NL,BE",
        ("recent_use_mobile", "login_freq", "has_sales_invoice", "log_sales_entry_count",
         "log_bank_entry_count", "log_projects_count", "log_project_time_cost_entries_count", "environment"),
        accepted_auc=0.80, window_activities=30),
    "wholesale_distribution": ProductSpec(
        "churn", "wholesale_distribution", "Wholesale distribution", "All", "NL,BE",
        ("tenure_in_months_upgrade", "recent_use_mobile", "login_freq", "accountant_or_linked",
         "active_users", "log_bank_entry_count", "log_cash_entry_count", "log_quote_count",
         "log_stock_count_entry_count", "log_sales_entry_count", "log_purchase_entry_count", "environment"),
        accepted_auc=0.83, window_activities=30),
}
DOWNGRADE = {
    "professional_services": ProductSpec(
        "downgrade", "professional_services", "Professional services", "All", "NL,BE",
        ("recent_use_mobile", "has_sales_invoice", "log_projects_count", "log_project_time_cost_entries_count",
         "bank_link", "big3_bank_account", "has_bank_link", "has_big3_bank_account", "log_tenure_in_months",
         "log_tenure_in_months_upgrade", "project_type_prepaid_htb"),
        accepted_auc=0.80, window_activities=30),
    "wholesale_distribution": ProductSpec(
        "downgrade", "wholesale_distribution", "Wholesale distribution", "All", "NL",
        ("tenure_in_months_upgrade", "recent_use_mobile", "login_freq", "accountant_or_linked",
         "active_users", "sector", "has_bank_link", "has_wholesale_name", "log_quote_count",
         "log_account_count", "log_stock_count_entry_count", "log_item_count",
         "log_sales_order_entry_count", "log_purchase_order_entry_count"),
        accepted_auc=0.82, window_activities=30),
}
SPECS = {"churn": CHURN, "downgrade": DOWNGRADE}


def get_spec(category: str, name: str) -> ProductSpec:
    try:
        return SPECS[category][name]
    except KeyError:
        raise ValueError(f"no specification {category}/{name}") from None


# names that older configurations spell differently
_RENAMED = {
    "log_other_accoutancy_activities": "log_other_accountancy_activities",
    "log_tenure_upgrade_in_months": "log_tenure_in_months_upgrade",
    "tenure_upgrade_in_months": "tenure_in_months_upgrade",
}


def snake_case(name: str) -> str:
    """LogProjectTypePrepaidHTB -> log_project_type_prepaid_htb."""
    out = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name).lower()
    return _RENAMED.get(out, out)


def load_spec(path: str, category: str, name: str) -> ProductSpec:
    """A JSON configuration: product, phase, country, period, window_activities,
    window_contract, algorithm, accepted_auc, predictors."""
    with open(path) as handle:
        raw = json.load(handle)
    missing = {"product", "country", "predictors", "window_activities"} - set(raw)
    if missing:
        raise ValueError(f"{path}: missing {sorted(missing)}")
    return ProductSpec(
        category, name, raw["product"], raw.get("phase", "All"), raw["country"],
        tuple(snake_case(p) for p in raw["predictors"]),
        accepted_auc=raw.get("accepted_auc", 0.8), window_activities=raw["window_activities"],
        window_contract=raw.get("window_contract", 91), period=raw.get("period", 3),
        algorithm=raw.get("algorithm", "LogisticRegression"),
        account_classes=tuple(raw.get("account_classes", ACCOUNT_CLASSES)), **COHORTS.get(name, {}))
