"""The parameterised queries by name, with positional parameters.

    run_named(tables, "active_days", [date(2024, 1, 30), 91, "NL,BE", "Accounting"])

Dates may be dates or ISO text. Each result holds one row per account (or score)
and, where the question has a reference date, that date as a column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from tenura.operators import activity, contracts, divisions, monitoring
from tenura.sources.tables import Tables


def _day(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(str(value)[:10])


def _windowed(operator):
    return lambda t, end, window, environment, product: operator(t, [_day(end)], window, environment, product)


NAMED: dict[str, Callable[..., DataFrame]] = {
    # end date, environment, product
    "contract_base": lambda t, end, environment, product: contracts.contract_base(
        t, [_day(end)], environment, product, 91, 91),
    "setup_type": lambda t, end, environment, product: contracts.setup_type(t, [_day(end)], environment, product),
    # end date, window, environment, product
    "active_days": _windowed(activity.active_days),
    "pageviews": _windowed(activity.pageviews),
    "mobile_use": _windowed(activity.mobile_use),
    "accountancy_activity": _windowed(activity.accountancy_activity),
    "manufacturing_activity": _windowed(activity.manufacturing_activity),
    "active_users_divisions": _windowed(activity.active_users_divisions),
    "financial_statistics": _windowed(divisions.financial_statistics),
    "project_statistics": _windowed(divisions.project_statistics),
    "growth_statistics": _windowed(divisions.growth_statistics),
    "user_role_days": lambda t, end, window, environment, product=None: activity.user_role_days(
        t, [_day(end)], window, environment),
    # end date, window, environment
    "linked_companies": lambda t, end, window, environment: activity.linked_companies(
        t, [_day(end)], window, environment),
    # end date, environment, product, start date
    "downgrade_events": lambda t, end, environment, product, start: contracts.downgrade_events(
        t, environment, product, _day(start), _day(end)),
    "freshness_date": monitoring.freshness_date,
    # date, environment, product, phase
    "health_score_exists": lambda t, end, environment, product, phase: monitoring.score_exists(
        t, "churn", _day(end), environment, product, phase),
    "downgrade_score_exists": lambda t, end, environment, product, phase: monitoring.score_exists(
        t, "downgrade", _day(end), environment, product, phase),
    "old_churn_scores": lambda t, past, environment, product, phase: monitoring.old_churn_scores(
        t, _day(past), environment, product, phase),
    # date, environment, product
    "old_downgrade_scores": lambda t, past, environment, product: monitoring.old_downgrade_scores(
        t, _day(past), environment, product),
}


def run_named(tables: Tables, name: str, params: Sequence = ()) -> DataFrame:
    if name not in NAMED:
        raise ValueError(f"unknown query {name!r}; known: {', '.join(sorted(NAMED))}")
    return NAMED[name](tables, *params)
