"""Reference dates of the run modes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from tenura.plans.specs import TRAINING_WINDOWS, ProductSpec


def refine_dates(spec: ProductSpec, latest: Callable[[], dt.date], current: dt.date | None = None,
                 past: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """(current, past) from whichever was given; `latest` is the data freshness
    date and only asked for when needed."""
    window = dt.timedelta(days=spec.window_contract)
    if current is not None and past is not None:
        return current, past
    if past is not None:
        return min(latest(), past + window), past
    current = current or latest()
    return current, current - window


def training_dates(spec: ProductSpec, past: dt.date, windows: int = TRAINING_WINDOWS) -> list[dt.date]:
    """The past date and the ones before it, one contract window apart."""
    return [past - dt.timedelta(days=spec.window_contract * i) for i in range(windows)]


def evaluation_date(spec: ProductSpec, past: dt.date) -> dt.date:
    """One and a half windows before the past date (half days to the even day)."""
    return past - dt.timedelta(days=round(1.5 * spec.window_contract))
