"""Scalar building blocks.

Each function takes SQL text of a column (or an expression) and returns a Column
made of built-in functions, so all of it stays inside generated JVM code and a
wide projection costs the driver one call per output column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_MONTH = 30.4  # fixed value: average month used for tenure
HOLIDAY_MONTHS = (1, 5, 7, 8, 9)  # fixed values
# fixed value: name fragments that mark a trading company
WHOLESALE_NAME_PATTERN = "handel|trad|internation|product|materieel|wholesale"
SCORE_TIMESTAMP_FORMAT = "MM-dd-yy hh:mm a"  # 10-24-19 09:30 AM


def label_text(text: str) -> str:
    """A label as the tables have it: lower-cased without any blank."""
    return text.replace(" ", "").lower()


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(c: str, csv: str) -> Column:
    """Membership in a comma separated list ('NL,BE'), blanks and case ignored."""
    items = [part.strip().lower() for part in csv.split(",") if part.strip()]
    if not items:
        return F.lit(False)
    return F.expr(f"{c} IN ({', '.join(quoted(i) for i in items)})")


def guarded_log(c: str) -> Column:
    """log1p of a positive value; zero for NULL, zero and negative values."""
    return F.expr(f"CASE WHEN {c} > 0 THEN log1p(CAST({c} AS DOUBLE)) ELSE 0.0D END")


def has_value(c: str) -> Column:
    """True for a positive value, false for NULL and the rest."""
    return F.expr(f"coalesce({c} > 0, false)")


def not_negative(c: str) -> Column:
    """NULL and negative values become zero."""
    return F.expr(not_negative_sql(c))


def not_negative_sql(c: str) -> str:
    return f"greatest(coalesce({c}, 0), 0)"


def null_safe_sum_sql(*cols: str) -> str:
    """Row-wise sum that counts NULL as zero."""
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def whole_months(end: str, start: str) -> Column:
    """Whole average months between two dates."""
    return F.expr(f"CAST(floor(datediff({end}, {start}) / {DAYS_PER_MONTH}) AS INT)")


def is_holiday_season(c: str) -> Column:
    return F.expr(f"month({c}) IN {HOLIDAY_MONTHS}")


def sector_bucket(c: str) -> Column:
    return F.expr(f"CASE WHEN {c} IS NULL THEN 'Unknown' WHEN {c} = 'G' THEN 'G' ELSE 'NonG' END")


def has_wholesale_name(c: str) -> Column:
    return F.expr(f"coalesce(lower({c}) RLIKE '{WHOLESALE_NAME_PATTERN}', false)")


def parse_score_timestamp(c: str) -> Column:
    """Text such as '10-24-19 09:30 AM'; NULL when it does not parse."""
    return F.expr(f"try_to_timestamp({c}, '{SCORE_TIMESTAMP_FORMAT}')")


def health_score(probability: str) -> Column:
    """0..100 from the probability of NO event, halves rounded to the even score."""
    return F.expr(f"CAST(bround({probability} * 100, 0) AS INT)")


def event_probability(score: str) -> Column:
    """Inverse of health_score: probability of the event."""
    return F.expr(f"(100 - {score}) / 100.0D")


def add_period(date: dt.date, months: int) -> dt.date:
    """Same day some months later, clipped to the month's last day."""
    index = date.year * 12 + date.month - 1 + months
    year, month = divmod(index, 12)
    first_of_next = dt.date(year + (month == 11), (month + 1) % 12 + 1, 1)
    last_day = (first_of_next - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(date.day, last_day))
