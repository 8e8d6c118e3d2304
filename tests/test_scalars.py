import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tenura import functions as fn
from tests.conftest import d


def value(spark, column, schema, *row):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_guarded_log(spark):
    for x, expected in ((None, 0.0), (-5, 0.0), (0, 0.0), (3, math.log(4))):
        assert abs(value(spark, fn.guarded_log("x"), "x bigint", x) - expected) < 1e-12


def test_flags_and_clipping(spark):
    for x, flag, clipped in ((None, False, 0), (-1, False, 0), (0, False, 0), (2, True, 2)):
        assert value(spark, fn.has_value("x"), "x bigint", x) is flag
        assert value(spark, fn.not_negative("x"), "x bigint", x) == clipped


def test_halves_round_to_even(spark):
    for probability, score in ((0.025, 2), (0.035, 4), (0.5, 50), (1.0, 100), (0.0, 0), (0.004, 0)):
        assert value(spark, fn.health_score("p"), "p double", probability) == score


def test_tenure_is_floored(spark):
    months = fn.whole_months("b", "a")
    assert value(spark, months, "a date, b date", d("2024-01-01"), d("2024-01-31")) == 0
    assert value(spark, months, "a date, b date", d("2024-01-01"), d("2024-02-01")) == 1
    assert value(spark, months, "a date, b date", d("2023-01-01"), d("2024-01-01")) == 12


def test_sector_and_name(spark):
    assert value(spark, fn.sector_bucket("s"), "s string", None) == "Unknown"
    assert value(spark, fn.sector_bucket("s"), "s string", "G") == "G"
    assert value(spark, fn.sector_bucket("s"), "s string", "g") == "NonG"
    for name, flag in ((None, False), ("GROOTHANDEL X", True), ("Bakery", False), ("Subtrading", True)):
        assert value(spark, fn.has_wholesale_name("s"), "s string", name) is flag


def test_score_timestamps(spark):
    assert value(spark, fn.parse_score_timestamp("s"), "s string", "10-24-19 09:30 PM") == dt.datetime(2019, 10, 24, 21, 30)
    assert value(spark, fn.parse_score_timestamp("s"), "s string", "not a date") is None


def test_lists_and_labels(spark):
    for env, found in (("nl", True), ("be", True), ("de", False)):
        assert value(spark, fn.in_list("e", " NL, BE"), "e string", env) is found
    assert value(spark, fn.in_list("e", ""), "e string", "nl") is False
    assert fn.label_text(" Professional Services") == "professionalservices"


def test_holiday_months(spark):
    assert [value(spark, fn.is_holiday_season("x"), "x date", dt.date(2024, m, 1)) for m in range(1, 13)] == \
        [m in (1, 5, 7, 8, 9) for m in range(1, 13)]


def test_add_period_clips():
    assert fn.add_period(d("2019-11-30"), 3) == d("2020-02-29")
    assert fn.add_period(d("2024-01-31"), -2) == d("2023-11-30")
    assert fn.add_period(d("2024-10-15"), 3) == d("2025-01-15")


@settings(max_examples=200)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2080, 12, 31)), st.integers(-24, 24))
def test_add_period_month(date, months):
    moved = fn.add_period(date, months)
    assert (moved.year * 12 + moved.month) - (date.year * 12 + date.month) == months
    assert moved.day <= date.day and (moved.day == date.day or (moved + dt.timedelta(days=1)).day == 1)
