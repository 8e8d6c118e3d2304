import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tenura.sources import sinks
from tenura.sources.tables import DIRECTORIES, SCHEMAS, Tables, column_names, read_health_score_csv, run_sql
from tenura.sources.testdata import MAPPINGS, REFERENCE_DATE, star_schema_tables
from tests.conftest import d, rows
from tests.fixtures import tables
from tests.test_plan_quality import plan_text

SF = "/root/testdata/sf0.001"


def test_keys_are_normalised_and_columns_typed(spark):
    t = tables(spark)
    accounts = t.get("accounts")
    assert accounts.columns == column_names("accounts")
    assert {r[0] for r in accounts.select("environment").collect()} == {"nl", "be"}
    assert {r[0] for r in t.get("package_classification").select("product").distinct().collect()} == {
        "accounting", "accountancy", "manufacturing", "professionalservices", "wholesaledistribution"}


def test_lake_layout_with_other_spellings_and_text_codes(spark, tmp_path):
    stored = spark.createDataFrame(
        [(" NL", "A1 ", "ID-1", "U1", "D1", "1", d("2024-01-01"), 3), ("NL", "A2", "ID-2", "U2", "D1", "x", d("2024-01-02"), 4)],
        "Environment string, AccountCode string, AccountID string, UserID string, DivisionCode string, "
        "ActivityID string, Date date, Quantity bigint")
    stored.write.parquet(str(tmp_path / "ActivityDaily"))
    t = Tables.from_parquet(spark, str(tmp_path))
    assert rows(t.get("activity_daily"), "account_code", "activity_id") == [("a1", 1), ("a2", None)]
    bounded = t.get("activity_daily", d("2024-01-02"), d("2024-01-02"))
    assert rows(bounded, "account_code") == [("a2",)]
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(Date,2024-01-02)" in plan


def test_timestamps_and_date_partitions_are_filtered_at_the_scan(spark, tmp_path):
    stamped = spark.createDataFrame([("D1", dt.datetime(2024, 1, 1, 23, 59)), ("D2", dt.datetime(2024, 1, 2, 0, 0)),
                                     ("D3", dt.datetime(2024, 1, 2, 23, 59)), ("D4", dt.datetime(2024, 1, 3))],
                                    "divisioncode string, date timestamp")
    stamped.write.parquet(str(tmp_path / "DivisionStatistics_Daily"))
    by_day = stamped.selectExpr("divisioncode", "to_date(date) AS date")
    by_day.write.partitionBy("date").parquet(str(tmp_path / "DivisionStatistics_DailyChanges"))
    t = Tables.from_parquet(spark, str(tmp_path))
    for name, sign in (("division_statistics_daily", "PushedFilters: [IsNotNull(date), GreaterThanOrEqual(date"),
                       ("division_statistics_daily_changes", "PartitionFilters: [isnotnull(date#")):
        df = t.get(name, d("2024-01-02"), d("2024-01-02"))
        assert rows(df, "division_code") == [("d2",), ("d3",)]
        assert sign in df._jdf.queryExecution().executedPlan().toString()


def test_glob_and_schema_merge(spark, tmp_path):
    base = "environment string, divisioncode string, date date"
    spark.createDataFrame([("NL", "D1", d("2024-01-01"))], base).write.parquet(str(tmp_path / "daily/2024/01/01"))
    spark.createDataFrame([("NL", "D2", d("2024-01-02"), 7)], base + ", quotecount bigint").write.parquet(
        str(tmp_path / "daily/2024/01/02"))
    t = Tables.from_parquet(spark, str(tmp_path), merge_schema=True,
                            paths={"division_statistics_daily": str(tmp_path / "daily/*/*/*")})
    assert rows(t.get("division_statistics_daily"), "division_code", "quote_count") == [("d1", None), ("d2", 7)]


def test_score_csv(spark, tmp_path):
    path = tmp_path / "scores.csv"
    path.write_text("index,healthscore,environment,accountcode,packagecode,phase,referencedate,predictdate\n"
                    "0,80, NL ,A1,P1,All,10-24-19 12:00 AM,10-25-19 09:30 PM\n"
                    "1,oops,BE,A2,P1,All,bad,10-25-19 09:30 AM\n")
    t = tables(spark).with_table("health_score", read_health_score_csv(spark, str(path)))
    assert rows(t.get("health_score"), "environment", "health_score", "reference_date", "predict_date") == [
        ("be", None, None, dt.datetime(2019, 10, 25, 9, 30)),
        ("nl", 80, d("2019-10-24"), dt.datetime(2019, 10, 25, 21, 30))]


def test_unknown_table_is_refused(spark):
    with pytest.raises(ValueError):
        Tables.from_frames(spark, {"nonsense": spark.range(1)})


def test_parameterised_sql(spark):
    tables(spark).register_views("v_")
    got = run_sql(spark, "SELECT account_code FROM v_accounts WHERE array_contains(split(:countries, ','), environment) "
                         "AND is_anonymized = :flag", countries="nl,be", flag=True)
    assert rows(got) == [("b1",)]


@pytest.mark.parametrize("name", [n for n, m in MAPPINGS.items() if m.bound_column])
def test_pushed_bounds_keep_exactly_the_rows(spark, name):
    t = star_schema_tables(spark, SF)
    column = "event_date" if name == "contracts" else "date"
    whole = t.get(name)
    for since, until in ((d("2023-11-01"), REFERENCE_DATE), (d("2023-12-24"), d("2023-12-24")), (None, d("2023-08-01"))):
        bounded = t.get(name, since, until)
        limits = [F.col(column) >= F.lit(since)] if since else []
        expected = whole.where(F.col(column) <= F.lit(until))
        for limit in limits:
            expected = expected.where(limit)
        assert bounded.count() == expected.count()
        assert "PushedFilters: [IsNotNull(" in bounded._jdf.queryExecution().executedPlan().toString()


def test_every_table_is_mapped(spark):
    t = star_schema_tables(spark, SF)
    for name in SCHEMAS:
        assert t.get(name).columns == column_names(name)
        assert not t.get(name).isEmpty()


def test_writing_a_date_again_replaces_it(spark, tmp_path):
    path = str(tmp_path / "out")
    schema = "account_code string, reference_date date"
    sinks.write_by_reference_date(spark.createDataFrame([("a", d("2024-01-01")), ("b", d("2024-02-01"))], schema), path)
    sinks.write_by_reference_date(spark.createDataFrame([("c", d("2024-02-01"))], schema), path)
    assert rows(spark.read.parquet(path), "account_code") == [("a",), ("c",)]


def test_append_sinks(spark, tmp_path):
    row = sinks.statistics_row(spark, run="train", environment="NL", auc=0.9, reference_date=d("2024-01-01"))
    for kind in ("parquet", "csv"):
        path = str(tmp_path / kind)
        sinks.append_rows(row, path, kind)
        sinks.append_rows(row, path, kind)
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    assert spark.read.csv(str(tmp_path / "csv"), header=True).select("auc").collect() == [("0.9",), ("0.9",)]
    sinks.append_rows(row, "train_statistics_test", "table")
    sinks.append_rows(row, "train_statistics_test", "table")
    assert spark.table("train_statistics_test").count() == 2
    spark.sql("DROP TABLE train_statistics_test")
    with pytest.raises(ValueError):
        sinks.append_rows(row, "x", "carrier pigeon")
    with pytest.raises(ValueError):
        sinks.statistics_row(spark, colour="red")


def test_checkpoint_folder_of_the_session_is_used(spark):
    df = sinks.cut_lineage(spark.range(5))
    assert df.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in spark.sparkContext.getCheckpointDir()


def test_table_published_again_replaces_its_dates(spark):
    name = "published_again"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    names = "account_code string, score int, reference_date date"
    first = spark.createDataFrame([("a", 1, d("2024-01-01")), ("b", 2, d("2024-02-01"))], names)
    sinks.publish_table(first, name)
    again = spark.createDataFrame([(d("2024-02-01"), 9, "c")], "reference_date date, score int, account_code string")
    for _ in range(2):
        sinks.publish_table(again, name)
    assert rows(spark.table(name), "account_code", "score", "reference_date") == [("a", 1, d("2024-01-01")), ("c", 9, d("2024-02-01"))]
    with pytest.raises(ValueError, match="columns of"):
        sinks.publish_table(first.withColumn("more", F.lit(1)), name)
    spark.sql(f"DROP TABLE {name}")


def test_day_folders_prune_files(spark, tmp_path):
    days = [d("2023-12-30"), d("2023-12-31"), d("2024-01-01"), d("2024-01-15"), d("2024-02-01")]
    stored = spark.createDataFrame([("nl", f"a{n}", day, 1, n) for n, day in enumerate(days * 2)],
                                   "environment string, account_code string, date date, activity_id int, quantity int")
    sinks.write_by_day(stored, f"{tmp_path}/{DIRECTORIES['activity_daily']}")
    sinks.write_by_day(stored.where("date = DATE '2024-01-15'"), f"{tmp_path}/{DIRECTORIES['activity_daily']}")  # that day replaces itself
    by_day, plain = (Tables.from_parquet(spark, str(tmp_path), by_day=names) for names in (["activity_daily"], []))
    for windows in ([(d("2023-12-31"), d("2024-01-15"))], [(d("2023-12-30"), d("2023-12-30")), (d("2024-01-02"), None)], [(None, d("2024-01-01"))]):
        found = by_day.get("activity_daily", windows=windows)
        assert rows(found) == rows(plain.get("activity_daily", windows=windows)) != []
        plan = plan_text(spark, found)
        assert re.search(r"PartitionFilters: \[[^\]]*make_date\(year#\d+, month#\d+, day#\d+", plan)
    with pytest.raises(ValueError, match="folders"):
        Tables.from_parquet(spark, str(tmp_path), by_day=["users"], paths={"users": f"{tmp_path}/{DIRECTORIES['activity_daily']}/year=2023/month=12/day=30"}) \
            ._stored["users"].bounds(None, None)
