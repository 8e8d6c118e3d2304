"""Physical plans: no nested-loop or cross joins, no Python on the data path,
filters and column lists at the scans."""

import re

import pytest

from tenura.checks.registry import all_queries
from tenura.operators.activity import activity_measures
from tenura.sources.tables import DIRECTORIES, Tables
from tenura.sources.testdata import REFERENCE_DATE, star_schema_tables

SF = "/root/testdata/sf0.001"
#: Their rows are made on the driver from fitted models: there is no plan to look at.
FITTED = ("logistic_optimum", "cross_validation_checked")
CHECKED = [name for name, query in all_queries(SF).items() if query.sql is not None and name not in FITTED]


def plan_text(spark, df):
    """The physical plan with whole filters."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan_of(spark, name):
    return plan_text(spark, all_queries(SF)[name].frame(star_schema_tables(spark, SF)))


@pytest.mark.parametrize("name", CHECKED)
def test_plan_scales(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(spark, name)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas", "ExistingRDD"):
        assert bad not in plan, bad
    assert "SinglePartition" not in plan or name in ("freshness_date", "reference_dates", "old_churn_scores",
                                                     "old_downgrade_scores", "validate_auc", "validate_auc_downgrade")


def scans(plan):
    return re.findall(r"FileScan parquet \[(.*?)\].*?PushedFilters: \[(.*?)\]", plan)


def test_page_views_read_four_columns_of_the_window(spark):
    found = [s for s in scans(plan_of(spark, "pageviews_window")) if s[0].startswith("ts#")]
    assert found
    for columns, filters in found:
        assert [c.split("#")[0] for c in columns.split(",")] == ["ts", "user_id", "event_type", "value"]
        assert "GreaterThanOrEqual(ts" in filters and "LessThan(ts" in filters


def test_only_the_windows_are_read(spark):
    """Four windows with gaps between them: four ranges at the scan, and no array for each row."""
    plan = plan_of(spark, "active_days_login_freq")
    found = [filters for columns, filters in scans(plan) if columns.startswith("ts#")]
    assert found and all(filters.count("GreaterThanOrEqual(ts") == 4 for filters in found)
    assert "Generate explode(array(CASE" not in plan


def test_clean_lake_pushes_the_country(spark, tmp_path):
    stored = star_schema_tables(spark, SF)
    for name, directory in DIRECTORIES.items():
        stored.get(name).write.parquet(str(tmp_path / directory))
    for clean in (True, False):
        lake = Tables.from_parquet(spark, str(tmp_path), clean=clean)
        df = activity_measures(lake, [REFERENCE_DATE], 30, "NL", ("pageviews",))
        filters = [f for c, f in scans(plan_text(spark, df)) if "quantity" in c]
        assert filters and all(("EqualTo(environment,nl)" in f or "In(environment" in f) == clean for f in filters)
        lake_rows = sorted(map(repr, df.collect()))
        assert lake_rows == sorted(map(repr, activity_measures(stored, [REFERENCE_DATE], 30, "NL", ("pageviews",)).collect()))


def test_lake_tables_are_opened_once(spark, tmp_path):
    star_schema_tables(spark, SF).get("users").write.parquet(str(tmp_path / "Users"))
    lake = Tables.from_parquet(spark, str(tmp_path))
    assert lake._stored["users"].read() is lake._stored["users"].read()
    assert lake.get("health_score").isEmpty()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lake.get("accounts")


def test_dataset_prunes_counters_it_does_not_use(spark):
    plan = plan_of(spark, "established_dataset")
    assert "project_total" not in plan and "gl_transactions" not in plan
    assert plan.count("FileScan parquet [ts#") == 1  # page views and roles in one pass


@pytest.mark.parametrize("name", ["project_sums", "division_growth_first_last", "division_financials"])
def test_divisions_are_not_broadcast(spark, name):
    """However small their files are: unfolded, they take many times that room in every task."""
    # those of a snapshot's own days aside
    joins = [line for line in plan_of(spark, name).splitlines() if "Join" in line and " division_code#" in line and " _division_code#" not in line]
    assert any("SortMergeJoin" in line for line in joins) and not any("Broadcast" in line for line in joins)
