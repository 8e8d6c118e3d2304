import bisect
import datetime as dt
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tenura import functions as fn
from tenura.plans import learn
from tenura.operators import activity, contracts, divisions, monitoring
from tenura.operators.grid import DistinctDays, LatestInt, in_look_back
from tests.conftest import d, rows
from tests.fixtures import REF, tables

REFS = [REF, d("2023-10-31"), d("2023-08-01")]
OUT = ("environment", "account_code")


def by_account(df, *columns):
    return {tuple(r)[1]: tuple(r)[2:] for r in rows(df, *OUT, *columns)}


def test_latest_contract_is_point_in_time(spark):
    latest = by_account(contracts.latest_contract(tables(spark), [REF]), "package_code", "date")
    assert latest["a1"] == ("p-acc", d("2023-03-01"))  # the row of February is not known yet
    assert latest["a2"] == ("p-man", d("2023-06-01"))  # tie: the largest record
    assert latest["a7"] == ("p-acc", REF)
    assert "a4" not in latest


def test_latest_contract_grid_equals_single_dates(spark):
    t = tables(spark)
    grid = rows(contracts.latest_contract(t, REFS))
    single = sorted((r for ref in REFS for r in rows(contracts.latest_contract(t, [ref]))), key=repr)
    assert grid == single
    # the order of the dates does not matter
    assert rows(contracts.latest_contract(t, REFS[::-1])) == grid


def test_latest_contract_equals_ranked_window(spark):
    t = tables(spark)
    t.get("activity_daily_contracts").createOrReplaceTempView("contract_rows")
    ranked = spark.sql(f"""
        SELECT environment, account_code, package_code FROM (SELECT *, row_number() OVER (
          PARTITION BY environment, account_code ORDER BY date DESC, package_code DESC) AS n
        FROM contract_rows WHERE date <= DATE '{REF}') WHERE n = 1""")
    assert rows(ranked) == rows(contracts.latest_contract(t, [REF]), *OUT, "package_code")


def test_last_upgrade(spark):
    assert by_account(contracts.last_upgrade(tables(spark), [REF]), "last_contract_upgrade_date") == {
        "a1": (d("2023-03-01"),)}


def test_contract_base(spark):
    base = contracts.contract_base(tables(spark), [REF], "NL,BE", "Accounting", 91, 30)
    got = by_account(base, "tenure_in_months", "tenure_in_months_upgrade", "valid_contract_days",
                     "valid_activity_days", "last_contract_upgrade_date")
    # a2 is of another product, a3 unclassified, a7 started today in a class that is not listed, a8 cancelled today
    assert set(got) == {"a1", "b1"}
    assert got["a1"] == (25, 11, 92, 31, d("2023-03-01"))
    # commercial days since December 15, the trial ended after the start
    assert got["b1"] == (1, 1, 48, 31, d("2023-12-15"))


def test_valid_days_with_trial(spark):
    base = contracts.contract_base(tables(spark), [REF], "NL", "Accountancy", 91, 30)
    got = by_account(base, "valid_contract_days", "valid_activity_days")
    # 31 commercial days; the trial of December counts for 91 days and ended before the 30 days
    assert got["a6"] == (31 + 31, 31)


def test_window_edges_and_cohort(spark):
    got = by_account(activity.pageviews(tables(spark), [REF], 91, "NL,BE", "Accounting"), "pageviews")
    assert got == {"a1": (5 + 7 + 2 + 2 + 1 + 4,), "b1": (9,)}
    assert set(by_account(activity.pageviews(tables(spark), [REF], 91, "NL", "Accounting"))) == {"a1"}


def test_logins_count_rows(spark):
    assert by_account(activity.active_days(tables(spark), [REF], 91, "NL", "Accounting"), "active_days") == {"a1": (2,)}
    assert by_account(activity.mobile_use(tables(spark), [REF], 91, "NL", "Accounting"), "use_mobile") == {"a1": (3,)}


def test_activity_mix_keeps_accounts_without_the_activity(spark):
    got = by_account(activity.accountancy_activity(tables(spark), [REF], 91, "NL"), *activity.ACCOUNTANCY_SUMS)
    assert got == {"a5": (4, -6, None), "a6": (None, None, None)}
    totals = activity.with_accountancy_total(activity.accountancy_activity(tables(spark), [REF], 91, "NL"))
    assert by_account(totals, "other_accountancy_activities") == {"a5": (4,), "a6": (0,)}


def test_active_users_and_divisions(spark):
    got = by_account(activity.active_users_divisions(tables(spark), [REF], 91, "NL", "Accounting"),
                     "active_users", "active_divisions")
    assert got == {"a1": (4, 2)}


def test_user_roles(spark):
    got = by_account(activity.user_role_days(tables(spark), [REF], 91, "NL,BE"),
                     "entrepreneur_days_active", "accountant_days_active")
    assert got == {"a1": (2, 1), "b1": (1, None)}


def test_accountant_status(spark):
    df = spark.createDataFrame([(1, True), (0, True), (None, False), (0, None)],
                               "accountant_days_active bigint, accountant_or_linked boolean")
    assert [r[0] for r in df.select(activity.accountant_status()).collect()] == [
        "Active", "Inactive", "NotLinked", "NotLinked"]


def test_linked_companies(spark):
    got = by_account(activity.linked_companies(tables(spark), [REF], 91, "NL,BE"), "active_days_on_linked_companies",
                     "num_active_linked_companies", "pageviews_on_linked_companies")
    assert got == {"a2": (1, 1, 4), "b1": (1, 1, 1)}


def test_financial_statistics(spark):
    got = by_account(divisions.financial_statistics(tables(spark), [REF], 91, "NL", "Accounting"),
                     "num_activated_divisions", "big3_bank_account", "bank_link", "ever_sent_invoice",
                     "currency_count", "gl_transactions")
    # d1 and d2 (deleted that very day); the newest d1 snapshot has no currency count
    assert got == {"a1": (2, 1, 1, 1, 1, 3 - 1 + 10)}


def test_growth_statistics(spark):
    got = by_account(divisions.growth_statistics(tables(spark), [REF], 91, "NL", "Accounting"),
                     "quote_count", "customer_count")
    assert got == {"a1": (12 - 0, 0)}  # d2 no longer counts


def test_project_statistics(spark):
    got = by_account(divisions.project_statistics(tables(spark), [REF], 91, "NL", "Accounting"),
                     "project_total_cost_entries_count", "project_type_fixed_price", "project_type_non_billable",
                     "project_type_prepaid_htb")
    assert got == {"a1": (3, 2, None, 3)}


def test_division_measures_together_equal_separate(spark):
    t = tables(spark)
    args = (t, REFS, 91, "NL")
    together = divisions.division_measures(*args, financial=True, growth=True, projects=True)
    for names, kind, flag in (
            (["num_activated_divisions", "fin_gl_transactions", "currency_count"], "financial", "_financial"),
            (["growth_quote_count"], "growth", "_growth"), (["project_project_type_prepaid_htb"], "projects", "_projects")):
        alone = divisions.division_measures(*args, **{kind: True})
        wanted = ["reference_date", "account_id", *names]
        assert rows(together.where(f"{flag} > 0"), *wanted) == rows(alone.where(f"{flag} > 0"), *wanted)


def test_downgrade_events(spark):
    got = rows(contracts.downgrade_events(tables(spark), "NL", "Wholesale distribution", REF, d("2024-04-30")))
    assert got == [("nl", "a1", d("2024-02-10")), ("nl", "a1", d("2024-03-10")), ("nl", "a6", d("2024-04-30"))]
    first = rows(contracts.first_downgrade(tables(spark), [REF], "NL", "Wholesale distribution", 3),
                 *OUT, "downgrade_date")
    assert first == [("nl", "a1", d("2024-02-10")), ("nl", "a6", d("2024-04-30"))]


def test_churn_label_edges(spark):
    schema = "reference_date date, full_cancellation_request_date date, latest_comm_final_date date"
    far = d("2025-01-01")
    df = spark.createDataFrame([
        (REF, None, far), (REF, d("2024-04-30"), far), (REF, d("2024-05-01"), far),
        (REF, None, d("2024-04-30")), (REF, None, None)], schema)
    labels = [r["churned"] for r in contracts.with_churn_label(df, [REF], 3).collect()]
    assert labels == [0.0, 1.0, 0.0, 1.0, 0.0]


def test_setup_type(spark):
    t = tables(spark)
    got = by_account(contracts.setup_type(t, [REF], "NL", "Accounting"), "master_data_setup_type")
    assert got == {"a1": ("Demo",)}
    # an unlisted type has no rank, comes first and has no category
    assert by_account(contracts.setup_type(t, [REF], "NL", "Accountancy"), "master_data_setup_type") == {"a6": (None,)}


def test_default_entries(spark):
    nl, be = divisions.DEFAULT_ENTRIES["nl"], divisions.DEFAULT_ENTRIES["be"]
    names = list(nl)
    schema = "environment string, tenure_in_months int, " + ", ".join(f"{n} bigint" for n in names)
    at_nl, at_be = [nl[n] for n in names], [be[n] for n in names]
    below = [at_nl[0] - 1, *at_nl[1:]]
    df = spark.createDataFrame([
        ("nl", 2, *at_nl), ("nl", 3, *at_nl), ("nl", 0, *below), ("nl", 0, *[v + 2 for v in at_nl]),
        ("be", 2, *at_be), ("be", 2, *[None] * 6), ("de", 2, *at_nl)], schema)
    got = [tuple(r[n] for n in names) for r in divisions.without_default_entries(df).collect()]
    assert got == [(0,) * 6, tuple(at_nl), tuple(below), (2,) * 6, (0,) * 6, (None,) * 6, tuple(at_nl)]


def test_no_leakage_from_later_rows(spark):
    """Rows dated after the reference date never change a feature."""
    t = tables(spark)
    later = d("2024-02-01")
    extra = t.with_table("activity_daily", t.get("activity_daily").unionByName(
        t.get("activity_daily").withColumn("date", F.lit(later))))
    extra = extra.with_table("division_statistics_daily_changes", t.get("division_statistics_daily_changes").unionByName(
        t.get("division_statistics_daily_changes").withColumn("date", F.lit(later))))
    extra = extra.with_table("division_statistics_daily", t.get("division_statistics_daily").unionByName(
        t.get("division_statistics_daily").withColumn("date", F.lit(later))))
    for operator in (activity.pageviews, divisions.financial_statistics, divisions.growth_statistics):
        assert rows(operator(t, [REF], 91, "NL,BE", "Accounting")) == rows(operator(extra, [REF], 91, "NL,BE", "Accounting"))


@pytest.mark.parametrize("days", [7, 30, 63, 64, 91, 130])
def test_distinct_days_is_exact(spark, days):
    random.seed(days)
    refs = [d("2024-01-30"), d("2023-12-01")]
    start = d("2023-07-01")
    # a third of all rows belong to one key
    data = [("hot" if random.random() < 0.33 else f"k{random.randrange(20)}",
             start + dt.timedelta(days=random.randrange(220))) for _ in range(3000)]
    counter = DistinctDays("days", days)
    tagged = in_look_back(spark.createDataFrame(data, "key string, date date"), refs, days)
    got = {(r[0], r[1]): r[2] for r in tagged.groupBy("reference_date", "key").agg(*counter.of_rows())
           .selectExpr("reference_date", "key", f"{counter.count()} AS n").collect()}
    expected = defaultdict(set)
    for key, date in data:
        for ref in refs:
            if ref - dt.timedelta(days=days) <= date <= ref:
                expected[ref, key].add(date)
    assert got == {k: len(v) for k, v in expected.items()}


def test_latest_int_packs_every_int(spark):
    values = [None, 0, -1, 1, 2 ** 31 - 1, -2 ** 31, 7]
    df = spark.createDataFrame([(d("1969-05-01"), v) for v in values] + [(d("2024-01-01"), v) for v in values],
                               "date date, v int")
    back = df.selectExpr("v", f"{LatestInt.pack('v')} AS p").selectExpr("v", f"{LatestInt.unpack('p')} AS w")
    assert all(r["v"] == r["w"] for r in back.collect())
    # later days win over larger values, and NULL is the smallest value of a day
    top = spark.createDataFrame([("a", d("2024-01-01"), 9), ("a", d("2024-01-02"), None), ("b", d("2024-01-02"), None),
                                 ("b", d("2024-01-02"), -5)], "k string, date date, v int")
    got = dict(top.groupBy("k").agg(F.expr(f"max({LatestInt.pack('v')}) AS p"))
               .selectExpr("k", LatestInt.unpack("p")).collect())
    assert got == {"a": None, "b": -5}


def test_freshness(spark):
    assert monitoring.freshness_date(tables(spark)).first()[0] == d("2024-01-30")  # changes end on the 31st


def _scores(*entries):
    return [("NL", account, "P-ACC", score, d(ref), dt.datetime.fromisoformat(predicted), phase)
            for account, score, ref, predicted, phase in entries]


def test_score_exists(spark):
    t = tables(spark, health_score=_scores(("A1", 40, "2023-09-30", "2023-10-01", "All"),
                                           ("A2", 70, "2023-09-30", "2023-10-01", " all "),
                                           ("A2", 99, "2023-09-30", "2023-10-01", "Onboarding")))
    best = monitoring.score_exists(t, "churn", d("2023-09-30"), "NL", "Accounting", "All")
    assert rows(best, "account_code", "health_score") == [("a2", 70)]
    assert monitoring.score_exists(t, "churn", d("2023-09-29"), "NL", "Accounting", "All").isEmpty()


def test_old_churn_scores(spark):
    t = tables(spark, health_score=_scores(
        ("A1", 40, "2023-10-30", "2023-10-31 08:00:00", "All"), ("A8", 45, "2024-01-30", "2024-01-30 09:00:00", "All"),
        ("A1", 20, "2024-01-30", "2024-01-30 09:00:00", "All"), ("A4", 60, "2024-01-30", "2024-01-30 10:00:00", "All"),
        ("A1", 90, "2024-05-01", "2024-05-02 09:00:00", "All")))
    got = rows(monitoring.old_churn_scores(t, d("2024-02-01"), "NL", "Accounting", "All"),
               "account_code", "health_score", "label", "prob")
    # a1 ends on 2024-04-30 = run + 3 months, a8 was cancelled the day after the run, a4 is unknown
    assert got == [("a1", 20, 1.0, 0.8), ("a4", 60, 0.0, 0.4), ("a8", 45, 1.0, 0.55)]
    earlier = monitoring.old_churn_scores(t, d("2024-01-01"), "NL", "Accounting", "All")
    assert rows(earlier, "account_code", "health_score") == [("a1", 40)]


def test_old_downgrade_scores(spark):
    t = tables(spark, is_usage_score=[("NL", a, "P-WD", s, d("2024-02-10"), dt.datetime(2024, 2, 10, 7), "All")
                                      for a, s in (("A1", 30), ("A6", 50), ("A2", 80))])
    got = rows(monitoring.old_downgrade_scores(t, d("2024-03-01"), "NL", "Wholesale distribution"),
               "account_code", "downgrade_date", "label")
    # the event on the day of the run does not count
    assert got == [("a1", d("2024-03-10"), 1.0), ("a2", None, 0.0), ("a6", d("2024-04-30"), 1.0)]


def test_auc_by_rank_equals_all_pairs(spark):
    random.seed(3)
    data = [("a" if i % 3 else "b", random.randrange(8), random.randrange(2)) for i in range(200)] + [("c", 1, 1)]
    df = spark.createDataFrame(data, "g string, s int, y int")
    got = {r["g"]: r["auc"] for r in monitoring.auc_by_rank(df, "s", "y", ["g"]).collect()}
    for group in "ab":
        pairs = [(p, n) for g, p, y in data for h, n, z in data if g == h == group and y == 1 and z == 0]
        expected = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
        assert abs(got[group] - expected) < 1e-12
    assert got["c"] is None


@pytest.mark.parametrize("threads", ["4", "64"])
def test_auc_of_scores_over_many_ranges(spark, threads):
    """As many values as rows, a group over all ranges, small groups, missing groups and scores, against ranks by hand."""
    random.seed(4)
    data = [(random.choice(["big", "big", "big", "b", None]), None if i % 97 == 0 else random.random() if i % 5 else round(random.random(), 1), random.randrange(2))
            for i in range(4000)] + [("one", 0.5, 1), ("all", 0.1, 0), ("all", 0.2, 0)]
    spark.conf.set("spark.sql.shuffle.partitions", threads)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(data, "g string, s double, y int")
        got = {r["g"]: (r["positives"], r["negatives"], r["auc"]) for r in monitoring.auc_by_rank(df, "s", "y", ["g"]).collect()}
        plan = monitoring.auc_by_rank(df, "s", "y", ["g"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # values are ordered inside a range; only totals, a row for each range, are ordered by group
    assert re.search(r"windowspecdefinition\(_range#\d+, g#\d+, s#", plan) and not re.search(r"windowspecdefinition\(g#\d+, s#", plan)
    for group in {g for g, _, _ in data}:
        of = [(-1.0 if s is None else s, y) for g, s, y in data if g == group]
        positives, negatives = [s for s, y in of if y], sorted(s for s, y in of if not y)
        pairs = sum(bisect.bisect_left(negatives, s) + bisect.bisect_right(negatives, s) for s in positives) / 2
        assert got[group][:2] == (len(positives), len(negatives))
        assert got[group][2] == (pytest.approx(pairs / len(positives) / len(negatives), abs=1e-12) if positives and negatives else None)


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "y double")
    assert rows(learn.weighted(df, "y"), "y", "class_weight") == [(0.0, 0.25), (0.0, 0.25), (0.0, 0.25), (1.0, 0.75)]


def test_event_probability(spark):
    assert spark.range(1).select(fn.event_probability("25").alias("p")).first()["p"] == 0.75
