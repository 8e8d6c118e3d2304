"""Data freshness, published scores, and their later validation."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenura.functions import add_period, event_probability, in_list, label_text
from tenura.operators.activity import PAGE_VIEW
from tenura.operators.contracts import churned, downgrade_events, downgraded
from tenura.sources.sinks import cut_lineage
from tenura.sources.tables import Tables

SCORE_TABLES = {"churn": ("health_score", "health_score"), "downgrade": ("is_usage_score", "score")}


def freshness_date(tables: Tables, since: dt.date | None = None) -> DataFrame:
    """Last day both the activity and (one day later) the division changes cover.

    A caller that knows a date the data reached before passes it as `since`; only
    newer days are read then. NULL when there are none."""
    viewed = (tables.get("activity_daily", since).where(f"activity_id = {PAGE_VIEW}")
              .agg(F.max("date").alias("latest_date")))
    changed = (tables.get("division_statistics_daily_changes", since)
               .agg(F.date_sub(F.max("date"), 1).alias("latest_date")))
    return viewed.union(changed).agg(F.min("latest_date").alias("latest_date"))


def _published(tables: Tables, category: str, product: str, phase: str | None, until: dt.date | None = None) -> DataFrame:
    """Scores of a product (and phase), predicted by the end of a day."""
    name, _ = SCORE_TABLES[category]
    packages = tables.get("package_classification").where(F.col("product") == label_text(product))
    scores = tables.get(name)
    if until is not None:
        scores = scores.where(F.col("predict_date") < F.lit(until + dt.timedelta(days=1)).cast("timestamp"))
    if phase is not None:
        scores = scores.where(F.col("phase") == phase.strip().lower())
    return scores.join(packages, ["environment", "package_code"])


def score_exists(tables: Tables, category: str, reference_date: dt.date, countries: str, product: str,
                 phase: str) -> DataFrame:
    """The best published score of a reference date; no row when there is none."""
    score = SCORE_TABLES[category][1]
    return (_published(tables, category, product, phase)
            .where(in_list("environment", countries) & (F.col("reference_date") == F.lit(reference_date)))
            .orderBy(F.col(score).desc(), "environment", "account_code", "package_code")
            .limit(1))


def _latest_run(scores: DataFrame, past_date: dt.date, countries: str) -> Column:
    """Day of the newest run on or before a date, as a scalar subquery."""
    return (scores.where(in_list("environment", countries)
                         & (F.col("predict_date") <= F.lit(past_date).cast("timestamp")))
            .agg(F.to_date(F.max("predict_date")).alias("d")).scalar())


def old_churn_scores(tables: Tables, past_date: dt.date, countries: str, product: str, phase: str,
                     period: int = 3) -> DataFrame:
    """Scores of the newest run on or before a date, with what happened since."""
    scores = _published(tables, "churn", product, phase, past_date)
    outcome = tables.get("accounts_contract_summary").select(
        "environment", "account_code", "full_cancellation_request_date", "latest_comm_final_date")
    predicted = F.to_date("predict_date")
    rows = (scores.where(predicted == _latest_run(scores, past_date, countries))
            .join(outcome, ["environment", "account_code"], "left"))
    return rows.select(
        "account_code", "environment", "health_score", "product", "phase", predicted.alias("predict_date"),
        "full_cancellation_request_date", "latest_comm_final_date",
        churned(f"add_months(to_date(predict_date), {period})").alias("label"),
        event_probability("health_score").alias("prob"))


def old_downgrade_scores(tables: Tables, past_date: dt.date, countries: str, product: str,
                         period: int = 3) -> DataFrame:
    """As old_churn_scores; an account appears once per downgrade strictly between
    the run and the end of its period, and once when there was none."""
    scores = _published(tables, "downgrade", product, None, past_date)
    run = _latest_run(scores, past_date, countries)
    # the run is by past_date, so nothing after its period counts
    events = (downgrade_events(tables, countries, product, None, add_period(past_date, period))
              .where((F.col("downgrade_date") > run) & (F.col("downgrade_date") < F.add_months(run, period))))
    predicted = F.to_date("predict_date")
    rows = (scores.where(predicted == run)
            .join(events, ["environment", "account_code"], "left"))
    return rows.select(
        "account_code", "environment", "score", "product", "phase", predicted.alias("predict_date"),
        "downgrade_date", downgraded().alias("label"), event_probability("score").alias("prob"))


def auc_by_rank(df: DataFrame, score: str, label: str, by: list[str]) -> DataFrame:
    """Area under the ROC curve of a score (probability of the event rises with
    `score`), per group; equal scores count one half, a missing score is the lowest.

    Rows are first counted per score value. The values of all groups are sorted into ranges, a range is ordered
    on its own, and starts with the negatives of the group's ranges before it: a prefix sum over totals, a row for each
    range and group. So a score may have as many values as rows, and one group may hold most of them.
    """
    counts = (df.groupBy(*by, score)
              .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("_pos"),
                   F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("_neg")))
    # written, since a range's number must mean the same rows to both that read it
    ranged = cut_lineage(counts.repartitionByRange(*by, score).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range", *by).agg(F.sum("_neg").alias("_in_range"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("_range").alias("_of"), *[F.col(c).alias(f"_of_{c}") for c in by],
                           F.coalesce(F.sum("_in_range").over(before), F.lit(0)).alias("_start"))
    same = [F.col("_range") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by]]
    below = Window.partitionBy("_range", *by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ordered = (ranged.withColumn("_below", F.coalesce(F.sum("_neg").over(below), F.lit(0)))
               .join(starts, reduce(Column.__and__, same)))
    # a product of two counts of rows outgrows a long
    pairs = F.sum(F.col("_pos").cast("decimal(18,0)") * (2 * (F.col("_start") + F.col("_below")) + F.col("_neg")).cast("decimal(19,0)"))
    return (ordered.groupBy(*by)
            .agg(F.sum("_pos").alias("positives"), F.sum("_neg").alias("negatives"), pairs.alias("_pairs"))
            .select(*by, "positives", "negatives",
                    F.try_divide(F.col("_pairs").cast("double") / F.lit(2.0), F.col("positives").cast("double") * F.col("negatives"))
                    .alias("auc")))
