"""Every operator as a named query over the test data, with its SQL counterpart.

Both sides pass through the same output projection (bigint, six decimals, dates
as text), so that values compare across engines.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura import functions as fn
from tenura.checks import oracle as sql
from tenura.operators import activity, contracts, divisions, monitoring
from tenura.operators.grid import ACCOUNT, REF
from tenura.operators.states import STATES
from tenura.plans import boosting, learn
from tenura.plans.certificate import fold_areas, logistic_certificate
from tenura.plans.dataset import base_accounts, dataset, features, model_columns
from tenura.plans.dates import evaluation_date, training_dates
from tenura.plans.specs import SPECS, ProductSpec
from tenura.sources.sinks import append_rows, cut_lineage, publish_table, shared_path, statistics_row, write_bucketed, write_by_day, write_by_reference_date
from tenura.sources.state import StateStore
from tenura.sources.tables import DIRECTORIES, Tables, read_health_score_csv, run_sql
from tenura.sources.testdata import REFERENCE_DATE, star_schema_tables

EVERYWHERE = "NL,BE"  # all countries of the data
WINDOW = 91
GRID = [REFERENCE_DATE - dt.timedelta(days=WINDOW * i) for i in range(4)]
PAST = dt.date(2023, 10, 30)


@dataclass(frozen=True)
class Query:
    """kinds: s text, i integer or flag, f number, d date."""

    run: Callable[[Tables], DataFrame]
    kinds: dict[str, str]
    sql: str | None = None

    def frame(self, tables: Tables) -> DataFrame:
        return _projected(self.run(tables), self.kinds)

    def oracle(self) -> str:
        casts = {"s": "CAST({c} AS VARCHAR)", "i": "CAST({c} AS BIGINT)",
                 "f": "ROUND(CAST({c} AS DOUBLE), 6)", "d": "CAST(CAST({c} AS DATE) AS VARCHAR)"}
        outputs = ", ".join(f"{casts[kind].format(c=c)} AS {c}" for c, kind in self.kinds.items())
        return sql.with_tables(f"SELECT {outputs} FROM ({self.sql}) AS answer")


def _projected(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    out = []
    for name, kind in kinds.items():
        c = F.col(name)
        if kind == "i":
            c = c.cast("bigint")
        elif kind == "f":
            c = F.round(c.cast("double"), 6)
        elif kind == "d":
            c = c.cast("date").cast("string")
        out.append(c.alias(name))
    return df.select(*out)


def _kinds(text: str) -> dict[str, str]:
    """'reference_date:d pageviews:i' -> {...}"""
    return dict(part.split(":") for part in text.split())


KEY = "reference_date:d environment:s account_code:s "


def _keyed(names, kind: str = "i") -> dict[str, str]:
    return _kinds(KEY + " ".join(f"{n}:{kind}" for n in names))


def _block(operator, builder, names, *args, kind: str = "i") -> Query:
    return Query(lambda t: operator(t, GRID, *args), _keyed(names, kind),
                 sql.union_refs(GRID, lambda ref: builder(ref, *args)))


def _spec(category: str, name: str) -> ProductSpec:
    return SPECS[category][name].everywhere(EVERYWHERE)


def _predictor_kind(name: str) -> str:
    if name in ("accountant", "environment", "master_data_setup_type", "sector"):
        return "s"
    return "f" if name.startswith("log_") or name in ("login_freq", "churned", "downgraded") else "i"


def _refs(spec: ProductSpec) -> list[dt.date]:
    return training_dates(spec, REFERENCE_DATE)


def _dataset(category: str, name: str) -> Query:
    spec = _spec(category, name)
    kinds = {c: "d" if c == REF else "s" if c in ("environment", "account_code", "package_code")
             else _predictor_kind(c) for c in model_columns(spec)}
    return Query(lambda t: dataset(t, _refs(spec), spec), kinds,
                 sql.union_refs(_refs(spec), lambda ref: sql.dataset(ref, spec)))


BASE_KINDS = _kinds(
    KEY + "account_name:s is_anonymized:i account_classification_code:s sector_code:s event_type:s package_code:s "
    "account_id:s number_of_users:i number_of_administrations:i accountant_or_linked:i mrr:f "
    "last_contract_upgrade_date:d product:s edition:s solution:s first_comm_start_date:d latest_comm_final_date:d "
    "first_trial_start_date:d latest_trial_final_date:d full_cancellation_request_date:d tenure_in_months:i "
    "tenure_in_months_upgrade:i log_tenure_in_months:f log_tenure_in_months_upgrade:f valid_contract_days:i "
    "valid_activity_days:i")


def _contract_queries() -> dict[str, Query]:
    base_sql = sql.union_refs(GRID, lambda ref: sql.base(ref, EVERYWHERE, "Accounting", 91, 30))
    wholesale_sql = sql.union_refs(GRID, lambda ref: sql.base(ref, EVERYWHERE, "Wholesale distribution"))

    def base(t: Tables, product: str = "Accounting", activities: int = 30) -> DataFrame:
        return contracts.contract_base(t, GRID, EVERYWHERE, product, 91, activities)

    def label_sql(ref):
        spec = _spec("downgrade", "wholesale_distribution")
        return f"SELECT environment, account_code, downgraded FROM ({sql.dataset(ref, spec)})"

    def churn_sql(ref):
        end = f"DATE '{fn.add_period(ref, 3)}'"
        return (f"SELECT environment, account_code, CASE WHEN full_cancellation_request_date <= {end} "
                f"OR latest_comm_final_date <= {end} THEN 1.0 ELSE 0.0 END AS churned "
                f"FROM ({sql.base(ref, EVERYWHERE, 'Accounting')})")

    def downgrade_label(t: Tables) -> DataFrame:
        events = contracts.first_downgrade(t, GRID, EVERYWHERE, "Wholesale distribution", 3)
        return (base(t, "Wholesale distribution").join(events, ACCOUNT, "left")
                .withColumn("downgraded", contracts.downgraded()))

    months = ", ".join(str(m) for m in fn.HOLIDAY_MONTHS)
    return {
        "latest_contract_asof": Query(
            lambda t: contracts.latest_contract(t, GRID),
            _kinds(KEY + "package_code:s event_type:s account_id:s number_of_users:i number_of_administrations:i "
                   "accountant_or_linked:i mrr:f date:d"),
            sql.union_refs(GRID, sql.latest_contract)),
        "last_upgrade_date": Query(
            lambda t: contracts.last_upgrade(t, GRID), _keyed(["last_contract_upgrade_date"], "d"),
            sql.union_refs(GRID, sql.last_upgrade)),
        "contract_base_tenure": Query(base, BASE_KINDS, base_sql),
        "valid_days": Query(
            lambda t: base(t, "Accountancy"), _keyed(["valid_contract_days", "valid_activity_days"]),
            sql.union_refs(GRID, lambda ref: sql.base(ref, EVERYWHERE, "Accountancy", 91, 30))),
        "holiday_flag": Query(
            lambda t: base(t).withColumn("is_holiday_season", fn.is_holiday_season(REF)),
            _keyed(["is_holiday_season"]),
            f"SELECT *, month(reference_date) IN ({months}) AS is_holiday_season FROM ({base_sql})"),
        "sector_name_flags": Query(
            lambda t: base(t, "Wholesale distribution").withColumns({
                "sector": fn.sector_bucket("sector_code"),
                "has_wholesale_name": fn.has_wholesale_name("account_name")}),
            _kinds(KEY + "sector:s has_wholesale_name:i"),
            "SELECT *, CASE WHEN sector_code IS NULL THEN 'Unknown' WHEN sector_code = 'G' THEN 'G' ELSE 'NonG' END "
            f"AS sector, COALESCE(regexp_matches(lower(account_name), '{fn.WHOLESALE_NAME_PATTERN}'), FALSE) "
            f"AS has_wholesale_name FROM ({wholesale_sql})"),
        "setup_type_best_rank": Query(
            lambda t: contracts.setup_type(t, GRID, EVERYWHERE, "Accounting"),
            _keyed(["master_data_setup_type"], "s"),
            sql.union_refs(GRID, lambda ref: sql.setup(ref, EVERYWHERE, "Accounting"))),
        "downgrade_events": Query(
            lambda t: contracts.downgrade_events(t, EVERYWHERE, "Wholesale distribution",
                                                 dt.date(2018, 1, 1), dt.date(2024, 12, 31)),
            _kinds("environment:s account_code:s downgrade_date:d"),
            sql.downgrades(EVERYWHERE, "Wholesale distribution", "DATE '2018-01-01'", "DATE '2024-12-31'")),
        "churn_label": Query(lambda t: contracts.with_churn_label(base(t), GRID, 3), _keyed(["churned"], "f"),
                             sql.union_refs(GRID, churn_sql)),
        "downgrade_label": Query(downgrade_label, _keyed(["downgraded"], "f"), sql.union_refs(GRID, label_sql)),
    }


def _activity_queries() -> dict[str, Query]:
    days = "active_days_on_linked_companies num_active_linked_companies pageviews_on_linked_companies".split()

    def mix(operator, sums, product):
        return Query(lambda t: operator(t, GRID, WINDOW, EVERYWHERE, product), _keyed(sums),
                     sql.union_refs(GRID, lambda ref: sql.activity_mix(ref, WINDOW, EVERYWHERE, product, sums)))

    def login_freq(t: Tables) -> DataFrame:
        spec = _spec("churn", "manufacturing")
        return features(t, GRID, spec, label=False)

    return {
        "pageviews_window": Query(
            lambda t: activity.pageviews(t, GRID, WINDOW, EVERYWHERE, "Accounting")
            .withColumn("log_pageviews", fn.guarded_log("pageviews")),
            _kinds(KEY + "pageviews:i log_pageviews:f"),
            sql.union_refs(GRID, lambda ref: f"SELECT *, {sql.log('pageviews')} AS log_pageviews FROM "
                                             f"({sql.pageviews(ref, WINDOW, EVERYWHERE, 'Accounting')})")),
        "active_days": _block(activity.active_days, sql.active_days, ["active_days"],
                              WINDOW, EVERYWHERE, "Accountancy"),
        "active_days_login_freq": Query(
            login_freq, _kinds(KEY + "active_days:i valid_activity_days:i login_freq:f"),
            sql.union_refs(GRID, lambda ref: (
                "SELECT b.environment, b.account_code, b.valid_activity_days, COALESCE(d.active_days, 0) AS active_days, "
                "COALESCE(d.active_days, 0) / b.valid_activity_days AS login_freq FROM "
                f"({sql.base(ref, EVERYWHERE, 'Manufacturing', 91, 30)}) b LEFT JOIN "
                f"({sql.active_days(ref, 30, EVERYWHERE, 'Manufacturing')}) d "
                "ON b.environment = d.environment AND b.account_code = d.account_code"))),
        "mobile_use_flag": _block(activity.mobile_use, sql.mobile, ["use_mobile"], 30, EVERYWHERE, "Manufacturing"),
        "accountancy_activity": mix(activity.accountancy_activity, activity.ACCOUNTANCY_SUMS, "Accountancy"),
        "manufacturing_activity": mix(activity.manufacturing_activity, activity.MANUFACTURING_SUMS, "Manufacturing"),
        "active_users_divisions": _block(activity.active_users_divisions, sql.active_users,
                                         ["active_users", "active_divisions"], WINDOW, EVERYWHERE,
                                         "Wholesale distribution"),
        "user_role_days": _block(activity.user_role_days, sql.role_days,
                                 ["entrepreneur_days_active", "accountant_days_active"], WINDOW, EVERYWHERE),
        "linked_companies": _block(activity.linked_companies, sql.linked_companies, days, WINDOW, EVERYWHERE),
        "sql_active_users": Query(_sql_active_users, _kinds("environment:s account_code:s active_users:i "
                                                            "active_divisions:i"),
                                  sql.active_users(REFERENCE_DATE, WINDOW, EVERYWHERE, "Accounting")),
    }


SQL_ACTIVE_USERS = """
WITH latest AS (
  SELECT environment, account_code, max_by(package_code, struct(date, package_code)) AS package_code
  FROM q_activity_daily_contracts WHERE date <= :end_date GROUP BY environment, account_code)
SELECT a.environment, a.account_code, count(DISTINCT a.user_id) AS active_users,
       count(DISTINCT a.division_code) AS active_divisions
FROM q_activity_daily a
JOIN latest c ON a.environment = c.environment AND a.account_code = c.account_code
JOIN q_package_classification p ON c.environment = p.environment AND c.package_code = p.package_code
WHERE a.activity_id = 1 AND array_contains(split(:environment, ','), a.environment)
  AND a.date BETWEEN date_sub(:end_date, :window) AND :end_date AND p.product = :product
GROUP BY a.environment, a.account_code
"""


def _sql_active_users(t: Tables) -> DataFrame:
    t.register_views("q_")
    return run_sql(t.spark, SQL_ACTIVE_USERS, end_date=REFERENCE_DATE, window=WINDOW,
                   environment=EVERYWHERE.lower(), product="accounting")


def _division_queries() -> dict[str, Query]:
    financial = ["num_activated_divisions", *divisions.FINANCIAL_FLAGS, *divisions.FINANCIAL]
    ps = _spec("churn", "professional_services")
    onboarding = _spec("churn", "accounting_onboarding")
    fills = ["use_mobile", *financial[:-1]]

    def fills_sql(ref):
        window = ps.window_activities
        base = sql.base(ref, EVERYWHERE, ps.product, 91, window)
        outputs = ", ".join(f"COALESCE({'m' if c == 'use_mobile' else 'f'}.{c}, 0) AS {c}" for c in fills)
        return (f"SELECT b.environment, b.account_code, COALESCE(b.sector_code, 'Unknown') AS sector_code, {outputs} "
                f"FROM ({base}) b LEFT JOIN ({sql.financial(ref, window, EVERYWHERE, ps.product)}) f "
                "ON b.environment = f.environment AND b.account_code = f.account_code "
                f"LEFT JOIN ({sql.mobile(ref, window, EVERYWHERE, ps.product)}) m "
                "ON b.environment = m.environment AND b.account_code = m.account_code")

    entries = list(divisions.DEFAULT_ENTRIES["nl"])

    def defaults_sql(ref):
        f_columns = ", ".join(f"f.{c}" for c in entries)
        joined = (f"SELECT b.environment, b.account_code, b.tenure_in_months, {f_columns} FROM "
                  f"({sql.base(ref, EVERYWHERE, 'Accounting')}) b LEFT JOIN "
                  f"({sql.financial(ref, 91, EVERYWHERE, 'Accounting')}) f ON b.environment = f.environment "
                  "AND b.account_code = f.account_code WHERE b.tenure_in_months < 6")
        return sql.without_defaults(joined)

    # changes with counters at the threshold of the country or above, or with one of them just below it
    counted = list(divisions.DEFAULT_ENTRIES["nl"])
    offset = "(abs(account_count) + {i}) % 7 - 1"
    near = {c: "CASE environment " + " ".join(f"WHEN '{country}' THEN {limits[c]}" for country, limits in divisions.DEFAULT_ENTRIES.items())
            + f" END + {offset.format(i=i)}" for i, c in enumerate(counted)}
    around = ["environment", "abs(project_type_time_and_material) AS tenure_in_months", "abs(account_count) % 7 AS step",
              *[f"{expression} AS {c}" for c, expression in near.items()]]
    sums = ", ".join(f"SUM({c}) AS {c}" for c in counted)

    def around_thresholds(t: Tables) -> DataFrame:
        rows = t.get("division_statistics_daily_changes").selectExpr(*around)
        return (divisions.without_default_entries(rows).groupBy("environment", "tenure_in_months", "step")
                .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in counted]))

    around_sql = (f"SELECT environment, tenure_in_months, step, COUNT(*) AS n, {sums} FROM ("
                  + sql.without_defaults(f"SELECT {', '.join(around)} FROM t_division_statistics_daily_changes") + ") GROUP BY ALL")
    return {
        "division_financials": _block(divisions.financial_statistics, sql.financial, financial,
                                      WINDOW, EVERYWHERE, "Accounting"),
        "division_growth_first_last": _block(divisions.growth_statistics, sql.growth, divisions.GROWTH,
                                             WINDOW, EVERYWHERE, "Wholesale distribution"),
        "project_sums": _block(divisions.project_statistics, sql.projects, list(divisions.PROJECTS),
                               WINDOW, EVERYWHERE, "Professional services"),
        "remove_default_entries": Query(lambda t: features(t, GRID, onboarding, label=False),
                                        _keyed(entries), sql.union_refs(GRID, defaults_sql)),
        "default_entry_thresholds": Query(around_thresholds, _kinds("environment:s tenure_in_months:i step:i n:i " + " ".join(f"{c}:i" for c in counted)),
                                          around_sql),
        "default_fills": Query(lambda t: features(t, GRID, ps, label=False),
                               {**_keyed(fills), "sector_code": "s"}, sql.union_refs(GRID, fills_sql)),
    }


def _feature(spec: ProductSpec, kinds: dict[str, str], blocks: dict[str, Callable], outputs: str) -> Query:
    """Columns of a product's feature set: blocks are SQL builders by alias, joined
    to the accounts b."""
    window = spec.window_activities

    def body(ref):
        joins = " ".join(
            f"LEFT JOIN ({builder(ref)}) {alias} ON {alias}.environment = b.environment "
            f"AND {alias}.account_code = b.account_code" for alias, builder in blocks.items())
        base = sql.base(ref, EVERYWHERE, spec.product, spec.window_contract, window)
        where = f"b.edition IS DISTINCT FROM '{spec.excluded_edition}'" if spec.excluded_edition else "TRUE"
        if spec.min_tenure is not None:
            where = f"b.tenure_in_months >= {spec.min_tenure}"
        return f"SELECT b.environment, b.account_code, {outputs} FROM ({base}) b {joins} WHERE {where}"

    return Query(lambda t: features(t, GRID, spec, label=False), {**_kinds(KEY), **kinds},
                 sql.union_refs(GRID, body))


def _feature_queries() -> dict[str, Query]:
    established = _spec("churn", "accounting_established")
    accountancy = _spec("churn", "accountancy")
    manufacturing = _spec("churn", "manufacturing")
    clipped = [f"greatest(COALESCE({c}, 0), 0)" for c in activity.ACCOUNTANCY_SUMS]
    total = "(" + " + ".join(clipped) + ")"
    made = "(COALESCE(manufacturing_basic, 0) + COALESCE(manufacturing_advanced, 0))"
    spent = "(COALESCE(f.sales_invoice, 0) + COALESCE(f.project_total_time_entries, 0))"

    def financial(spec):
        return lambda ref: sql.financial(ref, spec.window_activities, EVERYWHERE, spec.product)

    return {
        "accountant_status": _feature(
            established, _kinds("accountant:s entrepreneur_active:i accountant_days_active:i"),
            {"r": lambda ref: sql.role_days(ref, 91, EVERYWHERE)},
            "CASE WHEN r.accountant_days_active > 0 THEN 'Active' WHEN b.accountant_or_linked THEN 'Inactive' "
            "ELSE 'NotLinked' END AS accountant, COALESCE(r.entrepreneur_days_active, 0) > 0 AS entrepreneur_active, "
            "COALESCE(r.accountant_days_active, 0) AS accountant_days_active"),
        "accountancy_totals": _feature(
            accountancy, _kinds("continuous_monitoring:i scanning:i process_management:i "
                                "other_accountancy_activities:i log_other_accountancy_activities:f"),
            {"x": lambda ref: sql.activity_mix(ref, 91, EVERYWHERE, "Accountancy", activity.ACCOUNTANCY_SUMS)},
            ", ".join(f"{c} AS {name}" for c, name in zip(clipped, activity.ACCOUNTANCY_SUMS))
            + f", {total} AS other_accountancy_activities, {sql.log(total)} AS log_other_accountancy_activities"),
        "time_sales_invoice_log": _feature(
            accountancy, _kinds("log_time_sales_invoice_entry:f"), {"f": financial(accountancy)},
            f"{sql.log(spent)} AS log_time_sales_invoice_entry"),
        "manufacturing_totals": _feature(
            manufacturing, _kinds("log_manufacturing_activities:f recent_use_mobile:i"),
            {"x": lambda ref: sql.activity_mix(ref, 30, EVERYWHERE, "Manufacturing", activity.MANUFACTURING_SUMS),
             "m": lambda ref: sql.mobile(ref, 30, EVERYWHERE, "Manufacturing")},
            f"{sql.log(made)} AS log_manufacturing_activities, m.use_mobile IS NOT NULL AS recent_use_mobile"),
        "stock_count_log": _feature(
            manufacturing, _kinds("log_stock_count_entry_count:f"), {"f": financial(manufacturing)},
            f"{sql.log('f.stock_count_entry')} AS log_stock_count_entry_count"),
        "financial_flags_logs": _feature(
            established, {**{f"has_{c}": "i" for c in ("big3_bank_account", "bank_link", "sales_invoice", "currency_count")},
                          **{f"log_{c}": "f" for c in divisions.LOGGED_FINANCIAL}},
            {"f": financial(established)},
            ", ".join([*[f"COALESCE(f.{c} > 0, FALSE) AS has_{c}"
                         for c in ("big3_bank_account", "bank_link", "sales_invoice", "currency_count")],
                       *[f"{sql.log(f'f.{c}')} AS log_{c}" for c in divisions.LOGGED_FINANCIAL]])),
    }


def _documents(t: Tables, sf_dir: str) -> DataFrame:
    documents = t.spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "n_chars")
    labels = t.spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return documents.join(labels, "doc_id").withColumn("score", F.col("n_chars") % 101)


def _auc_sql(body: str, score: str, label: str, by: str) -> str:
    # Mann-Whitney: average rank of the positives
    ranked = (f"SELECT {by}, {label} AS y, RANK() OVER (PARTITION BY {by} ORDER BY {score}) "
              f"+ (COUNT(*) OVER (PARTITION BY {by}, {score}) - 1) / 2.0 AS r FROM ({body})")
    return (f"SELECT {by}, SUM(y) AS positives, COUNT(*) - SUM(y) AS negatives, "
            "CASE WHEN SUM(y) > 0 AND SUM(y) < COUNT(*) THEN (SUM(CASE WHEN y = 1 THEN r ELSE 0 END) "
            "- SUM(y) * (SUM(y) + 1) / 2.0) / (SUM(y) * (COUNT(*) - SUM(y))) END AS auc "
            f"FROM ({ranked}) GROUP BY {by}")


def _monitoring_queries(sf_dir: str) -> dict[str, Query]:
    accounting = ("2024-01-01", EVERYWHERE, "Accounting", "All")
    score_date = dt.date(2023, 10, 1)
    established = _spec("churn", "accounting_established")
    established_sql = sql.union_refs(_refs(established), lambda ref: sql.dataset(ref, established))
    freshness = ("SELECT min(d) AS latest_date FROM (SELECT max(date) AS d FROM t_activity_daily WHERE activity_id = 1 "
                 "UNION SELECT max(date) - 1 AS d FROM t_division_statistics_daily_changes)")

    def dates(t: Tables) -> DataFrame:
        spec = established
        steps = {"current": 0, "past": spec.window_contract,
                 **{f"train_{i}": spec.window_contract * (i + 1) for i in range(4)},
                 "evaluate": (dt.date(2024, 1, 1) - evaluation_date(spec, dt.date(2024, 1, 1))).days
                 + spec.window_contract}
        rows = F.array(*[F.struct(F.lit(k).alias("purpose"), F.lit(v).alias("_days")) for k, v in steps.items()])
        return (monitoring.freshness_date(t).select("latest_date", F.inline(rows))
                .select("purpose", F.date_sub("latest_date", F.col("_days")).alias("reference_date")))

    def exists(category: str, table: str, score: str) -> Query:
        names = ["environment", "account_code", "package_code", score, "phase", "product", "edition", "solution"]
        kinds = {n: "i" if n == score else "s" for n in names} | {"reference_date": "d", "predict_date": "d"}
        body = (f"SELECT * FROM ({sql.published(table, 'Accounting', 'all')}) WHERE environment IN ('nl', 'be') "
                f"AND reference_date = DATE '{score_date}' ORDER BY {score} DESC, environment, account_code, "
                "package_code LIMIT 1")
        return Query(lambda t: monitoring.score_exists(t, category, score_date, *accounting[1:]), kinds, body)

    churn_scores = sql.old_churn_scores(PAST, EVERYWHERE, "Accountancy", "All")
    return {
        "freshness_date": Query(monitoring.freshness_date, _kinds("latest_date:d"), freshness),
        "reference_dates": Query(
            dates, _kinds("purpose:s reference_date:d"),
            "SELECT purpose, latest_date - days AS reference_date FROM (" + freshness + "), (VALUES ('current', 0), "
            "('past', 91), ('train_0', 91), ('train_1', 182), ('train_2', 273), ('train_3', 364), ('evaluate', 227)) "
            "AS v(purpose, days)"),
        "score_exists": exists("churn", "health_score", "health_score"),
        "downgrade_score_exists": exists("downgrade", "is_usage_score", "score"),
        "old_churn_scores": Query(
            lambda t: monitoring.old_churn_scores(t, PAST, EVERYWHERE, "Accountancy", "All"),
            _kinds("account_code:s environment:s health_score:i product:s phase:s predict_date:d "
                   "full_cancellation_request_date:d latest_comm_final_date:d label:f prob:f"), churn_scores),
        "old_downgrade_scores": Query(
            lambda t: monitoring.old_downgrade_scores(t, PAST, EVERYWHERE, "Wholesale distribution"),
            _kinds("account_code:s environment:s score:i product:s phase:s predict_date:d downgrade_date:d "
                   "label:f prob:f"),
            sql.old_downgrade_scores(PAST, EVERYWHERE, "Wholesale distribution")),
        "validate_auc": Query(
            lambda t: monitoring.auc_by_rank(
                monitoring.old_churn_scores(t, PAST, EVERYWHERE, "Accountancy", "All"), "prob", "label", ["product"]),
            _kinds("product:s positives:i negatives:i auc:f"),
            _auc_sql(churn_scores, "prob", "label", "product")),
        "validate_auc_downgrade": Query(
            lambda t: monitoring.auc_by_rank(
                monitoring.old_downgrade_scores(t, PAST, EVERYWHERE, "Wholesale distribution"), "prob", "label", ["product"]),
            _kinds("product:s positives:i negatives:i auc:f"),
            _auc_sql(sql.old_downgrade_scores(PAST, EVERYWHERE, "Wholesale distribution"), "prob", "label", "product")),
        "auc_by_rank": Query(
            lambda t: monitoring.auc_by_rank(_documents(t, sf_dir), "score", "quality", ["lang"]),
            _kinds("lang:s positives:i negatives:i auc:f"),
            _auc_sql("SELECT d.lang, d.n_chars % 101 AS score, l.quality FROM documents d JOIN labels l "
                     "ON d.doc_id = l.doc_id", "score", "quality", "lang")),
        # a score with a value of its own for nearly every row, in groups of which one holds half of them
        "auc_of_continuous_score": Query(
            lambda t: monitoring.auc_by_rank(
                t.spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
                    "CAST(round(o_totalprice * 100) AS BIGINT) * 1000003 % 998244353 AS score",
                    "CASE WHEN o_totalprice > 150000 + o_orderkey % 90000 THEN 1 ELSE 0 END AS dear", "o_orderstatus AS status"),
                "score", "dear", ["status"]),
            _kinds("status:s positives:i negatives:i auc:f"),
            _auc_sql("SELECT o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) * 1000003 % 998244353 AS score, "
                     "CASE WHEN o_totalprice > 150000 + o_orderkey % 90000 THEN 1 ELSE 0 END AS dear FROM orders", "score", "dear", "status")),
        "fold_sizes": Query(
            lambda t: learn.stratified_folds(dataset(t, _refs(established), established), "churned",
                                             [REF, "environment", "account_code", "package_code"])
            .groupBy("churned", "fold").agg(F.count(F.lit(1)).alias("n")),
            _kinds("churned:f fold:i n:i"),
            "SELECT churned, fold, COUNT(*) AS n FROM (SELECT churned, ROW_NUMBER() OVER (PARTITION BY churned "
            f"ORDER BY account_code) % 5 AS fold FROM ({established_sql})) GROUP BY churned, fold"),
        "score_rounding": Query(
            lambda t: t.get("is_usage_score").groupBy("score").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("rounded", fn.health_score("(score / 200.0D)")),
            _kinds("score:i rounded:i n:i"),
            "SELECT score, COUNT(*) AS n, round_even(score / 200.0::DOUBLE * 100, 0) AS rounded "
            "FROM t_is_usage_score GROUP BY score"),
        "score_text_dates": Query(
            lambda t: t.get("health_score")
            .withColumn("text", F.date_format("predict_date", fn.SCORE_TIMESTAMP_FORMAT))
            .withColumn("predict_day", F.to_date(fn.parse_score_timestamp("text")))
            .groupBy("text", "predict_day").agg(F.count(F.lit(1)).alias("n")),
            _kinds("text:s predict_day:d n:i"),
            "SELECT strftime(predict_date, '%m-%d-%y %I:%M %p') AS text, CAST(predict_date AS DATE) AS predict_day, "
            "COUNT(*) AS n FROM t_health_score GROUP BY ALL"),
    }


def _trained(t: Tables, spec: ProductSpec):
    """Rows of the training windows and the model selected over the whole grid."""
    rows = cut_lineage(dataset(t, _refs(spec), spec))
    data = learn.training_frame(rows, spec).persist()
    try:
        return rows, learn.select_model(data, spec, parallelism=4)
    finally:
        data.unpersist()


def _learning_queries() -> dict[str, Query]:
    spec = _spec("churn", "accounting_established")
    tree_spec = replace(_spec("churn", "wholesale_distribution"), algorithm="GradientBoostedTrees")

    def scores(of: ProductSpec):
        def predict(t: Tables) -> DataFrame:
            rows, selection = _trained(t, of)
            return learn.score(selection.model, rows, of.predictors)

        return predict

    def cross_validation(t: Tables) -> DataFrame:
        _, selection = _trained(t, spec)
        return t.spark.createDataFrame(
            [(params["regParam"], float(metric)) for params, metric in selection.metrics],
            "reg_param double, auc double")

    def evaluate(t: Tables) -> DataFrame:
        # trained on the four windows, judged on a window one and a half before them
        _, selection = _trained(t, spec)
        ref = evaluation_date(spec, REFERENCE_DATE)
        scored_rows = cut_lineage(learn.score(selection.model, dataset(t, [ref], spec), spec.predictors))
        return t.spark.createDataFrame([(ref, float(learn.area_under_roc(scored_rows, spec.label)))],
                                       "reference_date date, auc double")

    scored = _kinds(KEY + "package_code:s event_probability:f health_score:i")
    return {
        "train_predict_scores": Query(scores(spec), scored),
        "stratified_cv_metrics": Query(cross_validation, _kinds("reg_param:f auc:f")),
        "gbt_scores": Query(scores(tree_spec), scored),
        "evaluate_model": Query(evaluate, _kinds("reference_date:d auc:f")),
    }


def _certificate_queries(sf_dir: str) -> dict[str, Query]:
    """Fitted models held against what they must fulfil; SQL counts the rows, and each claim must hold (1)."""
    spec = _spec("churn", "accounting_established")
    rows_sql = sql.union_refs(_refs(spec), lambda ref: sql.dataset(ref, spec))
    judged = evaluation_date(spec, REFERENCE_DATE)
    settings = ", ".join(f"({reg})" for reg in learn.LR_REG_PARAM)
    per_setting = (f"FROM ({rows_sql}), (VALUES {settings}) AS v(reg_param) GROUP BY reg_param")

    def fitted(t: Tables):
        return cut_lineage(learn.training_frame(cut_lineage(dataset(t, _refs(spec), spec)), spec))

    def optimum(t: Tables) -> DataFrame:
        """A fit for each penalty on all training rows, and its gradient."""
        data = fitted(t)
        encoded = cut_lineage(Pipeline(stages=learn.encoding_stages(data, spec.predictors)).fit(data).transform(data)
                              .select("features", "label", "class_weight"))
        algorithm, _ = learn.logistic_regression()
        found = []
        for reg in learn.LR_REG_PARAM:
            model = algorithm.copy({algorithm.regParam: reg}).fit(encoded)
            certificate = logistic_certificate(encoded, model, reg)
            found.append((reg, certificate.rows, certificate.positives, int(certificate.gradient < 1e-4), int(certificate.gap < 1e-6)))
        return t.spark.createDataFrame(found, "reg_param double, n long, positives long, is_optimum int, gap_is_small int")

    def cross_validated(t: Tables) -> DataFrame:
        """Every fold's model is the optimum of the rows it saw, and the published area is that of its scores."""
        selection = learn.select_model(fitted(t), spec, parallelism=4, keep_folds=True)
        encoded, found = cut_lineage(selection.encoded), []
        for position, (params, metric) in enumerate(selection.metrics):
            models = [by_setting[position] for by_setting in selection.fold_models]
            seen = [logistic_certificate(encoded.where(F.col("fold") != fold), model, params["regParam"]) for fold, model in enumerate(models)]
            areas = fold_areas(encoded, models)
            found.append((params["regParam"], sum(c.rows for c in seen) // (len(models) - 1), sum(c.gradient < 1e-4 for c in seen),
                          int(abs(sum(areas.values()) / len(models) - metric) < 1e-9)))
        return t.spark.createDataFrame(found, "reg_param double, n long, optimal_folds int, area_agrees int")

    def evaluation(t: Tables) -> DataFrame:
        """The area that the evaluation reports is the exact one of the scores it judged."""
        _, selection = _trained(t, spec)
        scored_rows = cut_lineage(learn.score(selection.model, dataset(t, [judged], spec), spec.predictors))
        reported = learn.area_under_roc(scored_rows, spec.label)
        exact = monitoring.auc_by_rank(scored_rows, "event_probability", spec.label, [REF])
        return exact.withColumn("area_agrees", (F.abs(F.col("auc") - reported) < 1e-9).cast("int"))

    # one feature with two values: the sums of both halves follow from the margins before, so SQL can boost as well
    grid = ", ".join(f"({s.depth}, {s.reg_lambda}, {s.child_weight})" for s in boosting.GRID)
    fall = "(({g}) * ({g}) / (({h}) + reg_lambda))"
    both = {"g": "g0 + g1", "h": "h0 + h1"}
    gain = f"{fall.format(g='g0', h='h0')} + {fall.format(g='g1', h='h1')} - {fall.format(**both)}"
    odds = {x: f"1 / (1 + exp(-m{x}))" for x in (0, 1)}
    rounds = 6

    def boosted(t: Tables) -> DataFrame:
        orders = t.spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
            "o_orderkey AS key", "array(CASE WHEN o_totalprice > 200000 THEN 1D ELSE 0D END, 0.5D) AS x",
            "CASE WHEN o_totalprice > 120000 + o_orderkey % 150000 THEN 1 ELSE 0 END AS label", "0 AS fold")
        total = orders.count()
        data = orders.withColumn("class_weight", F.lit(120.0) / F.lit(float(total)))
        _, models = boosting.fit_together(data, 2, [(setting, None) for setting in boosting.GRID], rounds=rounds, row_share=1, column_share=1)
        margins = [f"struct({s.depth} AS depth, {s.reg_lambda}D AS reg_lambda, {s.child_weight}D AS child_weight, {model.margin()} AS margin)"
                   for s, model in zip(boosting.GRID, models)]
        return (data.selectExpr("x", f"inline(array({', '.join(margins)}))").selectExpr("CAST(x[0] AS INT) AS dear", "* EXCEPT (x)")
                .groupBy("depth", "reg_lambda", "child_weight", "dear").agg(F.count(F.lit(1)).alias("n"), F.min("margin").alias("low"), F.max("margin").alias("high")))

    boosted_sql = f"""
        WITH RECURSIVE halves AS (
            SELECT CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS dear, COUNT(*) AS n,
                   SUM(CASE WHEN o_totalprice > 120000 + o_orderkey % 150000 THEN 1 ELSE 0 END) AS positives FROM orders GROUP BY 1),
        sums AS (SELECT SUM(n) AS n, 120.0 * SUM(CASE WHEN dear = 0 THEN n ELSE 0 END) / SUM(n) AS w0, 120.0 * SUM(CASE WHEN dear = 1 THEN n ELSE 0 END) / SUM(n) AS w1,
                 120.0 * SUM(CASE WHEN dear = 0 THEN positives ELSE 0 END) / SUM(n) AS y0, 120.0 * SUM(CASE WHEN dear = 1 THEN positives ELSE 0 END) / SUM(n) AS y1 FROM halves),
        settings AS (SELECT * FROM (VALUES {grid}) AS v(depth, reg_lambda, child_weight)),
        boosted(depth, reg_lambda, child_weight, round, m0, m1) AS (
            SELECT depth, CAST(reg_lambda AS DOUBLE), CAST(child_weight AS DOUBLE), 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM settings
            UNION ALL
            SELECT depth, reg_lambda, child_weight, round + 1,
                   m0 + 0.05 * CASE WHEN divided THEN -g0 / (h0 + reg_lambda) ELSE -(g0 + g1) / (h0 + h1 + reg_lambda) END,
                   m1 + 0.05 * CASE WHEN divided THEN -g1 / (h1 + reg_lambda) ELSE -(g0 + g1) / (h0 + h1 + reg_lambda) END
            FROM (SELECT *, h0 >= child_weight AND h1 >= child_weight AND {gain} >= 0.1 AS divided FROM (
                SELECT boosted.*, w0 * {odds[0]} - y0 AS g0, w1 * {odds[1]} - y1 AS g1, w0 * {odds[0]} * (1 - {odds[0]}) AS h0, w1 * {odds[1]} * (1 - {odds[1]}) AS h1
                FROM boosted, sums)) WHERE round < {rounds})
        SELECT depth, reg_lambda, child_weight, dear, n, CASE WHEN dear = 0 THEN m0 ELSE m1 END AS low, CASE WHEN dear = 0 THEN m0 ELSE m1 END AS high
        FROM boosted, halves WHERE round = {rounds}"""
    return {
        "boosted_with_l2": Query(
            boosted, _kinds("depth:i reg_lambda:f child_weight:f dear:i n:i low:f high:f"), boosted_sql),
        "logistic_optimum": Query(
            optimum, _kinds("reg_param:f n:i positives:i is_optimum:i gap_is_small:i"),
            f"SELECT reg_param, COUNT(*) AS n, SUM({spec.label}) AS positives, 1 AS is_optimum, 1 AS gap_is_small {per_setting}"),
        "cross_validation_checked": Query(
            cross_validated, _kinds("reg_param:f n:i optimal_folds:i area_agrees:i"),
            f"SELECT reg_param, COUNT(*) AS n, {learn.FOLDS} AS optimal_folds, 1 AS area_agrees {per_setting}"),
        "evaluation_checked": Query(
            evaluation, _kinds("reference_date:d positives:i negatives:i area_agrees:i"),
            f"SELECT reference_date, SUM({spec.label}) AS positives, COUNT(*) - SUM({spec.label}) AS negatives, 1 AS area_agrees "
            f"FROM ({sql.union_refs([judged], lambda ref: sql.dataset(ref, spec))}) GROUP BY reference_date"),
    }


def _preparation_queries() -> dict[str, Query]:
    """What training does to the rows before a model is fitted, step by step."""
    spec = _spec("churn", "accounting_onboarding")
    keys = "reference_date, environment, account_code, package_code"
    rows_sql = sql.union_refs(_refs(spec), lambda ref: sql.dataset(ref, spec))
    kind = {p: _predictor_kind(p) for p in spec.predictors}
    categorical = [p for p in spec.predictors if kind[p] == "s"]
    numeric = [p for p in spec.predictors if kind[p] != "s"]
    prepared_sql = f"SELECT {keys}, {spec.label}, " + ", ".join(
        [*[f"coalesce({c}, 'missing') AS _{c}" for c in categorical],
         *[f"coalesce(CAST({c} AS DOUBLE), 0) AS _{c}" for c in numeric]]) + f" FROM ({rows_sql})"
    key_kinds = _kinds(KEY + "package_code:s")

    def rows(t: Tables) -> DataFrame:
        return dataset(t, _refs(spec), spec)

    def under(df: DataFrame) -> DataFrame:
        """Keys as they were, predictors with an underscore in front."""
        ready = learn.prepared(df, spec.predictors)
        return ready.select(*key_kinds, spec.label, *[F.col(p).alias(f"_{p}") for p in spec.predictors])

    def indexed(t: Tables) -> DataFrame:
        ready = cut_lineage(learn.prepared(rows(t), spec.predictors))
        encoders = Pipeline(stages=learn.encoding_stages(ready, spec.predictors)).fit(ready)
        return encoders.transform(ready)

    def assembled(t: Tables) -> DataFrame:
        found = indexed(t).withColumn("_values", vector_to_array("features"))
        rest = F.aggregate(F.slice("_values", len(numeric) + 1, F.size("_values")), F.lit(0.0), lambda a, x: a + x)
        positions = F.slice("_values", 1, len(numeric))
        return (found.select(*key_kinds, rest.alias("hot"), F.posexplode(positions).alias("position", "value")))

    index_sql = ", ".join(f"(SELECT COUNT(*) FROM ranks r WHERE r.name = '{c}' AND (r.n > own_{c}.n OR r.n = own_{c}.n AND r.value < own_{c}.value)) "
                          f"AS {c}_index" for c in categorical)
    joins = " ".join(f"JOIN ranks own_{c} ON own_{c}.name = '{c}' AND own_{c}.value = p._{c}" for c in categorical)
    ranks = " UNION ALL ".join(f"SELECT '{c}' AS name, _{c} AS value, COUNT(*) AS n FROM ready GROUP BY ALL" for c in categorical)
    order = "CAST(conv(substr(md5(concat_ws('/', account_code, environment, reference_date)), 1, 12), 16, 10) AS BIGINT)"
    order_sql = "CAST('0x' || substr(md5(concat_ws('/', account_code, environment, reference_date)), 1, 12) AS BIGINT)"
    odds = "(0.3 * log_bank_entry_count - 0.2 * log_purchase_entry_count + 0.1)"
    # of numeric predictors in their order, one row a value; each category has one 1 among the rest
    values_sql = " UNION ALL ".join(f"SELECT {keys}, {i} AS position, _{c} AS value FROM ready" for i, c in enumerate(numeric))
    return {
        "prepared_predictors": Query(
            lambda t: under(rows(t)), {**key_kinds, **{f"_{p}": "s" if p in categorical else "f" for p in spec.predictors}}, prepared_sql),
        "encoded_categories": Query(
            indexed, {**key_kinds, **{f"{c}_index": "i" for c in categorical}},
            f"WITH ready AS ({prepared_sql}), ranks AS ({ranks}) SELECT {keys}, {index_sql} FROM ready p {joins}"),
        "assembled_features": Query(
            assembled, {**key_kinds, "hot": "i", "position": "i", "value": "f"},
            f"WITH ready AS ({prepared_sql}) SELECT *, {len(categorical)} AS hot FROM ({values_sql})"),
        "training_weights": Query(
            lambda t: learn.weighted(rows(t), spec.label), {**key_kinds, "label": "f", "class_weight": "f"},
            f"SELECT *, {spec.label} AS label, CASE WHEN {spec.label} = 1 THEN 1 - share ELSE share END AS class_weight "
            f"FROM (SELECT *, AVG({spec.label}) OVER () AS share FROM ({rows_sql}))"),
        "fold_numbers": Query(
            lambda t: learn.stratified_folds(rows(t), spec.label, [REF, "environment", "account_code", "package_code"], order=order),
            {**key_kinds, "fold": "i"},
            f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {spec.label} ORDER BY {order_sql} % 1024, {order_sql}, {keys}) % 5 AS fold FROM ({rows_sql})"),
        "score_formula": Query(
            lambda t: rows(t).withColumn("no_event", F.expr(f"1 / (1 + exp{odds})")).withColumn("health_score", fn.health_score("no_event")),
            {**key_kinds, "no_event": "f", "health_score": "i"},
            f"SELECT *, round_even(no_event * 100, 0) AS health_score FROM (SELECT *, 1 / (1 + exp{odds}) AS no_event FROM ({rows_sql}))"),
    }


def _state_queries() -> dict[str, Query]:
    """As-of operators on states that were carried on month by month from the given tables."""
    financial = ["num_activated_divisions", *divisions.FINANCIAL_FLAGS, *divisions.FINANCIAL]

    def kept(t: Tables, name: str) -> Tables:
        store = StateStore(t.spark, shared_path(t.spark, "state"), STATES)
        # a third of the days' facts before the oldest date come late and are taken in
        late = t.with_table(name, t.get(name).where("pmod(xxhash64(environment, date), 3) <> 0"))
        store.advance(late, name, min(GRID))
        store.advance(t, name, min(GRID), late_since=min(GRID) - dt.timedelta(days=60))
        for ref in sorted(GRID)[1:]:
            store.advance(t, name, ref)
        return t.with_state(store)

    return {
        "latest_contract_from_state": Query(
            lambda t: contracts.latest_contract(kept(t, "activity_daily_contracts"), GRID),
            _kinds(KEY + "package_code:s event_type:s account_id:s number_of_users:i number_of_administrations:i "
                   "accountant_or_linked:i mrr:f date:d"),
            sql.union_refs(GRID, sql.latest_contract)),
        "last_upgrade_from_state": Query(
            lambda t: contracts.last_upgrade(kept(t, "activity_daily_contracts"), GRID), _keyed(["last_contract_upgrade_date"], "d"),
            sql.union_refs(GRID, sql.last_upgrade)),
        "division_financials_from_state": _block(
            lambda t, *args: divisions.financial_statistics(kept(t, "division_statistics_daily"), *args), sql.financial, financial,
            WINDOW, EVERYWHERE, "Accounting"),
    }


def _storage_queries() -> dict[str, Query]:
    """Sources and sinks: given tables written to the shared folder and read back."""
    spec = _spec("churn", "accountancy")
    dataset_sql = sql.union_refs(_refs(spec), lambda ref: sql.dataset(ref, spec))

    def written_twice(t: Tables) -> DataFrame:
        path = shared_path(t.spark, "training")
        rows = cut_lineage(dataset(t, _refs(spec), spec))
        write_by_reference_date(rows, path)
        write_by_reference_date(rows.where(F.col(REF) == F.lit(_refs(spec)[0])), path)  # a date again replaces itself
        return t.spark.read.parquet(path).groupBy(REF, "environment").agg(F.count(F.lit(1)).alias("n"), F.sum("churned").alias("churned"))

    def from_csv(t: Tables) -> DataFrame:
        path = shared_path(t.spark, "scores")
        text = lambda c: F.date_format(F.col(c).cast("timestamp"), fn.SCORE_TIMESTAMP_FORMAT)
        stored = t.get("health_score").select(
            F.col("phase"), text("predict_date").alias("predictdate"), text("reference_date").alias("referencedate"),
            "environment", F.col("account_code").alias("accountcode"), F.col("package_code").alias("packagecode"), F.col("health_score").alias("healthscore"))
        append_rows(stored, path, "csv")
        read = t.with_table("health_score", read_health_score_csv(t.spark, path))
        return read.get("health_score").withColumn("predict_date", F.to_date("predict_date"))

    def merged(t: Tables) -> DataFrame:
        root = shared_path(t.spark, "lake")
        accounts = t.get("accounts")
        accounts.where("sector_code IS NULL").drop("sector_code").write.parquet(f"{root}/Accounts/part=1")
        accounts.where("sector_code IS NOT NULL").write.parquet(f"{root}/Accounts/part=2")
        lake = Tables.from_parquet(t.spark, root, merge_schema={"accounts"}, paths={"accounts": f"{root}/Acc*"}, clean={"accounts"})
        return lake.get("accounts")

    def statistics(t: Tables) -> DataFrame:
        path = shared_path(t.spark, "statistics")
        for auc in (0.5, 0.75):  # a run again replaces the row of its date
            for ref in GRID:
                write_by_reference_date(statistics_row(t.spark, run="train", reference_date=ref, auc=auc), path)
        found = t.spark.read.parquet(path).select(REF, "run", "auc")
        days = t.get("activity_daily").groupBy("date").agg(F.count(F.lit(1)).alias("events"))
        return found.join(days, found[REF] == days["date"], "left").withColumn("events", F.coalesce("events", F.lit(0)))

    def published_twice(t: Tables) -> DataFrame:
        name = f"published_{uuid.uuid4().hex}"
        scores = t.get("is_usage_score").withColumn("predict_date", F.to_date("predict_date"))
        publish_table(scores.withColumn("score", F.col("score") + 1), name)  # a first run, corrected by the second
        publish_table(scores, name)
        return t.spark.table(name)

    def from_day_folders(t: Tables) -> DataFrame:
        root = shared_path(t.spark, "lake")
        write_by_day(t.get("activity_daily"), f"{root}/{DIRECTORIES['activity_daily']}")
        stored = Tables.from_parquet(t.spark, root, by_day=["activity_daily"])
        lake = t.with_stored("activity_daily", stored)
        return activity.pageviews(lake, GRID, WINDOW, EVERYWHERE, "Accounting")

    grid = ", ".join(f"(DATE '{ref}')" for ref in GRID)
    return {
        "published_table": Query(
            published_twice, _kinds("environment:s account_code:s package_code:s score:i reference_date:d predict_date:d phase:s"),
            "SELECT * REPLACE (CAST(predict_date AS DATE) AS predict_date) FROM t_is_usage_score"),
        "pageviews_from_day_folders": Query(
            from_day_folders, _kinds(KEY + "pageviews:i"),
            sql.union_refs(GRID, lambda ref: sql.pageviews(ref, WINDOW, EVERYWHERE, "Accounting"))),
        "training_set_written": Query(
            written_twice, _kinds("reference_date:d environment:s n:i churned:i"),
            f"SELECT reference_date, environment, COUNT(*) AS n, SUM(churned) AS churned FROM ({dataset_sql}) GROUP BY ALL"),
        "scores_from_csv": Query(
            from_csv, _kinds("environment:s account_code:s package_code:s health_score:i reference_date:d predict_date:d phase:s"),
            "SELECT * REPLACE (CAST(predict_date AS DATE) AS predict_date) FROM t_health_score"),
        "merged_schema": Query(
            merged, _kinds("environment:s account_code:s account_id:s sector_code:s is_accountant:s"), "SELECT * FROM t_accounts"),
        "statistics_written": Query(
            statistics, _kinds("reference_date:d run:s auc:f events:i"),
            "SELECT reference_date, 'train' AS run, 0.75 AS auc, (SELECT COUNT(*) FROM t_activity_daily a WHERE a.date = g.reference_date) AS events "
            f"FROM (VALUES {grid}) AS g(reference_date)"),
    }


DATASETS = {
    "established_dataset": ("churn", "accounting_established"),
    "onboarding_dataset": ("churn", "accounting_onboarding"),
    "accountancy_dataset": ("churn", "accountancy"),
    "manufacturing_dataset": ("churn", "manufacturing"),
    "prof_services_dataset": ("churn", "professional_services"),
    "wholesale_dataset": ("churn", "wholesale_distribution"),
    "prof_services_downgrade_dataset": ("downgrade", "professional_services"),
    "wholesale_downgrade_dataset": ("downgrade", "wholesale_distribution"),
}


#: Queries that also run with the cohort found first: name there -> name here. Rows and SQL are the same.
COHORT_FIRST = {
    "pageviews_cohort_first": "pageviews_window",
    "active_users_cohort_first": "active_users_divisions",
    "established_cohort_first": "established_dataset",
    "wholesale_cohort_first": "wholesale_dataset",
}


#: Queries that also run on tables in buckets by account: name there -> name here. Rows and SQL are the same.
BUCKETED = {
    "contract_base_bucketed": "contract_base_tenure",
    "pageviews_bucketed": "pageviews_window",
    "established_bucketed": "established_dataset",
}
BY_ACCOUNT = ("accounts", "accounts_contract_summary", "activity_daily_contracts", "activity_daily")


def in_buckets(t: Tables, buckets: int, names: Sequence[str] = BY_ACCOUNT) -> Tables:
    """The tables with the named ones written to the catalog in buckets by account."""
    run = uuid.uuid4().hex
    catalog = {name: f"bucketed_{name}_{run}" for name in names}
    for name, table in catalog.items():
        write_bucketed(t.get(name), table, contracts.CONTRACT_KEY, buckets)
    return t.with_catalog(catalog, clean=True)


def _bucketed(query: Query) -> Query:
    return replace(query, run=lambda t: query.run(in_buckets(t, int(t.spark.conf.get("spark.sql.shuffle.partitions")))))


def _cohort_first(query: Query) -> Query:
    return replace(query, run=lambda t: query.run(t.with_cohort_first()))


def all_queries(sf_dir: str = "") -> dict[str, Query]:
    usual = _usual_queries(sf_dir)
    return (usual | {name: _cohort_first(usual[other]) for name, other in COHORT_FIRST.items()}
            | {name: _bucketed(usual[other]) for name, other in BUCKETED.items()})


def _usual_queries(sf_dir: str) -> dict[str, Query]:
    return {
        **_activity_queries(),
        **_contract_queries(),
        **_division_queries(),
        **_feature_queries(),
        **{name: _dataset(*key) for name, key in DATASETS.items()},
        **_monitoring_queries(sf_dir),
        **_preparation_queries(),
        **_state_queries(),
        **_storage_queries(),
        **_learning_queries(),
        **_certificate_queries(sf_dir),
    }


def run_query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return all_queries(sf_dir)[name].frame(star_schema_tables(spark, sf_dir))
