import datetime as dt
import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tenura.operators.monitoring import auc_by_rank
from tenura.plans import learn
from tenura.plans.dataset import dataset, features, model_columns
from tenura.plans.dates import evaluation_date, refine_dates, training_dates
from tenura.plans.jobs import Run, main
from tenura.plans.named_queries import NAMED, run_named
from tenura.plans.specs import SPECS, get_spec, load_spec, snake_case
from tenura.sources.sinks import ModelStore
from tenura.sources.tables import DIRECTORIES, SCORES, Tables
from tenura.sources.testdata import REFERENCE_DATE, star_schema_tables
from tests.conftest import d, rows
from tests.fixtures import REF, tables

SF = "/root/testdata/sf0.001"
ALL = [(category, name) for category, specs in SPECS.items() for name in specs]


def test_reference_dates():
    spec = get_spec("churn", "manufacturing")
    current, past, latest = d("2024-05-01"), d("2024-01-01"), d("2024-03-20")

    def never():
        raise AssertionError("freshness is not needed")

    assert refine_dates(spec, lambda: latest) == (latest, latest - dt.timedelta(days=91))
    assert refine_dates(spec, never, current=current) == (current, current - dt.timedelta(days=91))
    assert refine_dates(spec, lambda: latest, past=past) == (latest, past)
    assert refine_dates(spec, lambda: d("2025-01-01"), past=past) == (past + dt.timedelta(days=91), past)
    assert refine_dates(spec, never, current, past) == (current, past)
    assert training_dates(spec, past) == [past - dt.timedelta(days=91 * i) for i in range(4)]
    assert evaluation_date(spec, past) == past - dt.timedelta(days=136)


def test_specs_load_from_json(tmp_path):
    path = tmp_path / "spec.json"
    path.write_text(json.dumps({
        "product": "Accountancy", "phase": "All", "country": "NL,BE", "period": 3, "window_activities": 91,
        "window_contract": 91, "algorithm": "LogisticRegression", "accepted_auc": 0.8, "label": "Churned",
        "predictors": ["LoginFreq", "LogBankEntryCount", "LogOtherAccoutancyActivities", "TenureInMonthsUpgrade"]}))
    spec = load_spec(str(path), "churn", "accountancy")
    assert spec.predictors == ("login_freq", "log_bank_entry_count", "log_other_accountancy_activities",
                               "tenure_in_months_upgrade")
    assert spec.excluded_edition == "Basic" and spec.label == "churned"
    path.write_text("{}")
    with pytest.raises(ValueError):
        load_spec(str(path), "churn", "accountancy")
    with pytest.raises(ValueError):
        get_spec("churn", "nothing")


def test_snake_case():
    assert snake_case("ProjectTypePrepaidHTB") == "project_type_prepaid_htb"
    assert snake_case("HasBig3BankAccount") == "has_big3_bank_account"
    assert snake_case("LogGLTransactions") == "log_gl_transactions"


@pytest.mark.parametrize("category,name", ALL)
def test_dataset_has_ordered_columns_and_one_row_per_key(spark, category, name):
    spec = get_spec(category, name).everywhere("NL,BE")
    t = star_schema_tables(spark, SF)
    refs = training_dates(spec, REFERENCE_DATE)
    df = dataset(t, refs, spec)
    assert df.columns == model_columns(spec)
    counts = df.groupBy("reference_date", "environment", "account_code").count()
    assert counts.where("count > 1").isEmpty()
    unlabelled = dataset(t, refs[:1], spec, label=False)
    assert spec.label not in unlabelled.columns


def test_grid_equals_single_dates(spark):
    spec = get_spec("churn", "wholesale_distribution").everywhere("NL,BE")
    t = star_schema_tables(spark, SF)
    refs = training_dates(spec, REFERENCE_DATE)[:3]
    grid = rows(dataset(t, refs, spec))
    assert grid == sorted((r for ref in refs for r in rows(dataset(t, [ref], spec))), key=repr)
    assert grid


def test_cohorts(spark):
    t = tables(spark)
    established = features(t, [REF], get_spec("churn", "accounting_established"))
    assert rows(established, "account_code", "churned", "accountant") == [("a1", 1.0, "Active")]
    onboarding = features(t, [REF], get_spec("churn", "accounting_onboarding"))
    assert rows(onboarding, "account_code", "master_data_setup_type") == [("b1", "Unknown")]
    accountancy = features(t, [REF], get_spec("churn", "accountancy"))
    assert rows(accountancy, "account_code", "edition", "login_freq") == [("a6", None, 0.0)]  # Basic is out, NULL stays


def _noisy(spark, n=400, seed=1):
    random.seed(seed)
    data = []
    for i in range(n):
        x, flag, group = random.gauss(0, 1), random.random() < 0.4, random.choice(["u", "v", None])
        y = 1.0 if x + (1.0 if group == "u" else 0.0) + random.gauss(0, 0.5) > 1.2 else 0.0
        data.append((REF, "nl", f"a{i}", "p", None if i % 50 == 0 else x, flag, group, y))
    return spark.createDataFrame(data, "reference_date date, environment string, account_code string, "
                                       "package_code string, x double, flag boolean, grp string, churned double")


class _Spec:
    predictors = ("x", "flag", "grp", "environment")
    label = "churned"
    algorithm = "LogisticRegression"


def test_folds_are_stratified_and_stable(spark):
    df = _noisy(spark, 503)
    keys = ["reference_date", "environment", "account_code"]
    folded = learn.stratified_folds(df, "churned", keys, buckets=16)
    sizes = folded.groupBy("churned", "fold").count().collect()
    for label in (0.0, 1.0):
        counts = [r["count"] for r in sizes if r["churned"] == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1
    assert folded.count() == 503
    again = learn.stratified_folds(df.repartition(7), "churned", keys, buckets=16)
    assert rows(folded, "account_code", "fold") == rows(again, "account_code", "fold")


def test_weights_and_missing_values(spark):
    df = learn.weighted(learn.prepared(_noisy(spark), _Spec.predictors), "churned")
    share = df.agg(F.avg("churned")).first()[0]
    weights = {r[0]: r[1] for r in df.select("churned", "class_weight").distinct().collect()}
    assert abs(weights[1.0] - (1 - share)) < 1e-12 and abs(weights[0.0] - share) < 1e-12
    assert df.where("x IS NULL OR flag IS NULL OR grp IS NULL").isEmpty()
    nan = spark.createDataFrame([(float("nan"), True)], "x double, flag boolean")
    assert learn.prepared(nan, ["x", "flag"]).first() == (0.0, 1.0)
    with pytest.raises(TypeError):
        learn.split_columns(_noisy(spark), ["reference_date"])


def test_model_selection_scores_and_storage(spark, tmp_path):
    df = _noisy(spark)
    data = learn.training_frame(df, _Spec).persist()
    selection = learn.select_model(data, _Spec, folds=5)
    assert selection.auc > 0.8
    assert selection.auc == max(m for _, m in selection.metrics)
    assert [p["regParam"] for p, _ in selection.metrics] == [0.1, 1.0, 10.0]
    scored = learn.score(selection.model, df, _Spec.predictors)
    bounds = scored.agg(F.min("health_score"), F.max("health_score"), F.count("*")).first()
    assert 0 <= bounds[0] <= bounds[1] <= 100 and bounds[2] == 400
    assert scored.where("abs(health_score - (100 - 100 * event_probability)) > 0.5000001").isEmpty()
    # an unseen category is scored too
    unseen = df.limit(1).withColumn("grp", F.lit("never seen"))
    assert learn.score(selection.model, unseen, _Spec.predictors).first()["health_score"] is not None
    # the evaluator and the rank formula agree
    exact = auc_by_rank(scored.withColumn("g", F.lit(1)), "event_probability", "churned", ["g"]).first()["auc"]
    assert abs(learn.area_under_roc(scored, "churned") - exact) < 1e-9
    store = ModelStore(str(tmp_path))
    with pytest.raises(ValueError):
        store.load("m", spark)
    store.save(selection.model, "m", selection.auc, spark, dt.datetime(2024, 1, 1))
    store.save(selection.model, "m", selection.auc, spark, dt.datetime(2024, 2, 1))
    assert store.latest("m", spark)[0] == dt.datetime(2024, 2, 1)
    loaded = learn.score(store.load("m", spark), df, _Spec.predictors)
    assert rows(loaded, "account_code", "health_score") == rows(scored, "account_code", "health_score")
    data.unpersist()


def test_boosted_trees(spark):
    df = _noisy(spark, 300)
    data = learn.training_frame(df, _Spec)
    estimator, grid = learn.boosted_trees()
    selection = learn.select_model(data, _Spec, algorithm=estimator.setMaxIter(3), grid=grid[:2], folds=2 + 3)
    assert selection.auc > 0.7


def test_run_modes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(learn, "LR_REG_PARAM", (0.1,))
    spec = replace(get_spec("churn", "wholesale_distribution").everywhere("NL,BE"), accepted_auc=0.99)
    run = Run.create(star_schema_tables(spark, SF), spec, str(tmp_path), current=REFERENCE_DATE)
    assert not run.output_exists()
    run.train()  # kept although below the gate: there was no model
    first = run.models.latest(spec.model_name, spark)
    run.train()  # the gate holds now
    assert run.models.latest(spec.model_name, spark) == first
    run.predict()
    run.predict()
    scores = spark.read.parquet(run.scores_path())
    live = dataset(run.tables, [REFERENCE_DATE], spec, label=False).count()
    assert scores.count() == live > 0
    assert run.output_exists()
    run.evaluate()
    run.validate()
    statistics = {kind: spark.read.parquet(f"{tmp_path}/statistics/{kind}") for kind in ("train", "evaluate", "validate")}
    # a run again replaces the row of its reference date
    assert {kind: df.count() for kind, df in statistics.items()} == {"train": 1, "evaluate": 1, "validate": 1}
    assert statistics["train"].where("auc IS NULL OR reg_param IS NULL").isEmpty()
    with pytest.raises(ValueError):
        run.run("dance")


def test_command_line_on_a_lake(spark, tmp_path, capsys):
    t = tables(spark)
    for name, directory in DIRECTORIES.items():
        t.get(name).write.parquet(str(tmp_path / "lake" / directory))
    arguments = ["--category", "churn", "--name", "accounting_established", "--lake", str(tmp_path / "lake"),
                 "--out", str(tmp_path / "out")]
    main([*arguments, "--mode", "validate"])  # the current date comes from the data
    assert "validate churn_accounting_established 2024-01-30: None" in capsys.readouterr().out
    with pytest.raises(ValueError, match="no trained model"):
        main([*arguments, "--mode", "predict", "--current-date", "2024-01-31"])
    with pytest.raises(SystemExit):
        main([*arguments, "--mode", "unknown"])


def test_publish_loop_on_a_lake_without_scores(spark, tmp_path, monkeypatch, capsys):
    """A first run of all modes on a lake without score tables; the second one finds the scores of the first."""
    monkeypatch.setattr(learn, "LR_REG_PARAM", (0.1,))
    t, lake, out = star_schema_tables(spark, SF), tmp_path / "lake", tmp_path / "out"
    for name, directory in DIRECTORIES.items():
        if name not in SCORES:
            t.get(name).write.parquet(str(lake / directory))
    arguments = ["--category", "churn", "--name", "accountancy", "--lake", str(lake), "--out", str(out), "--clean",
                 "--publish-csv", str(tmp_path / "csv")]
    main([*arguments, "--mode", "all"])
    first = capsys.readouterr().out
    assert "already exist" not in first and "validate churn_accountancy" in first
    published = spark.read.parquet(str(out / "publish" / "health_score"))
    assert published.count() == spark.read.csv(str(tmp_path / "csv"), header=True).count() > 0
    main([*arguments, "--mode", "all"])
    assert "already exist" in capsys.readouterr().out
    assert spark.read.parquet(str(out / "publish" / "health_score")).count() == published.count()
    assert spark.read.parquet(str(out / "freshness")).count() == 1
    # scores of a period ago are judged by what happened since
    spec = replace(get_spec("churn", "accountancy"))
    old = Run.create(Tables.from_parquet(spark, str(lake), clean=True), spec, str(out), current=REFERENCE_DATE - dt.timedelta(days=182))
    old.predict()
    later = Run.create(Tables.from_parquet(spark, str(lake), clean=True), spec, str(out), current=REFERENCE_DATE)
    old_scores = later.published().get("health_score").where(F.col("reference_date") == F.lit(old.current))
    assert old_scores.count() > 0


def test_unreadable_is_not_absent(spark, tmp_path):
    (tmp_path / "registry").mkdir()
    (tmp_path / "registry" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        ModelStore(str(tmp_path)).latest("m", spark)
    assert ModelStore(str(tmp_path / "nowhere")).latest("m", spark) is None


def test_named_queries(spark):
    t = tables(spark)
    day, env = "2024-01-31", "NL,BE"
    parameters = {
        "contract_base": [day, env, "Accounting"], "setup_type": [day, env, "Accounting"],
        "user_role_days": [day, 91, env, "Accounting"], "linked_companies": [day, 91, env],
        "downgrade_events": ["2024-04-30", env, "Wholesale distribution", day], "freshness_date": [],
        "health_score_exists": [day, env, "Accounting", "All"], "downgrade_score_exists": [day, env, "Accounting", "All"],
        "old_churn_scores": [day, env, "Accounting", "All"], "old_downgrade_scores": [day, env, "Wholesale distribution"]}
    for name in NAMED:
        run_named(t, name, parameters.get(name, [day, 91, env, "Accounting"])).collect()
    assert rows(run_named(t, "pageviews", [day, 91, "NL", "Accounting"]), "account_code", "pageviews") == [("a1", 21)]
    with pytest.raises(ValueError):
        run_named(t, "unheard of")
