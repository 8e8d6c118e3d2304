"""Certificates of fits, and boosting against a plain implementation."""

import math
import random
from dataclasses import dataclass

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tenura.operators.monitoring import auc_by_rank
from tenura.plans import boosting, learn
from tenura.plans.certificate import fold_areas, logistic_certificate
from tests.conftest import d


def logistic_data(spark):
    rng = random.Random(2)
    rows = []
    for n in range(400):
        a, b = rng.gauss(3, 2), rng.gauss(-1, 0.5)
        rows.append((a, b, 7.0, float(rng.random() < 1 / (1 + math.exp(-(a - 3 + 2 * b + 2)))), rng.choice([0.3, 0.7]), n % 5))
    df = spark.createDataFrame(rows, "a double, b double, flat double, label double, class_weight double, fold int")
    return rows, VectorAssembler(inputCols=["a", "b", "flat"], outputCol="features").transform(df)


def gradient_by_hand(rows, model, reg):
    x, y, w = (np.array([r[:3] for r in rows]), np.array([r[3] for r in rows]), np.array([r[4] for r in rows]))
    left = w * (1 / (1 + np.exp(-(x @ np.array(model.coefficients) + model.intercept))) - y)
    mean = (w[:, None] * x).sum(0) / w.sum()
    deviation = np.sqrt((w[:, None] * (x - mean) ** 2).sum(0) / (w.sum() - (w ** 2).sum() / w.sum()))[:2]
    inner = (left[:, None] * x).sum(0)[:2] / w.sum() / deviation + reg * np.array(model.coefficients)[:2] * deviation
    return math.sqrt((inner ** 2).sum() + (left.sum() / w.sum()) ** 2), (inner ** 2).sum() / (2 * reg)


def test_certificate(spark):
    rows, data = logistic_data(spark)
    algorithm, _ = learn.logistic_regression()
    fits = {reg: algorithm.copy({algorithm.regParam: reg}).fit(data) for reg in (0.1, 10.0)}
    for fitted in fits:
        for claimed in fits:
            found = logistic_certificate(data, fits[fitted], claimed)
            gradient, gap = gradient_by_hand(rows, fits[fitted], claimed)
            assert (found.rows, found.positives) == (400, sum(r[3] for r in rows))
            assert found.gradient == pytest.approx(gradient, abs=1e-9) and found.gap == pytest.approx(gap, abs=1e-9)
            # the optimum of one penalty is none of the other
            assert (found.gradient < 1e-4) == (fitted == claimed)


def test_fold_areas(spark):
    _, data = logistic_data(spark)
    algorithm, _ = learn.logistic_regression()
    model = algorithm.copy({algorithm.regParam: 0.1}).fit(data)
    found = fold_areas(data, [model] * 5)
    for fold in range(5):
        scored = model.transform(data.where(F.col("fold") == fold)).withColumn("event_probability", vector_to_array("probability").getItem(1))
        assert found[fold] == pytest.approx(learn.area_under_roc(scored, "label"), abs=1e-12)


def boost_by_hand(rows, setting, rounds, min_gain=boosting.MIN_GAIN):
    """Margins of (x, label, weight, fold) rows, by recursion over sets of rows; every midway value is a cut."""
    margins = [0.0] * len(rows)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [w * (q - y) for q, (_, y, w) in zip(p, rows)]
        h = [w * q * (1 - q) for q, (_, y, w) in zip(p, rows)]

        def grow(members, depth):
            total = (sum(g[i] for i in members), sum(h[i] for i in members))
            leaf = boosting.leaf_weight(*total, setting.reg_lambda)
            best = None
            if depth < setting.depth:
                for f in range(len(rows[0][0])):
                    for cut in sorted({rows[i][0][f] for i in members})[:-1]:
                        left = [i for i in members if rows[i][0][f] <= cut]
                        right = [i for i in members if rows[i][0][f] > cut]
                        sums = [(sum(g[i] for i in side), sum(h[i] for i in side)) for side in (left, right)]
                        if min(s[1] for s in sums) >= setting.child_weight:
                            gain = sum(s[0] ** 2 / (s[1] + setting.reg_lambda) for s in sums) - total[0] ** 2 / (total[1] + setting.reg_lambda)
                            if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                                best = (gain, left, right)
            if best is None:
                return {i: leaf for i in members}, True
            (one, one_leaf), (two, two_leaf) = grow(best[1], depth + 1), grow(best[2], depth + 1)
            if one_leaf and two_leaf and best[0] < min_gain:
                return {i: leaf for i in members}, True
            return one | two, False

        added, _ = grow(list(range(len(rows))), 0)
        margins = [m + boosting.STEP * added[i] for i, m in enumerate(margins)]
    return margins


def boosting_rows(seed, n=300):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = (float(rng.randrange(5)), float(rng.randrange(3)), 1.0, float(rng.randrange(4)))
        out.append((x, int(rng.random() < 0.2 + 0.6 * ((x[0] > 2) ^ (x[1] > 0))), rng.choice([0.5, 1.0])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_boosting_is_that_by_hand(spark, seed):
    rows = boosting_rows(seed)
    settings = [boosting.Setting(3, 1.0, 5.0), boosting.Setting(2, 2.0, 20.0), boosting.Setting(4, 2.0, 5.0)]
    data = spark.createDataFrame([(n, list(x), y, w, n % 3) for n, (x, y, w) in enumerate(rows)], "key long, x array<double>, label int, class_weight double, fold int")
    fitted, models = boosting.fit_together(data, 4, [(s, None) for s in settings], rounds=6, row_share=1, column_share=1)
    got = {r["key"]: r["margins"] for r in fitted.collect()}
    scored = data.selectExpr("key", *[f"{model.margin()} AS m{i}" for i, model in enumerate(models)]).collect()
    for i, setting in enumerate(settings):
        expected = boost_by_hand(rows, setting, 6)
        assert [got[n][i] for n in range(len(rows))] == pytest.approx(expected, abs=1e-9)
        assert {r["key"]: r[f"m{i}"] for r in scored} == pytest.approx(dict(enumerate(expected)), abs=1e-9)
        assert any(tree.splits for tree in models[i].trees)


def test_left_out_folds_and_samples(spark):
    """A fold left out has no influence on its variant's trees; samples of rows and features are the same for a seed."""
    rows = boosting_rows(5)
    schema = "key long, x array<double>, label int, class_weight double, fold int"
    data = spark.createDataFrame([(n, list(x), y, w, n % 3) for n, (x, y, w) in enumerate(rows)], schema)
    changed = data.withColumn("label", F.expr("CASE WHEN fold = 1 THEN 1 - label ELSE label END"))
    variants = [(boosting.Setting(3, 1.0, 5.0), 1), (boosting.Setting(3, 1.0, 5.0), None)]
    one, two = (boosting.fit_together(df, 4, variants, rounds=3)[1] for df in (data, changed))
    assert one[0].trees == two[0].trees and one[1].trees != two[1].trees


def test_nothing_to_split(spark):
    schema = "key long, x array<double>, label int, class_weight double, fold int"
    flat = spark.createDataFrame([(n, [1.0, 2.0], n % 2, 1.0, 0) for n in range(10)], schema)
    rows, (model,) = boosting.fit_together(flat, 2, [(boosting.Setting(3, 1.0, 1.0), None)], rounds=2)
    assert {r["margins"][0] for r in rows.collect()} == {0.0} or all(abs(r["margins"][0]) < 0.2 for r in rows.collect())
    assert all(not tree.splits for tree in model.trees)


def test_search_and_stored_model(spark, tmp_path):
    """The search finds the better setting by rows left out; the model is stored and read as a pipeline and scores rows."""

    @dataclass(frozen=True)
    class Spec:
        predictors = ("kind", "amount", "flag")
        label = "churned"
        algorithm = "XGBoost"

    rng = random.Random(6)
    rows = []
    for n in range(600):
        kind, amount = rng.choice(["a", "b", None]), rng.gauss(0, 1)
        rows.append((d("2024-01-01"), "nl", f"a{n}", "p", kind, amount, amount > 1, float(rng.random() < (0.8 if (kind == "a") ^ (amount > 0) else 0.2))))
    dataset = spark.createDataFrame(rows, "reference_date date, environment string, account_code string, package_code string, kind string, amount double, flag boolean, churned double")
    data = learn.training_frame(dataset, Spec).cache()
    settings = [boosting.Setting(3, 1.0, 5.0), boosting.Setting(3, 1.0, 1000.0)]
    selection = learn.select_boosted(data, Spec, settings, rounds=5, row_share=1, column_share=1)
    assert selection.params == {"depth": 3, "reg_lambda": 1.0, "child_weight": 5.0} and selection.auc > 0.7
    assert selection.metrics[1][1] == pytest.approx(0.5)
    selection.model.write().save(str(tmp_path / "model"))
    model = type(selection.model).load(str(tmp_path / "model"))
    scored = learn.score(model, dataset, Spec.predictors)
    assert scored.count() == 600 and scored.where("health_score NOT BETWEEN 0 AND 100").isEmpty()
    assert auc_by_rank(scored.withColumn("g", F.lit(1)), "event_probability", "churned", ["g"]).first()["auc"] > 0.7


def test_training_rows_come_in_few_partitions(spark):
    """Two partitions for each core, however many the session shuffles into; more for many rows; the folds are the same."""
    rows = spark.range(400).selectExpr("id", "CAST(id % 7 = 0 AS DOUBLE) AS label")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        folded = learn.stratified_folds(rows, "label", ["id"])
        few = learn.in_few_partitions(folded, 400).persist()
        cores = spark.sparkContext.defaultParallelism
        assert few.rdd.getNumPartitions() == 2 * cores
        assert sorted(few.collect()) == sorted(folded.collect())
        assert learn.in_few_partitions(folded, 49 * learn.PARTITION_ROWS).persist().rdd.getNumPartitions() == 49
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.catalog.clearCache()
