"""Certificates of fitted models: what a fit claims, computed again from the rows by plain aggregates.

A logistic fit is convex, so a gradient of zero proves the optimum; its size bounds what is missing. The ROC area of a
cross-validation is computed again from the scores of each fold's model."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.operators.monitoring import auc_by_rank


@dataclass(frozen=True)
class Certificate:
    rows: int
    positives: int
    #: Length of the objective's gradient, features being scaled to unit deviation as in the fit.
    gradient: float
    #: The objective falls by no more than this in the penalised coefficients.
    gap: float


def _probability(features: Column, model: LogisticRegressionModel) -> Column:
    """Probability of the event from the coefficients alone."""
    coefficients = F.array(*[F.lit(float(c)) for c in model.coefficients])
    products = F.zip_with(features, coefficients, lambda x, c: x * c)
    return 1 / (1 + F.exp(-F.aggregate(products, F.lit(float(model.intercept)), lambda a, x: a + x)))


def logistic_certificate(data: DataFrame, model: LogisticRegressionModel, reg_param: float) -> Certificate:
    """Gradient of the weighted, L2-penalised log loss at a model's coefficients, as one aggregate over `data`
    (features, label, class_weight). Work grows with rows times features, the result with features."""
    size = len(model.coefficients)
    rows = data.select(vector_to_array("features").alias("x"), "label", F.col("class_weight").alias("w"))
    rows = rows.withColumn("left", F.col("w") * (_probability(F.col("x"), model) - F.col("label")))
    w, left = F.col("w"), F.col("left")
    at = [F.col("x").getItem(j) for j in range(size)]
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives"), F.sum(w).alias("w"), F.sum(w * w).alias("w2"), F.sum(left).alias("bias"),
        *[F.sum(w * x).alias(f"x{j}") for j, x in enumerate(at)], *[F.sum(w * x * x).alias(f"xx{j}") for j, x in enumerate(at)],
        *[F.sum(left * x).alias(f"g{j}") for j, x in enumerate(at)],
        *[(F.min(x) == F.max(x)).alias(f"flat{j}") for j, x in enumerate(at)]).first()
    total, slack = found["w"], found["w"] - found["w2"] / found["w"]
    penalised = []
    for j, coefficient in enumerate(model.coefficients):
        deviation = math.sqrt(max(found[f"xx{j}"] - found[f"x{j}"] ** 2 / total, 0.0) / slack)
        if deviation > 0 and not found[f"flat{j}"]:  # a constant feature has no coefficient
            penalised.append(found[f"g{j}"] / total / deviation + reg_param * coefficient * deviation)
    squares = sum(g * g for g in penalised)
    return Certificate(found["n"], int(found["positives"]), math.sqrt(squares + (found["bias"] / total) ** 2), squares / (2 * reg_param))


def fold_areas(data: DataFrame, models: list) -> dict[int, float]:
    """Exact ROC area of each fold's rows under the model that did not see them."""
    scored = [model.transform(data.where(F.col("fold") == fold)).select("fold", "label", vector_to_array("probability").getItem(1).alias("p"))
              for fold, model in enumerate(models)]
    whole = scored[0]
    for more in scored[1:]:
        whole = whole.unionByName(more)
    return {r["fold"]: r["auc"] for r in auc_by_rank(whole, "p", "label", ["fold"]).collect()}
