"""Training and scoring on pyspark.ml.

Encoders are stages of the saved pipeline, so a category has the same column in
training and prediction, and an unseen one falls into its own bucket.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, FloatType, NumericType, StringType
from pyspark.sql.window import Window

from tenura.functions import health_score
from tenura.plans import boosting
from tenura.plans.specs import KEYS, ProductSpec

FOLDS = 5
# fixed values: search grids
LR_REG_PARAM = (0.1, 1.0, 10.0)
GBT_MAX_DEPTH = (3, 4, 5)
GBT_MIN_INSTANCES = (5, 10, 20)
GBT_ROUNDS = 50
GBT_STEP = 0.05
GBT_SUBSAMPLE = 0.6
GBT_COLUMNS = "0.6"
#: Gain of a split per row; the usual bound of 0.1 is on sums over the rows of a node.
GBT_MIN_GAIN = 1e-4
#: One row in so many is held back to stop boosting when its error no longer falls.
STOP_SHARE = 10
MISSING_CATEGORY = "missing"
#: Training rows of a partition, where that makes more partitions than the cores need.
PARTITION_ROWS = 100_000


def split_columns(df: DataFrame, predictors) -> tuple[list[str], list[str]]:
    """(categorical, numeric) predictors by their type; booleans count as numbers."""
    categorical = [p for p in predictors if isinstance(df.schema[p].dataType, StringType)]
    numeric = [p for p in predictors if isinstance(df.schema[p].dataType, (NumericType, BooleanType))]
    unusable = set(predictors) - set(categorical) - set(numeric)
    if unusable:
        raise TypeError(f"predictors of an unusable type: {sorted(unusable)}")
    return categorical, numeric


def prepared(df: DataFrame, predictors) -> DataFrame:
    """Numeric predictors as doubles with NULL and NaN as zero, no NULL category."""
    categorical, numeric = split_columns(df, predictors)
    columns = {c: F.coalesce(F.col(c), F.lit(MISSING_CATEGORY)) for c in categorical}
    for c in numeric:
        value = F.col(c).cast("double")
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            value = F.when(F.isnan(value), 0.0).otherwise(value)
        columns[c] = F.coalesce(value, F.lit(0.0))
    return df.withColumns(columns)


def class_share(df: DataFrame, label: str) -> float:
    """Share of positives, by one small aggregate."""
    return df.agg(F.avg(F.col(label).cast("double"))).first()[0] or 0.0


def weighted(df: DataFrame, label: str, share: float | None = None) -> DataFrame:
    """Adds label and class_weight: a row weighs the share of the other class."""
    if share is None:
        share = class_share(df, label)
    return df.withColumns({
        "label": F.col(label).cast("double"),
        "class_weight": F.when(F.col(label) == 1, 1.0 - share).otherwise(share),
    })


def stratified_folds(df: DataFrame, label: str, keys, folds: int = FOLDS, seed: int = 0,
                     buckets: int = 1024, order: str | None = None) -> DataFrame:
    """Adds a fold number such that every fold holds the same number of rows of
    each class, give or take one.

    Rows are put in hash order (or that of another number, the SQL of `order`). The order is built per (class, bucket of the hash)
    and continued over the buckets by their counts, so no task sees a whole class.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *keys) if order is None else F.expr(order))
    hashed = hashed.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)))
    group = [label, "_bucket"]
    sizes = hashed.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*group, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    position = F.row_number().over(Window.partitionBy(*group).orderBy("_hash", *keys))
    # at most two classes times `buckets` rows, whatever the data
    placed = hashed.withColumn("_position", position).join(F.broadcast(starts), group)
    return (placed.withColumn("fold", F.pmod(F.col("_start") + F.col("_position"), F.lit(folds)).cast("int"))
            .drop("_hash", "_bucket", "_position", "_start"))


def encoding_stages(df: DataFrame, predictors, one_hot: bool = True) -> list:
    categorical, numeric = split_columns(df, predictors)
    stages, inputs = [], list(numeric)
    if categorical:
        indexed = [f"{c}_index" for c in categorical]
        stages.append(StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep"))
        if one_hot:
            encoded = [f"{c}_onehot" for c in categorical]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"))
            inputs += encoded
        else:
            inputs += indexed
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def logistic_regression():
    model = LogisticRegression(weightCol="class_weight", maxIter=100)
    return model, ParamGridBuilder().addGrid(model.regParam, list(LR_REG_PARAM)).build()


def boosted_trees():
    model = GBTClassifier(weightCol="class_weight", maxIter=GBT_ROUNDS, stepSize=GBT_STEP,
                          subsamplingRate=GBT_SUBSAMPLE, featureSubsetStrategy=GBT_COLUMNS,
                          minInfoGain=GBT_MIN_GAIN, validationIndicatorCol="stopping", seed=0)
    grid = (ParamGridBuilder().addGrid(model.maxDepth, list(GBT_MAX_DEPTH))
            .addGrid(model.minInstancesPerNode, list(GBT_MIN_INSTANCES)).build())
    return model, grid


ALGORITHMS = {"LogisticRegression": logistic_regression, "GradientBoostedTrees": boosted_trees}
#: Boosting with an L2 term on the leaves, of tenura.plans.boosting.
SECOND_ORDER = "XGBoost"


@dataclass(frozen=True)
class Selection:
    auc: float
    params: dict[str, float]
    metrics: list[tuple[dict[str, float], float]]
    model: PipelineModel
    #: On request the rows as the classifier saw them, and its model for each fold and setting.
    encoded: DataFrame | None = None
    fold_models: list | None = None


def _plain(params) -> dict[str, float]:
    return {param.name: value for param, value in params.items()}


def select_model(data: DataFrame, spec: ProductSpec, algorithm=None, grid=None, folds: int = FOLDS,
                 parallelism: int = 3, keep_folds: bool = False) -> Selection:
    """Stratified cross-validation over the grid. `data` comes from training_frame.

    The encoders are fitted once; the folds refit the classifier only.
    """
    if algorithm is None and spec.algorithm == SECOND_ORDER:
        return select_boosted(data, spec, folds=folds)
    if algorithm is None:
        try:
            algorithm, default_grid = ALGORITHMS[spec.algorithm]()
        except KeyError:
            raise ValueError(f"unknown algorithm {spec.algorithm!r}") from None
        grid = grid or default_grid
    encoders = Pipeline(stages=encoding_stages(data, spec.predictors)).fit(data)
    encoded = encoders.transform(data).select("features", "label", "class_weight", "fold", "stopping")
    validator = CrossValidator(estimator=algorithm, estimatorParamMaps=grid,
                               evaluator=BinaryClassificationEvaluator(numBins=0),
                               numFolds=folds, foldCol="fold", parallelism=parallelism, collectSubModels=keep_folds)
    fitted = validator.fit(encoded)
    metrics = [(_plain(params), float(metric)) for params, metric in zip(grid, fitted.avgMetrics)]
    position = max(range(len(metrics)), key=lambda i: metrics[i][1])
    model = PipelineModel(stages=[*encoders.stages, fitted.bestModel])
    kept = (encoded, fitted.subModels) if keep_folds else (None, None)
    return Selection(metrics[position][1], metrics[position][0], metrics, model, *kept)


def select_boosted(data: DataFrame, spec: ProductSpec, settings=tuple(boosting.GRID), folds: int = FOLDS, **options) -> Selection:
    """Stratified cross-validation of second-order boosting over its grid, all settings and folds in the same passes, and
    the model of the best setting on all rows. The trees are stored as SQL, so the model is a pipeline like others."""
    indexers = Pipeline(stages=encoding_stages(data, spec.predictors, one_hot=False)[:-1]).fit(data)
    categorical, numeric = split_columns(data, spec.predictors)
    names = [*numeric, *[f"{c}_index" for c in categorical]]
    keys = ["reference_date", *KEYS]
    frame = indexers.transform(data).select(F.xxhash64(*keys).alias("key"), F.array(*[F.col(c).cast("double") for c in names]).alias("x"),
                                            "label", "class_weight", "fold")
    found = boosting.cross_validated(frame, len(names), settings, folds, **options)
    best, area = max(found, key=lambda each: each[1])
    _, (model,) = boosting.fit_together(frame, len(names), [(best, None)], **options)
    event = SQLTransformer(statement=f"SELECT *, array(1 - _event, _event) AS probability FROM (SELECT *, 1 / (1 + exp(-({model.margin(names=names)}))) AS _event FROM __THIS__)")
    metrics = [(asdict(setting), metric) for setting, metric in found]
    return Selection(area, asdict(best), metrics, PipelineModel(stages=[*indexers.stages, event]))


def in_few_partitions(folded: DataFrame, rows: int) -> DataFrame:
    """Folded rows in fewer partitions than the session shuffles into: a fit makes hundreds of passes, each with a task for
    every partition, so there are two for each core, and more only for many rows."""
    spark = folded.sparkSession
    needed = max(2 * spark.sparkContext.defaultParallelism, math.ceil(rows / PARTITION_ROWS))
    return folded.coalesce(needed) if needed < int(spark.conf.get("spark.sql.shuffle.partitions")) else folded


def training_frame(dataset: DataFrame, spec: ProductSpec) -> DataFrame:
    """Prepared predictors, label, class weight, fold, and which rows stop the boosting."""
    keys = ["reference_date", *KEYS]
    rows = dataset.select(*dict.fromkeys([*keys, *spec.predictors, spec.label]))
    folded = in_few_partitions(stratified_folds(rows, spec.label, keys), rows.count())
    stopping = F.pmod(F.xxhash64(F.lit("stopping"), *keys), F.lit(STOP_SHARE)) == 0
    return weighted(prepared(folded, spec.predictors), spec.label, class_share(rows, spec.label)).withColumn("stopping", stopping)


def score(model, data: DataFrame, predictors) -> DataFrame:
    """Adds probability (of the event) and health_score; rows keep their columns."""
    keep = list(data.columns)
    frame = data.withColumns({f"_in_{c}": F.col(c) for c in predictors if c in KEYS})
    scored = model.transform(prepared(frame, predictors))
    restored = [F.col(f"_in_{c}").alias(c) if c in predictors and c in KEYS else F.col(c) for c in keep]
    vector = isinstance(scored.schema["probability"].dataType, VectorUDT)
    return (scored.withColumn("_p", vector_to_array("probability") if vector else F.col("probability"))
            .select(*restored, F.expr("_p[1] AS event_probability"), health_score("_p[0]").alias("health_score")))


def area_under_roc(scored: DataFrame, label: str, probability: str = "event_probability") -> float:
    rows = scored.select(F.col(label).cast("double").alias("label"), F.col(probability).alias("p"))
    return BinaryClassificationEvaluator(rawPredictionCol="p", labelCol="label", numBins=0).evaluate(rows)
