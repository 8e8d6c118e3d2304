"""Run modes: train, predict, evaluate, validate, or all of them in that order.

    python -m tenura.plans.jobs --category churn --name accountancy --mode train \
        --lake /data/lake --out /data/out --current-date 2024-01-30
"""

from __future__ import annotations

import argparse
import datetime as dt
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.functions import add_period
from tenura.operators import monitoring
from tenura.operators.states import STATES
from tenura.plans import learn
from tenura.plans.dataset import dataset
from tenura.plans.dates import evaluation_date, refine_dates, training_dates
from tenura.plans.specs import KEYS, ProductSpec, get_spec, load_spec
from tenura.sources.sinks import ModelStore, append_jdbc, append_rows, publish_table, statistics_row, write_by_reference_date
from tenura.sources.state import StateStore
from tenura.sources.tables import COHORT_BYTES, Tables, read_downgrade_score_csv, read_health_score_csv

MODES = ("train", "predict", "evaluate", "validate", "all")


def rows_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """What earlier runs wrote, None before the first one."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


@dataclass
class Run:
    """One product on one data set; results go below `out`."""

    tables: Tables
    spec: ProductSpec
    out: str
    current: dt.date
    past: dt.date
    #: Further places of published scores: csv, table or jdbc -> path, table name or address.
    sinks: dict[str, str] = field(default_factory=dict)

    @classmethod
    def create(cls, tables: Tables, spec: ProductSpec, out: str, current: dt.date | None = None,
               past: dt.date | None = None) -> Run:
        """Dates that are not given come from the data; days up to the last known one are not read again."""
        freshness = f"{out}/freshness"

        def newest() -> dt.date | None:
            known = rows_or_none(tables.spark, freshness)
            known = known and known.agg(F.max("latest_date")).first()[0]
            found = monitoring.freshness_date(tables, known).first()[0] or known
            if found is not None and found != known:
                append_rows(tables.spark.createDataFrame([(found,)], "latest_date date"), freshness)
            return found

        current, past = refine_dates(spec, newest, current, past)
        return cls(tables, spec, out, current, past)

    @property
    def spark(self) -> SparkSession:
        return self.tables.spark

    @property
    def models(self) -> ModelStore:
        return ModelStore(f"{self.out}/models")

    def keep_state(self, root: str) -> None:
        """As-of states below `root`, carried on to the dates of this run: later runs read the history once less."""
        store = StateStore(self.spark, root, STATES)
        for ref in sorted({*training_dates(self.spec, self.past), self.current}):
            for name in STATES:
                store.advance(self.tables, name, ref)
        self.tables = self.tables.with_state(store)

    def _statistics(self, kind: str, reference_date: dt.date, **values) -> None:
        """One row for a model and reference date: a run again replaces it."""
        row = statistics_row(self.spark, run=kind, environment=self.spec.countries, product=self.spec.product,
                             phase=self.spec.phase, category=self.spec.category, reference_date=reference_date, **values)
        write_by_reference_date(row, f"{self.out}/statistics/{kind}/model={self.spec.model_name}")

    def training_path(self) -> str:
        return f"{self.out}/training/{self.spec.model_name}"

    def train(self) -> float:
        """Build and store the training set, select a model, keep it when it is
        good enough or the first one."""
        refs = training_dates(self.spec, self.past)
        write_by_reference_date(dataset(self.tables, refs, self.spec), self.training_path())
        stored = (self.spark.read.parquet(self.training_path())
                  .where(F.col("reference_date").isin(refs)))
        data = learn.training_frame(stored, self.spec).persist()
        try:
            selection = learn.select_model(data, self.spec)
        finally:
            data.unpersist()
        now = dt.datetime.now()
        if selection.auc > self.spec.accepted_auc or self.models.latest(self.spec.model_name, self.spark) is None:
            self.models.save(selection.model, self.spec.model_name, selection.auc, self.spark, now)
        self._statistics("train", algorithm=self.spec.algorithm, reference_date=self.past, train_date=now,
                         reg_param=selection.params.get("regParam"), auc=selection.auc)
        return selection.auc

    def _scored(self, ref: dt.date, label: bool) -> DataFrame:
        model = self.models.load(self.spec.model_name, self.spark)
        return learn.score(model, dataset(self.tables, [ref], self.spec, label), self.spec.predictors)

    @property
    def score_table(self) -> str:
        return monitoring.SCORE_TABLES[self.spec.category][0]

    def scores_path(self) -> str:
        return f"{self.out}/publish/{self.score_table}/model={self.spec.model_name}"

    def predict(self) -> str:
        """Publish the scores of the current date. Running it again replaces them, in a catalog table too; csv and
        jdbc sinks only append."""
        name = monitoring.SCORE_TABLES[self.spec.category][1]
        scored = self._scored(self.current, label=False).select(
            *KEYS, F.col("health_score").alias(name), "reference_date",
            F.current_timestamp().alias("predict_date"), F.lit(self.spec.phase).alias("phase"))
        write_by_reference_date(scored, self.scores_path())
        for kind, target in self.sinks.items():
            written = self.spark.read.parquet(self.scores_path()).where(F.col("reference_date") == F.lit(self.current))
            if kind == "jdbc":
                append_jdbc(written, target, self.score_table)
            elif kind == "table":
                publish_table(written, target)
            else:
                append_rows(written, target, kind)
        return self.scores_path()

    def published(self) -> Tables:
        """The tables with the scores that were published: those of the lake and those of earlier runs below `out`."""
        own = rows_or_none(self.spark, f"{self.out}/publish/{self.score_table}")
        if own is None:
            return self.tables
        stored = self.tables.get(self.score_table)
        return self.tables.with_table(self.score_table, stored.unionByName(own.select(stored.columns)))

    def output_exists(self) -> bool:
        rows = monitoring.score_exists(self.published(), self.spec.category, self.current, self.spec.countries,
                                       self.spec.product, self.spec.phase)
        return not rows.isEmpty()

    def evaluate(self) -> float:
        """AUC of the stored model on a window the training set does not use."""
        ref = evaluation_date(self.spec, self.past)
        trained = self.models.latest(self.spec.model_name, self.spark)
        auc = learn.area_under_roc(self._scored(ref, label=True), self.spec.label)
        self._statistics("evaluate", reference_date=ref, train_date=trained[0] if trained else None,
                         evaluate_date=dt.datetime.now(), auc=auc)
        return auc

    def validate(self) -> float | None:
        """AUC of scores published a period ago against what happened since."""
        old_date = add_period(self.current, -self.spec.period)
        spec, tables = self.spec, self.published()
        if spec.category == "churn":
            rows = monitoring.old_churn_scores(tables, old_date, spec.countries, spec.product, spec.phase, spec.period)
        else:
            rows = monitoring.old_downgrade_scores(tables, old_date, spec.countries, spec.product, spec.period)
        result = (monitoring.auc_by_rank(rows.withColumn("_event", F.round(F.col("prob") * 100).cast("int")),
                                         "_event", "label", ["product", "predict_date"]).first())
        if result is None:
            return None
        self._statistics("validate", reference_date=old_date, predict_date=result["predict_date"], validate_date=dt.datetime.now(),
                         auc=result["auc"])
        return result["auc"]

    def run(self, mode: str) -> None:
        if mode not in MODES:
            raise ValueError(f"unknown mode {mode!r}")
        for step in MODES[:-1] if mode == "all" else (mode,):
            if step == "predict" and self.output_exists():
                print(f"scores of {self.current} already exist")
                continue
            print(f"{step} {self.spec.model_name} {self.current}: {getattr(self, step)()}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("contract risk")
    parser.add_argument("--category", required=True, choices=["churn", "downgrade"])
    parser.add_argument("--name", required=True, help="for example accounting_established")
    parser.add_argument("--mode", required=True, choices=MODES)
    parser.add_argument("--lake", required=True, help="root folder of the domain tables")
    parser.add_argument("--out", required=True, help="root folder of models, scores and statistics")
    parser.add_argument("--config", help="JSON file instead of the built-in specification")
    parser.add_argument("--score-csv", help="published scores in CSV instead of the lake's table")
    parser.add_argument("--state", help="root folder of as-of states that runs carry on, instead of reading whole histories")
    parser.add_argument("--cohort-mb", type=int, default=COHORT_BYTES >> 20,
                        help="largest size of a cohort's keys that are found first and keep other facts out; 0: never")
    parser.add_argument("--by-day", nargs="*", default=[], help="tables of the lake that lie in folders year=/month=/day= of their date")
    parser.add_argument("--clean", action="store_true", help="the lake's tables were written with normalised keys")
    for kind in ("csv", "table", "jdbc"):
        parser.add_argument(f"--publish-{kind}", help=f"write published scores to this {kind} sink as well")
    parser.add_argument("--current-date", type=dt.date.fromisoformat)
    parser.add_argument("--past-date", type=dt.date.fromisoformat)
    parser.add_argument("--shuffle-partitions", type=int,
                        help="partitions a shuffle starts with; adaptive execution merges small ones")
    options = parser.parse_args(argv)
    spec = (load_spec(options.config, options.category, options.name) if options.config
            else get_spec(options.category, options.name))
    builder = (SparkSession.builder.appName(f"contract-risk-{spec.model_name}")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false"))
    if options.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", options.shuffle_partitions)
    spark = builder.getOrCreate()
    tables = Tables.from_parquet(spark, options.lake, clean=options.clean, by_day=options.by_day).with_cohort_first(options.cohort_mb << 20)
    if options.score_csv:
        read = read_health_score_csv if spec.category == "churn" else read_downgrade_score_csv
        tables = tables.with_table(monitoring.SCORE_TABLES[spec.category][0], read(spark, options.score_csv))
    run = Run.create(tables, spec, options.out, options.current_date, options.past_date)
    run.sinks = {kind: target for kind in ("csv", "table", "jdbc") if (target := getattr(options, f"publish_{kind}"))}
    if options.state:
        run.keep_state(options.state)
    run.run(options.mode)


if __name__ == "__main__":
    main()
