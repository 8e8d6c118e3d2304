"""Where results go: training sets, published scores, run statistics, models."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATISTICS_SCHEMA = (
    "run string, environment string, product string, phase string, category string, algorithm string, "
    "reg_param double, reference_date date, train_date timestamp, evaluate_date timestamp, "
    "validate_date timestamp, predict_date date, auc double")
REGISTRY_SCHEMA = "model string, train_date timestamp, auc double, path string"


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder that driver and executors share: spark.checkpoint.dir, or one beside the warehouse
    where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "rows") -> DataFrame:
    """Written to the shared folder and read back: nothing before is computed again, lost executors lose nothing."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_reference_date(df: DataFrame, path: str) -> None:
    """Replace the reference dates present in df and keep the others, so that
    running a date again does not add rows twice. Rows are brought together by date
    and cut by size first: a date is a few full files, not one per task."""
    (df.hint("rebalance", "reference_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("reference_date").parquet(path))


def append_rows(df: DataFrame, path: str, kind: str = "parquet") -> None:
    writer = df.write.mode("append")
    if kind == "csv":
        writer.csv(path, header=True)
    elif kind == "table":
        writer.saveAsTable(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown sink {kind!r}")


def publish_table(df: DataFrame, name: str) -> None:
    """Writes to a catalog table by reference date: dates present in df replace those of the table, others stay, so a run
    published twice leaves one set of rows. The table is made where it is not there; columns are matched by name."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.hint("rebalance", "reference_date").write.partitionBy("reference_date").saveAsTable(name)
        return
    columns = spark.table(name).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"columns of {name} are {sorted(columns)}, not {sorted(df.columns)}")
    # a catalog table takes the mode from the session only
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.select(*columns).hint("rebalance", "reference_date").write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_by_day(df: DataFrame, path: str, date: str = "date") -> None:
    """Writes folders year=/month=/day=; days present in df replace themselves. Rows are brought together by day first."""
    folders = {"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)}
    (df.withColumns(folders).hint("rebalance", *folders).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path))


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """Writes a catalog table in buckets by `keys`, one sorted file a bucket; an older table of the name is replaced. Joins
    and aggregates by these keys (or by more columns) then need no shuffle. One key's rows share a bucket."""
    (df.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    df.write.jdbc(url, table, mode="append", properties=properties or {})


def statistics_row(spark: SparkSession, **values) -> DataFrame:
    """One row of run statistics; fields that do not apply stay NULL."""
    names = [part.strip().split(" ")[0] for part in STATISTICS_SCHEMA.split(",")]
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"unknown statistics: {sorted(unknown)}")
    return spark.createDataFrame([tuple(values.get(name) for name in names)], STATISTICS_SCHEMA)


@dataclass(frozen=True)
class ModelStore:
    """Dated model folders below one root and a small table that lists them."""

    root: str

    def _registry(self) -> str:
        return f"{self.root}/registry"

    def save(self, model, name: str, auc: float, spark: SparkSession, now: dt.datetime | None = None) -> str:
        now = now or dt.datetime.now()
        # a folder of its own: a scoring run never reads a model that is being written
        path = f"{self.root}/{name}/train_date={now:%Y%m%d}/{uuid.uuid4().hex}"
        model.write().save(path)
        spark.createDataFrame([(name, now, auc, path)], REGISTRY_SCHEMA) \
            .write.mode("append").parquet(self._registry())
        return path

    def latest(self, name: str, spark: SparkSession) -> tuple[dt.datetime, str] | None:
        try:
            models = spark.read.schema(REGISTRY_SCHEMA).parquet(self._registry())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # unreadable is not absent
                raise
            return None
        row = (models.where(F.col("model") == name)
               .orderBy(F.col("train_date").desc()).select("train_date", "path").first())
        return None if row is None else (row["train_date"], row["path"])

    def load(self, name: str, spark: SparkSession):
        from pyspark.ml import PipelineModel

        entry = self.latest(name, spark)
        if entry is None:
            raise ValueError(f"no trained model {name!r} below {self.root}")
        return PipelineModel.load(entry[1])
