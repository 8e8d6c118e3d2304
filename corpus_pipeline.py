"""The corpus pipeline: toxicity filter, line dedup, near-duplicate join, secret redaction, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written and read again as the next
stage's docs. All but the last return the columns of documents, with rows or texts that the stage decided on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.llm import toxicity
from tenura.llm.common import fresh_path, saved
from tenura.llm.line_chunks import passage_dedup
from tenura.llm.near_join import near_join
from tenura.llm.packing import pack
from tenura.llm.secret_scan import redact

#: No SQL: the toxicity stage is a trained network; tests hold the stages against brute force.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def _chosen(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """The rows of docs whose (id, hash of the text) are among the decided ones; of rows that share both, one."""
    keys = decided.groupBy(F.col("doc_id").alias("_at"), F.col("text_mark").alias("_mark")).agg(F.count(F.lit(1)).alias("_rows"))
    keys = saved(keys, "pipeline-kept")
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_at")) & (mark == F.col("_mark"))
    alone = docs.join(keys.where("_rows = 1"), same, "left_semi")
    repeated = docs.join(keys.where("_rows > 1"), same).dropDuplicates(["_at", "_mark"])
    return alone.unionByName(repeated.select(docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the model learns from the labels of the table beside the documents."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the repeated passages."""
    return _counted(passage_dedup(docs).select(docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies; of rows equal in id and text one."""
    return _chosen(docs, near_join(docs).where("kept"))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets replaced."""
    return _counted(redact(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 2048 tokens."""
    _, places = pack(docs)
    return places.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_copies),
    ("secret_scan", hide_secrets),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
