"""Helpers of the training-data operators: shared tables, hot keys, vocabulary paths."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than one in HOT_SHARE of all rows is hot, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or one beside the warehouse where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Writes the rows as a table in the shared folder and reads them back: lineage ends there, lost executors lose nothing."""
    spark = frame.sparkSession
    path = fresh_path(spark, label)
    frame.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: What operators keep in a Python worker between tasks, and how to empty it. Workers live on from stage to stage.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(name: str, empty: Callable[[], None]) -> None:
    _KEPT[name] = empty


def starts_task(name: str) -> None:
    """Empties what other operators left in this worker, so that a worker holds one operator's store at a time."""
    others = [other for other in _KEPT if other != name]
    for other in others:
        _KEPT.pop(other)()
    if others:
        import pyarrow

        pyarrow.default_memory_pool().release_unused()


def vocabulary(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def text_of(name: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def hot_keys(counts: DataFrame, total: int, least: int = 256, share: int = HOT_SHARE) -> DataFrame:
    """Of (key columns, n): the hot ones with `salts`, the parts each is split into. At most `share` rows, so it may be broadcast."""
    limit = max(least, total // share)
    return F.broadcast(counts.where(F.col("n") > limit).withColumn("salts", F.ceil(F.col("n") / limit).cast("int")))


def spread(*columns: str) -> Column:
    """A non-negative hash to deal rows out by."""
    return F.abs(F.hash(*columns).cast("long"))


def key_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], counts: DataFrame, total: int, least: int = 256) -> DataFrame:
    """Inner join of many rows with a table of one row a key. `counts` (keys, n) says how many rows a key has; the table's
    rows of hot keys, at most HOT_SHARE of them, are broadcast, so that no task gets all rows of one key."""
    hot = hot_keys(counts, total, least).select(*keys)
    usual = rows.join(hot, keys, "left_anti").join(table, keys)
    return usual.unionByName(rows.join(F.broadcast(table.join(hot, keys)), keys))
