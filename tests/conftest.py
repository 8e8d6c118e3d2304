import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[4]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(folder / "checkpoint"))
               .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def d(text):
    return None if text is None else dt.date.fromisoformat(text)


def frame(spark, schema, rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def rows(df, *columns):
    """Sorted tuples of the given columns (all when none is given)."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
