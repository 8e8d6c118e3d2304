"""Run registered queries on Spark and their SQL on DuckDB, and compare.

    python -m tenura.checks.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

from pyspark.sql import SparkSession

from tenura.checks.registry import all_queries
from tenura.sources.testdata import star_schema_tables


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark: SparkSession, sf_dir: str, name: str, connection=None) -> dict:
    """Row counts and whether all values agree."""
    query = all_queries(sf_dir)[name]
    started = time.time()
    df = query.frame(star_schema_tables(spark, sf_dir))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = {"query": name, "rows": len(got), "seconds": round(time.time() - started, 2), "same": None}
    if query.sql is not None:
        cursor = (connection or connect(sf_dir)).execute(query.oracle())
        expected = rows_of([d[0] for d in cursor.description], cursor.fetchall())
        result["expected"] = len(expected)
        result["same"] = got == expected
        if not result["same"]:
            result["extra"] = [r for r in got if r not in set(expected)][:3]
            result["missing"] = [r for r in expected if r not in set(got)][:3]
            result["columns"] = sorted(df.columns)
    return result


def main() -> None:
    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    for name in wanted or all_queries(sf_dir):
        try:
            print(compare(spark, sf_dir, name, connection), flush=True)
        except Exception as error:  # keep going: one report per query
            print({"query": name, "error": str(error)[:1500]}, flush=True)


if __name__ == "__main__":
    main()
