"""As-of state kept up to date: per key what is newest at the end of a month, so that history is read once.

A state is a table of rows of the facts (or rows that stand for them), one partition for each closed month: all that a
reference date after that month can need of what was before. It is carried on from the partition before and the days
since. A small table of watermarks names the partitions that are whole; a partition is listed after it was written, so a
run that dies leaves nothing that is read. Facts that come late are taken in by carrying on from the month they belong to.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenura.sources.tables import Tables

WATERMARK_SCHEMA = "table_name string, as_of date, written timestamp, part string"
DAY = dt.timedelta(days=1)


def month_end(day: dt.date) -> dt.date:
    """The last day of the last month that is over on a day (that day itself, if it ends its month)."""
    return day if (day + DAY).day == 1 else day.replace(day=1) - DAY


@dataclass(frozen=True)
class StateStore:
    """States below one root. `compact` says for each table which rows (with a date) later dates can need."""

    spark: SparkSession
    root: str
    compact: Mapping[str, Callable[[DataFrame], DataFrame]]

    def watermarks(self, name: str) -> dict[dt.date, str]:
        """Closed months of a state, and the folder that holds each; a month written again has the newer folder."""
        try:
            listed = self.spark.read.schema(WATERMARK_SCHEMA).parquet(f"{self.root}/watermarks")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":  # unreadable is not absent
                raise
            return {}
        rows = listed.where(F.col("table_name") == name).groupBy("as_of").agg(F.max_by("part", "written").alias("part")).collect()  # one a month
        return {r["as_of"]: r["part"] for r in sorted(rows, key=lambda r: r["as_of"])}

    def _partition(self, name: str, parts: Mapping[dt.date, str], days: Sequence[dt.date]) -> DataFrame:
        stored = self.spark.read.parquet(f"{self.root}/{name}")
        return stored.where(F.col("part").isin([parts[day] for day in days])).drop("part")

    def advance(self, tables: Tables, name: str, through: dt.date, late_since: dt.date | None = None,
                now: dt.datetime | None = None) -> list[dt.date]:
        """Carries the state on to the last month closed by `through`, and returns the months written.

        Nothing is read when that month is there already. With `late_since`, the day of the oldest fact that came
        late, every month from that day's on is written again."""
        last, parts = month_end(through), self.watermarks(name)
        again = [day for day in parts if late_since is not None and day >= late_since]
        wanted = sorted({*again, *([last] if all(day < last for day in parts) else [])})
        for day in wanted:
            before = max((d for d in parts if d < day and (d not in again or d in wanted[:wanted.index(day)])), default=None)
            facts = tables.get(name, None if before is None else before + DAY, day)
            compact = self.compact[name]
            if before is not None:
                held = self._partition(name, parts, [before])
                facts = facts.select(*held.columns).unionByName(held)
            part = f"{day}-{uuid.uuid4().hex}"
            # the rows of a state are dealt by size, not by the tasks that made them
            compact(facts).withColumn("part", F.lit(part)).hint("rebalance").write.mode("append").partitionBy("part").parquet(f"{self.root}/{name}")
            self.spark.createDataFrame([(name, day, now or dt.datetime.now(), part)], WATERMARK_SCHEMA).coalesce(1) \
                .write.mode("append").parquet(f"{self.root}/watermarks")
            parts[day] = part
        return wanted

    def rows(self, tables: Tables, name: str, refs: Sequence[dt.date]) -> DataFrame:
        """For every reference date the newest state up to it and the facts after that. A date before the first state
        needs all facts up to it."""
        parts = self.watermarks(name) if name in self.compact else {}
        held, windows = set(), []
        for ref in sorted(refs):
            before = max((day for day in parts if day <= ref), default=None)
            if before is not None:
                held.add(before)
            since = None if before is None else before + DAY
            if before == ref:
                continue  # the state is of that very day
            if windows and windows[-1][0] == since:
                windows[-1] = (since, ref)  # dates of one month share their days
            else:
                windows.append((since, ref))
        if not held:
            return tables.get(name, until=max(refs))
        state = self._partition(name, parts, sorted(held))
        if not windows:
            return state
        return tables.get(name, windows=windows).select(*state.columns).unionByName(state)
