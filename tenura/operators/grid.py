"""Reference-date grid: many point-in-time snapshots in one pass over the facts.

`refs` is a short driver-side list of reference dates (four for training, one
for prediction). Facts are scanned once for all of them:

* look-back facts are tagged with every reference date whose window holds them,
* as-of facts are reduced by one conditional aggregate per reference date and
  unfolded after the aggregate, so the history itself is never multiplied.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Refs = Sequence[dt.date]
REF = "reference_date"
ACCOUNT = [REF, "environment", "account_code"]


def day(date: dt.date) -> str:
    return f"DATE '{date}'"


def look_back_windows(refs: Refs, days: int) -> list[tuple[dt.date, dt.date]]:
    """The days that the look-back windows need, as ranges in order; those that meet are one."""
    out: list[tuple[dt.date, dt.date]] = []
    for ref in sorted(refs):
        since = ref - dt.timedelta(days=days)
        if out and since <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], ref)
        else:
            out.append((since, ref))
    return out


def in_window(ref: dt.date, days: int, date: str = "date") -> str:
    """SQL test for [ref - days, ref], both ends included."""
    return f"{date} BETWEEN {day(ref - dt.timedelta(days=days))} AND {day(ref)}"


def _tagged(df: DataFrame, tests: dict[dt.date, str], disjoint: bool = False) -> DataFrame:
    """Rows once for each reference date whose test holds; where at most one can, without an array."""
    if len(tests) == 1:
        (ref, test), = tests.items()
        return df.where(test).withColumn(REF, F.lit(ref))
    if disjoint:
        branches = " ".join(f"WHEN {test} THEN {day(ref)}" for ref, test in tests.items())
        return df.selectExpr("*", f"CASE {branches} END AS {REF}").where(f"{REF} IS NOT NULL")
    hits = ", ".join(f"CASE WHEN {test} THEN {day(ref)} END" for ref, test in tests.items())
    return df.selectExpr("*", f"explode(array({hits})) AS {REF}").where(f"{REF} IS NOT NULL")


def in_look_back(df: DataFrame, refs: Refs, days: int, date: str = "date") -> DataFrame:
    """Rows dated in [ref - days, ref], once per reference date."""
    ordered = sorted(refs)
    apart = all((b - a).days > days for a, b in zip(ordered, ordered[1:]))
    return _tagged(df, {ref: in_window(ref, days, date) for ref in refs}, apart)


def in_horizon(df: DataFrame, ends: dict[dt.date, dt.date], date: str) -> DataFrame:
    """Rows dated in [ref, end of ref], once per reference date, both ends included."""
    return _tagged(df, {ref: f"{date} BETWEEN {day(ref)} AND {day(end)}" for ref, end in ends.items()})


def as_of_parts(refs: Refs, name: str, record: str, test: str = "true", date: str = "date") -> list[Column]:
    """Largest record between one reference date and the next, for as_of_latest.

    The stretches do not overlap, so a row is looked at once, however many
    reference dates follow it.
    """
    out = []
    ordered = sorted(refs)
    for i, ref in enumerate(refs):
        position = ordered.index(ref)
        after = f"{date} > {day(ordered[position - 1])} AND " if position else ""
        out.append(F.expr(f"max(CASE WHEN {after}{date} <= {day(ref)} AND {test} THEN {record} END) AS {name}_{i}"))
    return out


def as_of_latest(df: DataFrame, refs: Refs, *names: str) -> DataFrame:
    """Combine the stretches of as_of_parts: up to a reference date, the largest of
    all stretches that end by then."""
    if len(refs) == 1:
        return df
    columns = {}
    for name in names:
        for i, ref in enumerate(refs):
            parts = [f"{name}_{j}" for j, other in enumerate(refs) if other <= ref]
            if len(parts) > 1:
                columns[f"{name}_{i}"] = F.expr(f"greatest({', '.join(parts)})")
    return df.withColumns(columns)


def rows_of_days(rows: DataFrame, ends: DataFrame, keys: Sequence[str], days: Sequence[str]) -> DataFrame:
    """Rows dated on one of the days that `ends` has for their key, with its columns. `ends` is an aggregate of dates
    alone, which hashes, so that whole records are compared on few rows only. Rows without a key belong to nothing."""
    renamed = ends.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_{k}") for k in keys])
    return rows.join(renamed, same & F.expr(f"date IN ({', '.join(days)})")).drop(*[f"_{k}" for k in keys])


def with_records(ends: DataFrame, facts: DataFrame, keys: Sequence[str], refs: Refs, day_name: str, name: str,
                 fields: Sequence[str]) -> DataFrame:
    """Replaces the days day_name_0, ... of each key by the records of those days as structs name_0, ...

    A record starts with the date; of several records of one day the largest counts."""
    days = [f"{day_name}_{i}" for i in range(len(refs))]
    # by key alone, not by day as well: the few rows left come together as the tables around them do (or already lie), so
    # that what follows by key needs no further shuffle. The largest record of a day is where another day begins.
    largest = Window.partitionBy(*keys).orderBy(F.col("date").desc(), *[F.col(c).desc() for c in fields if c != "date"])
    newest = (rows_of_days(facts.select(*keys, *fields), ends, keys, days)
              .withColumn("_before", F.lag("date").over(largest)).where("NOT (_before <=> date)").drop("_before"))
    if len(days) == 1:
        return newest.withColumn(f"{name}_0", F.struct(*fields)).drop(*days, *fields)
    # one record a reference date
    packed = newest.groupBy(*ends.columns).agg(F.collect_list(F.struct(*fields)).alias("_records"))
    records = {f"{name}_{i}": F.expr(f"get(filter(_records, r -> r.date = {day}), 0)") for i, day in enumerate(days)}
    return packed.withColumns(records).drop(*days, "_records")


def unfold(df: DataFrame, refs: Refs, *names: str) -> DataFrame:
    """Turn columns name_0, name_1, ... into one row per reference date."""
    folded = {f"{name}_{i}" for name in names for i in range(len(refs))}
    rest = [c for c in df.columns if c not in folded]
    entries = ", ".join(
        "struct(" + ", ".join([f"{day(ref)} AS {REF}", *[f"{name}_{i} AS {name}" for name in names]]) + ")"
        for i, ref in enumerate(refs))
    if len(refs) == 1:
        return df.selectExpr(*rest, f"{day(refs[0])} AS {REF}", *[f"{name}_0 AS {name}" for name in names])
    return df.selectExpr(*rest, f"inline(array({entries}))")


def by_ref(refs: Refs, value: Callable[[dt.date], str]) -> str:
    """SQL literal that depends on the row's reference date."""
    if len(refs) == 1:
        return value(refs[0])
    return "CASE " + " ".join(f"WHEN {REF} = {day(ref)} THEN {value(ref)}" for ref in refs) + " END"


class LatestInt:
    """Value of an integer column on the latest day, as an aggregate on one long.

    Day and value are packed into a long whose order is (day, value), so `max`
    finds the latest day and, among rows of that day, the largest value. The buffer
    is a fixed-width number: the aggregate hashes and combines on the map side,
    where the maximum of a struct would have to sort the whole history first.
    """

    SPAN = 2 ** 34  # room for every int and for NULL, which is zero

    @classmethod
    def pack(cls, value: str, date: str = "date") -> str:
        return f"unix_date({date}) * {cls.SPAN}L + coalesce(CAST({value} AS BIGINT) + {2 ** 31 + 1}L, 0L)"

    @classmethod
    def day(cls, packed: str) -> str:
        return f"date_from_unix_date(CAST(floor({packed} / {cls.SPAN}L) AS INT))"

    @classmethod
    def unpack(cls, packed: str) -> str:
        return (f"CAST(CASE WHEN pmod({packed}, {cls.SPAN}L) > 0 "
                f"THEN pmod({packed}, {cls.SPAN}L) - {2 ** 31 + 1}L END AS INT)")


class DistinctDays:
    """Exact count of distinct days of a look-back window as a bit set.

    Each row sets the bit of its day; bit sets are merged with bit_or. The buffer
    is a few longs per group, so it combines on the map side, needs no second
    shuffle, and several conditions can be counted in one aggregate.
    """

    def __init__(self, name: str, days: int):
        self.columns = [f"_{name}_{word}" for word in range((days + 64) // 64)]

    def of_rows(self) -> list[Column]:
        """First aggregate, over rows that carry `date` and the reference date."""
        offset = f"datediff({REF}, date)"
        return [F.expr(f"bit_or(CASE WHEN {offset} BETWEEN {64 * word} AND {64 * word + 63} "
                       f"THEN shiftleft(1L, {offset} - {64 * word}) END) AS {column}")
                for word, column in enumerate(self.columns)]

    def merged(self, condition: str = "true", source: DistinctDays | None = None) -> list[Column]:
        """Second aggregate, over the bit sets of the first."""
        return [F.expr(f"bit_or(CASE WHEN {condition} THEN {stored} END) AS {column}")
                for column, stored in zip(self.columns, (source or self).columns)]

    def count(self) -> str:
        """Number of distinct days, zero when there was none."""
        return "(" + " + ".join(f"coalesce(bit_count({c}), 0)" for c in self.columns) + ")"
