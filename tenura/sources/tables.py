"""Typed access to the domain tables.

Keys are normalised once, here, so that every operator joins on plain equality.
The date bounds an operator needs are passed down to the reader, which turns
them into a filter on the stored column: they reach the Parquet scan (or prune
date partitions) whatever the logical date is derived from.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tenura.functions.scalars import parse_score_timestamp

SCHEMAS: dict[str, str] = {
    "accounts": "environment string, account_code string, account_id string, name string, "
    "is_anonymized boolean, sector_code string, account_classification_code string, is_accountant string",
    "users": "user_id string, account_id string",
    "activity_daily": "environment string, account_code string, account_id string, user_id string, "
    "division_code string, activity_id int, date date, quantity bigint",
    "activity_daily_contracts": "environment string, account_code string, account_id string, "
    "package_code string, event_type string, number_of_users int, number_of_administrations int, "
    "accountant_or_linked boolean, mrr decimal(18,2), date date",
    "package_classification": "environment string, package_code string, product string, "
    "edition string, solution string",
    "accounts_contract_summary": "environment string, account_code string, had_comm_contract int, "
    "first_comm_start_date date, latest_comm_final_date date, first_trial_start_date date, "
    "latest_trial_final_date date, full_cancellation_request_date date",
    "contracts": "environment string, account_code string, package_code string, event_date date, "
    "event_type string, item_type string, inflow_outflow string",
    "divisions": "environment string, division_code string, account_id string, deleted date, "
    "blocking_status_code int, division_created date",
    "division_statistics_daily": "environment string, division_code string, date date, "
    "abnamro_bank_accounts int, ing_bank_accounts int, rabo_bank_accounts int, automatic_bank_link int, "
    "currency_count int, quote_count bigint, customer_count bigint, supplier_count bigint, "
    "sales_invoice_count bigint, stock_count_entry_count bigint, sales_order_entry_count bigint, "
    "purchase_order_entry_count bigint, delivery_entry_count bigint, item_count bigint, "
    "sales_price_list_count bigint",
    "division_statistics_daily_changes": "environment string, division_code string, date date, "
    "gl_transactions_count bigint, bank_transactions bigint, bank_entry_count bigint, "
    "cash_entry_count bigint, sales_invoice_count bigint, purchase_entry_count bigint, "
    "stock_count_entry_count bigint, sales_entry_count bigint, general_journal_entry_count bigint, "
    "account_count bigint, project_total_time_entries bigint, project_total_cost_entries bigint, "
    "project_type_fixed_price bigint, project_type_time_and_material bigint, "
    "project_type_non_billable bigint, project_type_prepaid_retainer bigint, "
    "project_type_prepaid_htb bigint",
    "division_statistics_summary": "environment string, division_code string, sales_invoice_first_date date",
    "divisions_master_data_setup": "environment string, division_code string, account_id string, "
    "master_data_setup_type string, master_data_setup_status string, event_start_time timestamp",
    "health_score": "environment string, account_code string, package_code string, health_score int, "
    "reference_date date, predict_date timestamp, phase string",
    "is_usage_score": "environment string, account_code string, package_code string, score int, "
    "reference_date date, predict_date timestamp, phase string",
}

KEY_COLUMNS = {
    "environment", "account_code", "account_id", "user_id", "division_code", "package_code",
    "event_type", "item_type", "inflow_outflow", "phase",
}
LABEL_COLUMNS = {"product"}
TEXT_COLUMNS = {"sector_code", "account_classification_code", "is_accountant", "edition", "solution",
                "master_data_setup_type", "master_data_setup_status"}

SYNONYMS = {"event_type": ("contracteventtypecode",), "is_anonymized": ("isanonymised",)}

# fixed values: directory of each table below a lake root
DIRECTORIES = {
    "accounts": "Accounts",
    "users": "Users",
    "activity_daily": "ActivityDaily",
    "activity_daily_contracts": "ActivityDaily_Contracts",
    "package_classification": "PackageClassification",
    "accounts_contract_summary": "AccountsContract_Summary",
    "contracts": "Contracts",
    "divisions": "Divisions",
    "division_statistics_daily": "DivisionStatistics_Daily",
    "division_statistics_daily_changes": "DivisionStatistics_DailyChanges",
    "division_statistics_summary": "DivisionStatistics_Summary",
    "divisions_master_data_setup": "Divisions_MasterDataSetup",
    "health_score": "HealthScore",
    "is_usage_score": "ISUsageScore",
}

#: Tables of published scores: none before the first run.
SCORES = ("health_score", "is_usage_score")

DATE_COLUMNS = {
    "activity_daily": "date",
    "activity_daily_contracts": "date",
    "contracts": "event_date",
    "division_statistics_daily": "date",
    "division_statistics_daily_changes": "date",
}

#: Keys of a cohort that may be sent to every executor.
COHORT_BYTES = 64 * 2 ** 20

# SQL predicates on the stored columns for [since, until], both ends included.
Bounds = Callable[[dt.date | None, dt.date | None], list[str]]


def column_names(table: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in SCHEMAS[table].replace("(18,2)", "").split(",")]


def column_type(table: str, column: str) -> str:
    for part in SCHEMAS[table].replace("(18,2)", "#").split(","):
        name, kind = part.strip().split(" ")
        if name == column:
            return kind.replace("#", "(18,2)")
    raise KeyError(column)


def spellings(name: str) -> list[str]:
    """Accepted stored names of a column: account_code, accountcode, and known synonyms."""
    return [name, name.replace("_", ""), *SYNONYMS.get(name, ())]


def stored_field(column: str, df: DataFrame):
    """The stored field of a domain column, under any accepted spelling."""
    present = {field.name.lower(): field for field in df.schema.fields}
    return next((present[s] for s in spellings(column) if s in present), None)


def normalised(table: str, df: DataFrame, clean: bool = False) -> DataFrame:
    """Schema order, declared types, one spelling per key (in a clean table they are as stored). Absent columns are NULL."""
    out = []
    for name in column_names(table):
        kind = column_type(table, name)
        field = stored_field(name, df)
        if field is None:
            text = f"CAST(NULL AS {kind})"
        elif field.dataType.simpleString() == kind:
            text = f"`{field.name}`"
        else:
            # bad text is NULL, also under ANSI rules; a number that does not fit is an error
            cast = "try_cast" if isinstance(field.dataType, StringType) else "cast"
            text = f"{cast}(`{field.name}` AS {kind})"
        if clean and field is not None and isinstance(field.dataType, StringType):
            pass
        elif name in KEY_COLUMNS:
            text = f"lower(trim({text}))"
        elif name in LABEL_COLUMNS:
            text = f"lower(regexp_replace({text}, ' ', ''))"
        elif name in TEXT_COLUMNS:
            text = f"trim({text})"
        out.append(f"{text} AS {name}")
    return df.selectExpr(*out)


def _stored_bounds(table: str, df: DataFrame) -> Bounds:
    """A date kept as a timestamp: compare the timestamp itself, since a comparison
    of its cast would not reach the scan. A stored date needs nothing."""
    field = stored_field(DATE_COLUMNS[table], df) if table in DATE_COLUMNS else None
    if field is None or not field.dataType.simpleString().startswith("timestamp"):
        return lambda since, until: []
    literal = "TIMESTAMP_NTZ" if field.dataType.simpleString() == "timestamp_ntz" else "TIMESTAMP"

    def bounds(since: dt.date | None, until: dt.date | None) -> list[str]:
        out = []
        if since is not None:
            out.append(f"`{field.name}` >= {literal} '{since} 00:00:00'")
        if until is not None:
            out.append(f"`{field.name}` < {literal} '{until + dt.timedelta(days=1)} 00:00:00'")
        return out

    return bounds


def _folder_bounds(table: str, read: Callable[[], DataFrame]) -> Bounds:
    """Bounds of a table in folders year=/month=/day= of its date: whole folders are left out before any file is opened,
    and what the stored date itself can rule out inside them."""
    def bounds(since: dt.date | None, until: dt.date | None) -> list[str]:
        df = read()
        missing = {"year", "month", "day"} - {c.lower() for c in df.columns}
        if missing:
            raise ValueError(f"{table} does not lie in folders by {sorted(missing)}")
        sides = ((">=", since), ("<=", until))
        folders = [f"make_date(year, month, day) {sign} DATE '{day}'" for sign, day in sides if day is not None]
        return folders + _stored_bounds(table, df)(since, until)

    return bounds


@dataclass(frozen=True)
class Stored:
    """A stored frame, how date bounds translate to its own columns, and the
    projection that makes a domain table of it (applied after the bounds)."""

    read: Callable[[], DataFrame]
    bounds: Bounds | None = None
    project: Callable[[DataFrame], DataFrame] | None = None
    #: Keys and labels were normalised when the table was written: filters on them reach the scan.
    clean: bool = False


def _either(ranges: list[list[str]]) -> str:
    """SQL test that all predicates of one of the ranges hold; empty when a range is open at both ends."""
    if not all(ranges):
        return ""
    return " OR ".join(f"({' AND '.join(predicates)})" for predicates in ranges)


class Tables:
    """The domain tables of one data set.

    `cohort_bytes`: how large the keys of a cohort may be that are found first and sent to the fact scans; 0 sends none."""

    def __init__(self, spark: SparkSession, stored: Mapping[str, Stored], state=None, cohort_bytes: int = 0):
        unknown = set(stored) - set(SCHEMAS)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        self.spark = spark
        self._stored = dict(stored)
        self.state = state
        self.cohort_bytes = cohort_bytes

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        return cls(spark, {name: Stored(lambda df=df: df) for name, df in frames.items()})

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str, merge_schema: bool | Collection[str] = False,
                     paths: Mapping[str, str] | None = None, clean: bool | Collection[str] = False,
                     by_day: Collection[str] = ()) -> Tables:
        """One directory (or glob, through `paths`) per table below `root`, opened once. Schemas are merged for all
        tables or the named ones; `clean` says which tables were written with normalised keys, `by_day` which lie in
        folders year=/month=/day= of their date. A lake without published scores has an empty table of them."""
        def among(name: str, chosen: bool | Collection[str]) -> bool:
            return chosen if isinstance(chosen, bool) else name in chosen

        def reader(name: str) -> Stored:
            path = (paths or {}).get(name, f"{root}/{DIRECTORIES[name]}")
            merge = str(among(name, merge_schema)).lower()

            @cache
            def read() -> DataFrame:
                return read_or_empty(spark, path, name) if name in SCORES else \
                    spark.read.option("mergeSchema", merge).parquet(path)

            return Stored(read, _folder_bounds(name, read) if name in by_day else None, clean=among(name, clean))

        return cls(spark, {name: reader(name) for name in SCHEMAS})

    def with_table(self, name: str, df: DataFrame) -> Tables:
        return Tables(self.spark, {**self._stored, name: Stored(lambda: df)}, self.state, self.cohort_bytes)

    def with_stored(self, name: str, other: Tables) -> Tables:
        """The same tables, with one as another set stores it."""
        return Tables(self.spark, {**self._stored, name: other._stored[name]}, self.state, self.cohort_bytes)

    def with_catalog(self, names: Mapping[str, str], clean: bool = False) -> Tables:
        """The same tables, some of them read from catalog tables (domain name -> catalog name). `clean` says that these
        were written with normalised keys; only then do filters on keys reach them and buckets by keys hold."""
        unknown = set(names) - set(SCHEMAS)
        if unknown:
            raise ValueError(f"unknown tables: {sorted(unknown)}")
        found = {name: Stored(lambda table=table: self.spark.table(table), clean=clean) for name, table in names.items()}
        return Tables(self.spark, {**self._stored, **found}, self.state, self.cohort_bytes)

    def with_state(self, store) -> Tables:
        """The same tables, whose newest rows come from a tenura.sources.state.StateStore."""
        return Tables(self.spark, self._stored, store, self.cohort_bytes)

    def with_cohort_first(self, most_bytes: int = COHORT_BYTES) -> Tables:
        """The same tables, whose facts are read for the accounts of a cohort only, as long as its keys take at most so many bytes."""
        return Tables(self.spark, self._stored, self.state, most_bytes)

    def newest(self, name: str, refs: Sequence[dt.date]) -> DataFrame:
        """Rows that hold what is newest on each reference date: the whole history up to the last one, or, where a
        state is kept, the state before each date and the days since."""
        return self.get(name, until=max(refs)) if self.state is None else self.state.rows(self, name, refs)

    def get(self, name: str, since: dt.date | None = None, until: dt.date | None = None,
            windows: Sequence[tuple[dt.date, dt.date]] | None = None) -> DataFrame:
        """Rows of a table dated in [since, until], or in one of several such ranges; both ends
        included, None is open."""
        stored = self._stored[name]
        raw = stored.read()
        ranges = [(since, until)] if windows is None else list(windows)
        bounds = stored.bounds or _stored_bounds(name, raw)
        limits = _either([bounds(a, b) for a, b in ranges])
        if limits:
            raw = raw.where(limits)
        if stored.project:
            raw = stored.project(raw)
        df = normalised(name, raw, stored.clean)
        limits = _either([[f"{DATE_COLUMNS[name]} {sign} DATE '{day}'"
                           for sign, day in ((">=", a), ("<=", b)) if day is not None] for a, b in ranges])
        return df.where(limits) if limits else df

    def register_views(self, prefix: str = "") -> None:
        """Temporary views for parameterised SQL text."""
        for name in self._stored:
            self.get(name).createOrReplaceTempView(prefix + name)


def read_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The stored table, or one without rows where nothing was written yet. Any other failure is an error."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMAS[name])


def read_downgrade_score_csv(spark: SparkSession, path: str) -> DataFrame:
    """As read_health_score_csv, for the downgrade score."""
    raw = spark.read.csv(path, header=True)
    return raw.select(
        "environment", F.col("accountcode").alias("account_code"), F.col("packagecode").alias("package_code"),
        F.expr("try_cast(score AS int)").alias("score"), F.to_date(parse_score_timestamp("referencedate")).alias("reference_date"),
        parse_score_timestamp("predictdate").alias("predict_date"), "phase")


def read_health_score_csv(spark: SparkSession, path: str) -> DataFrame:
    """Published scores in CSV: header, all text, dates such as '10-24-19 09:30 AM'."""
    raw = spark.read.csv(path, header=True)  # by header name, every column text, no inference scan
    return raw.select(
        "environment", F.col("accountcode").alias("account_code"), F.col("packagecode").alias("package_code"),
        F.expr("try_cast(healthscore AS int)").alias("health_score"),
        F.to_date(parse_score_timestamp("referencedate")).alias("reference_date"),
        parse_score_timestamp("predictdate").alias("predict_date"), "phase")


def run_sql(spark: SparkSession, text: str, **params) -> DataFrame:
    """SQL text with named markers (:end_date, :window, :environment ...)."""
    return spark.sql(text, args=params)
