"""The domain tables, derived column by column from the star-schema test data.

Every logical table is a projection of one stored table, written once as SQL
expressions both Spark and the checking database understand. customer rows are
accounts, events are activity, orders are contract events and published scores,
parts are divisions and lineitem rows are division statistics. Stored dates are
moved so that all tables overlap: orders and lineitem by a fixed number of days,
events are spread from 30 days over 450.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenura.sources.tables import Stored, Tables

REFERENCE_DATE = dt.date(2024, 1, 30)
SHIFT_DAYS = 8401  # 1995-01-01 -> 2018-01-01
SPREAD = 15  # one stored day of events covers this many days


def _environment(key: str) -> str:
    return f"CASE WHEN {key} % 3 = 0 THEN ' be' ELSE 'NL ' END"


def _code(prefix: str, key: str) -> str:
    return f"'{prefix}' || CAST({key} AS STRING) || ' '"


def _whole(expression: str, kind: str = "BIGINT") -> str:
    return f"CAST(FLOOR({expression}) AS {kind})"


def _tier(price: str) -> str:
    return f"CASE WHEN {price} < 150000 THEN '-s' WHEN {price} < 300000 THEN '-M' ELSE '-L' END"


def _shifted(column: str) -> str:
    return f"CAST({column} AS DATE) + {SHIFT_DAYS}"


@dataclass(frozen=True)
class Mapping:
    source: str
    columns: dict[str, str]
    unnest: tuple[str, ...] = ()  # values of a column "line" that repeats each stored row
    bound_column: str | None = None
    bound_kind: str = "shift"


_ACCOUNT_OF_EVENT = "user_id"
_USER_OF_EVENT = (f"CASE WHEN value >= 60 THEN {_whole('user_id / 5')} "
                  f"WHEN value >= 25 THEN {_whole('user_id / 3')} ELSE user_id END")
_ACTIVITY_DATE = (f"DATE '2024-01-30' - "
                  f"{_whole(f'((30 - day(ts)) * 24 + 23 - hour(ts)) * {SPREAD} / 24', 'INT')}")
_ACTIVITY_ID = """CAST(CASE event_type
    WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 8
    WHEN 'purchase' THEN CASE WHEN value < 10 THEN 5017 WHEN value < 20 THEN 5018 WHEN value < 30 THEN 5019
        WHEN value < 45 THEN 5003 WHEN value < 60 THEN 5005 WHEN value < 100 THEN 5004 ELSE 1 END
    ELSE CASE WHEN value < 5 THEN 5175 WHEN value < 10 THEN 5060 WHEN value < 15 THEN 5061
        WHEN value < 20 THEN 5062 WHEN value < 25 THEN 5058 WHEN value < 30 THEN 5173
        WHEN value < 35 THEN 5261 WHEN value < 40 THEN 5259 WHEN value < 50 THEN 5044
        WHEN value < 60 THEN 5045 WHEN value < 70 THEN 5046 WHEN value < 80 THEN 5056
        WHEN value < 90 THEN 5168 ELSE 9999 END END AS INT)"""
_ACCOUNT_OF_PART = _whole("p_partkey * 3 / 4")
_ACCOUNT_OF_LINE = _whole("l_partkey * 3 / 4")
_FIRST_START = f"DATE '2018-01-01' + {_whole('(c_acctbal + 1000) / 5', 'INT')}"
_SCORE_MONTH = f"CAST(date_trunc('month', {_shifted('o_orderdate')}) AS DATE)"

MAPPINGS: dict[str, Mapping] = {
    "accounts": Mapping("customer", {
        "environment": _environment("c_custkey"),
        "account_code": _code("A", "c_custkey"),
        "account_id": _code("ID-", "c_custkey"),
        "name": "CASE WHEN c_nationkey = 24 THEN NULL WHEN c_nationkey % 6 = 0 THEN c_name || ' Trading' "
                "WHEN c_nationkey % 6 = 1 THEN 'Groothandel ' || c_name ELSE c_name END",
        "is_anonymized": "c_acctbal < 0",
        "sector_code": "CASE c_mktsegment WHEN 'HOUSEHOLD' THEN NULL WHEN 'AUTOMOBILE' THEN 'G' ELSE 'M' END",
        "account_classification_code":
            "CASE WHEN c_nationkey < 4 THEN 'EOL' WHEN c_nationkey < 8 THEN 'ACC' WHEN c_nationkey < 12 THEN 'AC1' "
            "WHEN c_nationkey < 15 THEN 'AC7' WHEN c_nationkey < 18 THEN 'AC8' WHEN c_nationkey < 21 THEN 'JBO' "
            "WHEN c_nationkey < 23 THEN 'EO1' ELSE 'KPN' END",
        "is_accountant": "CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 'Accountant' ELSE 'Company' END",
    }),
    "users": Mapping("customer", {
        "user_id": _code("U-", "c_custkey"),
        "account_id": _code("ID-", "c_custkey"),
    }),
    "activity_daily": Mapping("events", {
        "environment": _environment(_ACCOUNT_OF_EVENT),
        "account_code": _code("A", _ACCOUNT_OF_EVENT),
        "account_id": _code("ID-", _ACCOUNT_OF_EVENT),
        "user_id": _code("u-", _USER_OF_EVENT),
        "division_code": _code("D", f"(user_id * 10 + {_whole('value')} % 4)"),
        "activity_id": _ACTIVITY_ID,
        "date": _ACTIVITY_DATE,
        "quantity": f"{_whole('value')} + 1",
    }, bound_column="ts", bound_kind="spread"),
    "activity_daily_contracts": Mapping("orders", {
        "environment": _environment("o_custkey"),
        "account_code": _code("A", "o_custkey"),
        "account_id": _code("ID-", "o_custkey"),
        "package_code": f"o_orderpriority || {_tier('o_totalprice')}",
        "event_type": "CASE o_orderstatus WHEN 'P' THEN 'CUP' WHEN 'F' THEN 'CDN' ELSE 'CNW' END",
        "number_of_users": _whole("o_totalprice / 50000", "INT"),
        "number_of_administrations": _whole("o_totalprice / 90000", "INT"),
        "accountant_or_linked": "o_totalprice > 250000",
        "mrr": "CAST(o_totalprice AS DECIMAL(18,2))",
        "date": _shifted("o_orderdate"),
    }, bound_column="o_orderdate"),
    "accounts_contract_summary": Mapping("customer", {
        "environment": _environment("c_custkey"),
        "account_code": _code("A", "c_custkey"),
        "had_comm_contract": "CASE WHEN c_nationkey = 5 THEN 0 ELSE 1 END",
        "first_comm_start_date": _FIRST_START,
        "latest_comm_final_date": "DATE '2022-12-01' + CAST((c_custkey * 7919) % 900 AS INT)",
        "first_trial_start_date":
            f"CASE WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN {_FIRST_START} - 30 END",
        "latest_trial_final_date":
            f"CASE c_mktsegment WHEN 'FURNITURE' THEN {_FIRST_START} - CAST(c_custkey % 4 AS INT) "
            f"WHEN 'HOUSEHOLD' THEN {_FIRST_START} + 3 END",
        "full_cancellation_request_date":
            "CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2023-01-01' + CAST((c_custkey * 7919) % 600 AS INT) END",
    }),
    "contracts": Mapping("orders", {
        "environment": _environment("o_custkey"),
        "account_code": _code("A", "o_custkey"),
        "package_code": "CASE WHEN line = 'Inflow' AND o_orderstatus = 'F' AND o_totalprice < 400000 "
                        f"THEN '1-URGENT' ELSE o_orderpriority END || {_tier('o_totalprice')}",
        "event_date": _shifted("o_orderdate"),
        "event_type": "CASE o_orderstatus WHEN 'P' THEN 'CUP' WHEN 'F' THEN 'CDN' ELSE 'CNW' END",
        "item_type": "CASE WHEN o_totalprice > 490000 THEN 'Module' ELSE 'Package' END",
        "inflow_outflow": "line",
    }, unnest=("Inflow", "Outflow"), bound_column="o_orderdate"),
    "divisions": Mapping("part", {
        "environment": _environment(_ACCOUNT_OF_PART),
        "division_code": _code("P", "p_partkey"),
        "account_id": _code("ID-", _ACCOUNT_OF_PART),
        "deleted": "CASE WHEN p_size = 10 THEN DATE '2024-01-30' WHEN p_size = 11 THEN DATE '2023-06-15' END",
        "blocking_status_code": "CASE WHEN p_size = 50 THEN 100 WHEN p_size = 49 THEN 99 ELSE 0 END",
        "division_created": "DATE '2018-01-01' + p_size * 40",
    }),
    "division_statistics_daily": Mapping("lineitem", {
        "environment": _environment(_ACCOUNT_OF_LINE),
        "division_code": _code("P", "l_partkey"),
        "date": _shifted("l_shipdate"),
        "abnamro_bank_accounts": "CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 1 ELSE 0 END",
        "ing_bank_accounts": "CASE WHEN l_returnflag = 'R' AND l_linenumber > 4 THEN 2 ELSE 0 END",
        "rabo_bank_accounts": "CASE WHEN l_tax > 0.06 THEN 1 ELSE 0 END",
        "automatic_bank_link": "CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END",
        "currency_count": "l_linenumber - 1",
        "quote_count": "CASE WHEN l_discount > 0.08 THEN NULL ELSE CAST(l_quantity AS BIGINT) END",
        "customer_count": _whole("l_extendedprice / 1000"),
        "supplier_count": "l_suppkey % 50",
        "sales_invoice_count": "CAST(l_quantity AS BIGINT) * 2",
        "stock_count_entry_count": "CAST(l_linenumber AS BIGINT)",
        "sales_order_entry_count": _whole("l_extendedprice / 500"),
        "purchase_order_entry_count": "CAST(ROUND(l_tax * 100) AS BIGINT)",
        "delivery_entry_count": "l_orderkey % 20",
        "item_count": "l_orderkey % 31",
        "sales_price_list_count": "CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_linenumber AS BIGINT) * 3 END",
    }, bound_column="l_shipdate"),
    "division_statistics_daily_changes": Mapping("lineitem", {
        "environment": _environment(_ACCOUNT_OF_LINE),
        "division_code": _code("P", "l_partkey"),
        "date": _shifted("l_shipdate"),
        "gl_transactions_count": "CAST(l_quantity AS BIGINT) * 3 - 20",
        "bank_transactions": "CAST(l_quantity AS BIGINT)",
        "bank_entry_count": "CAST(l_quantity AS BIGINT) + 5",
        "cash_entry_count": "CAST(l_linenumber AS BIGINT) - 2",
        "sales_invoice_count": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_linenumber AS BIGINT) END",
        "purchase_entry_count": "l_suppkey % 70",
        "stock_count_entry_count": "l_orderkey % 3 - 1",
        "sales_entry_count": _whole("l_extendedprice / 700"),
        "general_journal_entry_count": "CAST(ROUND(l_discount * 100) AS BIGINT)",
        "account_count": "l_orderkey % 17",
        "project_total_time_entries": "CASE WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_quantity AS BIGINT) - 10 END",
        "project_total_cost_entries": "CAST(ROUND(l_tax * 100) AS BIGINT)",
        "project_type_fixed_price": "l_orderkey % 5 - 2",
        "project_type_time_and_material": "CAST(l_linenumber AS BIGINT)",
        "project_type_non_billable": "CASE WHEN l_returnflag = 'A' THEN CAST(1 AS BIGINT) END",
        "project_type_prepaid_retainer": "l_suppkey % 2",
        "project_type_prepaid_htb": "CASE WHEN l_linenumber = 7 THEN CAST(2 AS BIGINT) ELSE CAST(-1 AS BIGINT) END",
    }, bound_column="l_shipdate"),
    "division_statistics_summary": Mapping("part", {
        "environment": _environment(_ACCOUNT_OF_PART),
        "division_code": _code("P", "p_partkey"),
        "sales_invoice_first_date": "CASE WHEN p_type = 'PROMO' THEN NULL ELSE DATE '2022-01-01' + p_size * 30 END",
    }),
    "divisions_master_data_setup": Mapping("part", {
        "environment": _environment(_ACCOUNT_OF_PART),
        "division_code": _code("P", "p_partkey"),
        "account_id": _code("ID-", _ACCOUNT_OF_PART),
        "master_data_setup_type":
            "CASE p_type WHEN 'ECONOMY' THEN 'Conversion' WHEN 'LARGE' THEN 'AccountantTemplate' "
            "WHEN 'MEDIUM' THEN 'ExactTemplate' WHEN 'PROMO' THEN 'Demo' WHEN 'SMALL' THEN 'Manual' "
            "ELSE CASE WHEN p_size < 10 THEN NULL WHEN p_size < 20 THEN 'TemporaryDivision' "
            "WHEN p_size < 25 THEN 'Unlisted' WHEN p_size < 40 THEN 'XML/CSV_Import' ELSE 'Empty' END END",
        "master_data_setup_status": "CASE WHEN p_size > 5 THEN 'Done' ELSE 'Started' END",
        "event_start_time": "CAST(DATE '2018-01-01' + p_size * 40 AS TIMESTAMP)",
    }),
    "health_score": Mapping("orders", {
        "environment": _environment("o_custkey"),
        "account_code": _code("A", "o_custkey"),
        "package_code": f"o_orderpriority || {_tier('o_totalprice')}",
        "health_score": f"CAST({_whole('o_totalprice')} % 101 AS INT)",
        "reference_date": _SCORE_MONTH,
        "predict_date": f"CAST({_SCORE_MONTH} + 1 AS TIMESTAMP)",
        "phase": "CASE o_orderstatus WHEN 'O' THEN 'Established' ELSE 'All ' END",
    }, bound_column=None),
    "is_usage_score": Mapping("orders", {
        "environment": _environment("o_custkey"),
        "account_code": _code("A", "o_custkey"),
        "package_code": f"o_orderpriority || {_tier('o_totalprice')}",
        "score": f"CAST({_whole('o_totalprice / 7')} % 101 AS INT)",
        "reference_date": _SCORE_MONTH,
        "predict_date": f"CAST({_SCORE_MONTH} + 1 AS TIMESTAMP)",
        "phase": "CASE o_orderstatus WHEN 'O' THEN 'Established' ELSE 'All ' END",
    }),
}

# Stored schemas of the tables used, so that reading needs no footer scan.
SOURCES = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# (priority, product) and (tier, edition, solution) of the package dimension
PRODUCTS = (
    ("1-URGENT", "Accounting"),
    ("2-HIGH", "Accountancy"),
    ("3-MEDIUM", "Manufacturing"),
    ("4-NOT SPECIFIED", "Professional services"),
    ("5-LOW", "Wholesale distribution"),
)
TIERS = (("-S", "'Basic'", "'Starter'"), ("-M", "'Advanced'", "'Core'"), ("-L", "NULL", "NULL"))
ENVIRONMENTS = ("NL", "BE")


def classification_sql() -> str:
    rows = ", ".join(
        f"('{environment}', '{priority}{tier}', '{product}', {edition}, {solution})"
        for environment in ENVIRONMENTS
        for priority, product in PRODUCTS
        for tier, edition, solution in TIERS)
    return (f"SELECT * FROM (VALUES {rows}) AS v(environment, package_code, product, edition, solution)")


def _bounds(mapping: Mapping):
    """Translate logical date bounds to the stored column, as pushable comparisons."""
    column = mapping.bound_column
    if column is None:
        return None

    def instant(day: dt.date, hours: int = 0) -> str:
        moment = dt.datetime.combine(day, dt.time()) + dt.timedelta(hours=hours)
        return f"TIMESTAMP_NTZ '{moment}'"

    def shift(since, until) -> list[str]:
        out = []
        if since is not None:
            out.append(f"{column} >= {instant(since - dt.timedelta(days=SHIFT_DAYS))}")
        if until is not None:
            out.append(f"{column} < {instant(until - dt.timedelta(days=SHIFT_DAYS - 1))}")
        return out

    def spread(since, until) -> list[str]:
        # one logical day is 24 / SPREAD stored hours; widened by two hours, the date filter is exact
        out = []
        if since is not None:
            hours = (REFERENCE_DATE - since).days * 24 // SPREAD + 24 // SPREAD + 3
            out.append(f"{column} >= {instant(REFERENCE_DATE, 24 - hours)}")
        if until is not None:
            hours = (REFERENCE_DATE - until).days * 24 // SPREAD - 2
            out.append(f"{column} < {instant(REFERENCE_DATE, 24 - hours)}")
        return out

    return shift if mapping.bound_kind == "shift" else spread


def star_schema_tables(spark: SparkSession, sf_dir: str) -> Tables:
    sources: dict[str, DataFrame] = {}

    def source(name: str) -> DataFrame:
        if name not in sources:
            sources[name] = spark.read.schema(SOURCES[name]).parquet(f"{sf_dir}/{name}.parquet")
        return sources[name]

    def stored(mapping: Mapping) -> Stored:
        def read() -> DataFrame:
            df = source(mapping.source)
            if mapping.unnest:
                values = ", ".join(f"'{v}'" for v in mapping.unnest)
                df = df.selectExpr("*", f"explode(array({values})) AS line")
            return df

        projection = [f"{expression} AS {name}" for name, expression in mapping.columns.items()]
        return Stored(read, _bounds(mapping), lambda df: df.selectExpr(*projection))

    tables = {name: stored(mapping) for name, mapping in MAPPINGS.items()}
    tables["package_classification"] = Stored(lambda: spark.sql(classification_sql()))
    return Tables(spark, tables)
