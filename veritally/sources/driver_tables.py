"""The banking extract, derived from the TPC-H-like tables by column expressions.

A customer is one customer with one account, an event is one transaction, a nation
is one branch. The clean extract leaves out events that are late or move no money; those reach the dirty
extract as they are, next to the defects that :mod:`veritally.plans.inject` adds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritally.config import Config
from veritally.functions.expressions import iso_utc, money_text, quoted, rotate, zero_padded
from veritally.operators.frames import aggregate
from veritally.sources.extract import Extract

CONFIG = Config(cutoff_utc="2024-01-30 18:30:00", as_of="2024-01-30")

# Rate on day 0 by currency, and the rise per day.
BASE_RATES = {"USD": "88.2000", "EUR": "102.6000", "GBP": "118.4000", "AED": "24.0100"}
DAILY_RISE = "0.0137"
FIRST_RATE_DAY, RATE_DAYS = "2024-01-01", 31
INLAND_CHANNELS = ["UPI", "IMPS", "NEFT", "ATM", "POS"]


# Column types, so that no footer is read while a plan is built.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def branches(nation: DataFrame) -> DataFrame:
    return nation.selectExpr(
        f"concat('BR', {zero_padded('n_nationkey', 4)}) AS branch_code",
        "n_name AS branch_name",
        "n_name AS city",
    )


def customers(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        f"concat('C', {zero_padded('c_custkey', 6)}) AS customer_id",
        "c_name AS full_name",
        "concat('user', c_custkey, '@example.com') AS email",
        f"concat('9', {zero_padded('c_custkey', 9)}) AS phone",
        "CAST(date_add(DATE'1970-01-01', CAST(c_custkey % 9000 AS INT)) AS STRING) AS date_of_birth",
        "concat('City ', c_nationkey) AS city",
        "if(c_custkey % 20 = 0, 'PENDING', 'VERIFIED') AS kyc_status",
        "'2023-12-01' AS created_at",
    )


def accounts(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        f"concat('ACC-', {zero_padded('c_custkey', 6)}) AS account_id",
        f"concat('C', {zero_padded('c_custkey', 6)}) AS customer_id",
        f"concat('BR', {zero_padded('c_nationkey', 4)}) AS branch_code",
        "if(c_mktsegment = 'BUILDING', 'CURRENT', 'SAVINGS') AS account_type",
        "'INR' AS currency",
        f"{money_text('CAST(abs(c_acctbal) AS DECIMAL(18, 2)) + 100000')} AS opening_balance",
        "'2023-12-01' AS opened_on",
        "'ACTIVE' AS status",
    )


def in_period(cfg: Config) -> str:
    """What makes an event a clean transaction."""
    return f"coalesce(ts < TIMESTAMP_NTZ'{cfg.cutoff_utc}' AND CAST(value AS DECIMAL(18, 2)) > 0, false)"


def transactions(events: DataFrame, *carried: str) -> DataFrame:
    amount = "CAST(value AS DECIMAL(18, 2))"
    foreign = "event_id % 33 = 2"
    paid_out = "event_id % 5 IN (3, 4) OR event_type IN ('purchase', 'error')"
    return events.selectExpr(
        f"concat('T', {zero_padded('event_id', 8)}) AS txn_id",
        f"concat('ACC-', {zero_padded('user_id', 6)}) AS account_id",
        f"{iso_utc('ts')} AS txn_ts",
        f"CAST({amount} AS STRING) AS amount",
        f"if({foreign}, {rotate(list(BASE_RATES), '(event_id div 33)')}, 'INR') AS currency",
        f"CASE WHEN {foreign} THEN 'CREDIT' WHEN {paid_out} THEN 'DEBIT' ELSE 'CREDIT' END AS direction",
        f"if({foreign}, 'SWIFT', {rotate(INLAND_CHANNELS, 'event_id')}) AS channel",
        "event_type AS counterparty",
        "CASE WHEN event_id % 25 = 0 THEN 'FAILED' WHEN event_id % 100 = 1 THEN 'REVERSED' "
        "ELSE 'SUCCESS' END AS status",
        *carried,
    )


def fx_rates(spark: SparkSession) -> DataFrame:
    rates = f"map_from_arrays(array({quoted(*BASE_RATES)}), array({', '.join(BASE_RATES.values())}))"
    return (
        spark.range(RATE_DAYS)
        .selectExpr("CAST(id AS INT) AS day", f"explode({rates}) AS (currency, base)")
        .selectExpr(
            f"CAST(date_add(DATE'{FIRST_RATE_DAY}', day) AS STRING) AS rate_date",
            "currency",
            f"CAST(CAST(base + (day + 1) * {DAILY_RISE} AS DECIMAL(12, 4)) AS STRING) AS inr_rate",
        )
    )


def closing_balances(clean: DataFrame, opened: DataFrame, rates: DataFrame, cfg: Config = CONFIG) -> DataFrame:
    """The bank's own ledger: opening plus the clean movements, one row per account."""
    moment = """to_timestamp_ntz(txn_ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")"""
    rupees = "if(currency = 'INR', amount, round(amount * CAST(inr_rate AS DECIMAL(12, 4)), 2))"
    priced = (
        clean.where("status = 'SUCCESS'")
        .selectExpr(
            "account_id", "direction", "currency", "CAST(amount AS DECIMAL(18, 2)) AS amount",
            f"CAST(CAST({moment} + INTERVAL '{cfg.offset_minutes}' MINUTE AS DATE) AS STRING) AS rate_date",
        )
        .join(rates, ["currency", "rate_date"], "left")
    )
    moved = aggregate(priced, ["account_id"], f"sum({rupees} * if(direction = 'CREDIT', 1, -1)) AS moved")
    closing = money_text("CAST(opening_balance AS DECIMAL(18, 2)) + coalesce(moved, 0)")
    return opened.join(moved, "account_id", "left").selectExpr(
        "account_id", f"'{cfg.as_of}' AS as_of", f"{closing} AS closing_balance")


def clean_extract(spark: SparkSession, sf_dir: str, cfg: Config = CONFIG) -> Extract:
    clean = Extract(
        branches=lambda: branches(table(spark, sf_dir, "nation")),
        customers=lambda: customers(table(spark, sf_dir, "customer")),
        accounts=lambda: accounts(table(spark, sf_dir, "customer")),
        transactions=lambda: transactions(table(spark, sf_dir, "events").where(in_period(cfg))),
        fx_rates=lambda: fx_rates(spark),
        closing_balances=lambda: closing_balances(clean.transactions, clean.accounts, clean.fx_rates, cfg),
    )
    return clean


def natural_transactions(spark: SparkSession, sf_dir: str, cfg: Config = CONFIG) -> DataFrame:
    """The events that the clean extract leaves out, each with the ``defects`` that keep it out.

    Told from the event's own time and value, not by the rules that are to find them.
    """
    out = table(spark, sf_dir, "events").where(f"NOT {in_period(cfg)}")
    late = f"ts IS NULL OR datediff(microsecond, TIMESTAMP_NTZ'{cfg.cutoff_utc}', ts) >= 0"
    # Half a hundredth and more is rounded to money.
    unpaid = "value IS NULL OR isnan(value) OR value < 0.005"
    tagged = out.selectExpr("*", f"array_compact(array(IF({unpaid}, 'NAT-01', NULL), IF({late}, 'NAT-02', NULL))) AS defects")
    return transactions(tagged, "defects")
