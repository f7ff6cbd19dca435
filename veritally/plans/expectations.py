"""Column expectations: 22 checks of one column each, counted in one pass per table.

NULLs fail nothing but the not-null check. Every copy of a repeated value counts
as unexpected. The sample holds the three smallest unexpected values, copies included.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from veritally.config import Config
from veritally.functions.expressions import missing_to_null, number, number_text, quoted, utc_timestamp
from veritally.operators.copies import repeated_keys
from veritally.operators.frames import aggregate, stacked
from veritally.operators.members import mark_member
from veritally.operators.samples import first_n, in_place
from veritally.sources.extract import COLUMNS, Extract, valid_currencies

# The five kinds of expectation, patterns, code sets and amount bounds.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
MATCHES = "expect_column_values_to_match_regex"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
ACCOUNT_ID = r"^ACC-\d{6}$"
EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
PHONE = r"^[6-9]\d{9}$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
LEAST, MOST = "0.01D", "10000000D"


@dataclass(frozen=True)
class Expectation:
    suite: str
    kind: str
    column: str
    # True where a non-null value is unexpected; unused by the null and unique kinds.
    unexpected: Callable[[Config], str] | None = None
    # Text of an unexpected value, where the column itself is not text.
    shown: str | None = None

    def fails(self, cfg: Config) -> str:
        if self.kind == NOT_NULL:
            return f"{self.column} IS NULL"
        return f"{self.column} IS NOT NULL AND {self.unexpected(cfg)}"


def matches(suite: str, column: str, pattern: str) -> Expectation:
    return Expectation(suite, MATCHES, column, lambda cfg: f"NOT {column} RLIKE r'{pattern}'")


def in_set(suite: str, column: str, *values: str) -> Expectation:
    return Expectation(suite, IN_SET, column, lambda cfg: f"{column} NOT IN ({quoted(*values)})")


def in_table(suite: str, column: str) -> Expectation:
    return Expectation(suite, IN_SET, column, lambda cfg: f"NOT {column}_known")


EXPECTATIONS = [
    Expectation("transactions", NOT_NULL, "txn_id"),
    Expectation("transactions", UNIQUE, "txn_id"),
    matches("transactions", "account_id", ACCOUNT_ID),
    in_table("transactions", "currency"),
    Expectation("transactions", NOT_NULL, "currency"),
    Expectation("transactions", BETWEEN, "amount_num",
                lambda cfg: f"NOT amount_num BETWEEN {LEAST} AND {MOST}", number_text("amount_num")),
    in_set("transactions", "direction", "DEBIT", "CREDIT"),
    in_set("transactions", "status", "SUCCESS", "FAILED", "REVERSED"),
    in_set("transactions", "channel", "UPI", "IMPS", "NEFT", "ATM", "POS", "SWIFT"),
    Expectation("transactions", BETWEEN, "txn_ts_utc",
                lambda cfg: f"txn_ts_utc > {cfg.cutoff} - INTERVAL '1' SECOND",
                "date_format(txn_ts_utc, 'yyyy-MM-dd HH:mm:ss')"),
    Expectation("customers", UNIQUE, "customer_id"),
    Expectation("customers", NOT_NULL, "email"),
    Expectation("customers", NOT_NULL, "phone"),
    Expectation("customers", NOT_NULL, "kyc_status"),
    matches("customers", "email", EMAIL),
    matches("customers", "phone", PHONE),
    in_set("customers", "kyc_status", "VERIFIED", "PENDING"),
    matches("customers", "date_of_birth", ISO_DATE),
    Expectation("accounts", UNIQUE, "account_id"),
    in_set("accounts", "account_type", "SAVINGS", "CURRENT"),
    in_table("accounts", "branch_code"),
    in_set("accounts", "currency", "INR"),
]


def loaded(raw: Extract, suite: str) -> DataFrame:
    """A raw table as the expectations see it: NA-like texts are NULL, two typed columns."""
    rows = getattr(raw, suite)
    rows = rows.selectExpr(*[f"{missing_to_null(c)} AS {c}" for c in COLUMNS[suite] if c in rows.columns])
    if suite != "transactions":
        return rows
    return rows.selectExpr("*", f"{number('amount')} AS amount_num", f"{utc_timestamp('txn_ts')} AS txn_ts_utc")


def evaluate(raw: Extract, suite: str, cfg: Config) -> DataFrame:
    """One result row per expectation of the suite."""
    rows = loaded(raw, suite)
    flagged = rows
    if suite == "transactions":
        currencies = valid_currencies(raw, cfg.base_currency)
        flagged = mark_member(rows, "currency", currencies, "currency", "currency_known")
    elif suite == "accounts":
        flagged = mark_member(rows, "branch_code", raw.branches, "branch_code", "branch_code_known")
    chosen = list(enumerate(e for e in EXPECTATIONS if e.suite == suite))
    by_row = _unexpected_by_row(flagged, [(i, e) for i, e in chosen if e.kind != UNIQUE], cfg)
    unexpected = stacked([by_row] + [
        repeated_keys(rows.where(f"{e.column} IS NOT NULL"), e.column).selectExpr(f"{i} AS i", f"{e.column} AS value", "copies")
        for i, e in chosen if e.kind == UNIQUE])
    counts = aggregate(unexpected, ["i"], "sum(copies) AS unexpected")
    elements = aggregate(getattr(raw, suite), [], "count(*) AS n").scalar()
    names = ", ".join(f"struct({i} AS i, '{e.kind}' AS expectation, '{e.column}' AS column)" for i, e in chosen)
    every = rows.sparkSession.sql(f"SELECT inline(array({names}))")
    return (
        every.join(counts, "i", "left").join(_samples(unexpected), "i", "left")
        .withColumn("element_count", elements)
        .selectExpr("*", "coalesce(unexpected, 0L) AS unexpected_count")
        .selectExpr(f"'{suite}' AS suite", "expectation", "column", "unexpected_count = 0 AS success",
                    "unexpected_count", "element_count", "coalesce(sample, CAST(array() AS ARRAY<STRING>)) AS sample")
    )


def _unexpected_by_row(flagged: DataFrame, by_row: list[tuple[int, Expectation]], cfg: Config) -> DataFrame:
    """(i, value, copies): each unexpected value of each expectation.

    One pass; equal values are counted in the map tasks. Counts and samples both start from this shuffle.
    """
    tests = ", ".join(
        f"IF({e.fails(cfg)}, struct({i} AS i, CAST({'NULL' if e.kind == NOT_NULL else e.shown or e.column} AS STRING) AS value), NULL)"
        for i, e in by_row)
    each = flagged.selectExpr(f"explode(array_compact(array({tests}))) AS bad")
    return aggregate(each, ["bad.i AS i", "bad.value AS value"], "count(*) AS copies")


def _samples(unexpected: DataFrame) -> DataFrame:
    # NULL is left out after the window: a filter before it would be moved below the aggregates, which counts and samples share.
    top = first_n(unexpected, "i", "value NULLS LAST", 3).where("value IS NOT NULL")
    repeated = top.selectExpr("i", "place", "array_repeat(value, CAST(least(copies, 3) AS INT)) AS value")
    return aggregate(repeated, ["i"], f"slice(flatten({in_place('value')}), 1, 3) AS sample")


def evaluate_all(raw: Extract, cfg: Config) -> DataFrame:
    return stacked([evaluate(raw, suite, cfg) for suite in ("transactions", "customers", "accounts")])
