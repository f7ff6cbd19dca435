"""The twelve quality rules. A finding is a row (rule_id, key)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from veritally.config import Config
from veritally.functions.expressions import blank, calendar_date, full_match, money, utc_timestamp
from veritally.operators.copies import repeated_keys
from veritally.operators.frames import aggregate, stacked
from veritally.operators.members import mark_member, orphans
from veritally.plans.oracle import expected_balances, valid_transactions
from veritally.sources.extract import Extract, valid_currencies

# Fixed values.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
PHONE = r"[6-9][0-9]{9}"
DIMENSIONS = ["Completeness", "Uniqueness", "Validity", "Integrity", "Timeliness", "Consistency"]


@dataclass(frozen=True)
class Rule:
    rule_id: str
    dimension: str
    table: str
    key: str
    description: str
    # Row rules test one row at a time and share one pass over their table ...
    failed: Callable[[Config], str] | None = None
    # ... possibly against one of these flags; the other rules bring a plan of their own.
    flag: str | None = None
    find: Callable[[Extract, Config, DataFrame | None], DataFrame] | None = None
    distinct: bool = False


def _late(cfg: Config) -> str:
    ts = utc_timestamp("txn_ts")
    return f"{ts} IS NULL OR {ts} >= {cfg.cutoff}"


def _repeated_ids(raw: Extract, cfg: Config, balances: DataFrame | None) -> DataFrame:
    return repeated_keys(raw.transactions, "txn_id")


def _unknown_branch(raw: Extract, cfg: Config, balances: DataFrame | None) -> DataFrame:
    return orphans(raw.accounts, "branch_code", raw.branches, "branch_code")


def _ledger(raw: Extract) -> DataFrame:
    return raw.closing_balances.selectExpr("account_id", f"{money('closing_balance')} AS closing")


def _overdrawn_savings(raw: Extract, cfg: Config, balances: DataFrame | None) -> DataFrame:
    savings = raw.accounts.where("account_type = 'SAVINGS'").select("account_id")
    return _ledger(raw).where("closing < 0").join(savings, "account_id")


def _wrong_closing(raw: Extract, cfg: Config, balances: DataFrame | None) -> DataFrame:
    if balances is None:
        balances = expected_balances(raw, valid_transactions(raw, cfg))
    expected = balances.select("account_id", "expected_closing")
    return _ledger(raw).join(expected, "account_id").where("closing <> expected_closing")


def _minor_with_current_account(raw: Extract, cfg: Config, balances: DataFrame | None) -> DataFrame:
    holders = raw.accounts.where("account_type = 'CURRENT'").select("customer_id").distinct()
    came_of_age = f"{cfg.as_of_date} - INTERVAL '{cfg.adult_years}' YEAR"
    minors = raw.customers.where(f"{calendar_date('date_of_birth')} > {came_of_age}")
    return minors.join(holders, "customer_id", "left_semi")


RULES = [
    Rule("UNQ-01", "Uniqueness", "transactions", "txn_id", "A transaction id occurs once",
         find=_repeated_ids),
    Rule("CMP-01", "Completeness", "customers", "customer_id", "Email, phone and KYC status are filled in",
         failed=lambda cfg: " OR ".join(map(blank, ["email", "phone", "kyc_status"]))),
    Rule("VAL-01", "Validity", "transactions", "txn_id", "The currency is the base currency or has a rate",
         failed=lambda cfg: "NOT currency_known", flag="currency_known", distinct=True),
    Rule("VAL-02", "Validity", "transactions", "txn_id", "The amount is a positive number",
         failed=lambda cfg: f"coalesce({money('amount')}, 0) <= 0", distinct=True),
    Rule("VAL-03", "Validity", "customers", "customer_id", "A given email has the form of an address",
         failed=lambda cfg: f"NOT {blank('email')} AND NOT {full_match('email', EMAIL)}"),
    Rule("VAL-04", "Validity", "customers", "customer_id", "A given phone is a ten-digit mobile number",
         failed=lambda cfg: f"NOT {blank('phone')} AND NOT {full_match('phone', PHONE)}"),
    Rule("INT-01", "Integrity", "transactions", "txn_id", "The account of a transaction exists",
         failed=lambda cfg: "account_id IS NOT NULL AND NOT account_known", flag="account_known", distinct=True),
    Rule("INT-02", "Integrity", "accounts", "account_id", "The branch of an account exists",
         find=_unknown_branch),
    Rule("TML-01", "Timeliness", "transactions", "txn_id", "A transaction is dated before the cutoff",
         failed=_late, distinct=True),
    Rule("CON-01", "Consistency", "accounts", "account_id", "A savings balance is not negative",
         find=_overdrawn_savings),
    Rule("CON-02", "Consistency", "accounts", "account_id", "Closing is opening plus credits minus debits",
         find=_wrong_closing),
    Rule("CON-03", "Consistency", "customers", "customer_id", "No minor holds a current account",
         find=_minor_with_current_account, distinct=True),
]
RULE_IDS = [r.rule_id for r in RULES]


def rule_table(spark: SparkSession) -> DataFrame:
    rows = [(r.rule_id, r.dimension, r.table, r.description) for r in RULES]
    return spark.createDataFrame(rows, "rule_id string, dimension string, `table` string, description string")


def findings(
    raw: Extract, cfg: Config, rule_ids: Iterable[str] = RULE_IDS, balances: DataFrame | None = None
) -> DataFrame:
    """(rule_id, key) of the chosen rules; row rules on one table share its scan.

    Transaction rules and CON-03 report a key once, the others once per bad row.
    CON-02 compares with ``balances``, the expected balances, where a job has them already.
    """
    wanted = [r for r in RULES if r.rule_id in set(rule_ids)]
    parts = []
    for rule in wanted:
        if rule.find:
            found = rule.find(raw, cfg, balances).selectExpr(f"'{rule.rule_id}' AS rule_id", f"{rule.key} AS key")
            parts.append(found.distinct() if rule.distinct else found)
    for table in ("transactions", "customers"):
        group = [r for r in wanted if r.failed and r.table == table]
        if group:
            found = _row_findings(raw, cfg, group)
            parts.append(found.distinct() if group[0].distinct else found)
    return stacked(parts)


def _row_findings(raw: Extract, cfg: Config, group: list[Rule]) -> DataFrame:
    rows, key = getattr(raw, group[0].table), group[0].key
    flags = {r.flag for r in group}
    if "currency_known" in flags:
        rows = mark_member(rows, "currency", valid_currencies(raw, cfg.base_currency), "currency", "currency_known")
    if "account_known" in flags:
        rows = mark_member(rows, "account_id", raw.accounts, "account_id", "account_known")
    if len(group) == 1:
        return rows.where(group[0].failed(cfg)).selectExpr(f"'{group[0].rule_id}' AS rule_id", f"{key} AS key")
    hits = ", ".join(f"if({r.failed(cfg)}, '{r.rule_id}', NULL)" for r in group)
    return rows.selectExpr(f"explode(array({hits})) AS rule_id", f"{key} AS key").where("rule_id IS NOT NULL")


def table_counts(raw: Extract, names: Iterable[str]) -> DataFrame:
    return stacked([
        aggregate(getattr(raw, name), [], "count(*) AS records").selectExpr(f"'{name}' AS table", "records")
        for name in names
    ])
