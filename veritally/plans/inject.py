"""Plant known defects in a clean extract and say which keys carry them.

Keys are picked by the number in the id, so every task decides alone and any
engine picks the same ones. Bad transactions are extra rows with ids of their own:
the ledger of the clean rows stays right.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from veritally.config import Config
from veritally.functions.expressions import iso_utc, money_text, quoted, rotate, zero_padded
from veritally.operators.frames import stacked
from veritally.sources.extract import COLUMNS, Extract

# The rule each defect breaks.
DEFECT_RULES = {
    "DQ-01": "UNQ-01", "DQ-02": "CMP-01", "DQ-03": "VAL-01", "DQ-04": "VAL-02",
    "DQ-05": "INT-01", "DQ-06": "TML-01", "DQ-07": "VAL-03", "DQ-08": "VAL-04",
    "DQ-09": "CON-01", "DQ-10": "CON-02", "DQ-11": "CON-03", "DQ-12": "INT-02",
}
# Rows that come with the source and break a rule without being planted.
NATURAL_RULES = {"NAT-01": "VAL-02", "NAT-02": "TML-01"}
# One in so many keys carries the defect: those with ``key % modulus == remainder``.
PICKS = {
    "DQ-01": (97, 5), "DQ-02": (25, 1), "DQ-03": (101, 7), "DQ-04": (211, 11),
    "DQ-05": (251, 13), "DQ-06": (307, 17), "DQ-07": (40, 3), "DQ-08": (50, 7),
    "DQ-09": (31, 6), "DQ-10": (37, 8), "DQ-11": (17, 4), "DQ-12": (29, 9),
}
BAD_CURRENCIES = ["INRR", "usd", "", "RS", "XYZ"]


@dataclass(frozen=True)
class Defects:
    """What the planted values look like."""

    incident_utc: str = "2024-01-11 05:15:00"
    incident_seconds: int = 7200
    late_hours: int = 240
    minor_born: str = "2009-06-15"  # and up to ``minor_days`` later
    minor_days: int = 300
    unknown_branch: str = "BR9999"
    # SQL texts over the customer's number ``n``, taken in turn.
    bad_emails: tuple[str, ...] = (
        "concat('user', n, '@')", "concat('user', n, '.example.com')", "concat('user ', n, '@example.com')",
        "concat('user', n, '@@example.com')")
    bad_phones: tuple[str, ...] = ("12345", "+917012345678", "70123-45678", "seven zero", "5012345678")
    # A ledger is off by one to seven times this, up or down, but never below zero.
    ledger_shift: str = "12.34"
    picks: dict[str, tuple[int, int]] = field(default_factory=lambda: dict(PICKS))

    def picked(self, defect: str, number: str = "n") -> str:
        modulus, remainder = self.picks[defect]
        return f"{number} % {modulus} = {remainder}"

    def turn(self, defect: str, number: str = "n") -> str:
        """How many carriers of the defect come before this one."""
        return f"({number} div {self.picks[defect][0]})"


def key_number(text: str) -> str:
    return f"CAST(regexp_extract({text}, '[0-9]+$', 0) AS BIGINT)"


def bad_transactions(clean: DataFrame, spec: Defects, cfg: Config) -> DataFrame:
    """Clean rows plus the planted ones, each row with its ``defect_id`` (NULL: clean).

    One scan: a row is repeated for every defect it seeds, then changed in place.
    """
    seeds = {"'clean'": "true", "'DQ-01'": f"{spec.picked('DQ-01')} AND status = 'SUCCESS'"}
    seeds |= {f"'{d}'": spec.picked(d) for d in ("DQ-03", "DQ-04", "DQ-05", "DQ-06")}
    seeded = ", ".join(f"if({test}, {defect}, NULL)" for defect, test in seeds.items())
    rows = (
        clean.selectExpr("*", f"{key_number('txn_id')} AS n")
        .selectExpr("*", f"explode(array({seeded})) AS seed")
        .where("seed IS NOT NULL")
    )
    extra = "seed NOT IN ('clean', 'DQ-01')"
    code = rotate(BAD_CURRENCIES, spec.turn("DQ-03"))
    incident = f"TIMESTAMP_NTZ'{spec.incident_utc}' + make_dt_interval(0, 0, 0, n % {spec.incident_seconds})"
    late = f"TIMESTAMP_NTZ'{cfg.cutoff_utc}' + make_dt_interval(0, CAST(1 + n % {spec.late_hours} AS INT))"
    changed = {
        "txn_id": f"if({extra}, concat('X', right(seed, 2), {zero_padded('n', 8)}), txn_id)",
        "account_id": f"if(seed = 'DQ-05', concat('ACC-9', {zero_padded('n % 100000', 5)}), account_id)",
        "txn_ts": f"CASE seed WHEN 'DQ-03' THEN {iso_utc(incident)} WHEN 'DQ-06' THEN {iso_utc(late)} ELSE txn_ts END",
        "amount": "CASE WHEN seed <> 'DQ-04' THEN amount WHEN n % 2 = 0 THEN '0.00' ELSE concat('-', amount) END",
        "currency": f"CASE WHEN seed = 'DQ-03' THEN nullif({code}, '') WHEN {extra} THEN 'INR' ELSE currency END",
        "status": f"if({extra}, 'SUCCESS', status)",
    }
    return rows.selectExpr(
        "nullif(seed, 'clean') AS defect_id",
        *[f"{changed.get(c, c)} AS {c}" for c in COLUMNS["transactions"]],
    )


def _replaced(columns: list[str], changed: dict[str, str], carried: dict[str, str]) -> list[str]:
    tests = ", ".join(f"if({test}, '{defect}', NULL)" for defect, test in carried.items())
    return [f"{changed.get(c, c)} AS {c}" for c in columns] + [f"array_compact(array({tests})) AS defects"]


def bad_customers(clean: DataFrame, accounts: DataFrame, spec: Defects) -> DataFrame:
    """Customers with planted values and the ``defects`` each one carries."""
    holders = accounts.where("account_type = 'CURRENT'").select("customer_id").distinct()
    rows = clean.join(holders.selectExpr("*", "true AS holder"), "customer_id", "left")
    picked = spec.picked
    lacks, slot = picked("DQ-02"), f"{spec.turn('DQ-02')} % 3"
    minor = f"{picked('DQ-11')} AND holder IS NOT NULL AND NOT {lacks}"
    turn = f"CAST({spec.turn('DQ-07')} % {len(spec.bad_emails)} AS INT)"
    email = f"element_at(array({', '.join(spec.bad_emails)}), {turn} + 1)"
    phone = rotate(list(spec.bad_phones), spec.turn("DQ-08"))
    born = f"CAST(date_add(DATE'{spec.minor_born}', CAST(n % {spec.minor_days} AS INT)) AS STRING)"
    changed = {
        "email": f"CASE WHEN {picked('DQ-07')} THEN {email} WHEN {lacks} AND {slot} = 0 THEN NULL ELSE email END",
        "phone": f"CASE WHEN {picked('DQ-08')} THEN {phone} WHEN {lacks} AND {slot} = 1 THEN NULL ELSE phone END",
        "kyc_status": f"if({lacks} AND {slot} = 2, NULL, kyc_status)",
        "date_of_birth": f"if({minor}, {born}, date_of_birth)",
    }
    carried = {"DQ-02": lacks, "DQ-07": picked("DQ-07"), "DQ-08": picked("DQ-08"), "DQ-11": minor}
    numbered = rows.selectExpr("*", f"{key_number('customer_id')} AS n")
    return numbered.selectExpr(*_replaced(clean.columns, changed, carried))


def bad_accounts(clean: DataFrame, transactions: DataFrame, spec: Defects) -> DataFrame:
    """Some accounts in use point to a branch nobody knows."""
    number = key_number("account_id")
    used = transactions.select("account_id").where(spec.picked("DQ-12", number)).distinct()
    rows = clean.join(used.selectExpr("*", "true AS in_use"), "account_id", "left")
    changed = {"branch_code": f"if(in_use, '{spec.unknown_branch}', branch_code)"}
    return rows.selectExpr(*_replaced(clean.columns, changed, {"DQ-12": "in_use"}))


def bad_closing(clean: DataFrame, accounts: DataFrame, spec: Defects) -> DataFrame:
    """Negative savings balances, and balances shifted up or down (never below zero)."""
    picked = spec.picked
    savings = accounts.where("account_type = 'SAVINGS'").select("account_id").distinct()
    rows = clean.join(savings.selectExpr("*", "true AS savings"), "account_id", "left")
    negative = f"{picked('DQ-09')} AND savings IS NOT NULL"
    shifted = f"{picked('DQ-10')} AND NOT {picked('DQ-09')}"
    closing, step = "CAST(closing_balance AS DECIMAL(18, 2))", f"CAST((1 + n % 7) * {spec.ledger_shift} AS DECIMAL(18, 2))"
    moved = f"IF({spec.turn('DQ-10')} % 2 = 1 AND {closing} >= {step}, {closing} - {step}, {closing} + {step})"
    changed = {"closing_balance": f"CASE WHEN {negative} THEN {money_text('-(n + 100)')} "
                                  f"WHEN {shifted} THEN {money_text(moved)} ELSE closing_balance END"}
    numbered = rows.selectExpr("*", f"{key_number('account_id')} AS n")
    return numbered.selectExpr(*_replaced(clean.columns, changed, {"DQ-09": negative, "DQ-10": shifted}))


class Planted:
    """A clean extract with defects: the ``dirty`` extract and its manifest.

    ``natural`` are transactions of the source that are no clean ones, each with its ``defects``.
    """

    def __init__(self, clean: Extract, cfg: Config, spec: Defects = Defects(), natural: DataFrame | None = None):
        self.natural = natural
        self.tagged = Extract(
            transactions=lambda: bad_transactions(clean.transactions, spec, cfg),
            customers=lambda: bad_customers(clean.customers, clean.accounts, spec),
            accounts=lambda: bad_accounts(clean.accounts, clean.transactions, spec),
            closing_balances=lambda: bad_closing(clean.closing_balances, clean.accounts, spec),
        )
        self.dirty = Extract(
            branches=lambda: clean.branches,
            fx_rates=lambda: clean.fx_rates,
            transactions=lambda: self._delivered(),
            customers=lambda: self.tagged.customers.drop("defects"),
            accounts=lambda: self.tagged.accounts.drop("defects"),
            closing_balances=lambda: self.tagged.closing_balances.drop("defects"),
        )

    def _delivered(self) -> DataFrame:
        rows = self.tagged.transactions.drop("defect_id")
        return rows if self.natural is None else rows.unionByName(self.natural.drop("defects"))

    def manifest(self) -> DataFrame:
        """One row (defect_id, rule_id, key) per planted or natural key."""
        planted = self.tagged.transactions.where("defect_id IS NOT NULL")
        parts = [planted.selectExpr("defect_id", "txn_id AS key")]
        for rows, key in ((self.tagged.customers, "customer_id"), (self.tagged.accounts, "account_id"),
                          (self.tagged.closing_balances, "account_id")):
            parts.append(rows.selectExpr("explode(defects) AS defect_id", f"{key} AS key"))
        if self.natural is not None:
            parts.append(self.natural.selectExpr("explode(defects) AS defect_id", "txn_id AS key"))
        rules = ", ".join(f"{quoted(d)}, {quoted(r)}" for d, r in (DEFECT_RULES | NATURAL_RULES).items())
        return stacked(parts).distinct().selectExpr("defect_id", f"map({rules})[defect_id] AS rule_id", "key")


def inject_defects(clean: Extract, cfg: Config, spec: Defects = Defects()) -> tuple[Extract, DataFrame]:
    planted = Planted(clean, cfg, spec)
    return planted.dirty, planted.manifest()
