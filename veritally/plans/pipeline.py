"""The quarantine ETL: every raw row is staged or rejected with a reason, then reported.

Shares nothing with :mod:`veritally.plans.oracle`, which recomputes the same figures.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import cached_property

from pyspark.sql import DataFrame

from veritally.config import Config, Runs
from veritally.functions.expressions import NET, business_day, calendar_date, money, total, utc_timestamp
from veritally.operators.copies import keys_again, mark_copies
from veritally.operators.frames import aggregate, zero_if_null
from veritally.operators.members import mark_member
from veritally.sources.extract import Extract, copy_columns, valid_currencies

# Columns of the written tables.
QUARANTINE_COLUMNS = ["txn_id", "account_id", "txn_ts", "amount", "currency", "direction", "channel",
                      "status", "reject_reason"]
STAGING_COLUMNS = ["txn_id", "account_id", "branch_code", "branch_name", "ist_date", "direction",
                   "channel", "status", "currency", "amount", "inr_amount"]

BAD_AMOUNT = "(amt IS NULL OR amt <= 0)"


class Pipeline:
    """The stages of one or several runs; each row carries the name of its ``run``.

    A stage is built when it is first asked for. A job that has written one may set
    the attribute to the written table, and later stages start from there.
    """

    # The ids of ``ids_again``, where a job has written them.
    known_again: DataFrame | None = None

    def __init__(self, raw: Extract, cfg: Config, runs: Runs):
        self.raw, self.cfg, self.runs = raw, cfg, runs

    def ids_again(self) -> DataFrame:
        return keys_again(self.raw.transactions, "txn_id")

    @cached_property
    def checked(self) -> DataFrame:
        """Raw rows with typed values, copies marked, and the currency looked up."""
        raw, cfg = self.raw, self.cfg
        rows = raw.transactions.selectExpr("*", f"{utc_timestamp('txn_ts')} AS ts_utc")
        order = copy_columns("ts_utc", cfg.arrival)
        written = {} if self.known_again is None else {"again": self.known_again}
        rows = mark_copies(rows, "txn_id", order, **written).selectExpr("*", f"{money('amount')} AS amt")
        return mark_member(rows, "currency", valid_currencies(raw, cfg.base_currency), "currency", "currency_known")

    @property
    def _bad_time(self) -> str:
        return f"(ts_utc IS NULL OR ts_utc >= {self.cfg.cutoff})"

    @property
    def _report_day(self) -> str:
        on = self.runs.on
        return f"if({on('PIPE-03')}, CAST(ts_utc AS DATE), {business_day('ts_utc', self.cfg)})"

    @cached_property
    def account_marked(self) -> DataFrame:
        return mark_member(self.checked, "account_id", self.raw.accounts, "account_id", "account_known")

    @cached_property
    def classified(self) -> DataFrame:
        """Every raw row with its reason for rejection (NULL: accepted) and business day."""
        raw, on = self.raw, self.runs.on
        rows = self.account_marked
        reason = f"""CASE WHEN is_copy AND NOT {on('PIPE-01')} THEN 'DUPLICATE'
                          WHEN NOT currency_known THEN 'INVALID_CURRENCY'
                          WHEN {BAD_AMOUNT} THEN 'NON_POSITIVE_AMOUNT'
                          WHEN account_id IS NOT NULL AND NOT account_known THEN 'UNKNOWN_ACCOUNT'
                          WHEN {self._bad_time} THEN 'FUTURE_DATED' END AS reject_reason"""
        return self.runs.fan_out(rows).selectExpr(
            "run", *raw.transactions.columns, "amt", "ts_utc", "is_copy", reason, f"{self._report_day} AS ist_date")

    @cached_property
    def quarantine(self) -> DataFrame:
        return self.classified.where("reject_reason IS NOT NULL").select("run", *QUARANTINE_COLUMNS)

    @cached_property
    def accepted(self) -> DataFrame:
        """Valid rows, copies included, with account and branch: nothing here depends on a fault.

        The inner join to accounts is itself the account test, so no membership flag is needed.
        """
        branches = self.raw.branches.selectExpr("branch_code", "branch_name", "true AS branch_known")
        return (
            self.checked.where(f"currency_known AND NOT {BAD_AMOUNT} AND NOT {self._bad_time}")
            .select("txn_id", "account_id", "ts_utc", "direction", "channel", "status", "currency", "amt", "is_copy")
            .join(self.raw.accounts.select("account_id", "branch_code"), "account_id")
            .join(branches, "branch_code", "left")
        )

    @cached_property
    def staging(self) -> DataFrame:
        """Accepted rows of each run with business day and converted amount."""
        raw, on = self.raw, self.runs.on
        rows = self.runs.fan_out(self.accepted).where(
            f"(NOT is_copy OR {on('PIPE-01')}) AND (branch_known IS NOT NULL OR NOT {on('PIPE-04')})")
        priced_on = "ist_date"
        if on("PIPE-02") != "false":
            newest = raw.fx_rates.selectExpr(f"{calendar_date('max(rate_date)')} AS newest")
            rows = rows.withColumn("newest", newest.scalar())
            priced_on = f"if({on('PIPE-02')}, newest, ist_date)"
        rates = raw.fx_rates.selectExpr(
            "currency", f"{calendar_date('rate_date')} AS priced_on", "try_cast(inr_rate AS DECIMAL(12, 4)) AS rate")
        return (
            rows.selectExpr("*", f"{self._report_day} AS ist_date",
                            f"if({on('PIPE-06')}, CAST(floor(amt) AS DECIMAL(18, 2)), amt) AS amount")
            .selectExpr("*", f"{priced_on} AS priced_on")
            .join(rates, ["currency", "priced_on"], "left")
            .selectExpr(
                "run", *STAGING_COLUMNS[:-1],
                f"CAST(if(currency = '{self.cfg.base_currency}', amount, round(amount * rate, 2)) "
                "AS DECIMAL(28, 2)) AS inr_amount")
        )

    @property
    def _counted(self) -> DataFrame:
        return self.staging.where(f"status = 'SUCCESS' OR {self.runs.on('PIPE-05')}")

    @cached_property
    def daily(self) -> DataFrame:
        """Count, credits, debits and net per business day and branch."""
        return aggregate(
            self._counted, ["run", "ist_date AS report_date", "branch_code"],
            "count(*) AS txn_count", f"{total('CREDIT')} AS credit_inr", f"{total('DEBIT')} AS debit_inr",
            f"{NET} AS net_inr")

    @cached_property
    def accounts(self) -> DataFrame:
        """Opening balance of each account, and the ledger's closing one."""
        ledger = self.raw.closing_balances.selectExpr("account_id", f"{money('closing_balance')} AS source_closing")
        return self.raw.accounts.selectExpr("account_id", f"{money('opening_balance')} AS opening").join(ledger, "account_id", "left")

    @cached_property
    def account_runs(self) -> DataFrame:
        """Per account its opening and ledger balance, and credits and debits in ``of_runs``."""
        net = aggregate(self._counted, ["run", "account_id"],
                        f"{total('CREDIT')} AS credits", f"{total('DEBIT')} AS debits")
        return (
            self.runs.fan_out(self.accounts).join(net, ["run", "account_id"], "left")
            .selectExpr("run", "account_id", "opening", "source_closing", *zero_if_null("credits", "debits"))
            .selectExpr("account_id", "opening", "source_closing", "array(struct(run, credits, debits)) AS of_runs")
        )

    @cached_property
    def balances(self) -> DataFrame:
        """Opening, movements and computed closing per account, against the ledger."""
        return self.account_runs.selectExpr("account_id", "opening", "source_closing", "inline(of_runs)").selectExpr(
            "run", "account_id", "opening", "credits", "debits", "opening + credits - debits AS computed_closing", "source_closing",
            "source_closing - (opening + credits - debits) AS difference")

    # What the checks compare, per run.

    @cached_property
    def rejected(self) -> DataFrame:
        return aggregate(self.quarantine, ["run", "reject_reason AS reason"], "count(*) AS actual")

    @cached_property
    def loaded(self) -> DataFrame:
        return aggregate(self.staging, ["run"], "count(*) AS loaded")

    def id_loads(self) -> tuple[DataFrame, dict[str, str]]:
        """Rows with a ``txn_id``, and per run how often each is loaded."""
        return self.staging, {name: f"IF(run = '{name}', 1, 0)" for name in self.runs.faults}


def run(raw: Extract, cfg: Config, faults: Iterable[str] = ()) -> Pipeline:
    return Pipeline(raw, cfg, Runs.single(faults))
