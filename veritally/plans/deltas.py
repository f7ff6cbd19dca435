"""All runs of a fault matrix from one row per transaction.

A fault changes which rows count, on which day, or at which amount, never the row itself. So a row
carries the few amounts that the runs tell apart, is summed once by everything that decides whether a run
counts it, and a run is a choice among these sums: rows are never multiplied by runs.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from veritally.functions.expressions import business_day, calendar_date
from veritally.operators.frames import aggregate, zero_if_null
from veritally.operators.members import mark_member
from veritally.plans.pipeline import BAD_AMOUNT, Pipeline


@dataclass(frozen=True)
class Amount:
    """How a run prices a row: at the rate of which day, and whether cut to whole units first."""

    priced_on: str
    cut: bool


def amount_of(faults: Iterable[str]) -> Amount:
    faults = set(faults)
    return Amount("newest" if "PIPE-02" in faults else day_of(faults), "PIPE-06" in faults)


def day_of(faults: Iterable[str]) -> str:
    return "utc_date" if "PIPE-03" in faults else "ist_date"


def loads(faults: Iterable[str]) -> str:
    """Whether a run loads an accepted row."""
    tests = [] if "PIPE-01" in faults else ["NOT is_copy"]
    tests += ["on_branch"] if "PIPE-04" in faults else []
    return " AND ".join(tests) or "true"


def counts(faults: Iterable[str]) -> str:
    return loads(faults) if "PIPE-05" in faults else f"{loads(faults)} AND paid"


class FaultMatrix(Pipeline):
    """The reports of several runs side by side; tables of single rows are those of :class:`Pipeline`."""

    @cached_property
    def amounts(self) -> list[Amount]:
        return list(dict.fromkeys(amount_of(f) for f in self.runs.faults.values()))

    @cached_property
    def valued(self) -> DataFrame:
        """Accepted rows with both days and, per way of pricing, their amount ``v`` and row count ``n``.

        A rate that is listed twice for a day counts the row twice, as the join in ``staging`` does.
        """
        raw, base = self.raw, self.cfg.base_currency
        newest = raw.fx_rates.selectExpr(f"{calendar_date('max(rate_date)')} AS newest")
        rows = self.accepted.selectExpr(
            "txn_id", "account_id", "branch_code", "branch_known IS NOT NULL AS on_branch", "is_copy", "direction", "currency", "amt",
            "coalesce(status = 'SUCCESS', false) AS paid", f"{business_day('ts_utc', self.cfg)} AS ist_date", "CAST(ts_utc AS DATE) AS utc_date")
        if any(a.priced_on == "newest" for a in self.amounts):
            rows = rows.withColumn("newest", newest.scalar())
        rates = aggregate(raw.fx_rates, ["currency", f"{calendar_date('rate_date')} AS day"],
                          "collect_list(struct(try_cast(inr_rate AS DECIMAL(12, 4)) AS rate)) AS rates")
        for day in dict.fromkeys(a.priced_on for a in self.amounts):
            rows = rows.join(rates.selectExpr("currency", f"day AS {day}", f"rates AS rates_{day}"), ["currency", day], "left")
        kept = ["txn_id", "account_id", "branch_code", "on_branch", "is_copy", "paid", "direction", "ist_date", "utc_date"]
        priced = []
        for i, a in enumerate(self.amounts):
            amt = "CAST(floor(amt) AS DECIMAL(18, 2))" if a.cut else "amt"
            listed = f"rates_{a.priced_on}"
            times = f"coalesce(size({listed}), 1)"
            exchanged = (f"aggregate({listed}, CAST(NULL AS DECIMAL(28, 2)), "
                         f"(s, x) -> IF(x.rate IS NULL, s, CAST(coalesce(s, 0) + round({amt} * x.rate, 2) AS DECIMAL(28, 2))))")
            priced += [f"CAST(IF(currency = '{base}', {amt} * {times}, {exchanged}) AS DECIMAL(28, 2)) AS v{i}", f"CAST({times} AS BIGINT) AS n{i}"]
        return rows.selectExpr(*kept, *priced)

    @property
    def _sums(self) -> list[str]:
        return [s for i in range(len(self.amounts)) for s in (f"sum(v{i}) AS v{i}", f"sum(n{i}) AS n{i}")]

    @cached_property
    def cube(self) -> DataFrame:
        """Sums by days, branch and what the faults look at: some dozen rows per branch and day."""
        return aggregate(self.valued, ["ist_date", "utc_date", "branch_code", "on_branch", "is_copy", "paid", "direction"], *self._sums)

    def _by_run(self, rows: DataFrame, test, *columns: str) -> DataFrame:
        """Each sum once per run that counts it, as ``run``, ``report_date``, ``v`` and ``n``."""
        choices = []
        for run, faults in self.runs.faults.items():
            i = self.amounts.index(amount_of(faults))
            choices.append(f"IF({test(faults)}, struct('{run}' AS run, {day_of(faults)} AS report_date, v{i} AS v, n{i} AS n), NULL)")
        spread = rows.selectExpr(*columns, f"explode(array_compact(array({', '.join(choices)}))) AS of_run")
        return spread.selectExpr("of_run.*", *columns)

    @cached_property
    def daily(self) -> DataFrame:
        return aggregate(
            self._by_run(self.cube, counts, "branch_code", "direction"), ["run", "report_date", "branch_code"],
            "sum(n) AS txn_count", "sum(IF(direction = 'CREDIT', v, 0)) AS credit_inr", "sum(IF(direction = 'DEBIT', v, 0)) AS debit_inr",
            "sum(IF(direction = 'CREDIT', v, -v)) AS net_inr")

    @cached_property
    def loaded(self) -> DataFrame:
        return aggregate(self._by_run(self.cube, loads), ["run"], "sum(n) AS loaded")

    @cached_property
    def rejected(self) -> DataFrame:
        """A copy is rejected as such, or, where copies are loaded, for the next reason it has.

        Rows are counted per account before accounts are looked up.
        """
        before = f"CASE WHEN NOT currency_known THEN 'INVALID_CURRENCY' WHEN {BAD_AMOUNT} THEN 'NON_POSITIVE_AMOUNT' END AS before"
        counted = aggregate(self.checked, ["account_id", "is_copy", before, f"{self._bad_time} AS bad_time"], "count(*) AS n")
        marked = mark_member(counted, "account_id", self.raw.accounts, "account_id", "account_known")
        reason = """CASE WHEN before IS NOT NULL THEN before WHEN account_id IS NOT NULL AND NOT account_known THEN 'UNKNOWN_ACCOUNT'
                         WHEN bad_time THEN 'FUTURE_DATED' END"""
        cube = aggregate(marked, ["is_copy", f"{reason} AS other"], "sum(n) AS n")
        per_run = ", ".join(f"struct('{run}' AS run, {'other' if 'PIPE-01' in faults else dup} AS reason)"
                            for run, faults in self.runs.faults.items() for dup in ["IF(is_copy, 'DUPLICATE', other)"])
        spread = cube.selectExpr("n", f"inline(array({per_run}))").where("reason IS NOT NULL")
        return aggregate(spread, ["run", "reason"], "sum(n) AS actual")

    @cached_property
    def account_sums(self) -> DataFrame:
        """Per account the credits and debits of every run, side by side."""
        sums = []
        for i, faults in enumerate(self.runs.faults.values()):
            v = f"v{self.amounts.index(amount_of(faults))}"
            sums += [f"sum({v}) FILTER (WHERE direction = '{d}' AND {counts(faults)}) AS {d.lower()}{i}" for d in ("CREDIT", "DEBIT")]
        return aggregate(self.valued, ["account_id"], *sums)

    @cached_property
    def account_runs(self) -> DataFrame:
        sides = [f"{c}{i}" for i in range(len(self.runs.faults)) for c in ("credit", "debit")]
        listed = ", ".join(f"struct('{run}' AS run, credit{i} AS credits, debit{i} AS debits)" for i, run in enumerate(self.runs.faults))
        return self.accounts.join(self.account_sums, "account_id", "left").selectExpr("* EXCEPT (" + ", ".join(sides) + ")", *zero_if_null(*sides)).selectExpr(
            "account_id", "opening", "source_closing", f"array({listed}) AS of_runs")

    def id_loads(self) -> tuple[DataFrame, dict[str, str]]:
        return self.valued, {run: f"IF({loads(faults)}, n{self.amounts.index(amount_of(faults))}, 0)" for run, faults in self.runs.faults.items()}
