"""The full month: rules, expectations, checks, scores and faults, dirty and clean."""

from collections import Counter
from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from month import extract, txn

from veritally.config import FAULTS, Config, Runs
from veritally.plans import expectations, mutation, rules, score
from veritally.plans.deltas import FaultMatrix
from veritally.plans.pipeline import Pipeline
from veritally.plans.reconcile import Checks, Source
from veritally.session import written


@pytest.fixture(scope="module")
def found(dirty, cfg):
    return written(rules.findings(dirty, cfg))


@pytest.fixture(scope="module")
def matrix(dirty, clean, cfg):
    rows = mutation.check_matrix({"dirty": dirty, "clean": clean}, cfg)
    return written(rows)


def test_every_defect_is_planted(planted_keys):
    assert {k: len(v) for k, v in sorted(planted_keys.items())} == {
        "DQ-01": 10, "DQ-02": 6, "DQ-03": 10, "DQ-04": 5, "DQ-05": 4, "DQ-06": 4, "DQ-07": 4, "DQ-08": 3,
        "DQ-09": 3, "DQ-10": 4, "DQ-11": 3, "DQ-12": 1, "NAT-02": 5}


def test_injection_is_repeatable_and_leaves_clean_rows_alone(planted, clean, manifest):
    assert planted.manifest().exceptAll(manifest).isEmpty()
    assert clean.transactions.exceptAll(planted.dirty.transactions).isEmpty()


def test_rules_flag_exactly_the_planted_keys(found, manifest):
    graded = score.grade(found, manifest)
    assert score.exact_rules(graded).first().asDict() == {"exact": 12, "rules": 12}
    for row in graded.collect():
        assert row.expected > 0 and row.missed == [] and row.false_positives == []


def test_rules_are_silent_on_clean_data(clean, cfg):
    assert rules.findings(clean, cfg).isEmpty()


def test_grading_lists_missed_and_false_keys_in_order(spark, manifest):
    some = spark.createDataFrame([("UNQ-01", f"Z{i:02d}") for i in range(15)], "rule_id string, key string")
    rows = {r.rule_id: r for r in score.grade(some, manifest).collect()}
    assert rows["UNQ-01"].false_positives == [f"Z{i:02d}" for i in range(10)]
    assert (rows["UNQ-01"].precision, rows["UNQ-01"].recall, len(rows["UNQ-01"].missed)) == (0.0, 0.0, 10)
    assert rows["VAL-02"].precision == 1.0 and rows["VAL-02"].recall == 0.0
    assert rows["CON-02"].expected == 7


def test_expectations_pass_on_clean_data(clean, cfg):
    results = expectations.evaluate_all(clean, cfg).collect()
    assert len(results) == 22 and all(r.success and r.sample == [] for r in results)


# Which planted or natural defects an expectation of a column meets.
MET = {
    ("transactions", "txn_id"): ["DQ-01"], ("transactions", "currency"): ["DQ-03"],
    ("transactions", "amount_num"): ["DQ-04", "NAT-01"], ("transactions", "txn_ts_utc"): ["DQ-06", "NAT-02"],
    ("customers", "email"): ["DQ-02", "DQ-07"], ("customers", "phone"): ["DQ-02", "DQ-08"],
    ("customers", "kyc_status"): ["DQ-02"], ("accounts", "branch_code"): ["DQ-12"],
}


def test_each_unexpected_value_is_a_known_defect(dirty, cfg, manifest):
    """Per column, the rows that its expectations reject are counted against the manifest's own keys."""
    raw = {"transactions": "txn_id", "customers": "customer_id", "accounts": "account_id"}
    counted, results = {}, expectations.evaluate_all(dirty, cfg).collect()
    for r in results:
        counted[r.suite, r.column] = counted.get((r.suite, r.column), 0) + r.unexpected_count
    for (suite, column), total in counted.items():
        keys = manifest.where(manifest.defect_id.isin(MET.get((suite, column), []))).select("key").distinct()
        rows = getattr(dirty, suite).join(keys, getattr(dirty, suite)[raw[suite]] == keys["key"], "left_semi")
        if column in ("email", "phone", "kyc_status"):  # an empty field counts where it is empty only
            own = rows.where(f"{column} IS NULL").count() + manifest.where(
                manifest.defect_id == {"email": "DQ-07", "phone": "DQ-08"}.get(column, "none")).count()
            assert total == own, column
        else:
            assert total == rows.count(), column
    sizes = {r.suite: r.element_count for r in results}
    assert sizes == {suite: getattr(dirty, suite).count() for suite in raw}


def _rounded(part, whole, places=2):
    """part / whole, rounded half up."""
    return float((Decimal(part) / Decimal(whole)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def test_rule_scores_count_the_keys_of_the_manifest(dirty, cfg, found, manifest):
    """A rule fails for each key that is planted for it; a ledger planted below zero also breaks the sum."""
    planted = Counter((r.rule_id, r.key) for r in manifest.select("rule_id", "key").distinct().collect())
    failed = Counter(rule for rule, _ in planted)
    failed["CON-02"] = len({k for rule, k in planted if rule in ("CON-01", "CON-02")})
    sizes = {t: getattr(dirty, t).count() for t in ("transactions", "customers", "accounts")}
    rates = {}
    for r in score.rule_scores(dirty, found).collect():
        assert (r.failed, r.records) == (failed[r.rule_id], sizes[r.table]), r.rule_id
        assert r.pass_rate == _rounded(100 * (r.records - r.failed), r.records)
        rates.setdefault(r.dimension, []).append(r.pass_rate)
    want = {d: _rounded(sum(Decimal(str(x)) for x in v), len(v)) for d, v in rates.items()}
    got = score.dimension_scores(score.rule_scores(dirty, found))
    assert {r.dimension: r.score for r in got.collect()} == want
    assert score.overall_score(got).first().score == _rounded(sum(Decimal(str(x)) for x in want.values()), len(want))


def test_daily_scores_recounted_row_by_row(dirty, cfg, found):
    bad = {r.key for r in found.where("rule_id IN ('VAL-01', 'VAL-02', 'INT-01')").collect()}
    first, rows = {}, Counter()
    for r in dirty.transactions.selectExpr("txn_id", "to_date(to_timestamp_ntz(replace(txn_ts, 'Z', '')) + INTERVAL '330' MINUTE) AS day").collect():
        rows[r.day] += 1
        first[r.txn_id] = min(r.day, first.get(r.txn_id, r.day))
    passed = Counter(day for txn_id, day in first.items() if txn_id not in bad)
    as_of = date.fromisoformat(cfg.as_of)
    want = {d: (n, n - passed[d], _rounded(100 * passed[d], n)) for d, n in rows.items() if d <= as_of}
    days = score.daily_scores(dirty, found, cfg)
    assert {r.date: (r.rows, r.failed, r.score) for r in days.collect()} == want
    assert score.worst_day(days).first().date == min(want, key=lambda d: (want[d][2], d))


# The checks that notice each fault.
ALWAYS = ["REC-04", "REC-05", "REC-06", "REC-07"]
NOTICED = {  # run -> failing on dirty, failing on clean
    "none": ([], []),
    "PIPE-01": (["REC-02", "REC-03", *ALWAYS], []),
    "PIPE-02": (ALWAYS, ALWAYS),
    "PIPE-03": (ALWAYS, ALWAYS),
    "PIPE-04": (["REC-01", "REC-02", *ALWAYS], []),
    "PIPE-05": (ALWAYS, ALWAYS),
    "PIPE-06": (ALWAYS, ALWAYS),
    "all": (["REC-01", "REC-02", "REC-03", *ALWAYS], ALWAYS),
}


def test_each_fault_is_noticed_by_the_known_checks(matrix):
    rows = matrix.collect()
    assert len(rows) == 2 * 8 * 7
    got = {run: tuple(sorted(r.check_id for r in rows if r.run == run and r.extract == e and not r.passed)
                      for e in ("dirty", "clean")) for run in NOTICED}
    assert got == NOTICED


def test_verdicts(matrix):
    verdicts = {r.run: r.verdict for r in mutation.verdicts(matrix).collect()}
    assert verdicts == {"none": "PASS", **dict.fromkeys([*FAULTS, "all"], "CAUGHT")}


def _side_by_side_and_alone(raw, cfg, runs, names):
    together = FaultMatrix(raw, cfg, Runs.matrix())
    for name in names:
        rows = [r.asDict() for r in getattr(together, name).collect()]
        for run in runs:
            alone = [r.asDict() for r in getattr(Pipeline(raw, cfg, Runs({run: Runs.matrix().faults[run]})), name).collect()]
            assert Counter(map(_shown, alone)) == Counter(_shown(r) for r in rows if r["run"] == run), (run, name)


def _shown(row):
    return str(sorted(row.items()))


def test_faults_side_by_side_equal_faults_alone(dirty, cfg):
    _side_by_side_and_alone(dirty, cfg, ["PIPE-01", "PIPE-03", "all"], ["daily", "balances", "rejected"])


def test_rows_are_not_multiplied_by_runs(dirty, cfg):
    matrix = FaultMatrix(dirty, cfg, Runs.matrix())
    assert matrix.valued.count() == matrix.accepted.count()
    assert matrix.cube.count() < 20 * dirty.branches.count() * 2 * 32


def test_rates_listed_twice_or_without_a_number(spark, tmp_path):
    """Both forms of the pipeline count a foreign row once per rate of its day."""
    day = "2026-09-05"
    raw = extract(spark, tmp_path, [txn(), txn("T2", currency="USD"), txn("T3", currency="EUR"), txn("T4", currency="AED"), txn("T5", currency="USD", direction="DEBIT")],
                  rates=[(day, "USD", "91.2500"), (day, "USD", "90.0000"), (day, "EUR", "many"), ("2026-09-28", "AED", "24.1111"), (day, "INR", "1.0000"), (day, "INR", "2.0000")])
    _side_by_side_and_alone(raw, Config(), ["none", "PIPE-02", "PIPE-06"], ["daily", "balances", "loaded"])


def test_month_ties_out_and_clean_quarantine_is_empty(dirty, clean, cfg):
    row = Checks(Source(dirty, cfg), Pipeline(dirty, cfg, Runs.single())).tie_out().first()
    assert row.passed and row.report_net is not None
    assert Pipeline(clean, cfg, Runs.single()).quarantine.isEmpty()
