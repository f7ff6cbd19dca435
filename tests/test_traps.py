"""Semantics that are easy to get subtly wrong."""

from dataclasses import replace

import pytest
from month import CFG, account, customer, extract, staged, txn

from veritally.config import Runs
from veritally.functions import expressions as x
from veritally.plans import expectations
from veritally.plans.oracle import valid_transactions
from veritally.plans.pipeline import Pipeline, run
from veritally.plans.reconcile import Checks, Source
from veritally.plans.rules import findings
from veritally.sources.extract import Extract, read_extract


def found(raw, *rules):
    return sorted((r.rule_id, r.key) for r in findings(raw, CFG, rules).collect())


def failing(raw, cfg=CFG):
    results = Checks(Source(raw, cfg), Pipeline(raw, cfg, Runs.single())).results().collect()
    assert len(results) == 7
    return sorted(r.check_id for r in results if not r.passed)


def test_null_keys_are_no_orphans(spark, tmp_path):
    accounts = [account(), account("ACC-000002", branch=""), account("ACC-000003", branch="BR99")]
    raw = extract(spark, tmp_path, [txn(), txn("T2", account_id=""), txn("T3", account_id="ACC-7")], accounts)
    assert found(raw, "INT-01", "INT-02") == [("INT-01", "T3"), ("INT-02", "ACC-000003")]


def test_nulls_among_the_known_keys_are_ignored(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn(), txn("T3", account_id="ACC-7")], [account(), account("")])
    assert found(raw, "INT-01") == [("INT-01", "T3")]


def test_unparsable_time_is_late_on_both_sides(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn(), txn("T2", ts="yesterday"), txn("T3", ts="2026-09-30T18:30:00Z")])
    assert found(raw, "TML-01") == [("TML-01", "T2"), ("TML-01", "T3")]
    assert [r.txn_id for r in valid_transactions(raw, CFG).collect()] == staged(run(raw, CFG)) == ["T1"]


def test_missing_account_is_noticed_by_row_accounting_only(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn(), txn("T2", account_id="")], closing=[("ACC-000001", "2026-09-30", "1010.00")])
    assert failing(raw) == ["REC-01"]


def test_repeated_accounts_fan_out_staging(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn()], [account(), account()], closing=[("ACC-000001", "2026-09-30", "1010.00")])
    assert staged(run(raw, CFG)) == ["T1", "T1"]
    assert {"REC-01", "REC-02"} <= set(failing(raw))


def test_repeated_rates_fan_out_staging(spark, tmp_path):
    rates = [("2026-09-05", "USD", "88.0000")] * 2
    raw = extract(spark, tmp_path, [txn(currency="USD")], rates=rates)
    assert "REC-01" in failing(raw)


def test_account_without_ledger_row_is_a_break_only_for_the_report(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn()], closing=[])
    assert found(raw, "CON-02") == [] and failing(raw) == ["REC-07"]


def test_null_branch_matches_nothing(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn()], [account(branch="")], closing=[("ACC-000001", "2026-09-30", "1010.00")])
    checks = Checks(Source(raw, CFG), Pipeline(raw, CFG, Runs.single()))
    assert checks.branch_totals().count() == 2


def test_calendar_ages(spark, tmp_path):
    people = [customer("C1", born="2008-09-30"), customer("C2", born="2008-10-01"), customer("C3", born="2009"),
              customer("C4", born="2010-01-01")]
    accounts = [account(f"ACC-{i}", kind="CURRENT", customer=f"C{i}") for i in (1, 2, 3)] + [account("ACC-4", customer="C4")]
    assert found(extract(spark, tmp_path, [txn()], accounts, people), "CON-03") == [("CON-03", "C2")]


def test_customer_rules_count_every_row_and_blank_is_missing(spark, tmp_path):
    people = [customer("C1", email="  "), customer("C1", phone=""), customer("C2", email="x@", phone="12345"),
              customer("C4", kyc="")]
    raw = extract(spark, tmp_path, [txn()], customers=people)
    assert found(raw, "CMP-01") == [("CMP-01", "C1"), ("CMP-01", "C1"), ("CMP-01", "C4")]
    assert found(raw, "VAL-04") == [("VAL-04", "C2")]
    assert found(raw, "VAL-03") == [("VAL-03", "C2")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    extract(spark, tmp_path, [txn()], customers=[customer("C3", email="ok@example.com\n"), customer("C4")])
    raw = read_extract(spark, str(tmp_path), line_breaks=True)
    assert raw.customers.count() == 2 and found(raw, "VAL-03") == [("VAL-03", "C3")]


def test_trailing_newline_is_no_full_match(spark):
    row = spark.sql("SELECT 'a@b.co\\n' AS mail, 'a@b.co' AS good")
    got = row.selectExpr(x.full_match("mail", "[a-z@.]+") + " AS bad", x.full_match("good", "[a-z@.]+") + " AS good").first()
    assert (got.bad, got.good) == (False, True)


def test_na_like_texts_are_missing_for_expectations_only(spark, tmp_path):
    raw = extract(spark, tmp_path, [txn()], customers=[customer(email="NA"), customer("C2", email="null")])
    results = {(r.expectation, r.column): r for r in expectations.evaluate(raw, "customers", CFG).collect()}
    assert results[(expectations.NOT_NULL, "email")].unexpected_count == 2
    assert results[(expectations.MATCHES, "email")].success
    assert found(raw, "CMP-01") == []


def test_first_arrival_wins_where_the_extract_says_so(spark, tmp_path):
    rows = [txn(ts="2026-09-06T06:00:00Z", amount="1.00"), txn(ts="2026-09-05T06:00:00Z", amount="2.00")]
    raw = extract(spark, tmp_path, rows)
    arrived = raw.transactions.selectExpr("*", "CASE amount WHEN '1.00' THEN 1L ELSE 2L END AS arrival")
    tagged = Extract(**{**raw._sources, "transactions": lambda: arrived})
    cfg = replace(CFG, arrival="arrival")
    assert str(run(raw, CFG).staging.first().amount) == "2.00"
    assert str(run(tagged, cfg).staging.first().amount) == "1.00"
    assert str(valid_transactions(tagged, cfg).first().amt) == "1.00"


@pytest.mark.parametrize("part, whole, expected", [(1, 800, 0.13), (0, 5, 0.0), (5, 5, 100.0), (2675, 100000, 2.68), (0, 0, 7.0)])
def test_shares_are_rounded_half_up(spark, part, whole, expected):
    row = spark.sql(f"SELECT {part}L * 100 AS p, {whole}L AS w").selectExpr(x.share("p", "w", 2, 7.0) + " AS s")
    assert row.first().s == expected


@pytest.mark.parametrize("expression, expected", [
    (x.rotate(["a", "b", "c"], "7"), "b"),
    (x.zero_padded("1234567", 6), "1234567"), (x.zero_padded("42", 6), "000042"),
    (x.iso_utc("TIMESTAMP_NTZ'2026-09-05 06:00:00.5'"), "2026-09-05T06:00:00Z"), (x.money_text("2.005"), "2.01"),
    (x.utc_timestamp("'2026-09-05T06:00:00+05:30'"), "2026-09-05 06:00:00"), (x.calendar_date("'2026-09'"), None),
    (x.number("'5d'"), None), (x.number("' 1e3 '"), "1000.0"), (x.blank("'  '"), "true"),
    (x.business_day("TIMESTAMP_NTZ'2026-09-10 18:30:00'", CFG), "2026-09-11"),
    ("DATE'2024-02-29' - INTERVAL 18 YEAR", "2006-02-28"),
])
def test_scalar_expressions(spark, expression, expected):
    assert spark.sql(f"SELECT CAST({expression} AS STRING) AS v").first().v == expected
