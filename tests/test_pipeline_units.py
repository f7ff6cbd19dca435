"""A few days of two branches, worked out by hand, and single rows at the edges."""

import pytest
from month import CFG, account, d, extract, rejected, report, staged, txn

from veritally.config import FAULTS, parse_faults
from veritally.plans.pipeline import run

# Local time is 5:30 ahead: 18:29 belongs to the day, 18:30 to the next one.
WEEK = [
    txn("A1", ts="2026-09-05T18:29:00Z", amount="40.25"),
    txn("A2", ts="2026-09-05T18:30:00Z", amount="12.50", direction="DEBIT"),
    txn("A3", ts="2026-09-05T02:15:00Z", amount="3.10", currency="USD"),  # 3.10 * 91.25 = 282.875
    txn("A4", ts="2026-09-06T09:00:00Z", amount="77.00", status="REVERSED"),
    txn("A4", ts="2026-09-06T10:00:00Z", amount="77.00", status="REVERSED"),
    txn("B1", ts="2026-09-06T23:59:59Z", amount="8.08", account_id="ACC-000002"),
    txn("B2", ts="2026-09-06T23:59:59Z", amount="0.01", account_id="ACC-000002", direction="DEBIT"),
    txn("B3", ts="2026-09-07T01:00:00Z", amount="65.00", account_id="ACC-000002", status="FAILED"),
    txn("C1", ts="2026-09-06T04:00:00Z", amount="5.55", account_id="ACC-000003"),
]
HOLDERS = [account(), account("ACC-000002", branch="BR02", opening="20.00"), account("ACC-000003", branch="BR77", opening="0.00")]
PLACES = [("BR01", "Harbour", "Kochi"), ("BR02", "Hill", "Munnar")]


@pytest.fixture
def week(spark, tmp_path):
    ledger = [("ACC-000001", "2026-09-30", "1310.63"), ("ACC-000002", "2026-09-30", "30.00"), ("ACC-000003", "2026-09-30", "5.55")]
    return extract(spark, tmp_path, WEEK, HOLDERS, branches=PLACES, closing=ledger)


def test_week_by_day_and_branch(week):
    out = run(week, CFG)
    assert report(out) == [
        ("2026-09-05", "BR01", 2, d("323.13"), d("0.00")),  # 40.25 and 282.88
        ("2026-09-06", "BR01", 1, d("0.00"), d("12.50")),
        ("2026-09-06", "BR77", 1, d("5.55"), d("0.00")),  # a branch nobody knows still reports
        ("2026-09-07", "BR02", 2, d("8.08"), d("0.01")),
    ]
    assert rejected(out) == [("A4", "DUPLICATE")]
    assert staged(out) == ["A1", "A2", "A3", "A4", "B1", "B2", "B3", "C1"]


def test_week_by_account(week):
    rows = {r.account_id: (r.credits, r.debits, r.computed_closing, r.difference) for r in run(week, CFG).balances.collect()}
    assert rows == {
        "ACC-000001": (d("323.13"), d("12.50"), d("1310.63"), d("0.00")),
        "ACC-000002": (d("8.08"), d("0.01"), d("28.07"), d("1.93")),  # the bank says 1.93 more
        "ACC-000003": (d("5.55"), d("0.00"), d("5.55"), d("0.00")),
    }


def test_local_offset_is_a_setting(week):
    from dataclasses import replace

    assert report(run(week, replace(CFG, offset_minutes=0)))[0] == ("2026-09-05", "BR01", 3, d("323.13"), d("12.50"))


REJECTED = {  # what is wrong with a row -> the reason; several at once: the first in this order
    "odd": ({"currency": "YEN"}, "INVALID_CURRENCY"),
    "none": ({"currency": ""}, "INVALID_CURRENCY"),
    "lower": ({"currency": "inr"}, "INVALID_CURRENCY"),
    "minus": ({"amount": "-0.01"}, "NON_POSITIVE_AMOUNT"),
    "nothing": ({"amount": "0"}, "NON_POSITIVE_AMOUNT"),
    "words": ({"amount": "1,000"}, "NON_POSITIVE_AMOUNT"),
    "nobody": ({"account_id": "ACC-404404"}, "UNKNOWN_ACCOUNT"),
    "first instant after": ({"ts": "2026-09-30T18:30:00Z"}, "FUTURE_DATED"),
    "no time": ({"ts": "tomorrow"}, "FUTURE_DATED"),
    "year only": ({"ts": "2025"}, "FUTURE_DATED"),
    "two things": ({"amount": "-1", "ts": "2027-01-01T00:00:00Z"}, "NON_POSITIVE_AMOUNT"),
    "all things": ({"ts": "never", "account_id": "ACC-404404", "amount": "x", "currency": "YEN"}, "INVALID_CURRENCY"),
}


def test_reasons(spark, tmp_path):
    good = txn("last second", ts="2026-09-30T18:29:59Z")
    out = run(extract(spark, tmp_path, [good, *[txn(name, **bad) for name, (bad, _) in REJECTED.items()]]), CFG)
    assert rejected(out) == sorted((name, reason) for name, (_, reason) in REJECTED.items())
    assert staged(out) == ["last second"] and report(out)[0][0] == "2026-09-30"


def test_account_without_movement_has_a_balance_row(spark, tmp_path):
    out = run(extract(spark, tmp_path, [txn()], [account(), account("ACC-000002", opening="5.00")]), CFG)
    rows = {r.account_id: r.computed_closing for r in out.balances.collect()}
    assert rows == {"ACC-000001": d("1010.00"), "ACC-000002": d("5.00")}


def test_bad_first_copy_costs_the_good_second_one(spark, tmp_path):
    rows = [txn(ts="2026-09-05T06:00:00Z", amount="0.00"), txn(ts="2026-09-05T07:00:00Z", amount="9.00")]
    out = run(extract(spark, tmp_path, rows), CFG)
    assert rejected(out) == [("T1", "DUPLICATE"), ("T1", "NON_POSITIVE_AMOUNT")] and staged(out) == []


def test_missing_account_is_neither_staged_nor_rejected(spark, tmp_path):
    out = run(extract(spark, tmp_path, [txn(), txn("T2", account_id="")]), CFG)
    assert staged(out) == ["T1"] and rejected(out) == []


def test_missing_rate_is_counted_without_an_amount(spark, tmp_path):
    out = run(extract(spark, tmp_path, [txn(ts="2026-09-06T06:00:00Z", currency="USD"), txn("T2", ts="2026-09-06T06:00:00Z")]), CFG)
    assert report(out) == [("2026-09-06", "BR01", 2, d("10.00"), d("0.00"))]


@pytest.mark.parametrize("fault, expected", [
    ("PIPE-01", (2, d("1131.50"))), ("PIPE-02", (1, d("520.80"))), ("PIPE-06", (1, d("547.50"))),
])
def test_faults_change_what_they_say(spark, tmp_path, fault, expected):
    rows = [txn(amount="6.20", currency="USD")] * 2  # 6.20 * 91.25 = 565.75, * 84 = 520.80, 6 * 91.25 = 547.50
    raw = extract(spark, tmp_path, rows)
    assert report(run(raw, CFG))[0][2:4] == (1, d("565.75"))
    assert report(run(raw, CFG, [fault]))[0][2:4] == expected


def test_fault_selector():
    assert parse_faults(None) == parse_faults("none") == frozenset()
    assert parse_faults("ALL") == frozenset(FAULTS)
    assert parse_faults("pipe-01, PIPE-03") == {"PIPE-01", "PIPE-03"}
    with pytest.raises(ValueError):
        parse_faults("PIPE-01,PIPE-77")
