"""Tables that several checks share are written once, hold what the unshared plans give, and grow with their own rows only."""

import pytest
from month import CFG, account, extract, txn

from veritally.config import Runs
from veritally.operators.copies import keys_again, mark_copies
from veritally.operators.difference import opened, weighed
from veritally.plans import expectations
from veritally.plans.deltas import FaultMatrix
from veritally.plans.pipeline import Pipeline
from veritally.plans.reconcile import Checks, Source, write_shared
from veritally.session import side_by_side, written

ROWS = [
    txn("T1"), txn("T1"), txn("T1", amount="12.00"), txn("T2", account_id="ACC-9"), txn("T2", account_id="ACC-9"), txn("T3", currency="??"),
    txn("T3", currency="??", account_id="ACC-9"), txn("T4", amount="-1"), txn("T5", ts="2027-01-01T00:00:00Z"), txn("T6", account_id=""),
    txn("T7", account_id="ACC-2"), txn("", amount="3.00"), txn("", amount="4.00"), txn("T8", currency="USD"), txn("T9", status="FAILED"),
]
ACCOUNTS = [account(), account("ACC-2", branch="BR99"), account("ACC-3")]


@pytest.fixture
def raw(spark, tmp_path):
    return extract(spark, tmp_path, ROWS, ACCOUNTS)


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def as_rows(frame):
    return sorted(map(str, frame.collect()))


def test_known_repeated_keys_mark_the_same_copies(spark, raw):
    rows, order = raw.transactions, ["txn_ts", "amount"]
    again = written(keys_again(rows, "txn_id"))
    assert sorted(r._key for r in again.collect()) == ["", "=T1", "=T2", "=T3"]
    told = mark_copies(rows, "txn_id", order, again)
    assert as_rows(told) == as_rows(mark_copies(rows, "txn_id", order))
    # Rows of other keys are not moved.
    single = plan_of(told.where("txn_id = 'T4'"))
    assert "BroadcastHashJoin" in single and "SortMergeJoin" not in plan_of(mark_copies(rows, "txn_id", order, again).select("is_copy"))


def test_shared_tables_change_no_result(raw):
    def checks():
        return Checks(Source(raw, CFG), FaultMatrix(raw, CFG, Runs.matrix()))

    plain, shared = checks(), checks()
    write_shared(shared)
    # Copies are told once, and every later table starts from that file.
    assert shared.out.checked.inputFiles() and shared.out.known_again.inputFiles()
    assert as_rows(shared.results()) == as_rows(plain.results())
    assert as_rows(shared.samples()) == as_rows(plain.samples())


@pytest.mark.parametrize("faults", [(), ("PIPE-01",)])
def test_reasons_counted_per_account_are_those_of_the_quarantine(raw, faults):
    counted = FaultMatrix(raw, CFG, Runs.single(faults)).rejected
    assert as_rows(counted.select("reason", "actual")) == as_rows(Pipeline(raw, CFG, Runs.single(faults)).rejected.select("reason", "actual"))


def test_dense_differences_move_only_the_rows_they_open(spark):
    """One key in fifty weighs otherwise in the second comparison: the others are read and left where they are."""
    left = spark.range(20000).selectExpr("CAST(id AS STRING) AS k")
    right = left.selectExpr("k", "CAST(k AS INT) % 50 = 7 AS odd")
    rows = opened(weighed(left, right, "k", ["1", "1"], ["1", "IF(odd, 0, 1)"]), 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in plan_of(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = {r._key for r in rows.select("_key").distinct().collect()}
    assert {str(i) for i in range(7, 20000, 50)} <= keys and len(keys) < 500


def test_an_expectation_looks_at_the_rows_once(raw):
    """Counts and samples share one pass, and all rows are counted without it."""
    found = expectations.evaluate(raw, "transactions", CFG)
    assert plan_of(found).count("Generate explode") == 1
    by_column = {(r.expectation, r.column): r for r in found.collect()}
    ids = by_column[expectations.NOT_NULL, "txn_id"]
    assert (ids.unexpected_count, ids.element_count, ids.sample) == (2, 15, [])
    again = by_column[expectations.UNIQUE, "txn_id"]
    assert (again.unexpected_count, again.sample) == (7, ["T1", "T1", "T1"])


def test_jobs_side_by_side_keep_their_order_and_raise(spark):
    assert side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(6)]) == list(range(6))
    with pytest.raises(ZeroDivisionError):
        side_by_side(spark, [lambda: 1, lambda: 1 // 0])
