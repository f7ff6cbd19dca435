"""The checks share no arithmetic with the pipeline: a wrong helper there is noticed."""

import pytest

from veritally.config import Runs
from veritally.plans import pipeline
from veritally.plans.reconcile import Checks, Source
from veritally.sources.extract import COLUMNS

WRONG = {
    "NET": lambda old: "sum(inr_amount)",
    "total": lambda old: lambda direction: f"2 * {old(direction)}",
    "money": lambda old: lambda text: f"10 * {old(text)}",
    "utc_timestamp": lambda old: lambda text: f"({old(text)} + INTERVAL '1' DAY)",
    "business_day": lambda old: lambda ts, cfg: f"date_add({old(ts, cfg)}, 1)",
    "mark_member": lambda old: lambda rows, key, members, column, flag: old(rows, key, members.limit(1), column, flag),
    "mark_copies": lambda old: lambda rows, key, order: rows.selectExpr("*", "false AS is_copy"),
    "BAD_AMOUNT": lambda old: "(amt IS NULL OR amt <= 100)",
}


@pytest.mark.parametrize("helper", WRONG)
def test_a_wrong_helper_of_the_pipeline_fails_a_check(monkeypatch, dirty, cfg, helper):
    for table in COLUMNS:  # landed before a plan is built on them
        getattr(dirty, table)
    monkeypatch.setattr(pipeline, helper, WRONG[helper](getattr(pipeline, helper)))
    results = Checks(Source(dirty, cfg), pipeline.Pipeline(dirty, cfg, Runs.single())).results().collect()
    assert not all(r.passed for r in results)
