"""Fault sensitivity: which checks notice which pipeline fault, on which extract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from veritally.config import Config, Runs
from veritally.operators.frames import aggregate, stacked
from veritally.plans.deltas import FaultMatrix
from veritally.plans.reconcile import Checks, Source, write_shared
from veritally.sources.extract import Extract


def check_matrix(extracts: Mapping[str, Extract], cfg: Config, runs: Runs | None = None) -> DataFrame:
    """(extract, run, check_id, passed, mismatches); the runs share one plan per extract.

    Shared tables are written while this plan is built; ``explain()`` shows what follows them.
    """
    runs = runs or Runs.matrix()
    checks = {name: Checks(Source(raw, cfg), FaultMatrix(raw, cfg, runs)) for name, raw in extracts.items()}
    write_shared(*checks.values())
    return stacked([
        c.results().selectExpr(f"'{name}' AS extract", "run", "check_id", "passed", "mismatches")
        for name, c in checks.items()
    ])


def verdicts(matrix: DataFrame) -> DataFrame:
    """PASS or FALSE ALARM for the correct pipeline, CAUGHT or ESCAPED for a fault."""
    failing = "array_sort(collect_set(CASE WHEN NOT passed THEN concat(extract, ':', check_id) END))"
    return aggregate(matrix, ["run"], f"{failing} AS failing").selectExpr(
        "run", "failing",
        "CASE WHEN run = 'none' THEN if(size(failing) > 0, 'FALSE ALARM', 'PASS') "
        "ELSE if(size(failing) > 0, 'CAUGHT', 'ESCAPED') END AS verdict")
