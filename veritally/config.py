"""Settings every job takes as an argument, and the fault switches of the pipeline."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Config:
    cutoff_utc: str = "2026-09-30 18:30:00"  # first instant after the period
    as_of: str = "2026-09-30"
    offset_minutes: int = 330
    base_currency: str = "INR"
    adult_years: int = 18
    # Column holding the arrival order, where the extract has one. Without it the
    # earliest timestamp wins, ties going to the smallest row content.
    arrival: str | None = None

    @property
    def cutoff(self) -> str:
        return f"TIMESTAMP_NTZ'{self.cutoff_utc}'"

    @property
    def as_of_date(self) -> str:
        return f"DATE'{self.as_of}'"


FAULTS = {
    "PIPE-01": "re-sent copies are loaded",
    "PIPE-02": "every day is converted at the newest rate",
    "PIPE-03": "the report day is the UTC day",
    "PIPE-04": "accounts on an unknown branch are lost in the branch join",
    "PIPE-05": "failed and reversed payments are counted",
    "PIPE-06": "amounts are cut to whole units before conversion",
}


def parse_faults(text: str | None) -> frozenset[str]:
    """``none``, ``all`` or a comma list of fault ids, in any case."""
    words = [w.strip().upper() for w in (text or "").split(",") if w.strip()]
    if words in ([], ["NONE"], ["OFF"], ["0"]):
        return frozenset()
    if words == ["ALL"]:
        return frozenset(FAULTS)
    unknown = sorted(set(words).difference(FAULTS))
    if unknown:
        raise ValueError(f"no such pipeline fault: {', '.join(unknown)}")
    return frozenset(words)


class Runs:
    """Named fault sets that one plan evaluates side by side.

    A switch is an SQL condition: a literal for a single run (Catalyst folds it away),
    a test of the ``run`` column for several. Rows are fanned out only where a
    stage starts to depend on the faults, so scans, the copy ranking and the
    account join are shared by all runs.
    """

    def __init__(self, faults: Mapping[str, Iterable[str]]):
        self.faults = {name: frozenset(ids) for name, ids in faults.items()}

    @classmethod
    def single(cls, faults: Iterable[str] = ()) -> Runs:
        return cls({"run": faults})

    @classmethod
    def matrix(cls) -> Runs:
        """The correct pipeline, each fault alone, and all of them together."""
        return cls({"none": (), **{f: (f,) for f in FAULTS}, "all": FAULTS})

    def on(self, fault: str) -> str:
        names = [name for name, ids in self.faults.items() if fault in ids]
        if len(names) in (0, len(self.faults)):
            return "true" if names else "false"
        return f"run IN ({', '.join(repr(n) for n in names)})"

    def fan_out(self, rows: DataFrame) -> DataFrame:
        names = ", ".join(repr(n) for n in self.faults)
        each = names if len(self.faults) == 1 else f"explode(array({names}))"
        return rows.selectExpr(f"{each} AS run", "*")
