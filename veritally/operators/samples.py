"""Small ordered samples of large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_n(rows: DataFrame, groups: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group with their ``place``.

    Spark limits each group inside the map tasks before it shuffles.
    """
    ranked = rows.selectExpr("*", f"row_number() OVER (PARTITION BY {groups} ORDER BY {order}) AS place")
    return ranked.where(f"place <= {n}")


def in_place(value: str, wanted: str = "true") -> str:
    """Aggregate: the wanted values of one already limited group, in order of ``place``."""
    ranked = f"array_sort(collect_list(CASE WHEN {wanted} THEN struct(place, {value} AS v) END))"
    return f"transform({ranked}, x -> x.v)"
