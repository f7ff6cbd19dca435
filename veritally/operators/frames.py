"""Short forms for SQL expressions on DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aggregate(rows: DataFrame, keys: list[str], *aggregates: str) -> DataFrame:
    """``SELECT keys, aggregates GROUP BY keys`` from SQL texts such as ``count(*) AS n``."""
    columns = [F.expr(a) for a in aggregates]
    return rows.groupBy(*[F.expr(k) for k in keys]).agg(*columns) if keys else rows.agg(*columns)


def stacked(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def zero_if_null(*columns: str) -> list[str]:
    return [f"coalesce({c}, 0) AS {c}" for c in columns]
