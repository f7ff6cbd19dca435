"""Membership in another table's keys, as a flag or as a filter.

A NULL key is never a member and, as with NOT IN, never an orphan either. NULLs
among the members are ignored. Both are left joins to distinct keys without a hint: Catalyst broadcasts a
list below the session's threshold, and beyond it AQE splits the rows of a hot key at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def member_keys(members: DataFrame, column: str, name: str) -> DataFrame:
    return members.where(f"{column} IS NOT NULL").selectExpr(f"{column} AS {name}").distinct()


def mark_member(rows: DataFrame, key: str, members: DataFrame, column: str, flag: str) -> DataFrame:
    """Add ``flag``: whether the key is among the members."""
    known = member_keys(members, column, key).selectExpr("*", "true AS is_member")
    return rows.join(known, key, "left").selectExpr("* EXCEPT (is_member)", f"is_member IS NOT NULL AS {flag}")


def orphans(rows: DataFrame, key: str, members: DataFrame, column: str) -> DataFrame:
    marked = mark_member(rows, key, members, column, "is_known")
    return marked.where(f"{key} IS NOT NULL AND NOT is_known").drop("is_known")
