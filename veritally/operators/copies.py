"""Mark the rows that repeat a key, one hot key included."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veritally.operators.frames import aggregate


def _never_null(key: str) -> str:
    return f"coalesce(concat('=', CAST({key} AS STRING)), '') AS _key"


def keys_again(rows: DataFrame, key: str) -> DataFrame:
    """The keys that occur more than once, NULL among them, as :func:`mark_copies` takes them."""
    return aggregate(rows, [_never_null(key)], "count(*) AS _n").where("_n > 1").select("_key")


def mark_copies(rows: DataFrame, key: str, order: list[str], again: DataFrame | None = None) -> DataFrame:
    """Add ``is_copy``: false for the first row of each key, true for every other.

    ``order`` lists expressions, ascending, NULL last; rows that agree in all columns are
    interchangeable. Keys are counted first, which map tasks reduce to one row each. One left join then tells rows
    of repeated keys from the others, which are done. Equal ones among the former are counted, the least of
    each key is an aggregate, and the rest are copies; all of it keeps the partitioning of that join. One plan
    at every size; a hot key is reduced in the map tasks, and split at run time where rows meet.

    ``again`` are the rows' :func:`keys_again`, where a job has written them. Spark then knows how few they are: while
    they are below the session's broadcast threshold, rows of other keys stay where they are read.
    """
    # Never NULL, so that joins and aggregates by it share one partitioning.
    keyed = rows.selectExpr("*", _never_null(key))
    repeated = (keys_again(rows, key) if again is None else again).selectExpr("_key", "true AS _again")
    told = keyed.join(repeated, "_key", "left")
    names = [f"`{c}`" for c in rows.columns]
    single = told.where("_again IS NULL").selectExpr(*names, "false AS is_copy")
    contents = aggregate(told.where("_again"), ["_key", *names], "count(*) AS _rows")
    place = "struct(" + ", ".join(f"{o} IS NULL, {o}" for o in [*order, *names]) + ")"
    first = aggregate(contents, ["_key"], f"min({place}) AS _first")
    spread = contents.join(first, "_key").selectExpr(*names, f"{place} = _first AS _is_first", "explode(sequence(1L, _rows)) AS _row")
    return single.unionByName(spread.selectExpr(*names, "NOT (_is_first AND _row = 1) AS is_copy"))


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with ``copies``."""
    return aggregate(rows, list(keys), "count(*) AS copies").where("copies > 1")
