"""Gapless row numbers in the order of the source files.

A scan knows which block of which file a row comes from, and hands the rows of a block on in their order.
Rows are written once with both; the rows of each block are counted, the counts are summed up over files
and blocks, and a row's number is the sum before its block plus its place there. No
row is sorted or shuffled for it: what meets in one task is one row per block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.frames import aggregate
from veritally.session import written

PLACED = ["_file", "_start", "_task_row"]


def placed(scan: DataFrame) -> DataFrame:
    """A scan of files with the file, the block and the running number of each row in its task.

    To be applied to the scan itself: a filter before it would leave gaps.
    """
    return scan.selectExpr("*", "_metadata.file_path AS _file", "_metadata.file_block_start AS _start",
                           "monotonically_increasing_id() AS _task_row")


def blocks(rows: DataFrame) -> DataFrame:
    """Per block: its first running number, and how many rows stand in earlier files and blocks."""
    counted = aggregate(rows, ["_file", "_start"], "count(*) AS _rows", "min(_task_row) AS _first")
    # One row per block, so a whole table's blocks fit one task.
    before = "coalesce(sum(_rows) OVER (ORDER BY _file, _start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    return counted.selectExpr("_file", "_start", "_first", f"{before} AS _before")


def numbered(rows: DataFrame, name: str = "src_row") -> DataFrame:
    """Rows of :func:`placed` with ``name``: 1, 2, 3 ... over all files, ordered by path and place.

    The rows are written first, so that counting and numbering see the same split of the files.
    """
    landed = written(rows)
    return (
        landed.join(blocks(landed), ["_file", "_start"])
        .withColumn(name, F.expr("_before + _task_row - _first + 1"))
        .drop(*PLACED, "_before", "_first")
    )


def running(rows: DataFrame, **sums: str) -> DataFrame:
    """Rows of a written :func:`placed` table with sums over all rows before them, in file order.

    Each value is summed per block, then over the blocks before, then over the rows before it in its block.
    """
    per_block = aggregate(rows, ["_file", "_start"], *[f"sum({v}) AS _{n}" for n, v in sums.items()])
    earlier = "OVER (ORDER BY _file, _start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = per_block.selectExpr("_file", "_start", *[f"coalesce(sum(_{n}) {earlier}, 0) AS _{n}" for n in sums])
    inside = "OVER (PARTITION BY _file, _start ORDER BY _task_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return rows.join(carried, ["_file", "_start"]).selectExpr(
        *rows.columns, *[f"_{n} + coalesce(sum({v}) {inside}, 0) AS {n}" for n, v in sums.items()])
