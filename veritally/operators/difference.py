"""Where two large multisets of keys differ, found through digests of key ranges.

Keys are dealt into ranges by their hash. Both sides are reduced to one order-free digest per range, the
right side counted negatively, which map tasks do before anything moves: the sides agree in a range
where all its sums are 0. Only ranges that differ are cut into finer ranges, and only keys
of fine ranges that still differ are compared one by one. Equal sides therefore shuffle a few numbers per
task, however many keys they have.

Several comparisons share the digests of the first one. Another comparison can differ from it only at keys with an
odd row, one that weighs otherwise there than in the first; the fine ranges of odd rows are opened without a digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.frames import aggregate

#: Ranges of the first level, and fine ranges in each of them; fine ranges are told by the bits of a word.
RANGES = 4096
FINE = 4096
WORD = 64

# A key's digest: two hashes, added up in halves that do not overflow below 2^31 keys a range.
PARTS = [part for h in ("xxhash64(_key)", "xxhash64('again', _key)") for part in (f"({h} & 4294967295)", f"shiftrightunsigned({h}, 32)")]


def weighed(left: DataFrame, right: DataFrame, key: str, left_weights: Sequence[str], right_weights: Sequence[str]) -> DataFrame:
    """Rows of both sides: key, ranges, and the weights w0, w1 ... with the right side's negative."""
    h = f"xxhash64('range', {key})"

    def side(rows: DataFrame, name: str, weights: Sequence[str], sign: str) -> DataFrame:
        return rows.selectExpr(
            f"{key} AS _key", f"'{name}' AS _side", f"CAST(pmod({h}, {RANGES}) AS INT) AS _range",
            f"CAST(pmod({h} div {RANGES}, {FINE}) AS INT) AS _fine", *[f"CAST({sign}({w}) AS BIGINT) AS w{i}" for i, w in enumerate(weights)])

    return side(left, "left", left_weights, "").unionByName(side(right, "right", right_weights, "-"))


def differing_ranges(rows: DataFrame, by: Sequence[str], comparisons: int) -> DataFrame:
    """The ranges in which the two sides differ by any of their weights."""
    sums = [f"sum(w{i}) <> 0 OR " + " OR ".join(f"sum(w{i} * {p}) <> 0" for p in PARTS) for i in range(comparisons)]
    return aggregate(rows, list(by), " OR ".join(sums) + " AS _differs").where("_differs").select(*by)


def opened(rows: DataFrame, comparisons: int) -> DataFrame:
    """The rows of :func:`weighed` in fine ranges that differ."""
    # At most RANGES short rows.
    inside = rows.join(F.broadcast(differing_ranges(rows, ["_range"], 1)), "_range", "left_semi")
    fine = differing_ranges(inside, ["_range", "_fine"], 1)
    if comparisons > 1:
        odd = " OR ".join(f"NOT w{i} <=> w0" for i in range(1, comparisons))
        fine = fine.unionByName(rows.where(odd).select("_range", "_fine"))
    words = aggregate(fine, ["_range", f"_fine div {WORD} AS _word"], f"bit_or(shiftleft(1L, _fine % {WORD})) AS _bits")
    # At most RANGES * FINE / WORD short rows, 262,144, however many keys there are: no key moves to be told.
    marked = rows.selectExpr("*", f"_fine div {WORD} AS _word").join(F.broadcast(words), ["_range", "_word"])
    return marked.where(f"getbit(_bits, _fine % {WORD}) = 1").select(*rows.columns)


def differences(left: DataFrame, right: DataFrame, key: str, left_weights: Sequence[str], right_weights: Sequence[str]) -> DataFrame:
    """(key, l0, r0, l1, r1 ...): keys that weigh differently on the two sides, with their weights.

    Weight i of a side is an SQL expression over its rows: how often the row counts in comparison i.
    Rows that weigh nothing need not differ. Keys compare null-safe.
    """
    n = len(left_weights)
    rows = opened(weighed(left, right, key, left_weights, right_weights), n)
    sums = [f"coalesce({sign}sum(w{i}) FILTER (WHERE _side = '{side}'), 0) AS {side[0]}{i}"
            for i in range(n) for side, sign in (("left", ""), ("right", "-"))]
    met = aggregate(rows, [f"_key AS {key}"], *sums)
    return met.where(" OR ".join(f"l{i} <> r{i}" for i in range(n)))
