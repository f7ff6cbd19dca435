"""Digest ranges find exactly the keys that a full comparison finds."""

import random
from collections import Counter

import pytest

from veritally.operators import difference
from veritally.operators.difference import differences, differing_ranges, opened, weighed


def sides(spark, left, right):
    schema = "k string, odd boolean"
    return spark.createDataFrame(left, schema).repartition(5), spark.createDataFrame(right, schema).repartition(3)


def keys(rng, n, share_lost=0.0, share_again=0.0):
    out = []
    for i in range(n):
        out += [(f"T{i}", i % 2 == 1)] * (0 if rng.random() < share_lost else 2 if rng.random() < share_again else 1)
    return out


@pytest.mark.parametrize("lost, again", [(0, 0), (0.002, 0), (0, 0.01), (0.3, 0.3)])
def test_the_same_keys_as_a_full_comparison(spark, lost, again):
    rng = random.Random(6)
    left, right = keys(rng, 4000), keys(rng, 4000, lost, again) + [("new", True)] * bool(lost)
    # A hot key and NULL, equal on both sides, then not.
    left += [("HOT", True)] * 2000 + [(None, False)] * 3
    right += [("HOT", True)] * (2000 if not again else 1999) + [(None, False)] * (3 if not lost else 2)
    l, r = sides(spark, left, right)
    ways = ["1", "IF(odd, 1, 0)"]
    got = {x.k: (x.l0, x.r0, x.l1, x.r1) for x in differences(l, r, "k", ways, ways).collect()}
    counts = [Counter(k for k, _ in left), Counter(k for k, _ in right), Counter(k for k, odd in left if odd), Counter(k for k, odd in right if odd)]
    want = {k: tuple(c[k] for c in counts) for k in counts[0] | counts[1] if counts[0][k] != counts[1][k] or counts[2][k] != counts[3][k]}
    assert got == want


def test_equal_sides_open_no_key(spark):
    l, r = sides(spark, keys(random.Random(1), 3000), keys(random.Random(1), 3000)[::-1])
    rows = weighed(l, r, "k", ["1"], ["1"])
    assert opened(rows, 1).isEmpty()
    # What moves: one row of sums per range and task.
    ranges = differing_ranges(rows, ["_range"], 1)
    assert ranges.isEmpty()


def test_few_differences_open_few_keys(spark):
    left = keys(random.Random(1), 20000)
    l, r = sides(spark, left, [x for x in left if x[0] not in ("T5", "T77")])
    assert opened(weighed(l, r, "k", ["1"], ["1"]), 1).count() <= 4
    assert {x.k for x in differences(l, r, "k", ["1"], ["1"]).collect()} == {"T5", "T77"}


def test_ranges_are_dealt_evenly(spark):
    l, r = sides(spark, keys(random.Random(2), 20000), [])
    sizes = weighed(l, r, "k", ["1"], ["1"]).groupBy("_range").count().agg({"count": "max", "_range": "count"}).first()
    assert sizes["max(count)"] < 40 and sizes["count(_range)"] > difference.RANGES * 0.9
