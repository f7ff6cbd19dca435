"""One id on a third of all rows: the plan stays the same and the result right."""

import pytest
from pyspark.sql import functions as F

from veritally.config import Runs
from veritally.operators.copies import mark_copies
from veritally.operators.members import mark_member, orphans
from veritally.operators.samples import first_n
from veritally.plans.pipeline import Pipeline
from veritally.plans.reconcile import Checks, Source
from veritally.plans.rules import findings
from veritally.sources.extract import Extract

ROWS = """
SELECT CASE WHEN id % 3 = 0 THEN {hot} WHEN id % 3 = 1 THEN concat('D', id div 30) ELSE concat('T', id) END AS txn_id,
       CAST({content} AS STRING) AS content, id % 7 AS ts
FROM range(3000)
"""


def rows(spark, hot, content):
    return spark.sql(ROWS.format(hot=hot, content=content)).repartition(6)


def counted(marked):
    return sorted((str(r.txn_id), r.ts, str(r.content), r.is_copy, r["count"])
                  for r in marked.groupBy("txn_id", "ts", "content", "is_copy").count().collect())


@pytest.mark.parametrize("hot", ["'HOT'", "NULL"])
@pytest.mark.parametrize("content", ["id", "'same'", "id % 5", "if(id % 4 = 0, NULL, id)"])
def test_copies_agree_with_one_window(spark, hot, content):
    given = rows(spark, hot, content)
    window = given.selectExpr("*", "row_number() OVER (PARTITION BY txn_id ORDER BY ts NULLS LAST, content NULLS LAST) > 1 AS is_copy")
    marked = mark_copies(given, "txn_id", ["ts", "content"])
    assert counted(marked) == counted(window)
    assert marked.where("NOT is_copy").count() == given.select("txn_id").distinct().count()


def shuffles(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning")


def test_a_hot_key_adds_no_shuffle(spark, no_broadcast):
    hot = mark_copies(rows(spark, "'HOT'", "id"), "txn_id", ["ts", "content"])
    even = mark_copies(rows(spark, "concat('H', id)", "id"), "txn_id", ["ts", "content"])
    assert shuffles(hot) <= shuffles(even) + 2
    plan = hot._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "NestedLoop" not in plan


@pytest.fixture
def no_broadcast(spark):
    """Plan as if no table were small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("known, hits", [([("HOT",), ("T2",)], 1001), ([("T2",)], 1), ([(None,)], 0)])
def test_large_member_lists_with_a_hot_key(spark, no_broadcast, known, hits):
    given = rows(spark, "'HOT'", "id")
    marked = mark_member(given, "txn_id", spark.createDataFrame(known * 2, "k string"), "k", "ok")
    assert marked.count() == 3000 and marked.where("ok").count() == hits
    assert marked.columns == [*given.columns, "ok"] or set(marked.columns) == {*given.columns, "ok"}


def test_pipeline_and_checks_where_nothing_is_small(spark, dirty, cfg, no_broadcast):
    """A third of the rows repeat one id on one account; every join is shuffled."""
    hot = dirty.transactions.where("status = 'SUCCESS' AND account_id LIKE 'ACC-0%'").orderBy("txn_id").limit(1)
    third = hot.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("again")
    skewed = Extract(**{**dirty._sources, "transactions": lambda: dirty.transactions.unionByName(third)})
    out = Pipeline(skewed, cfg, Runs.single())
    reasons = {r.reject_reason: r["count"] for r in out.quarantine.groupBy("reject_reason").count().collect()}
    assert reasons["DUPLICATE"] == 510
    results = Checks(Source(skewed, cfg), out).results().collect()
    assert len(results) == 7 and all(r.passed for r in results)
    assert findings(skewed, cfg).where("rule_id = 'UNQ-01'").count() in (10, 11)


def test_members_and_orphans_with_a_hot_key(spark):
    given = rows(spark, "'HOT'", "id")
    known = spark.createDataFrame([("HOT",), ("HOT",), (None,), ("T2",)], "k string")
    marked = mark_member(given, "txn_id", known, "k", "ok")
    assert marked.count() == 3000 and marked.where("ok").count() == 1001
    assert orphans(given, "txn_id", known, "k").count() == 1999


def test_samples_of_a_hot_group_are_limited_before_the_shuffle(spark):
    top = first_n(rows(spark, "'HOT'", "id"), "txn_id", "content", 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert top.where("txn_id = 'HOT'").count() == 3
