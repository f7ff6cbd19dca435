"""Quality scores by rule, dimension and day, and grading against the manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame

from veritally.config import Config
from veritally.functions.expressions import business_day, quoted, share, utc_timestamp
from veritally.operators.frames import aggregate, zero_if_null
from veritally.operators.samples import first_n, in_place
from veritally.plans.rules import DIMENSIONS, rule_table, table_counts
from veritally.sources.extract import Extract, copy_columns

# Findings of these rules fail a transaction row in the daily score.
TXN_ROW_RULES = ["VAL-01", "VAL-02", "INT-01"]


def rule_scores(raw: Extract, found: DataFrame) -> DataFrame:
    failed = aggregate(found, ["rule_id"], "count(*) AS failed")
    records = table_counts(raw, ["transactions", "customers", "accounts"])
    return (
        rule_table(found.sparkSession).join(records, "table").join(failed, "rule_id", "left")
        .selectExpr("rule_id", "dimension", "table", "description", "records", *zero_if_null("failed"))
        .selectExpr("*", f"{share('(records - failed) * 100', 'records', 2, 100.0)} AS pass_rate")
    )


def _mean(score: str) -> str:
    """Unweighted mean of scores already rounded to two places, rounded again."""
    return share(f"sum(CAST(round({score} * 100) AS BIGINT))", f"(count({score}) * 100)", 2, 100.0)


def dimension_scores(rules: DataFrame) -> DataFrame:
    names = rules.sparkSession.sql(f"SELECT explode(array({quoted(*DIMENSIONS)})) AS dimension")
    scored = names.join(rules.select("dimension", "pass_rate"), "dimension", "left")
    return aggregate(scored, ["dimension"], f"{_mean('pass_rate')} AS score")


def overall_score(dimensions: DataFrame) -> DataFrame:
    return aggregate(dimensions, [], f"{_mean('score')} AS score")


def daily_scores(raw: Extract, found: DataFrame, cfg: Config) -> DataFrame:
    """Per business day: rows, failed rows and score.

    A row passes when it is the first copy of its id and the id has no finding.
    So the passed rows of a day are the good ids whose first copy falls on it, and
    ids are reduced to one row each before anything is joined.
    """
    day = business_day(utc_timestamp("txn_ts"), cfg)
    # The first copy as the pipeline takes it; without an arrival order that is the earliest day.
    place = ", ".join(f"{c} IS NULL, {c}" for c in copy_columns("day", cfg.arrival))
    rows = raw.transactions.selectExpr("*", f"{day} AS day").selectExpr(
        "txn_id", "day", *([f"struct({place}) AS place"] if cfg.arrival else []))
    first = "min_by(day, place)" if cfg.arrival else "min(day)"
    bad = found.where(f"rule_id IN ({quoted(*TXN_ROW_RULES)})").selectExpr("key AS txn_id").distinct()
    good = aggregate(rows, ["txn_id"], f"{first} AS day").join(bad, "txn_id", "left_anti")
    return (
        aggregate(rows.where(f"day <= {cfg.as_of_date}"), ["day"], "count(*) AS rows")
        .join(aggregate(good, ["day"], "count(*) AS passed"), "day", "left")
        .selectExpr("day AS date", "rows", *zero_if_null("passed"))
        .selectExpr("date", "rows", "rows - passed AS failed", f"{share('passed * 100', 'rows', 2, 100.0)} AS score")
    )


def worst_day(daily: DataFrame) -> DataFrame:
    return daily.orderBy("score", "date").limit(1)


def expected_keys(manifest: DataFrame) -> DataFrame:
    """(rule_id, key) the rules should flag; a negative savings balance also breaks CON-02."""
    keys = manifest.select("rule_id", "key")
    return keys.unionByName(keys.where("rule_id = 'CON-01'").selectExpr("'CON-02' AS rule_id", "key"))


def grade(found: DataFrame, manifest: DataFrame) -> DataFrame:
    """Found against planted keys for all rules, with up to ten missed and false keys."""
    marked = found.selectExpr("rule_id", "key", "1 AS hit", "0 AS planted").unionByName(
        expected_keys(manifest).selectExpr("rule_id", "key", "0 AS hit", "1 AS planted"))
    keys = aggregate(marked, ["rule_id", "key"], "max(hit) AS hit", "max(planted) AS planted")
    totals = aggregate(keys, ["rule_id"], "sum(planted) AS expected", "sum(hit) AS found", "sum(hit * planted) AS hits")
    wrong = first_n(keys.where("hit <> planted"), "rule_id, hit", "key", 10)
    lists = aggregate(wrong, ["rule_id"], f"{in_place('key', 'hit = 0')} AS missed",
                      f"{in_place('key', 'hit = 1')} AS false_positives")
    none = "CAST(array() AS ARRAY<STRING>)"
    return (
        rule_table(found.sparkSession).join(totals, "rule_id", "left").join(lists, "rule_id", "left")
        .selectExpr("rule_id", *zero_if_null("expected", "found", "hits"), f"coalesce(missed, {none}) AS missed",
                    f"coalesce(false_positives, {none}) AS false_positives")
        .selectExpr("rule_id", "expected", "found", "missed", "false_positives",
                    f"{share('hits', 'found', 4, 1.0)} AS precision", f"{share('hits', 'expected', 4, 1.0)} AS recall")
    )


def exact_rules(graded: DataFrame) -> DataFrame:
    return aggregate(graded, [], "count_if(precision = 1 AND recall = 1) AS exact", "count(*) AS rules")
