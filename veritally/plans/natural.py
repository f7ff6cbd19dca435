"""The same kinds of check on tables that carry no planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritally.operators.copies import repeated_keys
from veritally.operators.frames import aggregate, stacked
from veritally.operators.members import mark_member, orphans
from veritally.plans.rules import EMAIL
from veritally.sources.driver_tables import table

# Child column -> parent key.
REFERENCES = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("labels", "doc_id", "documents", "doc_id"),
]


def duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def shipped_before_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS l_orderkey", "o_orderdate")
    return lines.join(orders, "l_orderkey").where("l_shipdate < o_orderdate").selectExpr(
        "l_orderkey", "l_linenumber", "CAST(l_shipdate AS DATE) AS ship_date", "CAST(o_orderdate AS DATE) AS order_date")


def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return orphans(orders.select("o_orderkey"), "o_orderkey", lines, "l_orderkey")


def negative_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked([
        table(spark, sf_dir, name).where(f"{p}_acctbal < 0").selectExpr(
            f"'{name}' AS tbl", f"{key} AS key", f"{p}_acctbal AS balance")
        for name, p, key in (("customer", "c", "c_custkey"), ("supplier", "s", "s_suppkey"))
    ])


def order_total_vs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = aggregate(table(spark, sf_dir, "lineitem"), ["l_orderkey AS o_orderkey"],
                      "sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS line_total")
    totals = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CAST(o_totalprice AS DECIMAL(18, 2)) AS order_total")
    return totals.join(lines, "o_orderkey", "left").where("NOT order_total <=> line_total")


def orphan_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and orphan rows per reference; children are counted per key before they join."""
    parts = []
    for child, column, parent, key in REFERENCES:
        per_key = aggregate(table(spark, sf_dir, child), [f"{column} AS key"], "count(*) AS n")
        marked = mark_member(per_key, "key", table(spark, sf_dir, parent), key, "known")
        lost = "CASE WHEN key IS NOT NULL AND NOT known THEN n END"
        totals = aggregate(marked, [], "coalesce(sum(n), 0) AS rows", f"coalesce(sum({lost}), 0) AS orphans")
        parts.append(totals.selectExpr(f"'{child}.{column} -> {parent}.{key}' AS reference", "rows", "orphans"))
    return stacked(parts)


def repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that occur more than once; only their digests are shuffled."""
    return repeated_keys(table(spark, sf_dir, "documents").selectExpr("md5(text) AS text_md5"), "text_md5")


def wrong_document_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "n_chars", "CAST(length(text) AS BIGINT) AS actual").where("n_chars <> actual")


def documents_with_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(f"text RLIKE r'{EMAIL}'").select("doc_id", "source")


def length_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: documents, those whose stated length is wrong or missing, and characters by either count."""
    docs = table(spark, sf_dir, "documents")
    return aggregate(docs, ["lang"], "count(*) AS documents", "count_if(NOT n_chars <=> CAST(length(text) AS BIGINT)) AS wrong",
                     "sum(n_chars) AS stated", "sum(CAST(length(text) AS BIGINT)) AS counted")
