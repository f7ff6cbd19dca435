"""Helpers of the operators: words, let-bindings, cumulative picks, shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veritally.llm import files
from veritally.session import configure

#: Between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, and this package on the Python workers."""
    configure(spark)
    # Rows a Python worker holds at once: long texts must not add up.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    files.ship_package(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the optimizer inlines."""
    return F.transform(F.array(value), body)[0]


def pieces(text: Column, separator: str) -> Column:
    """The non-empty pieces between separators; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def words(text: Column) -> Column:
    return pieces(text, SPACES)


def unit_hash(*columns: Column | str) -> Column:
    """A number in [0, 1) that depends on the values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)) / F.lit(float(1 << 52))


def cumulative_pick(
    rows: DataFrame, group: str, place: str, size: str, quota: DataFrame, ties: list[str], nearest: bool,
    bins: int = 4096,
) -> DataFrame:
    """Add ``picked``: rows of each group in order of ``place`` until their sizes reach the quota.

    ``place`` lies in [0, 1). ``quota`` has (group, quota), a small table. Sizes are summed
    by bin, which map tasks reduce; whole bins below the quota are picked, and only the one
    bin in which the quota ends is ordered, by (place, ties). Its last row is picked if that
    brings the sum nearer to the quota. So a group of any size is spread over all tasks, as
    long as a ``bins``-th of it fits one. Groups compare null-safe.
    """
    binned = rows.withColumn("_bin", F.floor(F.col(place) * bins).cast("int"))
    upto = Window.partitionBy(group).orderBy("_bin")
    sums = binned.groupBy(group, "_bin").agg(F.sum(size).alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(upto) - F.col("_sum"))
    limits = quota.select(F.col(group).alias("_group"), F.col("quota").alias("_quota"))
    ends = (
        limits.join(sums, limits["_group"].eqNullSafe(sums[group]), "left")
        .groupBy("_group", "_quota")
        # The first bin that is not wholly below the quota, and what lies before it.
        .agg(F.min(F.when(F.col("_before") + F.col("_sum") > F.col("_quota"), F.struct("_bin", "_before"))).alias("_end"))
        .selectExpr("_group", "_quota", "_end._bin AS _end_bin", "_end._before AS _end_before")
    )
    marked = binned.join(ends, binned[group].eqNullSafe(ends["_group"]), "left")
    within = Window.partitionBy("_group", "_bin").orderBy(place, *ties).rowsBetween(Window.unboundedPreceding, -1)
    at_end = marked.where("_bin = _end_bin").withColumn(
        "_before_row", F.col("_end_before") + F.coalesce(F.sum(size).over(within), F.lit(0)))
    most = "2 * (_quota - _before_row)" if nearest else "_quota - _before_row"
    at_end = at_end.withColumn("picked", F.expr(f"{size} <= {most}"))
    others = marked.where("_bin IS DISTINCT FROM _end_bin").withColumn(
        "picked", F.expr("_quota IS NOT NULL AND (_end_bin IS NULL OR _bin < _end_bin)"))
    wanted = [*rows.columns, "picked"]
    return others.select(*wanted).unionByName(at_end.select(*wanted))
