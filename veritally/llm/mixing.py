"""Mixing sources to target weights by entropy balancing.

Each document gets a rate ``min(most_copies, exp(lambda * size))`` with one lambda per source: of
all rates within the cap that take the target's tokens, these diverge least from taking every
document once. Lambda solves the convex dual; Newton steps run as Spark jobs over the
counts of (source, size), which lose nothing and do not grow with copies, and a bracket around
the root catches steps that leave it. Rates are then rounded into whole copies.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import cumulative_pick, unit_hash, words
from veritally.session import written


@dataclass(frozen=True)
class Mix:
    #: Weights of the sources in code point order, NULL last, starting over after the last.
    weights: tuple[int, ...] = (5, 2, 1)
    #: No source's target, and no document, exceeds so many times its size.
    most_copies: int = 3
    #: Newton stops when every source is this near to its target.
    tolerance: float = 1e-6
    most_steps: int = 60


def with_size(docs: DataFrame, name: str = "size") -> DataFrame:
    return docs.withColumn(name, F.size(words(F.col("text"))).cast("long"))


def source_targets(totals: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size) -> with ``target``: shares by weight, capped, the excess reshared.

    Filling up by weight ends where each source holds its cap or ``weight * level``. In order of
    cap / weight the capped sources come first, so the level follows from running sums.
    """
    listed = ", ".join(map(str, mix.weights))
    ranked = totals.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.selectExpr(
        "*", f"element_at(array({listed}), CAST((place - 1) % {len(mix.weights)} AS INT) + 1) AS weight",
        f"{mix.most_copies} * source_size AS cap", "sum(source_size) OVER () AS total")
    order = "(ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    level = (f"(total - coalesce(sum(cap) OVER {order}, 0)) / "
             f"(sum(weight) OVER () - coalesce(sum(weight) OVER {order}, 0))")
    levels = ranked.selectExpr("*", f"{level} AS own_level")
    found = levels.selectExpr(
        "*", "min(CASE WHEN cap > weight * own_level THEN struct(cap / weight AS r, place, own_level) END) OVER () AS open")
    return found.selectExpr(
        "source", "source_size",
        "CAST(CASE WHEN cap <= weight * coalesce(open.own_level, own_level) OR open IS NULL "
        "THEN cap ELSE weight * open.own_level END AS DOUBLE) AS target")


def solve_dual(counts: DataFrame, targets: DataFrame, mix: Mix) -> DataFrame:
    """(source, size, n), (source, source_size, target) -> targets with ``lambda``.

    Each step is one job over the counts; only the worst distance comes to the driver.
    """
    most = mix.most_copies
    # The root lies between these: all sizes count 1 word at least.
    state = written(targets.selectExpr(
        "*", "IF(target < source_size, ln(target / source_size), 0D) AS lo",
        f"IF(target > source_size, ln({most}D), 0D) AS hi",
        f"IF(target >= {most} * source_size, ln({most}D), 0D) AS lambda").na.fill(0.0, ["lo"]))
    kept = targets.columns
    for _ in range(mix.most_steps):
        at = state.withColumnRenamed("source", "_source")
        each = counts.join(at, counts["source"].eqNullSafe(at["_source"]))
        sums = each.groupBy("_source").agg(
            F.expr(f"sum(n * size * least({most}D, exp(lambda * size)))").alias("taken"),
            F.expr(f"sum(IF(lambda * size < ln({most}D), n * size * size * exp(lambda * size), 0D))").alias("slope"))
        moved = state.join(sums, state["source"].eqNullSafe(sums["_source"]), "left").selectExpr(
            "*", "coalesce(taken, 0) - target AS off")
        moved = moved.selectExpr(
            "*", "IF(off < 0, lambda, lo) AS new_lo", "IF(off > 0, lambda, hi) AS new_hi",
            "lambda - off / nullif(slope, 0D) AS newton", "abs(off) / greatest(target, 1D) AS error")
        stepped = moved.selectExpr(
            *kept, "new_lo AS lo", "new_hi AS hi",
            f"CASE WHEN error <= {mix.tolerance} THEN lambda WHEN newton > new_lo AND newton < new_hi THEN newton "
            "ELSE (new_lo + new_hi) / 2 END AS lambda", "error")
        state = written(stepped)
        worst = state.agg(F.max("error")).first()[0]
        state = state.drop("error")
        if worst is None or worst <= mix.tolerance:
            break
    return state.select(*kept, "lambda")


def mix_documents(docs: DataFrame, mix: Mix = Mix(), size: str = "size") -> DataFrame:
    """All columns of ``docs`` (doc_id, source, a size column) plus source_size, target, copies.

    A copy count is the rate rounded down or up. Documents are rounded up in an order in which
    chance (a hash of the id) follows the rate's fraction, until the source reaches its target; a
    second round fits other documents, largest first, into what the first left open. Reruns agree. NULL is a source of its own. Documents of size 0 are taken
    once and change no sum. Repeated rows are documents of their own; where rows agree in id and
    size, which of them is rounded up makes no difference. An empty table gives an empty mix.
    Columns named like the added ones are replaced.
    """
    added = ["source_size", "target", "copies"]
    rows = docs.drop(*added)
    counts = written(rows.groupBy("source", F.col(size).alias("size")).agg(F.count("*").alias("n")))
    totals = counts.groupBy("source").agg(F.expr("sum(n * size)").alias("source_size"))
    solved = solve_dual(counts, written(source_targets(totals, mix)), mix)
    rate = f"least({mix.most_copies}D, exp(lambda * {{}}))"
    at = solved.withColumnRenamed("source", "_source")
    sure = counts.join(at, counts["source"].eqNullSafe(at["_source"])).groupBy("_source", "target").agg(
        F.expr(f"sum(n * size * floor({rate.format('size')}))").alias("sure"))
    quota = written(sure.selectExpr("_source AS source", "target - sure AS quota"))

    rated = rows.join(at, rows["source"].eqNullSafe(at["_source"])).selectExpr(
        *[f"`{c}`" for c in rows.columns], "source_size", "target", f"{rate.format(f'`{size}`')} AS _rate")
    rated = rated.withColumn("_whole", F.floor("_rate")).withColumn("_part", F.expr("_rate - _whole"))
    rated = rated.withColumn("_place", F.least(
        (F.lit(2.0) - F.col("_part") - unit_hash("doc_id")) / 2, F.lit(1 - 1e-12)))
    open_ = f"_part > 0 AND `{size}` > 0"
    shut = rated.where(f"NOT ({open_})").withColumn("picked", F.lit(False))
    # First whole documents up to the quota, then of the others the largest that fit what is left.
    first = written(cumulative_pick(rated.where(open_), "source", "_place", size, quota, ["doc_id", size], False))
    used = first.where("picked").groupBy(F.col("source").alias("_source")).agg(F.sum(size).alias("_used"))
    left = written(quota.join(used, F.col("source").eqNullSafe(F.col("_source")), "left").selectExpr(
        "source", "quota - coalesce(_used, 0) AS quota"))
    limit = left.selectExpr("source AS _source", "quota AS _left")
    rest = first.where("NOT picked").drop("picked").join(limit, F.col("source").eqNullSafe(F.col("_source")))
    fits = rest.where(f"`{size}` <= _left").withColumn("_place", F.expr(f"1 - `{size}` / (_left + 1)")).drop("_source", "_left")
    over = rest.where(f"`{size}` > _left").drop("_source", "_left").withColumn("picked", F.lit(False))
    second = cumulative_pick(fits, "source", "_place", size, left, ["doc_id", size], True)
    both = reduce(DataFrame.unionByName, [first.where("picked"), second, over, shut])
    return both.select(*rows.columns, "source_size", "target",
                       (F.col("_whole") + F.col("picked").cast("int")).cast("int").alias("copies"))


def mixed_rows(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Each row of ``docs``, all its columns unchanged, as many times as the mix takes it.

    The mix looks at ids, sources, sizes and a digest of the row; the rows themselves move once, to meet
    their number of copies. Rows that agree in all columns are one row with all their copies.
    """
    row_digest = F.unhex(F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))))
    light = docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), row_digest.alias("row"))
    mixed = mix_documents(written(light), mix)
    copies = written(mixed.groupBy(F.col("row").alias("__mix_row")).agg(F.sum("copies").alias("__mix_copies")).where("__mix_copies > 0"))
    # Merged at every size, so that a table of copies which happens to fit a broadcast does not change the plan.
    met = docs.withColumn("__mix_at", row_digest).join(copies.hint("merge"), F.col("__mix_at") == F.col("__mix_row"))
    one = met.dropDuplicates(["__mix_at"])
    return one.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.expr("sequence(1, CAST(__mix_copies AS INT))")).alias("__mix_copy")).drop("__mix_copy")
