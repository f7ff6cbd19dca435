"""Quality rules: hashed n-gram log-likelihood ratio between trusted text and the whole corpus.

Words and word pairs are hashed into ``buckets`` cells. Their counts over trusted documents and
over all documents give two smoothed multinomials; a document's score is the mean log ratio of its
n-grams. The bar is a low quantile of the trusted documents' own scores, each taken as if the document
itself were not trusted, for that is how unlabelled ones are met. Base rules come first.

DataFrame functions only. The model has ``buckets`` rows at most, whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import let, words
from veritally.session import written


#: Cells in one row of the table that each task looks ratios up in.
CELLS_A_ROW = 1 << 10

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio"]


@dataclass(frozen=True)
class QualityRules:
    buckets: int = 1 << 14
    smoothing: float = 1.0
    #: The bar is this quantile of the trusted documents' left-out scores; without it ``least_ratio``.
    trusted_quantile: float | None = None
    #: A fixed bar (nats per n-gram).
    least_ratio: float = -0.15
    least_words: int = 50
    most_repeated_percent: int = 50
    #: Up to so many ids of trusted documents (of some 25 bytes) are broadcast; more join by shuffle.
    broadcast_ids: int = 1 << 22


#: What the queries use: cells enough to tell words and pairs apart, a bar for each corpus.
PER_CORPUS = QualityRules(buckets=1 << 20, trusted_quantile=0.01)


def cell(buckets: int, *parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def window_hashes(word: Column) -> Column:
    """A hash of each 3-word window, in order."""
    return F.when(F.size(word) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(word) - 3), lambda i: F.xxhash64(word[i], word[i + 1], word[i + 2])))


def repeated_hashes(ordered: Column) -> Column:
    """Distinct values that stand twice or more in a sorted array."""
    return F.array_distinct(F.filter(ordered, lambda h, i: (i > 0) & (h == ordered[F.greatest(i - 1, F.lit(0))])))


def repeated_words(word: Column, hashes: Column, repeated: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Equal windows have equal hashes, so a text without a repeated hash has none. Otherwise the
    windows whose hash is repeated (all of them, where these hashes are many) are sorted by
    their words, neighbours compared, and the places of the truly repeated ones merged.
    """
    every = F.sequence(F.lit(0), F.size(word) - 3)
    places = F.when(F.size(repeated) > 64, every).otherwise(
        F.filter(every, lambda i: F.array_contains(repeated, hashes[i])))
    windows = F.sort_array(F.transform(places, lambda i: F.struct(
        word[i].alias("a"), word[i + 1].alias("b"), word[i + 2].alias("c"), i.alias("i"))))

    def twice(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        equal = lambda i, j: (ordered[i]["a"] == ordered[j]["a"]) & (ordered[i]["b"] == ordered[j]["b"]) & (
            ordered[i]["c"] == ordered[j]["c"])
        found = F.filter(F.sequence(F.lit(0), last),
                         lambda k: ((k > 0) & equal(k, F.greatest(k - 1, F.lit(0)))) | (
                             (k < last) & equal(k, F.least(k + 1, last))))
        return F.sort_array(F.transform(found, lambda k: ordered[k]["i"]))

    covered = F.aggregate(
        let(windows, lambda w: F.when(F.size(w) < 2, F.array().cast("array<int>")).otherwise(twice(w))),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return F.when(F.size(repeated) == 0, F.lit(0).cast("long")).otherwise(covered)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All documents labelled as good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def grams(rows: DataFrame, buckets: int, *carried: str) -> DataFrame:
    """(carried, cell): a row for each word and each pair of ``w``."""
    # Each word with its follower; the last has none.
    pairs = rows.selectExpr(*carried, "inline(arrays_zip(w, slice(w, 2, greatest(size(w) - 1, 0)))) AS (a, b)")
    cells = pairs.select(*carried, cell(buckets, F.col("a")).alias("single"),
                         F.when(F.col("b").isNotNull(), cell(buckets, F.col("a"), F.col("b"))).alias("pair"))
    return cells.select(*carried, F.explode(F.array("single", "pair")).alias("cell")).where("cell IS NOT NULL")


def cell_counts(docs: DataFrame, trusted: DataFrame, rules: QualityRules) -> DataFrame:
    """(cell, n_target, n_raw) over all documents; map tasks reduce to ``buckets`` rows each."""
    ids = trusted.select(F.col("doc_id").alias("_trusted"))
    ids = F.broadcast(ids) if ids.count() <= rules.broadcast_ids else ids
    rows = docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("_trusted"), "left")
    split = rows.select(F.col("_trusted").isNotNull().cast("long").alias("t"), words(F.col("text")).alias("w"))
    return grams(split, rules.buckets, "t").groupBy("cell").agg(F.sum("t").alias("n_target"), F.count("*").alias("n_raw"))


def log_ratios(counts: DataFrame, total_target: int, total_raw: int, rules: QualityRules) -> DataFrame:
    """(cell, ratio, left_out) of the cells met; ``left_out`` with one trusted occurrence less.
    Without trusted text all are 0."""
    s, total = rules.smoothing, rules.smoothing * rules.buckets
    if not total_target:
        return counts.selectExpr("cell", "0D AS ratio", "0D AS left_out")
    raw = f"ln((n_raw + {s}D) / ({total_raw} + {total}D))"
    return counts.selectExpr(
        "cell", f"ln((n_target + {s}D) / ({total_target} + {total}D)) - {raw} AS ratio",
        f"ln((greatest(n_target - 1, 0) + {s}D) / ({total_target} + {total}D)) - {raw} AS left_out")


def in_rows(ratios: DataFrame, buckets: int) -> DataFrame:
    """(part, ratios, left_outs): :func:`log_ratios` in arrays of ``CELLS_A_ROW`` cells in order, NULL for cells not met. So a
    cell takes 16 bytes where the table is broadcast, not the 75 of a row of its own."""
    cells = ratios.sparkSession.range(buckets).selectExpr("CAST(id AS INT) AS cell").join(ratios, "cell", "left")
    listed = cells.groupBy(F.expr(f"cell div {CELLS_A_ROW}").cast("int").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("cell", "ratio", "left_out"))).alias("of"))
    return listed.selectExpr("part", "of.ratio AS ratios", "of.left_out AS left_outs")


def digests(text: Column) -> list[Column]:
    """128 bits that stand for a text beside its id."""
    return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]


def text_scores(docs: DataFrame, labels: DataFrame, rules: QualityRules) -> tuple[DataFrame, float]:
    """(__id, __a, __b, __ratio) of each id and text with words, and the bar."""
    trusted = trusted_ids(labels)
    counts = written(cell_counts(docs, trusted, rules))
    target, raw = counts.agg(F.sum("n_target"), F.sum("n_raw")).first()
    ratios = F.broadcast(in_rows(log_ratios(counts, target or 0, raw or 0, rules), rules.buckets))  # 16 bytes a bucket
    a, b = digests(F.col("text"))
    w = docs.select(F.col("doc_id").alias("__id"), a.alias("__a"), b.alias("__b"), words(F.col("text")).alias("w"))
    w = w.withColumn("n", F.size("w"))
    met = grams(w, rules.buckets, "__id", "__a", "__b", "n").withColumn("part", F.expr(f"CAST(cell div {CELLS_A_ROW} AS INT)"))
    met = met.join(ratios, "part").selectExpr(
        "__id", "__a", "__b", "n", f"ratios[cell % {CELLS_A_ROW}] AS ratio", f"left_outs[cell % {CELLS_A_ROW}] AS left_out")
    scores = written(met.groupBy("__id", "__a", "__b").agg(
        F.avg("ratio").alias("__ratio"), F.avg("left_out").alias("left_out"), F.max("n").alias("n")))
    bar = rules.least_ratio
    if rules.trusted_quantile is not None:
        # The document's other n-grams are missing from the trusted total, too.
        s = rules.smoothing * rules.buckets
        long = scores.where(f"n >= {rules.least_words}").join(
            trusted.select(F.col("doc_id").alias("__id")), "__id", "left_semi")
        bar = long.agg(F.percentile_approx(
            F.expr(f"left_out - ln(greatest({target or 0}D - (2 * n - 1) + {s}D, {s}D) / ({target or 0}D + {s}D))"),
            rules.trusted_quantile, 100_000)).first()[0]
        bar = float("-inf") if bar is None else bar
    return scores.select("__id", "__a", "__b", "__ratio"), bar


def score_documents(docs: DataFrame, labels: DataFrame, rules: QualityRules = PER_CORPUS) -> DataFrame:
    """All columns of ``docs`` plus ``__quality``, a struct of counts, ratio and verdicts.

    NULL or wordless text: no words, ratio 0, rejected by the base rules. Repeated rows are scored
    alike. A document shorter than two words has no pairs. An empty corpus gives no rows, empty labels
    leave the base rules alone. Columns that start with two underscores are this function's own.
    """
    scores, bar = text_scores(docs, labels, rules)
    w = F.col("__w")
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    split = docs.withColumn("__w", words(F.col("text")))
    # A column per step: inside a lambda an inlined expression would be evaluated for each element.
    hashed = split.withColumn("__h", window_hashes(w)).withColumn("__s", F.sort_array("__h"))
    hashed = hashed.withColumn("__r", repeated_hashes(F.col("__s")))
    found = hashed.select(
        *docs.columns,
        F.size(w).cast("long").alias("__n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("__word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("__n_symbols"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("__n_dup_lines"),
        repeated_words(w, F.col("__h"), F.col("__r")).alias("__n_repeat_words"),
        F.col("doc_id").alias("__doc"), *[d.alias(f"__of_{n}") for d, n in zip(digests(F.col("text")), "ab")])
    # Copies of a text differ in their ids: no key of this join is common.
    found = found.join(scores, F.expr("__doc <=> __id AND __of_a = __a AND __of_b = __b"), "left").withColumn(
        "__ratio", F.coalesce("__ratio", F.lit(0.0)))
    failed = F.expr(f"__n_words < {rules.least_words} OR "
                    f"100 * __n_repeat_words > {rules.most_repeated_percent} * __n_words")
    counted = [F.col(f"__{n}").alias(n) for n in COUNTS]
    judged = F.struct(*counted, failed.alias("base_failed"),
                      (~failed & (F.col("__ratio") >= F.lit(bar))).alias("kept"))
    # Exploded, so that no filter on the verdict is pushed into the steps above.
    return found.select(*docs.columns, F.explode(F.array(judged)).alias("__quality"))


def keep_good(docs: DataFrame, labels: DataFrame, rules: QualityRules = PER_CORPUS) -> DataFrame:
    """The documents that pass, with their own columns, whatever these are called."""
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return score_documents(packed, labels, rules).where("__quality.kept").select("row.*")
