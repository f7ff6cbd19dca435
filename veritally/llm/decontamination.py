"""Benchmark decontamination over a positional inverted index.

Postings are (term, doc_id, pos). Of each test window (13 words, or a whole shorter item) the rarest
terms are looked up first: their postings, shifted by the term's offset, must meet at one start.
Where they do, the remaining words are compared at their positions. Only postings of terms that
are looked up are ever moved. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritally.session import written

#: Everything that is no digit, ASCII letter or character beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Search:
    window: int = 13
    #: So many of a window's rarest terms must meet before its other words are compared.
    rarest: int = 3
    #: Contaminated from this share of hit words on, in percent.
    least_percent: int = 5
    #: Term tables up to so many rows (of some 100 bytes) are broadcast; larger ones are joined by shuffle.
    broadcast_rows: int = 200_000


def lower_ascii(word: Column) -> Column:
    """A-Z only; for words of ASCII characters that is ``lower``."""
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(F.translate(word, UPPER, LOWER))


def tokens(rows: DataFrame, key: str) -> DataFrame:
    """(key, pos, term), one row per word; positions of neighbours are neighbours."""
    split = rows.select(F.col(key), F.posexplode(F.split(F.coalesce("text", F.lit("")), BETWEEN_WORDS)).alias("pos", "term"))
    return split.where("term <> ''").withColumn("term", lower_ascii(F.col("term")))


def text_id(doc_id: str | Column = "doc_id") -> Column:
    """What tells texts apart: the id and 128 bits of the text, so rows that repeat an id, or have none,
    stand for their own texts and equal rows for one."""
    return F.struct(doc_id, F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS), "")).cast("long")


def small(rows: DataFrame, search: Search) -> DataFrame:
    """A written table, marked for broadcast where its counted rows allow it."""
    return F.broadcast(rows) if rows.count() <= search.broadcast_rows else rows


def test_words(items: DataFrame) -> DataFrame:
    """(item, item_pos, n_item, term): the words of each distinct test item, numbered from 0.

    An item is (item_id, hash of its text); rows without an id are items that no list names.
    """
    found = tokens(items.select("item_id", "text").distinct().withColumn(
        "item", F.struct("item_id", F.xxhash64("text").alias("h"))), "item")
    numbered = found.selectExpr(
        "item", "CAST(row_number() OVER (PARTITION BY item ORDER BY pos) - 1 AS INT) AS item_pos",
        "CAST(count(*) OVER (PARTITION BY item) AS INT) AS n_item", "term")
    return numbered


def rarest_terms(words: DataFrame, frequency: DataFrame, search: Search) -> DataFrame:
    """(item, start, term, item_pos, needed): the rarest terms of each test window.

    Terms that occur nowhere are the rarest of all; a window with one has no match.
    """
    counted = words.join(frequency, "term", "left").na.fill(0, ["n"])
    last = f"greatest(n_item - {search.window}, 0)"
    windows = counted.selectExpr(
        "*", f"explode(sequence(greatest(item_pos - {search.window - 1}, 0), least(item_pos, {last}))) AS start")
    ranked = windows.selectExpr(
        "*", "row_number() OVER (PARTITION BY item, start ORDER BY n, item_pos) AS place",
        "min(n) OVER (PARTITION BY item, start) AS least")
    return ranked.where(f"place <= {search.rarest} AND least > 0").selectExpr(
        "item", "start", "term", "item_pos", f"least({search.rarest}, n_item) AS needed")


class PositionalIndex:
    """Postings of the training tokens that a set of test items can meet; ``doc_id`` is a :func:`text_id` in here."""

    def __init__(self, docs: DataFrame, items: DataFrame, search: Search = Search()):
        self.docs, self.search = docs.select(text_id().alias("doc_id"), "text"), search
        self.words = written(test_words(items))
        vocabulary = written(self.words.select("term").distinct())
        found = tokens(self.docs, "doc_id").select("term").join(small(vocabulary, search), "term")
        #: (term, n): how often each test term occurs in the corpus.
        self.frequency = written(found.groupBy("term").agg(F.count("*").alias("n")))
        self.wanted = written(rarest_terms(self.words, self.frequency, search))
        terms = small(written(self.wanted.select("term").distinct()), search)
        #: (term, doc_id, pos) of the terms that some window looks up.
        self.postings = written(tokens(self.docs, "doc_id").join(terms, "term").select("term", "doc_id", "pos"))

    def starts(self) -> DataFrame:
        """(item, doc_id, shift) where the rarest terms of some window all meet; the test item's
        word 0 would stand at ``shift``."""
        places = self.wanted.select("item", "start", "needed", "term", "item_pos")
        # Each (item, place) is looked up once, whatever the number of windows around it.
        lists = places.groupBy("term", "item", "item_pos").agg(F.collect_set(F.struct("start", "needed")).alias("windows"))
        met = self.postings.join(lists, "term").selectExpr("item", "doc_id", "pos - item_pos AS shift", "item_pos", "windows")
        each = met.selectExpr("item", "doc_id", "shift", "inline(windows)")
        full = each.groupBy("item", "doc_id", "shift", "start", "needed").count().where("count >= needed")
        return full.select("item", "doc_id", "shift").distinct()

    def matches(self) -> DataFrame:
        """(item, doc_id, shift, start, n): occurrences of whole test windows, ``n`` words from
        position ``shift + start`` of the document on."""
        starts = written(self.starts())
        ids = starts.select("doc_id").distinct()
        near = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
        wanted = starts.join(self.words, "item").selectExpr(
            "item", "doc_id AS at_doc", "shift", "item_pos", "n_item", "term AS at_term", "shift + item_pos AS at_pos")
        have = tokens(near, "doc_id").distinct()
        same = have.join(wanted, F.expr("doc_id <=> at_doc AND pos = at_pos AND term = at_term"))
        size = f"least(n_item, {self.search.window})"
        runs = same.selectExpr(
            "item", "doc_id", "shift", "item_pos AS start", f"{size} AS n",
            f"count(*) OVER (PARTITION BY item, doc_id, shift ORDER BY item_pos RANGE BETWEEN CURRENT ROW "
            f"AND {self.search.window - 1} FOLLOWING) AS found")
        return runs.where("found = n").drop("found")

    def proximity(self, within: int = 50) -> DataFrame:
        """(item, start, doc_id, digest, pos): the rarest terms of a test window, in any order, inside
        ``within`` words from ``pos`` on."""
        met = self.postings.join(self.wanted, "term").selectExpr(
            "item", "start", "needed", "doc_id", "pos", "term")
        span = (f"(PARTITION BY item, start, doc_id ORDER BY pos RANGE BETWEEN CURRENT ROW AND {within - 1} FOLLOWING)")
        distinct = self.wanted.groupBy("item", "start").agg(F.countDistinct("term").alias("terms"))
        near = met.join(distinct, ["item", "start"]).selectExpr(
            "item", "start", "doc_id", "pos", "terms", f"size(collect_set(term) OVER {span}) AS found")
        return near.where("found = terms").selectExpr("item", "start", "doc_id.*", "pos")


def contamination(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    NULL and wordless texts have no words and no hits; an item without words matches nothing. Rows
    that repeat an id, or have none, are judged by their own texts. Empty tables: without items
    nothing is hit; without documents there are no rows.
    """
    return judged(docs, items, search).drop("digest")


def judged(docs: DataFrame, items: DataFrame, search: Search) -> DataFrame:
    """The rows of ``contamination`` with the ``digest`` of their text."""
    matches = written(PositionalIndex(docs, items, search).matches())
    covered = matches.selectExpr("doc_id", "explode(sequence(shift + start, shift + start + n - 1)) AS pos").distinct()
    hits = covered.groupBy("doc_id").agg(F.count("*").alias("n_hit"))
    listed = matches.selectExpr("doc_id", "CAST(item.item_id AS STRING) AS item_id").where("item_id IS NOT NULL").distinct().groupBy("doc_id").agg(
        F.count("*").alias("n_items"),
        F.sha2(F.array_join(F.sort_array(F.collect_list("item_id")), ","), 256).alias("items_sha256"))
    found = hits.withColumnRenamed("doc_id", "_doc").join(listed, F.col("_doc").eqNullSafe(F.col("doc_id")), "left").drop("doc_id")
    counted = docs.select(text_id().alias("doc"), word_count(F.col("text")).alias("n_words"))
    rows = counted.join(written(found), F.col("doc").eqNullSafe(F.col("_doc")), "left").drop("_doc")
    none = F.sha2(F.lit(""), 256)
    return rows.select(
        "doc.doc_id", "doc.digest", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
    ).withColumn("contaminated", F.expr(f"n_hit > 0 AND 100 * n_hit >= {search.least_percent} * n_words"))


def keep_clean(docs: DataFrame, items: DataFrame, search: Search = Search()) -> DataFrame:
    """The documents that are not contaminated, with their own columns.

    Rows are judged by id and text. Of contaminated documents only id and digest are joined back, so clean
    texts are not shuffled for it where those fit the session's broadcast threshold.
    """
    bad = written(judged(docs, items, search).where("contaminated").selectExpr("struct(doc_id, digest) AS _bad").distinct())
    return docs.join(bad, text_id(docs["doc_id"]).eqNullSafe(bad["_bad"]), "left_anti")
