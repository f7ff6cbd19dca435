"""n-gram Jaccard join by MinHash banding.

Texts with the same words are one node with a number of copies. Nodes are shuffled on their band
hashes; nodes that share a band with others fall into candidate groups, and inside a group all pairs
are verified on their full sets of n-grams. Pairs are counted and merged where they are verified,
in blocks of bounded size; no pair leaves its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.common import words
from veritally.llm.components import connected_components
from veritally.session import written


@dataclass(frozen=True)
class JaccardJoin:
    words: int = 5
    #: A link is a Jaccard similarity of ``least_parts`` / ``of_parts`` or more.
    least_parts: int = 4
    of_parts: int = 5
    rows: int = 5
    #: A pair at the threshold shares a band with this probability.
    recall: float = 0.9999
    #: Larger groups are verified block by block.
    block_texts: int = 512
    block_bytes: int = 8 << 20

    @property
    def bands(self) -> int:
        """Bands needed for the recall: 1 - (1 - s^rows)^bands."""
        miss = 1 - (self.least_parts / self.of_parts) ** self.rows
        return int(np.ceil(np.log(1 - self.recall) / np.log(miss)))


MOST_CACHED = 1 << 19


class _WordHashes(dict):
    def __missing__(self, word):
        self[word] = number = xxhash.xxh64_intdigest(word)
        return number


@lru_cache(maxsize=1)
def _word_hashes() -> _WordHashes:
    return _WordHashes()


def shingles(texts: list[str], n: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """(words of each text, hashes of all n-grams, how many of them each text has).

    Words stand between ASCII white space. A text of fewer words has one n-gram of all, one
    without words none.
    """
    known = _word_hashes()
    if len(known) > MOST_CACHED:
        known.clear()
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    words = np.array([len(w) for w in split], np.int64)
    counts = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    at = np.fromiter((h for w in split for h in map(known.__getitem__, w)), np.uint64, int(words.sum()))
    if not len(at):
        return split, at, counts
    first = np.repeat(np.cumsum(words) - words, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    upto = np.repeat(np.cumsum(words), counts)
    out = np.zeros(len(first), np.uint64)
    for k in range(n):
        inside = first + k < upto
        word = np.where(inside, at[np.minimum(first + k, len(at) - 1)], np.uint64(0))
        out = (out ^ word) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return split, out, counts


def text_key(words: list[bytes]) -> bytes | None:
    return hashlib.md5(b" ".join(words)).digest() if words else None


def _factors(count: int) -> np.ndarray:
    rng = np.random.default_rng(1)
    return rng.integers(1 << 62, size=(2, count), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def fingerprints(docs: DataFrame, how: JaccardJoin) -> DataFrame:
    """(doc_id, key, n_bytes, bands): a digest of the words, and one hash per band. Texts without
    words have neither."""
    n, rows, bands = how.words, how.rows, how.bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, add = _factors(rows * bands)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            split, hashes, counts = shingles(texts, n)
            some = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[some]
            found = np.zeros((len(some), bands), np.uint64)
            for k in range(rows * bands if len(some) else 0):
                least = np.minimum.reduceat(hashes * odd[k] + add[k], starts)
                found[:, k // rows] = (found[:, k // rows] ^ (least ^ least >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            found = (found ^ found >> np.uint64(32)).view(np.int64)
            lists = dict(zip(some.tolist(), found))
            keys = list(map(text_key, split))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").cast(pa.int64()), pa.array(keys, pa.binary()),
                pa.array([sum(map(len, w)) for w in split], pa.int64()),
                pa.array([lists.get(i) for i in range(len(texts))], pa.list_(pa.int64())),
            ], names=["doc_id", "key", "n_bytes", "bands"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, key binary, n_bytes long, bands array<long>")


def verified(table: pa.Table, how: JaccardJoin) -> pa.Table:
    """One block pair of one group: links of each text inside it, and the least text it is
    connected with. Texts of block ``i`` meet those of block ``j``, or each other where i = j."""
    rows = {}
    for r in table.to_pylist():  # rows that repeat an id may bring another text under the key
        if r["key"] not in rows and text_key(r["text"].encode("utf-8", "surrogatepass").split()) == r["key"]:
            rows[r["key"]] = r
    seen = list(rows.values())
    texts = [r["text"] for r in seen]
    order = sorted(range(len(seen)), key=lambda i: seen[i]["key"])
    seen, texts = [seen[i] for i in order], [texts[i] for i in order]
    _, hashes, counts = shingles(texts, how.words)
    owner = np.repeat(np.arange(len(seen)), counts)
    pairs = np.unique(np.stack([owner.astype(np.uint64), hashes]), axis=1) if len(hashes) else np.zeros((2, 0), np.uint64)
    owner, hashes = pairs[0].astype(np.int64), pairs[1]
    sizes = np.bincount(owner, minlength=len(seen))
    _, column, times = np.unique(hashes, return_inverse=True, return_counts=True)
    common = times[column] > 1
    owner, column = owner[common], np.unique(column[common], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(seen), len(seen)), np.float32)
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((len(seen), width), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = (how.of_parts * both >= how.least_parts * union) & ~np.eye(len(seen), dtype=bool)
    side = np.array([r["block"] for r in seen])
    if len(seen) and seen[0]["i"] != seen[0]["j"]:
        linked &= side[:, None] != side[None, :]
    labels, old = np.arange(len(seen)), None
    while old is None or (old != labels).any():
        old = labels
        near = np.where(linked, labels[None, :], len(seen)).min(1, initial=len(seen))
        labels = np.minimum(labels, near)
        labels = labels[labels]
    links = linked @ np.array([r["copies"] for r in seen], np.int64) if len(seen) else []
    return pa.table({"key": pa.array([r["key"] for r in seen], pa.binary()),
                     "root": pa.array([seen[k]["key"] for k in labels], pa.binary()),
                     "n_links": pa.array([int(x) for x in links], pa.int64())})


def near_duplicates(docs: DataFrame, how: JaccardJoin = JaccardJoin()) -> DataFrame:
    """Per document: doc_id, class_id (the least id of its class), n_links (documents linked to it).

    Rows that repeat an id with another text are judged by their own text. Copies link to each other and share their text's links; they are counted, not expanded. A
    class is a connected component of links. A NULL or wordless text, or a row without an id, is
    linked to nothing: its class is its own id. Repeated rows count as copies. An empty table gives
    no rows. Only doc_id and text are read.
    """
    return judged_texts(docs, how).select("doc_id", "class_id", "n_links")


def judged_texts(docs: DataFrame, how: JaccardJoin) -> DataFrame:
    """The rows of ``near_duplicates`` with the key of their words and ``first``, the key of the text
    that stands for the class under ``class_id``."""
    prints = written(fingerprints(docs, how))
    named = prints.where("key IS NOT NULL AND doc_id IS NOT NULL")
    texts = written(named.groupBy("key").agg(
        F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("n_bytes").alias("n_bytes"),
        F.first("bands").alias("bands")))
    bands = texts.select("key", F.posexplode("bands").alias("band", "h"))
    shared = bands.groupBy("band", "h").agg(F.min("key").alias("leader"), F.count("*").alias("n")).where("n > 1")
    stars = bands.join(shared, ["band", "h"]).where("key <> leader").select("key", "leader")
    groups = written(connected_components(stars)).withColumnRenamed("node", "key")

    members = texts.drop("bands").join(groups, "key")
    sizes = members.groupBy("root").agg(F.expr(
        f"CAST(greatest(ceil(count(*) / {how.block_texts}), ceil(sum(n_bytes) / {how.block_bytes})) AS INT)").alias("blocks"))
    placed = written(members.join(sizes, "root").selectExpr(
        "doc", "key", "root", "copies", "blocks", "CAST(pmod(xxhash64(key), blocks) AS INT) AS block"))
    # Each text goes once to every block it has to meet.
    sent = placed.selectExpr("*", "explode(sequence(0, blocks - 1)) AS other").selectExpr(
        "doc", "key", "root", "copies", "block", "least(block, other) AS i", "greatest(block, other) AS j")
    read = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    # Merged at every size: a list of texts that happens to fit a broadcast does not change the plan.
    blocks = read.join(sent.hint("merge"), "doc").select("root", "i", "j", "block", "key", "copies", "text")
    found = written(blocks.groupBy("root", "i", "j").applyInArrow(
        lambda t: verified(t, how), "key binary, root binary, n_links long"))

    classes = written(connected_components(found.select("key", "root")))
    links = found.groupBy("key").agg(F.sum("n_links").alias("links"))
    known = texts.select("key", "doc", "copies").join(links, "key", "left").join(
        classes.withColumnRenamed("node", "key").withColumnRenamed("root", "class"), "key", "left")
    known = known.select("key", "doc", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                         F.coalesce("class", "key").alias("class"))
    least = known.groupBy("class").agg(F.min(F.struct("doc", "key")).alias("least")).selectExpr(
        "class", "least.doc AS class_id", "least.key AS first")
    judged = written(known.join(least, "class").select(F.col("key").alias("_key"), "class_id", "first", "n_links"))
    out = prints.join(judged, F.expr("key = _key AND doc_id IS NOT NULL"), "left")
    return out.select("doc_id", "key", "first", F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(docs: DataFrame, how: JaccardJoin = JaccardJoin()) -> DataFrame:
    """One document of each class, the one with the least id, with its own columns.

    Rows are judged by id and words: of rows that repeat both, one stays, and rows of one id with
    other words have a fate of their own. Of wordless rows that repeat an id and a text one stays;
    rows without an id all stay. The verdicts are reached without texts; these meet them in one join.
    """
    judged = judged_texts(docs, how).where("doc_id IS NOT NULL").groupBy("doc_id", "key").agg(
        F.count("*").alias("n"), F.max(F.expr("key IS NOT NULL AND (class_id <> doc_id OR key <> first)")).alias("__keep_lost"))
    told = written(judged.where("__keep_lost OR n > 1").select(F.col("doc_id").alias("__keep_id"), F.upper(F.hex("key")).alias("__keep_key"), "__keep_lost"))
    split = words(F.col("text"))
    # The same key as ``text_key`` gives; NULL without words.
    key = F.when(F.size(split) > 0, F.upper(F.md5(F.array_join(split, " ").cast("binary"))))
    met = docs.withColumn("__keep_own", key).join(
        told.hint("merge"), (F.col("doc_id") == F.col("__keep_id")) & F.col("__keep_own").eqNullSafe(F.col("__keep_key")), "left")
    once = met.where("__keep_lost IS NULL")
    twice = met.where("NOT __keep_lost").withColumn("__keep_wordless", F.when(F.col("__keep_own").isNull(), F.col("text"))).dropDuplicates(["doc_id", "__keep_own", "__keep_wordless"])
    return once.select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(twice.select(*[F.col(f"`{c}`") for c in docs.columns]))
