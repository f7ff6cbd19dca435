"""Spelling variants: words one edit apart, found by PartEnum signatures.

A word is the binary vector of its letter multiset (the second 'e' of a word is a dimension of its own).
One inserted, deleted or replaced letter changes at most two dimensions. The dimensions are dealt into
``parts`` parts; of two vectors within a Hamming distance of two, at least ``parts`` - 2 parts agree in
full, so every choice of ``parts`` - 2 parts is enumerated and its projection is one exact signature.
Anagrams agree in all signatures. Therefore a signature also carries two of the three thirds of the word:
the third that the edit touches is left out, the other two are equal letter by letter. Words meet in an
equi-join on signatures and are verified by their edit distance there.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import written

DISTANCE = 2
#: Distinct words a task counts before it hands them on.
MOST_COUNTED = 1 << 18


@dataclass(frozen=True)
class Variants:
    #: Words of fewer code points or occurrences are not looked at.
    least_length: int = 6
    least_count: int = 5
    #: A form occurs so many times as often as its variant, at least.
    times: int = 5
    parts: int = 3


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of Latin letters of all texts, A-Z lower-cased, one code point deleted
    where the checksum of '<doc_id>:<run>' says so. A NULL doc_id is written as nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile("[a-zÀ-ÿ]+")
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not text:
                    continue
                # bytes.lower() changes A-Z alone.
                lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                upto = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for word, n in Counter(letters.findall(lowered)).items():
                    h = zlib.crc32(word.encode(), upto)
                    if h % 199 == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    counts[word] += n
                if len(counts) > MOST_COUNTED:
                    yield out()
                    counts.clear()
        yield out()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def part_of(letter: str, nth: int, parts: int) -> tuple[int, int]:
    """(part, hash) of one dimension."""
    h = xxhash.xxh64_intdigest(f"{letter}{nth}")
    return h % parts, h >> 8


def thirds(word: str, length: int) -> list[str]:
    """What is left of a word without its last, its first and its middle third, the thirds being those
    of the shorter word of a pair, of ``length`` letters."""
    third = -(-length // 3)
    return [word[:length - third], word[third - length:], word[:third] + word[-third:]]


def signatures(word: str, how: Variants) -> Iterator[tuple[int, int, int]]:
    """(signature, length of the shorter word it is meant for, third left out).

    A pair differs by at most one in length, so a word stands as the shorter one and as the longer one.
    """
    sums, seen = [0] * how.parts, Counter()
    for letter in word:
        seen[letter] += 1
        part, h = part_of(letter, seen[letter], how.parts)
        sums[part] += h
    for length in {len(word), max(len(word) - 1, how.least_length)}:
        for side, rest in enumerate(thirds(word, length)):
            for chosen in combinations(range(how.parts), how.parts - DISTANCE):
                at = " ".join([f"{p} {sums[p]}" for p in chosen])
                yield xxhash.xxh64_intdigest(f"{length} {side} {at} {rest}") - (1 << 63), length, side


def near_pairs(words: DataFrame, how: Variants) -> DataFrame:
    """(word, n) -> pairs (a, n_a, b, n_b), a before b, that differ by one edit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(word, n, *s) for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist())
                    for s in signatures(word, how)]
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
                names=["word", "n", "signature", "length", "side"])

    signed = words.select("word", "n").mapInArrow(run, "word string, n long, signature long, length int, side int")
    left = signed.select("signature", "length", "side", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = signed.select("signature", F.col("word").alias("b"), F.col("n").alias("n_b"))
    third = "CAST(ceil(length / 3) AS INT)"
    # A pair that meets under several thirds counts under the first of them.
    first = (f"(side = 0 OR left(a, length - {third}) <> left(b, length - {third})) AND "
             f"(side < 2 OR right(a, length - {third}) <> right(b, length - {third}))")
    near = f"a < b AND length = least(length(a), length(b)) AND levenshtein(a, b, 1) = 1 AND {first}"
    met = left.join(right.hint("merge"), (left["signature"] == right["signature"]) & F.expr(near))
    return met.select("a", "n_a", "b", "n_b").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root), by pointer doubling: a form occurs more often than its word, so
    there are no cycles and the number of steps is the logarithm of the longest chain."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        if stepped.where("next IS NOT NULL").isEmpty():
            return now
        now = stepped.drop("next")


def variant_groups(docs: DataFrame, how: Variants = Variants()) -> DataFrame:
    """Per word: word, n, n_near, form, form_n and root.

    Words are the distinct results of :func:`count_words` with at least ``least_length`` code points
    and ``least_count`` occurrences. The form of a word is its most frequent near word (ties: the
    first in code-point order), if it occurs ``times`` as often; the root is the end of the chain of
    forms. NULL and empty texts have no words; repeated rows count as often as they stand; an
    empty table gives no rows. Only doc_id and text are read.
    """
    words = written(count_words(docs).where(f"length(word) >= {how.least_length} AND n >= {how.least_count}"))
    pairs = near_pairs(words, how)
    both = pairs.selectExpr("a AS word", "n_b AS m", "b AS other").unionByName(
        pairs.selectExpr("b AS word", "n_a AS m", "a AS other"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    best = best.selectExpr("word", "n_near", "best.other AS _form", "-best.less AS _form_n")
    known = written(words.join(best, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0) AS n_near",
        f"CASE WHEN _form_n >= {how.times} * n THEN _form END AS form", f"CASE WHEN _form_n >= {how.times} * n THEN _form_n END AS form_n"))
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
