"""Removal of repeated byte strings by suffix sorting.

Every window of ``length`` bytes is named by its least k-gram hash, the leftmost of equals: equal windows
have the same, at the same offset. Neighbouring windows with the same k-gram form a segment, and
segments meet others of the same hash by one shuffle. Equal segments repeat as a whole. Where
different segments share a hash, their texts are sorted by suffix, in batches of whole groups, and
windows that stand next to an equal one are repeated.

Suffixes are sorted by linear grouping: groups of suffixes with equal Lyndon prefixes are processed in
descending order; each suffix points to the nearest one before it in a lower group, and what
is pointed to leaves its group upwards. A last pass places the suffixes of each group in order.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.session import written


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 24
    #: Suffixes are sorted in batches of whole groups of about so many bytes.
    batch_bytes: int = 1 << 17
    #: Groups with more bytes than this are split by the windows' digests instead; that is exact too.
    group_bytes: int = 1 << 20


# ---------------------------------------------------------------- suffix sorting

def _numbers(values: np.ndarray) -> array:
    """Four bytes each, where a list takes up to forty."""
    return array("i", values.astype(np.int32).tobytes())


def suffix_array(text: list[int] | bytes) -> list[int]:
    """Starts of all suffixes in order; a suffix that is a beginning of another comes first."""
    return _suffixes(text).tolist()


def _suffixes(text: list[int] | bytes) -> array:
    n = len(text)
    if n == 0:
        return array("i")
    # Groups are ranges of ``order``; ``first[i]`` is where the group of suffix i begins.
    letters = np.frombuffer(text, np.uint8) if isinstance(text, bytes) else np.array(text)
    by_letter = np.argsort(letters, kind="stable")
    ordered = letters[by_letter]
    starts = np.concatenate([[0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1])
    lengths = np.diff(starts, append=n)
    sizes, places, firsts = np.zeros(n, np.int32), np.empty(n, np.int32), np.empty(n, np.int32)
    sizes[starts], places[by_letter], firsts[by_letter] = lengths, np.arange(n), np.repeat(starts, lengths)
    order, place, first, size = (_numbers(x) for x in (by_letter, places, firsts, sizes))
    lower = _numbers(np.full(n, -1))  # nearest suffix before it in a lower group
    end = n - 1
    while end >= 0:
        start = first[order[end]]
        group = order[start:end + 1]
        count: dict[int, int] = {}
        if len(group) == 1:
            i = group[0]
            p = i - 1
            while p >= 0 and place[p] > end:
                p = lower[p]
            lower[i] = p
            if p >= 0:
                count[p] = 1
        else:
            for i in sorted(group):  # from left to right, so a pointer inside the group is known already
                p = i - 1
                while p >= 0 and place[p] >= start:
                    p = lower[p]
                lower[i] = p
                if p >= 0:
                    count[p] = count.get(p, 0) + 1
        if len(count) == 1:
            moves = [list(count)]
        else:
            by_count: dict[int, list[int]] = {}
            for p, c in count.items():
                by_count.setdefault(c, []).append(p)
            moves = [by_count[c] for c in sorted(by_count, reverse=True)]
        for pointed in moves:
            # Those pointed to leave the upper end of their group, each group's together.
            left: dict[int, int] = {}
            for p in pointed:
                g = first[p]
                left[g] = taken = left.get(g, 0) + 1
                to, at = g + size[g] - taken, place[p]
                other = order[to]
                order[at], order[to] = other, p
                place[other], place[p] = at, to
            for g, taken in left.items():
                size[g] -= taken
                if size[g]:
                    size[g + size[g]] = taken
                else:
                    size[g] = taken
            for p in pointed:
                g = first[p]
                if place[p] >= g + size[g]:
                    first[p] = g + size[g]
        end = start - 1
    # Within its group a suffix stands as the one after its Lyndon prefix does.
    result, done = _numbers(np.zeros(n)), bytearray(n)
    filled: dict[int, int] = {}
    k, i = 0, n  # the empty suffix is the least of all
    while True:
        j = i - 1
        while j >= 0 and not done[j]:
            g = first[j]
            at = filled.get(g, g)
            result[at] = j
            filled[g] = at + 1
            done[j] = 1
            j = lower[j]
        if k == n:
            return result
        i = result[k]
        k += 1


# ---------------------------------------------------------------- segments

_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each position, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    out, width, have, base = None, 1, 0, _STEP
    n = len(data) - gram + 1
    while True:
        if gram & width:
            part = h[have:have + n]
            out = part.copy() if out is None else out * base + part
            have += width
        width *= 2
        if width > gram:
            break
        h = h[:-(width // 2)] * base + h[width // 2:]
        base = (np.array([base]) * base)[0]  # arrays wrap around without a warning
    out = (out ^ out >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ out >> np.uint64(32)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[:len(values) - (width - step)], values[width - step:]) if width > step else values


CHUNK = 1 << 19


def segments(data: bytes, how: Repeats) -> Iterator[tuple[int, int, int, int]]:
    """(start, windows, hash, gram) of each run of windows that share their least k-gram, which
    stands ``gram`` bytes after the start."""
    width = how.length - how.gram + 1
    at, limit = 0, len(data) - how.length + 1
    while at < limit:
        n = min(CHUNK, limit - at)
        h = gram_hashes(np.frombuffer(data, np.uint8, n + how.length - 1, at), how.gram)
        packed = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        least = sliding_least(packed, width)
        cuts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [n]])
        grams = (least[cuts[:-1]] & np.uint64((1 << 20) - 1)).astype(np.int64)
        yield from zip((cuts[:-1] + at).tolist(), np.diff(cuts).tolist(), h[grams].view(np.int64).tolist(),
                       (grams - cuts[:-1]).tolist())
        at += n


def text_sum(data: bytes) -> int:
    """What Spark's ``xxhash64`` gives for the text. Texts that share an id, NULL above all, are told apart by it:
    a crc32 repeats among some 77,000 of them, this among some five billion."""
    h = xxhash.xxh64_intdigest(data, 42)
    return h - (h >> 63 << 64)


def segment_rows(docs: DataFrame, how: Repeats) -> DataFrame:
    """(doc_id, crc, v, digest, a, n, g): all segments of all texts; a text is known by its id and a 64-bit checksum, ``crc``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                data = (text or "").encode("utf-8", "surrogatepass")
                if len(data) >= how.length:
                    crc, digest, rest = text_sum(data), xxhash.xxh3_64_intdigest, how.length - 1
                    rows += [(doc_id, crc, v, digest(data[a:a + n + rest]) - (1 << 63), a, n, g)
                             for a, n, v, g in segments(data, how)]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.int32()) for c in columns[5:]],
                names=["doc_id", "crc", "v", "digest", "a", "n", "g"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, crc long, v long, digest long, a long, n int, g int")


def contents(docs: DataFrame, wanted: DataFrame, how: Repeats) -> DataFrame:
    """(doc_id, crc, v, digest, a, n, g) -> (v, digest, g, content); each text is met once."""
    lists = wanted.groupBy("doc_id", "crc").agg(F.collect_list(F.struct("v", "digest", "a", "n", "g")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                rows += [(p["v"], p["digest"], p["g"], data[p["a"]:p["a"] + p["n"] + how.length - 1]) for p in parts]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["v", "digest", "g", "content"])

    found = with_parts(docs, lists).where("parts IS NOT NULL").select("text", "parts")
    return found.mapInArrow(run, "v long, digest long, g int, content binary").dropDuplicates(["v", "digest"])


def with_parts(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Documents with what ``lists`` (doc_id, crc, ...) has of them; merged at every size."""
    keyed = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("c", F.xxhash64("text"))
    return keyed.join(lists.hint("merge"), F.expr("id <=> doc_id AND c = crc"), "left")


FOUND = "v long, digest long, x int, y int"


def repeated_windows(held: list[tuple[int, int, int, bytes]], how: Repeats) -> list[tuple[int, int, int, int]]:
    """(v, digest, x, y): windows x..y-1 of a content that equal a window of another; what is held of
    a content begins at its byte ``shift``."""
    if not held:
        return []
    text = b"\0".join(c for *_, c in held)
    lengths = np.array([len(c) for *_, c in held])
    starts = np.cumsum(lengths + 1) - lengths - 1
    begins = np.zeros(len(text) + 1, bool)  # where a window of one content begins
    for a, n in zip(starts.tolist(), lengths.tolist()):
        begins[a:a + max(n - how.length + 1, 0)] = True
    order = np.frombuffer(_suffixes(text), np.int32)
    at = order[begins[order]]
    same = _same_as_next(text, at, how.length)
    places = np.unique(np.concatenate([at[:-1][same], at[1:][same]]))
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > 1) + 1  # contents stand farther apart
    x, y = places[np.concatenate([[0], cuts])], places[np.concatenate([cuts - 1, [-1]])] + 1
    owner = np.searchsorted(starts, x, side="right") - 1
    return [(held[k][0], held[k][1], held[k][2] + i, held[k][2] + j)
            for k, i, j in zip(owner.tolist(), (x - starts[owner]).tolist(), (y - starts[owner]).tolist())]


def _same_as_next(text: bytes, at: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows that begin at these bytes equal the one after them."""
    out = np.zeros(max(len(at) - 1, 0), bool)
    if len(out):
        windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), size)
        for k in range(0, len(out), 4096):
            some = windows[at[k:k + 4097]]
            out[k:k + 4096] = (some[1:] == some[:-1]).all(axis=1)
    return out


def _found_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["v", "digest", "x", "y"])


def _common(a: bytes, b: bytes) -> int:
    """How many bytes two strings begin with in common."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def _reach(parts: list[bytes]) -> list[int]:
    """The most bytes each string begins with in common with any other."""
    order = sorted(range(len(parts)), key=parts.__getitem__)
    most = [0] * len(parts)
    for i, j in zip(order, order[1:]):
        n = _common(parts[i], parts[j])
        most[i], most[j] = max(most[i], n), max(most[j], n)
    return most


def able(group: list[tuple[int, int, int, bytes]], how: Repeats) -> list[tuple[int, int, int, bytes]]:
    """(v, digest, shift, content): what of each content in a group could lie in a shared window.

    A window holds the gram, so equal windows agree to the left of it and to the right of it. No content reaches
    farther than it agrees with any other on that side, which is cut off, and what is left may be too short.
    """
    left = _reach([content[:g][::-1] for _, _, g, content in group])
    right = _reach([content[g + how.gram:] for _, _, g, content in group])
    return [(v, digest, g - a, content[g - a:g + how.gram + b])
            for (v, digest, g, content), a, b in zip(group, left, right) if a + how.gram + b >= how.length]


def sort_groups(texts: DataFrame, how: Repeats) -> DataFrame:
    """Groups within the bound, whole groups at a time, by suffix sorting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("v", "digest", "g", "content"))):
                if group and row[0] != group[0][0]:
                    whole = able(group, how)
                    held, size, group = held + whole, size + sum(len(c) for *_, c in whole), []
                    if size >= how.batch_bytes:
                        yield _found_batch(repeated_windows(held, how))
                        held, size = [], 0
                group.append(row)
        yield _found_batch(repeated_windows(held + able(group, how), how))

    return texts.repartition("v").sortWithinPartitions("v").mapInArrow(run, FOUND)


def count_windows(texts: DataFrame, how: Repeats) -> DataFrame:
    """Groups beyond the bound: their windows are counted by 128-bit digest, split over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(v, digest, x, xxhash.xxh3_128_digest(content[x:x + how.length]))
                    for v, digest, content in zip(*(batch.column(k).to_pylist() for k in ("v", "digest", "content")))
                    for x in range(len(content) - how.length + 1)]
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["v", "digest", "x", "w"])

    each = written(texts.mapInArrow(run, "v long, digest long, x int, w binary"))
    twice = each.groupBy("v", "w").agg(F.count("*").alias("times")).where("times > 1").select("v", "w")
    return each.join(twice, ["v", "w"]).selectExpr("v", "digest", "x", "x + 1 AS y")


# ---------------------------------------------------------------- the job

def shared_segments(segs: DataFrame) -> DataFrame:
    """Segments whose hash occurs twice or more. These hashes are written first: read from files, both sides of the
    join are plain shuffles, and Spark splits the rows of a very common hash over many tasks."""
    twice = written(segs.groupBy("v").agg(F.count("*").alias("m")).where("m > 1").select("v"))
    return segs.join(twice.hint("merge"), "v")


def repeated_spans(docs: DataFrame, how: Repeats) -> DataFrame:
    """(doc_id, crc, s, e): bytes s..e-1 of a text lie in windows that also start elsewhere."""
    shared = written(shared_segments(written(segment_rows(docs, how))))
    kinds = written(shared.groupBy("v", "digest").agg(
        F.count("*").alias("copies"), F.min(F.struct("doc_id", "crc", "a", "n", "g")).alias("one")))
    groups = kinds.groupBy("v").agg(F.count("*").alias("kinds"), F.sum(F.col("one.n") + how.length - 1).alias("bytes"))
    mixed = kinds.join(groups.where("kinds > 1").hint("merge"), "v").select("v", "digest", "one.*", "bytes")
    texts = written(contents(docs, mixed, how).join(groups.select("v", "bytes").hint("merge"), "v"))
    small, large = texts.where(f"bytes <= {how.group_bytes}").drop("bytes"), texts.where(f"bytes > {how.group_bytes}").drop("bytes")
    found = written(sort_groups(small, how).union(count_windows(large, how)))
    whole = kinds.where("copies > 1").selectExpr("v", "digest", "0 AS x", "one.n AS y")
    marks = whole.unionByName(found)
    return shared.join(marks.hint("merge"), ["v", "digest"]).selectExpr(
        "doc_id", "crc", "a + x AS s", f"a + y + {how.length - 1} AS e")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(data: bytes, parts) -> tuple[bytes, int, int]:
    """(what is left, removed bytes, maximal removed runs)."""
    kept, removed, spans, at, upto = [], 0, 0, 0, -1
    for s, e in sorted((p["s"], p["e"]) for p in parts or ()):
        if s > upto:  # not even touching the run before
            if upto >= 0:
                removed += upto - at
            kept.append(data[max(upto, 0):s])
            at, spans, upto = s, spans + 1, e
        upto = max(upto, e)
    if spans:
        removed += upto - at
    return b"".join(kept) + data[max(upto, 0):], removed, spans


def remove_repeats(docs: DataFrame, how: Repeats = Repeats()) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    NULL text is empty; texts shorter than a window keep all. Copies repeat each other and lose all
    their bytes, repeated rows among them. A NULL id is an id like any other. Only doc_id and text
    are read.
    """
    spans = repeated_spans(docs, how)
    lists = spans.distinct().groupBy("doc_id", "crc").agg(F.collect_list(F.struct("s", "e")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                data = text.encode("utf-8", "surrogatepass")
                kept, removed, n = _removed(data, parts)
                rows.append((len(data), removed, n, hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").cast(pa.int64()), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return with_parts(docs, lists).select("id", "text", "parts").mapInArrow(run, RESULT)
