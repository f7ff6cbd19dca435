"""Token-ID output as Re-Pair grammars.

Documents are tokenized in ascending id order and written in blocks of bounded size. In a block,
frequent neighbouring pairs of ids are replaced by new symbols, round after round, never across the
end of a document. A block file holds the rules, the length each rule expands to, the remaining
symbols, and where each document starts among them, so that one document, or one id in it, is
decoded without the rest.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm import files
from veritally.session import written


@dataclass(frozen=True)
class Encoding:
    tokenizer: str
    end_id: int = 1
    #: A block is closed with the document that fills it to so many ids.
    block_ids: int = 1 << 21
    rounds: int = 6
    pairs_per_round: int = 2048
    least_count: int = 32


# ---------------------------------------------------------------- tokens

# How the word-piece vocabulary splits text, and characters for which Python's lower()
# and these patterns are known to agree with the library. Other texts are left to the library.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
USUAL = bytes([9, 10, 13, *range(32, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])
# Of each usual character: its lower case, and 0 for a space, 1 for a letter, 2 for a digit, 3 for others.
LOWER = bytes(ord(chr(i).lower()) if i in USUAL else i for i in range(256))
KINDS = bytes(0 if chr(i).isspace() else 1 if chr(i).isalpha() else 2 if chr(i).isdigit() else 3 for i in range(256))
MOST_CACHED = 1 << 19


class _Places(dict):
    """Numbers its keys as they come."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def is_usual(text: str) -> bool:
    try:
        return "<|" not in text and not text.encode("latin-1").translate(None, USUAL)
    except UnicodeEncodeError:
        return False


def split(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first bytes, lengths) of the pieces of usual characters in lower case that end with three spaces: runs of letters,
    single digits, runs of others, and 's 't 'm 'd 're 've 'll where nothing of a run stands before them."""
    letters, kinds = np.frombuffer(data, np.uint8), np.frombuffer(data.translate(KINDS), np.uint8)
    edges = np.ones(len(data), bool)
    np.not_equal(kinds[1:], kinds[:-1], out=edges[1:])
    edges |= kinds == 2
    quotes = np.flatnonzero(letters == ord("'"))
    quotes = quotes[edges[quotes]]
    one, two = letters[quotes + 1], letters[quotes + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for n, at in ((2, quotes[short]), (3, quotes[long])):
        edges[at + 1] = False
        edges[at + n] = True
    at = np.flatnonzero(edges)
    lengths = np.diff(at, append=len(data))
    pieces = np.flatnonzero(kinds.take(at))
    return at.take(pieces), lengths.take(pieces)


#: For each number of bytes, a mask of the first so many of eight.
FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Known:
    """Numbers of the pieces of up to 16 bytes, which stand as two words of eight: open addressing, many at once."""

    def __init__(self, bits: int = 16):
        self.bits, self.n = bits, 0
        self.one, self.two, self.number = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int64)

    def _places(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        h = one * np.uint64(0x9E3779B97F4A7C15) + two * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(64 - self.bits)).astype(np.intp)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The number of each, -1 of those that are not known."""
        place = self._places(one, two)
        out = self.number.take(place)
        left = np.flatnonzero(((self.one.take(place) != one) | (self.two.take(place) != two)) & (out >= 0))
        place = place.take(left)
        while len(left):
            place = place + 1 & len(self.number) - 1
            out[left] = self.number.take(place)
            more = np.flatnonzero(((self.one.take(place) != one.take(left)) | (self.two.take(place) != two.take(left))) & (out.take(left) >= 0))
            left, place = left.take(more), place.take(more)
        return out

    def add(self, one: np.ndarray, two: np.ndarray, number: np.ndarray):
        """Know these as well, none of them known and all different."""
        if 4 * (self.n + len(number)) > len(self.number):
            held = np.flatnonzero(self.number >= 0)
            one, two, number = (np.concatenate([x.take(held), y]) for x, y in ((self.one, one), (self.two, two), (self.number, number)))
            self.__init__((4 * len(number)).bit_length())
        self.n += len(number)
        place = self._places(one, two)
        while len(number):
            free = np.flatnonzero(self.number.take(place) < 0)
            self.number[place[free]] = number[free]
            mine = self.number.take(place) == number
            self.one[place[mine]], self.two[place[mine]] = one[mine], two[mine]
            one, two, number, place = one[~mine], two[~mine], number[~mine], place[~mine] + 1 & len(self.number) - 1


class Grown:
    """An array that grows at its end in amortized time."""

    def __init__(self, kind):
        self.held, self.n = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray):
        if self.n + len(values) > len(self.held):
            more = np.zeros(max(2 * len(self.held), self.n + len(values)), self.held.dtype)
            more[:self.n] = self.held[:self.n]
            self.held = more
        self.held[self.n:self.n + len(values)] = values
        self.n += len(values)


class Tokens:
    """Ids of many texts at once; pieces seen before are looked up, not encoded again."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0].get("pattern", {}).get("Regex")
        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        suffix = (spec.get("model") or {}).get("end_of_word_suffix")
        self.by_piece = split == PIECE_PATTERN and steps == ["NFC", "Replace", "Lowercase"] and suffix == "</w>"
        if self.by_piece:  # pieces are split and in lower case already
            spec["normalizer"], spec["pre_tokenizer"]["pretokenizers"][0] = None, {"type": "WhitespaceSplit"}
        self.of_pieces = Tokenizer.from_str(json.dumps(spec))
        self.size = self.of_pieces.get_vocab_size()
        ends = [i for t, i in self.of_pieces.get_vocab().items() if t.endswith("</w>")]
        self.ends_piece = np.zeros(self.size, bool)
        self.ends_piece[ends] = True
        self._hold([], np.zeros(0, np.int64), np.zeros(0, np.uint32))

    @cached_property
    def tokenizer(self):
        """For whole texts; few tasks meet one that needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def _hold(self, pieces: list[str], length: np.ndarray, ids: np.ndarray):
        """Know these pieces alone, of so many ids each."""
        self.places, self.flat = _Places(zip(pieces, range(len(pieces)))), Grown(np.uint32)
        self.first, self.length, self.again = Grown(np.int64), Grown(np.int64), Grown(bool)
        self.flat.add(ids)
        self.length.add(length)
        self.first.add(np.cumsum(length) - length)
        self.again.add(np.zeros(len(pieces), bool))
        self.known = Known()

    def _forget(self):
        """Keep the pieces that were met again since they were learnt or kept, half of what is held at most."""
        keep = np.flatnonzero(self.again.held[:self.again.n])[:MOST_CACHED // 2]
        length, pieces = self.length.held[keep], list(self.places)
        at = np.repeat(self.first.held[keep] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        self._hold([pieces[i] for i in keep.tolist()], length, self.flat.held[at])

    def _learn(self):
        """Encode the pieces numbered since the last call, all in one string."""
        n_new = len(self.places) - self.first.n
        if not n_new:
            return
        new = list(islice(reversed(self.places), n_new))[::-1]
        # Without offsets, which nothing here reads.
        ids = np.array(self.of_pieces.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, np.uint32)
        last = np.flatnonzero(self.ends_piece[ids])
        if len(last) != n_new:
            raise ValueError("a piece was not encoded on its own")
        length = np.diff(last, prepend=-1)
        self.first.add(self.flat.n + last + 1 - length)
        self.length.add(length)
        self.flat.add(ids)
        self.again.add(np.zeros(n_new, bool))

    def _numbers(self, data: bytes, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number of each piece of the bytes, which end with 16 that belong to none."""
        words = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
        one = words[at] & FIRST_BYTES.take(np.minimum(lengths, 8))
        two, more = np.zeros(len(at), np.uint64), np.flatnonzero(lengths > 8)
        two[more] = words[at[more] + 8] & FIRST_BYTES.take(np.minimum(lengths[more] - 8, 8))
        out = self.known.find(one, two)
        long, new = np.flatnonzero(lengths > 16), np.flatnonzero((out < 0) & (lengths <= 16))
        # Each piece that was not met yet once; those too long for two words each time.
        new = new[np.lexsort((two[new], one[new]))]
        first = np.ones(len(new), bool)
        first[1:] = (one[new[1:]] != one[new[:-1]]) | (two[new[1:]] != two[new[:-1]])
        firsts = new[first]
        for some in (long, firsts):
            out[some] = [self.places[data[a:a + n].decode("latin-1")] for a, n in zip(at[some].tolist(), lengths[some].tolist())]
        self.known.add(one[firsts], two[firsts], out[firsts])
        out[new] = out[firsts][np.cumsum(first) - 1]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each text)."""
        usual = [self.by_piece and is_usual(t) for t in texts]
        if len(self.places) > MOST_CACHED:
            self._forget()
        found = [t.encode("latin-1") if ok else b"" for t, ok in zip(texts, usual)]
        data = b"\n".join([*found, b"\n" * 16]).translate(LOWER)
        starts, sizes = split(data)
        at = self._numbers(data, starts, sizes)
        self.again.held[at[at < self.first.n]] = True
        self._learn()
        lengths = self.length.held.take(at)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        place = np.repeat(self.first.held.take(at) - bounds[:-1], lengths)
        place += np.arange(bounds[-1])
        ids = self.flat.held.take(place)
        pieces = np.searchsorted(starts, np.cumsum([0] + [len(x) + 1 for x in found]))
        counts = np.diff(bounds[pieces])
        if all(usual):
            return ids, counts
        parts, cut = [], np.cumsum(counts)
        for i, ok in enumerate(usual):
            part = ids[cut[i] - counts[i]:cut[i]] if ok else np.array(
                self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32)
            counts[i] = len(part)
            parts.append(part)
        return np.concatenate(parts), counts


@lru_cache(maxsize=1)
def tokens_of(path: str) -> Tokens:
    """One per Python worker: what it has learnt serves later tasks."""
    return Tokens(path)


# ---------------------------------------------------------------- grammar

#: Cells that pairs are counted in first; one more takes the pairs across documents, which count nowhere.
CELLS = 1 << 18


def frequent_pairs(symbols: np.ndarray, ends: np.ndarray, most: int, least: int) -> np.ndarray:
    """Keys (left << 32 | right) of the most frequent pairs inside documents, most frequent first.

    Counts of hashed pairs leave few candidates; those are counted exactly.
    """
    cells = (symbols[:-1] * np.uint32(0x9E3779B1) + symbols[1:] * np.uint32(0x85EBCA77) >> np.uint32(14)).astype(np.intp)
    cells[np.flatnonzero(ends[:-1])] = CELLS
    counts = np.bincount(cells, minlength=CELLS + 1)
    counts[CELLS] = 0
    bar = max(least, int(np.partition(counts, -4 * most)[-4 * most]))
    able = np.flatnonzero((counts >= bar).take(cells))
    keys = symbols.take(able).astype(np.uint64) << np.uint64(32) | symbols.take(able + 1).astype(np.uint64)
    found, n = np.unique(keys, return_counts=True)
    found, n = found[n >= least], n[n >= least]
    return found[np.lexsort((found, -n))][:most]


def numbered(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, the number from 1 of each of them in a table of ``size``, where all others have 0)."""
    distinct = np.unique(values)
    table = np.zeros(size, np.int32)
    table[distinct] = np.arange(1, len(distinct) + 1)
    return distinct, table


def compress(ids: np.ndarray, ends: np.ndarray, vocabulary: int, how: Encoding):
    """(left, right) of the rules and the remaining symbols; ``ends`` marks last ids of documents."""
    symbols, ends, left, right = ids.astype(np.uint32), ends.copy(), [], []
    size = vocabulary
    for _ in range(how.rounds):
        if len(symbols) < 2:
            break
        chosen, starts, seconds = [], set(), set()
        for key in frequent_pairs(symbols, ends, how.pairs_per_round, how.least_count).tolist():
            a, b = key >> 32, key & 0xFFFFFFFF
            # No symbol both opens one chosen pair and closes another: their places cannot overlap.
            if a != b and a not in seconds and b not in starts:
                starts.add(a)
                seconds.add(b)
                chosen.append(key)
        if not chosen:
            break
        keys = np.sort(np.array(chosen, np.uint64))
        first, second = (keys >> np.uint64(32)).astype(np.uint32), (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        (openers, opens), (closers, closes) = numbered(first, size), numbered(second, size)
        # The rule of each opener and closer, 0 where the two are no chosen pair.
        rules = np.zeros((len(openers) + 1) * (len(closers) + 1), np.int32)
        rules[opens[first] * (len(closers) + 1) + closes[second]] = np.arange(1, len(keys) + 1)
        places = symbols.astype(np.intp)
        at = np.flatnonzero((opens > 0).take(places[:-1]) & (closes > 0).take(places[1:]) & ~ends[:-1])
        rule = rules.take(opens.take(places.take(at)) * np.intp(len(closers) + 1) + closes.take(places.take(at + 1)))
        met = np.flatnonzero(rule > 0)
        at, rule = at.take(met), rule.take(met)
        symbols[at] = size - 1 + rule
        ends[at] = ends.take(at + 1)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        kept = np.flatnonzero(keep)
        symbols, ends = symbols.take(kept), ends.take(kept)
        left.append(first)
        right.append(second)
        size += len(keys)
    none = np.zeros(0, np.uint32)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), symbols, ends


def expansion_lengths(left: np.ndarray, right: np.ndarray, vocabulary: int) -> np.ndarray:
    lengths = np.ones(vocabulary + len(left), np.int64)
    done, n = 0, len(left)
    while done < n:  # rules of one round refer to earlier rounds only
        ready = done + np.flatnonzero((left[done:] >= vocabulary + done) | (right[done:] >= vocabulary + done))[:1]
        upto = int(ready[0]) if len(ready) else n
        lengths[vocabulary + done:vocabulary + upto] = lengths[left[done:upto]] + lengths[right[done:upto]]
        done = upto
    return lengths


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, vocabulary: int) -> np.ndarray:
    while len(symbols) and (rule := symbols >= vocabulary).any():
        at = np.cumsum(1 + rule) - 1 - rule
        out = np.empty(len(symbols) + int(rule.sum()), np.uint32)
        out[at] = symbols
        of = symbols[rule] - vocabulary
        out[at[rule]], out[at[rule] + 1] = left[of], right[of]
        symbols = out
    return symbols


# ---------------------------------------------------------------- files

MAGIC = b"RPG1"
HEADER = struct.Struct("<4sIIIQQI")  # magic, vocabulary, rules, documents, symbols, ids, bytes a symbol


def write_block(stream, doc_ids: list, ids: np.ndarray, counts: np.ndarray, vocabulary: int, how: Encoding) -> int:
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    left, right, symbols, ends = compress(ids, ends, vocabulary, how)
    starts = np.concatenate([[0], np.flatnonzero(ends) + 1]).astype("<u8")
    width = 2 if vocabulary + len(left) <= 1 << 16 else 4
    parts = [
        HEADER.pack(MAGIC, vocabulary, len(left), len(counts), len(symbols), len(ids), width),
        left.astype("<u4"), right.astype("<u4"), expansion_lengths(left, right, vocabulary)[vocabulary:].astype("<u4"),
        np.array([d or 0 for d in doc_ids], "<i8"), np.array([d is None for d in doc_ids], "u1"), starts,
        symbols.astype(f"<u{width}"),
    ]
    return sum(stream.write(p if isinstance(p, bytes) else p.tobytes()) for p in parts)


class Block:
    """A block file; documents and single ids are decoded on demand."""

    def __init__(self, data: bytes):
        magic, self.vocabulary, rules, n, symbols, self.n_ids, width = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("no block file")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.left, self.right, lengths = take("<u4", rules), take("<u4", rules), take("<u4", rules)
        ids, null = take("<i8", n), take("u1", n).astype(bool)
        self.doc_ids = pa.array(ids, mask=null)
        self.starts = take("<u8", n + 1).astype(np.int64)
        self.symbols = take(f"<u{width}", symbols).astype(np.uint32)
        self.lengths = np.concatenate([np.ones(self.vocabulary, np.int64), lengths])

    def document(self, k: int) -> np.ndarray:
        return expand(self.symbols[self.starts[k]:self.starts[k + 1]], self.left, self.right, self.vocabulary)

    def token(self, k: int, i: int) -> int:
        """The ``i``-th id of document ``k``, by way of the lengths alone."""
        own = self.symbols[self.starts[k]:self.starts[k + 1]]
        upto = np.cumsum(self.lengths[own])
        at = int(np.searchsorted(upto, i, side="right"))
        symbol, i = int(own[at]), i - (int(upto[at - 1]) if at else 0)
        while symbol >= self.vocabulary:
            a, b = int(self.left[symbol - self.vocabulary]), int(self.right[symbol - self.vocabulary])
            symbol, i = (a, i) if i < self.lengths[a] else (b, i - int(self.lengths[a]))
        return symbol

    def expanded(self) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each document starts among them and the last one ends)."""
        # Each symbol's ids once, one after the other; the block is put together from these.
        flat = expand(np.arange(len(self.lengths), dtype=np.uint32), self.left, self.right, self.vocabulary)
        first, symbols = np.cumsum(self.lengths) - self.lengths, self.symbols.astype(np.intp)
        lengths = self.lengths.take(symbols)
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(first.take(symbols) - bounds[:-1], lengths)
        at += np.arange(bounds[-1])
        return flat.take(at), bounds[self.starts]

    def documents(self) -> Iterator[tuple[int | None, np.ndarray]]:
        """All documents, expanded together."""
        ids, upto = self.expanded()
        for k, doc_id in enumerate(self.doc_ids.to_pylist()):
            yield doc_id, ids[upto[k]:upto[k + 1]]


# ---------------------------------------------------------------- Spark

MANIFEST = "part int, block int, path string, n_docs long, n_ids long, n_bytes long"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, folder: str, how: Encoding) -> DataFrame:
    """Write all documents in ascending id order (NULL first); returns the written manifest.

    A NULL text is empty. Every document ends with ``end_id``. Rows with equal ids stand next to
    each other in any order. Without documents there are no files. Only doc_id and text are read.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = tokens_of(how.tokenizer), TaskContext.get().partitionId()
        held, doc_ids, n_ids, block = [], [], 0, 0

        def flush():
            path, stream = files.create(folder, ".rpg")
            with stream:
                ids, counts = (np.concatenate(x) for x in zip(*held))
                n_bytes = write_block(stream, doc_ids, ids, counts, tokens.size, how)
            row = {"part": part, "block": block, "path": path, "n_docs": len(doc_ids), "n_ids": n_ids, "n_bytes": n_bytes}
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                ("n_ids", pa.int64()), ("n_bytes", pa.int64())]))

        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, counts = tokens.encode(texts)
            after = np.cumsum(counts)
            held.append((np.insert(ids, after, how.end_id), counts + 1))
            doc_ids += batch.column("doc_id").to_pylist()
            n_ids += len(held[-1][0])
            if n_ids >= how.block_ids:
                yield flush()
                held, doc_ids, n_ids, block = [], [], 0, block + 1
        if doc_ids:
            yield flush()

    ordered = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").repartitionByRange(
        F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    return written(ordered.mapInArrow(write, MANIFEST))


def read_shards(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                with files.open_for_reading(path) as f:
                    block = Block(f.read())
                ids, upto = block.expanded()
                data, cuts = memoryview(ids.astype("<u4")).cast("B"), (4 * upto).tolist()
                sums = [zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])]
                columns = [block.doc_ids, pa.array(start + upto[:-1]), pa.array(np.diff(upto)), pa.array(sums, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    before = Window.orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    # Some three files a task, held one at a time.
    return placed.repartition(-(-manifest.count() // 3) or 1, "path").mapInArrow(read, ROWS)


def encode_documents(docs: DataFrame, how: Encoding) -> DataFrame:
    """Write the documents as grammar blocks and return what reading them back gives."""
    return read_shards(write_shards(docs, files.new_folder(docs.sparkSession, "token-shards"), how))
