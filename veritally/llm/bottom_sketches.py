"""Near duplicates from bottom-k sketches of one hash function.

A sketch holds the ``k`` least hashes of a text's set of word shingles. Inverted lists of retained
values generate the candidates. A single value is retained by all texts that use a common phrase, so a
list stands for ``run`` retained values that follow each other, the last being followed by the first. Let two
sets with a similarity of 0.8 or more be put in one ring by their hashes: at most a fifth of the values
belong to one set alone, and m of them leave m arcs of at least 4m common ones, so four common
values in a row exist always; these are a run in both sketches. Sets beyond ``k`` values are seen through
the first ``k`` positions of the ring; no run of four lies there with a probability of about 0.8 ^ k.

Candidates pass if the sketch of their union estimates enough similarity, and are then verified on their
full sets. Only components are asked for, so pairs inside one component are not compared again:
each text first meets the leader of the lists it shares most, twice, and only lists whose texts are then still in
different components are gone through pair by pair, in blocks of bounded size, a pair in its first list only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.llm.components import connected_components
from veritally.session import written


@dataclass(frozen=True)
class Sketches:
    words: int = 2
    #: A link is a similarity of ``least`` / ``of`` or more.
    least: int = 80
    of: int = 100
    k: int = 64
    run: int = 4
    #: Standard deviations of the estimate that a candidate may fall short.
    slack: float = 6.0
    #: Leaders' rounds before the remaining lists are gone through.
    star_rounds: int = 2
    #: Texts of a list that are compared with as many others in one task, by so many at a time.
    list_block: int = 4096
    block: int = 256

    def least_common(self, seen: int) -> float:
        """Common values among ``seen`` of the union's sketch that a candidate needs."""
        s = self.least / self.of
        return s * seen - self.slack * (seen * s * (1 - s)) ** 0.5


SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A random number per byte and place in a word (after 64 places they repeat, times an odd factor).
LETTERS = np.random.default_rng(17).integers(0, 1 << 64, 64 << 8, np.uint64)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_hashes(lowered: bytes) -> np.ndarray:
    """64 bits for each word: the sum of its letters' random numbers, mixed with its length."""
    data = np.frombuffer(lowered, np.uint8)
    inside = ~SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    lengths = edges[1::2] - edges[::2]
    if not len(lengths):
        return np.zeros(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(first[-1] + lengths[-1]) - np.repeat(first, lengths)
    values = LETTERS[(place & 63) << 8 | data[inside]] * ((place >> 6 << 1) + 1).astype(np.uint64)
    out = (np.add.reduceat(values, first) ^ lengths.astype(np.uint64)) * FACTOR
    return out ^ out >> np.uint64(32)


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; fewer words are one shingle, none have none."""
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1 if n else 0, np.uint64)
    for i in range(n):
        out = (out ^ words[i:len(words) - n + 1 + i]) * FACTOR
        out ^= out >> np.uint64(29)
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])] if len(out) else out


def full_set(text: str | None, how: Sketches) -> np.ndarray:
    return shingle_set(word_hashes(_lowered(text)), how.words)


def text_key(words: np.ndarray) -> bytes | None:
    """128 bits for a sequence of words, None without words."""
    return hashlib.md5(words.tobytes()).digest() if len(words) else None


def sketches(docs: DataFrame, how: Sketches) -> DataFrame:
    """(doc_id, sum, key, n_shingles, sketch): checksum of the text, digest of its words, the ``k`` least
    hashes; no key and no sketch without words."""
    k, n = how.k, how.words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, lists = [], [], []
            for text in batch.column("text").to_pylist():
                words = word_hashes(_lowered(text))
                hashes = shingle_set(words, n)
                keys.append(text_key(words))
                sizes.append(len(hashes))
                lists.append(hashes[:k].view(np.int64) if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("sum"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "sum", "key", "n_shingles", "sketch"])

    read = docs.selectExpr("doc_id", "text", "xxhash64(text) AS sum")
    return read.mapInArrow(run, "doc_id long, sum long, key binary, n_shingles long, sketch array<long>")


def postings(nodes: DataFrame, how: Sketches) -> DataFrame:
    """(list, node): the runs of retained values; those of a whole set go round its end."""
    following = ", ".join(f"element_at(sketch, 1 + (i + {j}) % size(sketch))" for j in range(how.run))
    last = f"IF(n_shingles > size(sketch), size(sketch) - {how.run}, size(sketch) - 1)"
    runs = f"transform(sequence(0, {last}), i -> xxhash64({following}))"
    return nodes.where(f"size(sketch) >= {how.run}").selectExpr("node", f"explode({runs}) AS list")


def passes(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int, how: Sketches) -> bool:
    """Whether the sketch of the union leaves two sorted sketches their chance."""
    if how.of * min(n_a, n_b) < how.least * max(n_a, n_b):
        return False
    if n_a <= how.k and n_b <= how.k:
        common = len(np.intersect1d(a, b, assume_unique=True))
        return how.of * common >= how.least * (n_a + n_b - common)
    union = np.union1d(a, b)[:how.k]
    common = np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)
    return common.sum() >= how.least_common(len(union))


def filtered(pairs: DataFrame, nodes: DataFrame, how: Sketches) -> DataFrame:
    """The pairs (a, b) that the estimate lets pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            keep = [passes(np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64), n, m, how)
                    for x, y, n, m in zip(rows["x"], rows["y"], rows["n"], rows["m"])]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of_a = nodes.selectExpr("node AS a", "sketch AS x", "n_shingles AS n")
    of_b = nodes.selectExpr("node AS b", "sketch AS y", "n_shingles AS m")
    sized = pairs.join(of_a, "a").join(of_b, "b").where(f"{how.of} * least(n, m) >= {how.least} * greatest(n, m)")
    return sized.mapInArrow(run, "a long, b long")


def linked(pairs: DataFrame, texts: DataFrame, how: Sketches) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough. The texts that meet one ``b`` are dealt
    into blocks, to each of which the text of ``b`` goes too."""
    pairs = written(pairs)
    centres = pairs.groupBy("b").agg(F.count("*").alias("met")).selectExpr("b", f"CAST(ceil(met / {how.block}) AS INT) AS blocks")
    dealt = pairs.join(centres, "b").selectExpr("a AS node", "b", "CAST(pmod(xxhash64(a), blocks) AS INT) AS block")
    both = dealt.unionByName(centres.selectExpr("b AS node", "b", "explode(sequence(0, blocks - 1)) AS block"))

    def run(rows: list[tuple]) -> list[tuple[int, int]]:
        centre = rows[0][0]
        sets = {node: full_set(text, how) for _, _, node, text in rows}
        near = []
        for node in sorted(sets):
            common = len(np.intersect1d(sets[node], sets[centre], assume_unique=True))
            if node != centre and how.of * common >= how.least * (len(sets[node]) + len(sets[centre]) - common):
                near.append((node, centre))
        return near

    met = texts.join(both.hint("merge"), "node").select("b", "block", "node", "text")
    return _by_group(met, 2, run)


def common_values(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of some sets have in common."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(h) for h in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        held = np.zeros((n, int(column[b - 1]) + 1 - start), np.float32)
        held[owner[a:b], column[a:b] - start] = 1
        both += held @ held.T
    return both


def candidates(sets: list[np.ndarray], how: Sketches) -> np.ndarray:
    """Which pairs of sets have sketches with enough common values for :func:`passes`, as a matrix.

    What the sketch of a union has in common cannot be more than what the two sketches have.
    """
    sizes = np.array([len(x) for x in sets])
    both = common_values([x[:how.k] for x in sets])
    small, large = np.minimum(sizes[:, None], sizes), np.maximum(sizes[:, None], sizes)
    whole = how.of * both >= how.least * (small + large - both)
    return (how.of * small >= how.least * large) & np.where(large <= how.k, whole, both >= how.least_common(how.k))


def linked_in(sets: list[np.ndarray], fit: np.ndarray, how: Sketches) -> list[tuple[int, int]]:
    """Edges that connect what the fitting pairs with similar full sets connect, one a set at most."""
    fit = fit & candidates(sets, how)
    some = np.flatnonzero(fit.any(0) | fit.any(1))
    if not len(some):
        return []
    sizes, both = np.array([len(sets[i]) for i in some]), common_values([sets[i] for i in some])
    near = fit[np.ix_(some, some)] & (how.of * both >= how.least * (sizes[:, None] + sizes - both))
    near |= near.T
    labels, old = np.arange(len(some)), None
    while old is None or (old != labels).any():
        old = labels
        labels = np.minimum(labels, np.where(near, labels, len(some)).min(1))
        labels = labels[labels]
    return [(int(some[i]), int(some[k])) for i, k in enumerate(labels) if i != k]


def compared_lists(mixed: DataFrame, texts: DataFrame, how: Sketches) -> DataFrame:
    """Links (a, b) that connect what linked pairs of different components connect, of pairs that share a list.

    Of lists that hold the same texts one is looked at, and a pair is compared in the first list it shares
    only. Lists (list, node, component) are gone through in pairs of blocks, on full sets.
    """
    sizes = mixed.groupBy("list").agg(F.count("*").alias("n"), *[
        F.sum(F.expr(f"xxhash64(node, {seed}) >> 32")).alias(f"d{seed}") for seed in (1, 2)])
    sizes = sizes.groupBy("n", "d1", "d2").agg(F.min("list").alias("list"))
    sizes = sizes.selectExpr("list", f"CAST(ceil(n / {how.list_block}) AS INT) AS blocks")
    kept = written(mixed.join(sizes, "list"))
    own = kept.groupBy("node").agg(F.collect_set("list").alias("lists"))  # at most as many as a sketch has runs
    dealt = kept.selectExpr("*", "CAST(pmod(xxhash64(node), blocks) AS INT) AS block", "explode(sequence(0, blocks - 1)) AS other")
    sent = dealt.selectExpr("list", "node", "component", "block", "least(block, other) AS i", "greatest(block, other) AS j")

    def run(rows: list[tuple]) -> list[tuple[int, int]]:
        now, i, j = rows[0][:3]
        nodes, component, block, texts, lists = zip(*[r[3:] for r in sorted(rows, key=lambda r: r[3])])
        component, block = np.array(component), np.array(block)
        earlier = [np.array([x for x in own if x < now], np.int64) for own in lists]
        known: dict[int, np.ndarray] = {}
        edges = []
        starts = range(0, len(nodes), how.block)
        for p, q in ((p, q) for p in starts for q in starts if p <= q):
            part = np.unique([*range(p, min(p + how.block, len(nodes))), *range(q, min(q + how.block, len(nodes)))])
            fit = np.triu(component[part][:, None] != component[part], 1)
            if p < q:
                fit &= (part < q)[:, None] & (part >= q)
            if i != j:
                fit &= block[part][:, None] != block[part]
            if not fit.any():
                continue
            fit &= common_values([earlier[k] for k in part]) == 0
            some = np.flatnonzero(fit.any(0) | fit.any(1))
            if not len(some):
                continue
            at = part[some]
            known.update({k: full_set(texts[k], how) for k in at.tolist() if k not in known})
            for x, y in linked_in([known[k] for k in at.tolist()], fit[np.ix_(some, some)], how):
                edges.append((nodes[at[x]], nodes[at[y]]))
                component[component == component[at[y]]] = component[at[x]]  # need not meet again here
        return edges

    met = sent.join(texts.hint("merge"), "node").join(own, "node")
    return _by_group(met.select("list", "i", "j", "node", "component", "block", "text", "lists"), 3, run)


def _by_group(rows: DataFrame, keys: int, run: Callable[[list[tuple]], list[tuple[int, int]]]) -> DataFrame:
    """Pairs (a, b) that ``run`` makes of the rows of each group; the first ``keys`` columns name it.

    Groups are dealt over as many tasks as shuffles have, as few bytes may be much work, and a task
    holds one group, of bounded size, at a time.
    """
    names = rows.columns[:keys]

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            a, b = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: list[tuple] = []
        for batch in batches:
            pairs: list[tuple[int, int]] = []
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if held and held[0][:keys] != row[:keys]:
                    pairs += run(held)
                    held = []
                held.append(row)
            yield out(pairs)
        if held:
            yield out(run(held))

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, *names).sortWithinPartitions(*names).mapInArrow(stream, "a long, b long")


def _components(links: DataFrame) -> DataFrame:
    return connected_components(links).withColumnsRenamed({"node": "_node", "root": "_root"})


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Rows with the component of their node, at first the node itself."""
    if labels is None:
        return rows.withColumn("component", F.col("node"))
    return rows.join(labels, F.col("node") == F.col("_node"), "left").select(*rows.columns, F.coalesce("_root", "node").alias("component"))


def _mixed(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    """What is left of the lists: those whose texts are in different components, with a leader
    that changes from list to list."""
    rows = written(_labelled(lists.select("list", "node"), labels))
    open_lists = rows.groupBy("list").agg(F.min("component").alias("_least"), F.max("component").alias("_most"),
                                          F.min(F.struct("component", "node")).alias("_first"), F.max(F.struct("component", "node")).alias("_last"))
    open_lists = open_lists.where("_least <> _most").selectExpr("list AS _list", "_first", "_last")
    return written(rows.join(open_lists, F.col("list") == F.col("_list")).drop("_list"))


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text): the text of one row of each node, found by its checksum and id, told by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None
        for batch in batches:
            keep = []
            for node, key, text in zip(*[batch.column(c).to_pylist() for c in ("node", "key", "text")]):
                keep.append(node != before and text_key(word_hashes(_lowered(text))) == key)
                before = node if keep[-1] else before  # rows that repeat an id and a text follow each other
            yield batch.select(["node", "text"]).filter(pa.array(keep, pa.bool_()))

    read = docs.selectExpr("CAST(doc_id AS BIGINT) AS _id", "text", "xxhash64(text) AS _sum")
    wanted = nodes.selectExpr("node", "key", "first.sum AS _first_sum", "first.doc_id AS _first_id")
    # Merged at every size, so that a list which happens to fit a broadcast does not change the plan.
    met = read.join(wanted.hint("merge"), (F.col("_sum") == F.col("_first_sum")) & F.col("_id").eqNullSafe(F.col("_first_id")))
    return met.select("node", "key", "text").mapInArrow(run, "node long, text string")


def node_components(nodes: DataFrame, docs: DataFrame, how: Sketches) -> DataFrame:
    """(_node, _root): each node that has a link, and the least node of its component."""
    every = postings(nodes, how)
    shared = every.groupBy("list").agg(F.min("node").alias("_least"), F.max("node").alias("_most")).where("_least < _most")
    lists = written(every.join(shared.select("list"), "list").select("list", "node"))
    met = written(lists.select("node").distinct())
    near = written(nodes.join(met, "node"))
    texts = written(texts_of(docs, near))
    labels, links = None, None
    for _ in range(how.star_rounds):
        mixed = _mixed(lists, labels)
        # The leader is a text of another component: the least one, for the least component the last one.
        leader = "IF(component = _first.component, _last.node, _first.node)"
        led = mixed.selectExpr("node AS a", f"{leader} AS b").groupBy("a", "b").agg(F.count("*").alias("shared"))
        best = led.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("best")).selectExpr("a", "best.b AS b")
        found = linked(filtered(best, near, how), texts, how)
        links = written(found if links is None else links.unionByName(found))
        labels = written(_components(links))
    rest = _mixed(lists, labels).select("list", "node", "component")
    found = compared_lists(rest, texts, how)
    return written(_components(links.unionByName(found)))


def near_duplicates(docs: DataFrame, how: Sketches = Sketches()) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (the least doc_id reachable by links), kept.

    Words stand between ASCII white space, A-Z count as a-z; copies of the same words are one node.
    A NULL or wordless text has no shingle and no link. Rows that repeat an id are judged by their own
    texts. A row without an id links like any other and names no component: it is kept only where
    none of its component has an id. An empty table gives no rows. Only doc_id and text are read.
    """
    prints = written(sketches(docs, how))
    place = F.struct("sum", F.col("doc_id").isNull().alias("unnamed"), "doc_id")
    nodes = written(
        prints.where("key IS NOT NULL").groupBy("key").agg(
            F.min(place).alias("first"), F.min("doc_id").alias("least"), F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"))
        .withColumn("node", F.monotonically_increasing_id()))
    labels = node_components(nodes, docs, how)
    judged = _labelled(nodes.select("node", "key", "least"), labels)
    least = judged.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(judged.join(least, "component").select(F.col("key").alias("_key"), "component_id"))
    out = prints.select("doc_id", "key", "n_shingles").join(named, F.col("key") == F.col("_key"), "left")
    component = "IF(key IS NULL, doc_id, component_id)"
    return out.selectExpr("doc_id", "n_shingles", f"{component} AS component_id",
                          f"coalesce(doc_id = {component}, {component} IS NULL) AS kept")
