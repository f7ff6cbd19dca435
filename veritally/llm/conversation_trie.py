"""Prefix trie of conversations as burst tries.

A conversation is a sequence of turn ids, cut into stretches of ``stretch`` turns; the sequences of
one stretch that follow the same turns stand in one container under one head of the trie. A
container that is too large bursts: the turns that all its suffixes share become nodes of the trie, and the
suffixes are dealt into new containers by their next turn id. The other containers are sorted and
swept into nodes. Sums over subtrees go from the last stretch and the last burst upwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritally.operators.frames import stacked
from veritally.session import written


@dataclass(frozen=True)
class Burst:
    #: Turns of a conversation in one row.
    stretch: int = 256
    #: Turn ids that a container may hold.
    most: int = 1 << 15


ROOT = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
TOTALS = "cont binary, src binary, children long, leaves long, saved long"


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, id, n_bytes) of the rebuilt conversations, at from 1, and all (conv, own, head, base).

    Turns go by turn number, NULL first, then by role and text.
    """
    clean = conversations.where("conv_id IS NOT NULL").selectExpr(
        "CAST(conv_id AS BIGINT) AS conv", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text")
    at = "row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS at"
    turns = written(clean.selectExpr("conv", at, "unhex(md5(concat(octet_length(role), ':', role, text))) AS id",
                                     "octet_length(text) AS n_bytes"))
    convs = turns.groupBy("conv").agg(F.count("*").alias("own")).selectExpr(
        "conv", "own", "CAST(crc32(CAST(CAST(conv AS STRING) AS BINARY)) % 9 AS INT) AS head", "conv - conv % 5 AS base")
    heads = turns.where("at <= 8").groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "n_bytes"))).alias("first"))
    convs = written(convs.join(heads, "base", "left").selectExpr(
        "conv", "own", "head", "slice(coalesce(first, array()), 1, head) AS first"))
    begun = convs.selectExpr("conv", "explode(first) AS t").selectExpr("conv", "CAST(t.at AS BIGINT) AS at", "t.id", "t.n_bytes")
    own = turns.join(convs.selectExpr("conv", "head", "size(first) AS taken"), "conv").where("at > head").selectExpr(
        "conv", "CAST(at - head + taken AS BIGINT) AS at", "id", "n_bytes")
    return begun.unionByName(own), convs


def stretches(turns: DataFrame, how: Burst) -> DataFrame:
    """(conv, level, head, tail, ids, sizes, is_last): the stretches of each conversation, ``head`` and
    ``tail`` the digests of all turns before it and up to its end."""
    cut = turns.groupBy("conv", F.expr(f"CAST((at - 1) div {how.stretch} AS INT) AS level")).agg(
        F.sort_array(F.collect_list(F.struct("at", "id", "n_bytes"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, waiting = None, ROOT, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if waiting:
                    out.append({**waiting, "is_last": waiting["conv"] != r["conv"]})
                head = digest if conv == r["conv"] else ROOT
                conv, digest = r["conv"], hashlib.md5(head + b"".join(r["ids"])).digest()
                waiting = {**r, "head": head, "tail": digest}
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if waiting:
            yield pa.RecordBatch.from_pylist([{**waiting, "is_last": True}], schema)

    schema = pa.schema([("conv", pa.int64()), ("level", pa.int32()), ("head", pa.binary()), ("tail", pa.binary()),
                        ("ids", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int32())), ("is_last", pa.bool_())])
    sorted_ = cut.selectExpr("conv", "level", "turns.id AS ids", "turns.n_bytes AS sizes").repartition("conv").sortWithinPartitions("conv", "level")
    return sorted_.mapInArrow(run, "conv long, level int, head binary, tail binary, ids array<binary>, sizes array<int>, is_last boolean")


def ends(last: DataFrame) -> DataFrame:
    """(tail, conv) -> (tail, ends_sha256): one pass over the sorted ids; however many conversations end at
    one node, its task holds one row at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            tails, shas = [], []
            for tail, conv in zip(batch.column("tail").to_pylist(), batch.column("conv").to_pylist()):
                if tail != now:
                    if now is not None:
                        tails.append(now)
                        shas.append(digest.hexdigest())
                    now, digest = tail, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(b",%d" % conv)
            if tails:
                yield pa.RecordBatch.from_arrays([pa.array(tails, pa.binary()), pa.array(shas)], names=["tail", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], names=["tail", "ends_sha256"])

    return last.repartition("tail").sortWithinPartitions("tail", "conv").mapInArrow(run, "tail binary, ends_sha256 string")


def swept(rows: DataFrame, depth: int) -> DataFrame:
    """Sort the containers and sweep each into nodes: rows of NODE, and one row of TOTALS per container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                if held and held[0]["cont"] != r["cont"]:
                    out += nodes_of(held, depth)
                    held = []
                held.append(r)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(nodes_of(held, depth), schema)

    schema = pa.schema([(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
                       + [("ends_sha256", pa.string()), ("cont", pa.binary()), ("src", pa.binary()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64())])
    return rows.repartition("cont").sortWithinPartitions("cont", "ids").mapInArrow(run, f"{NODE}, {TOTALS}")


def nodes_of(rows: list[dict], depth: int) -> list[dict]:
    """Nodes of one container of bounded size, whose rows are sorted, and its totals. ``at`` turns of the
    stretch lie above the container; ``depth`` turns above the stretch."""
    at, cont = rows[0]["at"], rows[0]["cont"]
    top = {"conv_id": rows[0]["up"], "children": 0, "leaves": 0, "saved": 0}
    open_nodes, done, before = [top], [], None

    def close() -> None:
        node = open_nodes.pop()
        above = open_nodes[-1]
        node["leaves"] = node["leaves"] or 1
        node["saved"] += (node["n_convs"] - 1) * node["size"]
        above["children"] += 1
        above["leaves"] += node["leaves"]
        above["saved"] += node["saved"]
        if above is not top:
            above["conv_id"] = min(above["conv_id"], node["conv_id"])
            above["n_convs"] += node["n_convs"]
        node["above"] = above
        done.append(node)

    for r in rows:
        ids = r["ids"]
        same = at
        if before is not None:
            while same < min(len(ids), len(before)) and ids[same] == before[same]:
                same += 1
        while len(open_nodes) - 1 > same - at:
            close()
        for d in range(same, len(ids)):
            open_nodes.append({"conv_id": r["least"], "depth": depth + d + 1, "size": r["sizes"][d], "n_convs": 0,
                               "children": 0, "leaves": 0, "saved": 0, "ends": NO_ENDS})
        end = open_nodes[-1]
        if end is not top:
            end["conv_id"] = min(end["conv_id"], r["least"])
            end["n_convs"] += r["n"]
            end["ends"] = r["ends_sha256"] or NO_ENDS
            if r["below_children"]:
                end["children"], end["leaves"], end["saved"] = r["below_children"], r["below_leaves"], r["below_saved"]
        before = ids
    while len(open_nodes) > 1:
        close()
    out = [{"conv_id": n["conv_id"], "depth": n["depth"], "parent_conv_id": n["above"]["conv_id"], "n_convs": n["n_convs"],
            "n_children": n["children"], "n_leaves": n["leaves"], "saved_tokens": n["saved"], "ends_sha256": n["ends"]} for n in done]
    return [*out, {"cont": cont, "src": rows[0]["src"], "children": top["children"], "leaves": top["leaves"], "saved": top["saved"]}]


def burst(rows: DataFrame, how: Burst) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Burst the containers that hold too much: (what burst, what goes on, what ended at a burst head)."""
    sizes = rows.groupBy("cont").agg(F.count("*").alias("rows"), F.sum(F.size("ids") - F.col("at")).alias("held"))
    large = sizes.where(f"rows > 1 AND held > {how.most}").select(F.col("cont").alias("_cont"))
    inside = written(rows.join(large, F.col("cont") == F.col("_cont")).drop("_cont"))
    if inside.isEmpty():
        return None
    ranges = inside.groupBy("cont", "src", "at", "up").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.min(F.struct("ids", "sizes")).alias("lo"), F.max("ids").alias("hi"))
    # What the first and the last sequence share, all between them share too.
    shared = ("coalesce(array_position(transform(sequence(1, least(size(lo.ids), size(hi))), "
              "i -> element_at(lo.ids, i) <=> element_at(hi, i)), false) - 1, 0)")
    equal = "slice(lo.ids, 1, least(size(lo.ids), size(hi))) = slice(hi, 1, least(size(lo.ids), size(hi)))"
    heads = written(ranges.selectExpr(
        "cont", "src", "at", "up", "n", "least", "lo.sizes AS sizes",
        f"CAST(IF({equal}, least(size(lo.ids), size(hi)), {shared}) AS INT) AS shared"))
    above = heads.selectExpr("cont AS _cont", "shared", "IF(shared > at, least, up) AS _up")
    dealt = inside.join(above, F.col("cont") == F.col("_cont"))
    onward = dealt.where("size(ids) > shared").selectExpr(
        "unhex(md5(concat(cont, element_at(ids, shared + 1)))) AS cont", "cont AS src", "shared AS at", "_up AS up",
        *[c for c in rows.columns if c not in ("cont", "src", "at", "up")])
    stopped = dealt.where("size(ids) = shared").selectExpr("cont", "ends_sha256")
    return heads, written(onward), written(stopped)


def burst_nodes(heads: DataFrame, below: DataFrame, stopped: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """(nodes, totals) of the containers that burst, from the totals of those they burst into."""
    summed = below.groupBy(F.col("src").alias("cont")).agg(
        F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    known = written(heads.join(summed, "cont").join(stopped, "cont", "left"))
    each = known.selectExpr("*", "explode(IF(shared > at, sequence(at + 1, shared), array())) AS d")
    own = "(n - 1) * aggregate(slice(sizes, {0}, shared - {0} + 1), 0L, (s, x) -> s + x)"
    nodes = each.selectExpr(
        "least AS conv_id", f"CAST({depth} + d AS BIGINT) AS depth", "IF(d = at + 1, up, least) AS parent_conv_id",
        "n AS n_convs", "IF(d = shared, children, 1L) AS n_children", "leaves AS n_leaves",
        f"saved + {own.format('d')} AS saved_tokens", f"IF(d = shared, coalesce(ends_sha256, '{NO_ENDS}'), '{NO_ENDS}') AS ends_sha256")
    totals = known.selectExpr("cont", "src", "IF(shared > at, 1L, children) AS children", "leaves",
                              f"IF(shared > at, saved + {own.format('(at + 1)')}, saved) AS saved")
    return nodes, totals


def level_nodes(rows: DataFrame, depth: int, how: Burst) -> tuple[DataFrame, DataFrame]:
    """(nodes, totals per head) of the stretches at one depth."""
    settled, rounds = [], []
    while True:
        step = burst(rows, how)
        if step is None:
            settled.append(rows)
            break
        rounds.append(step)
        heads = step[0].select(F.col("cont").alias("_cont"))
        settled.append(rows.join(heads, F.col("cont") == F.col("_cont"), "left_anti"))
        rows = step[1]
    result = written(swept(stacked(settled), depth))
    nodes = [result.where("depth IS NOT NULL").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")]
    totals = result.where("depth IS NULL").select("cont", "src", "children", "leaves", "saved")
    for heads, _, stopped in reversed(rounds):
        # Every container knows the one it came from; totals of other rounds find no partner here.
        found, sums = burst_nodes(heads, totals, stopped, depth)
        nodes.append(found)
        totals = written(totals.unionByName(sums))
    return stacked(nodes), totals.where("src IS NULL")


def trie_nodes(conversations: DataFrame, how: Burst = Burst()) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (its least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Rows without conv_id belong to no conversation and are left out; turns go by (turn, role, text), NULL
    turns first; a NULL role or text is empty; repeated rows are turns of their own. An empty
    table gives no rows. Only conv_id, turn, role and text are read.
    """
    turns, convs = rebuilt_turns(conversations)
    cut = written(stretches(turns, how))
    last = ends(cut.where("is_last").select("tail", "conv"))
    begun = convs.join(cut.where("level = 0").select("conv"), "conv", "left_anti")
    at_root = ends(begun.select(F.lit(ROOT).alias("tail"), "conv"))
    paths = cut.groupBy("level", "head", "tail").agg(
        F.first("ids").alias("ids"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv").alias("least"))
    paths = written(paths.join(last, "tail", "left"))
    root = convs.agg(F.count("*").alias("n"), F.min("conv").alias("least")).first()
    nodes, totals = [], None
    for level in range(cut.agg(F.max("level")).first()[0] or 0, -1, -1):
        rows = paths.where(f"level = {level}")
        if level:
            up = paths.where(f"level = {level - 1}").select(F.col("tail").alias("head"), F.col("least").alias("up"))
            rows = rows.join(up, "head")
        else:
            rows = rows.withColumn("up", F.lit(root["least"]).cast("long"))
        if totals is None:
            rows = rows.selectExpr("*", *[f"CAST(NULL AS BIGINT) AS below_{c}" for c in ("children", "leaves", "saved")])
        else:
            rows = rows.join(totals.selectExpr("cont AS tail", *[f"{c} AS below_{c}" for c in ("children", "leaves", "saved")]), "tail", "left")
        rows = written(rows.selectExpr("head AS cont", "CAST(NULL AS BINARY) AS src", "0 AS at", "up", "ids", "sizes", "n", "least",
                                       "ends_sha256", "below_children", "below_leaves", "below_saved"))
        found, totals = level_nodes(rows, level * how.stretch, how)
        nodes.append(found)
    top = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")).where("n_convs > 0")
    sums = totals.agg(F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    one = {c: sums.select(c).scalar() for c in sums.columns} | {"ends_sha256": at_root.select("ends_sha256").scalar()}
    nodes.append(top.withColumns(one).selectExpr(
        "conv_id", "0L AS depth", "CAST(NULL AS BIGINT) AS parent_conv_id", "n_convs", "coalesce(children, 0) AS n_children",
        "coalesce(leaves, 1) AS n_leaves", "coalesce(saved, 0) AS saved_tokens", f"coalesce(ends_sha256, '{NO_ENDS}') AS ends_sha256"))
    return stacked(nodes)
