"""Sharding by balanced label propagation.

Documents start in the shard their id's hash names. In each round, linked documents (here: equal
texts) ask to move to the shard that holds most of their neighbours; between each two shards only
as much moves as the other direction or the receiver's spare capacity allows, greatest
gain first. Unlinked documents, which no move can cut, then even the sizes out. DataFrame functions
only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritally.llm.common import cumulative_pick, unit_hash
from veritally.session import written


@dataclass(frozen=True)
class Shards:
    count: int = 8
    rounds: int = 8
    #: The documents of one text move in so many parcels, so a text larger than a shard is split.
    parcels: int = 64
    #: Unlinked documents over a shard's size / ``large_parts`` are placed one by one; there can be
    #: at most ``count * large_parts`` of them, whatever the input.
    large_parts: int = 1000
    bins: int = 4096


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key, row): what placing a document needs; NULL text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("key"), F.monotonically_increasing_id().alias("row"))


def spread(rows: DataFrame) -> DataFrame:
    """Add ``u``, the hash of the id; rows of an id that repeats, NULL among them, get one each, or
    they would all stand at one place, whatever their number. ``rows`` are written ones."""
    again = rows.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_n")).where("_n > 1").select("_id", F.lit(True).alias("_again"))
    told = rows.join(again, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    u = F.when(F.col("_again"), unit_hash("doc_id", "row")).otherwise(unit_hash("doc_id"))
    return told.withColumn("u", u).drop("_id", "_again", "row")


def start_parcels(nodes: DataFrame, how: Shards) -> DataFrame:
    """(key, parcel, n, bytes, shard) of the texts that several documents share."""
    each = nodes.groupBy("key", _parcel(how)).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    linked = each.groupBy("key").agg(F.sum("n").alias("copies")).where("copies > 1").select("key")
    return each.join(linked, "key").withColumn("shard", (F.col("parcel") % how.count).cast("int"))


def _parcel(how: Shards):
    return F.floor(F.col("u") * how.parcels).cast("int").alias("parcel")


def propagate(parcels: DataFrame, capacity: float, how: Shards) -> DataFrame:
    """Move parcels towards their neighbours, round after round, until none wants or may move."""
    now = written(parcels)
    for _ in range(how.rounds):
        near = now.groupBy("key", "shard").agg(F.sum("n").alias("near"))
        best = near.groupBy("key").agg(F.max(F.struct("near", F.xxhash64("key", "shard").alias("tie"), "shard")).alias("best"))
        wish = now.join(best, "key").join(near, ["key", "shard"]).selectExpr(
            "key", "parcel", "n", "bytes", "shard", "best.shard AS wanted", "best.near - near AS gain")
        wish = written(wish)
        asked = wish.where("wanted <> shard").groupBy("shard", "wanted").agg(F.sum("bytes").alias("asked"))
        back = asked.selectExpr("shard AS b_wanted", "wanted AS b_shard", "asked AS back")
        loads = now.groupBy(F.col("shard").alias("l_shard")).agg(F.sum("bytes").alias("load"))
        into = asked.groupBy(F.col("wanted").alias("i_shard")).agg(F.sum("asked").alias("into"))
        quota = asked.join(back, F.expr("shard = b_shard AND wanted = b_wanted"), "left").join(
            into, F.expr("wanted = i_shard")).join(loads, F.expr("wanted = l_shard"), "left")
        quota = written(quota.selectExpr(
            f"shard * {how.count} + wanted AS pair",
            "least(asked, least(asked, coalesce(back, 0)) + "
            f"greatest({capacity}D - coalesce(load, 0), 0) * asked / into) AS quota"))
        if quota.isEmpty():
            break
        rows = wish.withColumn("pair", F.expr(f"IF(wanted <> shard, shard * {how.count} + wanted, NULL)"))
        rows = rows.withColumn("place", F.expr("1D / (2 + greatest(gain, 0))"))
        stay = rows.where("pair IS NULL").withColumn("picked", F.lit(False))
        ask = cumulative_pick(rows.where("pair IS NOT NULL"), "pair", "place", "bytes", quota, ["key", "parcel"], False)
        now = written(ask.unionByName(stay).selectExpr(
            "key", "parcel", "n", "bytes", "IF(picked, wanted, shard) AS shard", "picked"))
        if now.where("picked").isEmpty():
            break
        now = now.drop("picked")
    return now.select("key", "parcel", "n", "bytes", "shard")


def place_large(large: DataFrame, loads: list[float], how: Shards) -> DataFrame:
    """(key, shard): the largest documents one by one into the emptiest shard. Their number is bounded."""
    start = "array(" + ", ".join(f"{x}D" for x in loads) + ")"
    listed = large.agg(F.sort_array(F.collect_list(F.struct("size", "key")), asc=False).alias("docs"))
    least = "array_position(acc.loads, array_min(acc.loads))"
    placed = listed.selectExpr(
        "docs", f"aggregate(docs, named_struct('loads', {start}, 'to', CAST(array() AS ARRAY<INT>)), (acc, d) -> "
        f"named_struct('loads', transform(acc.loads, (x, i) -> IF(i = {least} - 1, x + d.size, x)), "
        f"'to', array_append(acc.to, CAST({least} - 1 AS INT)))).to AS to")
    return placed.selectExpr("inline(arrays_zip(docs, to))").selectExpr("docs.key AS key", "to AS shard")


def _loads(rows: DataFrame, size: str, how: Shards) -> list[float]:
    found = {r[0]: float(r[1]) for r in rows.groupBy("shard").agg(F.sum(size)).collect()}  # one row per shard
    return [found.get(s, 0.0) for s in range(how.count)]


def fill_up(small: DataFrame, loads: list[float], how: Shards) -> DataFrame:
    """Add ``shard``: documents in order of their hash fill what each shard lacks.

    Running sums come from sums by bin and, inside a bin, from an ordered window.
    """
    binned = small.withColumn("bin", F.floor(F.col("u") * how.bins).cast("int"))
    sums = binned.groupBy("bin").agg(F.sum("size").alias("sum"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # a row per bin
    starts = written(sums.select(F.col("bin").alias("_bin"), F.coalesce(F.sum("sum").over(upto), F.lit(0)).alias("before")))
    rest = float(sums.agg(F.sum("sum")).first()[0] or 0)
    level = (sum(loads) + rest) / how.count
    lack = [max(0.0, level - x) for x in loads]
    scale = rest / sum(lack) if sum(lack) else 1.0
    ends = [sum(lack[: s + 1]) * scale for s in range(how.count)]
    within = Window.partitionBy("bin").orderBy("u", "doc_id", "key").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)) + F.col("size") / 2
    at = binned.join(starts, F.col("bin") == F.col("_bin")).withColumn("middle", middle)
    beyond = " + ".join(f"IF(middle >= {e}D, 1, 0)" for e in ends[:-1]) or "0"
    return at.withColumn("shard", F.expr(beyond)).drop("bin", "_bin", "before", "middle")


def with_slots(rows: DataFrame, how: Shards) -> DataFrame:
    """Add ``slot``: gapless from 0 inside each shard."""
    binned = rows.withColumn("bin", F.floor(F.col("u") * how.bins).cast("int"))
    counts = binned.groupBy("shard", "bin").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("shard").alias("_shard"), F.col("bin").alias("_bin"),
                           F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("u", "doc_id", "key"))
    at = binned.withColumn("own", own).join(starts, F.expr("shard = _shard AND bin = _bin"))
    return at.withColumn("slot", (F.col("before") + F.col("own") - 1).cast("long")).drop("bin", "_shard", "_bin", "own", "before")


def shard_documents(docs: DataFrame, how: Shards = Shards()) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (NULL).

    Equal texts, NULL and empty text among them, are linked. Repeated rows are documents of their
    own; a NULL id is an id like any other. An empty table gives no rows. Only doc_id and text
    are read.
    """
    nodes = written(spread(written(sized(docs))).select("*", _parcel(how)))
    total = float(nodes.agg(F.sum("size")).first()[0] or 0)
    capacity = total / how.count
    linked = propagate(start_parcels(nodes, how), capacity, how)
    placed = written(nodes.join(linked.select("key", "parcel", "shard"), ["key", "parcel"], "left"))
    fixed, single = placed.where("shard IS NOT NULL"), placed.where("shard IS NULL").drop("shard")
    bar = capacity / how.large_parts
    large = single.where(f"size > {bar}D")
    big = written(large.join(place_large(large, _loads(fixed, "size", how), how), "key"))
    together = fixed.unionByName(big)
    small = fill_up(single.where(f"size <= {bar}D"), _loads(together, "size", how), how)
    sharded = written(reduce(DataFrame.unionByName, [together, small]))
    return with_slots(sharded, how).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def cut_links(nodes: DataFrame) -> DataFrame:
    """(links, cut) over (key, shard) rows: pairs of equal texts, and those in different shards."""
    each = nodes.groupBy("key", "shard").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.sum("n").alias("n"), F.expr("sum(n * (n - 1) / 2)").alias("inside"))
    return each.agg(F.expr("coalesce(sum(n * (n - 1) / 2), 0)").alias("links"),
                    F.expr("coalesce(sum(n * (n - 1) / 2 - inside), 0)").alias("cut"))
