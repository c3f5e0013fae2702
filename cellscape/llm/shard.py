"""Sharding by a k-d tree over document metadata, balanced by bytes.

A node is cut at the weighted median along its widest dimension.  The median is found by
distributed refinement: bytes are summed per bin of the order key, the bin that crosses the
target is opened into finer bins, until an edge is close enough.  All nodes of a level are
refined by the same jobs; the driver holds one cut per node, so at most one per shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscape.llm.hot import join_hot
from cellscape.session import Scratch

#: An order key has 20 bits of the dimension, 20 of a text hash and 22 of a row hash: equal
#: texts lie together, and a cut enters a group of them only where it must.
LEVEL_BITS, TEXT_BITS, ROW_BITS = 20, 20, 22
LOW_BITS = TEXT_BITS + ROW_BITS
#: Bits of the key that are left below the bins of each round.
ROUNDS = (47, 34, 22, 11, 0)
#: A cut is good enough when it misses its target by this share of a shard's bytes; at the
#: edge of a group of equal texts more is allowed.
NEAR, NEAR_GROUP = 0.002, 0.01


def _ranks(values: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(value, rank) of distinct values in their order: sorted by ranges, numbered in each range, offset by the ranges before."""
    placed = scratch.put(f"{name}-sorted", values.repartitionByRange("value").sortWithinPartitions("value").select(
        "value", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at")))
    ranges = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return scratch.put(name, placed.join(ranges.select("range", (before - F.col("first")).alias("offset")), "range").select(
        "value", (F.col("offset") + F.col("at")).cast("double").alias("rank")))


def _metadata(docs: DataFrame, dims: list[str], text: str, doc_id: str, scratch: Scratch) -> DataFrame:
    """(rid, doc_id, size, text_crc32, low, x0, x1, ...): a row's coordinates are those of its group of equal texts, that is of
    the group's smallest id; numbers count as they are and strings by the rank of their value among all."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    mask = lambda h, bits: h.bitwiseAND(F.lit((1 << bits) - 1))
    text_hash = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    low = F.shiftleft(mask(text_hash, TEXT_BITS), ROW_BITS).bitwiseOR(
        mask(F.xxhash64(F.lit(1), F.col(doc_id)), ROW_BITS))
    named = [F.col(d).alias(f"d{i}") for i, d in enumerate(dims, 1)]
    base = scratch.put("base", docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), size.alias("size"),
        F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "utf-8")).alias("text_crc32"), low.alias("low"),
        F.md5(F.coalesce(F.col(text), F.lit(""))).alias("same"), F.log2(size).alias("x0"), *named))
    number = base.count()
    own = base.drop(*(f"d{i}" for i in range(1, len(dims) + 1)))
    # The id is the last dimension; the smallest one leads the struct.
    order = [f"d{i}" for i in (len(dims), *range(1, len(dims)))]
    first = base.groupBy("same").agg(F.min(F.struct(*order)).alias("d")).select("same", "d.*")
    rows = join_hot(own, scratch.put("first", first), "same", number).drop("same")
    for i, d in enumerate(dims, 1):
        if isinstance(docs.schema[d].dataType, T.NumericType):
            value = F.coalesce(F.nanvl(F.col(f"d{i}").cast("double"), F.lit(0.0)), F.lit(0.0))
            rows = rows.withColumn(f"x{i}", value).drop(f"d{i}")
            continue
        rows = scratch.put(f"rows-{i}", rows.withColumn("value", F.coalesce(F.col(f"d{i}").cast("string"), F.lit(""))).drop(f"d{i}"))
        ranks = _ranks(rows.select("value").distinct(), scratch, f"ranks-{i}").withColumnRenamed("rank", f"x{i}")
        rows = join_hot(rows, ranks, "value", number).drop("value")
    return rows


def _rows(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of whole numbers (one row per node) from the driver's list."""
    return df.sparkSession.createDataFrame(rows, ", ".join(f"{n} long" for n in names))


def _key(dims: int) -> Column:
    level = F.lit(0).cast("long")
    for i in range(dims):
        level = F.when(F.col("dim") == i, F.col(f"l{i}")).otherwise(level)
    return F.shiftleft(level, LOW_BITS).bitwiseOR(F.col("low"))


def _descend(rows: DataFrame, cuts: list[tuple], dims: int) -> DataFrame:
    """Move the rows of cut nodes to the children 2 * node and 2 * node + 1."""
    if not cuts:
        return rows
    table = F.broadcast(_rows(rows, cuts, ["node", "dim", "cut"]))  # at most one row per shard
    child = F.col("node") * 2 + (_key(dims) >= F.col("cut")).cast("long")
    return rows.join(table, "node", "left").withColumn("node", F.coalesce(child, F.col("node"))).drop("dim", "cut")


def _medians(rows: DataFrame, nodes: dict[int, dict], dims: int) -> list[tuple]:
    """(node, dim, cut) for every node of ``nodes`` (dim, target, near): keys under cut go left."""
    cuts, state = {}, {n: (0, 0) for n in nodes}  # node -> prefix of its keys, bytes below it
    keyed = rows.join(F.broadcast(_rows(rows, [(n, x["dim"]) for n, x in nodes.items()], ["node", "dim"])), "node")
    keyed = keyed.select("node", "size", _key(dims).alias("key"))
    above = LEVEL_BITS + LOW_BITS
    for left in ROUNDS:
        open_nodes = [n for n in state if n not in cuts]
        if not open_nodes:
            break
        at = F.broadcast(_rows(rows, [(n, state[n][0], state[n][1], nodes[n]["target"]) for n in open_nodes],
                               ["node", "prefix", "below", "target"]))
        bins = (keyed.join(at, "node").where(F.shiftright("key", above) == F.col("prefix"))
                .groupBy("node", "below", "target", F.shiftright("key", left).alias("bin"))
                .agg(F.sum("size").alias("bytes")))
        order = Window.partitionBy("node").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        upto = F.col("below") + F.sum("bytes").over(order)  # at most 2^15 bins a node
        crossing = (bins.withColumn("upto", upto).where("upto >= target")
                    .groupBy("node").agg(F.min(F.struct("upto", "bin", "bytes")).alias("x")).select("node", "x.*"))
        for r in crossing.collect():  # one row per node
            x, start = nodes[r.node], r.upto - r.bytes
            low_miss, high_miss = x["target"] - start, r.upto - x["target"]
            near = x["near"] * (NEAR_GROUP / NEAR if left == ROW_BITS else 1)
            if min(low_miss, high_miss) <= near or left == 0:
                cuts[r.node] = (r.bin + (high_miss < low_miss)) << left
            state[r.node] = (r.bin, start)
        above = left
    return [(n, nodes[n]["dim"], c) for n, c in cuts.items()]


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              dims: list[str] | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, shard, slot.

    ``size`` is the text's UTF-8 bytes plus one (null: none plus one).  The number of leaves
    is ``shards``, or what makes them ``target_bytes`` large.  Dimensions: the logarithm of
    the size, the columns ``dims`` and the id, each scaled to the table's range; a null or
    NaN number is zero, a null string the empty one, and strings count by their rank.  A group of
    equal texts has the coordinates of its smallest id, so it lies in one shard unless keeping it whole would
    unbalance the shards (``NEAR_GROUP``); then it fills neighbouring ones.  Shards have nearly equal bytes (within about one
    per cent, or one document where documents are larger, however long they are); slots run from 0 without gaps.
    Null ids rank below all others; repeated rows stay with their group.  An empty table gives an empty result;
    other columns of ``docs`` are not read.
    """
    dims = [*(dims or []), doc_id]
    scratch = Scratch(docs.sparkSession)
    raw = scratch.put("metadata", _metadata(docs, dims, text, doc_id, scratch))
    count = len(dims) + 1
    span = raw.agg(F.sum("size").alias("total"), *(f(f"x{i}").alias(f"{n}{i}") for i in range(count)
                                                   for n, f in (("lo", F.min), ("hi", F.max)))).first()
    total = span.total or 0
    if shards is None:
        shards = max(1, math.ceil(total / target_bytes))
    scale = lambda i: (2 ** LEVEL_BITS - 1) / ((span[f"hi{i}"] or 0) - (span[f"lo{i}"] or 0) or 1)
    rows = raw.select("rid", "doc_id", "size", "text_crc32", "low", F.lit(1).cast("long").alias("node"), *(
        F.floor((F.col(f"x{i}") - F.lit(span[f"lo{i}"] or 0.0)) * scale(i)).cast("long").alias(f"l{i}")
        for i in range(count)))

    leaves, open_nodes = [], {1: (0, shards)}  # node -> first shard, number of shards
    while open_nodes:
        leaves += [(n, first) for n, (first, k) in open_nodes.items() if k == 1]
        open_nodes = {n: x for n, x in open_nodes.items() if x[1] > 1}
        if not open_nodes:
            break
        wide = (rows.join(F.broadcast(_rows(rows, [(n,) for n in open_nodes], ["node"])), "node").groupBy("node")
                .agg(F.sum("size").alias("bytes"),
                     *((F.max(f"l{i}") - F.min(f"l{i}")).alias(f"w{i}") for i in range(count))))
        nodes = {}
        for r in wide.collect():  # one row per node
            k = open_nodes[r.node][1]
            nodes[r.node] = {"dim": max(range(count), key=lambda i: r[f"w{i}"]),  # noqa: B023
                             "target": round(r.bytes * (k // 2) / k), "near": NEAR * r.bytes / k}
        cuts = _medians(rows, nodes, count) if nodes else []
        rows = _descend(rows, cuts, count)
        cut_nodes = {n for n, _, _ in cuts}
        children = {}
        for n, (first, k) in open_nodes.items():
            if n in cut_nodes:
                children |= {2 * n: (first, k // 2), 2 * n + 1: (first + k // 2, k - k // 2)}
            else:  # no rows reached this node
                leaves.append((n, first))
        open_nodes = children
    placed = scratch.put("placed", rows.join(F.broadcast(_rows(rows, leaves, ["node", "shard"])), "node")
                         .select("rid", "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard")))
    return _with_slots(placed).select("doc_id", "size", "text_crc32", "shard", "slot")


def _with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard from 0: by the part that wrote a row, then inside the part."""
    parted = placed.withColumn("part", F.shiftright("rid", 33))  # the upper bits of rid name its writing task
    counts = parted.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("rid"))
    return (parted.withColumn("i", inside).join(offsets, ["shard", "part"])
            .withColumn("slot", F.col("offset") + F.col("i") - 1))
