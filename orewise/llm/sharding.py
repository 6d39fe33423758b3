"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns many arcs of the ring (its virtual nodes). A row's hash puts it on an arc
and so at that arc's shard; a shard takes only as many rows as its capacity, and what
overflows an arc continues clockwise to the next arcs whose shards have room. Capacities
are the mean, rounded down or up, so counts differ by one at most.

Only counts for each arc (shards x virtual nodes, whatever the input) are planned on the
driver: which ranks of an arc go to which shard, and from which slot on. Rows find theirs
by their rank within the arc, which adds the counts of the cells before to the rank within
one of the arc's many cells, so no task sees a whole arc.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

SHARDS, VIRTUAL_NODES = 24, 64
#: Cells of the ring; each is ranked in one task. A multiple is needed at most per 1e6 rows.
CELLS = 1 << 14
#: Rows that are equal in every column are counted first and dealt out again in runs of so many.
RUN = 1 << 16


def ring(spark: SparkSession, shards: int, virtual: int) -> list[tuple[int, int]]:
    """(position, shard) of every virtual node, by position; positions are unsigned 31-bit hashes."""
    nodes = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(virtual - 1))).alias("v"))
    at = F.shiftrightunsigned(F.xxhash64(F.lit("node"), "shard", "v"), 33)
    return sorted((r.at, r.shard) for r in nodes.select(at.alias("at"), "shard").collect())


def plan(counts: list[int], owners: list[int], shards: int) -> list[list[tuple[int, int, int, int]]]:
    """Rows of each arc in ring order -> per arc (first rank, rows, shard, first slot).

    Shards first take rows of their own arcs, in ring order, up to capacity; then the
    overflow of each arc, in ring order, goes on clockwise to arcs of shards with room.
    """
    total = sum(counts)
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in counts]
    over: deque[tuple[int, int, int]] = deque()

    def take(arc: int, rank: int, rows: int, shard: int) -> int:
        n = min(rows, capacity[shard] - used[shard])
        if n:
            out[arc].append((rank, n, shard, used[shard]))
            used[shard] += n
        return n

    for arc, rows in enumerate(counts):
        n = take(arc, 0, rows, owners[arc])
        if n < rows:
            over.append((arc, n, rows - n))
    for arc, rank, rows in over:
        at = arc
        while rows:
            at = (at + 1) % len(counts)
            n = take(arc, rank, rows, owners[at])
            rank, rows = rank + n, rows - n
    return out


def bounded_ring(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL_NODES, cells: int = CELLS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, size, text_crc32, home_shard, shard, slot: a row for a row.

    size is the text's UTF-8 bytes plus 8 and text_crc32 its checksum (null: 8 and 0). Rows
    hash by all three; rows equal in all three are interchangeable and take neighbouring
    ranks. A null doc_id hashes like any other value. slots of a shard count from 0 without
    a gap. Fewer rows than shards leave some empty; an empty table gives an empty one. Other
    columns aren't read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.encode(F.col("text").cast("string"), "utf-8"), F.lit("").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    hashed = F.xxhash64("doc_id", "size", "text_crc32")
    groups = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n")).withColumn("h", F.shiftrightunsigned(hashed, 33))

    nodes = ring(spark, shards, virtual)
    ends, owners = [p for p, _ in nodes], [s for _, s in nodes]
    # Cells cut the ring evenly; a cell that a node cuts has two or more arcs, and is ranked by both.
    width = (1 << 31) // cells
    edges = sorted({0, *(e + 1 for e in ends), *range(0, 1 << 31, width)})
    of_edge = [bisect_right([e + 1 for e in ends], e) % len(ends) for e in edges]
    fence = spark.createDataFrame([(k, e, a) for k, (e, a) in enumerate(zip(edges, of_edge))], "cell int, low long, arc int")
    by_slice = fence.withColumn("slice", F.floor(F.col("low") / width).cast("int"))
    lists = by_slice.groupBy("slice").agg(F.sort_array(F.collect_list(F.struct("low", "cell", "arc"))).alias("fence"))
    placed = written(
        groups.withColumn("slice", F.floor(F.col("h") / width).cast("int"))
        .join(F.broadcast(lists), "slice")
        .withColumn("at", F.element_at(F.filter("fence", lambda x: x.low <= F.col("h")), -1))
        .select("doc_id", "size", "text_crc32", "n", "h", "at.cell", "at.arc"),
        "ring",
    )

    per_cell = placed.groupBy("cell", "arc").agg(F.sum("n").alias("rows"))
    found = {(r.cell, r.arc): r.rows for r in per_cell.collect()}  # at most cells + nodes rows
    counts, before = [0] * len(nodes), []
    # An arc that passes the ring's end begins at the cells after the last node.
    order = sorted(range(len(edges)), key=lambda k: (of_edge[k], edges[k] <= ends[of_edge[k]], edges[k]))
    for k in order:
        before.append((k, counts[of_edge[k]]))
        counts[of_edge[k]] += found.get((k, of_edge[k]), 0)
    moves = [
        (arc, owners[arc], rank, rank + n, shard, slot) for arc, parts in enumerate(plan(counts, owners, shards)) for rank, n, shard, slot in parts
    ]
    offsets = spark.createDataFrame(before, "cell int, before long")
    # The plan has a row for each arc and each overflow; their number follows the ring alone.
    segments = (
        spark.createDataFrame(moves, "arc int, home_shard int, low long, high long, shard int, slot long")
        .groupBy("arc", "home_shard")
        .agg(F.sort_array(F.collect_list(F.struct("low", "high", "shard", "slot"))).alias("segments"))
    )
    rank = F.coalesce(F.sum("n").over(Window.partitionBy("cell").orderBy("h", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = placed.withColumn("rank", rank).join(F.broadcast(offsets), "cell").withColumn("rank", F.col("rank") + F.col("before"))
    runs = ranked.select(
        "doc_id", "size", "text_crc32", "arc", "rank", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / RUN))).alias("run")
    )
    each = runs.select(
        "doc_id", "size", "text_crc32", "arc", "rank",
        F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("n"), (F.col("run") + 1) * RUN) - 1)).alias("k"),
    ).withColumn("rank", F.col("rank") + F.col("k"))
    return (
        each.join(F.broadcast(segments), "arc")
        .withColumn("to", F.element_at(F.filter("segments", lambda x: x.low <= F.col("rank")), -1))
        .select("doc_id", "size", "text_crc32", "home_shard", F.col("to.shard").alias("shard"), (F.col("to.slot") + F.col("rank") - F.col("to.low")).alias("slot"))
    )
