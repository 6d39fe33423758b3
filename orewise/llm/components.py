"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, written


def _least(edges: DataFrame) -> DataFrame:
    """u, m: the least of u and its neighbours."""
    return edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))


def _joined(batches):
    """Union-find over the edges of one task."""
    up: dict = {}

    def root(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(x) for x in nodes], pa.int64())], ["node", "component"])


def connected_components(edges: DataFrame, max_rounds: int = 60, few: int = 0) -> DataFrame:
    """edges(u long, v long), no nulls -> node, component (the least node reachable).

    Loops, repeated edges and either direction are allowed; nodes without an edge don't
    appear. An empty table gives an empty one. Each round is written to the shared folder,
    so that a lost executor costs one round and plans stay short. Neighbours are never
    gathered in a row: a hub's edges stay rows, its least neighbour is a partial aggregate. At
    most `few` edges, counted first, are joined in one task instead, which saves the rounds' shuffles.
    """
    now = written(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    if few and now.count() <= few:
        return now.select("u", "v").repartition(1).mapInArrow(_joined, "node long, component long")
    before = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = (
            large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = written(small, "edges")
        dropped(now)
        now = after
        state = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
