"""Borders of labelled objects as rings of corners, over tiles: no group is larger than a tile.

A border is a chain of directed unit edges, the object to their right. A tile follows the edges
that start at its own corners; what closes there is a ring, what leaves it is a part that names the edge
it came by and the edge it left by. Parts are joined across tiles by pointer doubling: in each
round every part looks twice as far ahead, first for the ring's least corner, which names the
ring, then for the part's place behind it. Rounds grow with the logarithm of the parts of a ring.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .grid import Lattice

TILE = 256
#: East, south, west, north: the step of an edge, and its inner and outer pixel as seen from the corner where it starts.
_STEP = np.array([(0, 1), (1, 0), (0, -1), (-1, 0)])
_INNER = [(0, 0), (0, -1), (-1, -1), (-1, 0)]
_OUTER = [(-1, 0), (0, 0), (0, -1), (-1, -1)]
_FAR = 1 << 62


def _jumped(step: np.ndarray, value: np.ndarray, join) -> tuple[np.ndarray, np.ndarray]:
    """Pointer doubling over an array of successors (its length: none): last pointers, and values joined along the way."""
    n = len(step)
    step = np.append(step, n)
    for _ in range(n.bit_length() + 1):
        value = join(value, value[step])
        step = step[step]
    return step[:n], value[:n]


def _chains(labels: np.ndarray, top: int, left: int, tile: int, width: int):
    """Labels of a tile with two pixels around it (its first is at row top, column left) -> chains of edges that start at its corners.

    Each is (label, came by, left by, corners where it turns); a ring has -1 for both edges. Edges and corners are
    numbered over the whole lattice.
    """
    h, w = labels.shape
    r, c = (x.ravel() for x in np.mgrid[1 : h - 1, 1 : w - 1])  # corners within one step of the tile's own
    found = []
    for d in range(4):
        inner, outer = (labels[r + a, c + b] for a, b in (_INNER[d], _OUTER[d]))
        there = (inner > 0) & (inner != outer)
        found.append((r[there], c[there], np.full(there.sum(), d), inner[there]))
    r, c, d, label = map(np.concatenate, zip(*found))
    own = lambda r, c: (r >= 2) & (r < 2 + tile) & (c >= 2) & (c < 2 + tile)
    number = ((r + top) * (width + 1) + c + left) * 4 + d
    at = np.full((h + 2, w + 2, 4), -1)
    mine = own(r, c)
    e = np.flatnonzero(mine)
    at[r[e], c[e], d[e]] = e
    # The edge that follows: to the right if the object goes on there, else ahead, else to the left.
    end = r + _STEP[d, 0], c + _STEP[d, 1]
    after = np.full(len(r), -1)
    for turn in (3, 0, 1):
        x = at[end[0], end[1], (d + turn) % 4]
        after = np.where((x >= 0) & (label[x] == label), x, after)
    stays = own(*end)
    n = len(r)
    before = np.full(n, -1)
    ahead = np.flatnonzero(stays & (after >= 0))
    before[after[ahead]] = ahead
    place = np.full(n + 1, -1)
    place[e] = np.arange(len(e))
    k = len(e)
    forth = np.where(stays[e], place[after[e]], k)
    back = np.where((before[e] >= 0) & mine[before[e]], place[before[e]], k)
    # Rings: those that never end. They start at their least edge, whose corner is their least.
    corner = number[e]
    last, least = _jumped(forth, np.append(corner, _FAR), np.minimum)
    ring = last < k
    starts = ring & (corner == least)
    back = np.where(starts, k, back)
    _, steps = _jumped(back, np.append(np.ones(k, int), 0), np.add)
    _, first = _jumped(back, np.append(np.arange(k), -1), lambda a, b: np.where(b >= 0, b, a))
    order = np.lexsort((steps, first))
    turns = d[e] != np.where(before[e] >= 0, d[before[e]], -1)
    cuts = np.flatnonzero(np.diff(first[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(order))):
        chain = order[a:b]
        corners = corner[chain[turns[chain]]] // 4
        closed = ring[chain[0]]
        came = -1 if closed else int(number[before[e[chain[0]]]])
        yield int(label[e[chain[0]]]), came, -1 if closed else int(corner[chain[-1]]), corners


def ring_parts(labels: DataFrame, rows: int, cols: int, tile: int = TILE) -> DataFrame:
    """labels(row, col, label) on a lattice -> label, ring long, part int, corners array<long>.

    A corner is row * (cols + 1) + col of the lattice's corners. A ring is named by its least corner,
    where its first part begins; parts in order give the corners where it turns, clockwise round the
    object and the other way round its holes. Objects that touch at a corner only stay apart. Labels
    of 0 or below and null ones are background, as are pixels that aren't there; a pixel has one row.
    """
    own = labels.where("label > 0").select(F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), F.col("label").cast("int").alias("label"))
    near = lambda x: F.sequence(F.floor((x - 2) / tile), F.floor((x + 2) / tile))
    dealt = own.select("*", F.explode(near(F.col("row"))).alias("tr")).select("*", F.explode(near(F.col("col"))).alias("tc")).where("tr >= 0 and tc >= 0")

    def run(table: pa.Table) -> pa.Table:
        top, left = table.column("tr")[0].as_py() * tile - 2, table.column("tc")[0].as_py() * tile - 2
        a = np.zeros((tile + 4, tile + 4), np.int64)
        a[table.column("row").to_numpy() - top, table.column("col").to_numpy() - left] = table.column("label").to_numpy()
        out = list(zip(*_chains(a, top, left, tile, cols))) or [[], [], [], []]
        kinds = pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64())
        return pa.table([pa.array(list(x), t) for x, t in zip(out, kinds)], names=["label", "came", "gone", "corners"])

    chains = written(dealt.groupBy("tr", "tc").applyInArrow(run, "label int, came long, gone long, corners array<long>"))
    closed = chains.where("came < 0").select("label", F.element_at("corners", 1).alias("ring"), F.lit(0).alias("part"), "corners")
    least = F.coalesce(F.array_min("corners"), F.lit(_FAR))
    open_ = chains.where("came >= 0").select("label", F.col("came").alias("id"), F.col("gone").alias("next"), least.alias("own"), "corners")

    # The least corner of each ring: every part looks 1, 2, 4, ... parts ahead.
    now = written(open_.select("id", "next", F.col("own").alias("low"), F.lit(True).alias("new")))
    ahead = lambda: now.select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("low").alias("_low"))
    while now.where("new").limit(1).count():
        both = now.join(ahead(), F.col("next") == F.col("_id"))
        now = written(both.select("id", F.col("_next").alias("next"), F.least("low", "_low").alias("low"), (F.col("_low") < F.col("low")).alias("new")))
    named = written(open_.join(now.select("id", "low"), "id"))
    # The place behind the ring's first part: the part before that has no next one.
    firsts = named.where("own = low").select(F.col("id").alias("lead"))
    ends = named.join(firsts, F.col("next") == F.col("lead"), "left")
    now = written(ends.select("id", F.when(F.col("lead").isNull(), F.col("next")).alias("next"), F.lit(1).cast("long").alias("rest")))
    while now.where("next is not null").limit(1).count():
        far = now.select(F.col("id").alias("_id"), F.col("next").alias("_next"), F.col("rest").alias("_rest"))
        both = now.join(far, F.col("next") == F.col("_id"), "left")
        now = written(both.select("id", F.col("_next").alias("next"), (F.col("rest") + F.coalesce("_rest", F.lit(0))).alias("rest")))
    placed = named.join(now.select("id", "rest"), "id")
    size = placed.where("own = low").select("low", F.col("rest").alias("parts"))
    placed = placed.join(size, "low").withColumn("part", (F.col("parts") - F.col("rest")).cast("int"))
    # The first part begins at the least corner; what lies before that ends the ring.
    cut = F.array_position("corners", F.col("low")).cast("int")
    whole = F.array(F.struct(F.col("part").alias("part"), F.col("corners").alias("corners")))
    halves = F.array(
        F.struct(F.lit(0).alias("part"), F.slice("corners", cut, F.size("corners")).alias("corners")),
        F.struct(F.col("parts").cast("int").alias("part"), F.slice("corners", 1, cut - 1).alias("corners")),
    )
    split = placed.select("label", F.col("low").alias("ring"), F.explode(F.when(F.col("own") == F.col("low"), halves).otherwise(whole)).alias("p"))
    return closed.unionByName(split.select("label", "ring", "p.part", "p.corners").where(F.size("corners") > 0))


def outlines(labels: DataFrame, grid: Lattice, tile: int = TILE) -> DataFrame:
    """row, col, label -> label, rings (JSON): the closed rings of each object by their least corners, as a sink takes them.

    A ring's text is one value; who needs no text of a whole object takes ring_parts().
    """
    parts = ring_parts(labels, grid.rows, grid.cols, tile)
    ring = parts.groupBy("label", "ring").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("part", "corners"))), lambda p: p["corners"])).alias("c"))
    point = lambda k: F.array(F.lit(grid.extent.west) + (k % (grid.cols + 1)) * grid.step, F.lit(grid.extent.north) - F.floor(k / (grid.cols + 1)) * grid.step)
    ring = ring.select("label", "ring", F.transform(F.concat("c", F.slice("c", 1, 1)), point).alias("points"))
    every = ring.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("ring", "points"))).alias("rings"))
    return every.select("label", F.to_json(F.transform("rings", lambda r: r["points"])).alias("rings"))
