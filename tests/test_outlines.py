"""Rings over tiles against one walk round each object."""

import json

import numpy as np
import pandas as pd
import pytest

from orewise.operators.grid import sheet
from orewise.operators.outlines import outlines, ring_parts


def walked(a):
    """(label, least corner) -> corners where the ring turns, by following one edge after the other."""
    edges = {}
    for r, c in np.argwhere(a > 0):
        for (dr, dc), (p, q) in {(-1, 0): ((0, 0), (0, 1)), (0, 1): ((0, 1), (1, 1)), (1, 0): ((1, 1), (1, 0)), (0, -1): ((1, 0), (0, 0))}.items():
            y, x = r + dr, c + dc
            if not (0 <= y < a.shape[0] and 0 <= x < a.shape[1]) or a[y, x] != a[r, c]:
                edges[(a[r, c], (r + p[0], c + p[1]), (q[0] - p[0], q[1] - p[1]))] = (r + q[0], c + q[1])
    out = {}
    while edges:
        label, start, way = min(edges, key=lambda k: (k[1], k[2] != (0, 1)))
        ring, at = [], start
        while True:
            to = edges.pop((label, at, way), None)
            if to is None:
                break
            right, left = (way[1], -way[0]), (-way[1], way[0])
            new = next((w for w in (right, way, left) if (label, to, w) in edges), None)
            at = to
            if new is None:
                ring.append(to)
                break
            if new != way:
                ring.append(to)
            way = new
        ring = ring[-1:] + ring[:-1]
        out[label, ring[0]] = ring
    return out


def frame(spark, a):
    r, c = np.indices(a.shape)
    return spark.createDataFrame(pd.DataFrame({"row": r.ravel(), "col": c.ravel(), "label": a.ravel()}), "row int, col int, label int")


def check(spark, a, tile):
    parts = ring_parts(frame(spark, a), *a.shape, tile).collect()
    got, biggest = {}, 0
    for p in sorted(parts, key=lambda p: (p.label, p.ring, p.part)):
        own = [divmod(k, a.shape[1] + 1) for k in p.corners]
        got.setdefault((p.label, divmod(p.ring, a.shape[1] + 1)), []).extend(own)
        biggest = max(biggest, len(own))
    assert got == walked(a)
    for key in got:
        assert [p.part for p in sorted(parts, key=lambda p: p.part) if (p.label, divmod(p.ring, a.shape[1] + 1)) == key][0] == 0
    return biggest


@pytest.mark.parametrize("tile", [3, 8, 256])
def test_any_tile(spark, tile):
    rng = np.random.default_rng(tile)
    a = (rng.random((23, 31)) < 0.6) * rng.integers(1, 3, (23, 31))
    check(spark, a, tile)
    a = np.ones((20, 17), int)
    a[5:9, 3:14], a[12, 12], a[13, 13] = 0, 0, 0
    check(spark, a, tile)


def test_a_large_object_with_holes(spark):
    """One object over 16 x 16 tiles: rings of thousands of corners, no part above a tile's border."""
    y, x = np.mgrid[:256, :256]
    a = ((np.hypot(y - 128, x - 128) < 120) & (np.hypot(y - 100, x - 90) > 30) & (np.hypot(y - 170, x - 150) > 25)).astype(int)
    a[60:64, 150:153] = 0
    a[128, 20:236:2] = 2
    assert check(spark, a, 16) <= 16 * 16 * 4
    comb = np.zeros((64, 200), int)
    comb[:4], comb[:, ::2] = 1, 1  # one ring through all tiles
    check(spark, comb, 16)


def test_text_of_rings(spark):
    a = np.ones((12, 12), int) * (np.hypot(*(np.mgrid[:12, :12] - 5.5)) < 5)
    a[5, 5] = 0
    (row,) = outlines(frame(spark, a), sheet(12, 12, 2.0), 4).collect()
    rings = json.loads(row.rings)
    area = lambda p: sum(p[k][0] * p[k + 1][1] - p[k + 1][0] * p[k][1] for k in range(len(p) - 1)) / 2
    assert len(rings) == 2 and all(r[0] == r[-1] for r in rings)
    assert abs(sum(map(area, rings))) == a.sum() * 4 and area(rings[0]) < 0 < area(rings[1])


def test_nothing(spark):
    assert ring_parts(frame(spark, np.zeros((4, 4), int)), 4, 4).count() == 0
    few = spark.createDataFrame([(0, 0, None), (1, 1, -3)], "row int, col int, label int")
    assert outlines(few, sheet(4, 4)).count() == 0
