"""Exact distances over tiles against the two passes over the whole array."""

import numpy as np
import pandas as pd
import pytest

from orewise.operators.distance import distance_inside

FAR = 1 << 60


def plain(m):
    """Squared distances by all pairs of a row, then of a column."""
    x = np.arange(m.shape[1])
    g = np.full(m.shape, FAR)
    for r, row in enumerate(m):
        unset = np.flatnonzero(~row)
        if len(unset):
            after = np.clip(np.searchsorted(unset, x), 0, len(unset) - 1)
            g[r] = np.minimum(abs(x - unset[after]), abs(x - unset[np.maximum(after - 1, 0)])) ** 2
    y = np.arange(m.shape[0])
    out = np.full(m.shape, FAR)
    for r in y:
        out[r] = np.minimum((y - r)[:, None] ** 2 + g, FAR).min(0)
    return out


def run(spark, m, tile):
    r, c = np.nonzero(m)
    mask = spark.createDataFrame(pd.DataFrame({"row": r, "col": c}), "row long, col long")
    return distance_inside(mask, m.shape, tile).toPandas()


def check(spark, m, tile):
    got, want = run(spark, m, tile), plain(m)
    here = np.full(m.shape, -1.0)
    here[got.row, got.col] = got.distance.fillna(-2)
    assert len(got) == (here != -1).sum() and (here[m] != -1).all()
    want = np.where(want >= FAR, -2, np.sqrt(want.astype(float)))
    assert np.array_equal(here[here != -1], want[here != -1])


def test_a_million_pixels_over_many_tiles(spark):
    """Large objects with holes: distances reach over two tiles of 64 pixels."""
    rng = np.random.default_rng(5)
    y, x = np.mgrid[:1000, :1000]
    m = np.zeros((1000, 1000), bool)
    for r, c, a, b in [(300, 320, 290, 260), (700, 600, 240, 390), (120, 900, 90, 70)]:
        m |= ((y - r) / a) ** 2 + ((x - c) / b) ** 2 < 1
    for r, c in rng.integers(0, 1000, (12, 2)):
        m[r, c] = False
    m[640:760, 500:503] = False
    assert plain(m).max() > 128**2
    check(spark, m, 64)


@pytest.mark.parametrize("tile", [4, 16, 256])
def test_any_tile(spark, tile):
    rng = np.random.default_rng(tile)
    for share, shape in ((0.9, (40, 37)), (0.995, (33, 70)), (0.5, (9, 50))):
        check(spark, rng.random(shape) < share, tile)
    far = np.ones((50, 61), bool)
    far[49, 60] = False  # one unset pixel in a corner
    check(spark, far, tile)
    lone = np.zeros((40, 40), bool)
    lone[20:22, 3:38] = True  # most tiles aren't there
    check(spark, lone, tile)


def test_no_unset_pixel_and_no_pixel(spark):
    assert run(spark, np.ones((20, 9), bool), 8).distance.isna().all()
    assert not len(run(spark, np.zeros((20, 9), bool), 8))
    mask = spark.createDataFrame([(0, 0), (0, 0), (None, 1), (1, None), (-1, 0), (5, 0), (0, 1)], "row int, col int")
    assert {(r.row, r.col): r.distance for r in distance_inside(mask, (2, 3), 2).collect()} == {(0, 0): 1.0, (0, 1): 1.0, (1, 0): 0.0, (1, 1): 0.0}
    with pytest.raises(ValueError):
        distance_inside(mask, (1 << 21, 1))
