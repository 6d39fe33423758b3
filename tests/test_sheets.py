"""Queries on sheets over several tiles against the whole array at once."""

from collections import deque

import numpy as np
import pytest

from orewise import queries as yard
from orewise.operators import tiles
from orewise.queries import sheets
from orewise.queries.inputs import Inputs
from test_outlines import walked

yard.load()
SF = "/root/testdata/sf0.01"


def array(df, name, n):
    rows = df.toPandas()
    out = np.full((n, n), np.nan)
    out[rows.row, rows.col] = rows[name]
    assert not rows.duplicated(["row", "col"]).any()
    return out


@pytest.fixture(scope="module")
def sheet(spark):
    i = Inputs(spark, SF)
    n = sheets.side(i)
    assert n == 512  # four tiles
    mask = sheets.objects(i).toPandas()
    m = np.zeros((n, n), bool)
    m[mask.row, mask.col] = True
    return n, m, array(sheets.cells(i), "v", n)


@pytest.fixture(scope="module")
def flooded(sheet):
    """Objects numbered in raster order of their first cells, by search from cell to cell."""
    n, m, _ = sheet
    out, k = np.zeros((n, n), int), 0
    for start in map(tuple, np.argwhere(m)):
        if not out[start]:
            k += 1
            out[start], todo = k, deque([start])
            while todo:
                r, c = todo.popleft()
                for y in range(max(r - 1, 0), min(r + 2, n)):
                    for x in range(max(c - 1, 0), min(c + 2, n)):
                        if m[y, x] and not out[y, x]:
                            out[y, x] = k
                            todo.append((y, x))
    return out


def run(spark, name):
    return yard.QUERIES[name](spark, SF)


def test_components(spark, sheet, flooded):
    n, m, _ = sheet
    assert np.array_equal(np.nan_to_num(array(run(spark, "n15_sheet_components"), "label", n)).astype(int), flooded)
    crossing = set(flooded[:, 255]) & set(flooded[:, 256]) - {0}
    assert crossing  # objects reach over the seam


def test_zonal(spark, sheet, flooded):
    _, _, v = sheet
    got = {r.label: (r.n, r.total, r.top) for r in run(spark, "a01_sheet_zonal").collect()}
    own = (flooded > 0) & ~np.isnan(v)
    want = {}
    for label, x in zip(flooded[own], v[own]):
        want.setdefault(label, []).append(x)
    assert got == {k: (len(x), pytest.approx(sum(x)), max(x)) for k, x in want.items()}


def test_rings(spark, sheet, flooded):
    n, got = sheet[0], {}
    for p in sorted(run(spark, "r06_sheet_rings").collect(), key=lambda p: (p.label, p.ring, p.part)):
        got.setdefault((p.label, divmod(p.ring, n + 1)), []).extend(divmod(int(k), n + 1) for k in p.corners.split(","))
    assert got == walked(flooded)


def test_neighbours(spark, sheet, flooded):
    n, want = sheet[0], set()
    for dr in range(-2, 3):
        for dc in range(-2, 3):
            if dr * dr + dc * dc <= 4:
                a = flooded[max(dr, 0) : n + min(dr, 0), max(dc, 0) : n + min(dc, 0)]
                b = flooded[max(-dr, 0) : n + min(-dr, 0), max(-dc, 0) : n + min(-dc, 0)]
                both = (a > 0) & (b > 0) & (a != b)
                want |= set(zip(a[both].tolist(), b[both].tolist()))
    assert {(r.label, r.other) for r in run(spark, "j07_sheet_neighbours").collect()} == want


@pytest.mark.parametrize("name, column, kernel", [
    ("n04_sheet_gaussian", "smooth", lambda a: tiles.gauss(a, 2.0)),
    ("n08_sheet_thin", "height", lambda a: np.minimum(a, tiles.grey_opening(a, tiles.disc(2)))),
    ("n13_sheet_median", "median", lambda a: tiles.median_filter(a, 5)),
])
def test_kernels_over_seams(spark, sheet, name, column, kernel):
    n, _, v = sheet
    assert np.allclose(array(run(spark, name), column, n), kernel(np.nan_to_num(v)), atol=1.1e-4)


def test_ground(spark, sheet):
    """Blocks of 4, opening with a disc of 2, blur, linear between block values from corner to corner, never above the surface."""
    n, _, v = sheet
    v = np.nan_to_num(v)
    low = v.reshape(n // 4, 4, n // 4, 4).min((1, 3))
    g = tiles.gauss(tiles.grey_opening(low, tiles.disc(2)), 1.0)
    at = np.arange(n) * ((n // 4 - 1) / (n - 1))
    k = np.minimum(np.floor(at).astype(int), n // 4 - 2)
    t = at - k
    rows = g[k] * (1 - t)[:, None] + g[k + 1] * t[:, None]
    want = np.minimum(rows[:, k] * (1 - t) + rows[:, k + 1] * t, v)
    assert np.allclose(array(run(spark, "n10_sheet_ground"), "ground", n), want, atol=1.1e-4)


@pytest.mark.parametrize("name", ["n04_sheet_gaussian", "n02_sheet_box", "n13_sheet_median", "n08_sheet_thin"])
def test_rows_are_shuffled_once(spark, name):
    """Rows of a cell meet in its tile: they aren't grouped by cell before, and no value is rounded by way of a decimal."""
    plan = run(spark, name)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "HashAggregate" not in plan and "round(" not in plan


def test_repeated_pixels(spark):
    """Of a pixel's rows the greatest value counts, nulls don't, NaN is the greatest (and missing): SQL's max."""
    nan = float("nan")
    px = spark.createDataFrame([(0, 0, 5.0), (0, 0, 7.0), (0, 0, 6.0), (0, 1, None), (0, 1, -2.0), (1, 0, None), (1, 1, nan), (1, 1, 9.0)], "row int, col int, v double")
    got = {(r.row, r.col): r.out for r in tiles.by_tile(px, lambda a: a, ["v"], {"out": "double"}, (2, 3), 0, absent=1.0, repeated=True).collect()}
    assert got == {(0, 0): 7.0, (0, 1): -2.0, (0, 2): 1.0, (1, 0): None, (1, 1): None, (1, 2): 1.0}


def test_median_of_odd_windows():
    a = np.random.default_rng(3).normal(size=(40, 33))
    b = np.pad(a, 2, mode="symmetric")
    want = np.median(np.lib.stride_tricks.sliding_window_view(b, (5, 5)), axis=(2, 3))
    assert np.array_equal(tiles.median_filter(a, 5), want)
