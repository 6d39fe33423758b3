"""Filters of patches against loops over pixels; the mode that super-resolution takes."""

import math

import numpy as np
import pytest

from orewise import queries as yard
from orewise.operators import patches, resample, superres, tiles
from orewise.operators.grid import sheet
from orewise.sources import synthetic

yard.load()
F2 = 2


def table(spark, a, name="v"):
    rows = [(int(r), int(c), None if np.isnan(a[r, c]) else float(a[r, c])) for r, c in np.ndindex(a.shape)]
    return spark.createDataFrame(rows, f"row int, col int, {name} double").repartition(5)


def mirrored(k, n):
    return -k - 1 if k < 0 else 2 * n - 1 - k if k >= n else k


def patch(a, r, c):
    near = [a[mirrored(r + y, a.shape[0]), mirrored(c + x, a.shape[1])] for y in range(-2, 3) for x in range(-2, 3)]
    return np.array(near) - sum(near) / 25


def kind(p):
    gx, gy = (p[13] - p[11]) / 2, (p[17] - p[7]) / 2
    sector = int(math.atan2(gy, gx) % math.pi / (math.pi / 8)) % 8
    return sector + (8 if 4 * (gx * gx + gy * gy) < sum(p * p) / 25 else 0)


def looped(fine, factor):
    """(row, col) -> patch and rest of a whole array's blocks, one by one."""
    h, w = fine.shape[0] // factor, fine.shape[1] // factor
    mean = lambda x: np.nan if np.isnan(x).all() else np.nanmean(x)
    coarse = np.array([[mean(fine[r * factor : (r + 1) * factor, c * factor : (c + 1) * factor]) for c in range(w)] for r in range(h)])
    up, out = tiles.cubic(np.nan_to_num(coarse), factor), {}
    for r, c in np.ndindex(h, w):
        block = (slice(r * factor, (r + 1) * factor), slice(c * factor, (c + 1) * factor))
        p, rest = patch(coarse, r, c), (fine[block] - up[block]).ravel()
        if not np.isnan(p).any() and not np.isnan(rest).any():
            out[r, c] = (p, rest)
    return coarse, up, out


def by_least_squares(pairs):
    """The same filters as stacked least squares: ridge and leaning are rows of their own."""
    x, y = (np.array(v) for v in zip(*pairs))
    spread = (x**2).sum() / 25
    ridge = math.sqrt(1e-6 * spread) * np.eye(25)
    base = np.linalg.lstsq(np.vstack((x, ridge)), np.vstack((y, np.zeros((25, y.shape[1])))), rcond=None)[0]
    lean = math.sqrt(50 * spread / len(x)) * np.eye(25)
    out = {}
    for k in range(16):
        mine = np.array([kind(p) == k for p in x])
        out[k] = np.linalg.lstsq(np.vstack((x[mine], lean)), np.vstack((y[mine], lean @ base)), rcond=None)[0]
    return out


@pytest.fixture(scope="module")
def scene():
    """520 x 60 fine pixels: 260 coarse rows cross a tile's edge; one pixel is missing."""
    rng = np.random.default_rng(5)
    a = rng.random((520, 60))
    a = tiles.gauss(a, 1.5) * 10 + np.where(np.add.outer(np.arange(520), np.arange(60)) % 37 < 12, 1.0, 0.0)
    a[101, 33] = np.nan
    return a


@pytest.fixture(scope="module")
def loops(scene):
    return looped(scene, F2)


def test_filters_equal_least_squares(spark, scene, loops):
    coarse, up, pairs = loops
    got = {r.kind: np.array(r.weights).reshape(25, 4) for r in patches.trained(table(spark, scene), ["v"], F2, (260, 30)).collect()}
    want = by_least_squares(list(pairs.values()))
    assert set(got) == set(range(16)) and len(pairs) < 260 * 30
    for k in want:
        assert np.allclose(got[k], want[k], atol=1e-6), k


def test_patched_equals_the_loop(spark, scene, loops):
    coarse, up, pairs = loops
    filters = patches.trained(table(spark, scene), ["v"], F2, (260, 30))
    own = {r.kind: np.array(r.weights).reshape(25, 4) for r in filters.collect()}
    rows = patches.patched(table(spark, coarse), filters, ["v"], F2, (260, 30)).collect()
    assert len(rows) == scene.size and len({(r.row, r.col) for r in rows}) == scene.size
    got = np.zeros(scene.shape)
    for r in rows:
        got[r.row, r.col] = r.v
    want = up.copy()
    for r, c in np.ndindex(coarse.shape):
        p = patch(coarse, r, c)
        if not np.isnan(p).any():
            want[2 * r : 2 * r + 2, 2 * c : 2 * c + 2] += (p @ own[kind(p)]).reshape(2, 2)
    assert np.allclose(got, want, atol=1e-4)  # the spline's memory is cut at a tile's halo


def test_scores_leave_each_fold_out(spark, scene, loops):
    _, _, pairs = loops
    folds = spark.createDataFrame([(r, c, r // 26 % 3) for r in range(260) for c in range(30)], "row int, col int, fold int")
    got = patches.scored(table(spark, scene), ["v"], F2, (260, 30), folds).first()
    plain = sharp = 0.0
    for f in range(3):
        use = by_least_squares([v for (r, _), v in pairs.items() if r // 26 % 3 != f])
        for (r, _), (p, rest) in pairs.items():
            if r // 26 % 3 == f:
                plain += (rest**2).sum()
                sharp += ((rest - p @ use[kind(p)]) ** 2).sum()
    n = 4 * len(pairs)
    assert got.n == n and got.rmse_bicubic == pytest.approx(math.sqrt(plain / n), abs=1e-5)
    assert got.rmse_sr == pytest.approx(math.sqrt(sharp / n), abs=1e-5) and got.improvement_pct == pytest.approx(100 * (1 - got.rmse_sr / got.rmse_bicubic))
    assert got.improvement_pct > 5


def test_filters_of_another_site_and_radiometry(spark):
    """Filters trained on one half of the yard sharpen the other half in other units."""
    px = synthetic.site(spark, sheet(450, 600)).select("row", "col", "red").cache()
    left, right = px.where("row < 200 and col < 200"), px.where("row < 200 and col >= 300 and col < 500").withColumn("col", (px.col - 300).cast("int"))
    filters = patches.trained(left, ["red"], 4, (50, 50))
    coarse = resample.block_mean(right, ["red"], 4)
    scaled = coarse.selectExpr("row", "col", "red * 40 - 7 as red")
    truth = right.withColumnRenamed("red", "t")
    error = lambda d, e="red": d.join(truth, ["row", "col"]).selectExpr(f"sqrt(avg(pow({e} - t, 2))) e").first().e
    sharp = error(patches.patched(coarse, filters, ["red"], 4, (50, 50)))
    assert sharp < error(superres.bicubic(coarse, ["red"], 4, (50, 50)))
    assert error(patches.patched(scaled, filters, ["red"], 4, (50, 50)), "(red + 7) / 40") == pytest.approx(sharp, rel=1e-6)


def test_mode_taken(spark):
    rng = np.random.default_rng(2)
    fine = tiles.gauss(rng.random((80, 80)), 2.0)
    ref = table(spark, fine)
    coarse = resample.block_mean(ref, ["v"], 4)
    filters = patches.trained(ref, ["v"], 4, (20, 20))
    mode = lambda method, **have: superres.resolved(coarse, ["v"], 4, (20, 20), method, rounds=2, **have).select("mode").distinct().collect()[0].mode
    assert mode("patches", filters=filters, reference=ref) == "patches"
    assert mode("patches", reference=ref) == "reference" and mode("patches") == "bicubic"
    assert mode("patches", filters=filters.where("kind < 0")) == "bicubic"
    assert mode("patches", filters=filters.withColumn("factor", filters.factor + 1)) == "bicubic"
    assert mode("reference", filters=filters, reference=ref) == "reference"
    assert mode("reference", filters=filters, reference=ref.where("row < 0")) == "bicubic" and mode("reference", reference=ref.drop("v")) == "bicubic"
    assert mode("bicubic", filters=filters, reference=ref) == "bicubic" and mode("other", filters=filters) == "bicubic"


def test_flat_missing_and_empty(spark):
    flat = table(spark, np.full((16, 16), 3.0))
    filters = patches.trained(flat, ["v"], 4, (4, 4))
    out = patches.patched(resample.block_mean(flat, ["v"], 4), filters, ["v"], 4, (4, 4)).collect()
    assert len(out) == 256 and all(r.v == pytest.approx(3.0) for r in out)
    assert patches.trained(flat.where("row < 0"), ["v"], 4, (4, 4)).count() == 0
    assert patches.trained(table(spark, np.full((16, 16), np.nan)), ["v"], 4, (4, 4)).count() == 0
    folds = spark.createDataFrame([(r, c, r % 2) for r in range(4) for c in range(4)], "row int, col int, fold int")
    got = patches.scored(flat, ["v"], 4, (4, 4), folds).first()
    assert got.rmse_sr == pytest.approx(0.0, abs=1e-9) and patches.scored(flat.where("row < 0"), ["v"], 4, (4, 4), folds).count() == 0


def test_sheet(spark):
    rows = yard.QUERIES["m10_sheet_patches"](spark, "/root/testdata/sf0.01").selectExpr("count(*) n", "count(distinct row, col) u", "min(mode) a", "max(mode) b", "count(v) v").first()
    assert rows.n == rows.u == rows.v == 512 * 512 and rows.a == rows.b == "patches"
    score = yard.QUERIES["m10_sheet_scores"](spark, "/root/testdata/sf0.01").first()
    assert score.n == 512 * 512 and 0 < score.rmse_sr < score.rmse_bicubic
