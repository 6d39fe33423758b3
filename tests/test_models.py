"""Trees against trees grown here, every split tried; folds and samples against what they promise."""

from collections import Counter

import numpy as np
import pytest

from orewise import queries as yard
from orewise.operators import modelling
from orewise.queries import fits
from orewise.queries.inputs import Inputs
from pyspark.sql import functions as F

yard.load()
SF = "/root/testdata/sf0.001"


def grown(x, y, depth=5, columns=None, rng=None, cuts=None):
    """A tree of least squares as a function, five levels: the best of all cuts halfway between the table's neighbouring values, the lowest of equal ones."""
    cuts = cuts or [(v[1:] + v[:-1]) / 2 for v in map(np.unique, x.T)]
    mean = y.mean()
    best = (1e-12, None, None)
    tried = range(x.shape[1]) if columns is None else rng.choice(x.shape[1], columns, replace=False)
    for k in tried if depth and len(y) > 1 else ():
        order = np.argsort(x[:, k], kind="stable")
        v, s = x[order, k], np.cumsum(y[order] - mean)
        at = np.flatnonzero(v[1:] > v[:-1])
        if len(at):
            n = at + 1
            gain = s[at] ** 2 / n + (s[-1] - s[at]) ** 2 / (len(y) - n)
            top = int(gain.argmax())
            if gain[top] > best[0]:
                best = (gain[top], k, cuts[k][np.searchsorted(cuts[k], v[at[top]])])
    if best[1] is None:
        return lambda z: np.full(len(z), mean)
    left = x[:, best[1]] <= best[2]
    a, b = (grown(x[m], y[m], depth - 1, columns, rng, cuts) for m in (left, ~left))
    return lambda z: np.where(z[:, best[1]] <= best[2], a(z), b(z))


def boosted(x, y, rounds):
    """The first tree as it is, each next one a tenth of a tree of the squared error's slope."""
    trees = [(1.0, grown(x, y))]
    total = lambda z: sum(w * t(z) for w, t in trees)
    for _ in range(rounds - 1):
        trees.append((0.1, grown(x, 2 * (y - total(x)))))
    return total


def forest(x, y, rounds, seed=1):
    rng, trees = np.random.default_rng(seed), []
    for _ in range(rounds):
        drawn = rng.integers(0, len(y), len(y))
        trees.append(grown(x[drawn], y[drawn], columns=max(1, -(-x.shape[1] // 3)), rng=rng))
    return lambda z: sum(t(z) for t in trees) / rounds


def by_folds(fit, x, y, fold):
    out = np.zeros(len(y))
    for k in np.unique(fold):
        out[fold == k] = fit(x[fold != k], y[fold != k])(x[fold == k])
    return out


@pytest.fixture(scope="module")
def points():
    """3,000 rows; features of 8 values, so that every cut between values is a candidate and no two cuts part a node alike."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 8, (3000, 3)).astype(float)
    y = np.sin(x[:, 0]) * 5 + x[:, 1] * (x[:, 2] > 3) + rng.normal(0, 0.5, 3000)
    return x, y, rng.integers(0, 3, 3000)


def rows(spark, points):
    x, y, fold = points
    return spark.createDataFrame([(k, *map(float, r), float(v), int(f)) for k, (r, v, f) in enumerate(zip(x, y, fold))], "id int, a double, b double, c double, h double, fold int")


def test_boosted_trees_row_by_row(spark, points):
    got = {r.id: r.pred for r in modelling.out_of_fold(rows(spark, points), ["a", "b", "c"], "h", 3, rounds=6).collect()}
    want = by_folds(lambda x, y: boosted(x, y, 6), *points)
    assert np.allclose([got[k] for k in range(3000)], want, atol=1e-6)


def test_forest_by_tolerance(spark, points):
    got = {r.id: r.pred for r in modelling.out_of_fold(rows(spark, points), ["a", "b", "c"], "h", 3, kind="rf", rounds=40).collect()}
    mine, want = np.array([got[k] for k in range(3000)]), by_folds(lambda x, y: forest(x, y, 40), *points)
    assert np.corrcoef(mine, want)[0, 1] > 0.95
    rmse = lambda p: np.sqrt(((p - points[1]) ** 2).mean())
    assert rmse(mine) == pytest.approx(rmse(want), rel=0.15)


@pytest.mark.parametrize("name,fit", [("m04_out_of_fold", lambda x, y: boosted(x, y, 5)), ("m04_random_forest", lambda x, y: forest(x, y, 10))])
def test_queries_of_models(spark, name, fit):
    """Errors of each fold as those of our own trees, which try every split where MLlib tries 32 bins."""
    p = fits._modelled(Inputs(spark, SF)).where("blue is not null and green is not null and red is not null and nir is not null").orderBy("row", "col").toPandas()
    want = by_folds(fit, p[["blue", "green", "red", "nir"]].to_numpy(), p.h.to_numpy(), p.fold.to_numpy())
    got = {r.fold: r for r in yard.QUERIES[name](spark, SF).collect()}
    assert set(got) == set(p.fold)
    for k, r in got.items():
        own = (p.fold == k).to_numpy()
        assert r.n == own.sum() and r.rmse == pytest.approx(np.sqrt(((want - p.h.to_numpy())[own] ** 2).mean()), rel=0.15)


def test_downscaled_row_by_row(spark):
    """Features differ within a coarse pixel but their means have few values: equal to our own trees with the residual put back."""
    rng = np.random.default_rng(4)
    base = rng.integers(0, 12, (12, 12, 2)).astype(float)
    fine = base.repeat(2, 0).repeat(2, 1)
    fine += np.tile(np.array([[-1.0, 1.0], [1.0, -1.0]]), (12, 12))[:, :, None] * np.repeat(np.repeat(rng.integers(0, 4, (12, 12, 2)), 2, 0), 2, 1)
    lst = 10 + 2 * base[:, :, 0] - base[:, :, 1] + rng.normal(0, 0.3, (12, 12))
    f = spark.createDataFrame([(r, c, *map(float, fine[r, c])) for r, c in np.ndindex(24, 24)], "row int, col int, a double, b double")
    coarse = spark.createDataFrame([(r, c, float(lst[r, c])) for r, c in np.ndindex(12, 12)], "row int, col int, lst double")
    got = np.zeros((24, 24))
    for r in modelling.downscaled(coarse, f, ["a", "b"], 2, rounds=5).collect():
        got[r.row, r.col] = r.lst
    pred = boosted(base.reshape(-1, 2), lst.ravel(), 5)(fine.reshape(-1, 2)).reshape(24, 24)
    mean = pred.reshape(12, 2, 12, 2).mean((1, 3))
    assert np.allclose(got, np.clip(pred + (lst - mean).repeat(2, 0).repeat(2, 1), -40, 80), atol=1e-6)


@pytest.mark.parametrize("name", ["m20_downscaled", "g12_forest_downscaled"])
def test_queries_of_downscaling(spark, name):
    """Each coarse mean is kept, unless a value was cut at the physical bounds, and detail differs within it."""
    px = Inputs(spark, SF).px.select("row", "col", "dsm")
    got = yard.QUERIES[name](spark, SF).join(px, ["row", "col"]).withColumns({"r": F.floor(F.col("row") / 4), "c": F.floor(F.col("col") / 4)})
    cells = got.groupBy("r", "c").agg(F.avg("lst").alias("a"), F.avg("dsm").alias("b"), F.min("lst").alias("low"), F.max("lst").alias("high"), F.count("*").alias("n"), F.countDistinct("lst").alias("k")).toPandas()
    inside = (cells.low > -40) & (cells.high < 80)
    assert cells.n.sum() == px.count() and inside.mean() > 0.9 and np.allclose(cells.a[inside], cells.b[inside], atol=2e-4) and (cells.k > 1).mean() > 0.5


def test_folds(spark):
    px = Inputs(spark, SF).px.select("row", "col").toPandas()
    got = yard.QUERIES["m02_spatial_folds"](spark, SF).toPandas()
    assert Counter(zip(got.row, got.col)) == Counter(zip(px.row, px.col))
    block = modelling.DEFAULT.fold_block_m / 10.0
    own = {}
    for r, c, f in zip(got.row, got.col, got.fold):
        own.setdefault((int((r + 0.5) // block), int((c + 0.5) // block)), set()).add(f)
    assert all(len(f) == 1 for f in own.values())
    sizes = Counter(next(iter(f)) for f in own.values())
    assert set(sizes) == set(range(min(modelling.DEFAULT.folds, len(own))))


def test_balanced_sample(spark):
    px = Inputs(spark, SF).lpx.where("h is not null")
    want = {(r.row, r.col): r.h for r in px.select("row", "col", "h").collect()}
    got = yard.QUERIES["m03_balanced_sample"](spark, SF).collect()
    assert len(got) == len({(r.row, r.col) for r in got}) and all(r.h == pytest.approx(want[r.row, r.col], abs=1e-4) for r in got)
    sizes = Counter(h > 10 for h in want.values())
    assert Counter(want[r.row, r.col] > 10 for r in got) == {k: min(200, n) for k, n in sizes.items()}
    # The rows of least hash, as one window over each stratum would rank them.
    h = F.xxhash64(F.lit(42), "row", "col")
    least = [r for s in ("h > 10", "not h > 10") for r in px.where(s).orderBy(h, "row", "col").limit(200).collect()]
    assert {(r.row, r.col) for r in got} == {(r.row, r.col) for r in least}
