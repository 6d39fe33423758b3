"""Leave-one-out by blocks against a plain loop, for more folds than any block holds."""

import numpy as np
import pytest

from orewise.operators import validation
from orewise.sources.tables import written


def plain(rows):
    """(key, fold, actual, pred) -> key: corrected, each fold by itself."""
    used = np.array([(f, a, p) for _, f, a, p in rows if a is not None and p is not None and a > 0 and p > 0])
    out = {}
    for key, fold, _, pred in rows:
        rest = used[used[:, 0] != fold]
        if len(rest) < 4 or pred is None:
            out[key] = None
            continue
        x, y = np.log(rest[:, 2]), np.log(rest[:, 1])
        b, c = np.polyfit(x, y, 1)
        e = min(max(b, 0.5), 2.5)
        k = rest[:, 1].sum() / max((np.exp(c) * rest[:, 2] ** e).sum(), 1e-9)
        out[key] = k * np.exp(c) * max(pred, 0) ** e
    return out


def check(found, rows):
    want = plain(rows)
    got = {r.pile_id: r.corrected for r in found.collect()}
    assert set(got) == set(want)
    for key, x in want.items():
        assert got[key] == (None if x is None else pytest.approx(x, rel=1e-9))


def made(n, folds, seed):
    rng = np.random.default_rng(seed)
    v = rng.uniform(100, 10_000, n)
    rows = [(k, int(rng.integers(folds)) if folds else k, float(x), float(3 * x**0.6 * np.exp(0.2 * rng.normal()))) for k, x in enumerate(v)]
    rows[1] = (*rows[1][:3], rows[0][3])  # equal areas
    return rows + [(n, n, None, 50.0), (n + 1, n + 1, 10.0, None), (n + 2, n + 2, 0.0, 5.0), (n + 3, n + 3, 7.0, -5.0)]


SCHEMA = "pile_id int, fold int, actual double, pred double"


def test_fifteen_hundred_piles(spark):
    rows = made(1500, 0, 1)
    check(validation.leave_one_out(spark.createDataFrame(rows, SCHEMA), "pile_id"), rows)


@pytest.mark.parametrize("folds", [2, 7])
def test_folds(spark, folds):
    rows = made(90, folds, folds)
    check(validation.power_corrected(spark.createDataFrame(rows, SCHEMA)), rows)


def test_blocks_of_any_size(spark):
    rng = np.random.default_rng(3)
    fits = [(k, float(e)) for k, e in enumerate(rng.uniform(0.5, 2.5, 37))]
    values = [(int(rng.integers(50)), float(x), 2.0) for x in rng.uniform(0, 5, 101)]
    tables = [written(spark.createDataFrame(t, s)) for t, s in ((fits, "f int, e double"), (values, "f int, x double, w double"))]
    for size in ((4, 7), (1000, 1000)):
        got = {r.f: r.s for r in validation.power_sums(*tables, size).collect()}
        for f, e in fits:
            assert got[f] == pytest.approx(sum(w * np.exp(e * x) for g, x, w in values if g != f))


def test_none_to_fit(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert validation.power_corrected(empty).count() == 0
    rows = [(1, None, 5.0, 4.0)] + [(k, k, 5.0 + k, 4.0 + k) for k in range(2, 9)]
    got = {r.pile_id: r.corrected for r in validation.power_corrected(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] is None and all(got[k] is not None for k in range(2, 9))
