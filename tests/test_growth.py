"""Steps whose work has to grow no faster than their input."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from orewise.llm import decontaminate
from orewise.operators import components, distance, focal, neighbours, tiles


def test_as_of_meets_days_not_rows(spark):
    """200,000 rows of one key a side within three days: 10^10 pairs of rows, but nine of days."""
    day = lambda k: F.date_add(F.lit("2020-01-01"), (F.col("id") % k).cast("int"))
    left = spark.range(200_000).select("id", F.lit(1).alias("k"), day(3).alias("d"))
    right = spark.range(200_000).select(F.col("id").alias("scene"), F.lit(1).alias("k"), day(2).alias("d2"), (-F.col("id")).alias("cloud"))
    got = neighbours.as_of(left, right, "k", "d", "d2", 20, [F.col("cloud"), F.col("scene")])
    assert {tuple(r) for r in got.groupBy("d", "scene", "apart").count().collect()} == {
        (datetime.date(2020, 1, 1), 199_998, 0, 66_667), (datetime.date(2020, 1, 2), 199_999, 0, 66_667), (datetime.date(2020, 1, 3), 199_999, 1, 66_666)
    }


def test_as_of_by_loops(spark):
    rng = np.random.default_rng(3)
    first = datetime.date(1969, 12, 1)
    made = lambda n: [(k, int(rng.integers(4)) or None, None if rng.random() < 0.1 else first + datetime.timedelta(int(rng.integers(80)))) for k in range(n)]
    left, right = made(150), [(*x, int(rng.integers(3))) for x in made(60)]
    l = spark.createDataFrame(left + left[:5], "id int, k int, d date")  # noqa: E741
    r = spark.createDataFrame(right, "scene int, k int, d date, cloud int")
    got = neighbours.as_of(l, r, "k", "d", "d", 6, [F.col("cloud"), F.col("scene").desc()])
    assert got.columns == ["id", "k", "d", "scene", "_k", "_d", "cloud", "apart"]
    want = set()
    for i, k, d in left:
        near = [(abs((e - d).days), c, -s) for s, j, e, c in right if k and k == j and d and e and abs((e - d).days) <= 6]
        if near:
            want.add((i, -min(near)[2], min(near)[0]))
    rows = [(x.id, x.scene, x.apart) for x in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


def test_latent_space_has_no_sample(spark):
    """Weights come from all documents' counts and directions from all items, so the order of words in other documents changes nothing."""
    rng = np.random.default_rng(5)
    items = [[f"w{k}" for k in rng.choice(400, 40, False)] for _ in range(30)]
    others = [[f"w{k}" for k in rng.choice(2000, 64, False)] for _ in range(300)]
    leaks = [others[k][:30] + items[k] + others[k][30:] for k in range(12)]
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], "item_id long, text string")
    found = []
    for texts in (others, [rng.permutation(x).tolist() for x in others]):
        docs = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(leaks + texts)], "doc_id long, text string")
        found.append({(r.doc_id, r.item_id): round(r.cosine, 4) for r in decontaminate.leaks(docs, benchmark).collect() if r.doc_id < 12})
    assert set(found[0]) == {(k, k) for k in range(12)} and min(found[0].values()) > 0.3
    assert found[0] == found[1]


def test_boxes_go_to_tiles_whole(spark):
    """Overlapping boxes over seams and borders: only their corners are shuffled, and each pixel comes once."""
    boxes = [(-2, 3, 5, 4), (6, 6, 4, 9), (7, 1, 30, 8), (20, 20, 1, 1), (3, 3, 0, 5), (2, 28, 2, 9)]
    want = np.zeros((26, 31), bool)
    for r, c, h, w in boxes:
        want[max(r, 0) : max(r + h, 0), max(c, 0) : max(c + w, 0)] = True
    got = tiles.painted(spark.createDataFrame(boxes, "row int, col int, high int, wide int"), (26, 31), 8).collect()
    assert len(got) == want.sum() and {(r.row, r.col) for r in got} == set(zip(*(x.tolist() for x in np.nonzero(want))))


def test_absent_pixels_need_no_rows(spark):
    """Two pixels of a grid of 600 x 300: all tiles come back, and equal the filled array's blur."""
    px = spark.createDataFrame([(255, 255, 7.0), (599, 0, 3.0)], "row int, col int, v double")
    a = np.zeros((600, 300))
    a[255, 255], a[599, 0] = 7, 3
    got = focal.gaussian(px, "v", 2.0, (600, 300), absent=0.0).toPandas()
    out = np.full(a.shape, np.nan)
    out[got.row, got.col] = got.smooth
    assert np.allclose(out, tiles.gauss(a, 2.0))


def test_tiles_get_tasks_of_their_own(spark):
    """A tile's rows are few bytes whatever its work is, so sizes would leave all tiles to one task (2 tasks for 256 tiles before)."""
    boxes = spark.range(4000).select((F.col("id") % 1000 * 4).cast("int").alias("row"), (F.col("id") * 2 % 4000).cast("int").alias("col"), F.lit(2).alias("high"), F.lit(3).alias("wide"))
    for out in (tiles.painted(boxes, (4096, 4096)), tiles.painted_tiles(boxes, (4096, 4096)), focal.opened_boxes(boxes, (4096, 4096), focal.offsets("square", 1))):
        assert out.rdd.getNumPartitions() == 32
    plan = focal.opened_boxes(boxes, (4096, 4096), focal.offsets("square", 1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # boxes are shuffled, pixels aren't


def test_boxes_are_opened_in_their_tiles(spark):
    rng = np.random.default_rng(9)
    rows = [tuple(map(int, x)) for x in zip(rng.integers(-3, 41, 60), rng.integers(-3, 53, 60), rng.integers(0, 7, 60), rng.integers(0, 7, 60))]
    boxes, shape = spark.createDataFrame(rows, "row int, col int, high int, wide int"), focal.offsets("square", 1)
    kernel, halo = focal._steps(shape, [np.logical_and, np.logical_or])
    mask = tiles.painted(boxes, (40, 52), 8)
    want = {tuple(r) for r in focal.opened(mask, shape).collect()}
    got = tiles.painted(boxes, (40, 52), 8, kernel, halo).collect()
    assert len(got) == len(want) > 0 and {tuple(r) for r in got} == want
    bits = {(r.tr * 8 + y, r.tc * 8 + x) for r in tiles.painted_tiles(boxes, (40, 52), 8).collect() for y, x in np.argwhere(tiles.unpacked(r.bits, 8)).tolist()}
    assert bits == {tuple(r) for r in mask.collect()}


def test_filled_tiles_get_tasks_of_their_own(spark):
    """Ten pixels of a grid of 64 tiles: eight tasks, where partitions by size had one."""
    px = spark.range(10).select(F.col("id").cast("int").alias("row"), F.col("id").cast("int").alias("col"), F.lit(1.0).alias("v"))
    for f in (lambda p, g: focal.gaussian(p, "v", 2.0, g, absent=0.0), lambda p, g: focal.box(p, "v", 5, g, absent=0.0), lambda p, g: focal.median5(p, "v", g, absent=0.0), lambda p, g: focal.without_thin(p, "v", 2.0, 1.0, g, absent=0.0)):
        assert f(px, (2048, 2048)).rdd.getNumPartitions() == 8


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distances_get_tasks_of_their_own(spark):
    """64 tiles of a few bytes each: all distances were made in one task."""
    mask = spark.range(64).select((F.floor(F.col("id") / 8) * 256 + 9).cast("int").alias("row"), (F.col("id") % 8 * 256 + 9).cast("int").alias("col"))
    got = distance.distance_inside(mask, (2048, 2048))
    assert got.rdd.getNumPartitions() == 8
    assert [tuple(r) for r in got.groupBy("distance").count().orderBy("distance").collect()] == [(0.0, 2048 * 2048 - 64), (1.0, 64)]


def test_labels_meet_pixels_by_tile(spark):
    """Values meet a tile's labels, which are one row."""
    rng = np.random.default_rng(2)
    m = rng.random((40, 40)) < 0.5
    mask = spark.createDataFrame([tuple(map(int, x)) for x in np.argwhere(m)], "row int, col int")
    px = spark.createDataFrame([(r, c, float(r * 40 + c)) for r in range(-2, 42) for c in range(42) if (r + c) % 3], "row int, col int, v double")
    table = components.label_tiles(mask, 40, tile=8)
    assert table.count() == 25
    got = components.inside(px, table, 25, 8)
    want = {(r.row, r.col): r.label for r in components.labelled(mask, 40, tile=8).collect()}
    assert len(want) == m.sum()
    rows = got.collect()
    assert len(rows) == sum((r + c) % 3 > 0 for r, c in want)
    assert all(r.label == want[r.row, r.col] and r.v == r.row * 40 + r.col for r in rows)


def test_neighbours_leave_tiles_as_pairs(spark):
    """Random labels over seams, some pixels with two: the same pairs as by loops, without a join of pixels."""
    rng = np.random.default_rng(8)
    rows = {(int(r), int(c), int(k)) for r, c, k in zip(rng.integers(240, 272, 260), rng.integers(-16, 16, 260), rng.integers(0, 40, 260))}
    rows |= {(r, c, 77) for r in range(250, 256) for c in range(-3, 3)}
    labels = spark.createDataFrame(sorted(rows), "row int, col int, label int")
    for reach in (1, 3):
        got = neighbours.neighbours(labels, reach)
        assert "Join" not in _plan(got) and got.schema["label"].dataType.simpleString() == "int"
        want = {(a[2], b[2]) for a in rows for b in rows if a[2] and b[2] and a[2] != b[2] and abs(a[0] - b[0]) + abs(a[1] - b[1]) <= reach}
        found = [(r.label, r.other) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == want
