"""The operators on small analytic inputs, and against plain NumPy."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orewise.functions import classes, columns, geo
from orewise.operators import focal, modelling, neighbours, resample, thermal, tiles, validation, vector, zonal
from orewise.operators.components import labelled
from orewise.operators.outlines import outlines
from orewise.operators.grid import Extent, Lattice, around, sheet
from orewise.plans import inventory as plans
from orewise.sources import jobs, synthetic


def frame(spark, a, name="v"):
    r, c = np.nonzero(~np.isnan(a))
    return spark.createDataFrame(pd.DataFrame({"row": r.astype("int32"), "col": c.astype("int32"), name: a[r, c]}))


def array(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        if r[name] is not None:
            out[r.row, r.col] = r[name]
    return out


def cone(n, res, radius, height):
    y, x = (np.mgrid[0:n, 0:n] + 0.5) * res - n * res / 2
    return np.maximum(height * (1 - np.hypot(x, y) / radius), 0)


def test_grids_nest(spark):
    for step in (1.0, 1.5, 3.0, 10.0, 30.0):
        g = Lattice(Extent(1234.5, 5678.9, 2222.2, 6789.1).nested(), step)
        assert all(v % 30 == 0 for v in g.extent) and g.cols * step % 30 == 0 and g.extent.west <= 1234.5 and g.extent.north >= 6789.1
    g = sheet(90, 60)
    assert g.stepped(3.0).cols == 20 and g.part((10, 5), (20, 25)).place_in(g) == (10, 5) and g.cell_area == 1.0
    points = spark.createDataFrame([(1.0, 5.0), (31.0, 64.0)], "x double, y double")
    assert around(points, 10.0) == Lattice(Extent(0.0, 0.0, 60.0, 90.0), 10.0) and around(points, 10.0, 30.0).extent == Extent(-30.0, -30.0, 90.0, 120.0)


def test_cone_volume_and_coverage(spark):
    a = cone(400, 0.5, 40, 12)
    px = frame(spark, np.where(a > 0, a, np.nan), "h").withColumn("label", F.lit(1))
    r = zonal.volumes(px, 0.25).first()
    assert abs(r.volume_m3 / (math.pi * 40**2 * 12 / 3) - 1) < 0.01 and r.sigma_m3 == pytest.approx(r.area_m2 * 0.05)


def test_toe_plane_on_a_slope(spark):
    a = cone(200, 1.0, 40, 12)
    g = sheet(200, 200)
    y, x = np.mgrid[0:200, 0:200] + 0.5
    px = frame(spark, a + 0.05 * x, "dsm").withColumn("label", F.lit(0)).drop("label")
    lab = frame(spark, np.where(a > 0, 1.0, np.nan), "one").select("row", "col", F.lit(1).alias("label"))
    ring = focal.spread(lab, focal.offsets("cross", 2)).select("row", "col", "label").distinct().join(lab, ["row", "col", "label"], "left_anti").join(px, ["row", "col"])
    gx, gy = g.centre(F.col("row"), F.col("col"))
    fits = zonal.toe_planes(ring.select("label", gx.alias("x"), gy.alias("y"), F.col("dsm").alias("z")))
    out = zonal.toe_volumes(lab.join(px, ["row", "col"]).withColumns({"x": gx, "y": gy}), fits, 1.0).first()
    assert abs(out.volume_m3 / (math.pi * 40**2 * 12 / 3) - 1) < 0.05


def test_derived_ground_under_a_pile(spark):
    a = 200 + cone(160, 1.0, 30, 10)
    got = array(focal.derived_ground(frame(spark, a, "dsm"), (160, 160), 1.0, 80.0), "ground", a.shape)
    assert np.abs(got - 200).max() < 1.0 and (got <= a + 1e-9).all()


def test_tile_kernels_equal_whole_arrays(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(53, 41))
    px, grid = frame(spark, a), a.shape
    run = lambda kernel, halo: array(tiles.by_tile(px, kernel, ["v"], {"o": "double"}, grid, halo, tile=16), "o", grid)
    assert np.allclose(run(lambda x: tiles.gauss(x, 1.3), 8), tiles.gauss(a, 1.3))
    assert np.allclose(run(lambda x: tiles.box_mean(x, 4), 4), tiles.box_mean(a, 4))
    assert np.allclose(run(lambda x: tiles.grey_opening(x, tiles.disc(2)), 4), tiles.grey_opening(a, tiles.disc(2)))
    assert np.allclose(run(lambda x: tiles.median_filter(x, 5), 3), tiles.median_filter(a, 5))
    fine = array(resample.cubic(px, "v", 3, grid, tile=16), "v", (159, 123))
    assert np.allclose(fine, tiles.cubic(a, 3), atol=1e-6)
    assert np.allclose(fine.reshape(53, 3, 41, 3)[:, 1, :, 1], a, atol=1e-6)  # the spline passes through the pixels


def test_even_box_reaches_back():
    a = np.arange(6.0)[None, :].repeat(6, 0)
    assert tiles.box_mean(a, 2)[3, 3] == 2.5


def test_morphology(spark):
    rng = np.random.default_rng(3)
    m = rng.random((30, 30)) < 0.7
    px = frame(spark, np.where(m, 1.0, np.nan)).select("row", "col")
    pad = np.pad(m, 1)
    eroded = np.array([[pad[r : r + 3, c : c + 3].all() for c in range(30)] for r in range(30)])
    wide = np.pad(eroded, 1)
    opened = np.array([[wide[r : r + 3, c : c + 3].any() for c in range(30)] for r in range(30)])
    got = {(r.row, r.col) for r in focal.opened(px, focal.offsets("square", 1)).collect()}
    assert got == set(map(tuple, np.argwhere(opened).tolist()))
    assert len(focal.offsets("cross", 2)) == 13 and len(focal.offsets("disc", 3)) == 29


@pytest.mark.parametrize("eight", [True, False])
def test_components_in_raster_order(spark, eight):
    rng = np.random.default_rng(4)
    m = rng.random((60, 70)) < (0.42 if eight else 0.55)
    want, n = np.zeros(m.shape, int), 0
    for r, c in np.argwhere(m):
        if not want[r, c]:
            n += 1
            todo = [(r, c)]
            while todo:
                y, x = todo.pop()
                if 0 <= y < 60 and 0 <= x < 70 and m[y, x] and not want[y, x]:
                    want[y, x] = n
                    todo += [(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if eight or not i * j]
    got = array(labelled(frame(spark, np.where(m, 1.0, np.nan)).select("row", "col"), 70, eight, tile=16), "label", m.shape)
    assert np.array_equal(np.nan_to_num(got), want)


def test_block_mean_round_trip(spark):
    y, x = np.mgrid[0:60, 0:60]
    a = 5 + 0.01 * x + 0.02 * y
    fine, coarse = sheet(60, 60), sheet(6, 6, 10.0)
    c = resample.to_grid(frame(spark, a), "v", fine, coarse)
    back = array(resample.to_grid(c, "v", coarse, fine), "v", a.shape)
    assert np.abs(back - a)[5:-5, 5:-5].max() < 0.02
    gaps = a.copy()
    gaps[:10, :10] = np.nan
    assert resample.block_mean(frame(spark, gaps), ["v"], 10).count() == 35


def test_interpolation_masks_what_it_does_not_know(spark):
    a = np.ones((8, 8))
    a[:, 4:] = np.nan
    out = array(resample.interpolated(frame(spark, a), "v", sheet(8, 8), sheet(16, 16, 0.5)), "v", (16, 16))
    assert not np.isnan(out[:, :7]).any() and np.isnan(out[:, 9:]).all()


def test_polygons(spark):
    square = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    hole = [[4, 4], [6, 4], [6, 6], [4, 6], [4, 4]]
    rows = [
        (1, json.dumps({"type": "MultiPolygon", "coordinates": [[square, hole], [[[12, 0], [14, 0], [14, 2], [12, 0]]]]})),
        (2, json.dumps({"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": [[[8, 8], [12, 8], [12, 12], [8, 12], [8, 8]]]}]})),
    ]
    polys = vector.polygons(spark.createDataFrame(rows, "feature_id int, geom_json string"))
    assert polys.count() == 3
    got = array(vector.rasterized(vector.edges(polys), sheet(20, 20)), "label", (20, 20))
    assert np.nansum(got == 1) == 100 - 4 - 4 + 3 and np.nansum(got == 2) == 16
    with pytest.raises(Exception, match="unsupported"):
        vector.polygons(spark.createDataFrame([(1, '{"type":"Point","coordinates":[1,2]}')], "feature_id int, geom_json string")).collect()


def test_outlines_have_the_pixels_area(spark):
    a = np.full((12, 12), np.nan)
    a[2:8, 3:9], a[4, 5], a[8, 9] = 1, np.nan, 1
    r = outlines(frame(spark, a).select("row", "col", F.col("v").cast("int").alias("label")), sheet(12, 12)).first()
    assert abs(sum(vector.area_of(x) for x in json.loads(r.rings))) == np.nansum(a == 1)


def test_coordinates(spark):
    d = spark.createDataFrame([(6.75, 49.31), (9.0, 0.0), (11.9, 60.0)], "lon double, lat double")
    x, y = geo.to_utm(F.col("lon"), F.col("lat"))
    rows = d.select("lon", "lat", x.alias("x"), y.alias("y")).select("*", *[c.alias(n) for c, n in zip(geo.from_utm(F.col("x"), F.col("y")), ("lon2", "lat2"))]).collect()
    for r in rows:
        assert abs(r.lon2 - r.lon) < 1e-8 and abs(r.lat2 - r.lat) < 1e-8
    assert rows[1].x == pytest.approx(500000) and rows[1].y == pytest.approx(0)


def test_nearest_and_neighbours(spark):
    a = np.full((60, 60), np.nan)
    a[5:15, 5:15], a[5:15, 20:30], a[40:50, 40:50] = 1, 2, 3
    lab = frame(spark, a).select("row", "col", F.col("v").cast("int").alias("label"))
    assert {(r.label, r.other) for r in neighbours.neighbours(lab, 20).collect()} == {(1, 2), (2, 1)}
    px = spark.createDataFrame([(10, 16), (10, 17), (10, 18), (0, 59), (7, 7)], "row int, col int")
    got = {(r.row, r.col): (r.label, r.d2) for r in neighbours.nearest_label(px, lab, 5).collect()}
    assert got == {(10, 16): (1, 4), (10, 17): (1, 9), (10, 18): (2, 4), (7, 7): (1, 0)}


def test_hotspot_inversion(spark):
    hot, bg, area = 150.0, 20.0, 25.0
    mixed = columns.radiance(F.lit(hot + 273.15)) * (area / 1e4) + columns.radiance(F.lit(bg + 273.15)) * (1 - area / 1e4)
    seen = columns.kelvin(mixed) - 273.15
    r = spark.range(1).select(columns.hotspot_celsius(seen, F.lit(bg), area, 100.0).alias("t"), columns.hotspot_celsius(F.lit(30.0), F.lit(bg), 2e4, 100.0).alias("full")).first()
    assert abs(r.t - hot) < 1e-6 and abs(r.full - 30) < 1e-6
    d = spark.range(1).select(*[columns.detectable_celsius(F.lit(20.0), F.lit(0.8), m).alias(f"m{int(m)}") for m in (100.0, 70.0, 5.0)]).first()
    assert 300 < d.m100 < 340 and 180 < d.m70 < 220 and 21 < d.m5 < 23


def test_binomial_tail(spark):
    for n, k in ((0, 0), (1, 1), (10, 3), (48, 5), (300, 20)):
        got = spark.range(1).select(columns.binomial_tail(F.lit(n), F.lit(k), 0.025)).first()[0]
        assert got == pytest.approx(sum(math.comb(n, j) * 0.025**j * 0.975 ** (n - j) for j in range(k, n + 1)), abs=1e-12)


def test_dark_material_is_not_fire(spark):
    rng = np.random.default_rng(6)
    rows = []
    for s in range(10):
        for r in range(10):
            for c in range(10):
                b11 = 0.03 + 0.002 * rng.random()
                b12 = b11 * 1.02 + (0.08 if s == 7 and (r, c) in ((4, 4), (4, 5)) else 0)
                rows.append((s, f"2025-03-{s + 1:02d}", r, c, 1, b11, b12))
    px = spark.createDataFrame(rows, "scene_id int, date string, row int, col int, label int, b11 double, b12 double")
    hits = thermal.swir_hits(px).collect()
    assert [(h.date, h.hot_px) for h in hits] == [("2025-03-08", 2)]


def test_pooled_dates(spark):
    dates = spark.createDataFrame([(1, "2025-01-01"), (2, "2025-01-09")], "label int, date string")
    near = spark.createDataFrame([(1, 2), (2, 1)], "label int, other int")
    got = {r.label: r.swir_dates for r in thermal.pooled(dates, near).collect()}
    assert got == {1: ["2025-01-01", "2025-01-09"], 2: ["2025-01-01", "2025-01-09"]}


@pytest.mark.parametrize(
    "row,level",
    [((2, 0, 0, 1.0, False, False), "critical"), ((0, 3, 4, 0.0001, False, False), "warning"), ((1, 1, 5, 0.1, False, False), "warning"), ((0, 0, 0, 1.0, True, True), "warning"),
     ((1, 0, 3, 1.0, False, False), "watch"), ((0, 1, 9, 0.2, False, False), "watch"), ((0, 0, 0, 1.0, False, True), "watch"), ((0, 0, 5, 1.0, True, False), "none")],
)
def test_alert_ladder(spark, row, level):
    c = [F.lit(x) for x in row]
    got = spark.range(1).select(*[x.alias(n) for x, n in zip(classes.alert(*c, F.lit(3), F.lit(9)), ("a", "why"))]).first()
    assert got.a == level and (got.why is None) == (level == "none")


def test_power_and_ratio_corrections(spark):
    rng = np.random.default_rng(8)
    v = rng.uniform(100, 10_000, 60)
    rows = [(k, k % 5, float(x), float(3 * math.sqrt(x) * math.exp(0.03 * rng.normal()))) for k, x in enumerate(v)]
    df = spark.createDataFrame(rows, "pile_id int, fold int, actual double, pred double")
    out = validation.power_corrected(df)
    assert 1.9 < out.agg(F.median("exponent")).first()[0] < 2.1
    assert validation.metrics(out, pred="corrected").first().wape_pct < 8
    few = df.where("pile_id < 2")
    assert validation.power_corrected(few).where("corrected is not null").count() == 0
    assert validation.ratio_corrected(few).where("corrected is not null").count() == 0
    r = validation.ratio_corrected(df).where("pile_id = 7").first()
    rest = [x for x in rows if x[1] != 2]
    assert r.corrected == pytest.approx(rows[7][3] * sum(x[2] for x in rest) / sum(x[3] for x in rest))
    assert validation.leave_one_out(df.where("pile_id < 7"), "pile_id").where("corrected is not null").count() == 7


def test_metrics_edges(spark):
    one = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "actual double, pred double")
    r = validation.metrics(one).first()
    assert r.n == 1 and r.r2 is None and r.bias == 1.0
    assert validation.metrics(one.limit(0)).first().n == 0


def test_lines(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=2000)
    y = 2 * x + 1 + 0.1 * rng.normal(size=2000)
    y[:40] += 50
    d = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    r = modelling.line(d, "x", "y").first()
    assert abs(r.a - 2) < 0.05 and abs(r.b - 1) < 0.2
    few = modelling.line(d.limit(5), "x", "y").first()
    assert few.a == 0.0


def test_folds_are_blocks(spark):
    g = sheet(600, 600)
    px = spark.createDataFrame([(r, c) for r in range(0, 600, 25) for c in range(0, 600, 25)], "row int, col int")
    rows = modelling.spatial_folds(px, g).collect()
    by = {}
    for r in rows:
        by.setdefault((r.row // 150, r.col // 150), set()).add(r.fold)
    assert all(len(x) == 1 for x in by.values()) and len({r.fold for r in rows}) == 5


def test_synthetic_yard(spark):
    g = sheet(450, 600)
    px = synthetic.site(spark, g).withColumns({"h": F.col("dsm") - F.col("dtm"), "ndvi": F.lit(0.0)}).cache()
    found = plans.detect_piles(px.select("row", "col", "h", "dsm", "ndvi"), g).groupBy("class").count().collect()
    assert {r["class"]: r["count"] for r in found} == {"stockpile": 8, "structure": 3}
    roofs = plans.detect_structures(px.select("row", "col", "h", "ndvi"), g).collect()
    assert len(roofs) == 3 and {r["class"] for r in roofs} == {"roof"}
    piles = plans.inventory(px.drop("h", "ndvi"), g)
    assert piles.count() == 9 - 1 and piles.agg(F.sum("volume_m3")).first()[0] > 0.9 * 55_000
    named = spark.createDataFrame([(1, "coal"), (3, "iron_ore"), (7, "wood_chips"), (4, "limestone")], "label int, commodity string")
    got = {r.label: (r.commodity, r.source) for r in plans.inventory(px.drop("h", "ndvi"), g, named).collect()}
    assert got[1] == ("coal", "client") and got[6] == ("iron_ore", "learned") and got[8] == ("limestone", "learned")


def test_thermal_yard(spark):
    scenes = synthetic.thermal_scenes(synthetic.site(spark), scenes=8).cache()
    obs = scenes.where("cover > 0").select("scene_id", F.lit(1).alias("label"), "row", "col", "lst", (F.col("row") * 0.0 + 1).alias("cover")) if "cover" in scenes.columns else None
    assert obs is None and scenes.groupBy("scene_id").count().count() == 8
    hot = scenes.groupBy("scene_id").agg((F.max("lst") - F.median("lst")).alias("d")).agg(F.min("d")).first()[0]
    assert hot > 0.3


def test_payloads(spark):
    import base64

    enc = lambda s: base64.b64encode(s.encode()).decode()
    good = {"project_uuid": "p", "thermal_start": "2025-01-01", "thermal_end": "2025-02-01", "stockpiles_geojson": '{"type":"Polygon"}'}
    rows = [(1, enc(json.dumps(good))), (2, "%%%"), (3, enc("no json")), (4, enc(json.dumps(good | {"thermal_start": "soon"}))), (5, enc(json.dumps(good | {"thermal_start": "2025-03-01"}))), (6, enc(json.dumps(good | {"stockpiles_geojson": "x"})))]
    got = {r.id: r.error for r in jobs.payloads(spark.createDataFrame(rows, "id int, data string")).collect()}
    assert got[1] is None and all(got[k] for k in range(2, 7))


def test_exports(spark, tmp_path):
    rows = spark.createDataFrame([("a", float("nan"), [1, 2])], "name string, v double, xs array<int>").withColumn("g", F.lit('{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'))
    f = json.loads(jobs.feature_collection(rows, "g", ["name", "v"]).first()[0])
    assert f["properties"] == {"name": "a", "v": None} and f["geometry"]["coordinates"][0][1] == [1.0, 0.0]
    jobs.write_csv(rows, f"file://{tmp_path}/c")
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/c").first().xs == "[1,2]"
    run = spark.sql("select timestamp'2025-01-02 03:04:05' as run_ts, 'p' as pile_id")
    jobs.write_run(run, f"file://{tmp_path}/r")
    jobs.write_run(run, f"file://{tmp_path}/r")
    assert spark.read.parquet(f"file://{tmp_path}/r").where("run_day = '2025-01-02'").count() == 2


def test_streams(spark, tmp_path):
    from orewise.streaming import scenes

    folder = f"{tmp_path}/in"
    spark.createDataFrame([(1, "2025-01-01 01:00:00", 30.0), (1, "2025-01-01 09:00:00", 50.0), (2, "2025-01-02 01:00:00", 10.0)], "label int, ts string, lst double").withColumn("ts", F.to_timestamp("ts")).write.parquet(folder)
    stream = scenes.arrivals(spark, folder, "label int, ts timestamp, lst double")
    q = scenes.into_table(scenes.once_per_date(stream), f"{tmp_path}/out", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    q = scenes.persistence(stream, 20.0).writeStream.outputMode("complete").format("memory").queryName("p").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {r.label: r.share for r in spark.table("p").collect()} == {1: 1.0, 2: 0.0}
    q = scenes.daily(stream).writeStream.outputMode("append").format("memory").queryName("d").trigger(availableNow=True).start()
    q.awaitTermination(120)


def test_mean_of_others(spark):
    """Against each row's own loop: null values, one row, ties and an empty table."""
    values = [1.0, 2.0, None, 2.0, -5.0]
    df = spark.createDataFrame(list(enumerate(values)), "k int, v double")
    got = {r.k: r.others for r in validation.mean_of_others(df, F.col("v")).collect()}
    for k in range(len(values)):
        rest = [v for j, v in enumerate(values) if j != k and v is not None]
        assert abs(got[k] - sum(rest) / len(rest)) < 1e-12
    assert validation.mean_of_others(df.where("k = 1"), F.col("v")).first().others is None
    assert validation.mean_of_others(df.limit(0), F.col("v")).count() == 0


def test_shared_rings(spark):
    """Objects that share a ring get what each would get from a copy of it."""
    obs = spark.createDataFrame([(s, k, k, 0, 20.0 + k * s, 0.1 * k) for s in (1, 2) for k in range(1, 7)], "scene_id int, label int, row int, col int, lst double, cover double")
    rings = obs.select("scene_id", "label", (F.col("label") % 2).alias("ring")).distinct()
    shared = spark.createDataFrame([(s, g, float(10 * g + v * v)) for s in (1, 2) for g in (0, 1) for v in range(5)], "scene_id int, ring int, lst double")
    one = thermal.contrasts(obs, rings.join(shared, ["scene_id", "ring"]).drop("ring"))
    two = thermal.contrasts(obs, shared, rings=rings)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.select(*one.columns).collect())) and one.count() == 12


def test_coverage_of_each_label_by_itself(spark):
    """Layers in one pass: overlapping footprints don't take from each other, and each equals its own mask's coverage."""
    px = spark.range(60 * 300).select((F.col("id") / 300).cast("int").alias("row"), (F.col("id") % 300).cast("int").alias("col"))
    label = F.when(F.col("row").between(10, 30) & F.col("col").between(240, 260), 1).when(F.col("row").between(31, 50) & F.col("col").between(240, 280), 2)
    own = px.withColumn("label", label).where("label is not null")
    cells = lambda d: {(r.row, r.col): round(r.cover, 9) for r in d.collect()}
    both = focal.coverage(own, 20.0, 1.0, (60, 300), 10, by=("label",)).cache()
    for k in (1, 2):
        alone = cells(focal.coverage(own.where(F.col("label") == k).select("row", "col"), 20.0, 1.0, (60, 300), 10))
        assert cells(both.where(F.col("label") == k)) == alone
        assert sum(alone.values()) * 100 == pytest.approx({1: 21 * 21, 2: 20 * 41}[k], rel=1e-6)  # blurring keeps the area
    assert focal.coverage(own.where("label > 9"), 20.0, 1.0, (60, 300), 10, by=("label",)).count() == 0
