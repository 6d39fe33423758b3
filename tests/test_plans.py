"""Composite stages on the synthetic yard."""

import pytest
from pyspark.sql import functions as F

from orewise.operators import modelling, resample, superres
from orewise.operators.grid import sheet
from orewise.plans import port, stages
from orewise.sources import catalog, synthetic

G = sheet(450, 600)


@pytest.fixture(scope="module")
def yard(spark):
    return synthetic.site(spark, G).withColumn("h", F.col("dsm") - F.col("dtm")).cache()


@pytest.fixture(scope="module")
def coarse(yard):
    """The yard as a 10 m sensor sees it, with occupied shares."""
    px = yard.withColumn("occupied", (F.col("h") > 0.5).cast("double"))
    out = resample.block_mean(px, ["blue", "green", "red", "nir", "occupied"], 10)
    label = px.groupBy(F.floor(F.col("row") / 10).cast("int").alias("row"), F.floor(F.col("col") / 10).cast("int").alias("col")).agg(F.mode("label").alias("label"))
    return out.join(label, ["row", "col"]).cache()


def test_thermal_stage_finds_the_warm_pile(spark, yard):
    scenes = synthetic.thermal_scenes(yard, scenes=8, block=30, hot=1, hot_c=300.0, share=0.05).withColumn("native_m", F.lit(60.0))
    out = {r.label: r for r in stages.thermal_stage(scenes, yard.select("row", "col", "label"), 30, 1.0, (450, 600)).collect()}
    assert out[1].persistence >= 0.5 and out[1].alert in ("warning", "watch") and out[1].mean_dt > max(out[k].mean_dt for k in (4, 8))


def test_port_model_and_erase_test(spark, yard, coarse):
    piles = yard.where("label > 0").groupBy("label").agg(F.sum("h").alias("volume"))
    labels = coarse.select("row", "col", "label")
    model = port.fit(coarse, labels, piles, 2, 100.0, rounds=5)
    assert model.volumes(coarse).count() == 8
    t = port.erase_test(model, coarse, labels).first()
    assert t.passed and t.before > 0


def test_sensor_study(spark, yard):
    px = modelling.spatial_folds(yard.where("label > 0 and row % 3 = 0 and col % 3 = 0"), G)
    study = stages.sensor_study(px, ["blue", "green", "red", "nir"], 9.0, methods=("rf",), rounds=5)
    m = {r.correction: r for r in stages.study_metrics(study).collect()}
    assert set(m) == {"none", "ratio", "power", "quadratic"} and m["none"].n == 8


def test_recent_scene_of_an_unchanged_yard(spark, yard):
    px = yard.where("row % 3 = 0 and col % 3 = 0")
    scene = px.where("col >= 300").select("row", "col", *[(F.col(b) * 1.1).alias(b) for b in port.BANDS])
    model = modelling.fitted(px.where("label > 0"), port.BANDS, "h", 5)
    uav = px.where("label > 0").groupBy("label").agg((F.sum("h") * 9).alias("uav"))
    out = stages.recent_scene(px, scene, model, lambda d: d, port.BANDS, uav, 9.0, least=0.8).collect()
    seen = [r for r in out if r.estimate is not None]
    assert 0 < len(seen) < 8 and abs(sum(r.estimate for r in seen) / sum(r.uav for r in seen) - 1) < 0.25


def test_super_resolution(spark, yard):
    ref = yard.where("row < 120 and col < 120").select("row", "col", "red")
    blur = resample.block_mean(ref, ["red"], 10).select("row", "col", (F.col("red") * 0.9 + 0.01).alias("red"))
    sharp = superres.sharpened(blur, ref, ["red"], 10, (12, 12), rounds=5)
    smooth = superres.bicubic(resample.block_mean(ref, ["red"], 10), ["red"], 10, (12, 12))
    error = lambda d: d.join(ref.withColumnRenamed("red", "t"), ["row", "col"]).agg(F.sqrt(F.avg((F.col("red") - F.col("t")) ** 2))).first()[0]
    assert error(sharp) < error(smooth)


def test_polygon_features(spark, yard):
    f = superres.polygon_features(yard.where("row < 200 and col < 200").select("row", "col", "label"), 1.0, (200, 200))
    r = f.groupBy("label").agg(F.max("depth").alias("d"), F.min("edge_m").alias("e")).collect()
    assert all(x.d == 1.0 and x.e == 1.0 for x in r)


def test_parabola(spark):
    d = spark.range(400).select((F.col("id") / 40).alias("x")).withColumn("y", 1 + 0.5 * F.col("x") + 0.2 * F.col("x") ** 2 + 0.01 * (F.col("x") * 40 % 3 - 1))
    c = modelling.parabola(d, "x", "y").first()
    assert (c.c0, c.c1, c.c2, c.k) == pytest.approx((1, 0.5, 0.2, 1), abs=0.02)
    few = modelling.parabola(d.limit(5), "x", "y").first()
    assert few.c1 == 0.0 and modelling.calibrated(d, modelling.parabola(d, "x", "y"), "x").where("height < 0").count() == 0
    assert modelling.pixel_metrics(d.limit(1), "x", "y").count() == 0


def test_catalog(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.createDataFrame([(0, 0, float("nan"), 5.0)], "row int, col int, b1 double, b2 double").write.parquet(path)
    site = catalog.Site(spark, {"spot": path})
    assert site.read("spot").first().b1 is None and site.read("pleiades") is None
    assert site.optical("spot", {"blue": "b2"}).first().blue == 5.0 and site.first("pleiades", "spot").count() == 1
    with pytest.raises(KeyError):
        site.first("none")
    a = spark.createDataFrame([(0, 0, 1.0), (0, 1, 1.0)], "row int, col int, dsm double")
    b = spark.createDataFrame([(0, 1, 2.0)], "row int, col int, dsm double")
    got = {(r.row, r.col): (r.dsm, r.survey) for r in catalog.mosaic({"a": a, "b": b}, "dsm").collect()}
    assert got == {(0, 0): (1.0, "a"), (0, 1): (2.0, "b")}
    scenes = spark.createDataFrame([(1, "2025-01-01", 5.0, 0.99), (2, "2025-01-03", 1.0, 0.98), (3, "2025-01-03", 30.0, 0.99)], "scene_id int, date string, cloud double, clear double").withColumn("date", F.to_date("date"))
    assert catalog.best_scene(scenes, "2025-01-03", 10).first().scene_id == 2
    assert {r.scene_id for r in catalog.newest_per_date(scenes).collect()} == {1, 3}
    l8 = spark.createDataFrame([(1, "2025-01-01", 0, 0, 40000, 64), (1, "2025-01-01", 0, 1, 40000, 8)], "scene_id int, date string, row int, col int, st int, qa int")
    assert catalog.landsat(l8, l8.withColumn("scene_id", F.lit(2))).count() == 2
    s2 = spark.createDataFrame([(0, 0, 4, 5000.0), (0, 1, 9, 5000.0)], "row int, col int, scl int, b11 double")
    assert [r.b11 for r in catalog.sentinel(s2).collect()] == [0.5]


def test_every_pile_is_left_out_by_itself(spark, monkeypatch):
    """26 piles make 26 fits, each without the pile's zone, and one more for production; groups are an explicit choice."""
    seen = []

    def fake(px, features, label, rounds, seed=42):
        zones = {r.zone for r in px.select("zone").distinct().collect()}
        seen.append(zones)
        return lambda rows: rows.withColumn("p", F.lit(1.0) / len(zones))

    monkeypatch.setattr(modelling, "footprint_probability", fake)
    px = spark.range(26 * 16).select((F.col("id") / 16).cast("int").alias("row"), (F.col("id") % 16).cast("int").alias("col"))
    px = px.select("row", "col", *[((F.col("row") + F.col("col") + k) % 7 / 10.0).alias(b) for k, b in enumerate(port.BANDS)], (F.col("col") % 2).cast("double").alias("occupied"))
    labels = px.select("row", "col", F.when(F.col("col") < 8, F.col("row") + 1).otherwise(0).alias("label"))
    piles = spark.range(1, 28).select(F.col("id").cast("int").alias("label"), (100.0 * F.col("id") ** 1.2).alias("volume"))  # the 27th has no zone
    model = port.fit(px, labels, piles, 1, 100.0)
    everything = set(range(1, 27))
    assert sorted(map(sorted, seen[:-1])) == sorted(sorted(everything - {k}) for k in everything) and seen[-1] == everything
    assert model.accuracy.first().n == 26
    seen.clear()
    port.fit(px, labels, piles, 1, 100.0, groups=3)
    assert len(seen) == 4
