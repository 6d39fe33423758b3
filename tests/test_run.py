"""Restarts of a run, the two-chain study, quality bits and samples."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from orewise import queries as yard
from orewise.operators import modelling
from orewise.plans import chains
from orewise.plans.run import Run, Stage, content
from orewise.sources import catalog

yard.load()
SF = "/root/testdata/sf0.001"


def stages(calls, fail=()):
    def stage(name, make, needs, **settings):
        def run(t, s):
            calls.append(name)
            if name in fail:
                raise RuntimeError("killed")
            return make(t, s)

        return Stage(name, run, needs, settings)

    return [
        stage("doubled", lambda t, s: t["a"].withColumn("x", F.col("x") * s["by"]), ("a",), by=2),
        stage("counted", lambda t, s: t["b"].groupBy("k").count(), ("b",)),
        stage("joined", lambda t, s: t["doubled"].join(t["counted"], "k"), ("doubled", "counted")),
        stage("summed", lambda t, s: t["joined"].agg(F.sum("x").alias("x")), ("joined",)),
    ]


def test_restart(spark, tmp_path):
    a = spark.createDataFrame([(1, 2.0), (2, None), (2, None)], "k int, x double")
    b = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    folder, inputs = f"file://{tmp_path}/run", {"a": a, "b": b}
    for k, name in enumerate(["counted", "joined", "summed"], 1):  # killed in one stage after the other
        calls, run = [], Run(spark, folder)
        with pytest.raises(RuntimeError):
            run(stages(calls, {name}), inputs)
        assert calls[-1] == name and run.read == ["doubled", "counted", "joined"][: k - 1]
    calls, run = [], Run(spark, folder)
    out = run(stages(calls), inputs)
    assert calls == ["summed"] and run.read == ["doubled", "counted", "joined"]
    fresh = Run(spark, f"file://{tmp_path}/other")(stages([]), inputs)
    assert all(content(out[k]) == content(fresh[k]) for k in fresh)
    # A stage whose files are lost is made again; what depends on it is unchanged and read.
    (lost,) = [d for d in os.listdir(tmp_path / "run") if d.startswith("joined-")]
    (part,) = [f for f in os.listdir(tmp_path / "run" / lost) if f.endswith(".parquet")][:1]
    os.remove(tmp_path / "run" / lost / part)
    calls, run = [], Run(spark, folder)
    run(stages(calls), inputs)
    assert calls == ["joined"] and run.read == ["doubled", "counted", "summed"]
    shutil.rmtree(tmp_path / "run" / lost)
    calls, run = [], Run(spark, folder)
    run(stages(calls), inputs)
    assert calls == ["joined"]
    # Another input: only what follows from it is made; a stage that comes out the same stops that.
    calls, run = [], Run(spark, folder)
    out = run(stages(calls), {"a": a, "b": spark.createDataFrame([(2,), (1,), (1,)], "k int")})
    assert calls == []
    run(stages(calls), {"a": a, "b": spark.createDataFrame([(1,), (3,)], "k int")})
    assert calls == ["counted", "joined", "summed"]


def test_content(spark):
    one = spark.createDataFrame([(1, None), (2, "a")], "k int, v string")
    assert content(one) == content(one.orderBy(F.desc("k"))) != content(one.union(one))
    assert content(one) != content(one.fillna("")) != content(one.withColumnRenamed("v", "w"))


def test_site_run(spark):
    out = yard.QUERIES["c08_site_run"](spark, SF).collect()
    assert len({r.label for r in out}) == len(out) > 50
    assert all(r.tonnage_t is None or r.tonnage_t > 0 for r in out) and any(r.predicted for r in out)
    assert all(r.estimate is None or r.change is not None for r in out)


def test_chains(spark):
    rows = {(r.chain, r.method): r for r in yard.QUERIES["m18_chains"](spark, SF).collect()}
    assert set(rows) == {("footprint", "power"), ("height", "power"), ("height", "raw")}
    assert all(r.n == 16 for r in rows.values()) and sum(r.chosen for r in rows.values()) <= 1


def test_choice_of_a_chain(spark):
    p = [(k, c, m, 100.0 + k, (100.0 + k) * f) for k in range(4) for c, m, f in (("footprint", "power", 1.3), ("height", "power", 0.9), ("height", "raw", 1.05))]
    predicted = spark.createDataFrame(p, "label int, chain string, method string, actual double, predicted double")
    pick = lambda **r: [(x.chain, x.method) for x in chains.chosen(predicted, spark.createDataFrame(list(r.items()), "chain string, response double")).where("chosen").collect()]
    assert pick(footprint=0.5, height=0.5) == [("height", "raw")]
    assert pick(footprint=0.5, height=0.19) == [("footprint", "power")]
    assert pick(footprint=0.1, height=0.0) == []


def test_transfer(spark):
    rows = yard.QUERIES["c14_transfer"](spark, SF).collect()
    seen = [r for r in rows if r.predicted is not None]
    assert len(rows) == 32 and {r.label for r in rows} - {r.label for r in seen} == {4, 8, 12, 16}  # half of these zones is missing
    assert all(abs(r.change - 1) < 0.1 and abs(r.predicted / r.actual - 1) < 0.1 for r in seen)  # the same scene in other levels


def test_least_hashes(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("kind"), "id").repartition(7)
    take = lambda df, n: sorted((r.kind, r.id) for r in modelling.least_hashes(df, "kind", n, ["id"]).collect())
    import hashlib

    want = []
    for kind in range(3):
        own = sorted((hashlib.md5(f"42:{k}".encode()).hexdigest(), k) for k in range(5000) if k % 3 == kind)[:40]
        want += [(kind, k) for _, k in own]
    assert take(rows, 40) == sorted(want) == take(rows.coalesce(1), 40)
    few = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "kind int, id int")
    assert len(modelling.least_hashes(few, "kind", 1, ["id"]).collect()) == 2
    assert modelling.least_hashes(few.limit(0), "kind", 1, ["id"]).count() == 0


def test_mosaic(spark):
    """Each pixel's value is that of the model fitted on the other folds' sample."""
    px = spark.range(900).select((F.col("id") / 30).cast("int").alias("row"), (F.col("id") % 30).cast("int").alias("col"))
    px = px.withColumns({"fold": F.pmod(F.xxhash64(F.floor(F.col("row") / 5), F.floor(F.col("col") / 5)), F.lit(3)).cast("int"), "red": F.col("row") / 30.0, "nir": F.col("col") / 30.0})
    px = px.withColumns({"h": F.col("red") * 4 - 0.5, "class": (F.col("col") < 10).cast("int")}).cache()
    drawn = modelling.least_hashes(px, "class", 100, ["row", "col"])
    got = {(r.row, r.col): r for r in modelling.mosaic_out_of_fold(px, drawn, ["red", "nir"], "h", 3, rounds=3).collect()}
    assert len(got) == 900 and all(r.pred >= 0 for r in got.values())
    for k in range(3):
        model = modelling.fitted(drawn.where(F.col("fold") != k), ["red", "nir"], "h", 3)
        for r in model.transform(px.where(F.col("fold") == k)).collect():
            assert got[r.row, r.col].pred == pytest.approx(max(r.pred, 0.0))


def test_quality_bits(spark):
    rows = [("d", "2025-05-01 12:00:00", 0, k, 300.15, k, 0) for k in range(8)] + [("n", "2025-05-01 23:10:00", 0, 0, 290.15, 1, 0), ("c", "2025-05-01 22:10:00", 0, 0, 290.15, 1, 1)]
    rows += [("e", "2025-05-01 18:10:00", 0, 0, 290.15, 0, 0), ("x", "2025-05-01 01:00:00", 0, 0, None, 0, 0), ("y", "2025-05-01 02:00:00", 0, 0, 280.15, None, 0)]
    px = spark.createDataFrame(rows, "scene_id string, ts string, row int, col int, kelvin double, qc int, cloud int").withColumn("ts", F.to_timestamp("ts"))
    got = sorted((r.scene_id, r.col, round(r.lst, 6), r.night, r.clear) for r in catalog.station_passes(px).collect())
    assert got == [("d", 0, 27.0, False, 0.5), ("d", 1, 27.0, False, 0.5), ("d", 4, 27.0, False, 0.5), ("d", 5, 27.0, False, 0.5), ("n", 0, 17.0, True, 1.0)]
    assert catalog.station_passes(px, 1).count() == 0
