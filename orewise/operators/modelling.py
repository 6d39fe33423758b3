"""Fits: folds, samples, robust lines, radiometric matches, trees from MLlib."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import DEFAULT, Settings
from ..sources.tables import written
from .grid import Lattice


def spatial_folds(px: DataFrame, grid: Lattice, s: Settings = DEFAULT) -> DataFrame:
    """Adds fold: blocks of ground, permuted by seed, dealt round the folds. The table of blocks follows the grid's extent alone."""
    across = -int(-(grid.cols * grid.step) // s.fold_block_m)
    down = -int(-(grid.rows * grid.step) // s.fold_block_m)
    order = np.random.default_rng(s.seed).permutation(across * down)
    table = px.sparkSession.createDataFrame([(k, int(order[k]) % s.folds) for k in range(across * down)], "block int, fold int")
    x, y = (F.col("col") + 0.5) * grid.step, (F.col("row") + 0.5) * grid.step
    block = (F.floor(y / s.fold_block_m) * across + F.floor(x / s.fold_block_m)).cast("int")
    return px.withColumn("block", block).join(F.broadcast(table), "block").drop("block")


def hashed_fold(x: Column, y: Column, block_m: float = 150.0, folds: int = 5) -> Column:
    """Fold of a block by arithmetic."""
    return F.abs((F.floor(x / block_m) * 7 + F.floor(y / block_m) * 13) % folds).cast("int")


def balanced(df: DataFrame, stratum: Column, each: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Up to each rows of every stratum, drawn without replacement by hash.

    Parts of a stratum are ranked first and what they keep then, so no task ranks a whole one.
    """
    h = F.xxhash64(F.lit(seed), *keys)
    df = df.withColumn("_s", stratum)
    for group in (["_s", F.pmod(h, F.lit(_PARTS))], ["_s"]):
        df = df.withColumn("_n", F.row_number().over(Window.partitionBy(*group).orderBy(h, *keys))).where(F.col("_n") <= each).drop("_n")
    return df.drop("_s")


def stratified(rows: DataFrame, by: str, most: int, keys: list[str]) -> DataFrame:
    """At most so many rows of each class, those of least hash of their keys.

    A class's rows are first thinned by hash to about 4 * most + 200, so no task ranks a whole
    class; that this leaves fewer than most of them has odds of under 1e-40.
    """
    h = F.xxhash64(*keys)
    counts = rows.groupBy(by).agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), (4.0 * most + 200) / F.col("_n"))
    near = rows.join(F.broadcast(counts), by).withColumn("_h", h).where(F.pmod("_h", F.lit(1 << 20)) < F.ceil(share * (1 << 20)))  # a row a class
    order = Window.partitionBy(by).orderBy(F.pmod("_h", F.lit(1 << 20)), "_h", *keys)
    return near.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most).drop("_k", "_h", "_n")


#: Parts in which a class's least hashes are first ranked.
_PARTS = 64


def least_hashes(rows: DataFrame, by: str, most: int, keys: list[str], seed: int = 42) -> DataFrame:
    """The `most` rows of each class of least md5 of their keys: a sample that any two tasks' samples merge into.

    Each task keeps the least of what it reads, parts of them are ranked apart, then the rest: no task
    ranks a whole class. Keys are unique within a class (equal rows may otherwise stand for each
    other); ties of hashes are in the order of the keys. A null class is a class, fewer rows are all kept.
    """
    import pyarrow as pa
    import pyarrow.compute  # noqa: F401

    name = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))
    hashed = rows.withColumn("_h", name)

    def run(batches):
        held: dict = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for kind in table.column(by).unique():
                own = table.filter(pa.compute.equal(table.column(by), kind) if kind.is_valid else pa.compute.is_null(table.column(by)))
                both = pa.concat_tables([held[kind], own]) if kind in held else own
                held[kind] = both.sort_by([("_h", "ascending"), *[(k, "ascending") for k in keys]]).slice(0, most)
        for table in held.values():
            yield from table.to_batches()

    near = hashed.mapInArrow(run, hashed.schema)
    order = ["_h", *keys]
    ranked = lambda df, *part: df.withColumn("_n", F.row_number().over(Window.partitionBy(by, *part).orderBy(*order))).where(F.col("_n") <= most).drop("_n")
    part = F.pmod(F.xxhash64("_h"), F.lit(_PARTS))
    return ranked(ranked(near.withColumn("_p", part), "_p").drop("_p")).drop("_h")


def mosaic_out_of_fold(px: DataFrame, sample: DataFrame, features: list[str], label: str, folds: int, rounds: int = 20, seed: int = 42) -> DataFrame:
    """px(row, col, fold, features), sample of such rows with label -> row, col, fold, pred: every pixel by a model that saw none of its fold.

    A model a fold is fitted on the sample without that fold. Each pixel is read once for its own
    fold's model, predictions below 0 count as 0, and the folds' parts lie side by side. Pixels with a
    missing feature have no prediction.
    """
    out = None
    held = written(sample)
    for k in range(folds):
        model = fitted(held.where(F.col("fold") != k), features, label, rounds, seed)
        part = model.transform(px.where(F.col("fold") == k)).select("row", "col", "fold", F.greatest("pred", F.lit(0.0)).alias("pred"))
        out = part if out is None else out.unionByName(part)
    return out


def line(df: DataFrame, x: str, y: str, by: list[str] | None = None, sigmas: float = 2.5, least: int = 10) -> DataFrame:
    """Robust y = a x + b: fitted again without residuals beyond so many sigmas; below least rows a = 0 and b is the mean."""
    by = by or []
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    fit = lambda d: d.groupBy(by).agg(F.regr_slope(y, x).alias("a"), F.regr_intercept(y, x).alias("b"), F.count("*").alias("n"), F.avg(y).alias("mean"))
    first = fit(known)
    joined = known.join(F.broadcast(first), by) if by else known.crossJoin(F.broadcast(first))
    r = joined.withColumn("_r", F.col(y) - F.col("a") * F.col(x) - F.col("b"))
    spread = r.groupBy(by).agg(F.stddev_pop("_r").alias("_s"))
    r = r.join(F.broadcast(spread), by) if by else r.crossJoin(F.broadcast(spread))
    again = fit(r.where(F.abs("_r") < sigmas * F.greatest("_s", F.lit(1e-6))).select(*by, x, y))
    again = again.select(*by, F.col("a").alias("a2"), F.col("b").alias("b2"), F.col("n").alias("n2"))
    both = first.join(again, by, "left") if by else first.crossJoin(again)
    few, better = F.col("n") < least, F.col("n2") > least
    return both.select(
        *by, F.when(few, 0.0).when(better, F.col("a2")).otherwise(F.col("a")).alias("a"),
        F.when(few, F.coalesce("mean", F.lit(0.0))).when(better, F.col("b2")).otherwise(F.col("b")).alias("b"), F.when(better & ~few, F.col("n2")).otherwise(F.col("n")).alias("n"),
    )


def matched(df: DataFrame, new: str, ref: str, least: int = 20) -> DataFrame:
    """Gain and offset from a new scene to the reference's radiometry; 1 and 0 below least rows."""
    fit = df.agg(F.regr_slope(ref, new).alias("a"), F.regr_intercept(ref, new).alias("b"), F.regr_count(ref, new).alias("n"))
    enough = F.col("n") >= least
    return fit.select(F.when(enough, F.col("a")).otherwise(1.0).alias("gain"), F.when(enough, F.col("b")).otherwise(0.0).alias("offset"), "n")


def invariant(ndvi_new: Column, ndvi_ref: Column, excluded: Column) -> Column:
    """Pixels that a scene's radiometry may be fitted on: no plants, no water, unchanged."""
    same = (F.abs(ndvi_new - ndvi_ref) < 0.05) & (ndvi_ref > 0) & (ndvi_ref < 0.3) & ~excluded
    return F.coalesce(same, F.lit(False))


def normalised(px: DataFrame, bands: list[str]) -> DataFrame:
    """px(band, new_band of bands, use) -> band, gain, offset, n, r2: a line per band, trimmed at two sigmas."""
    long = px.where("use").select(F.explode(F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"new_{b}").alias("x"), F.col(b).alias("y")) for b in bands])).alias("e")).select("e.*")
    first = long.groupBy("band").agg(F.regr_slope("y", "x").alias("a"), F.regr_intercept("y", "x").alias("b"))
    r = long.join(F.broadcast(first), "band").withColumn("r", F.col("y") - F.col("a") * F.col("x") - F.col("b"))
    spread = r.groupBy("band").agg(F.stddev_pop("r").alias("s"))
    kept = r.join(F.broadcast(spread), "band").where(F.abs("r") < 2 * F.col("s") + 1e-12)
    return kept.groupBy("band").agg(F.regr_slope("y", "x").alias("gain"), F.regr_intercept("y", "x").alias("offset"), F.count("*").alias("n"), F.regr_r2("y", "x").alias("r2"))


def nearest_centroid(rows: DataFrame, examples: DataFrame, bands: list[str]) -> DataFrame:
    """Adds commodity: that of the nearest mean of examples(commodity, bands); null where a band is missing."""
    centres = examples.groupBy("commodity").agg(*[F.avg(b).alias(f"c_{b}") for b in bands])
    kinds = centres.select(F.struct("commodity", *[f"c_{b}" for b in bands]).alias("c")).agg(F.array_sort(F.collect_list("c")).alias("cs"))  # a few materials
    apart = lambda c: sum((F.pow(F.col(b) - c[f"c_{b}"], 2) for b in bands), F.lit(0.0))
    ranked = F.array_min(F.transform("cs", lambda c: F.struct(apart(c).alias("d"), c["commodity"].alias("commodity"))))
    whole = F.lit(True)
    for b in bands:
        whole = whole & F.col(b).isNotNull()
    return rows.crossJoin(F.broadcast(kinds)).withColumn("commodity", F.when(whole, ranked["commodity"])).drop("cs")


def out_of_fold(df: DataFrame, features: list[str], label: str, folds: int, kind: str = "gbt", rounds: int = 20, seed: int = 42) -> DataFrame:
    """Adds pred: each fold's rows by trees fitted on the others; rows with a missing feature drop out."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    data = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="skip").transform(df)
    make = {"gbt": lambda: GBTRegressor(featuresCol="_v", labelCol=label, maxIter=rounds, seed=seed, predictionCol="pred"), "rf": lambda: RandomForestRegressor(featuresCol="_v", labelCol=label, numTrees=rounds, seed=seed, predictionCol="pred")}[kind]
    out = None
    for k in range(folds):
        part = make().fit(data.where((F.col("fold") != k) & F.col(label).isNotNull())).transform(data.where(F.col("fold") == k)).drop("_v")
        out = part if out is None else out.unionByName(part)
    return out


def fitted(df: DataFrame, features: list[str], label: str, rounds: int = 20, seed: int = 42, kind: str = "gbt"):
    """The production model: assembler and boosted trees ("gbt") or a forest ("rf") as one pipeline model, which can be saved."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    own = {"featuresCol": "_v", "labelCol": label, "seed": seed, "predictionCol": "pred"}
    trees = RandomForestRegressor(numTrees=rounds, **own) if kind == "rf" else GBTRegressor(maxIter=rounds, **own)
    steps = [VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="skip"), trees]
    return Pipeline(stages=steps).fit(df.where(F.col(label).isNotNull()))


def downscaled(coarse: DataFrame, fine: DataFrame, features: list[str], k: int, least: int = 50, low: float = -40.0, high: float = 80.0, kind: str = "gbt", rounds: int = 20) -> DataFrame:
    """coarse(row, col, lst) and fine(row, col, features), k fine pixels a coarse one -> fine row, col, lst.

    Trees learn lst from the features' block means; each coarse pixel's mean is kept by adding
    its residual back. With too few coarse pixels each fine pixel takes its coarse one's value.
    """
    from .resample import block_mean

    means = block_mean(fine, features, k).join(coarse, ["row", "col"]).where("lst is not null")
    cell = [F.floor(F.col(c) / k).cast("int").alias(f"_{c}") for c in ("row", "col")]
    if means.count() < least:
        c = coarse.select(F.col("row").alias("_row"), F.col("col").alias("_col"), "lst")
        return fine.select("row", "col", *cell).join(c, ["_row", "_col"]).select("row", "col", "lst")
    model = fitted(means, features, "lst", rounds, kind=kind)
    pred = written(model.transform(fine).select("row", "col", *cell, "pred"))
    residual = pred.groupBy("_row", "_col").agg(F.avg("pred").alias("mean")).join(coarse.select(F.col("row").alias("_row"), F.col("col").alias("_col"), "lst"), ["_row", "_col"])
    residual = residual.select("_row", "_col", F.coalesce(F.col("lst") - F.col("mean"), F.lit(0.0)).alias("r"))
    return pred.join(residual, ["_row", "_col"]).select("row", "col", F.least(F.greatest(F.col("pred") + F.col("r"), F.lit(low)), F.lit(high)).alias("lst"))


def parabola(df: DataFrame, x: str, y: str, sigmas: float = 2.5, least: int = 10) -> DataFrame:
    """Robust y = c0 + c1 x + c2 x2, not below zero, with k that matches the means: one row c0, c1, c2, k.

    Few rows give the mean of y. The fit is repeated without residuals beyond so many sigmas.
    """
    from .zonal import solve3

    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))

    def fit(d: DataFrame) -> DataFrame:
        p = [F.sum(F.pow("x", F.lit(k))).alias(f"p{k}") for k in range(5)]
        q = [F.sum(F.pow("x", F.lit(k)) * F.col("y")).alias(f"q{k}") for k in range(3)]
        m = d.agg(*p, *q, F.avg("y").alias("mean"), F.count("*").alias("n"))
        c = solve3([[F.col(f"p{i + j}") for j in range(3)] for i in range(3)], [F.col(f"q{i}") for i in range(3)])
        return m.select(*[v.alias(f"c{k}") for k, v in enumerate(c)], "mean", "n")

    value = F.col("c0") + F.col("c1") * F.col("x") + F.col("c2") * F.col("x") ** 2
    first = fit(known)
    r = known.crossJoin(F.broadcast(first)).withColumn("r", F.col("y") - value)  # one row of coefficients
    r = r.crossJoin(F.broadcast(r.agg(F.stddev_pop("r").alias("s"))))
    again = fit(r.where(F.abs("r") < sigmas * F.greatest("s", F.lit(1e-6))).select("x", "y"))
    second = again.select(*[F.col(k).alias(f"{k}_") for k in ("c0", "c1", "c2", "n")])
    use = F.coalesce(F.col("n_") > least, F.lit(False))
    few = F.col("n") < least
    best = first.crossJoin(second).select(
        *[F.when(few, F.coalesce("mean", F.lit(0.0)) if k == 0 else F.lit(0.0)).when(use, F.col(f"c{k}_")).otherwise(F.col(f"c{k}")).alias(f"c{k}") for k in range(3)]
    )
    mean = known.crossJoin(F.broadcast(best)).agg(F.avg("y").alias("a"), F.avg(F.greatest(value, F.lit(0.0))).alias("b"))
    return best.crossJoin(mean).select("c0", "c1", "c2", F.when(F.col("b") > 0, F.col("a") / F.col("b")).otherwise(1.0).alias("k"))


def calibrated(df: DataFrame, coefficients: DataFrame, x: str) -> DataFrame:
    """Adds height from parabola()'s row."""
    value = F.col("c0") + F.col("c1") * F.col(x) + F.col("c2") * F.col(x) ** 2
    out = df.crossJoin(F.broadcast(coefficients)).withColumn("height", F.col("k") * F.greatest(value, F.lit(0.0)))  # one row
    return out.drop("c0", "c1", "c2", "k")


def pixel_metrics(df: DataFrame, pred: str, true: str) -> DataFrame:
    """n, rmse, mae, bias and R2 over pixels that both know; no row below two."""
    from .validation import metrics

    return metrics(df, true, pred).where("n >= 2").select("n", "rmse", "mae", "bias", "r2")


def footprint_probability(px: DataFrame, features: list[str], label: str, rounds: int = 20, seed: int = 42):
    """A classifier of occupied pixels: a function from rows to rows with p."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    assemble = VectorAssembler(inputCols=features, outputCol="_v", handleInvalid="skip")
    model = GBTClassifier(featuresCol="_v", labelCol=label, maxIter=rounds, seed=seed).fit(assemble.transform(px.where(F.col(label).isNotNull())))

    def score(rows: DataFrame) -> DataFrame:
        out = model.transform(assemble.transform(rows)).withColumn("p", vector_to_array("probability")[1])
        return out.drop("_v", "probability", "rawPrediction", "prediction")

    return score
