"""The port study with two chains: area by footprint, or height, whichever passes the erase test with the least error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import modelling, validation
from ..sources.tables import new_path, numbered, written
from . import port

CHAINS = ("footprint", "height")
#: A chain passes if the erased pile's volume falls by so much.
LEAST_RESPONSE = 0.2


def _footprint(train: DataFrame, rounds: int) -> Callable[[DataFrame], DataFrame]:
    """Rows -> zone, pred: the area that the pile covers."""
    score = modelling.footprint_probability(train.withColumn("y", (F.col("occupied") > 0.5).cast("double")), port.FEATURES, "y", rounds)
    return lambda rows: score(rows).groupBy("zone").agg(F.sum("p").alias("pred"))


def _height(train: DataFrame, rounds: int) -> Callable[[DataFrame], DataFrame]:
    """Rows -> zone, pred: the sum of predicted heights."""
    model = modelling.fitted(train.where("h is not null"), port.FEATURES, "h", rounds)
    return lambda rows: model.transform(rows).groupBy("zone").agg(F.sum(F.greatest("pred", F.lit(0.0))).alias("pred"))


_FIT = {"footprint": _footprint, "height": _height}


def out_of_pile(train: DataFrame, piles: DataFrame, rounds: int, groups: int | None = None) -> DataFrame:
    """train(zone, occupied, h, features), piles(label, volume) -> label, chain, actual, pred: by fits that saw none of the pile.

    Every pile is left out by itself unless a caller deals them to groups. Each fit's rows are
    appended to one table; the plan doesn't grow with the fits.
    """
    n = F.col("n") - 1
    seen = piles.where("volume is not null").join(train.select(F.col("zone").alias("label")).distinct(), "label", "left_semi")
    dealt = written(numbered(seen, "label", "n").select(F.col("label").alias("zone"), (n if groups is None else F.pmod(n, F.lit(groups))).alias("held")))
    parts = written(train.join(dealt, "zone", "left"))
    path, fits = new_path(train.sparkSession), dealt.agg(F.max("held")).first()[0]
    schema = "zone int, pred double, chain string"
    for k in range(0 if fits is None else fits + 1):
        for chain in CHAINS:
            predicted = _FIT[chain](parts.where(F.coalesce(F.col("held") != k, F.lit(True))), rounds)
            predicted(parts.where(F.col("held") == k)).withColumn("chain", F.lit(chain)).write.mode("append").parquet(path)
    held = train.sparkSession.read.schema(schema).parquet(path) if fits is not None else train.sparkSession.createDataFrame([], schema)
    return seen.join(held, seen.label == held.zone).select("label", "chain", F.col("volume").alias("actual"), "pred")


def calibrated(out: DataFrame) -> DataFrame:
    """label, chain, actual, pred -> label, chain, method, actual, predicted: the power law of the other piles, and for heights the sum itself.

    Each pile's law is fitted without it.
    """
    parts = []
    for chain in CHAINS:
        own = out.where(F.col("chain") == chain)
        parts.append(validation.leave_one_out(own, "label").select("label", "chain", F.lit("power").alias("method"), "actual", F.col("corrected").alias("predicted")))
    raw = out.where("chain = 'height'").select("label", "chain", F.lit("raw").alias("method"), "actual", F.col("pred").alias("predicted"))
    return parts[0].unionByName(parts[1]).unionByName(raw)


def volumes(train: DataFrame, scene: DataFrame, piles: DataFrame, rounds: int) -> DataFrame:
    """label, chain, pred_ref, pred: what the fits on all piles see in the reference and in another scene of the same rows' zones."""
    out = None
    for chain in CHAINS:
        predicted = _FIT[chain](train, rounds)
        both = predicted(train).withColumnRenamed("pred", "pred_ref").join(predicted(scene), "zone")
        both = both.join(piles.select(F.col("label").alias("zone")), "zone", "left_semi").select(F.col("zone").alias("label"), F.lit(chain).alias("chain"), "pred_ref", "pred")
        out = both if out is None else out.unionByName(both)
    return out


def chosen(predicted: DataFrame, responses: DataFrame, least: float = LEAST_RESPONSE) -> DataFrame:
    """calibrated() and responses(chain, response) -> chain, method, n, wape_pct, bias_pct, r2, response, passed, chosen.

    The chain with the least error of those that pass the erase test is chosen; ties go to the first
    name; none if none passes.
    """
    m = validation.metrics(predicted, "actual", "predicted", by=["chain", "method"]).join(F.broadcast(responses), "chain", "left")  # a row a chain
    m = m.withColumn("passed", F.coalesce(F.col("response") >= least, F.lit(False)))
    best = m.where("passed and wape_pct is not null").agg(F.min(F.struct("wape_pct", "chain", "method")).alias("b"))
    is_best = (F.col("b.chain") == F.col("chain")) & (F.col("b.method") == F.col("method"))
    return m.crossJoin(F.broadcast(best)).select("chain", "method", "n", "wape_pct", "bias_pct", "r2", "response", "passed", F.coalesce(is_best, F.lit(False)).alias("chosen"))  # one row


def erase_responses(train: DataFrame, px: DataFrame, labels: DataFrame, piles: DataFrame, rounds: int) -> DataFrame:
    """chain, response: how far the largest pile's prediction falls when its pixels look like the ground around it."""
    (label,) = piles.agg(F.max_by("label", "volume")).first()
    gone = port.features(port.erased(px, labels, label)).join(train.select("row", "col", "zone"), ["row", "col"])
    both = volumes(train, gone, piles.where(F.col("label") == label), rounds)
    return both.select("chain", F.when(F.col("pred_ref") > 0, 1 - F.col("pred") / F.col("pred_ref")).otherwise(0.0).alias("response"))


def training(px: DataFrame, labels: DataFrame, radius: int) -> DataFrame:
    """px(row, col, bands, occupied, h) with features and the nearest pile within radius as zone."""
    return written(port.features(px).join(port.zones(px, labels, radius), ["row", "col"]))


def transferred(train: DataFrame, other: DataFrame, piles: DataFrame, rounds: int, least: float = 0.8) -> DataFrame:
    """Another sensor's scene on the fits of this one: label, chain, actual, coverage, change, predicted.

    other(row, col, bands) may lack pixels and bands' levels: its bands are matched line by line to the reference's over
    pixels of no pile, and only then scored. A pile's volume is the surveyed one by the model's
    change between the two scenes, in which the fit's bias cancels; null where less than `least` of its zone was seen.
    """
    own = train.select("row", "col", "zone", "occupied", *port.BANDS)
    both = own.join(other.select("row", "col", *[F.col(b).alias(f"new_{b}") for b in port.BANDS]), ["row", "col"], "left")
    use = (F.col("occupied") <= 0.5) & F.col(f"new_{port.BANDS[0]}").isNotNull()
    fit = {r.band: r for r in modelling.normalised(both.withColumn("use", use), port.BANDS).collect()}  # a row a band
    line = lambda b: fit[b].gain * F.col(f"new_{b}") + fit[b].offset if b in fit else F.col(f"new_{b}")
    matched = both.select("row", "col", *[line(b).alias(b) for b in port.BANDS])
    scene = port.features(matched).join(train.select("row", "col", "zone"), ["row", "col"])
    seen = both.groupBy(F.col("zone").alias("label")).agg(F.avg(F.col(f"new_{port.BANDS[0]}").isNotNull().cast("double")).alias("coverage"))
    found = volumes(train, scene, piles, rounds)
    out = seen.join(piles.select("label", F.col("volume").alias("actual")), "label").crossJoin(F.broadcast(train.sparkSession.createDataFrame([(c,) for c in CHAINS], "chain string")))
    out = out.join(found, ["label", "chain"], "left")
    change = F.when((F.col("coverage") >= least) & (F.col("pred_ref") > 0), F.col("pred") / F.col("pred_ref"))
    return out.select("label", "chain", "actual", "coverage", change.alias("change"), (F.col("actual") * change).alias("predicted"))
