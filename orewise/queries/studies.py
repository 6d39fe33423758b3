"""The site's run and the port study on pixels of the tables."""

import uuid

from pyspark.sql import functions as F

from ..plans import chains, port
from ..plans.run import Run, site_stages
from ..sources.tables import shared_dir, written
from . import query
from .inputs import SIDE, r4


def site_inputs(i):
    """Pixels with labels, a later scene that lacks a strip, and temperatures of blocks of 8 x 8 pixels, an hour of events a scene."""
    px = i.lpx.select("row", "col", "label", "dsm", "dtm", *port.BANDS)
    scene = px.where("col < 88").select("row", "col", *[(F.col(b) * 1.1 + 0.01 * k).alias(b) for k, b in enumerate(port.BANDS)])
    e = i.table("events")
    hour, side = F.hour("ts"), SIDE // 8
    thermal = e.groupBy(F.to_date("ts").alias("date"), ((hour < 6) | (hour >= 20)).alias("night"), (F.col("user_id") % side).cast("int").alias("row"), (F.col("event_id") % side).cast("int").alias("col"))
    thermal = thermal.agg(F.avg("value").alias("lst")).select((F.datediff("date", F.lit("2000-01-01")) * 2 + F.col("night").cast("int")).alias("scene_id"), "date", "night", F.lit(8.0).alias("native_m"), "row", "col", "lst")
    return {"px": px, "scene": scene, "thermal": thermal}


@query("c08_site_run")
def site_run(i):
    """All stages of a site in one restartable run: the report of its objects."""
    run = Run(i.spark, f"{shared_dir(i.spark)}/orewise/runs/{uuid.uuid4().hex}")
    out = run(site_stages(SIDE, SIDE, rounds=3), {k: written(v) for k, v in site_inputs(i).items()})["report"]
    return out.select("label", "commodity", *[r4(c).alias(c) for c in ("volume_m3", "tonnage_t", "predicted", "change", "estimate")], "alert")


def port_inputs(i):
    """16 piles of the sheet: pixels, labels, surveyed volumes."""
    px = written(i.lpx.where("h is not null").select("row", "col", "h", *port.BANDS, (F.col("label") > 0).cast("double").alias("occupied")))
    pile = (F.floor(F.col("row") / 24) * 4 + F.floor(F.col("col") / 24) + 1).cast("int")
    labels = px.select("row", "col", F.when(F.col("occupied") > 0, pile).otherwise(0).alias("label"))
    piles = px.where("occupied > 0").groupBy(pile.alias("label")).agg(F.sum("h").alias("volume"))
    return px, labels, written(piles)


@query("m18_chains")
def two_chains(i):
    """Footprint and height chains by piles held out in three groups, erase test and choice."""
    px, labels, piles = port_inputs(i)
    train = chains.training(px, labels, 2)
    predicted = chains.calibrated(chains.out_of_pile(train, piles, 2, groups=3))
    m = chains.chosen(predicted, chains.erase_responses(train, px, labels, piles, 2))
    return m.select("chain", "method", "n", *[r4(c, 2).alias(c) for c in ("wape_pct", "bias_pct", "response")], "passed", "chosen")


@query("c14_transfer")
def transfer(i):
    """Another sensor's scene, its levels matched, on this one's fits."""
    px, labels, piles = port_inputs(i)
    other = px.where("col < 80").select("row", "col", *[(F.col(b) * 1.2 + 0.05).alias(b) for b in port.BANDS])
    out = chains.transferred(chains.training(px, labels, 2), other, piles, 2)
    return out.select("label", "chain", *[r4(c, 3).alias(c) for c in ("actual", "coverage", "change", "predicted")])
