"""Joins by place and time: nearest label, rings, neighbours, as-of, overlap, leave-one-out."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import numbered
from . import tiles
from .focal import offsets, spread


def _border(labels: DataFrame) -> DataFrame:
    """Labelled pixels with an unlabelled or other 4-neighbour: what lies nearest to any outside pixel."""
    own = labels.where("label > 0").select("row", "col", "label")
    near = spread(own, [(0, 1), (0, -1), (1, 0), (-1, 0)]).select("row", "col", "label")
    inner = near.groupBy("row", "col", "label").count().where("count = 4").select("row", "col", "label")
    return own.join(inner, ["row", "col", "label"], "left_anti")


def nearest_label(px: DataFrame, labels: DataFrame, radius: int) -> DataFrame:
    """px(row, col) -> label of the nearest labelled pixel within radius, and d2; ties go to the least label."""
    inside = labels.where("label > 0").select("row", "col", "label", F.lit(0).alias("d2"))
    reach = spread(_border(labels), offsets("disc", radius)).select("row", "col", "label", "d2").unionByName(inside)
    best = reach.groupBy("row", "col").agg(F.min(F.struct("d2", "label")).alias("b"))
    return px.select("row", "col").join(best, ["row", "col"]).select("row", "col", F.col("b.label").alias("label"), F.col("b.d2").alias("d2"))


def neighbours(labels: DataFrame, reach: int, n: int | None = None) -> DataFrame:
    """Pairs of labels whose pixels lie within reach steps of a cross: label, other.

    Pixels meet in tiles with a halo of that reach; only pairs leave a tile. A pixel may have several labels.
    n: the number of tiles, where it is known.
    """
    kind, tile = labels.schema["label"].dataType.simpleString(), tiles.TILE
    shape = [s for s in offsets("cross", reach) if s != (0, 0)]

    def run(table: pa.Table) -> pa.Table:
        r0, c0 = (table.column(k)[0].as_py() * tile - reach for k in ("tr", "tc"))
        side = tile + 2 * reach
        # Distinct pixels and labels; those of one pixel go to layers of their own.
        px = np.unique(np.stack(((table.column("row").to_numpy() - r0) * side + table.column("col").to_numpy() - c0, table.column("label").to_numpy())), axis=1)
        at, label = px
        first = np.flatnonzero(np.diff(at, prepend=-1))
        layer = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        a = np.zeros((layer.max() + 1, side + 2, side + 2), np.int64)
        r, c = at // side + 1, at % side + 1
        a[layer, r, c] = label
        # What lies nearest to others are the tile's own pixels with a neighbour of another label, or several labels of one pixel.
        near = [(a[:, r + y, c + x] == label).any(0) for y, x in ((0, 1), (0, -1), (1, 0), (-1, 0))]
        own = (r > reach) & (r <= reach + tile) & (c > reach) & (c <= reach + tile)
        border = own & ~np.logical_and.reduce(near)
        found = [np.zeros((0, 2), np.int64)]
        for k in range(len(a)):
            for here, steps in ((border, shape), (own, [(0, 0)] if len(a) > 1 else [])):
                rr, cc, mine = r[here], c[here], label[here]
                for y, x in steps:
                    other = a[k, rr + y, cc + x]
                    pair = np.flatnonzero((other > 0) & (other != mine))
                    if len(pair):
                        found.append(np.unique(np.stack((mine[pair], other[pair]), 1), axis=0))
        pairs = np.unique(np.concatenate(found), axis=0)
        return pa.table({"label": pa.array(pairs[:, 0]), "other": pa.array(pairs[:, 1])})

    dealt = tiles.dealt(labels.where("label > 0"), [F.col("label").cast("long").alias("label")], None, reach)
    dealt = dealt if n is None else tiles.apart(dealt, n)
    pairs = dealt.groupBy("tr", "tc").applyInArrow(run, "label long, other long").distinct()
    return pairs.select(F.col("label").cast(kind).alias("label"), F.col("other").cast(kind).alias("other"))


def ring(labels: DataFrame, px: DataFrame, inner: int, outer: int) -> DataFrame:
    """label and pixels of px whose distance to the label's nearest pixel is over inner, up to outer."""
    reach = spread(_border(labels), offsets("disc", outer))
    near = reach.groupBy("label", "row", "col").agg(F.min("d2").alias("d2")).where(F.col("d2") > inner * inner)
    inside = labels.where("label > 0").select("row", "col", "label")
    return near.join(inside, ["row", "col", "label"], "left_anti").join(px, ["row", "col"])


def majority_overlap(objects: DataFrame, covered: DataFrame, share: float = 0.5) -> DataFrame:
    """Objects (row, col, label) with at most that share of their pixels in covered(row, col)."""
    hit = objects.join(covered.select("row", "col", F.lit(1.0).alias("hit")), ["row", "col"], "left")
    most = hit.groupBy("label").agg(F.avg(F.coalesce("hit", F.lit(0.0))).alias("share")).where(F.col("share") > share)
    return objects.join(most, "label", "left_anti")


def as_of(left: DataFrame, right: DataFrame, on: str, at: str, right_at: str, days: int, rank: list[Column]) -> DataFrame:
    """For each distinct left row the right one within days that is least by |time difference|, then rank (columns of right).

    Right rows of one key and day are equally far from whatever asks, so only the first of them by rank is kept, and
    left rows of one key and day get one answer: what meets is keys and days, however many rows
    they have. They meet by whole windows of time: a right day goes to its window and the two beside
    it, so that is an equi-join of at most 3 * days right days for each left one.
    """
    day = lambda c: F.datediff(c, F.lit("1970-01-01"))
    span = lambda c: F.floor(c / days)
    l = left.distinct().withColumns({"_on": F.col(on), "_day": day(F.col(at))})  # noqa: E741
    names = {c: f"_{c}" for c in right.columns if c in left.columns}
    r = right.withColumns({"_ron": F.col(on)}).select(*[F.col(c).alias(names.get(c, c)) for c in right.columns], "_ron")
    r = r.withColumn("_rday", day(F.col(names.get(right_at, right_at)))).where("_ron is not null and _rday is not null")
    first = Window.partitionBy("_ron", "_rday").orderBy(*rank)
    r = r.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    r = r.withColumn("_w", F.explode(F.array(*[span(F.col("_rday")) + k for k in (-1, 0, 1)])))
    asked = l.select("_on", "_day").distinct().withColumn("_w", span(F.col("_day")))
    both = asked.join(r, (asked["_on"] == r["_ron"]) & (asked["_w"] == r["_w"])).drop("_w", "_ron").withColumn("apart", F.abs(F.col("_rday") - F.col("_day"))).where(F.col("apart") <= days)
    nearest = Window.partitionBy("_on", "_day").orderBy("apart", *rank)
    best = both.withColumn("_n", F.row_number().over(nearest)).where("_n = 1").drop("_n", "_rday")
    return l.join(best, ["_on", "_day"]).drop("_on", "_day")


def new_outlines(candidates: DataFrame, existing: DataFrame, most: float = 0.3) -> DataFrame:
    """Candidates (row, col, label) that existing(row, col) covers by at most that share, named N001.. by size."""
    hit = candidates.join(existing.select("row", "col", F.lit(1.0).alias("hit")), ["row", "col"], "left")
    sizes = hit.groupBy("label").agg(F.count("*").alias("n_px"), F.avg(F.coalesce("hit", F.lit(0.0))).alias("share")).where(F.col("share") <= most)
    order = numbered(sizes.select(F.struct((-F.col("n_px")).alias("n"), "label").alias("k")), "k", "place")
    return sizes.join(order.select("k.label", "place"), "label").withColumn("name", F.format_string("N%03d", "place")).drop("place")
