"""Between grids: block means, interpolation, decimation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tiles
from .grid import Lattice


def block_mean(px: DataFrame, values: list[str], k: int) -> DataFrame:
    """Means of the known pixels of k x k blocks."""
    cell = lambda c: F.floor(F.col(c) / k).cast("int").alias(c)
    return px.groupBy(cell("row"), cell("col")).agg(*[F.avg(v).alias(v) for v in values])


def interpolated(px: DataFrame, value: str, src: Lattice, dst: Lattice, order: int = 1) -> DataFrame:
    """src pixels at dst's centres: nearest (0), bilinear (1), edges held; missing pixels count as the mean.

    A target is null if less than half of its bilinear weight lies on known pixels. Targets
    look up their two or four sources by an equi-join; sources are not gathered.
    """
    mean = px.agg(F.avg(value).alias("mean"))
    target = px.sparkSession.range(dst.cols * dst.rows).select((F.col("id") / dst.cols).cast("int").alias("row"), (F.col("id") % dst.cols).cast("int").alias("col"))
    x, y = dst.centre(F.col("row"), F.col("col"))
    target = target.withColumns({"y": (src.extent.north - y) / src.step - 0.5, "x": (x - src.extent.west) / src.step - 0.5})
    hold = lambda c, n: F.least(F.greatest(c, F.lit(0)), F.lit(n - 1)).cast("int")
    corners = target.withColumn("c", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])))
    r, c = F.floor("y") + F.col("c.i"), F.floor("x") + F.col("c.j")
    w = (1 - F.abs(r - F.col("y"))) * (1 - F.abs(c - F.col("x")))
    near = F.struct(F.abs(r - F.col("y")) + F.abs(c - F.col("x")), r, c)
    corners = corners.select("row", "col", hold(r, src.rows).alias("sr"), hold(c, src.cols).alias("sc"), w.alias("w"), near.alias("near"))
    source = px.where(F.col(value).isNotNull()).select(F.col("row").alias("sr"), F.col("col").alias("sc"), F.col(value).alias("v"))
    joined = corners.join(source, ["sr", "sc"], "left").crossJoin(F.broadcast(mean))
    v = F.coalesce("v", "mean")
    found = F.sum(v * F.col("w")) if order else F.min_by(v, "near")
    seen = F.sum(F.when(F.col("v").isNotNull(), F.col("w")).otherwise(0.0))
    return joined.groupBy("row", "col").agg(F.when(seen >= 0.5, found).alias(value))


def cubic(px: DataFrame, value: str, factor: int, grid: tuple[int, int], tile: int = tiles.TILE) -> DataFrame:
    """Cubic spline samples, factor a pixel and axis; the spline's memory fades within the halo."""
    halo = 16

    import numpy as np
    import pyarrow as pa

    def kernel(a):
        return tiles.cubic(tiles.filled(a), factor)

    low, high = (lambda x: F.floor((x - halo) / tile)), (lambda x: F.floor((x + halo) / tile))
    height, width = grid
    dealt = (
        px.select("row", "col", F.col(value).cast("double").alias("v"), F.explode(F.sequence(low(F.col("row")), high(F.col("row")))).alias("tr"))
        .select("*", F.explode(F.sequence(low(F.col("col")), high(F.col("col")))).alias("tc"))
        .where((F.col("tr") >= 0) & (F.col("tc") >= 0) & (F.col("tr") * tile < height) & (F.col("tc") * tile < width))
    )

    def run(table: pa.Table) -> pa.Table:
        tr, tc = table.column("tr")[0].as_py(), table.column("tc")[0].as_py()
        r0, c0 = max(tr * tile - halo, 0), max(tc * tile - halo, 0)
        r1, c1 = min((tr + 1) * tile + halo, height), min((tc + 1) * tile + halo, width)
        a = np.full((r1 - r0, c1 - c0), np.nan)
        a[table.column("row").to_numpy() - r0, table.column("col").to_numpy() - c0] = table.column("v").to_numpy(zero_copy_only=False)
        fine = kernel(a)
        a0, b0 = (tr * tile - r0) * factor, (tc * tile - c0) * factor
        h, w = min(tile, height - tr * tile) * factor, min(tile, width - tc * tile) * factor
        rr, cc = np.mgrid[0:h, 0:w]
        return pa.table({
            "row": pa.array((rr + tr * tile * factor).ravel(), pa.int32()), "col": pa.array((cc + tc * tile * factor).ravel(), pa.int32()),
            value: pa.array(fine[a0 : a0 + h, b0 : b0 + w].ravel(), pa.float64()),
        })

    return dealt.groupBy("tr", "tc").applyInArrow(run, f"row int, col int, {value} double")


def to_grid(px: DataFrame, value: str, src: Lattice, dst: Lattice, order: int = 1) -> DataFrame:
    """Coarser: block mean (whole ratios) or bilinear; finer: interpolation; the same: as it is."""
    if src == dst:
        return px.select("row", "col", value)
    k = dst.step / src.step
    if k > 1 and abs(k - round(k)) < 1e-6:
        return block_mean(px, [value], round(k))
    return interpolated(px, value, src, dst, order)


def decimated(px: DataFrame, k: int) -> DataFrame:
    return px.where((F.col("row") % k == 0) & (F.col("col") % k == 0))
