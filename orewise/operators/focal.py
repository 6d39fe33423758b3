"""Focal operators: small stencils as windows and offset joins, wide ones on tiles."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.tables import written
from . import tiles


def _difference(value: Column, across: str, at: str, res: float) -> Column:
    """Central difference between neighbours, one-sided where only one is there."""
    axis = Window.partitionBy(across).orderBy(at)
    near = lambda k: F.when(F.lag(at, k).over(axis) == F.col(at) - k, F.lag(value, k).over(axis))
    before, after = near(1), near(-1)
    return (
        F.when(before.isNotNull() & after.isNotNull(), (after - before) / (2 * res))
        .when(after.isNotNull(), (after - value) / res)
        .when(before.isNotNull(), (value - before) / res)
    )


def gradients(px: DataFrame, value: str, res: float) -> DataFrame:
    """Adds gx and gy; null for a pixel without a neighbour on the axis."""
    return px.withColumn("gx", _difference(F.col(value), "row", "col", res)).withColumn("gy", _difference(F.col(value), "col", "row", res))


def slope_degrees(px: DataFrame, value: str, res: float) -> DataFrame:
    """Adds slope; an axis without a neighbour counts as level."""
    g = gradients(px, value, res)
    flat = lambda c: F.coalesce(c, F.lit(0.0))
    return g.withColumn("slope", F.when(F.col(value).isNotNull(), F.degrees(F.atan(F.hypot(flat(F.col("gx")), flat(F.col("gy")))))))


def offsets(kind: str, n: int) -> list[tuple[int, int]]:
    """Offsets of a 'square', a 'cross' dilated n times (diamond), a 'disc' or a 'circle' of radius n."""
    inside = {"square": lambda r, c: True, "cross": lambda r, c: abs(r) + abs(c) <= n, "disc": lambda r, c: r * r + c * c <= n * n}[kind]
    return [(r, c) for r in range(-n, n + 1) for c in range(-n, n + 1) if inside(r, c)]


def spread(px: DataFrame, shape: list[tuple[int, int]]) -> DataFrame:
    """Every row at each of the shape's offsets from its pixel, with d2, the squared distance."""
    steps = F.array(*[F.struct(F.lit(r).alias("dr"), F.lit(c).alias("dc")) for r, c in shape])
    moved = px.withColumn("step", F.explode(steps))
    return moved.select(
        (F.col("row") + F.col("step.dr")).alias("row"), (F.col("col") + F.col("step.dc")).alias("col"),
        (F.col("step.dr") ** 2 + F.col("step.dc") ** 2).cast("int").alias("d2"), *[c for c in px.columns if c not in ("row", "col")],
    )


def _moved(a: np.ndarray, shape: list[tuple[int, int]], pick: Callable) -> np.ndarray:
    """pick over the array moved by each offset; unset outside it."""
    n = max(max(abs(r), abs(c)) for r, c in shape)
    b = np.pad(a, n)
    out = None
    for r, c in shape:
        part = b[n - r : n - r + a.shape[0], n - c : n - c + a.shape[1]]
        out = part.copy() if out is None else pick(out, part, out=out)
    return out


def _steps(shape: list[tuple[int, int]], steps: list[Callable]) -> tuple[Callable, int]:
    """The steps (np.logical_and erodes, np.logical_or dilates) one after another, and the halo that they don't reach across."""

    def kernel(a):
        for pick in steps:
            a = _moved(a, shape, pick)
        return a

    return kernel, len(steps) * max(max(abs(r), abs(c)) for r, c in shape)


def _morphed(mask: DataFrame, shape: list[tuple[int, int]], steps: list[Callable]) -> DataFrame:
    return tiles.mask_by_tile(mask, *_steps(shape, steps))


def dilated(mask: DataFrame, shape: list[tuple[int, int]]) -> DataFrame:
    """mask(row, col) of set pixels -> set pixels after dilation."""
    return _morphed(mask, shape, [np.logical_or])


def eroded(mask: DataFrame, shape: list[tuple[int, int]]) -> DataFrame:
    """Pixels whose whole neighbourhood is set; outside counts as unset."""
    return _morphed(mask, shape, [np.logical_and])


def opened(mask: DataFrame, shape: list[tuple[int, int]], times: int = 1) -> DataFrame:
    """Erosions, then as many dilations."""
    return _morphed(mask, shape, [np.logical_and] * times + [np.logical_or] * times)


def opened_boxes(boxes: DataFrame, grid: tuple[int, int], shape: list[tuple[int, int]], times: int = 1) -> DataFrame:
    """opened() of the grid's pixels that boxes(row, col, high, wide) cover, painted and opened in the same tile."""
    kernel, halo = _steps(shape, [np.logical_and] * times + [np.logical_or] * times)
    return tiles.painted(boxes, grid, kernel=kernel, halo=halo)


def closed(mask: DataFrame, shape: list[tuple[int, int]]) -> DataFrame:
    return _morphed(mask, shape, [np.logical_or, np.logical_and])


def focal(px: DataFrame, shape: list[tuple[int, int]], value: str, **aggs) -> DataFrame:
    """Aggregates of the present neighbours at each pixel of px: aggs are name=function of a Column."""
    near = spread(px.select("row", "col", value), shape).groupBy("row", "col").agg(*[f(F.col(value)).alias(k) for k, f in aggs.items()])
    return px.select("row", "col").join(near, ["row", "col"])


def stencil(px: DataFrame, value: str, weights: dict[tuple[int, int], float], out: str) -> DataFrame:
    """Weighted sums of neighbours; null unless all are there."""
    cells = F.array(*[F.struct(F.lit(-r).alias("dr"), F.lit(-c).alias("dc"), F.lit(float(w)).alias("w")) for (r, c), w in weights.items()])
    moved = px.select("row", "col", value, F.explode(cells).alias("x")).select(
        (F.col("row") + F.col("x.dr")).alias("row"), (F.col("col") + F.col("x.dc")).alias("col"), (F.col(value) * F.col("x.w")).alias("part")
    )
    sums = moved.groupBy("row", "col").agg(F.when(F.count("part") == len(weights), F.sum("part")).alias(out))
    return px.join(sums, ["row", "col"], "left")


LAPLACIAN = {(0, 0): -4, (0, 1): 1, (0, -1): 1, (1, 0): 1, (-1, 0): 1}


def gaussian(px: DataFrame, value: str, sigma: float, grid: tuple[int, int], out: str = "smooth", by: tuple[str, ...] = (), absent: float | None = None, repeated: bool = False) -> DataFrame:
    """Gaussian blur, of each layer (by) apart; missing pixels count as zero. absent and repeated as in tiles.by_tile, here and below."""
    return tiles.by_tile(px, lambda a: tiles.gauss(tiles.filled(a), sigma), [value], {out: "double"}, grid, tiles.gauss_radius(sigma), by=by, absent=absent, repeated=repeated)


def box(px: DataFrame, value: str, size: int, grid: tuple[int, int], absent: float | None = None, repeated: bool = False, std: bool = True) -> DataFrame:
    """Box mean and, unless a caller has no use for it, local standard deviation."""

    def kernel(a):
        a = tiles.filled(a)
        return (tiles.box_mean(a, size), tiles.local_std(a, size)) if std else tiles.box_mean(a, size)

    return tiles.by_tile(px, kernel, [value], {"mean": "double"} | ({"std": "double"} if std else {}), grid, size, absent=absent, repeated=repeated)


def relief(px: DataFrame, value: str, window_m: float, res: float, grid: tuple[int, int]) -> DataFrame:
    """Value less its blur over the window: what stands out."""
    sigma = max(window_m / res / 2, 1.0)
    return tiles.by_tile(px, lambda a: a - tiles.gauss(tiles.filled(a), sigma), [value], {"relief": "double"}, grid, tiles.gauss_radius(sigma))


def without_thin(px: DataFrame, value: str, radius_m: float, res: float, grid: tuple[int, int], absent: float | None = None, repeated: bool = False) -> DataFrame:
    """Heights without what is narrower than a disc: booms, posts."""
    r = max(round(radius_m / res), 1)

    def kernel(a):
        return np.where(np.isnan(a), np.nan, np.minimum(a, tiles.grey_opening(tiles.filled(a), tiles.disc(r))))

    return tiles.by_tile(px, kernel, [value], {"height": "double"}, grid, 2 * r, absent=absent, repeated=repeated)


def median5(px: DataFrame, value: str, grid: tuple[int, int], absent: float | None = None, repeated: bool = False) -> DataFrame:
    return tiles.by_tile(px, lambda a: tiles.median_filter(tiles.filled(a), 5), [value], {"median": "double"}, grid, 3, absent=absent, repeated=repeated)


def coverage(mask: DataFrame, native_m: float, res: float, grid: tuple[int, int], block: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of each coarse pixel's measured footprint that the mask covers: blurred, then averaged; for each value of by apart."""
    sigma = native_m / res / 2.355
    smooth = gaussian(mask.withColumn("set", F.lit(1.0)), "set", sigma, grid, by=by)
    return smooth.groupBy(*by, F.floor(F.col("row") / block).cast("int").alias("row"), F.floor(F.col("col") / block).cast("int").alias("col")).agg(F.avg("smooth").alias("cover"))


def features(px: DataFrame, grid: tuple[int, int], res: float) -> DataFrame:
    """Model features of bands blue, green, red, nir: brightness, indices, gradients, texture and blur differences."""
    radius = 0
    scales = [(m, max(round(m / res), 3), max(m / res / 2, 0.5)) for m in (5.0, 15.0, 40.0)]
    radius = max(max(size, tiles.gauss_radius(sigma)) for _, size, sigma in scales)
    names = ["brightness", "redness", "ndvi", "grad_x", "grad_y", "grad_mag"] + [f"{k}_{int(m)}m" for m, *_ in scales for k in ("tex", "dog")]

    def kernel(blue, green, red, nir):
        gone = np.isnan(blue) | np.isnan(green) | np.isnan(red) | np.isnan(nir)
        b, g, r, n = map(tiles.filled, (blue, green, red, nir))
        bright = (r + g + b) / 3
        gy, gx = tiles.gradient(bright, res)
        out = [bright, (r - b) / (r + b + 1e-6), (n - r) / (n + r + 1e-6), gx, gy, np.hypot(gx, gy)]
        for _, size, sigma in scales:
            out += [tiles.local_std(bright, size), bright - tiles.gauss(bright, sigma)]
        return tuple(np.where(gone, np.nan, x) for x in out)

    return tiles.by_tile(px, kernel, ["blue", "green", "red", "nir"], {n: "double" for n in names}, grid, radius)


def _middle(values: DataFrame, value: str) -> float | None:
    """Exact median of the known values: counted by value and range, so that no task holds all of them."""
    counted = values.where(F.col(value).isNotNull()).groupBy(value).count()
    ranged = written(counted.repartitionByRange(value).withColumn("range", F.spark_partition_id()))
    sizes = {r.range: r.n for r in ranged.groupBy("range").agg(F.sum("count").alias("n")).collect()}  # a row for a shuffle partition
    total, before, found = sum(sizes.values()), 0, []
    for k in sorted(sizes):
        wanted = [x - before for x in {(total - 1) // 2, total // 2} if before <= x < before + sizes[k]]
        if wanted:
            past = F.sum("count").over(Window.partitionBy("range").orderBy(value))
            hit = [(past > x) & (past - F.col("count") <= x) for x in wanted]
            rows = ranged.where(F.col("range") == k).select(value, *[h.alias(f"h{j}") for j, h in enumerate(hit)])
            found += [rows.where(f"h{j}").first()[0] for j in range(len(hit))]
        before += sizes[k]
    return sum(found) / len(found) if found else None


def derived_ground(px: DataFrame, grid: tuple[int, int], res: float, window_m: float = 80.0, coarse_m: float = 4.0, absent: float | None = None) -> DataFrame:
    """Bare ground from a surface alone: block minimum, opening with a wide disc, blur, back to pixels, never above the surface.

    Blocks meet pixels by tile: a block goes to the tiles whose pixels lie beside it.
    """
    k = max(round(coarse_m / res), 1)
    height, width = -(-grid[0] // k), -(-grid[1] // k)
    r = max(round(window_m / 2 / coarse_m), 1)
    tile = tiles.TILE
    block = lambda c: F.floor(F.col(c) / k).cast("int").alias(c)
    low = F.min("dsm")
    if absent is not None:
        side = lambda c, n: F.least(F.lit(k), F.lit(n) - F.col(c) * k)
    coarse = px.groupBy(block("row"), block("col")).agg(low.alias("low"), F.count("*").alias("n"))
    if absent is not None:
        coarse = coarse.withColumn("low", F.when(F.col("n") < side("row", grid[0]) * side("col", grid[1]), F.least("low", F.lit(float(absent)))).otherwise(F.col("low")))
    coarse = written(coarse.select("row", "col", "low"))
    (top,) = coarse.agg(F.max("low")).first()

    def kernel(a):
        b = tiles.filled(a, np.nan if top is None else top)
        return tiles.gauss(tiles.grey_opening(b, tiles.disc(r)), 1.0), np.isnan(a).astype(float)

    # Blocks without a pixel count as the highest one in the opening (or as absent), and are the median of the others afterwards.
    halo = 2 * r + 4
    every = coarse.unionByName(tiles.every_tile(px.sparkSession, (height, width)).select((F.col("tr") * tile).alias("row"), (F.col("tc") * tile).alias("col"), F.lit(None).cast("double").alias("low"))) if absent is None else coarse
    every = every.groupBy("row", "col").agg(F.max("low").alias("low")) if absent is None else every
    ground = written(tiles.by_tile(every, kernel, ["low"], {"ground": "double", "gap": "int"}, (height, width), halo, absent=absent))
    middle = _middle(ground.where("gap = 0"), "ground") if absent is None and ground.where("gap = 1").limit(1).count() else None
    # Corner to corner: pixel i of n*k lies at i * (n - 1) / (n*k - 1).
    steps = [(n - 1) / max(n * k - 1, 1) for n in (height, width)]

    def reach(c: str, step: float, n: int) -> Column:
        """Tiles with a pixel between the blocks before and after this one."""
        low, high = (F.floor((F.col(c) + d) / step) + d if step else F.lit(0 if d < 0 else n - 1) for d in (-1, 1))
        return F.sequence(F.floor(F.greatest(low, F.lit(0)) / tile).cast("int"), F.floor(F.least(high, F.lit(n - 1)) / tile).cast("int"))

    g = ground.withColumn("v", F.when(F.col("gap") == 1, F.lit(middle).cast("double")).otherwise(F.col("ground")))
    g = g.withColumn("tr", F.explode(reach("row", steps[0], grid[0]))).withColumn("tc", F.explode(reach("col", steps[1], grid[1])))
    both = tiles.dealt(px, [F.col("dsm").cast("double").alias("v")], grid, 0).where("v is not null")
    both = both.select("row", "col", "v", "tr", "tc", F.lit(False).alias("coarse")).unionByName(g.select("row", "col", "v", "tr", "tc", F.lit(True).alias("coarse")))

    def run(table: pa.Table) -> pa.Table:
        r0, c0 = (table.column(x)[0].as_py() * tile for x in ("tr", "tc"))
        own, blocks = table.filter(pc.invert(table.column("coarse"))), table.filter(table.column("coarse"))
        row, col = (own.column(x).to_numpy() for x in ("row", "col"))
        v = own.column("v").to_numpy(zero_copy_only=False)
        if absent is not None:
            a = np.full((min(tile, grid[0] - r0), min(tile, grid[1] - c0)), float(absent))
            a[row - r0, col - c0] = v
            row, col = (x.ravel() for x in np.mgrid[r0 : r0 + a.shape[0], c0 : c0 + a.shape[1]])
            v = a.ravel()
        if not len(v) or not blocks.num_rows:
            return pa.table({"row": pa.array([], pa.int32()), "col": pa.array([], pa.int32()), "ground": pa.array([], pa.float64())})
        br, bc = (blocks.column(x).to_numpy() for x in ("row", "col"))
        b = np.full((br.max() - br.min() + 1, bc.max() - bc.min() + 1), np.nan)
        b[br - br.min(), bc - bc.min()] = blocks.column("v").to_numpy(zero_copy_only=False)
        y, x = row * steps[0], col * steps[1]
        y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
        found, weight = np.zeros(len(v)), np.zeros(len(v))
        for i in (0, 1):
            for j in (0, 1):
                w = (1 - np.abs(y0 + i - y)) * (1 - np.abs(x0 + j - x))
                at = b[np.minimum(y0 + i, height - 1) - br.min(), np.minimum(x0 + j, width - 1) - bc.min()]
                found += np.where(np.isnan(at), 0, at) * w
                weight += w
        out = np.minimum(found / weight, v)
        return pa.table({"row": pa.array(row, pa.int32()), "col": pa.array(col, pa.int32()), "ground": pa.array(out, pa.float64(), mask=np.isnan(out))})

    return both.groupBy("tr", "tc").applyInArrow(run, "row int, col int, ground double")
