"""Neighbourhood kernels: pixels are dealt to tiles with a halo, and NumPy works on one tile.

A pixel goes to its own tile and to those whose halo holds it, in one shuffle by tile; a
tile's size is fixed, so is a task's memory. Outside the grid the edge is mirrored (or held
at a constant), from within the tile.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TILE = 256


def dealt(px: DataFrame, columns: list, grid: tuple[int, int] | None, halo: int, tile: int = TILE) -> DataFrame:
    """px(row, col, ...) -> columns, row, col, and tr, tc of each tile whose halo holds the pixel; without a grid tiles go on in all directions."""
    rows = px.where(F.col("row").isNotNull() & F.col("col").isNotNull())
    if grid is not None:
        rows = rows.where(F.col("row").between(0, grid[0] - 1) & F.col("col").between(0, grid[1] - 1))
    rows = rows.select(*columns, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"))
    for c, out, size in (("row", "tr", 0), ("col", "tc", 1)):
        first, most = F.floor((F.col(c) - halo) / tile).cast("int"), -(-2 * halo // tile) + 1
        if most == 1:
            rows = rows.withColumn(out, first)
            continue
        # A fixed number of candidates: sequences of each row's own length take several times as long.
        rows = rows.withColumn(out, F.explode(F.array(*[first + k for k in range(most)]))).where(F.col(out) * tile <= F.col(c) + halo)
        if grid is not None:
            rows = rows.where((F.col(out) >= 0) & (F.col(out) * tile < grid[size]))
    return rows


def every_tile(spark: SparkSession, grid: tuple[int, int], tile: int = TILE) -> DataFrame:
    """tr, tc of the grid's tiles."""
    down, across = -(-grid[0] // tile), -(-grid[1] // tile)
    return spark.range(down * across).select((F.col("id") / across).cast("int").alias("tr"), (F.col("id") % across).cast("int").alias("tc"))


def by_tile(px: DataFrame, kernel: Callable, inputs: list[str], outputs: dict[str, str], grid: tuple[int, int], halo: int, tile: int = TILE, edge: float | None = None, by: tuple[str, ...] = (), absent: float | None = None, repeated: bool = False) -> DataFrame:
    """px(by..., row, col, inputs...) -> by..., row, col, outputs of kernel(arrays) on grid (height, width).

    kernel gets float64 arrays of a tile with its halo (NaN: missing) and returns as many of
    that shape; rows come back for every pixel of the grid's tiles that px touches, null
    for NaN. edge None mirrors at the grid's border, a number stands for all outside it. Each
    value of the columns by is a layer of its own, on the tiles that its pixels touch. With absent
    (and without by) all tiles of the grid come back, and pixels that px has no row for count as that
    number: they are filled in by tile, so a sparse px needn't be joined with all pixels of the grid.
    With repeated, px may have several rows for a pixel, of which the greatest value counts as in SQL's max: they
    meet in the tile, so px needn't be grouped, and shuffled, by pixel before.
    """
    height, width = grid
    rows = dealt(px, [*by, *[F.col(c).cast("double").alias(c) for c in inputs]], grid, halo, tile)
    if absent is not None:
        if by:
            raise ValueError("absent pixels of layers")
        rows = rows.unionByName(every_tile(px.sparkSession, grid, tile), allowMissingColumns=True)
    # One key of eight bytes: rows of a task are sorted by it without comparing them.
    rows = rows.withColumn("tile", F.shiftleft(F.col("tr").cast("long"), 32) + F.col("tc")).drop("tr", "tc")
    if absent is not None:
        rows = rows.repartition(tasks(of_grid(grid, tile)), "tile")
    kinds = {k: px.schema[k].dataType.simpleString() for k in by}
    schema = ", ".join([*(f"{k} {v}" for k, v in kinds.items()), "row int", "col int", *(f"{k} {v}" for k, v in outputs.items())])
    around = np.nan if absent is None else absent

    def run(table: pa.Table) -> pa.Table:
        tr, tc = divmod(table.column("tile")[0].as_py(), 1 << 32)
        # The part of the tile and its halo that lies in the grid.
        r0, r1 = max(tr * tile - halo, 0), min((tr + 1) * tile + halo, height)
        c0, c1 = max(tc * tile - halo, 0), min((tc + 1) * tile + halo, width)
        own = table if absent is None else table.filter(table.column("row").is_valid())
        row, col = (own.column(k).to_numpy() for k in ("row", "col"))
        arrays = []
        for name in inputs:
            a = np.full((r1 - r0, c1 - c0), around)
            v = own.column(name).to_numpy(zero_copy_only=False).astype(float)
            if repeated:  # the last of a pixel's rows stays
                order = np.argsort(np.where(own.column(name).is_null().to_numpy(), -np.inf, v), kind="stable")
                a[row[order] - r0, col[order] - c0] = v[order]
            else:
                a[row - r0, col - c0] = v
            pad = ((halo - (tr * tile - r0), halo - (r1 - min((tr + 1) * tile, height))), (halo - (tc * tile - c0), halo - (c1 - min((tc + 1) * tile, width))))
            arrays.append(np.pad(a, pad, mode="symmetric") if edge is None else np.pad(a, pad, constant_values=edge))
        found = kernel(*arrays)
        found = found if isinstance(found, tuple) else (found,)
        h, w = min(tile, height - tr * tile), min(tile, width - tc * tile)
        rr, cc = np.mgrid[tr * tile : tr * tile + h, tc * tile : tc * tile + w]
        columns = [pa.repeat(table.column(k)[0], h * w) for k in by]
        columns += [pa.array(rr.ravel(), pa.int32()), pa.array(cc.ravel(), pa.int32())]
        for a, kind in zip(found, outputs.values()):
            core = np.asarray(a, float)[halo : halo + h, halo : halo + w].ravel()
            column = pa.array(core, pa.float64(), mask=np.isnan(core))
            columns.append(column if kind == "double" else column.cast(pa.int32() if kind == "int" else pa.int64()))
        return pa.table(columns, names=[*by, "row", "col", *outputs])

    return rows.groupBy(*by, "tile").applyInArrow(run, schema)


def mask_by_tile(mask: DataFrame, kernel: Callable, halo: int, tile: int = TILE) -> DataFrame:
    """mask(row, col) of set pixels -> those that kernel (booleans of a tile with its halo, unset outside the mask) sets, on a grid without borders."""
    kind = mask.schema["row"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        r0, c0 = (table.column(k)[0].as_py() * tile for k in ("tr", "tc"))
        a = np.zeros((tile + 2 * halo,) * 2, bool)
        a[table.column("row").to_numpy() - r0 + halo, table.column("col").to_numpy() - c0 + halo] = True
        return _pixels(kernel(a)[halo : halo + tile, halo : halo + tile], r0, c0)

    out = dealt(mask, [], None, halo, tile).groupBy("tr", "tc").applyInArrow(run, "row int, col int")
    return out.select(F.col("row").cast(kind).alias("row"), F.col("col").cast(kind).alias("col"))


def tasks(tiles: int) -> int:
    """Tasks for so many tiles: eight a task. Tiles are small as bytes, so partitions by size would leave them all to one task."""
    return max(1, min(-(-tiles // 8), 2048))


def apart(tiles: DataFrame, n: int) -> DataFrame:
    """n rows of tiles (tr, tc, ...) over their tasks."""
    return tiles.repartition(tasks(n), "tr", "tc")


def of_grid(grid: tuple[int, int], tile: int = TILE) -> int:
    """The grid's tiles."""
    return -(-grid[0] // tile) * -(-grid[1] // tile)


def _pixels(a: np.ndarray, r0: int, c0: int) -> pa.Table:
    r, c = np.nonzero(a)
    return pa.table({"row": pa.array(r + r0, pa.int32()), "col": pa.array(c + c0, pa.int32())})


def _packed(a: np.ndarray, tr: int, tc: int) -> pa.Table:
    return pa.table({"tr": pa.array([tr], pa.int32()), "tc": pa.array([tc], pa.int32()), "bits": pa.array([np.packbits(a).tobytes()], pa.binary())})


def unpacked(bits: bytes, tile: int = TILE) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), count=tile * tile).reshape(tile, tile).astype(bool)


PACKED = "tr int, tc int, bits binary"


def packed(mask: DataFrame, tile: int = TILE) -> DataFrame:
    """mask(row, col) of set pixels -> tr, tc, bits of the tiles it touches: a row for each."""

    def run(table: pa.Table) -> pa.Table:
        tr, tc = (table.column(k)[0].as_py() for k in ("tr", "tc"))
        a = np.zeros((tile, tile), bool)
        a[table.column("row").to_numpy() - tr * tile, table.column("col").to_numpy() - tc * tile] = True
        return _packed(a, tr, tc)

    return dealt(mask, [], None, 0, tile).groupBy("tr", "tc").applyInArrow(run, PACKED)


def _painted(boxes: DataFrame, grid: tuple[int, int], tile: int, halo: int, out: Callable, schema: str) -> DataFrame:
    """out(booleans of a tile with its halo, tr, tc) of the grid's tiles that boxes touch; only boxes are shuffled, to the tiles whose halo they reach."""
    height, width = grid

    def span(c: str, n: str, size: int):
        first, last = F.greatest(F.col(c), F.lit(0)) - halo, F.least(F.col(c) + F.col(n), F.lit(size)) - 1 + halo
        return F.sequence(F.floor(F.greatest(first, F.lit(0)) / tile).cast("int"), F.floor(F.least(last, F.lit(size - 1)) / tile).cast("int"))

    inside = (F.col("high") > 0) & (F.col("wide") > 0) & (F.col("row") < height) & (F.col("col") < width) & (F.col("row") + F.col("high") > 0) & (F.col("col") + F.col("wide") > 0)
    rows = boxes.where(inside).select(*[F.col(c).cast("int").alias(c) for c in ("row", "col", "high", "wide")])
    rows = rows.withColumn("tr", F.explode(span("row", "high", height))).withColumn("tc", F.explode(span("col", "wide", width)))
    around = tile + 2 * halo

    def run(table: pa.Table) -> pa.Table:
        tr, tc = (table.column(k)[0].as_py() for k in ("tr", "tc"))
        r0, c0 = tr * tile - halo, tc * tile - halo
        row, col, high, wide = (table.column(k).to_numpy() for k in ("row", "col", "high", "wide"))
        top, left, past, end = (np.clip(x, 0, around) for x in (row - r0, col - c0, row + high - r0, col + wide - c0))
        a = np.zeros((around + 1, around + 1), int)  # +1 where a box begins, -1 where it is over: sums count the boxes of a pixel
        for r, c, sign in ((top, left, 1), (past, end, 1), (top, end, -1), (past, left, -1)):
            np.add.at(a, (r, c), sign)
        a = a.cumsum(0).cumsum(1)[:around, :around] > 0
        a[: max(-r0, 0)] = a[max(height - r0, 0) :] = False
        a[:, : max(-c0, 0)] = a[:, max(width - c0, 0) :] = False
        return out(a, tr, tc)

    return apart(rows, of_grid(grid, tile)).groupBy("tr", "tc").applyInArrow(run, schema)


def painted(boxes: DataFrame, grid: tuple[int, int], tile: int = TILE, kernel: Callable | None = None, halo: int = 0) -> DataFrame:
    """boxes(row, col, high, wide) -> row, col of the grid's pixels that any box covers, once each: boxes go to the tiles they touch.

    With a kernel (as in mask_by_tile, within halo) those that it sets.
    """

    def out(a, tr, tc):
        a = a if kernel is None else kernel(a)
        h, w = min(tile, grid[0] - tr * tile), min(tile, grid[1] - tc * tile)
        return _pixels(a[halo : halo + h, halo : halo + w], tr * tile, tc * tile)

    return _painted(boxes, grid, tile, halo, out, "row int, col int")


def painted_tiles(boxes: DataFrame, grid: tuple[int, int], tile: int = TILE) -> DataFrame:
    """The same pixels as packed() has them: tr, tc, bits, no row for a pixel."""
    return _painted(boxes, grid, tile, 0, _packed, PACKED)


def filled(a: np.ndarray, value: float = 0.0) -> np.ndarray:
    return np.where(np.isnan(a), value, a)


def gauss(a: np.ndarray, sigma: float, cut: float = 4.0) -> np.ndarray:
    """Separable Gaussian, cut at 4 sigma; what the halo lacks is mirrored and thrown away."""
    r = int(cut * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    w /= w.sum()
    for axis in (0, 1):
        b = np.pad(a, [(r, r) if k == axis else (0, 0) for k in (0, 1)], mode="symmetric")
        a = np.apply_along_axis(np.convolve, axis, b, w, mode="valid")
    return a


def gauss_radius(sigma: float) -> int:
    return int(4.0 * sigma + 0.5)


def disc(r: int) -> np.ndarray:
    y, x = np.mgrid[-r : r + 1, -r : r + 1]
    return x * x + y * y <= r * r


def _over(a: np.ndarray, shape: np.ndarray, pick: Callable) -> np.ndarray:
    """pick (minimum or maximum) over the shape's offsets, mirrored at the array's edge."""
    r, c = shape.shape[0] // 2, shape.shape[1] // 2
    b = np.pad(a, ((r, r), (c, c)), mode="symmetric")
    out = None
    for i, j in np.argwhere(shape):
        part = b[i : i + a.shape[0], j : j + a.shape[1]]
        out = part.copy() if out is None else pick(out, part)
    return out


def grey_opening(a: np.ndarray, shape: np.ndarray) -> np.ndarray:
    return _over(_over(a, shape, np.minimum), shape, np.maximum)


def median_filter(a: np.ndarray, size: int) -> np.ndarray:
    lo = size // 2
    b = np.pad(a, (lo, size - 1 - lo), mode="symmetric")
    windows = np.lib.stride_tricks.sliding_window_view(b, (size, size))
    if size % 2 == 0 or np.isnan(b).any():
        return np.median(windows, axis=(2, 3))
    return np.partition(windows.reshape(*a.shape, size * size), size * size // 2)[..., size * size // 2]  # the same in a third of the time


def box_mean(a: np.ndarray, size: int) -> np.ndarray:
    """Even sizes reach one pixel further back than forward."""
    lo = size // 2
    b = np.pad(a, (lo, size - 1 - lo), mode="symmetric")
    s = np.pad(b.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (s[size:, size:] - s[:-size, size:] - s[size:, :-size] + s[:-size, :-size]) / size**2


def local_std(a: np.ndarray, size: int) -> np.ndarray:
    return np.sqrt(np.maximum(box_mean(a * a, size) - box_mean(a, size) ** 2, 0))


def gradient(a: np.ndarray, res: float) -> tuple[np.ndarray, np.ndarray]:
    return np.gradient(a, res)


def cubic(a: np.ndarray, factor: int) -> np.ndarray:
    """Cubic B-spline samples of a, factor per pixel and axis: coefficients by the two-sided filter."""
    pole = np.sqrt(3.0) - 2
    for axis in (0, 1):
        b = np.moveaxis(a, axis, 0)
        n = len(b)
        ring = np.concatenate((b, b[::-1]))  # the mirrored signal repeats
        k = np.arange(2 * n)
        w = (pole**k + pole ** (2 * n - k)) / (1 - pole ** (2 * n)) * np.sqrt(3.0)  # summed over all repeats
        spectrum = np.fft.fft(ring, axis=0) * np.fft.fft(w)[:, None]
        coef = np.fft.ifft(spectrum, axis=0).real[:n]
        at = (np.arange(n * factor) + 0.5) / factor - 0.5
        base = np.floor(at).astype(int)
        t = at - base
        weights = [(1 - t) ** 3 / 6, (3 * t**3 - 6 * t**2 + 4) / 6, (-3 * t**3 + 3 * t**2 + 3 * t + 1) / 6, t**3 / 6]
        out = 0
        for d, x in zip((-1, 0, 1, 2), weights):
            i = base + d
            i = np.where(i < 0, -i - 1, np.where(i >= n, 2 * n - 1 - i, i))
            out = out + coef[i] * x[:, None]
        a = np.moveaxis(out, 0, axis)
    return a
