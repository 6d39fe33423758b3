"""Finer bands by filters of patches: what a spline loses, as a linear function of a coarse pixel's neighbours.

A patch is a coarse pixel's 5 x 5 neighbourhood less its mean. Its kind is the direction of its
slope and whether the slope explains it; both stay when a band is scaled or shifted, and so do
the filters, so they can be fitted on one site and used on another without matching radiometry.
A fit is one pass: normal equations are sums by band, fold and kind, and the fit that leaves a fold out
adds up the others'. Only these sums, of fixed size, reach the driver. A table has one row a pixel.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from . import tiles
from .resample import block_mean

REACH = 2
SIZE = (2 * REACH + 1) ** 2
SECTORS = 8
#: Patches that the filter of all kinds counts for in the fit of one kind, and the ridge of that filter.
PRIOR, RIDGE = 50.0, 1e-6
FILTERS = "band string, factor int, kind int, weights array<double>"


def kinds(x: np.ndarray) -> np.ndarray:
    """Kind of each patch (a row of SIZE values): the sector of its slope, SECTORS more if the slope is under half of its variance."""
    mid, wide = SIZE // 2, 2 * REACH + 1
    gx, gy = (x[:, mid + 1] - x[:, mid - 1]) / 2, (x[:, mid + wide] - x[:, mid - wide]) / 2
    sector = np.floor(np.mod(np.arctan2(gy, gx), np.pi) * SECTORS / np.pi).astype(int) % SECTORS
    rough = 4 * (gx**2 + gy**2) < (x**2).mean(1)
    return sector + SECTORS * rough


#: Coarse pixels around a tile that its splines reach.
HALO = 16


def _near(a: np.ndarray) -> np.ndarray:
    """Patch of each pixel as a row of SIZE values less their mean; mirrored at the array's edge, NaN where a value is missing."""
    b = np.pad(a, REACH, mode="symmetric")
    near = np.lib.stride_tricks.sliding_window_view(b, (2 * REACH + 1, 2 * REACH + 1)).reshape(-1, SIZE)
    return near - near.mean(1, keepdims=True)


class _Tile:
    """A tile of coarse pixels with its halo, and which part of it is the tile's own."""

    def __init__(self, tr: int, tc: int, grid: tuple[int, int], tile: int):
        self.row, self.col = tr * tile, tc * tile
        self.high, self.wide = min(tile, grid[0] - self.row), min(tile, grid[1] - self.col)
        self.r0, self.c0 = max(self.row - HALO, 0), max(self.col - HALO, 0)
        self.shape = min(self.row + tile + HALO, grid[0]) - self.r0, min(self.col + tile + HALO, grid[1]) - self.c0
        self.top, self.left = self.row - self.r0, self.col - self.c0

    def coarse(self, table: pa.Table, band: str) -> np.ndarray:
        a = np.full(self.shape, np.nan)
        a[table.column("row").to_numpy() - self.r0, table.column("col").to_numpy() - self.c0] = table.column(band).to_numpy(zero_copy_only=False)
        return a

    def core(self, a: np.ndarray, k: int = 1) -> np.ndarray:
        return a[self.top * k : (self.top + self.high) * k, self.left * k : (self.left + self.wide) * k]

    def patches(self, a: np.ndarray) -> np.ndarray:
        return self.core(_near(a).reshape(*a.shape, SIZE)).reshape(-1, SIZE)


def _blocks(a: np.ndarray, factor: int) -> np.ndarray:
    """A row of factor^2 pixels, row by row, for each block."""
    return a.reshape(a.shape[0] // factor, factor, a.shape[1] // factor, factor).swapaxes(1, 2).reshape(-1, factor * factor)


def _sums(reference: DataFrame, bands: list[str], factor: int, grid: tuple[int, int], folds: DataFrame | None = None) -> dict[tuple[str, int], dict[int, tuple[int, np.ndarray, float]]]:
    """(band, fold) -> kind -> number of patches, their products with themselves and with what is to be found (the reference less
    the spline of its block means), and the sum of its squares.

    Pixels go to the tile of their block in one shuffle, blocks to the tiles whose splines reach them and folds(row, col, fold)
    of coarse pixels to their tile; a tile's examples are summed there and don't leave it. Only blocks that are wholly known with their
    neighbourhood count, and only those with a fold if there are folds.
    """
    tile, area, by_fold = tiles.TILE, factor * factor, folds is not None
    values = [F.col(b).cast("double").alias(b) for b in bands]
    fine = tiles.dealt(reference, values, (grid[0] * factor, grid[1] * factor), 0, tile * factor).withColumn("what", F.lit(0))
    blocks = written(block_mean(reference.where(F.col("row").between(0, grid[0] * factor - 1) & F.col("col").between(0, grid[1] * factor - 1)), bands, factor))
    rows = fine.unionByName(tiles.dealt(blocks, values, grid, HALO, tile).withColumn("what", F.lit(1)))
    if by_fold:
        own = tiles.dealt(folds, [F.col("fold").cast("int").alias("fold")], grid, 0, tile).where("fold is not null").withColumn("what", F.lit(2))
        rows = rows.unionByName(own, allowMissingColumns=True)
    schema = "band string, fold int, kind int, n long, squares double, part binary"
    typed = pa.schema([("band", pa.string()), ("fold", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("squares", pa.float64()), ("part", pa.binary())])

    def products(table: pa.Table) -> pa.Table:
        t = _Tile(table.column("tr")[0].as_py(), table.column("tc")[0].as_py(), grid, tile)
        fine, blocks, owned = (table.filter(pc.equal(table.column("what"), k)) for k in range(3))
        at = fine.column("row").to_numpy() - t.row * factor, fine.column("col").to_numpy() - t.col * factor
        fold = np.zeros((t.high, t.wide))
        if by_fold:
            fold[:] = np.nan
            fold[owned.column("row").to_numpy() - t.row, owned.column("col").to_numpy() - t.col] = owned.column("fold").to_numpy(zero_copy_only=False)
        fold, out = fold.ravel(), []
        for band in bands:
            a, sharp = t.coarse(blocks, band), np.full((t.high * factor, t.wide * factor), np.nan)
            sharp[at] = fine.column(band).to_numpy(zero_copy_only=False)
            x, y = t.patches(a), _blocks(sharp - t.core(tiles.cubic(tiles.filled(a), factor), factor), factor)
            good = ~(np.isnan(x).any(1) | np.isnan(y).any(1) | np.isnan(fold))
            x, y, of = x[good], y[good], fold[good].astype(int)
            kind = kinds(x) if len(x) else of
            for f, k in sorted(set(zip(of.tolist(), kind.tolist()))):
                mine = (of == f) & (kind == k)
                part = x[mine].T @ np.hstack((x[mine], y[mine]))
                out.append({"band": band, "fold": f, "kind": k, "n": int(mine.sum()), "squares": float((y[mine] ** 2).sum()), "part": part.tobytes()})
        return pa.Table.from_pylist(out, typed)

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(SIZE * (SIZE + area))
        for p in group.column("part"):
            total += np.frombuffer(p.as_py(), float)
        ends = [pa.array([pc.sum(group.column(c)).as_py()], t) for c, t in (("n", pa.int64()), ("squares", pa.float64()))]
        return pa.table([*(group.column(k)[:1] for k in ("band", "fold", "kind")), *ends, pa.array([total.tobytes()], pa.binary())], schema=typed)

    out: dict = {}
    for r in rows.groupBy("tr", "tc").applyInArrow(products, schema).groupBy("band", "fold", "kind").applyInArrow(add, schema).collect():  # bands x folds x kinds
        out.setdefault((r.band, r.fold), {})[r.kind] = (r.n, np.frombuffer(r.part, float).reshape(SIZE, SIZE + area), r.squares)
    return out


def _solved(sums: list[dict[int, tuple[int, np.ndarray, float]]]) -> dict[int, np.ndarray]:
    """Filters (SIZE x factor^2) of each kind from sums added up; a kind of few patches leans on the filter of all."""
    added: dict[int, np.ndarray] = {}
    for part in sums:
        for kind, (_, m, _) in part.items():
            added[kind] = added.get(kind, 0) + m
    count = sum(n for part in sums for n, _, _ in part.values())
    whole = sum(added.values())
    spread = float(np.trace(whole[:, :SIZE])) / SIZE
    if spread == 0:  # flat patches only: nothing to add
        return {k: np.zeros(m[:, SIZE:].shape) for k, m in added.items()}
    base = np.linalg.solve(whole[:, :SIZE] + RIDGE * spread * np.eye(SIZE), whole[:, SIZE:])
    lean = PRIOR * spread / count
    out = {k: np.linalg.solve(m[:, :SIZE] + lean * np.eye(SIZE), m[:, SIZE:] + lean * base) for k, m in added.items()}
    return {k: out.get(k, base) for k in range(2 * SECTORS)}


def trained(reference: DataFrame, bands: list[str], factor: int, grid: tuple[int, int]) -> DataFrame:
    """reference(row, col, bands) on factor times grid -> FILTERS, a table of 16 rows a band to be saved and used on any site.

    Blocks and patches with a missing pixel are left out; a band without any has no filters.
    """
    sums = _sums(reference, bands, factor, grid)
    rows = [(band, factor, kind, w.ravel().tolist()) for (band, _), part in sorted(sums.items()) for kind, w in sorted(_solved([part]).items())]
    return reference.sparkSession.createDataFrame(rows, FILTERS)


def held(filters: DataFrame | None, bands: list[str], factor: int) -> dict[str, dict[int, np.ndarray]]:
    """The filters of bands at a factor, {} if a band has none: 16 rows a band."""
    rows = [] if filters is None else filters.where(F.col("band").isin(bands) & (F.col("factor") == factor)).collect()
    out: dict[str, dict[int, np.ndarray]] = {}
    for r in rows:
        out.setdefault(r.band, {})[r.kind] = np.array(r.weights).reshape(SIZE, factor * factor)
    return out if set(out) == set(bands) else {}


def _found(x: np.ndarray, filters: dict[int, np.ndarray], area: int) -> np.ndarray:
    out, kind = np.zeros((len(x), area)), kinds(x)
    for k in np.unique(kind).tolist():
        if k in filters:
            out[kind == k] = x[kind == k] @ filters[k]
    return out


def patched(coarse: DataFrame, filters: DataFrame, bands: list[str], factor: int, grid: tuple[int, int]) -> DataFrame:
    """coarse(row, col, bands) -> fine row, col, bands: splines, and what the filters find in each whole patch. A band without filters stays a spline.

    Both are made in the tile, so fine pixels are never shuffled.
    """
    use = {b: held(filters, [b], factor).get(b, {}) for b in bands}
    tile, area = tiles.TILE, factor * factor
    shared = coarse.sparkSession.sparkContext.broadcast(use)  # 16 filters of 25 x factor^2 numbers a band

    def run(table: pa.Table) -> pa.Table:
        t = _Tile(table.column("tr")[0].as_py(), table.column("tc")[0].as_py(), grid, tile)
        found = []
        for band in bands:
            a = t.coarse(table, band)
            if np.isnan(a).all():
                found.append(None)
                continue
            x, add = t.patches(a), np.zeros((t.high * t.wide, area))
            whole = ~np.isnan(x).any(1)
            if whole.any():
                add[whole] = _found(x[whole], shared.value[band], area)
            add = add.reshape(t.high, t.wide, factor, factor).swapaxes(1, 2).reshape(t.high * factor, t.wide * factor)
            found.append((t.core(tiles.cubic(tiles.filled(a), factor), factor) + add).ravel())
        n = t.high * t.wide * area if any(v is not None for v in found) else 0
        row, col = np.divmod(np.arange(n), t.wide * factor)
        columns = [pa.array(row + t.row * factor, pa.int32()), pa.array(col + t.col * factor, pa.int32())]
        return pa.table([*columns, *[pa.nulls(n, pa.float64()) if v is None else pa.array(v) for v in found]], names=["row", "col", *bands])

    rows = tiles.dealt(coarse, [F.col(b).cast("double").alias(b) for b in bands], grid, HALO, tile)
    return rows.groupBy("tr", "tc").applyInArrow(run, "row int, col int, " + ", ".join(f"{b} double" for b in bands))


def scored(reference: DataFrame, bands: list[str], factor: int, grid: tuple[int, int], folds: DataFrame) -> DataFrame:
    """band, n, rmse_bicubic, rmse_sr, improvement_pct against the reference, each fold's pixels by filters of the other folds.

    folds(row, col, fold) are of coarse pixels. Bands without a whole block give no row; a
    spline without an error improves by 0. The error of a fit is a form of the sums that it came from: with x'x, x'y and y'y of
    a fold and kind and the others' filter w it is y'y - 2 w'x'y + w'x'x w, so the scene is read once.
    """
    sums = _sums(reference, bands, factor, grid, folds)
    area, total = factor * factor, {}
    for (b, f), part in sorted(sums.items()):
        rest = [s for (c, g), s in sums.items() if c == b and g != f]
        fit = _solved(rest) if rest else {}
        held = total.setdefault(b, [0, 0.0, 0.0])
        for kind, (n, m, squares) in part.items():
            w = fit.get(kind)
            gain = 0.0 if w is None else float((w * (m[:, :SIZE] @ w - 2 * m[:, SIZE:])).sum())
            held[0] += n * area
            held[1] += squares
            held[2] += max(squares + gain, 0.0)
    rows = [(b, n, float(np.sqrt(plain / n)), float(np.sqrt(sharp / n))) for b, (n, plain, sharp) in total.items()]
    out = reference.sparkSession.createDataFrame(rows, "band string, n long, rmse_bicubic double, rmse_sr double")
    gain = 100 * (F.col("rmse_bicubic") - F.col("rmse_sr")) / F.col("rmse_bicubic")
    return out.withColumn("improvement_pct", F.when(F.col("rmse_bicubic") > 0, gain).otherwise(0.0))
