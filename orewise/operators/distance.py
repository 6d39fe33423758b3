"""Exact Euclidean distances inside a mask, over tiles, with no limit from a halo.

The transform is separable. Along each row the nearest unset pixel to both sides is known within
a tile or carried from the tiles beside it: a row of a strip of tiles carries two numbers. That
gives each pixel a parabola over its column, and a pixel's squared distance is the lower envelope of
the column's parabolas. Of a tile's parabolas only those that can be lowest somewhere above or below it
leave it; tiles of a strip take them up in order, drop what has been overtaken, and pass the
rest on. Pixels are handled by tile only; what runs along a strip are these summaries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from . import tiles

TILE = 256
#: Stands for "no unset pixel": larger than any squared distance, and sums of two still fit.
_FAR = 1 << 60
_LONG, _LONGS = pa.int64(), pa.list_(pa.int64())


def _hull(at: np.ndarray, height: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parabolas (x - at)^2 + height of many columns, rows ascending by `at`, absent ones _FAR: same shape, without those never lowest.

    A stack for each column, all columns at a time.
    """
    n, cols = height.shape
    column = np.arange(cols)
    q, g, top = np.zeros((n, cols), np.int64), np.full((n, cols), _FAR), np.full(cols, -1)
    for k in range(n):
        todo = height[k] < _FAR
        while True:
            # Pop the top while the new parabola overtakes it no later than it overtook the one below.
            a, b = np.maximum(top - 1, 0), np.maximum(top, 0)
            qa, ga, qb, gb = q[a, column], g[a, column], q[b, column], g[b, column]
            left = (gb + qb * qb - ga - qa * qa) * (at[k] - qb)
            right = (height[k] + at[k] * at[k] - gb - qb * qb) * (qb - qa)
            pop = todo & (top >= 1) & (right <= left)
            if not pop.any():
                break
            top = top - pop
        top = top + todo
        q[top[todo], column[todo]], g[top[todo], column[todo]] = at[k], height[k][todo]
    g[np.arange(n)[:, None] > top] = _FAR
    return q, g


def _visible(at: np.ndarray, row: np.ndarray, height: np.ndarray, edge: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat parabolas (column, row, height), rows ascending in a column -> those that are lowest somewhere at edge or past it.

    Past means in the direction from the rows to the edge: rows are all on one side of it.
    """
    if not len(at):
        return at, row, height
    sign = 1 if row[0] < edge else -1
    x = np.abs(row - edge)
    # Ascending distance from the edge: one is overtaken at the edge already if a nearer one is as low there.
    order = np.lexsort((x, at))
    at, x, height = at[order], x[order], height[order]
    start = np.flatnonzero(np.diff(at, prepend=-1))
    place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
    grid_x, grid_h = np.zeros((place.max() + 1, size), np.int64), np.full((place.max() + 1, size), _FAR)
    grid_x[place, at], grid_h[place, at] = x, height
    there = grid_h < _FAR
    value = np.where(there, grid_x**2 + grid_h, 2 * _FAR)
    nearer = np.vstack((np.full((1, size), 2 * _FAR), np.minimum.accumulate(value, 0)[:-1]))
    grid_h[value >= nearer] = _FAR
    # Farthest first, on an axis that grows towards the edge.
    far, k = np.unique(-grid_x[grid_h < _FAR]), None
    line = np.full((len(far), size), _FAR)
    k = np.nonzero(grid_h < _FAR)
    line[np.searchsorted(far, -grid_x[k]), k[1]] = grid_h[k]
    q, g = _hull(far, line)
    k = np.nonzero(g < _FAR)
    out = k[1], edge + sign * q[k], g[k]
    order = np.lexsort((out[1], out[0]))
    return tuple(c[order] for c in out)


def _beside(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last unset place of each row; -1 where a row has none."""
    unset = ~bits
    any_ = unset.any(1)
    return np.where(any_, unset.argmax(1), -1), np.where(any_, bits.shape[1] - 1 - unset[:, ::-1].argmax(1), -1)


def _row_gap(bits: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Squared distance along the row to the nearest unset pixel; before and after: the nearest beyond the tile (places in its columns), _FAR if none."""
    w = bits.shape[1]
    x = np.arange(w)
    last = np.maximum.accumulate(np.where(bits, -_FAR, x), 1)
    last = np.where(last < 0, np.where(before < _FAR, before, -_FAR)[:, None], last)
    first = np.minimum.accumulate(np.where(bits, _FAR, x)[:, ::-1], 1)[:, ::-1]
    first = np.where(first == _FAR, after[:, None], first)
    gap = np.minimum(np.where(last > -_FAR, x - last, _FAR), np.where(first < _FAR, first - x, _FAR))
    return np.where(gap < _FAR, np.minimum(gap, 1 << 29) ** 2, _FAR)


def distance_inside(mask: DataFrame, grid: tuple[int, int], tile: int = TILE) -> DataFrame:
    """mask(row, col) of set pixels, or its tiles (tiles.packed) -> row, col, distance: to the nearest unset pixel of the grid (height, width), exactly.

    A row for each pixel of the tiles that the mask touches: 0 for unset ones, null where the
    whole grid is set. Repeated pixels are one, pixels outside the grid and null ones are left out;
    outside is neither set nor unset. An empty mask gives none. Sides are up to 2 ** 20, so that products of envelopes stay exact.
    """
    height, width = grid
    if max(grid) > 1 << 20:
        raise ValueError("sides above 2 ** 20")
    inside = mask
    if "bits" not in mask.columns:
        inside = tiles.packed(mask.where(F.col("row").between(0, height - 1) & F.col("col").between(0, width - 1)), tile)
    shape = lambda tr, tc: (min(tile, height - tr * tile), min(tile, width - tc * tile))

    def sides(batches):
        for batch in batches:
            for row in batch.to_pylist():
                h, w = shape(row["tr"], row["tc"])
                first, last = _beside(tiles.unpacked(row["bits"], tile)[:h, :w])
                columns = zip(([row["tr"]], [row["tc"]], [row["bits"]], [first], [last]), (pa.int32(), pa.int32(), pa.binary(), _LONGS, _LONGS))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in columns], ["tr", "tc", "bits", "first", "last"])

    own = written(inside.mapInArrow(sides, "tr int, tc int, bits binary, first array<long>, last array<long>"))
    n = own.count()

    def along_rows(table: pa.Table) -> pa.Table:
        """A strip of tiles side by side: for each row of each tile the nearest unset column before and after it, in the grid."""
        table = table.sort_by("tc")
        tr, tcs = table.column("tr")[0].as_py(), table.column("tc").to_numpy()
        rows = shape(tr, 0)[0]
        sides = {}
        for name, order, step in (("before", range(len(tcs)), -1), ("after", range(len(tcs) - 1, -1, -1), 1)):
            near, expected, out = np.full(rows, _FAR), 0 if step < 0 else -(-width // tile) - 1, {}
            for k in order:
                c0, c1 = tcs[k] * tile, min((tcs[k] + 1) * tile, width)
                if tcs[k] != expected:  # tiles that aren't there are unset
                    near = np.full(rows, c0 - 1 if step < 0 else c1)
                out[k] = near
                own = np.array((table.column("last") if step < 0 else table.column("first"))[k].as_py())
                near, expected = np.where(own >= 0, own + c0, near), tcs[k] - step
            sides[name] = [out[k].tolist() for k in range(len(tcs))]
        return pa.table([table.column("tr"), table.column("tc"), pa.array(sides["before"], _LONGS), pa.array(sides["after"], _LONGS)], names=["tr", "tc", "before", "after"])

    # A task for a strip or for a few tiles: they are small as bytes, and partitions by size would leave all of them to one task.
    carried = own.select("tr", "tc", "first", "last").repartition(-(-height // tile), "tr").groupBy("tr").applyInArrow(along_rows, "tr int, tc int, before array<long>, after array<long>")

    def parabolas(tr: int, tc: int, row: dict) -> np.ndarray:
        h, w = shape(tr, tc)
        bits = tiles.unpacked(row["bits"], tile)[:h, :w]
        place = lambda name: np.where((x := np.array(row[name])) < _FAR, x - tc * tile, _FAR)
        return np.where(bits, _row_gap(bits, place("before"), place("after")), 0)

    named = ("column", "row", "height")
    flat = ", ".join(f"{side}_{k} array<long>" for side in ("up", "down") for k in named)

    def outward(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tr, tc = row["tr"], row["tc"]
                g = parabolas(tr, tc, row)
                r, c = np.nonzero(g.T < _FAR)[::-1]
                flatly = c, r + tr * tile, g[r, c]
                up = _visible(*flatly, tr * tile - 1, g.shape[1])
                down = _visible(*flatly, tr * tile + g.shape[0], g.shape[1])
                columns = [pa.array([tr], pa.int32()), pa.array([tc], pa.int32()), *[pa.array([x], _LONGS) for x in (*up, *down)]]
                yield pa.RecordBatch.from_arrays(columns, ["tr", "tc", *[f"{s}_{k}" for s in ("up", "down") for k in named]])

    whole = written(own.drop("first", "last").join(carried, ["tr", "tc"]))
    leaving = tiles.apart(whole, n).mapInArrow(outward, f"tr int, tc int, {flat}")

    def along_columns(table: pa.Table) -> pa.Table:
        """A strip of tiles one above the other: what reaches each from above (in down_*) and from below (in up_*)."""
        table = table.sort_by("tr")
        tc, trs = table.column("tc")[0].as_py(), table.column("tr").to_numpy()
        w = shape(0, tc)[1]
        empty = tuple(np.zeros(0, np.int64) for _ in named)
        out = {}
        for side, order, step in (("down", range(len(trs)), 1), ("up", range(len(trs) - 1, -1, -1), -1)):
            state, expected = empty, 0 if step > 0 else -(-height // tile) - 1
            for k in order:
                top, past = trs[k] * tile, min((trs[k] + 1) * tile, height)
                edge = top if step > 0 else past - 1
                if trs[k] != expected:
                    state = np.arange(w), np.full(w, edge - step), np.zeros(w, np.int64)
                state = _visible(*state, edge, w)
                out[side, k] = state
                own = tuple(np.array(table.column(f"{side}_{x}")[k].as_py(), np.int64) for x in named)
                state, expected = tuple(np.concatenate(x) for x in zip(state, own)), trs[k] + step
        columns = [pa.array([out[s, k][j] for k in range(len(trs))], _LONGS) for s in ("up", "down") for j in range(3)]
        return pa.table([table.column("tr"), table.column("tc"), *columns], names=["tr", "tc", *[f"{s}_{k}" for s in ("up", "down") for k in named]])

    arriving = leaving.repartition(-(-width // tile), "tc").groupBy("tc").applyInArrow(along_columns, f"tr int, tc int, {flat}")

    def lowest(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tr, tc = row["tr"], row["tc"]
                g = parabolas(tr, tc, row)
                h, w = g.shape
                rows = np.arange(tr * tile, tr * tile + h)
                best = g.copy()
                for side in ("up", "down"):
                    c, r, z = (np.array(row[f"{side}_{k}"], np.int64) for k in named)
                    first = np.flatnonzero(np.diff(c, prepend=-1))
                    place = np.arange(len(c)) - np.repeat(first, np.diff(np.append(first, len(c))))
                    for k in range(place.max() + 1 if len(place) else 0):
                        x = place == k
                        best[:, c[x]] = np.minimum(best[:, c[x]], (rows[:, None] - r[x]) ** 2 + z[x])
                # Rows of the tile, nearest first; those d away add d * d at least, so from the largest distance on none is lower.
                d = 1
                while d < h and d * d < best.max():
                    np.minimum(best[d:], g[:-d] + d * d, out=best[d:])
                    np.minimum(best[:-d], g[d:] + d * d, out=best[:-d])
                    d += 1
                rr, cc = np.mgrid[tr * tile : tr * tile + h, tc * tile : tc * tile + w]
                d = np.sqrt(best.ravel().astype(float))
                columns = [pa.array(rr.ravel(), pa.int32()), pa.array(cc.ravel(), pa.int32()), pa.array(d, pa.float64(), mask=best.ravel() >= _FAR)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "col", "distance"])

    return tiles.apart(whole.join(arriving, ["tr", "tc"]), n).mapInArrow(lowest, "row int, col int, distance double")
