"""Connected objects of a mask: labels within tiles, then merged across their seams."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import numbered, written
from . import tiles

TILE = 256


def _tile_labels(mask: np.ndarray, eight: bool) -> np.ndarray:
    """Least raster index of each set pixel's component, by sweeps in both directions until nothing changes."""
    h, w = mask.shape
    big = h * w
    lab = np.where(mask, np.arange(big).reshape(h, w), big)
    steps = [(0, 1), (1, 0), (1, 1), (1, -1)] if eight else [(0, 1), (1, 0)]
    while True:
        before = lab.copy()
        for dr, dc in steps:
            a = lab[: h - dr, max(0, -dc) : w - max(0, dc)]
            b = lab[dr:, max(0, dc) : w - max(0, -dc)]
            both = np.where((a < big) & (b < big), np.minimum(a, b), big)
            np.minimum(a, both, out=a)
            np.minimum(b, both, out=b)
        root = np.append(lab.ravel(), big)  # pointer jumping: a label is a pixel, which has one too
        lab = np.where(mask, root[np.minimum(lab, big)], big)
        if np.array_equal(lab, before):
            return lab


def merged(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """edges(u, v) -> node, root: least node reachable; each round is written, so plans stay short."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        star = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        now = written(star.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct())
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    raise RuntimeError("components did not settle")


def label_tiles(mask: DataFrame, width: int, eight: bool = True, tile: int = TILE) -> DataFrame:
    """mask(row, col) of set pixels, or its tiles (tiles.packed) -> tr, tc, index, labels.

    Components are numbered from 1 in raster order. index holds each pixel's place in the tile's labels, from 1 (0: unset); see placed().
    What is joined are the parts of components in tiles and pixels on seams, never all pixels.
    """
    packed = written(mask if "bits" in mask.columns else tiles.packed(mask, tile))
    n = packed.count()

    def local(batches):
        for batch in batches:
            for row in batch.to_pylist():
                r0, c0 = row["tr"] * tile, row["tc"] * tile
                a = tiles.unpacked(row["bits"], tile)
                root = _tile_labels(a, eight)
                nodes = np.unique(root[a])
                index = np.where(a, np.searchsorted(nodes, root) + 1, 0).astype(np.int32)
                nodes = (nodes // tile + r0) * width + nodes % tile + c0
                a[1:-1, 1:-1] = False
                r, c = np.nonzero(a)
                edge = [{"row": y, "col": x, "node": z} for y, x, z in zip((r + r0).tolist(), (c + c0).tolist(), nodes[index[r, c] - 1].tolist())]
                yield pa.RecordBatch.from_pylist([{"tr": row["tr"], "tc": row["tc"], "index": zlib.compress(index.tobytes(), 1), "nodes": nodes.tolist(), "edge": edge}], pa.schema(kinds))

    kinds = [("tr", pa.int32()), ("tc", pa.int32()), ("index", pa.binary()), ("nodes", pa.list_(pa.int64())), ("edge", pa.list_(pa.struct([("row", pa.int32()), ("col", pa.int32()), ("node", pa.int64())])))]
    own = written(tiles.apart(packed, n).mapInArrow(local, "tr int, tc int, index binary, nodes array<long>, edge array<struct<row: int, col: int, node: long>>"))
    # Neighbours across a seam: only border pixels meet.
    border = own.select(F.explode("edge").alias("e")).select("e.*")
    steps = [(0, 1), (1, 0), (1, 1), (1, -1)] if eight else [(0, 1), (1, 0)]
    moved = border.withColumn("s", F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in steps])))
    moved = moved.select((F.col("row") + F.col("s.r")).alias("row"), (F.col("col") + F.col("s.c")).alias("col"), F.col("node").alias("u"))
    seams = moved.join(border.withColumnRenamed("node", "v"), ["row", "col"]).where("u <> v").select("u", "v").distinct()
    parts = own.select("tr", "tc", F.posexplode("nodes").alias("place", "node")).join(merged(seams), "node", "left")
    parts = written(parts.select("tr", "tc", "place", F.coalesce("root", "node").alias("node")))
    named = parts.join(numbered(parts, "node", "label"), "node").groupBy("tr", "tc").agg(F.array_sort(F.collect_list(F.struct("place", "label"))).alias("named"))
    out = own.select("tr", "tc", "index").join(named.select("tr", "tc", F.col("named.label").alias("labels")), ["tr", "tc"])
    return tiles.apart(out, n)


def placed(index: bytes, labels: list[int], tile: int = TILE) -> np.ndarray:
    """Labels of a tile's pixels, 0 for unset ones."""
    return np.append(0, labels).astype(np.int32)[np.frombuffer(zlib.decompress(index), np.int32)].reshape(tile, tile)


def labelled(mask: DataFrame, width: int, eight: bool = True, tile: int = TILE) -> DataFrame:
    """mask of set pixels (as label_tiles takes it) -> row, col, label: components numbered from 1 in raster order."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = placed(row["index"], row["labels"], tile)
                r, c = np.nonzero(a)
                columns = (r + row["tr"] * tile, c + row["tc"] * tile, a[r, c])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()) for x in columns], ["row", "col", "label"])

    return label_tiles(mask, width, eight, tile).mapInArrow(run, "row int, col int, label int")


def inside(px: DataFrame, labels: DataFrame, n: int, tile: int = TILE) -> DataFrame:
    """px(row, col, ...) -> its rows within objects, with label: pixels meet the labels (label_tiles) of their tile, one of n."""
    rows = px.withColumns({"tr": F.floor(F.col("row") / tile).cast("int"), "tc": F.floor(F.col("col") / tile).cast("int")})

    def run(own: pa.Table, objects: pa.Table) -> pa.Table:
        if not objects.num_rows:
            return own.slice(0, 0).drop_columns(["tr", "tc"]).append_column("label", pa.array([], pa.int32()))
        a = placed(objects.column("index")[0].as_py(), objects.column("labels")[0].as_py(), tile)
        row, col = (own.column(k).to_numpy() % tile for k in ("row", "col"))
        return own.drop_columns(["tr", "tc"]).append_column("label", pa.array(a[row, col], pa.int32())).filter(pa.array(a[row, col] > 0))

    schema = ", ".join([*(f"`{k}` {t}" for k, t in px.dtypes), "label int"])
    deal = lambda df: tiles.apart(df, n).groupBy("tr", "tc")
    return deal(rows.where("tr is not null and tc is not null")).cogroup(deal(labels)).applyInArrow(run, schema)
