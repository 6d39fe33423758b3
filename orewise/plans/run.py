"""A restartable run: stages as tables in the shared folder, with a manifest that tells which are still good.

A stage's digest covers its name, its settings and the content of every table that it reads. Its
table lies below that digest, and a manifest is written once the table is whole. A later run with the
same inputs reads finished stages; a stage that was lost, was cut short or whose input has changed
is made again, and so is what depends on a changed result. Nothing but these digests reaches the driver.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stage:
    """make(tables by name, settings) -> the stage's table; needs: the inputs and earlier stages that it reads."""

    name: str
    make: Callable[[dict[str, DataFrame], dict], DataFrame]
    needs: tuple[str, ...]
    settings: dict = field(default_factory=dict)


def content(df: DataFrame) -> str:
    """A digest of a table's columns and rows in any order, repeated ones too: one aggregate over two hashes of each row."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}) if df.columns else F.lit("")
    one, two = F.xxhash64(row).cast("decimal(38,0)"), F.xxhash64(row, F.lit(1)).cast("decimal(38,0)")
    found = df.agg(F.count("*"), F.sum(one), F.sum(two)).first()
    return hashlib.sha256(json.dumps([df.dtypes, *map(str, found)]).encode()).hexdigest()


class Run:
    """Runs stages in the folder; made lists those that this run made, read those that it found."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.made: list[str] = []
        self.read: list[str] = []

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def _done(self, stage: Stage, digest: str) -> dict | None:
        """The manifest's entry, if it and the table's files are there."""
        path = f"{self.folder}/manifest/{stage.name}-{digest}"
        if not self._exists(f"{path}/_SUCCESS") or not self._exists(f"{self.folder}/{stage.name}-{digest}/_SUCCESS"):
            return None
        entry = self.spark.read.schema("stage string, digest string, content string, rows long, schema string").json(path).first()
        table = self.spark.read.schema(entry.schema).parquet(f"{self.folder}/{stage.name}-{digest}")
        try:
            whole = table.count() == entry.rows
        except Exception as lost:  # a file that is gone; anything else is raised
            if "FILE_NOT_EXIST" not in str(lost) and "FileNotFound" not in str(lost):
                raise
            whole = False
        return {"table": table, "content": entry.content} if whole else None

    def _make(self, stage: Stage, digest: str, tables: dict[str, DataFrame]) -> dict:
        path = f"{self.folder}/{stage.name}-{digest}"
        df = stage.make(tables, stage.settings)
        df.write.mode("overwrite").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        entry = (stage.name, digest, content(table), table.count(), ", ".join(f"`{k}` {v}" for k, v in df.dtypes))
        self.spark.createDataFrame([entry], "stage string, digest string, content string, rows long, schema string").coalesce(1).write.mode("overwrite").json(f"{self.folder}/manifest/{stage.name}-{digest}")
        return {"table": table, "content": entry[2]}

    def __call__(self, stages: list[Stage], inputs: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """The tables of all stages by name; each stage comes after what it needs."""
        used = {k for s in stages for k in s.needs}
        state = {k: {"table": v, "content": content(v)} for k, v in inputs.items() if k in used}
        for stage in stages:
            own = {k: state[k] for k in stage.needs}
            key = json.dumps([stage.name, stage.settings, [[k, v["content"]] for k, v in own.items()]], sort_keys=True)
            digest = hashlib.sha256(key.encode()).hexdigest()[:24]
            found = self._done(stage, digest)
            (self.made if found is None else self.read).append(stage.name)
            state[stage.name] = found or self._make(stage, digest, {k: v["table"] for k, v in own.items()})
        return {s.name: state[s.name]["table"] for s in stages}


def site_stages(rows: int, cols: int, step: float = 1.0, block: int = 8, rounds: int = 5, folds: int = 3, methods: tuple[str, ...] = ("gbt",)) -> list[Stage]:
    """A site's run: inventory, sensor study with its errors and choice, recent scene, thermal stage, and one report of all objects.

    Inputs: px(row, col, label, dsm, dtm, bands), scene(row, col, bands) of a later date and
    thermal(scene_id, date, night, native_m, row, col, lst) on blocks of pixels.
    """
    from ..operators import modelling
    from ..operators.grid import sheet
    from . import inventory, port, stages

    grid = sheet(rows, cols, step)
    high = lambda px: px.withColumn("h", F.col("dsm") - F.col("dtm"))

    def study(t, s):
        px = modelling.spatial_folds(high(t["px"]).where("h is not null and label > 0"), grid).withColumn("fold", F.col("label") % s["folds"])
        return stages.sensor_study(px, port.BANDS, step * step, s["folds"], tuple(s["methods"]), s["rounds"])

    def choice(t, s):
        m = stages.study_metrics(t["study"])
        best = m.agg(F.min(F.struct("wape_pct", "method", "correction")).alias("b")).select("b.method", "b.correction", F.lit(True).alias("chosen"))
        return m.join(F.broadcast(best), ["method", "correction"], "left").fillna(False, ["chosen"])  # one row

    def recent(t, s):
        px = high(t["px"])
        model = modelling.fitted(px.where("label > 0 and h is not null"), port.BANDS, "h", s["rounds"])
        uav = t["inventory"].select("label", F.col("volume_m3").alias("uav"))
        return stages.recent_scene(px, t["scene"], model, lambda d: d, port.BANDS, uav, step * step, least=0.8)

    def report(t, s):
        best = t["study"].join(t["choice"].where("chosen").select("method", "correction"), ["method", "correction"])
        return (
            t["inventory"].select("label", "commodity", "volume_m3", "tonnage_t")
            .join(best.select("label", "predicted"), "label", "left")
            .join(t["recent"].select("label", "change", "estimate"), "label", "left")
            .join(t["thermal_stage"].select("label", "alert"), "label", "left")
        )

    return [
        Stage("inventory", lambda t, s: inventory.inventory(t["px"], grid), ("px",), {"grid": [rows, cols, step]}),
        Stage("study", study, ("px",), {"folds": folds, "methods": list(methods), "rounds": rounds}),
        Stage("choice", choice, ("study",)),
        Stage("recent", recent, ("px", "scene", "inventory"), {"rounds": rounds}),
        Stage("thermal_stage", lambda t, s: stages.thermal_stage(t["thermal"], t["px"].select("row", "col", "label"), s["block"], step, (rows, cols)), ("thermal", "px"), {"block": block}),
        Stage("report", report, ("inventory", "study", "choice", "recent", "thermal_stage")),
    ]
