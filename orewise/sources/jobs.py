"""Jobs, features and reports as rows: payloads, GeoJSON, JSON and CSV exports, run tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAYLOAD = "project_uuid string, stockpiles_geojson string, buildings_geojson string, aoi_geojson string, thermal_start string, thermal_end string, sensors array<string>"
#: The run tables that reports append to, by day of the run.
PILES = T.StructType(
    [T.StructField("run_ts", T.TimestampType()), *(T.StructField(c, T.StringType()) for c in ("project_uuid", "pile_id", "commodity", "alert"))]
    + [T.StructField(c, T.DoubleType()) for c in ("area_m2", "volume_m3", "tonnage_t")]
)


def payloads(messages: DataFrame) -> DataFrame:
    """messages(id, data base64) -> id, the payload's fields, error (null if it is a job): bad base64 or JSON is an error, not a failure."""
    text = F.try_to_binary("data", F.lit("base64")).cast("string")
    p = messages.select("id", F.from_json(text, PAYLOAD, {"mode": "PERMISSIVE"}).alias("p"), text.alias("text"))
    bad = (
        F.when(F.col("text").isNull(), "message is not base64")
        .when(F.col("p").isNull() | F.col("p.project_uuid").isNull(), "project_uuid is missing")
        .when(F.col("p.stockpiles_geojson").isNotNull() & F.get_json_object("p.stockpiles_geojson", "$.type").isNull(), "stockpiles_geojson is not GeoJSON")
        .when(F.col("p.thermal_start").isNotNull() & F.try_to_date("p.thermal_start").isNull(), "thermal_start is not a date")
        .when(F.try_to_date("p.thermal_start") > F.try_to_date("p.thermal_end"), "thermal_end is before thermal_start")
    )
    return p.select("id", "p.*", bad.alias("error"))


def window(centre: Column, start: Column, end: Column, days: int = 120) -> tuple[Column, Column]:
    """The thermal window: as given, else days around the survey."""
    return F.coalesce(start, F.date_sub(centre, days)), F.coalesce(end, F.date_add(centre, days))


def feature_collection(rows: DataFrame, geometry: str, properties: list[str]) -> DataFrame:
    """A GeoJSON feature per row, as JSON text; numbers that aren't finite are null."""
    finite = lambda c, t: F.when(~F.isnan(c) & (F.abs(F.col(c)) < float("inf")), F.col(c)).alias(c) if t in ("double", "float") else F.col(c)
    kinds = dict(rows.dtypes)
    props = F.struct(*[finite(c, kinds[c]) for c in properties])
    return rows.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.from_json(geometry, "type string, coordinates array<array<array<double>>>").alias("geometry"), props.alias("properties")), {"ignoreNullFields": "false"}).alias("feature"))


def flat(rows: DataFrame) -> DataFrame:
    """Complex columns as JSON text, for CSV."""
    return rows.select(*[F.to_json(c).alias(c) if t.startswith(("struct", "array", "map")) else F.col(c) for c, t in rows.dtypes])


def write_csv(rows: DataFrame, path: str) -> None:
    flat(rows).write.mode("overwrite").option("header", True).csv(path)


def write_run(rows: DataFrame, path: str) -> None:
    """Appends a run's rows to its table, partitioned by day."""
    rows.withColumn("run_day", F.to_date("run_ts")).write.mode("append").partitionBy("run_day").parquet(path)
