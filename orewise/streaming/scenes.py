"""Structured Streaming over scene observations: late data, one hit per object and date, running persistence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def arrivals(spark: SparkSession, folder: str, schema: str, files: int = 4) -> DataFrame:
    """Observations as files of a folder arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def once_per_date(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """stream(label, ts, ...) -> the first observation of each object and date; later ones within the watermark are dropped."""
    return stream.withColumn("date", F.to_date("ts")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["label", "date"])


def daily(stream: DataFrame, late: str = "2 days", window: str = "1 day") -> DataFrame:
    """Counts and extremes by window and object, emitted when the watermark has passed them."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", window), "label").agg(F.count("*").alias("n"), F.max("lst").alias("top"))


def persistence(stream: DataFrame, threshold: float) -> DataFrame:
    """Running share of hot observations by object, for update or complete mode."""
    hot = (F.col("lst") > threshold).cast("double")
    return stream.groupBy("label").agg(F.count("*").alias("n"), F.sum(hot).alias("hot"), F.avg(hot).alias("share"))


def into_table(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Appends each batch to a Parquet table once, by its batch number."""

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
