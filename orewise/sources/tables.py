"""Tables of the shared folder, and the ingest rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import known

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, which the driver and all executors share; only a local master may lack it."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = _own.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="orewise-"))
    return top.rstrip("/")


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else has."""
    return f"{shared_dir(spark)}/orewise/tables/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table of the shared folder, read back: its lineage ends here."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ingested(df: DataFrame) -> DataFrame:
    """NaN and infinities of float columns become null."""
    floats = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: known(F.col(c)) for c in floats}) if floats else df


def numbered(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Distinct, sortable keys numbered from 1 in their order, over many tasks.

    Keys are dealt by range; the counts of the ranges (a row each) give every range its first
    number, so no task sees all keys.
    """
    from pyspark.sql.window import Window

    ranged = written(keys.select(key).distinct().repartitionByRange(key).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    first = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(key))
    return ranged.join(F.broadcast(first), "_range").select(key, (within + F.col("_first")).cast("int").alias(out))
