"""What the training-data operators share: tables, the shared work folder, cut lineage."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 100_000

_own: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only a local master may run without the setting; it then gets a folder of its own.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = _own.setdefault(spark.sparkContext.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="orewise-")
        _own[spark.sparkContext.applicationId] = top
    return top.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/orewise/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: later reads don't need the lineage."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Removes the files of a table made by written(), when nothing reads it any more."""
    spark = df.sparkSession
    for top in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(top)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables that are needed only until a later one is written; then clear() removes their files."""

    def __init__(self) -> None:
        self.tables: list[DataFrame] = []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(written(df, name))
        return self.tables[-1]

    def clear(self) -> None:
        while self.tables:
            dropped(self.tables.pop())


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has few rows, else as it is (Spark then shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def given_back(run):
    """run (for mapInArrow), but at a task's end the worker gives its free memory back to the system.

    Spark keeps workers for later tasks and stages, and all of them count beside the executor's JVM."""

    @functools.wraps(run)
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # other C libraries have no such call
            ctypes.CDLL(None).malloc_trim(0)

    return whole


def small_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 16) -> None:
    """Lowers the rows and bytes of an Arrow batch, in this session: texts are long, and both
    the JVM and the Python worker hold whole batches."""
    limits = {"maxRecordsPerBatch": (rows, ""), "maxBytesPerBatch": (megabytes << 20, "b")}
    for name, (most, unit) in limits.items():
        key = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(key).rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, f"{most}{unit}")
