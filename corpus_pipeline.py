"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, tokens.

Each stage takes (spark, docs, sf_dir), docs having the columns of the documents table, and
returns a DataFrame; run() writes each stage's result to the shared folder and gives what
was read back to the next. All stages but the last return the columns of docs, whose n_chars
they keep true to the text. A stage that drops rows numbers them first, in a table of its own,
and decides for each row by its own text: doc_ids may repeat or be null.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orewise.llm import pii
from orewise.llm.bpe import encode
from orewise.llm.common import Scratch, small, written
from orewise.llm.decontaminate import leaks
from orewise.llm.quality import passed
from orewise.llm.similar import similar


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """docs with a number of each row, written so that a number stays with its row; the number's column."""
    key = "row"
    while key in map(str.lower, docs.columns):
        key += "_"
    return written(docs.withColumn(key, F.monotonically_increasing_id()), name), key


def without(rows: DataFrame, key: str, gone: DataFrame, name: str) -> DataFrame:
    """rows but those whose numbers gone has, without the numbers. The rejected are looked up: they are the fewer."""
    gone = written(gone, name)
    return rows.join(small(gone), key, "left_anti").drop(key)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return passed(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, similarity 0.8) the row of least doc_id stays, a null one being the last.

    A row without a text (null) is no copy and stays.
    """
    rows, key = keyed(docs, "dedup-rows")
    scratch = Scratch()
    found = similar(rows.where("text is not null").select(F.col(key).alias("doc_id"), "text"), scratch=scratch)
    others = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias(key), "component_id"), "others")
    scratch.clear()
    members = others.unionByName(others.select(F.col("component_id").alias(key), "component_id").distinct())
    order = F.struct(F.col("doc_id").isNull(), "doc_id", key)
    least = members.join(rows.select(key, "doc_id"), key).groupBy("component_id").agg(F.min_by(key, order).alias(key)).select(key)
    return without(rows, key, members.select(key).join(least, key, "left_anti"), "copies").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows, key = keyed(docs, "decontamination-rows")
    found = leaks(rows.select(F.col(key).alias("doc_id"), "text"), benchmark)
    return without(rows, key, found.select(F.col("doc_id").alias(key)).distinct(), "leaks").select(docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the names of its kinds."""
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))  # so that no column of docs can clash
    found = pii.find(rows, pii.fit(spark))
    clean = found.select("row", pii.redact(F.col("text"), F.col("spans")).alias("clean"))
    new = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return clean.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, with a digest of what they decode to."""
    out = encode(docs, public_tokenizers.path("word_bpe_49k.json"), keep=False)
    return out.select("doc_id", "n_tokens", "ids", F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]

#: Fingerprint components, latent retrieval and fitted trees are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
