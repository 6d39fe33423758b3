"""The registered queries of the training-data operators, and SQL for those that have it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import encode
from .chat import rotate, rotate_sql
from . import pii
from .common import table
from .decontaminate import leaks
from .divergence import divergence, divergence_sql
from .licenses import scan, scan_sql
from .phrases import collocations, collocations_sql
from .prefixtree import similar_sets
from .quality import quality
from .quality_sql import quality_sql
from .repeats import without_repeats
from .sharding import bounded_ring
from .simhash import near_duplicates
from .warc import archived, payloads

WARC_SQL = """
WITH d AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND coalesce(page_id > least, least IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND coalesce(page_id > least, least IS NOT NULL) THEN least END AS refers_to
FROM f"""


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).withColumn("line_licenses", F.array_join("line_licenses", ","))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op3_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bounded_ring(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home_shard"
    )


def op4_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda x: F.concat_ws(":", x.start, x.end))
    return rotate(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payloads(archived(table(spark, sf_dir, "pages")))


def op6_latent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256")
    )


def _listed(spans) -> Column:
    kinds = F.array(*map(F.lit, pii.KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x.kind + 1), x.start, x.end)), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(spark))
    of_kind = lambda k: F.size(F.filter("base", lambda x: x.kind == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(pii.BASE)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_prefixtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def queries():
    each = (
        op1_licenses, op2_quality, op3_ring, op4_rotation, op5_warc, op6_latent, op7_bpe, op8_pii, op9_repeats, op10_simhash,
        op11_prefixtree, op12_phrases, op13_divergence,
    )
    return {f.__name__: f for f in each}


def oracle_sql() -> dict[str, str]:
    return {"op1_licenses": scan_sql(), "op4_rotation": rotate_sql(), "op5_warc": WARC_SQL, "op2_quality": quality_sql(), "op12_phrases": collocations_sql(), "op13_divergence": divergence_sql()}
