"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments. Two fingerprints at most ``distance`` bits apart
agree, in one segment at least, up to ``distance // segments`` bits; so each fingerprint
looks up the small Hamming ball around each of its segments in that segment's table, and
whole distances are checked in the join itself. No pair within the distance is missed.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, small_batches, written
from .components import connected_components

BITS = 64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, words: int = 4, seed: int = 42) -> np.ndarray:
    """XXH64 of each of the text's word shingles, repeats included; the whole sequence if it is shorter, none without a word."""
    data = b" ".join((text or "").encode().translate(_LOWER).split())
    if not data:
        return np.zeros(0, "<u8")
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(data)]))
    n = max(1, len(starts) - words + 1)
    last = ends[words - 1 :] if len(ends) >= words else ends[-1:]
    view, h = memoryview(data), xxhash.xxh64_intdigest
    return np.fromiter((h(view[a:b], seed) for a, b in zip(starts[:n].tolist(), last.tolist())), "<u8", n)


def simhash(hashes: np.ndarray, block: int = 65_536) -> int:
    """The bits that are set in over half of the hashes; 0 of none."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), block):
        ones += np.unpackbits(hashes[k : k + block].view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int = 4, seed: int = 42, block: int = 65_536) -> int:
    """SimHash of the text's word shingles, as an unsigned integer; 0 without any word."""
    return simhash(shingle_hashes(text, words, seed), block)


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fp long (the 64 bits as a signed number), a row for a row."""

    def run(batches):
        for batch in batches:
            out = [fingerprint(x.as_py(), words, seed) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(out, np.uint64).view(np.int64), pa.int64())], ["doc_id", "fp"]
            )

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _balls(distance: int, segments: int) -> tuple[list[tuple[int, int]], list[tuple[int, int, int]]]:
    """(shift, width) of each segment; (segment, shift, mask) of each flip to look up."""
    cuts = [BITS * k // segments for k in range(segments + 1)]
    spans = [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    flips = [
        (k, at, sum(1 << x for x in bits))
        for k, (at, width) in enumerate(spans)
        for r in range(distance // segments + 1)
        for bits in combinations(range(width), r)
    ]
    return spans, flips


def links(fps: DataFrame, distance: int = 4, segments: int = 3) -> DataFrame:
    """fps(fp long) of distinct, non-null values -> a, b, distance: all pairs at most so far apart, a < b."""
    spans, flips = _balls(distance, segments)
    assert all(width < 60 for _, width in spans), "a key holds the segment's number above its bits"
    part = lambda k: F.shiftrightunsigned("fp", spans[k][0]).bitwiseAND((1 << spans[k][1]) - 1)
    key = lambda k, x: x.bitwiseOR(F.lit(k << 60))
    tables = fps.select(F.col("fp").alias("a"), F.explode(F.array(*[key(k, part(k)) for k in range(segments)])).alias("key"))
    probes = fps.select(
        F.col("fp").alias("b"), F.explode(F.array(*[key(k, part(k).bitwiseXOR(F.lit(m))) for k, _, m in flips])).alias("key")
    )
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    # Merged, not broadcast: Spark takes the exploded probes for as small as fps are, and the driver would hold all of them.
    found = tables.join(probes.hint("merge"), (tables.key == probes.key) & (F.col("a") < F.col("b")) & (apart <= distance))
    return found.select("a", "b").distinct().withColumn("distance", apart.cast("int"))


def near_duplicates(docs: DataFrame, distance: int = 4, words: int = 4, segments: int = 3, seed: int = 42) -> DataFrame:
    """docs(doc_id, text) -> doc_id, fp, component_id: the least doc_id reachable over links.

    Texts with equal fingerprints are one class, so copies never make pairs: links join
    classes. Null and blank texts have fingerprint zero and link like any other. A repeated
    doc_id keeps its rows; a null doc_id is a member that never names a component (null if
    it has no other member). Other columns of docs are not read. An empty table gives none.
    """
    fps = written(fingerprints(docs, words, seed), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    nodes = connected_components(links(classes.select("fp"), distance, segments).select(F.col("a").alias("u"), F.col("b").alias("v")))
    # Only linked classes need their component's name; the others have their own.
    linked = written(classes.join(nodes, classes.fp == nodes.node).select("fp", "least", "component"), "linked")
    named = small(linked.groupBy("component").agg(F.min("least").alias("component_id")))
    names = linked.join(named, "component").select("fp", "component_id")
    by_class = classes.join(names, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    return fps.join(by_class, "fp").select("doc_id", "fp", "component_id")
