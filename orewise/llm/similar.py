"""Near-duplicates of a stated shingle similarity: SimHash links first, what they leave by prefix trees.

A 64-bit SimHash within a few bits finds nearly equal texts at once, however many there are;
texts of Jaccard similarity 0.8 are about ten bits apart, further than small Hamming balls
reach. So the links of multi-index hashing (checked on whole sets) make the first components,
and the prefix-tree join compares what is still apart. The result is that of all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, small_batches
from .prefixtree import joined, keyed, named, signatures
from .simhash import links


def hash_links(units: DataFrame, sets: DataFrame, percent: int, distance: int, segments: int, scratch: Scratch) -> DataFrame:
    """units(unit, fp), sets(unit, codes) -> u, v: links of similar sets whose fingerprints are at most so many bits apart.

    Of the units with a fingerprint one stands for all; each other meets it, and each of those the least
    linked one. So a unit is in two links at most as the greater: enough to start from.
    """
    able = units.join(sets.select("unit"), "unit", "left_semi")
    classes = scratch.written(able.groupBy("fp").agg(F.min("unit").alias("rep")), "classes")
    near = links(classes.select("fp"), distance, segments)
    ends = [classes.select(F.col("fp").alias(x), F.col("rep").alias(f"rep_{x}")) for x in "ab"]
    named_links = near.join(ends[0], "a").join(ends[1], "b").select(F.least("rep_a", "rep_b").alias("u"), F.greatest("rep_a", "rep_b").alias("v"))
    pairs = named_links.groupBy("v").agg(F.min("u").alias("u"))
    pairs = pairs.unionByName(able.join(classes, "fp").where("unit <> rep").select(F.col("rep").alias("u"), F.col("unit").alias("v")))
    one = sets.select(F.col("unit").alias("u"), F.col("codes").alias("of_u"))
    both = scratch.written(pairs, "hash-links").join(one, "u").join(sets.withColumnRenamed("unit", "v"), "v")
    common = F.size(F.array_intersect("of_u", "codes"))
    return both.where((100 + percent) * common >= percent * (F.size("of_u") + F.size("codes"))).select("u", "v")


def similar(docs: DataFrame, words: int = 5, percent: int = 80, distance: int = 4, segments: int = 3, seed: int = 42, scratch: Scratch | None = None) -> DataFrame:
    """docs(doc_id, text) -> doc_id, component_id: the least doc_id reachable over pairs of that similarity (per cent).

    doc_ids are unique and not null (a caller numbers its rows). Shingles are of lower-cased
    words (ASCII letters), fewer words being one shingle; texts without a word, null ones too,
    have equal, empty sets and are one component. Other columns aren't read. An empty
    table gives none. No similar pair is missed, and none that isn't similar is linked directly.
    scratch gets the tables that the result reads, for a caller to clear once it has written that.
    """
    scratch = scratch or Scratch()
    small_batches(docs.sparkSession)
    docs = keyed(docs)
    found = scratch.written(signatures(docs, words, seed, fingerprint=True), "signatures")
    known = lambda units, sets: hash_links(units, sets, percent, distance, segments, scratch)
    components = scratch.written(joined(docs, found, percent, words, seed, scratch, known), "components")
    names = named(found, components)
    blank = names.where("n_shingles = 0")
    least = blank.agg(F.min("doc_id").alias("component_id"))
    blank = blank.select("doc_id").crossJoin(F.broadcast(least))  # one row
    return names.where("n_shingles > 0").select("doc_id", "component_id").unionByName(blank)
