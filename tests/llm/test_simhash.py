import random

import xxhash

from pyspark.sql import functions as F

from orewise.llm.components import connected_components
from orewise.llm.simhash import fingerprint, links, near_duplicates


def plain(text):
    words = (text or "").translate({k: k + 32 for k in range(65, 91)}).replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    """Least member reachable, by search over all pairs."""
    at = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a in range(len(fps)):
            for b in range(len(fps)):
                if (fps[a] ^ fps[b]).bit_count() <= 4 and at[a] > at[b]:
                    at[a], changed = at[b], True
    return at


def test_fingerprint_is_the_plain_one():
    for text in (None, "", " \n", "One", "one two THREE", "É Straße x y Z\n\nw " * 40, "a b c d", "ａ b c　d e"):
        assert fingerprint(text) == plain(text)
    assert fingerprint("a b c d e f g", block=2) == fingerprint("a b c d e f g")


def test_links_miss_no_pair(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {x for b in base for x in (b, *(b ^ sum(1 << k for k in rng.sample(range(64), n)) for n in (1, 2, 3, 4, 4, 5)))}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = {(r.a, r.b, r.distance) for r in links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {(a, b, (a ^ b & (1 << 64) - 1).bit_count()) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    assert {x[:2] for x in found} == {x[:2] for x in want}


def test_near_duplicates(spark):
    rng = random.Random(4)
    words = ["heap", "ore", "coal", "yard", "of", "the", "and", "lime"]
    texts = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    rows = []
    for t in texts:
        w = t.split(" ")
        rows += [t, t.upper(), " ".join(w[:60] + ["new"] + w[61:]), " ".join(w[:-1])]
    rows += ["", None, "  ", "one", "one"]
    docs = spark.createDataFrame([(k, x, "c") for k, x in enumerate(rows)], "doc_id long, text string, fp string")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert [got[k] for k in range(len(rows))] == groups([plain(x) for x in rows])


def test_ties_nulls_and_empty(spark):
    docs = spark.createDataFrame([(5, "a b"), (5, "a b"), (None, "a b"), (None, "lone words here")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == [(5, 5), (5, 5), (None, 5), (None, None)]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 200)] + [(7, 7), (300, 301), (301, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 200)}, 300: 300, 301: 300}
    assert connected_components(spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))).count() == 0


def test_probes_are_not_broadcast(spark, tmp_path):
    """A small table of fingerprints has 67 probes each: the driver must not gather them for a broadcast."""
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    plan = links(spark.read.parquet(f"{tmp_path}/fps"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
