import random

import numpy as np
import zstandard
from pyspark.sql import functions as F

from orewise.llm.repeats import Block, _repeating, brute_force, without_repeats


def run(spark, rows, **sizes):
    docs = spark.createDataFrame([(*x, "own") for x in rows], "doc_id long, text string, block string").repartition(3)
    out = without_repeats(docs, **sizes).withColumn("kept", F.sha2("kept", 256))
    return sorted(map(tuple, out.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    words = ["ab", "the", "é", "stone", "x", "yard", "heap", "of"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(30) for _ in range(4)]
    rows = [(k, text(rng.randrange(60)) + rng.choice(passages) + text(rng.randrange(60)) + rng.choice(["", *passages])) for k in range(60)]
    rows += [(7, rows[3][1]), (100, rows[3][1]), (None, rows[5][1]), (None, rows[5][1]), (101, None), (102, ""), (103, "z" * 400), (104, "z" * 49), (105, "z" * 60), (-3, "z" * 51)]
    rows += [(200 + k, rows[8][1]) for k in range(30)]
    for sizes in ({}, {"block_bytes": 900, "bucket_bytes": 2000}, {"block_bytes": 900, "bucket_bytes": 2000, "hot_blocks": 1}):
        assert run(spark, rows, **sizes) == sorted(brute_force(rows), key=str)


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert run(spark, rows, block_bytes=50_000, bucket_bytes=100_000) == sorted(brute_force(rows), key=str)


def test_empty(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_hot_gram_is_spread():
    """One line in every block, with other surroundings each time: no bucket gets the entries of them all."""
    rng = random.Random(1)
    line = "this line of forty bytes stands everywhere"
    around = lambda: "".join(rng.choices("abcdefghijklmnop ", k=60))
    texts = [(around() + line + around()).encode() for _ in range(400)]
    blocks = [Block(np.array([k]).tobytes(), np.array([len(t)]).tobytes(), zstandard.compress(t)) for k, t in enumerate(texts)]
    buckets = 1024

    def most(hot_blocks):
        asked, sizes = [dict(b.sample(buckets)) for b in blocks], np.zeros(buckets, int)
        told = [{} for _ in blocks]
        for bucket in range(buckets):
            mine = [k for k, x in enumerate(asked) if bucket in x]
            for k, bits in zip(mine, _repeating([asked[k][bucket] for k in mine], hot_blocks)):
                told[k][bucket] = bits
        for b, x in zip(blocks, told):
            b.entries(buckets, x)
            for bucket, _, counts, *_ in b.questions():
                sizes[bucket] += len(counts)
        return sizes.max(), sizes.sum()

    plain, spread = most(10_000), most(100)
    assert plain[0] > 200  # the entries of the gram chosen in most blocks, all in one bucket
    assert spread[0] <= 110 and spread[1] > 5 * plain[1]  # a gram of up to 100 blocks stays together
