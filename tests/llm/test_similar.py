"""Near-duplicates of five words and similarity 0.8 against all pairs."""

import random
from collections import Counter

import numpy as np
import pytest

from orewise.llm.similar import similar
from orewise.llm.simhash import shingle_hashes


def components(rows, least=0.8):
    """doc_id -> least doc_id reachable, by all pairs."""
    sets = {d: frozenset(shingle_hashes(t, 5).tolist()) for d, t in rows}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            one, two = sets[a], sets[b]
            if one == two or len(one & two) >= least * len(one | two):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def changed(rng, words, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.randrange(10**6)}"
    return out


def run(spark, rows, **how):
    docs = spark.createDataFrame([(*x, "own") for x in rows], "doc_id long, text string, digest string").repartition(3)
    return {r.doc_id: r.component_id for r in similar(docs, **how).collect()}


def test_near_copies(spark):
    """Copies with so many words changed that similarity is above and below 0.8; chains, copies, blanks and short texts."""
    rng, rows = random.Random(8), []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([40, 100, 300]))]
        rows.append(" ".join(words))
        for share in (0.005, 0.015, 0.02, 0.03):
            rows.append(" ".join(changed(rng, words, max(1, int(len(words) * share)))))
        rows.append("  ".join(words).upper())
        for _ in range(5):  # a chain
            words = changed(rng, words, max(1, len(words) // 80))
            rows.append(" ".join(words))
    rows += ["", " \n", None, "one two", "One  TWO", "one two three", "a " * 500, "a " * 700]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    assert run(spark, rows) == components(rows)


def test_table_recall(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert run(spark, rows) == components(rows)


@pytest.mark.parametrize("share", [0.012, 0.022])
def test_hundreds_of_copies_around_the_threshold(spark, share):
    """300 copies of one text, each with so many words changed: similarities lie around 0.8 (many below it at 0.022)."""
    rng = random.Random(7)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(f"n{rng.randrange(10**6)}" if rng.random() < share else w for w in words)) for k in range(300)]
    assert run(spark, rows) == components(rows)


def test_three_thousand_copies_around_the_threshold(spark):
    """All pairs by a product of incidence matrices; whatever is linked there is linked here."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    rows = [(k, " ".join(f"n{rng.randrange(10**6)}" if rng.random() < 0.024 else w for w in words)) for k in range(3000)]
    sets = [set(shingle_hashes(t, 5).tolist()) for _, t in rows]
    often = Counter(h for s in sets for h in s)
    usual = {h: n for n, h in enumerate(h for h, k in often.items() if k > 1)}
    held = np.zeros((len(rows), len(usual)), np.float32)
    for k, s in enumerate(sets):
        held[k, [usual[h] for h in s if h in usual]] = 1
    both, size = held @ held.T, np.array([len(s) for s in sets])
    near = both * 180 >= 80 * (size[:, None] + size[None])
    np.fill_diagonal(near, True)
    label = np.arange(len(rows))
    while True:
        new = np.where(near, label, len(rows)).min(1)
        if (new == label).all():
            break
        label = new
    assert len(set(label)) > 300  # many stay alone
    assert run(spark, rows) == dict(enumerate(label.tolist()))


def test_empty(spark):
    assert similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0
