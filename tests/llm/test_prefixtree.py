"""The prefix-tree join against all pairs: tries of any edge, cells of any size, large groups around the threshold."""

import random
import re

import numpy as np
import pytest

from orewise.llm.prefixtree import Trie, linked, meeting, prefix, similar_sets

SCHEMA = "doc_id long, text string, component_id long, token string"


def root(up, x):
    while up[x] != x:
        x = up[x]
    return x


def plain_set(text, words=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    return frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute(rows, percent=85, words=4):
    sets = [plain_set(t, words) for _, t, *_ in rows]
    up = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                up[root(up, i)] = root(up, j)
    least = {}
    for k, (i, *_) in enumerate(rows):
        r = root(up, k)
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return sorted(((i, len(sets[k]), least[root(up, k)] if sets[k] else i) for k, (i, *_) in enumerate(rows)), key=str)


def varied(rng, text, share):
    return " ".join(f"v{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def groups(seed, docs=120):
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(50))
    base = [" ".join(f"b{g}x{rng.randrange(99)}" for _ in range(rng.choice([3, 8, 40, 300]))) for g in range(8)]
    rows = [(rng.randrange(10**6), varied(rng, rng.choice(base), rng.choice([0, 0.01, 0.03, 0.1])) + rng.choice(["", "", f" {passage}"])) for _ in range(docs)]
    rows += [(k, f"{passage} own{k} words{k} {' '.join(f'u{k}x{j}' for j in range(8))}") for k in range(20)]
    rows += [(None, rows[0][1]), (None, None), (5, None), (5, " \n"), (6, ""), (7, "one"), (8, "ONE"), (9, "one two\tthree"), (None, "only here is this text"), rows[1], rows[1]]
    return [(*r, 3, "x") for r in rows]


@pytest.mark.parametrize("percent, words, cell", [(85, 4, 2_000_000), (85, 4, 700), (80, 5, 60)])
def test_equals_all_pairs(spark, percent, words, cell, monkeypatch):
    monkeypatch.setattr("orewise.llm.prefixtree.FEW", 100_000 if cell != 700 else 5)
    rows = groups(percent + cell)
    found = similar_sets(spark.createDataFrame(rows, SCHEMA), percent, words, cell=cell)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, percent, words)


@pytest.mark.parametrize("cell", [2_000_000, 9_000])
def test_three_hundred_copies_around_the_threshold(spark, cell):
    rng = random.Random(11)
    base = " ".join(f"w{rng.randrange(10**5)}" for _ in range(200))
    rows = [(k, varied(rng, base, 0.022), 0, "") for k in range(300)]
    found = similar_sets(spark.createDataFrame(rows, SCHEMA), 80, 5, cell=cell)
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows, 80, 5)


def test_components_with_and_without_rounds(spark):
    from orewise.llm.components import connected_components

    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(7, 7), (900, 901), (901, 900)]
    df = spark.createDataFrame(edges, "u long, v long")
    one, many = ({r.node: r.component for r in connected_components(df, few=few).collect()} for few in (1000, 10))
    assert one == many and connected_components(df.limit(0), few=5).count() == 0


def test_order_of_frequent_shingles(spark):
    """Results don't depend on what counts as frequent."""
    import orewise.llm.prefixtree as p

    rows = groups(3, 60)
    docs = p.keyed(spark.createDataFrame(rows, SCHEMA))
    found = p.signatures(docs, 4, 42, counted=50, reported=2)
    assert found.where("shingle is not null").count()
    parts = p.Scratch()
    names = p.named(found, p.joined(docs, parts.written(found, "signatures"), 85, 4, 42, parts))
    assert sorted(map(tuple, names.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("edge", [1, 3, 32])
def test_tries_of_any_edge(edge, monkeypatch):
    rng = random.Random(edge)
    monkeypatch.setattr(Trie.__init__, "__defaults__", (edge,))
    for trial in range(150):
        base = [rng.sample(range(200), rng.randrange(1, 60)) for _ in range(5)]
        sets = []
        for _ in range(rng.randrange(2, 40)):
            b = set(rng.choice(base))
            for _ in range(rng.randrange(4)):
                b ^= {rng.randrange(200)}
            sets.append(np.array(sorted(b or {1}), np.uint64))
        n, percent = len(sets), rng.choice([50, 80, 85])
        label = np.array([rng.randrange(n) for _ in range(n)]) if trial % 3 else np.arange(n)
        side = np.array([rng.random() < 0.5 for _ in range(n)]) if trial % 2 else None
        want = list(range(n))
        for i in range(n):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if label[i] == label[j] or (side is None or side[i] != side[j]) and 100 * len(a & b) >= percent * len(a | b):
                    want[root(want, i)] = root(want, j)
        got = list(range(n))
        for i in range(n):
            for j in range(i):
                if label[i] == label[j]:
                    got[root(got, i)] = root(got, j)
        for i, j in linked(sets, label.copy(), percent, side):
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert 100 * len(a & b) >= percent * len(a | b)
            got[root(got, i)] = root(got, j)
        same = lambda up: [[root(up, x) == root(up, y) for y in range(n)] for x in range(n)]
        assert same(got) == same(want)


def test_prefixes_of_similar_sets_meet():
    rng = random.Random(4)
    for _ in range(4000):
        percent, n = rng.choice([60, 80, 85, 100]), rng.randrange(1, 120)
        a = set(rng.sample(range(10**6), n))
        b = set(rng.sample(sorted(a), max(1, n - rng.randrange(1 + n // 6)))) | set(rng.sample(range(10**6), rng.randrange(1 + n // 6)))
        if 100 * len(a & b) >= percent * len(a | b):
            first = [sorted(x)[: prefix(len(x), percent)] for x in (a, b)]
            shared = len(set(first[0]) & set(first[1]))
            assert shared >= meeting(min(len(a), len(b)))
            assert all(shared >= meeting(-(-percent * len(x) // 100)) for x in (a, b))


def test_no_rows(spark):
    assert similar_sets(spark.createDataFrame([], SCHEMA)).count() == 0
