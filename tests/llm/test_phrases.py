"""Phrase mining against plain counting, for any size of shard, and against exact fractions."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from orewise.llm.common import Scratch
from orewise.llm.phrases import Filter, bitmaps, collocations, frequent_phrases, phrase_counts

SCHEMA = "doc_id long, text string, lang string, n long, phrase string"


def counted(rows):
    out, sizes = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in (1, 2, 3):
                out.update((lang, " ".join(words[k : k + size])) for k in range(len(words) - size + 1))
    return out, sizes


def brute(rows, least, covered=50, top=2000):
    f, sizes = counted(rows)
    cands = {k: a for k, a in f.items() if " " in k[1] and a >= least}
    kept = []
    for (lang, phrase), a in cands.items():
        words = phrase.split(" ")
        longer = [x for (o, p), x in cands.items() if o == lang and len(p) > len(phrase) and f" {phrase} " in f" {p} "]
        if any(100 * x >= covered * a for x in longer):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = f[lang, " ".join(words[:k])], f[lang, " ".join(words[k:])]
            cuts.append((10**6 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        kept.append((lang, -score, -a, phrase.encode(), left, right))
    out = []
    for lang in sizes:
        own = sorted(x for x in kept if x[0] == lang)[:top]
        out += [(lang, k, p.decode(), -a, left, right, sizes[lang], -score) for k, (_, score, a, p, left, right) in enumerate(own, 1)]
    return sorted(out)


def made(seed, docs=40):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "d", "E-f", "g#", "h", "Ä"]
    rows = []
    for k in range(docs):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b"]) for _ in range(rng.randrange(90)))
        rows.append((k, text, rng.choice(["en", "en", "de", None, "und"]), 1, "x"))
    return rows + [(None, None, "en", 1, "x"), (1, "", "fr", 1, "x"), (1, " .,\n", "fr", 1, None), (2, "only once", "fr", 1, "x"), *rows[:2]]


@pytest.mark.parametrize("positions, least", [(1, 2), (64, 4), (1 << 20, 10)])
def test_equals_plain_counting(spark, positions, least):
    rows = made(positions)
    found = collocations(spark.createDataFrame(rows, SCHEMA), least, positions=positions)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, least)


def test_top_and_ties(spark):
    rows = [(k, " . ".join(f"x{j} y{j}" for j in range(30)), "en", 1, "") for k in range(10)]
    found = collocations(spark.createDataFrame(rows, SCHEMA), top=7)
    assert sorted(map(tuple, found.collect())) == brute(rows, 10, top=7)  # all scores are equal: phrases by their bytes
    assert found.count() == 7


def test_one_word_over_and_over(spark):
    rows = [(k, "da " * 500 + "end", "en", 1, "") for k in range(3)]
    assert sorted(map(tuple, collocations(spark.createDataFrame(rows, SCHEMA)).collect())) == brute(rows, 10)


def test_depth_first_ranges_of_any_size(spark):
    rows = made(5)
    docs = spark.createDataFrame(rows, SCHEMA).fillna({"text": "", "lang": "und"})
    found, _ = frequent_phrases(docs, Scratch(), least=2)
    want, _ = counted(rows)
    for length, table in enumerate(found, 1):
        assert {(r.lang, r.phrase): r.n for r in table.collect()} == {k: n for k, n in want.items() if n >= 2 and k[1].count(" ") == length - 1}
    shards, usual = bitmaps(docs), [Filter(t) for t in found[:2]]
    total = lambda entries: sorted(map(tuple, phrase_counts(shards, 3, usual, entries).groupBy("lang", "phrase").sum("n").collect()))
    assert total(1) == total(10**6)


def test_filter_loses_nothing(spark):
    import orewise.llm.phrases as p

    words = [f"w{k}" for k in range(500)]
    f = Filter(spark.createDataFrame([("en", w) for w in words], "lang string, phrase string"))
    assert f(p._word_hash("en", words)).all()
    assert np.mean(f(p._word_hash("de", words))) < 0.2


def test_nothing_frequent(spark):
    assert collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None, 1, ""), (2, "some words here", "en", 1, "")], SCHEMA)).count() == 0
