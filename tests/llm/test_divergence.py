"""Source divergence against its definition: each group meets each kept term, in plain Python."""

from collections import Counter, defaultdict

import pytest

from orewise.llm.divergence import divergence, term_counts

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string"


def brute(rows, least, top=10):
    import re

    docs = [((lang or ""), (source or ""), re.findall(r"[a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, *_ in rows]
    out = []
    for lang in {x for x, *_ in docs}:
        df = Counter(t for x, _, terms in docs if x == lang for t in set(terms))
        kept = {t for t, k in df.items() if k >= least}
        count = defaultdict(Counter)
        for x, source, terms in docs:
            if x == lang:
                count[source].update(t for t in terms if t in kept)
        every = sum(count.values(), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in count.items()}
        q = share(every)
        cost = lambda a, b: (a - b) ** 2 // (a + b)
        for s in count:
            pairs = sorted(((sum(cost(p[s][t], p[o][t]) for t in kept), o) for o in count if o != s), key=lambda x: (-x[0], x[1].encode()))
            terms = sorted(((cost(p[s][t], q[t]), t) for t in kept if count[s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:top]
            out += [(lang, s, part, item, value, k) for part, found in (("pair", pairs), ("term", terms)) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


ROWS = [
    (1, "The mill ground the corn. THE MILL", "en", "a", 1, "x"),
    (1, "the mill stood still; naïve Étude étude", "en", "b", 1, "x"),
    (2, "corn corn corn mill the", "en", "b", 1, None),
    (3, "the corn 12 34 --", "en", None, None, None),
    (None, "", "en", "empty", 1, "x"),
    (None, None, "en", "null", 1, "x"),
    (4, "la meunière dort", "fr", "a", 1, "x"),
    (5, "la meunière", None, "a", 1, "x"),
    (5, "la meunière", None, "a", 1, "x"),
    (6, "la meunière", None, "c", 1, "x"),
    (7, "das", "de", "a", 1, "x"),
    (8, None, "de", "b", 1, "x"),
]


@pytest.mark.parametrize("least", [1, 2, 3])
def test_equals_the_definition(spark, least):
    found = divergence(spark.createDataFrame(ROWS, SCHEMA), least)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(ROWS, least)


def test_partial_sums_of_any_size(spark):
    import orewise.llm.divergence as d

    docs = spark.createDataFrame(ROWS, SCHEMA).fillna("", ["text", "lang", "source"])
    total = lambda df: sorted(map(tuple, df.groupBy("lang", "source", "term").sum("n", "docs").collect()))
    assert total(d.term_counts(docs, 1)) == total(d.term_counts(docs))


def test_terms_beyond_the_tenth(spark):
    words = [f"w{chr(97 + k)}" for k in range(14)]
    rows = [(k, " ".join(words * (k % 3)), "en", f"s{k % 2}", 1, "") for k in range(6)] + [(9, "other " * 5, "en", "s2", 1, "")]
    found = divergence(spark.createDataFrame(rows, SCHEMA), 1)
    assert sorted(map(tuple, found.collect())) == brute(rows, 1)
    assert found.where("part = 'term'").agg({"rank": "max"}).first()[0] == 10


def test_no_rows(spark):
    assert divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_task_sums_before_it_tells(spark):
    """Two texts of the same 350,000 terms in one task: each term is told once."""
    term = "translate(cast(x as string), '0123456789', 'abcdefghij')"
    docs = spark.range(2).coalesce(1).selectExpr("'en' as lang", "'a' as source", f"array_join(transform(sequence(0, 349999), x -> {term}), ' ') as text")
    got = term_counts(docs).selectExpr("count(*) as rows", "sum(n) as n", "sum(docs) as docs").first()
    assert tuple(got) == (350_000, 700_000, 700_000)
