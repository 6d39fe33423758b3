"""Source divergence audit: how far the sources of a language differ in their words, and by which.

Each group (lang, source) gives every kept term a smoothed share p in whole billionths; two
groups are as far apart as the sum over all kept terms of (p - q)^2 / (p + q), floored term by
term. That sum never visits the terms that neither group has: by inclusion and exclusion over the
groups' supports it is

    what all terms of g cost against h's share of an absent term     (histogram of g's counts)
  + the same with g and h exchanged                                  (histogram of h's counts)
  + for terms in both, the true cost less those two                  (sparse join of postings)
  + the terms in neither, times one constant.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import small, small_batches, written

#: A language keeps the terms that so many of its documents have.
LEAST_DOCS = 10
#: Ranks of the part `term`.
TOP = 10
#: Distinct (group, term) entries that a worker holds before it hands its sums on.
ENTRIES = 700_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: In UTF-8 every byte of a character beyond ASCII is 0x80 at least, so terms can be cut in bytes.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def term_counts(docs: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """docs(lang, source, text), no nulls -> lang, source, term, n, docs: partial sums of occurrences and documents."""

    def rows(sums: dict):
        """A batch for each group, which goes once it is told."""
        while sums:
            (lang, source), (n, d) = sums.popitem()
            terms = list(n)
            columns = [
                pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(n.values(), pa.int64(), size=len(terms)), pa.array(map(d.__getitem__, terms), pa.int64(), size=len(terms)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def run(batches):
        sums: dict = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
                terms = _TERM.findall(text.encode().translate(_LOWER))
                if terms:
                    n, d = sums.setdefault((lang, source), (Counter(), Counter()))
                    size -= len(n)
                    n.update(terms)
                    d.update(set(terms))
                    size += len(n)
                    if size > entries:
                        yield from rows(sums)
                        size = 0
        yield from rows(sums)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")


def _share(n: str) -> Column:
    """The smoothed share of a term that occurs n times, exactly: products go through decimals."""
    return F.expr(f"1 + (1000000000BD * ({n} + 2)) div (total + 2 * kept)")


def _cost(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """docs(text, lang, source) -> lang, source, part, item, value long, rank int.

    Part `pair`: item is each other source of the lang, value their distance. Part `term`: the
    terms that the source uses more than its lang does, by what they add to the distance
    between the two, the first `top`. Ranks count from 1 for each group and part, by value
    descending, then item. A null text, lang or source is ''. A group without terms counts like
    any other; with no term kept, values of pairs are 0. Repeated rows count as often as
    they are there. An empty table gives none. Other columns aren't read. A worker holds one
    text and ENTRIES sums; a longer text is held whole.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    sums = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = written(sums, "term-counts")
    every = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = written(every.where(F.col("docs") >= least_docs).select("lang", "term", "n"), "kept-terms")
    langs = small(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("all")))

    held = counts.join(kept.select("lang", "term", F.col("n").alias("n_lang")), ["lang", "term"])
    held = written(held.select("lang", "source", "term", "n", "n_lang"), "postings")
    own = held.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = written(groups.fillna(0).withColumn("zero", F.when(F.col("kept") > 0, _share("0")).otherwise(F.lit(1))), "groups")

    # Each posting with its share, the share of an absent term of its group, and its lang's share.
    of_lang = F.expr("1 + (1000000000BD * (n_lang + 2)) div (`all` + 2 * kept)")
    shares = held.join(small(groups), ["lang", "source"]).select("lang", "source", "term", "n", "zero", _share("n").alias("p"), of_lang.alias("q"))

    # What a group's terms cost against another's constant: a row for each count that the group has.
    heights = shares.groupBy("lang", "source", "n", "p").agg(F.count("*").alias("times"))
    other = groups.select("lang", F.col("source").alias("to"), F.col("zero").alias("z"))
    sided = heights.join(small(other), "lang").where("source <> to")
    sided = sided.select("lang", F.least("source", "to").alias("a"), F.greatest("source", "to").alias("b"), (F.col("times") * _cost("p", "z")).alias("part"), F.lit(0).alias("shared"))
    # Terms in both supports: the true cost in place of the two that were counted.
    left = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("zero").alias("za"))
    right = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("zero").alias("zb"))
    both = left.join(right, ["lang", "term"]).where("a < b")
    both = both.select("lang", "a", "b", (_cost("pa", "pb") - _cost("pa", "zb") - _cost("za", "pb")).alias("part"), F.lit(1).alias("shared"))
    found = sided.unionByName(both).groupBy("lang", "a", "b").agg(F.sum("part").alias("part"), F.sum("shared").alias("shared"))

    ga = groups.select("lang", "kept", F.col("source").alias("a"), F.col("terms").alias("na"), F.col("zero").alias("za"))
    gb = groups.select("lang", F.col("source").alias("b"), F.col("terms").alias("nb"), F.col("zero").alias("zb"))
    pairs = ga.join(small(gb), "lang").where("a < b").join(found, ["lang", "a", "b"], "left").fillna(0, ["part", "shared"])
    neither = F.expr("kept - na - nb + shared")
    value = F.when(F.col("kept") > 0, F.col("part") + neither * _cost("za", "zb")).otherwise(F.lit(0))
    ends = F.explode(F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")]))
    pairs = pairs.select("lang", value.cast("long").alias("value"), ends.alias("e")).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")

    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _cost("p", "q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(above).where(F.col("rank") <= top))


def divergence_sql(least_docs: int = LEAST_DOCS, top: int = TOP) -> str:
    """DuckDB SQL over documents for divergence(): every group meets every kept term, absent ones too."""
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT id) >= {least_docs}),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY 1),
own AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM own GROUP BY 1, 2),
g AS (SELECT DISTINCT lang, source FROM d),
shares AS (SELECT g.lang, g.source, kept.term, coalesce(own.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(own.n, 0) + 2)) // (coalesce(sums.total, 0) + 2 * v) AS p,
    1 + (1000000000::HUGEINT * (kept.n + 2)) // (size.total + 2 * v) AS q
  FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = kept.term LEFT JOIN sums ON sums.lang = g.lang AND sums.source = g.source),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM pairs
UNION ALL
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INT AS rank FROM terms) WHERE rank <= {top}"""
