"""Phrase collocations by compressed position bitmaps: shift, AND, popcount, depth-first.

A shard is a run of one language's texts laid out on a line: a position for each word and an
empty one between pieces. Each of its words has a bitmap of its positions, of which only the
non-zero bytes are stored, with the gaps between them. A phrase's bitmap is shifted by one and
ANDed with the words' bitmaps; what is left are the ends of the longer phrase, and as the
position after a piece is empty, no phrase leaves its piece. Phrases grow depth-first from a range of
first words at a time. Counts are popcounts, summed over the shards.

Between two lengths the sums tell which phrases are frequent; only these are extended. Shards learn
them from a bit filter of stated size: a bit too many costs work and never changes a count.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, small_batches

#: Words and gaps of a shard; it is closed after the text that fills it.
POSITIONS = 1 << 20
#: Bitmap bytes that are extended at a time.
ENTRIES = 50_000
#: Bits of the filter for each frequent phrase, and the most it may have (128 MB in each worker).
FILTER_PER_ITEM, FILTER_MOST = 16, 1 << 30
_BLOCK = 1 << 16
#: A candidate's least count, and the longest phrases.
LEAST, LONGEST = 10, 3
#: A phrase goes if a longer one has this share (per cent) of its occurrences.
COVERED = 50
TOP = 2_000
#: Parts that a language's candidates are first ranked in.
RANK_PARTS = 64

#: A-Z become a-z, a tab a space, and [.,;:!?\x0A-\x0D] a line feed.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b"\t.,;:!?\x0b\x0c\r", bytes(range(97, 123)) + b" \n\n\n\n\n\n\n\n\n")
_BITMAPS = "lang string, words array<string>, ones array<int>, bytes array<int>, gaps binary, bits binary"


def _packed(words: list[bytes], line: list[int], lang: str) -> pa.RecordBatch:
    """A shard as a row: its words, their popcounts, and their bitmaps' non-zero bytes with the gaps before them."""
    line = np.array(line, np.int64)
    at = np.flatnonzero(line >= 0)
    order = np.argsort(line[at], kind="stable")
    at, word = at[order], line[at][order]
    key = word << 32 | at >> 3
    first = np.flatnonzero(np.diff(key, prepend=-1))
    bits = np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), first)
    owner, block = key[first] >> 32, key[first] & 0xFFFFFFFF
    gaps = np.where(np.diff(owner, prepend=-1) != 0, block, np.diff(block, prepend=0)).astype("<u4")
    planes = gaps.view(np.uint8).reshape(-1, 4).T.tobytes()  # high bytes are mostly zero
    n = len(words)
    whole = lambda x: pa.array([x.astype(np.int32)], pa.list_(pa.int32()))
    columns = [pa.array([lang]), pa.array([[w.decode() for w in words]], pa.list_(pa.string())), whole(np.bincount(word, minlength=n)), whole(np.bincount(owner, minlength=n))]
    columns += [pa.array([zlib.compress(planes, 1)], pa.binary()), pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "ones", "bytes", "gaps", "bits"])


def bitmaps(docs: DataFrame, positions: int = POSITIONS) -> DataFrame:
    """docs(lang, text), no nulls -> a row for each shard; a text is never split over two."""

    def run(batches):
        new = lambda: (defaultdict(count().__next__), [])
        own: dict = defaultdict(new)

        def closed():
            for lang, (ids, line) in own.items():
                if ids:
                    yield _packed(list(ids), line, lang)
            own.clear()

        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids, line = own[lang]
                for piece in text.encode().translate(_PLAIN).split(b"\n"):
                    if words := piece.split():
                        line.extend(map(ids.__getitem__, words))
                        line.append(-1)
                if sum(len(x) for _, x in own.values()) >= positions:
                    yield from closed()
        yield from closed()

    return docs.select("lang", "text").mapInArrow(run, _BITMAPS)


def _word_hash(lang: str, words: list[str]) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    lead = lang.encode() + b"\x00"
    return np.fromiter((h(lead + w.encode()) for w in words), np.uint64, len(words))


def _joined(h: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a phrase with another word."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + more
    return h ^ (h >> np.uint64(32))


class Filter:
    """Which hashes may be those of frequent phrases: a bit for each slot, built in blocks by tasks."""

    def __init__(self, frequent: DataFrame):
        """frequent(lang, phrase), written."""
        n = frequent.count()
        self.log = min(max((FILTER_PER_ITEM * n - 1).bit_length(), 16), FILTER_MOST.bit_length() - 1)
        log = self.log

        def slots(batches):
            for batch in batches:
                out = []
                for lang, phrase in zip(*(c.to_pylist() for c in batch.columns)):
                    each = _word_hash(lang, phrase.split(" "))
                    h = each[:1]
                    for k in range(1, len(each)):
                        h = _joined(h, each[k : k + 1])
                    out.append(int(h[0]) >> (64 - log))
                out = np.array(out, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(out // _BLOCK), pa.array((out % _BLOCK).astype(np.int32))], ["block", "slot"])

        def block(table: pa.Table) -> pa.Table:
            bits = np.zeros(_BLOCK, bool)
            bits[table.column("slot").to_numpy()] = True
            return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        found = frequent.select("lang", "phrase").mapInArrow(slots, "block long, slot int").distinct().groupBy("block").applyInArrow(block, "block long, bits binary")
        bits = np.zeros(1 << log >> 3, np.uint8)
        for r in found.toLocalIterator():  # 8 kB each
            bits[r.block * _BLOCK // 8 : (r.block + 1) * _BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
        self.shared = frequent.sparkSession.sparkContext.broadcast(bits)

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = h >> np.uint64(64 - self.log)
        return (self.shared.value[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 != 0

    def __getstate__(self):
        return {"log": self.log, "shared": self.shared}


class _Shard:
    """A shard's bitmaps of words that may be frequent, unpacked: owner, block and bits of each byte."""

    def __init__(self, row: dict, usual: Filter):
        h = _word_hash(row["lang"], row["words"])
        alive = usual(h)
        n = np.array(row["bytes"], np.int64)
        gaps = np.ascontiguousarray(np.frombuffer(zlib.decompress(row["gaps"]), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
        run = np.cumsum(gaps)
        start = np.cumsum(n) - n
        block = run - np.repeat(run[start] - gaps[start], n)
        own = np.repeat(alive, n)
        self.hash, self.block = h, block[own]
        self.bits = np.frombuffer(zlib.decompress(row["bits"]), np.uint8)[own]
        self.owner = np.repeat(np.arange(len(n)), n)[own]
        order = np.argsort(self.block, kind="stable")
        self.by_block = self.owner[order], self.bits[order]
        size = int(self.block.max()) + 3 if len(self.block) else 2
        per = np.bincount(self.block, minlength=size)
        self.starts, self.per = np.cumsum(per) - per, per

    def extended(self, phrase: np.ndarray, block: np.ndarray, bits: np.ndarray):
        """Bitmaps of phrases -> those of every phrase with one more word: phrase, word, block, bits of non-zero bytes."""
        up, over = (bits << 1) & 255, bits >> 7  # a byte's highest position moves on to the next byte
        a, b = np.flatnonzero(up), np.flatnonzero(over)
        phrase, block, bits = np.concatenate((phrase[a], phrase[b])), np.concatenate((block[a], block[b] + 1)), np.concatenate((up[a], over[b]))
        n = self.per[block]
        left = np.repeat(np.arange(len(n)), n)
        right = np.arange(len(left)) + np.repeat(self.starts[block] - (np.cumsum(n) - n), n)
        both = bits[left] & self.by_block[1][right]
        hit = np.flatnonzero(both)
        left = left[hit]
        return phrase[left], self.by_block[0][right[hit]], block[left], both[hit]


def phrase_counts(shards: DataFrame, length: int, usual: list[Filter], entries: int = ENTRIES) -> DataFrame:
    """Popcounts by shard of the phrases of length words whose words and shorter phrases may be frequent: lang, phrase, n.

    usual has a filter for each shorter length.
    """

    def grown(shard: _Shard, words: list[np.ndarray], h: np.ndarray, phrase, block, bits):
        """Extends phrases (their words and hashes) by a word, and on to the length before it returns."""
        phrase, word, block, bits = shard.extended(phrase, block, bits)
        new = phrase * len(shard.hash) + word
        order = np.argsort(new, kind="stable")
        new, block, bits = new[order], block[order], bits[order]
        first = np.flatnonzero(np.diff(new, prepend=-1))
        if not len(first):
            return None
        last, word = new[first] // len(shard.hash), new[first] % len(shard.hash)
        words = [w[last] for w in words] + [word]
        if len(words) == length:
            keep = usual[length - 2](_joined(shard.hash[words[-2]], shard.hash[word])) if length > 2 else slice(None)
            return [w[keep] for w in words], np.add.reduceat(np.bitwise_count(bits).astype(np.int64), first)[keep]
        h = _joined(h[last], shard.hash[word])
        keep = usual[len(words) - 1](h)
        each = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(new))))
        number = np.cumsum(keep) - 1
        own = keep[each]
        return grown(shard, [w[keep] for w in words], h[keep], number[each[own]], block[own], bits[own])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one shard at a time is unpacked
                row = batch.slice(k, 1).to_pylist()[0]
                shard, names = _Shard(row, usual[0]), pa.array(row["words"], pa.string())
                cuts = np.append(np.flatnonzero(np.diff(shard.owner, prepend=-1)), len(shard.owner))
                at = 0
                while at < len(shard.owner):
                    # The words that begin within so many bytes, one at least.
                    to = max(cuts[np.searchsorted(cuts, at + entries, "right") - 1], cuts[np.searchsorted(cuts, at, "right")])
                    own = shard.owner[at:to]
                    found = grown(shard, [np.arange(len(names))], shard.hash, own, shard.block[at:to], shard.bits[at:to])
                    at = to
                    if found is None:
                        continue
                    words, n = found
                    phrase = pc.binary_join_element_wise(*[names.take(pa.array(w)) for w in words], " ")
                    yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(row["lang"]), len(n)), phrase, pa.array(n, pa.int64())], ["lang", "phrase", "n"])

    return shards.mapInArrow(run, "lang string, phrase string, n long")


def frequent_phrases(docs: DataFrame, scratch: Scratch, least: int = LEAST, longest: int = LONGEST, positions: int = POSITIONS) -> tuple[list[DataFrame], DataFrame]:
    """docs(lang, text) -> for each length the written table lang, phrase, n of phrases with n >= least; and lang, n of all words."""
    shards = scratch.written(bitmaps(docs, positions), "bitmaps")
    word = F.explode(F.arrays_zip(F.col("words").alias("phrase"), F.col("ones").alias("n"))).alias("w")
    words = shards.select("lang", word).select("lang", F.col("w.phrase").alias("phrase"), F.col("w.n").alias("n"))
    ones = F.aggregate("ones", F.lit(0).cast("long"), lambda a, x: a + x)
    sizes = scratch.written(shards.select("lang", ones.alias("n")).groupBy("lang").agg(F.sum("n").alias("n")), "words-of-langs")
    found, usual = [], []
    for length in range(1, longest + 1):
        each = words if length == 1 else phrase_counts(shards, length, usual)
        found.append(scratch.written(each.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least), f"phrases-{length}"))
        if length < longest:
            usual.append(Filter(found[-1]))
    return found, sizes


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP, positions: int = POSITIONS, scratch: Scratch | None = None) -> DataFrame:
    """docs(lang, text) -> lang, rank int, phrase, a, l, r, n, score: the first phrases of each lang.

    Phrases of 2 to longest words with at least `least` occurrences, scored by their worst cut
    (l and r count its parts, ties are for the first cut); one that a longer phrase contains goes if that
    has `covered` per cent of its occurrences. Order: score and a descending, phrase in
    bytes. A null lang is 'und' (one with such a lang), a null text empty; repeated rows count. An
    empty table, or one without a frequent phrase, gives none. Other columns aren't read. A
    worker holds a shard, thus one text whole at least (some 40 bytes for each of its bytes).
    """
    scratch = scratch or Scratch()
    small_batches(docs.sparkSession)
    plain = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found, sizes = frequent_phrases(plain, scratch, least, longest, positions)
    every, longer = found[0], None
    for table in found[1:]:
        every = every.unionByName(table)
    words = F.split("phrase", " ")
    long = every.withColumn("words", words).where(F.size("words") > 1)

    cut = long.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"), F.array_join(F.slice("words", F.col("k") + 1, F.size("words")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cut = cut.join(every.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    score = F.expr("(1000000BD * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(15, 0)) * cast(r as decimal(15, 0)))")
    worst = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    # What lies inside a longer phrase: each of its shorter runs of words.
    size = F.size("words")
    runs = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice("words", i, m), " "))))
    longer = long.where(size > 2).select("lang", "n", F.explode(runs).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = worst.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)).alias("part")
    first = kept.select("*", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top).drop("part")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, covered: int = COVERED, top: int = TOP) -> str:
    """DuckDB SQL over documents for collocations() with phrases of two and three words."""
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
ones AS (SELECT lang, unnest(ws) AS phrase FROM w),
twos AS (SELECT lang, unnest(list_transform(range(1, greatest(len(ws), 1)::BIGINT), lambda i: ws[i] || ' ' || ws[i + 1])) AS phrase FROM w),
threes AS (SELECT lang, unnest(list_transform(range(1, greatest(len(ws) - 1, 1)::BIGINT), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS phrase FROM w),
f AS (SELECT lang, phrase, 1 AS size, count(*) AS n FROM ones GROUP BY 1, 2
  UNION ALL SELECT lang, phrase, 2, count(*) FROM twos GROUP BY 1, 2 HAVING count(*) >= {least}
  UNION ALL SELECT lang, phrase, 3, count(*) FROM threes GROUP BY 1, 2 HAVING count(*) >= {least}),
c AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1 AND n >= {least}),
cuts AS (SELECT lang, phrase, a, k, array_to_string(ws[:k], ' ') AS lp, array_to_string(ws[k + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
scored AS (SELECT cuts.lang, cuts.phrase, a, k, x.n AS l, y.n AS r, (1000000::HUGEINT * a * a // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lp JOIN f y ON y.lang = cuts.lang AND y.phrase = rp),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (SELECT lang, phrase, max(n) AS n FROM (SELECT lang, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase, a AS n FROM c WHERE size = 3) GROUP BY 1, 2),
kept AS (SELECT worst.* FROM worst LEFT JOIN longer USING (lang, phrase) WHERE longer.n IS NULL OR 100 * longer.n < {covered} * a),
sizes AS (SELECT lang, count(*) AS n FROM ones GROUP BY 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score FROM kept JOIN sizes USING (lang)
QUALIFY rank <= {top}"""
