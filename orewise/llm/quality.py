"""Quality rules: repetition coverage by rolling hashes.

Every text's words get 64-bit hashes from one prefix sum over its characters; windows of
several n-gram lengths get theirs from one prefix sum over the word hashes. Sorting the
window hashes finds the n-grams that occur twice or more in a text; the characters of all
words below such windows, and of lines that repeat an earlier line, are the coverage.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_back, small_batches

#: Window lengths whose coverage is reported, and the percentage of a text's word
#: characters above which the rule rejects it. Longer windows get lower limits.
NGRAM_PERCENT = {5: 35, 7: 30, 10: 25}
LINE_PERCENT = 30
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
BASE_WINDOW, BASE_PERCENT = 3, 50
#: Characters of text that are worked on at once (a longer text is worked on alone).
BLOCK_CHARS = 250_000

_B, _C = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd, so both have inverses mod 2**64
_U = np.uint64


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i to n."""
    out = []
    for b in (base, pow(base, -1, 2**64)):
        p = np.full(n + 1, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class _Powers:
    """Grows as longer blocks come."""

    def __init__(self, base: int):
        self.base, self.n = base, -1

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n, self.up, self.down = n, *_powers(self.base, n)
        return self.up, self.down


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _prefix(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def _again(keys: np.ndarray, later: bool = False) -> np.ndarray:
    """Which keys occur twice or more; with later, only those after the first."""
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0 if len(keys) else np.zeros(0, bool)
    hit = np.zeros(len(keys), bool)
    hit[1:] = same
    if not later:
        hit[:-1] |= same
    out = np.empty(len(keys), bool)
    out[order] = hit
    return out


_char_powers, _word_powers = _Powers(_B), _Powers(_C)


def measure(texts: list[str], ngrams: tuple[int, ...] = tuple(NGRAM_PERCENT)) -> dict[str, np.ndarray]:
    """Counts for each text: words, word characters, symbols, repeated lines, words in repeated
    windows of BASE_WINDOW, and word characters in repeated lines and n-grams."""
    n_docs = len(texts)
    chars = np.frombuffer("".join(x + "\n" for x in texts).encode("utf-32-le"), "<u4")
    ends = np.cumsum([len(x) + 1 for x in texts])
    space = (chars == 32) | ((chars >= 9) & (chars <= 13))
    edge = np.diff(np.concatenate(([True], space)).astype(np.int8))
    first = np.flatnonzero(edge == -1)  # the last character is a space, so each word ends
    last = np.flatnonzero(edge == 1)
    lengths = last - first
    doc = np.searchsorted(ends, first, "right")
    up, down = _char_powers(len(chars))
    prefix = _prefix(_mixed(chars.astype(np.uint64) + _U(1)), up)
    word = _mixed((prefix[last] - prefix[first]) * down[first] + lengths.astype(np.uint64))
    salt = _mixed(np.arange(n_docs, dtype=np.uint64) + _U(_C))
    by_doc = lambda at, what: np.bincount(at, what, n_docs).astype(np.int64)
    symbols = np.flatnonzero(np.isin(chars, [ord(c) for c in SYMBOLS]))
    out = {
        "n_words": by_doc(doc, None),
        "word_chars": by_doc(doc, lengths),
        "n_symbols": by_doc(np.searchsorted(ends, symbols, "right"), None),
    }

    line_ends = np.flatnonzero(chars == 10)
    line_first = np.concatenate(([0], line_ends[:-1] + 1))
    line_doc = np.searchsorted(ends, line_first, "right")
    word_at = np.searchsorted(first, np.concatenate((line_first, [len(chars)])))  # words don't cross lines
    worded = np.diff(word_at) > 0
    run = np.concatenate(([0], np.cumsum(lengths)))
    line_chars = np.diff(run[word_at])[worded]
    a, b, at = line_first[worded], line_ends[worded], line_doc[worded]
    repeated = _again(_mixed((prefix[b] - prefix[a]) * down[a] + (b - a).astype(np.uint64)) ^ salt[at], later=True)
    out["n_dup_lines"] = by_doc(at[repeated], None)
    out["dup_line_chars"] = by_doc(at[repeated], line_chars[repeated])

    up, down = _word_powers(len(word))
    prefix = _prefix(word, up)
    for n in (BASE_WINDOW, *ngrams):
        k = max(0, len(word) - n + 1)
        inside = doc[:k] == doc[n - 1 :][:k]
        at = np.flatnonzero(inside)
        keys = _mixed((prefix[at + n] - prefix[at]) * down[at]) ^ salt[doc[at]]
        at = at[_again(keys)]
        cover = np.zeros(len(word) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        hit = np.cumsum(cover[:-1]) > 0
        if n == BASE_WINDOW:
            out["n_repeat_words"] = by_doc(doc[hit], None)
        if n in ngrams:
            out[f"dup{n}_chars"] = by_doc(doc[hit], lengths[hit])
    return out


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup{n}_chars" for n in NGRAM_PERCENT)]


def _blocks(texts: list[str]):
    """Slices of about BLOCK_CHARS characters."""
    start = size = 0
    for k, x in enumerate(texts):
        if size and size + len(x) > BLOCK_CHARS:
            yield start, k
            start, size = k, 0
        size += len(x)
    if start < len(texts):
        yield start, len(texts)


def repetition(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> doc_id and MEASURES, all long: a row for a row, nothing shuffled.

    A null or blank text has no word and counts of zero. Repeated rows and doc_ids stay as
    they are, null doc_ids too; other columns aren't read.
    """
    schema = "doc_id long, " + ", ".join(f"{x} long" for x in MEASURES)

    def run(batches):
        for batch in batches:
            for lo, hi in _blocks(texts := [x or "" for x in batch.column(1).to_pylist()]):
                found = measure(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *(pa.array(found[x], pa.int64()) for x in MEASURES)], ["doc_id", *MEASURES]
                )

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(given_back(run), schema)


def judged(measures: DataFrame) -> DataFrame:
    """Adds base_failed and kept to the counts of repetition()."""
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * BASE_PERCENT)
    over = [F.col("dup_line_chars") * 100 > F.col("word_chars") * LINE_PERCENT]
    over += [F.col(f"dup{n}_chars") * 100 > F.col("word_chars") * p for n, p in NGRAM_PERCENT.items()]
    rejected = base
    for x in over:
        rejected = rejected | x
    return measures.withColumns({"base_failed": base, "kept": ~rejected})


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed and kept (never null), then the coverages, for each row of docs."""
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged(repetition(docs)).select("doc_id", *base, "base_failed", "kept", *[x for x in MEASURES if x not in base])


def passed(docs: DataFrame) -> DataFrame:
    """The rows of docs whose text is kept, as they are: each goes by its own verdict, and nothing is joined or copied.

    docs must have a column text; a null one has no words and goes.
    """
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            kept, texts = [], [x or "" for x in batch.column(at).to_pylist()]
            for lo, hi in _blocks(texts):
                found = measure(texts[lo:hi])
                words, chars = found["n_words"], found["word_chars"]
                bad = (words < MIN_WORDS) | (100 * found["n_repeat_words"] > BASE_PERCENT * words) | (100 * found["dup_line_chars"] > LINE_PERCENT * chars)
                for n, p in NGRAM_PERCENT.items():
                    bad |= 100 * found[f"dup{n}_chars"] > p * chars
                kept.append(~bad)
            yield batch.filter(pa.array(np.concatenate(kept) if kept else np.zeros(0, bool)))

    small_batches(docs.sparkSession)
    return docs.mapInArrow(given_back(run), docs.schema)
