"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of words; a word is one of FEATURES hashed terms, weighted by its
inverse document frequency over the whole corpus. A randomised SVD of all benchmark passages
by TF-IDF gives the latent space; its products with the passage matrix are summed over the
cluster, and only matrices of fixed size reach the driver. No counts, weights or directions come
from a sample of the documents. Each document is then read once: passages whose
terms can't reach the cosine are left out by a bound, the others are projected and compared
with all benchmark passages, and the candidates' words checked by their longest common
subsequence with the item and with its answer, the item's last words.

The latent image is an approximation, so a count of the item's rarest words that a leak
can't do without brings up whatever the image leaves out, for the same checks.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_back, small_batches, written

FEATURES, RANK, EXTRA, POWERS = 1 << 16, 224, 16, 2
#: Words of half a passage: passages are two neighbouring halves.
HALF = 16
#: Terms in more than this share of the documents have no latent direction.
COMMON = 0.15
#: Cosine of a candidate: the passage's latent image with the item's, over the passage's whole
#: length. It is at most the root of the share of the passage's weight on benchmark terms.
COSINE = 0.15
#: Share of the item's words in common order for a leak; below SURE its answer's must be there too.
LCS, SURE, ANSWER, ANSWER_WORDS = 0.6, 0.9, 0.5, 8
#: Items looked up in one reading of the documents.
ITEMS = 5_000
BLOCK_BYTES = 1 << 19
#: Pairs of a word and an item that has it, worked on at once.
PAIRS = 1 << 21
_RANGE = 1024

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_B = 0x9E3779B1
_powers: list[np.ndarray] = []


class Words:
    """Words of documents that lie one after another in data: start, end, document and term of each."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        size = len(data)
        if not _powers or len(_powers[0]) < size + 1:
            _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint32), np.full(size, b, np.uint32))), dtype=np.uint32) for b in (_B, pow(_B, -1, 2**32))]
        up, down = _powers
        self.data = _FOLD[data]
        inside = np.zeros(size + 2, bool)
        inside[1:-1] = _WORD[self.data]
        start = inside[1:-1] & ~inside[:-2]
        stop = inside[1:-1] & ~inside[2:]
        first = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < size)]  # a word doesn't cross into the next document
        start[first] |= inside[1:-1][first]
        stop[first - 1] |= inside[1:-1][first - 1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        prefix = np.zeros(size + 1, np.uint32)
        np.cumsum((self.data + np.uint32(1)) * up[:size], out=prefix[1:], dtype=np.uint32)
        h = (prefix[self.end] - prefix[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint32)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
        self.term = (h >> np.uint32(16)).astype(np.int64)
        self.doc = np.searchsorted(ends, self.start, "right")

    def text(self, a: int, b: int) -> list[bytes]:
        return [self.data[x:y].tobytes() for x, y in zip(self.start[a:b].tolist(), self.end[a:b].tolist())]


def _of_texts(texts: list[str]) -> Words:
    raw = [x.encode() for x in texts]
    return Words(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(x) for x in raw]))


def _read(batch: pa.RecordBatch):
    """doc_ids and Words of blocks of the batch's documents, straight from its text buffer."""
    text = batch.column(1)
    text = text.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    lo = 0
    while lo < len(text):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + BLOCK_BYTES, "right")) - 1)
        yield batch.column(0).slice(lo, hi - lo), Words(data[offsets[lo] : offsets[hi]], offsets[lo + 1 : hi + 1] - offsets[lo])
        lo = hi


def _halves(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word and document of each half passage; a document's last one may be short."""
    if not len(words.doc):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.concatenate(([0], np.flatnonzero(np.diff(words.doc)) + 1))
    within = np.arange(len(words.doc)) - np.repeat(new, np.diff(np.concatenate((new, [len(words.doc)]))))
    first = np.flatnonzero(within % HALF == 0)
    return first, words.doc[first]


def _passages(sums: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Sums of each half with the next one of its document."""
    out = sums.copy()
    out[:-1][doc[1:] == doc[:-1]] += sums[1:][doc[1:] == doc[:-1]]
    return out


def _summed(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """Rows (range int, part binary of float64) summed by range: one array of that shape."""

    def add(group: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, np.float64) for x in group.column("part").to_pylist()], axis=0)
        return pa.table({"range": group.column("range")[:1], "part": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(shape)
    for r in rows.groupBy("range").applyInArrow(add, "range int, part binary").collect():  # FEATURES / _RANGE rows at most
        part = np.frombuffer(r.part, np.float64).reshape(-1, shape[1])
        out[r.range * _RANGE : r.range * _RANGE + len(part)] = part
    return out


def _parts(total: np.ndarray) -> pa.RecordBatch:
    parts = [np.ascontiguousarray(total[k : k + _RANGE], np.float64).tobytes() for k in range(0, len(total), _RANGE)]
    return pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.binary())], ["range", "part"])


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """docs(doc_id, text) -> in how many documents each hashed term occurs, and the number of documents: of all of them."""

    def run(batches):
        total = np.zeros(FEATURES)
        for batch in batches:
            for _, words in _read(batch):
                pair = np.sort((words.doc << 16 | words.term).astype(np.uint32) if len(words.doc) and words.doc[-1] < 1 << 16 else words.doc << 16 | words.term)
                if len(pair):
                    total += np.bincount(pair[np.concatenate(([True], np.diff(pair) != 0))] & 0xFFFF, minlength=FEATURES)
        yield _parts(total)

    rows = docs.select("doc_id", "text").mapInArrow(given_back(run), "range int, part binary")
    return _summed(rows, (FEATURES, 1))[:, 0].astype(np.int64), docs.count()


def _grouped(group: np.ndarray, index: np.ndarray, weight: np.ndarray, source: np.ndarray, n: int, groups: int = 512) -> np.ndarray:
    """For each of n groups the sum of its entries' source rows by their weights, some groups at a time."""
    out = np.zeros((n, source.shape[1]))
    order = np.argsort(group, kind="stable")
    group, index, weight = group[order], index[order], weight[order]
    if len(group):
        new = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(group)]))
        for lo in range(0, len(new) - 1, groups):
            part = new[lo : lo + groups + 1]
            a, b = part[0], part[-1]
            out[group[part[:-1]]] = np.add.reduceat(source[index[a:b]] * weight[a:b, None], part[:-1] - a, axis=0)
    return out


class Space:
    """The latent space: weights of terms, their directions, and the benchmark's passages in it."""

    def __init__(self, idf: np.ndarray, usable: np.ndarray, items: list[tuple[int, str]]):
        self.idf, self.items = idf.astype(np.float32), items
        self.words = _of_texts([t for _, t in items])
        known = np.zeros(FEATURES, bool)
        known[self.words.term] = True
        self.known = known & usable
        self.n_known = int(self.known.sum())
        self.column = np.cumsum(self.known) - 1  # of a known term in the matrix
        self.square = (self.idf**2).astype(np.float32)
        self.of_item = [np.flatnonzero(self.words.doc == k) for k in range(len(items))]
        self.terms = [self.words.term[x].tolist() for x in self.of_item]
        self.counts = [Counter(x) for x in self.terms]
        self.texts = [self.words.text(int(x[0]), int(x[-1]) + 1) if len(x) else [] for x in self.of_item]
        self.directions = self.queries = np.zeros((0, 1), np.float32)  # until place(), and if no term is known
        self.query_item = np.zeros(0, np.int64)
        self._rarest()

    def _rarest(self) -> None:
        """Each item's rarest terms (as lists of items by term), and how many of them each leak has.

        A leak misses at most n - LCS * n of the item's n words. So of that many and a fifth of n
        more words, whichever they are, it has at least that fifth.
        """
        self.size = np.array([len(x) for x in self.terms], np.int64)
        self.hits = np.ones(len(self.items), np.int64)
        pairs = [np.zeros(0, np.int64)]
        for k, terms in enumerate(self.terms):
            spare = len(terms) - math.ceil(LCS * len(terms))
            least = np.argsort(-self.idf[terms], kind="stable")[: spare + max(1, len(terms) // 5)]
            self.hits[k] = max(1, len(least) - spare)
            pairs.append(np.unique(np.array(terms, np.int64)[least]) * len(self.items) + k)
        term, item = np.divmod(np.sort(np.concatenate(pairs)), max(1, len(self.items)))
        self.rare_item = item.astype(np.uint16 if len(self.items) < 1 << 16 else np.int64)  # short ones sort fast
        self.rare_first = np.searchsorted(term, np.arange(FEATURES + 1))

    def matrix(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """TF-IDF of the passages on known terms, of length one: passage, column, weight of the entries, number of passages."""
        first, doc = _halves(words)
        half = np.searchsorted(first, np.arange(len(words.term)), "right") - 1
        both = np.concatenate((half, half - 1))  # a word is in its half's passage and in the one before
        at = np.concatenate((np.arange(len(half)),) * 2)
        same = both >= 0
        same[len(half) :] &= doc[np.maximum(half - 1, 0)] == doc[half]
        same &= self.known[words.term[at]]
        passage, term = both[same], words.term[at[same]]
        norm = np.sqrt(np.bincount(passage, self.square[term], len(first)))
        return passage, self.column[term], self.idf[term] / norm[passage], len(first)

    def rows(self, words: Words, directions: np.ndarray) -> np.ndarray:
        """The matrix times directions."""
        passage, term, weight, n = self.matrix(words)
        return _grouped(passage, term, weight, directions, n)

    def gram(self, words: Words, directions: np.ndarray) -> np.ndarray:
        """The transposed matrix times the matrix times directions."""
        passage, term, weight, n = self.matrix(words)
        return _grouped(term, passage, weight, _grouped(passage, term, weight, directions, n), self.n_known)

    def place(self, directions: np.ndarray) -> None:
        """Takes the directions (a row for a column of the matrix, orthonormal) and projects the benchmark's passages."""
        self.directions = (directions * self.idf[self.known, None]).astype(np.float32)
        first, doc = _halves(self.words)
        image = self.rows(self.words, directions)
        norm = np.linalg.norm(image, axis=1)
        last = np.concatenate((doc[1:] != doc[:-1], [True]))
        alone = np.concatenate(([True], doc[1:] != doc[:-1]))
        good = (norm > 1e-9) & (~last | alone)  # an item's last half is in the passage before
        self.queries = (image[good] / norm[good, None]).astype(np.float32)
        self.query_item = doc[good]


def _fit(items: DataFrame, space: Space) -> None:
    """Randomised SVD of the passages of all items(doc_id, text): a random range, POWERS rounds of products with the Gram matrix, orthonormal each time."""
    passages = written(items.repartition(4), "passages")
    context = items.sparkSession.sparkContext
    shared = context.broadcast(space)  # at most ITEMS texts and arrays of FEATURES

    def gram(q: np.ndarray) -> np.ndarray:
        """The passages' Gram product with q, which goes to each executor once: FEATURES x (RANK + EXTRA) doubles at most."""
        held = context.broadcast(q)

        def product(batches):
            space, q = shared.value, held.value
            total = np.zeros(q.shape)
            for batch in batches:
                for _, words in _read(batch):
                    total += space.gram(words, q)
            yield _parts(total)

        out = _summed(passages.mapInArrow(given_back(product), "range int, part binary"), q.shape)
        held.unpersist()
        return out

    q = np.random.default_rng(11).standard_normal((space.n_known, min(RANK + EXTRA, space.n_known)))
    for _ in range(POWERS + 1):
        q = np.linalg.qr(gram(q))[0]
    # The small problem: eigenvectors of the range's Gram matrix, largest first.
    small = q.T @ gram(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    space.place(q @ vectors[:, np.argsort(-values)[:RANK]])
    shared.unpersist()


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence: bits of one integer hold a row of the table."""
    at: dict = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & at.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def verdict(item: list, region: list) -> tuple[int, int, bool]:
    """Words of the item and of its answer in common order with the region; whether it is a leak."""
    answer = item[-ANSWER_WORDS:]
    n, m = common_length(item, region), common_length(answer, region)
    return n, m, n >= SURE * len(item) or (n >= LCS * len(item) and m >= ANSWER * len(answer))


class _Block:
    """The documents of a block while they are searched: their half passages and the leaks found."""

    def __init__(self, words: Words, space: Space):
        self.words, self.space = words, space
        self.first, self.doc = _halves(words)
        self.bounds = np.searchsorted(words.doc, np.arange(words.doc[-1] + 2)) if len(words.doc) else np.zeros(1, np.int64)
        self.best: dict[tuple[int, int], tuple] = {}

    def check(self, half: int, item: int) -> tuple[int, int] | None:
        """Words and answer words in common with the item around a half passage, if it is a leak."""
        words, text, counts, terms = self.words, self.space.texts[item], self.space.counts[item], self.space.terms[item]
        d, w = int(self.doc[half]), int(self.first[half])
        a, b = max(int(self.bounds[d]), w - len(text)), min(int(self.bounds[d + 1]), w + 2 * HALF + len(text))
        region = words.term[a:b].tolist()
        # Words of the item that the region has at all, then their order by hashes, then the words.
        if sum(map(counts.get, counts.keys() & region)) < LCS * len(text) or common_length(terms, region) < LCS * len(text):
            return None
        n, m, leak = verdict(text, words.text(a, b))
        return (n, m) if leak else None

    def cosine(self, half: int, item: int) -> float:
        """The cosine of one passage with the item's nearest one; 0 if they share no latent direction."""
        space, w = self.space, int(self.first[half])
        term = self.words.term[w : min(w + 2 * HALF, int(self.bounds[self.doc[half] + 1]))]
        known, queries = term[space.known[term]], space.queries[space.query_item == item]
        if not len(known) or not len(queries):
            return 0.0
        vector = space.directions[space.column[known]].sum(0)
        return float((queries @ vector).max() / np.sqrt(space.square[term].sum()))


def _latent(block: _Block) -> None:
    """Leaks around the passages whose latent image is near an item's."""
    words, space, first, doc, best = block.words, block.space, block.first, block.doc, block.best
    if not len(first) or not len(space.queries):
        return
    square = space.square[words.term]
    known = space.known[words.term]
    weight = _passages(np.add.reduceat(square, first), doc)
    shared = _passages(np.add.reduceat(square * known, first), doc)
    wanted = (shared >= COSINE**2 * weight) & (shared > 0)
    needed = wanted.copy()  # and the halves after them
    needed[1:] |= wanted[:-1]
    sizes = np.diff(np.concatenate((first, [len(words.term)])))
    use = np.repeat(needed, sizes) & known
    at = np.flatnonzero(use)
    if not len(at):
        return
    half = np.repeat(np.arange(len(first)), sizes)[at]
    new = np.concatenate(([0], np.flatnonzero(np.diff(half)) + 1))
    index = np.full(len(first), -1)
    index[half[new]] = np.arange(len(new))
    image = np.zeros((len(new) + 1, space.directions.shape[1]), np.float32)
    for lo in range(0, len(new), 2048):
        hi = min(lo + 2048, len(new))
        stop = new[hi] if hi < len(new) else len(at)
        image[lo:hi] = np.add.reduceat(space.directions[space.column[words.term[at[new[lo] : stop]]]], new[lo:hi] - new[lo], axis=0)
    mine = np.flatnonzero(wanted)
    after = np.where((mine + 1 < len(first)) & (doc[np.minimum(mine + 1, len(first) - 1)] == doc[mine]), np.minimum(mine + 1, len(first) - 1), -1)
    for lo in range(0, len(mine), 2048):
        part, nxt = mine[lo : lo + 2048], after[lo : lo + 2048]
        vectors = image[index[part]] + image[np.where(nxt >= 0, index[nxt], -1)]
        scores = (vectors @ space.queries.T) / np.sqrt(weight[part])[:, None]
        for p, q in np.argwhere(scores >= COSINE).tolist():
            d, item, cosine = int(doc[part[p]]), int(space.query_item[q]), float(scores[p, q])
            known_leak = best.get((d, item))
            if known_leak:
                if cosine > known_leak[0]:
                    best[d, item] = (cosine, *known_leak[1:])
                continue
            found = block.check(int(part[p]), item)
            if found:
                best[d, item] = (cosine, *found)


def _rare_runs(words: Words, space: Space):
    """(first word, last word, item) of stretches that hold as many of an item's rarest words as a leak must, arrays at a time."""
    n = np.diff(space.rare_first)[words.term]
    before = np.concatenate(([0], np.cumsum(n)))
    reach = 2 * int(space.size.max(initial=0)) + 2 * HALF  # words of the longest region
    lo, end = 0, 0
    while end < len(n):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + PAIRS, "right")) - 1)
        end = min(len(n), hi + reach)
        lots = n[lo:end]
        at = np.repeat(np.arange(lo, end), lots)
        item = space.rare_item[np.arange(len(at)) + np.repeat(space.rare_first[words.term[lo:end]] - (before[lo:end] - before[lo]), lots)]
        order = np.argsort(item, kind="stable")
        at, item = at[order], item[order].astype(np.int64)
        last = np.arange(len(at)) + space.hits[item] - 1
        inside = last < len(at)
        last[~inside] = 0
        good = inside & (item[last] == item) & (words.doc[at[last]] == words.doc[at]) & (at[last] - at < 2 * space.size[item] + 2 * HALF)
        yield at[good], at[last[good]], item[good]
        lo = hi


def _counted(block: _Block) -> None:
    """Leaks around the passages that hold enough of an item's rarest words: all that there are."""
    words, space, best = block.words, block.space, block.best
    if not len(block.first):
        return
    half_first = np.searchsorted(block.doc, np.arange(words.doc[-1] + 1))
    half_end = np.searchsorted(block.doc, np.arange(words.doc[-1] + 1), "right")
    for a, b, item in _rare_runs(words, space):
        d = words.doc[a]
        # The regions that hold both words, by their half passages.
        low = np.maximum((b - block.bounds[d] - 2 * HALF - space.size[item]) // HALF + 1, 0) + half_first[d]
        n = np.minimum((a - block.bounds[d] + space.size[item]) // HALF + half_first[d] + 1, half_end[d]) - low
        n = np.maximum(n, 0)
        half = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        for key in np.unique(np.repeat(item, n) * len(block.first) + half).tolist():
            k, h = divmod(key, len(block.first))
            d_k = (int(block.doc[h]), k)
            if d_k in best:
                continue
            found = block.check(h, k)
            if found:
                best[d_k] = (block.cosine(h, k), *found)


def _search(words: Words, space: Space):
    """(document, item, cosine, words in common, answer words in common) of the leaks in a block."""
    block = _Block(words, space)
    _latent(block)
    _counted(block)
    for (d, item), (cosine, n, m) in block.best.items():
        yield d, item, cosine, n, m


LEAKS = "doc_id long, item_id long, cosine double, common_words long, answer_words long, item_words long"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs(doc_id, text), benchmark(item_id, text) -> LEAKS: a row for each document and item that it holds.

    Words are runs of ASCII letters and digits, case folded, and other bytes from 128 on.
    Null and blank texts hold nothing and are held by nothing. An item is found whatever its
    words' frequencies are and however many items there are; cosine is below COSINE (0 without
    a word of at most COMMON of the documents) where only the count of rarest words brought it
    up. Repeated documents and items give rows of their own. Other columns aren't read. Empty
    tables give none.

    Items are looked up ITEMS at a time, so what a task holds doesn't grow with the benchmark.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null")
    items, n_items = _numbered(items)
    frequency, n_docs = document_frequency(docs)
    idf = np.log((n_docs + 1) / (frequency + 1)) + 0.01
    # Small tables are made by Arrow: rows of Python objects would go through RDDs, whose workers stay beside the others.
    none = [pa.array([], pa.float64() if "double" in x else pa.int64()) for x in LEAKS.split(", ")]
    out = docs.sparkSession.createDataFrame(pa.table(none, [x.split()[0] for x in LEAKS.split(", ")]))
    for lo in range(0, n_items, ITEMS):
        some = items.where((F.col("n") >= lo) & (F.col("n") < lo + ITEMS))
        part = [(r.item_id, r.text) for r in some.orderBy("n").collect()]  # ITEMS rows
        space = Space(idf, frequency <= COMMON * max(n_docs, 1), part)
        if not len(space.words.term):
            continue
        if space.known.any():
            _fit(some.select(F.col("item_id").alias("doc_id"), "text"), space)
        shared = docs.sparkSession.sparkContext.broadcast(space)  # at most FEATURES x RANK floats and ITEMS texts

        def run(batches, shared=shared):
            space = shared.value
            for batch in batches:
                rows = [
                    (ids[d].as_py(), space.items[k][0], c, n, m, len(space.texts[k])) for ids, words in _read(batch) for d, k, c, n, m in _search(words, space)
                ]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.float64() if k == 2 else pa.int64()) for k, x in enumerate(zip(*rows))],
                        ["doc_id", "item_id", "cosine", "common_words", "answer_words", "item_words"],
                    )

        out = out.unionByName(docs.mapInArrow(given_back(run), LEAKS))
    return out


def _numbered(items: DataFrame) -> tuple[DataFrame, int]:
    """items with n, their place in the order of item_id and text, over many tasks; how many there are."""
    from pyspark.sql.window import Window

    ranged = written(items.repartitionByRange("item_id", "text").withColumn("range", F.spark_partition_id()), "items")
    counts = {r.range: r["count"] for r in ranged.groupBy("range").count().collect()}  # a row for a shuffle partition
    total, first = 0, []
    for k in sorted(counts):
        first.append((k, total))
        total += counts[k]
    if not total:
        return ranged.withColumn("n", F.lit(0)), 0
    at = pa.table([pa.array([x[0] for x in first], pa.int32()), pa.array([x[1] for x in first], pa.int64())], ["range", "first"])
    begin = F.broadcast(items.sparkSession.createDataFrame(at))
    within = F.row_number().over(Window.partitionBy("range").orderBy("item_id", "text")) - 1
    return ranged.join(begin, "range").withColumn("n", F.col("first") + within), total


def brute_force(docs: list[tuple], items: list[tuple]) -> set[tuple]:
    """(doc_id, item_id) whose words pass verdict() in some stretch of the document: for small fixtures."""
    split = lambda t: (lambda w: w.text(0, len(w.start)))(_of_texts([t or ""]))
    found, known = set(), [(i, split(t)) for i, t in items if t]
    for doc, text in docs:
        words = split(text)
        for item, want in known:
            if want and common_length(want, words) >= LCS * len(want):
                step = max(1, HALF)
                for w in range(0, max(1, len(words)), step):
                    if verdict(want, words[max(0, w - len(want)) : w + 2 * HALF + len(want)])[2]:
                        found.add((doc, item))
                        break
    return found
