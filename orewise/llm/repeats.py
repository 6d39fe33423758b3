"""Removal of byte strings that repeat across documents, by blockwise suffix sorting.

Suffixes are never sorted all at once. A cover sample of positions is ranked first: every
string of LENGTH bytes holds a sampled position, at a place that its bytes alone decide
(the least hash among its grams of GRAM bytes), so equal strings meet at equal sampled
grams. Grams of one block and document only end the search for all strings around them.
The suffixes at the other sampled positions fall into buckets by their gram. One bucket at
a time is sorted: the grams get their ranks by their bytes, and a string's long tie with
others, the gram that they share, is resolved by that rank and the gram's place in the
string, so that only the bytes before and after it are compared. Memory follows the bucket
and the block of documents, whose sizes are fixed.

Between the steps travel five bytes for each sampled gram of a block, the surroundings of
the grams that repeat, and one bit back for each string in question.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

LENGTH, GRAM = 50, 26
#: Bytes of text in a block of documents, and of text for which there is one bucket.
BLOCK_BYTES, BUCKET_BYTES = 1 << 20, 4 << 20
#: A gram in more blocks than this has its strings dealt one by one.
HOT_BLOCKS = 2_000
NO_ID = np.iinfo(np.int64).max
_B, _INV = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)
_U = np.uint64
_powers: list[np.ndarray] = []


def _hashes(data: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of each string of n bytes."""
    size = len(data)
    if not _powers or len(_powers[0]) < size + 1:
        _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, _U), np.full(size, b, _U)))) for b in (_B, _INV)]
    up, down = _powers
    prefix = np.zeros(size + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * up[:size], out=prefix[1:])
    out = (prefix[n:] - prefix[:-n]) * down[: size - n + 1]
    out ^= out >> _U(32)
    out *= _U(0xD6E8FEB86659FD93)
    out ^= out >> _U(32)
    return out


def cover(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings that share a sampled gram: first start, number, gram's start, its hash, document.

    Every string of LENGTH bytes within a document is in exactly one run.
    """
    starts = LENGTH - GRAM + 1  # grams of a string
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(_U), none
    gram = _hashes(data, GRAM)
    least = (gram & _U(0xFFFFFFFF00000000)) | np.arange(len(gram), dtype=_U)  # the first of equal ones
    width = 1
    while 2 * width <= starts:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if starts > width:
        least = np.minimum(least[: width - starts], least[starts - width :])
    ends = np.cumsum(lengths)
    at = np.flatnonzero(np.arange(len(least)) + LENGTH <= np.repeat(ends, lengths)[: len(least)])
    sampled = (least[at] & _U(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(sampled) != 0) | (np.diff(at) != 1)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(at)])))
    return at[first], count, sampled[first], gram[sampled[first]], np.searchsorted(ends, at[first], "right")


def _bucket(gram: np.ndarray, buckets: int) -> np.ndarray:
    return (gram & _U(0xFFFFFFFFFF)) % _U(buckets)  # 40 bits: enough for any number of buckets


def _dealt(buckets: np.ndarray):
    """bucket, indexes of it; in the order of buckets, and of the indexes within one."""
    order = np.argsort(buckets, kind="stable")
    cuts = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(buckets[part[0]]), part


class Block:
    """A block of documents: its bytes, ids and runs."""

    def __init__(self, ids: bytes, lengths: bytes, packed: bytes):
        self.ids, self.lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
        self.raw = zstandard.decompress(packed) if packed else b""
        self.data = np.frombuffer(self.raw, np.uint8)
        self.start, self.count, self.sampled, self.gram, self.doc = cover(self.data, self.lengths)
        self.grams, self.place = np.unique(self.gram, return_inverse=True)

    def sample(self, buckets: int):
        """bucket, five bytes of each of its grams: the sampled grams, each once."""
        high = (self.grams >> _U(24)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        for bucket, at in _dealt(_bucket(self.grams, buckets)):
            yield bucket, high[at].tobytes()

    def entries(self, buckets: int, answers: dict[int, bytes]) -> None:
        """Picks the runs whose gram repeats; equal surroundings are one entry with the least id.

        A run whose gram is in very many blocks is taken apart: each of its strings is an entry,
        dealt by its own bytes, so that what stands around a hot gram doesn't meet in one bucket.
        """
        repeats, hot = np.zeros(len(self.grams), bool), np.zeros(len(self.grams), bool)
        for bucket, at in _dealt(_bucket(self.grams, buckets)):
            bits = np.frombuffer(answers[bucket], np.uint8).reshape(2, -1)
            repeats[at], hot[at] = (np.unpackbits(x, count=len(at)).astype(bool) for x in bits)
        low, high = np.full(len(self.grams), NO_ID), np.full(len(self.grams), np.iinfo(np.int64).min)
        np.minimum.at(low, self.place, self.doc)
        np.maximum.at(high, self.place, self.doc)
        runs = np.flatnonzero((repeats | (low < high))[self.place])
        apart = hot[self.place[runs]]
        pieces = np.where(apart, self.count[runs], 1)
        run = np.repeat(runs, pieces)
        self.run_start, self.run_count = self.start[run] + _ranges(np.zeros(len(runs), np.int64), pieces), np.where(np.repeat(apart, pieces), 1, self.count[run])
        self.run_doc = self.doc[run]
        known: dict[bytes, int] = {}
        self.entry = np.zeros(len(run), np.int64)
        for k, (a, b) in enumerate(zip(self.run_start.tolist(), (self.run_start + self.run_count + LENGTH - 1).tolist())):
            self.entry[k] = known.setdefault(self.raw[a:b], len(known))
        self.texts = list(known)
        n = len(known)
        self.least = np.full(n, NO_ID)
        np.minimum.at(self.least, self.entry, self.ids[self.run_doc])
        self.entry_gram, self.entry_count, self.entry_place = np.zeros(n, _U), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.entry_gram[self.entry], self.entry_count[self.entry] = self.gram[run], self.run_count
        self.entry_place[self.entry] = self.sampled[run] - self.run_start
        own = self.gram[run]
        if apart.any():
            alone = np.repeat(apart, pieces)
            own[alone] = _hashes(self.data, LENGTH)[self.run_start[alone]]
        self.entry_bucket = np.zeros(n, _U)
        self.entry_bucket[self.entry] = _bucket(own, buckets)

    def questions(self):
        """bucket, then of its entries: gram's top byte, number of strings, gram's place, least id, surroundings."""
        for bucket, at in _dealt(self.entry_bucket):
            yield (
                bucket, (self.entry_gram[at] >> _U(56)).astype(np.uint8).tobytes(), self.entry_count[at].astype(np.uint8).tobytes(),
                self.entry_place[at].astype(np.uint8).tobytes(), self.least[at].tobytes(), b"".join([self.texts[k] for k in at.tolist()]),
            )

    def covered(self, answers: dict[int, bytes]) -> np.ndarray:
        """Which bytes go: those of strings that a smaller id has too."""
        before = np.concatenate(([0], np.cumsum(self.entry_count)))
        smaller = np.zeros(before[-1], bool)  # of each entry's strings: an id below the entry's least has it
        for bucket, at in _dealt(self.entry_bucket):
            bits = np.unpackbits(np.frombuffer(answers[bucket], np.uint8), count=int(self.entry_count[at].sum())).astype(bool)
            smaller[_ranges(before[at], self.entry_count[at])] = bits
        count = self.run_count
        hit = smaller[_ranges(before[self.entry], count)] | np.repeat(self.ids[self.run_doc] > self.least[self.entry], count)
        at = _ranges(self.run_start, count)[hit]
        edge = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + LENGTH, -1)
        return np.cumsum(edge[:-1]) > 0


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... count[0] of them, then those of the next."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) - np.repeat(ends - count - first, count)


def _repeating(blobs: list[bytes], hot_blocks: int) -> list[bytes]:
    """Of each block's sampled grams, a bit: another block has it; and then a bit: over hot_blocks blocks have it."""
    sizes = [len(x) // 5 for x in blobs]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :5] = np.frombuffer(b"".join(blobs), np.uint8).reshape(-1, 5)
    _, place, blocks = np.unique(wide.view("<u8").ravel(), return_inverse=True, return_counts=True)
    blocks = blocks[place]
    return [np.packbits(x > 1).tobytes() + np.packbits(x > hot_blocks).tobytes() for x in np.split(blocks, np.cumsum(sizes)[:-1])]


def _order(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys, the first one first, and where in it a row differs from the one before."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= np.diff(k[order]) != 0
    return order, new


def _packed(data: np.ndarray, at: np.ndarray, jump: np.ndarray | None, n: int) -> list[np.ndarray]:
    """n bytes from each place as integers that compare as the bytes do; from jump bytes on, GRAM bytes are left out."""
    out = np.zeros((len(at), -(-n // 8) * 8), np.uint8)
    for k in range(n):
        out[:, k] = data[at + k if jump is None else at + k + GRAM * (k >= jump)]
    return list(out.view(">u8").astype(_U).T)


def _smaller(tops: np.ndarray, counts: np.ndarray, places: np.ndarray, leasts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Of each entry's strings in order: an entry with a smaller least id has it too."""
    sizes = counts + LENGTH - 1
    begin, before = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), bool)
    for top in np.unique(tops):  # a part of the bucket at a time
        mine = np.flatnonzero(tops == top)
        order, new = _order(*_packed(data, begin[mine] + places[mine], None, GRAM))
        rank = np.empty(len(mine), np.int64)
        rank[order] = np.cumsum(new)
        at, own = _ranges(begin[mine], counts[mine]), np.repeat(leasts[mine], counts[mine])
        jump = np.repeat(begin[mine] + places[mine], counts[mine]) - at  # the gram's place in the string
        order, new = _order(np.repeat(rank, counts[mine]) * LENGTH + jump, *_packed(data, at, jump, LENGTH - GRAM))
        group = np.flatnonzero(new)
        least = np.minimum.reduceat(own[order], group)
        found = np.empty(len(order), bool)
        found[order] = np.repeat(least, np.diff(np.concatenate((group, [len(order)])))) < own[order]
        out[_ranges(before[mine], counts[mine])] = found
    return out


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs(doc_id, text) -> block, n_bytes, ids, lengths, packed: documents in blocks of about block_bytes."""
    schema = pa.schema([("block", pa.int64()), ("n_bytes", pa.int64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("packed", pa.binary())])

    def run(batches):
        from pyspark import TaskContext

        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0

        def block():
            raw = b"".join(texts)
            lengths = np.array([len(x) for x in texts], np.int64)
            return _rows(schema, [(number, len(raw), np.array(ids, np.int64).tobytes(), lengths.tobytes(), zstandard.compress(raw, 1))])

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                data = text.as_buffer().to_pybytes() if text.is_valid else b""
                if texts and size + len(data) > block_bytes:
                    yield block()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(NO_ID if doc.as_py() is None else doc.as_py())
                texts.append(data)
                size += len(data)
        if texts:
            yield block()

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "block long, n_bytes long, ids binary, lengths binary, packed binary"
    )


def _block(table: pa.Table) -> Block:
    return Block(*(table.column(k)[0].as_py() for k in ("ids", "lengths", "packed")))


def _answers(table: pa.Table, step: int) -> dict[int, bytes]:
    return {b: x for b, x, s in zip(table.column("bucket").to_pylist(), table.column("bits").to_pylist(), table.column("step").to_pylist()) if s == step}


def without_repeats(docs: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept binary: a row for a row.

    A byte goes if a string of LENGTH bytes over it also starts in a document of a smaller
    doc_id; n_spans counts the maximal runs of bytes that went, kept is what remains (it may
    end within a character). A null text is empty, a null doc_id larger than any other, and
    documents of equal doc_id never count against each other. Other columns aren't read.

    A bucket holds about bucket_bytes of text by its hash, besides what repeats: a string that
    is in every block has one entry a block in its bucket, 50 to 74 bytes each, so block_bytes
    should grow with the corpus (16 MB at 100 TB: six million blocks). What stands around a gram of
    over hot_blocks blocks is dealt by each string's own bytes.
    """
    spark = docs.sparkSession
    table = written(blocks(docs, block_bytes), "blocks")
    buckets = max(1, -(-(table.agg(F.sum("n_bytes")).first()[0] or 0) // bucket_bytes))

    sample_schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("grams", pa.binary())])
    answer_schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("bits", pa.binary()), ("step", pa.int32())])
    question_schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("tops", pa.binary()), ("counts", pa.binary()), ("places", pa.binary()), ("leasts", pa.binary()), ("texts", pa.binary())])
    answer_sql = "block long, bucket int, bits binary, step int"

    def sample(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                part = pa.Table.from_batches([batch.slice(k, 1)])
                number = part.column("block")[0].as_py()
                yield _rows(sample_schema, [(number, *x) for x in _block(part).sample(buckets)])

    def rank(group: pa.Table) -> pa.Table:
        bits = _repeating(group.column("grams").to_pylist(), hot_blocks)
        n = group.num_rows
        return pa.Table.from_arrays([group.column("block"), group.column("bucket"), pa.array(bits, pa.binary()), pa.array([1] * n, pa.int32())], schema=answer_schema)

    def ask(block: pa.Table, told: pa.Table) -> pa.Table:
        out = _block(block)
        out.entries(buckets, _answers(told, 1))
        number = block.column("block")[0].as_py()
        return pa.Table.from_batches([_rows(question_schema, [(number, *x) for x in out.questions()])])

    def settle(group: pa.Table) -> pa.Table:
        counts = [np.frombuffer(x, np.uint8).astype(np.int64) for x in group.column("counts").to_pylist()]
        tops, places, leasts, texts = (b"".join(group.column(x).to_pylist()) for x in ("tops", "places", "leasts", "texts"))
        # In the order of the grams' top bytes, so that a part of the bucket is one stretch of text.
        all_counts, all_tops = np.concatenate(counts), np.frombuffer(tops, np.uint8)
        order = np.argsort(all_tops, kind="stable")
        sizes = all_counts + LENGTH - 1
        begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(texts, np.uint8)[_ranges(begin[order], sizes[order])]
        found = _smaller(all_tops[order], all_counts[order], np.frombuffer(places, np.uint8).astype(np.int64)[order], np.frombuffer(leasts, np.int64)[order], data)
        flags = np.empty(len(found), bool)
        flags[_ranges((np.cumsum(all_counts) - all_counts)[order], all_counts[order])] = found
        cuts = np.cumsum([int(x.sum()) for x in counts])[:-1]
        bits = [np.packbits(x).tobytes() for x in np.split(flags, cuts)]
        n = group.num_rows
        return pa.Table.from_arrays([group.column("block"), group.column("bucket"), pa.array(bits, pa.binary()), pa.array([2] * n, pa.int32())], schema=answer_schema)

    def cut(block: pa.Table, told: pa.Table) -> pa.Table:
        out = _block(block)
        out.entries(buckets, _answers(told, 1))
        gone = out.covered(_answers(told, 2))
        ends = np.cumsum(out.lengths)
        first = ends - out.lengths
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        edge[first[out.lengths > 0]] = gone[first[out.lengths > 0]]
        total, spans = (np.concatenate(([0], np.cumsum(x))) for x in (gone, edge))
        kept = [out.data[a:b][~gone[a:b]].tobytes() for a, b in zip(first.tolist(), ends.tolist())]
        ids = [None if x == NO_ID else x for x in out.ids.tolist()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans"]
        columns = [pa.array(x, pa.int64()) for x in (ids, out.lengths, total[ends] - total[first], spans[ends] - spans[first])]
        return pa.table([*columns, pa.array(kept, pa.binary())], names=[*names, "kept"])

    ranked = written(
        table.mapInArrow(sample, "block long, bucket int, grams binary").groupBy("bucket").applyInArrow(rank, answer_sql), "ranks"
    )
    asked = table.groupBy("block").cogroup(ranked.groupBy("block")).applyInArrow(
        ask, "block long, bucket int, tops binary, counts binary, places binary, leasts binary, texts binary"
    )
    settled = written(asked.groupBy("bucket").applyInArrow(settle, answer_sql), "settled")
    told = ranked.unionByName(settled)
    return table.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def brute_force(rows: list[tuple[int | None, str | None]], length: int = LENGTH) -> list[tuple]:
    """The rows of without_repeats() with kept's SHA-256, string by string: for small fixtures."""
    texts = [(NO_ID if i is None else i, (t or "").encode()) for i, t in rows]
    least: dict[bytes, int] = {}
    for i, t in texts:
        for k in range(len(t) - length + 1):
            s = t[k : k + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for (doc, _), (i, t) in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if least[t[k : k + length]] < i:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
