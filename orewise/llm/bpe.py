"""BPE encoding and decoding, long texts by tree concatenation.

A long text is cut into leaves of a fixed number of characters, wherever the cuts fall;
leaves are encoded in parallel, each as if it stood alone. Two neighbours are joined by
encoding a window around their cut anew, which grows on either side until its ids agree
exactly with the neighbour's own at some place; what lies beyond is settled. Joins go up
as a tree.

Why one agreed piece is enough: pieces of words depend only on what follows their start,
and within a word a sequence of ids is the word's encoding if and only if each two
neighbouring ids are the encoding of their own characters. A piece that both encodings
have at the same place has its left neighbour from one and its right neighbour from the
other, so all pairs hold. White space is not needed anywhere.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from functools import lru_cache
from itertools import compress
from operator import not_
from string import punctuation
from typing import NamedTuple
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import given_back, small_batches

#: Characters of a leaf; longer texts are cut. Four ids a character still have 16-bit places.
LEAF_CHARS = 16_000
#: Characters that are encoded in one call, so that memory doesn't follow the batch.
BLOCK_CHARS = 200_000
#: Characters of the first window on either side of a cut.
WINDOW = 32
#: What a cut can change on its left: characters of the longest special token. On its right, an apostrophe's suffix.
MARGIN, SUFFIX = 16, 4
# The normalizer and pre-tokenizer that the tree and the memory of runs are made for.
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(4)
def can_be_cut(path: str) -> bool:
    """The file's texts may be encoded in parts: its normalizer, words and model are those known here.

    Other files' texts are encoded whole, each by one call.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], (file.get("pre_tokenizer") or {}).get("pretokenizers", [])
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))
    marks = all(len(t["content"]) <= MARGIN and not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) for t in file["added_tokens"])
    return (
        model["type"] == "BPE" and plain and marks and file.get("post_processor") is None
        and (file.get("normalizer") or {}).get("normalizers") == NORMALIZER
        and [x["type"] for x in split] == ["Split", "ByteLevel"]
        and split[0]["pattern"] == {"Regex": WORDS} and split[0]["behavior"] == "Removed" and split[0]["invert"]
        and not split[1]["add_prefix_space"] and not split[1]["use_regex"]
    )


def _plain(run: str) -> tuple[str, str]:
    """A run's body, folded if it is ASCII, and the ASCII punctuation at its end."""
    if "<|" in run:
        return run, ""
    body = run.rstrip(punctuation)
    last = body[-1:]
    if not (last.isascii() and last.isalnum()):
        body = run  # a letter beyond ASCII may end in a mark when normalized, which belongs to the punctuation
    return body.lower() if body.isascii() else body, run[len(body) :]


class Runs:
    """A tokenizer's ids by runs between white space, which no id crosses: each run is encoded
    once while it is remembered. Long runs aren't remembered, and at LIMIT runs all are forgotten.

    A new run is looked up by its plain form: the tokenizer folds ASCII case, and punctuation that
    ends a run after an ASCII letter or digit is a piece of its own."""

    LIMIT, LONGEST = 1_000_000, 64  # some 200 bytes a run

    def __init__(self, tok):
        self.tok, self.known = tok, {"": b""}

    def lists(self, texts: list[str]) -> list[tuple[list[str], list[bytes]]]:
        """The runs of each text, one for each white space and one more, and their ids as little-endian unsigned 32-bit integers."""
        runs = [x.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for x in texts]
        ids = [list(map(self.known.get, x)) for x in runs]
        missing: set[str] = set()
        for x, found in zip(runs, ids):
            missing.update(compress(x, map(not_, found)))
        new = {x: _plain(x) for x in missing.difference([""])}
        ask = list({part for x in new.values() for part in x}.difference(self.known))
        for run, found in zip(ask, self.tok.encode_batch_fast(ask, add_special_tokens=False)):
            self.known[run] = array("I", found.ids).tobytes()
        for run, (body, end) in new.items():
            self.known[run] = self.known[body] + self.known[end]
        out = [(x, found if all(found) else list(map(self.known.__getitem__, x))) for x, found in zip(runs, ids)]
        for run in {*new, *ask}:
            if len(run) > self.LONGEST:
                del self.known[run]
        if len(self.known) > self.LIMIT:
            self.known = {"": b""}
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return [b"".join(ids) for _, ids in self.lists(texts)]


@lru_cache(4)
def remembered(path: str) -> Runs:
    assert sys.byteorder == "little" and array("I").itemsize == 4
    return Runs(tokenizer(path))


class Encoded(NamedTuple):
    """Characters start to end of a text, encoded as if they stood alone: ids, and the places where
    a chunk of whole characters starts, with the number of ids before it (one more at the end)."""

    start: int
    end: int
    ids: np.ndarray
    at: np.ndarray
    before: np.ndarray

    def joined(self, k: int, other: Encoded, j: int) -> Encoded:
        """The first k chunks of this one and the other's from its chunk j on."""
        n, m = int(self.before[k]), int(other.before[j])
        ids = np.concatenate((self.ids[:n], other.ids[m:]))
        return Encoded(self.start, other.end, ids, np.concatenate((self.at[:k], other.at[j:])), np.concatenate((self.before[:k], other.before[j:] - m + n)))

    def chunk(self, k: int) -> np.ndarray:
        return self.ids[self.before[k] : self.before[k + 1]]


def spelled(tok, text: str, start: int) -> Encoded:
    """text, which starts at a place of a longer one, with a chunk wherever an id and a character start together."""
    found = tok.encode(text, add_special_tokens=False)
    places = np.array(found.offsets, np.int64).reshape(-1, 2)
    whole = np.ones(len(places), bool)
    whole[1:] = places[1:, 0] >= np.maximum.accumulate(places[:-1, 1])
    first = np.flatnonzero(whole)
    return Encoded(start, start + len(text), np.array(found.ids, np.uint32), places[first, 0] + start, np.append(first, len(places)))


def leaf(runs: Runs, text: str, start: int = 0) -> Encoded:
    """A leaf: short runs are one chunk each, long ones are spelled."""
    [(parts, ids)] = runs.lists([text])
    chars = np.fromiter(map(len, parts), np.int64, len(parts))
    if chars.max() <= runs.LONGEST:
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        places = start + np.cumsum(chars + 1) - (chars + 1)
        return Encoded(start, start + len(text), np.frombuffer(b"".join(ids), "<u4"), places[n > 0], np.append(0, np.cumsum(n[n > 0])))
    at, ends, here, n = [], [0], start, 0
    for run, x in zip(parts, ids):
        if len(run) > runs.LONGEST:
            long = spelled(runs.tok, run, here)
            at += long.at.tolist()
            ends += (long.before[1:] + n).tolist()
            n = ends[-1]
        elif x:
            n += len(x) // 4
            at.append(here)
            ends.append(n)
        here += len(run) + 1
    return Encoded(start, start + len(text), np.frombuffer(b"".join(ids), "<u4"), np.array(at, np.int64), np.array(ends, np.int64))


def _can_start(char: str) -> bool:
    """A character that no normal form joins to or moves before the one in front of it."""
    return char.isascii() or not (category(char)[0] == "M" or 0x1160 <= ord(char) < 0x1200 or 0xD7B0 <= ord(char) < 0xD800 or 0x16D40 <= ord(char) < 0x16D80)


def _agreed(text: str, one: Encoded, window: Encoded, low: int, high: int) -> tuple[int, int] | None:
    """A chunk of one, between these places, that the window has too with the same ids; its numbers in both."""
    k = int(np.searchsorted(one.at, low))
    while k + 1 < len(one.at) and one.at[k + 1] <= high:
        j = int(np.searchsorted(window.at, one.at[k]))
        nxt = int(np.searchsorted(window.at, one.at[k + 1]))
        if nxt < len(window.at) and window.at[j] == one.at[k] and window.at[nxt] == one.at[k + 1] and _can_start(text[one.at[k]]):
            if np.array_equal(one.chunk(k), window.ids[window.before[j] : window.before[nxt]]):
                return k, j
        k += 1
    return None


def join(tok, text: str, left: Encoded, right: Encoded) -> Encoded:
    """Two neighbours of a text -> one, as if encoded together."""
    cut, before, after = left.end, WINDOW + MARGIN, WINDOW + MARGIN
    while True:
        k = int(np.searchsorted(left.at, cut - before, "right")) - 1
        while k >= 0 and not _can_start(text[left.at[k]]):
            k -= 1
        low = int(left.at[k]) if k >= 0 else left.start
        high = min(cut + after, right.end)
        window = spelled(tok, text[low:high], low)
        a = (0, 0) if low == left.start else _agreed(text, left, window, low + SUFFIX, cut - MARGIN)
        b = (len(right.at), len(window.at)) if high == right.end else _agreed(text, right, window, cut + SUFFIX, high - MARGIN)
        if a and b:
            return left.joined(a[0], window, a[1]).joined(a[0] + b[1] - a[1], right, b[0])._replace(end=right.end)
        before, after = (before if a else 2 * before), (after if b else 2 * after)


def tree(tok, text: str, parts: list[Encoded]) -> np.ndarray:
    """The ids of the whole text from its leaves in order."""
    while len(parts) > 1:
        parts = [join(tok, text, *parts[k : k + 2]) if k + 1 < len(parts) else parts[k] for k in range(0, len(parts), 2)]
    return parts[0].ids


def _blocks(texts: list[str]):
    start = size = 0
    for k, x in enumerate(texts):
        if size and size + len(x) > BLOCK_CHARS:
            yield start, k
            start, size = k, 0
        size += len(x)
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, tokenizer_file: str, decoded: bool = True, leaf_chars: int = LEAF_CHARS, keep: bool = True) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit), decoded.

    ids are those of the tokenizer on the whole text, without added special tokens; decoded
    (null unless asked for) is the tokenizer's decoding of them, special tokens kept. A row
    for a row; a null or empty text has no ids. Only leaves of long texts are shuffled. They
    are told apart by doc_id and the text's SHA-256, so that a task which runs again finds
    the same groups; rows equal in both, null doc_ids too, are encoded once and stay as many.
    Tokenizer files of another make (see can_be_cut) are used too, without leaves. Workers keep the
    runs that they remember for later tasks, unless keep is false: other stages then have the memory.
    """
    schema = "doc_id long, n_tokens long, ids binary, decoded string"
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = can_be_cut(tokenizer_file)
    narrow = "<u2" if 4 * leaf_chars < 1 << 16 else "<u4"
    id_type = "<u2" if tokenizer(tokenizer_file).get_vocab_size() <= 1 << 16 else "<u4"

    def result(tok, ids: list[bytes], doc_ids: pa.Array) -> pa.RecordBatch:
        lists = [np.frombuffer(x, "<u4").tolist() for x in ids] if decoded else []
        texts = tok.decode_batch(lists, skip_special_tokens=False) if decoded else [None] * len(ids)
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(texts, pa.string())],
            ["doc_id", "n_tokens", "ids", "decoded"],
        )

    def short(batches):
        tok = tokenizer(tokenizer_file)
        whole = lambda texts: [array("I", x.ids).tobytes() for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
        ids = remembered(tokenizer_file).encode if cut else whole
        for batch in batches:
            for lo, hi in _blocks(texts := batch.column(1).to_pylist()):
                yield result(tok, ids(texts[lo:hi]), batch.column(0).slice(lo, hi - lo))
        if not keep:
            remembered.cache_clear()

    def leaves(batches):
        runs = remembered(tokenizer_file)
        for batch in batches:
            for k, text in enumerate(batch.column(4)):
                one = leaf(runs, text.as_py())
                found = [one.ids.astype(id_type), np.diff(one.at, prepend=0).astype(narrow), np.diff(one.before).astype(narrow)]
                yield pa.RecordBatch.from_arrays(
                    [*(x.slice(k, 1) for x in batch.columns), *(pa.array([x.tobytes()], pa.binary()) for x in found)],
                    [*batch.schema.names, "ids", "places", "counts"],
                )
        if not keep:
            remembered.cache_clear()

    def whole(group: pa.Table) -> pa.Table:
        group = group.sort_by("part").combine_chunks()
        texts, parts, here = group.column("text").to_pylist(), [], 0
        for k, text in enumerate(texts):
            ids, places, counts = (np.frombuffer(group.column(c)[k].as_py(), t) for c, t in (("ids", id_type), ("places", narrow), ("counts", narrow)))
            at, before = np.cumsum(places, dtype=np.int64) + here, np.append(0, np.cumsum(counts, dtype=np.int64))
            parts.append(Encoded(here, here + len(text), ids.astype(np.uint32), at, before))
            here += len(text)
        tok = tokenizer(tokenizer_file)
        one = result(tok, [tree(tok, "".join(texts), parts).tobytes()], group.column("doc_id").chunk(0).slice(0, 1))
        return pa.Table.from_batches([one.append_column("copies", group.column("copies").chunk(0).slice(0, 1))])

    small_batches(docs.sparkSession)
    if not cut:
        return rows.mapInArrow(given_back(short), schema)
    is_long = F.length("text") > leaf_chars
    slices = F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{leaf_chars}}}"), F.lit(0))
    parts = (
        rows.where(is_long)
        .select("doc_id", F.sha2("text", 256).alias("digest"), F.posexplode(slices).alias("part", "text"))
        .groupBy("doc_id", "digest", "part")
        .agg(F.count("*").alias("copies"), F.first("text").alias("text"))
    )
    encoded = parts.mapInArrow(given_back(leaves), "doc_id long, digest string, part int, copies long, text string, ids binary, places binary, counts binary")
    joined = encoded.groupBy("doc_id", "digest").applyInArrow(whole, schema + ", copies long")
    each = joined.select("doc_id", "n_tokens", "ids", "decoded", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")
    return rows.where(~is_long).mapInArrow(given_back(short), schema).unionByName(each)
