"""N-gram Jaccard join by prefix trees: components of documents whose shingle sets are similar enough.

Shingles have one global order, rare ones first. Sets as similar as asked share one of their first
few shingles, so only sets that meet at such a shingle are compared; there a trie of the
ordered sets is traversed once for each set, overlaps are shared along common paths, and
subtrees go whose remaining length can't reach the overlap any more, or that hold only what is
already known to be in the same component. So a group of thousands of near copies costs about a look each
and never its pairs, while any pair in different components is still compared exactly.

1. Equal sets are one unit. Very frequent shingles are counted (lossy counting over all rows) and put last.
2. Each unit's prefix. Shingles that stand in the prefixes of two units or more are kept; prefixes are a little longer than
   one common shingle needs, so similar sets share several: a unit with fewer shared ones has no partner and goes, and of the
   others' only the rarest are needed for two similar sets to meet once. Passages that many texts hold fall out here.
3. A first round: each unit goes to a few of its shared shingles. Most links are found here.
4. The last round: all shingles whose units are still in different components. Units that such shingles tie together are
   one cell if they fit into it. Of larger ties each shingle's units are dealt to cells of bounded size, in blocks that meet
   pairwise; blocks of one and the same component don't meet.

The first round is for speed, the last for completeness: no link is lost, whatever the first finds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, given_back, small, small_batches
from .components import connected_components
from .simhash import shingle_hashes, simhash

#: Lossy counting: shingles counted at a time, the least count that is reported, and how many frequent ones are told to all tasks (3 MB).
COUNTED, REPORTED, FREQUENT = 1 << 21, 16, 200_000
#: Shingles of a cell's sets, and what a trie reads of an edge at a time.
CELL, EDGE = 2_000_000, 32
#: Edges of components that one task joins, counted first; more take rounds over many tasks.
FEW = 100_000
#: Per cent of a set by which prefixes are longer than one common shingle needs, and which similar sets then share there.
MEETING = 10
_SIGNED = pa.int64()


def _digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, words: int, seed: int, fingerprint: bool = False, counted: int = COUNTED, reported: int = REPORTED) -> DataFrame:
    """docs(doc_id, text, key) -> doc_id, key, digest and n of the set, fp; and between them rows of frequent shingles: shingle, times.

    key is a hash of the text. The counts of a task's every `counted` shingles are told if they are
    `reported` at least.
    """

    def told(sets: list[np.ndarray]) -> pa.RecordBatch:
        values, times = np.unique(np.concatenate(sets), return_counts=True)
        many = times >= reported
        n = int(many.sum())
        none = [pa.nulls(n, t) for t in (_SIGNED, _SIGNED, pa.binary(), _SIGNED, _SIGNED)]
        return pa.RecordBatch.from_arrays([*none, pa.array(values[many].view(np.int64)), pa.array(times[many])], ["doc_id", "key", "digest", "n", "fp", "shingle", "times"])

    def run(batches):
        sets, size = [], 0
        for batch in batches:
            digests, ns, fps = [], [], []
            for x in batch.column(1):
                h = shingle_hashes(x.as_py(), words, seed)
                own = np.unique(h)
                digests.append(_digest(own))
                ns.append(len(own))
                fps.append(simhash(h) if fingerprint else 0)
                sets.append(own)
                size += len(own)
                if size >= counted:
                    yield told(sets)
                    sets, size = [], 0
            n = len(ns)
            columns = [batch.column(0), batch.column(2), pa.array(digests, pa.binary()), pa.array(ns, _SIGNED), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.nulls(n, _SIGNED), pa.nulls(n, _SIGNED)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "digest", "n", "fp", "shingle", "times"])
        if sets:
            yield told(sets)

    return docs.select("doc_id", "text", "key").mapInArrow(given_back(run), "doc_id long, key long, digest binary, n long, fp long, shingle long, times long")


class Order:
    """The global order: shingles by hash (63 bits), then the frequent ones, the most frequent last."""

    def __init__(self, found: DataFrame, most: int = FREQUENT):
        times = found.where("shingle is not null").groupBy("shingle").agg(F.sum("times").alias("times"))
        top = times.orderBy(F.desc("times"), "shingle").limit(most).toArrow()
        shingles = top.column("shingle").to_numpy().view(np.uint64)[::-1]
        by_value = np.argsort(shingles)
        self.shared = found.sparkSession.sparkContext.broadcast((shingles[by_value], by_value.astype(np.uint64)))

    def __call__(self, own: np.ndarray) -> np.ndarray:
        """Distinct shingle hashes -> their codes, in the order."""
        values, rank = self.shared.value
        codes = own >> np.uint64(1)
        if len(values):
            at = np.minimum(np.searchsorted(values, own), len(values) - 1)
            usual = values[at] == own
            codes = np.where(usual, np.uint64(1 << 63) + rank[at], codes)
        return np.unique(codes)


def _coded(docs: DataFrame, words: int, seed: int, order: Order, percent: int | None) -> DataFrame:
    """docs(text) -> digest, codes: each set once a task, in the order; with percent only the prefix."""

    def run(batches):
        seen = set()
        for batch in batches:
            digests, codes = [], []
            for x in batch.column(0):
                own = np.unique(shingle_hashes(x.as_py(), words, seed))
                digest = _digest(own)
                if len(own) and digest not in seen:
                    seen.add(digest)
                    code = order(own)
                    digests.append(digest)
                    codes.append((code if percent is None else code[: prefix(len(code), percent)]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(codes, pa.list_(_SIGNED))], ["digest", "codes"])

    return docs.select("text").mapInArrow(given_back(run), "digest binary, codes array<long>")


def meeting(n: int) -> int:
    """How many shingles the prefixes of two sets of n or more share, if these are similar enough."""
    return 1 + n * MEETING // 100


def prefix(n: int, percent: int) -> int:
    """A prefix of a set of n that shares meeting(m) shingles with that of any similar set, m being the smaller size.

    Two sets of an overlap of o share k of their first (size - o + k) shingles, in any order common to both.
    """
    return n - (percent * n + 99) // 100 + meeting(n)


class Trie:
    """Ordered sets as a trie with edges of up to EDGE shingles; leaves are the sets in lexicographic order."""

    def __init__(self, sets: list[np.ndarray], edge: int = EDGE):
        """sets: ascending local numbers below 2 ** 32, none empty."""
        self.order = sorted(range(len(sets)), key=lambda k: sets[k].astype(">u4").tobytes())
        self.rows = [sets[k] for k in self.order]
        self.sizes = np.array([len(x) for x in self.rows])
        self.flat = np.concatenate(self.rows)
        offset = np.cumsum(self.sizes) - self.sizes
        parts = []  # parent, depth above, depth, first leaf, past leaf, leaf or -1

        def chain(parent: int, low: int, high: int, first: int, past: int, leaf: int) -> int:
            at = low
            while True:
                to = min(at + edge, high)
                parts.append((parent, at, to, first, past, leaf if to == high else -1))
                parent, at = len(parts) - 1, to
                if to == high:
                    return parent

        shared = [0] + [self._common(a, b) for a, b in zip(self.rows, self.rows[1:])] + [0]
        todo = [(-1, 0, 0, len(self.rows))]
        while todo:
            parent, depth, first, past = todo.pop()
            # Sets of [first, past) agree up to depth; where they part decides the children.
            inner = np.array(shared[first + 1 : past], int)
            cuts = [first, *(first + 1 + np.flatnonzero(inner == depth)).tolist(), past] if len(inner) else [first, past]
            for a, b in zip(cuts, cuts[1:]):
                if b - a == 1:
                    chain(parent, depth, len(self.rows[a]), a, b, a)
                else:
                    low = min(shared[a + 1 : b])
                    todo.append((chain(parent, depth, low, a, b, -1), low, a, b))
        up, above, depth, first, past, leaf = map(np.array, zip(*parts))
        by_parent = np.argsort(up, kind="stable")
        self.above, self.depth, self.first, self.past, self.leaf = above, depth, first, past, leaf
        self.child = by_parent
        self.begin = np.searchsorted(up[by_parent], np.arange(-1, len(up)), "left")
        self.end = np.searchsorted(up[by_parent], np.arange(-1, len(up)), "right")
        self.start = offset[first] + above  # an edge's shingles are its first leaf's
        self.last = self.flat[np.maximum(offset[first] + depth - 1, 0)]
        self.least = np.array([self.sizes[a:b].min() for a, b in zip(first, past)])
        self.most = np.array([self.sizes[a:b].max() for a, b in zip(first, past)])

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        apart = np.flatnonzero(a[:n] != b[:n])
        return int(apart[0]) if len(apart) else n

    @staticmethod
    def _spans(low: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)

    def similar(self, probe: np.ndarray, mark: np.ndarray, percent: int, beyond: int, known: np.ndarray | None) -> np.ndarray:
        """Leaves past `beyond` that are similar to the probe, whose shingles are set in mark; nodes in known are passed over."""
        size, found = len(probe), []
        nodes, overlap = np.array([-1]), np.zeros(1, int)
        while len(nodes):
            n = self.end[nodes + 1] - self.begin[nodes + 1]
            overlap = np.repeat(overlap, n)
            nodes = self.child[self._spans(self.begin[nodes + 1], n)]
            keep = self.past[nodes] > beyond
            if known is not None:
                keep &= ~known[nodes]
            nodes, overlap = nodes[keep], overlap[keep]
            if not len(nodes):
                break
            n = self.depth[nodes] - self.above[nodes]
            hits = np.concatenate(([0], np.cumsum(mark[self.flat[self._spans(self.start[nodes], n)]])))
            past = np.cumsum(n)
            overlap = overlap + hits[past] - hits[past - n]
            # The best that a set below can reach, at the size that suits it best.
            rest = size - np.searchsorted(probe, self.last[nodes], "right")
            best = np.clip(self.depth[nodes] + rest, self.least[nodes], self.most[nodes])
            reach = overlap + np.minimum(best - self.depth[nodes], rest)
            keep = (100 + percent) * reach >= percent * (best + size)
            nodes, overlap = nodes[keep], overlap[keep]
            leaf = self.leaf[nodes] >= 0
            found.append(self.leaf[nodes[leaf]])
            nodes, overlap = nodes[~leaf], overlap[~leaf]
        return np.concatenate(found) if found else np.zeros(0, int)

    def alike(self, label: np.ndarray) -> np.ndarray:
        """For each node the label that all its leaves have, or -1."""
        change = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        return np.where(change[self.past - 1] == change[self.first], label[self.first], -1)


def linked(sets: list[np.ndarray], label: np.ndarray, percent: int, other: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Enough links (places in sets) to join every component: none within a label. With other (True: second side) only links across."""
    values = np.unique(np.concatenate(sets))
    local = [np.searchsorted(values, x) for x in sets]
    label = np.unique(label, return_inverse=True)[1]
    stored = np.arange(len(sets)) if other is None else np.flatnonzero(other)
    probes = stored if other is None else np.flatnonzero(~other)
    if not len(stored) or not len(probes):
        return []
    trie, mark = Trie([local[k] for k in stored]), np.zeros(len(values), bool)
    leaves = stored[trie.order]
    now = trie.alike(label[leaves])
    out = []
    for at, k in enumerate(leaves) if other is None else ((-1, k) for k in probes):
        mark[local[k]] = True
        found = trie.similar(local[k], mark, percent, at + 1, now == label[k])
        mark[local[k]] = False
        new = leaves[found]
        _, one = np.unique(label[new], return_index=True)
        new = new[one][label[new[one]] != label[k]]
        if len(new):
            out += [(int(k), int(x)) for x in new]
            label[np.isin(label, label[new])] = label[k]
            now = trie.alike(label[leaves])
    return out


def _cells_joined(dealt: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """dealt(token, low, high, block, unit, component), sets(unit, codes) -> links u, v; a cell is token, low and high."""

    def run(table: pa.Table) -> pa.Table:
        unit, place = np.unique(table.column("unit").to_numpy(), return_index=True)
        codes = table.column("codes").combine_chunks()
        own = [codes[int(k)].values.to_numpy().view(np.uint64) for k in place]
        label = table.column("component").to_numpy()[place]
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        other = None if low == high else np.array(table.column("block").to_pylist(), object)[place] == high
        found = linked(own, label, percent, other)
        u, v = (np.array([unit[x[side]] for x in found], np.int64) for side in (0, 1))
        return pa.table({"u": pa.array(u, _SIGNED), "v": pa.array(v, _SIGNED)})

    return dealt.join(sets, "unit").groupBy("token", "low", "high").applyInArrow(run, "u long, v long")


def _shared(postings: DataFrame) -> DataFrame:
    """postings(unit, n, token), each once -> those whose token has another unit too: one look at both neighbours in order."""
    order = Window.partitionBy("token").orderBy("unit")
    near = postings.withColumns({"before": F.lag("unit").over(order), "after": F.lead("unit").over(order)})
    return near.where("before is not null or after is not null").drop("before", "after")


def _first_cells(shared: DataFrame, cell: int) -> DataFrame:
    """Each unit at two of its shared shingles, those of least and greatest hash; a shingle's units in blocks that don't meet."""
    hashed = shared.select("token", "unit", "n", F.struct(F.xxhash64("token").alias("h"), "token").alias("by"))
    parts = hashed.groupBy("unit").agg(F.min("by").alias("b1"), F.max("by").alias("b2"), F.first("n").alias("n"))
    picked = parts.select("unit", "n", F.explode(F.array_distinct(F.array("b1.token", "b2.token"))).alias("token"))
    blocks = picked.groupBy("token").agg(F.ceil(F.sum("n") / cell).alias("blocks"), F.count("*").alias("units")).where("units > 1")
    dealt = picked.join(blocks, "token").select("token", "unit", F.pmod(F.xxhash64("unit", "token"), F.col("blocks")).cast("string").alias("block"))
    return dealt.select("token", F.col("block").alias("low"), F.col("block").alias("high"), "block", "unit", F.col("unit").alias("component"))


def _last_cells(shared: DataFrame, nodes: DataFrame, cell: int, scratch: Scratch) -> DataFrame:
    """Cells of all shingles whose units are in different components: every two of these meet in some cell."""
    at = shared.join(nodes, shared.unit == nodes.node, "left").select("token", "unit", "n", F.coalesce("component", "unit").alias("component"))
    mixed = at.groupBy("token").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("units"), F.sum(F.xxhash64("unit").cast("decimal(38,0)")).alias("who"), F.sum("n").alias("size")).where("a < b")
    once = mixed.groupBy("units", "who").agg(F.min(F.struct("token", "size")).alias("t")).select("t.*")  # shingles with the same units are one
    at = scratch.written(at.join(once.select("token", "size"), "token"), "mixed")
    # Units that shingles tie together, if they fit into a cell: each goes there once, not once a shingle.
    first = at.groupBy("token").agg(F.min("unit").alias("hub"))
    tied = scratch.written(connected_components(at.join(first, "token").select(F.col("unit").alias("u"), F.col("hub").alias("v")), few=FEW), "tied")
    members = at.select("unit", "n", F.col("component").alias("own")).distinct().join(tied, at.unit == tied.node).select("unit", "n", F.col("own").alias("component"), F.col("component").alias("cluster"))
    fits = members.groupBy("cluster").agg(F.sum("n").alias("all")).where(F.col("all") <= cell).select("cluster")
    members = scratch.written(members.join(fits, "cluster"), "clusters")
    clusters = members.select(F.col("cluster").alias("token"), F.lit("c").alias("low"), F.lit("c").alias("high"), F.lit("c").alias("block"), "unit", "component")
    at = scratch.written(at.join(members.select("unit"), "unit", "left_anti"), "untied")
    whole = at.where(F.col("size") <= cell).select("token", F.lit("").alias("low"), F.lit("").alias("high"), F.lit("").alias("block"), "unit", "component")
    # Beyond a cell's size: components above that size have blocks of their own, the others share blocks.
    large = at.where(F.col("size") > cell)
    weight = large.groupBy("token", "component").agg(F.sum("n").alias("weight"))
    big = F.col("weight") > cell
    rest = weight.groupBy("token").agg(F.ceil(F.coalesce(F.sum(F.when(~big, F.col("weight"))), F.lit(0)) / cell).alias("rest"))
    named = large.join(weight, ["token", "component"]).join(rest, "token")
    own = F.concat_ws(":", "component", F.pmod(F.xxhash64("unit"), F.ceil(F.col("weight") / cell)))
    mine = F.when(big, own).otherwise(F.concat(F.lit("s"), F.pmod(F.xxhash64("component"), F.greatest("rest", F.lit(1)))))
    named = scratch.written(named.select("token", "unit", "component", mine.alias("block"), F.when(big, F.col("component")).alias("alone")), "blocks")
    blocks = named.groupBy("token", F.col("block").alias("other")).agg(F.first("alone").alias("other_alone"))
    meet = named.join(blocks, "token").where("alone is null or other_alone is null or alone <> other_alone")
    meet = meet.select("token", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "unit", "component")
    return clusters.unionByName(whole).unionByName(meet)


def joined(docs: DataFrame, found: DataFrame, percent: int, words: int, seed: int, scratch: Scratch, known=None, cell: int = CELL) -> DataFrame:
    """docs(doc_id, text, key) and their written signatures -> digest, component: every digest of a set of two links or more.

    The components of units are exact. known(units) may give links (u, v) of units that were found
    in another way; they save the first round work.
    """
    order = Order(found)
    rows = found.where("digest is not null and n > 0")
    units = rows.groupBy("digest").agg(F.min("key").alias("key"), F.first("n").alias("n"), F.first("fp").alias("fp"))
    units = scratch.written(units.withColumn("unit", F.monotonically_increasing_id()), "units")

    prefixes = _coded(docs, words, seed, order, percent).groupBy("digest").agg(F.first("codes").alias("codes")).join(units.select("digest", "unit", "n"), "digest")
    shared = scratch.written(_shared(prefixes.select("unit", "n", F.explode("codes").alias("token"))), "shared")
    least = F.expr(f"1 + ((n * {percent} + 99) div 100) * {MEETING} div 100")  # meeting() of the smallest partner
    able = shared.groupBy("unit").agg(F.count("*").alias("times"), F.first("n").alias("n")).where(F.col("times") >= least)
    shared = scratch.written(_shared(shared.join(able.select("unit", (F.col("times") - least).alias("spare")), "unit")), "shared")
    # Similar sets have `least` of these in common, so one of them is among each set's rarest but so many.
    often = shared.groupBy("token").agg(F.count("*").alias("often"))
    rare = shared.join(often, "token").withColumn("place", F.row_number().over(Window.partitionBy("unit").orderBy("often", "token")))
    shared = scratch.written(_shared(rare.where(F.col("place") <= F.col("spare") + 1)), "shared")
    needed = scratch.written(shared.select("unit").distinct().join(units, "unit").select("unit", "digest", "key"), "needed")
    sets = _coded(docs.join(small(needed.select("key").distinct()), "key", "left_semi"), words, seed, order, None)
    sets = scratch.written(sets.join(needed.select("unit", "digest"), "digest").dropDuplicates(["unit"]).select("unit", "codes"), "sets")

    links = _cells_joined(_first_cells(shared, cell), sets, percent)
    if known is not None:
        links = links.unionByName(known(units, sets))
    links = scratch.written(links, "first-links")
    nodes = scratch.written(connected_components(links, few=FEW), "first-components")
    more = _cells_joined(_last_cells(shared, nodes, cell, scratch), sets, percent)
    links = links.unionByName(scratch.written(more, "last-links"))
    nodes = connected_components(links, few=FEW)
    return units.join(nodes, units.unit == nodes.node).select("digest", "component")


def keyed(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("key"))


def similar_sets(docs: DataFrame, percent: int = 85, words: int = 4, seed: int = 42, scratch: Scratch | None = None, cell: int = CELL) -> DataFrame:
    """docs(doc_id, text) -> doc_id, n_shingles long, component_id: the least doc_id reachable over links.

    Texts are split at ASCII white space, A-Z lower-cased. A document's set is its distinct shingles
    of `words` words; with fewer words the whole sequence is one; without words, or with a null text,
    it is empty and linked with nothing, a component of its own. Two documents link when 100 *
    intersection >= percent * union (64-bit hashes stand for shingles, 63 bits in the trie). Documents with
    equal sets are linked. A repeated doc_id keeps its rows, each with its own text's component; a null one
    never names a component that has another member. Other columns aren't read. An empty table
    gives none. A worker holds a text's hashes: 40 bytes for each of the words of the longest text.
    """
    scratch = scratch or Scratch()
    small_batches(docs.sparkSession)
    docs = keyed(docs)
    found = scratch.written(signatures(docs, words, seed), "signatures")
    components = scratch.written(joined(docs, found, percent, words, seed, scratch, cell=cell), "components")
    return named(found, components)


def named(found: DataFrame, components: DataFrame) -> DataFrame:
    """signatures and the components of linked digests -> doc_id, n_shingles, component_id."""
    rows = found.where("digest is not null").select("doc_id", "digest", F.col("n").alias("n_shingles"))
    each = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("least")).join(components, "digest", "left")
    least = each.where("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    names = each.join(least, "component", "left").select("digest", F.coalesce("component_id", "least").alias("component_id"))
    full = rows.where("n_shingles > 0").join(names, "digest").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
