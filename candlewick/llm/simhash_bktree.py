"""SimHash near-duplicates through sharded BK-trees.

Plan: texts -> 64-bit fingerprints (one Arrow pass, texts never shuffled) -> distinct
fingerprints -> shards -> one BK-tree per shard -> links -> components -> documents.

Two fingerprints at most ``r`` bits apart agree on at least one of ``r + 1`` bit bands, so
a shard holds the distinct fingerprints with one value in one band and every link lies
inside some shard.  A shard's tree is data, not a driver variable: it travels by an
equi-join to the blocks of queries of its shard, so neither the driver nor a single task
ever holds all fingerprints.  A shard of over ``tree_size`` fingerprints is cut into several
trees and each is searched by all blocks of the shard.

Inside a tree, a child hangs on its parent by their exact Hamming distance and a search
follows only edges within the radius.  Everything below an edge of at most ``r`` bits is
linked to the parent by construction, so a dense ball of near copies is one labelled
subtree which its own members need not search again: the work there is linear, and
the links that leave a task are one per pair of labels, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import free_names, staged, staged_with
from candlewick.llm.components import star_components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one tree, and (query, node) pairs looked at together.
TREE_SIZE = 1 << 14
FRONTIER = 1 << 21
HASH_CHUNK = 1 << 14
#: Labels with more than this part of all distinct fingerprints (fewer than that many) are joined by a broadcast.
LARGE_LABELS = 1_000
LINKS = "u bigint, v bigint"


def fingerprint(data: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one UTF-8 text: ASCII lower case, words split at ASCII white space,
    shingles with repeats (fewer words: all of them), XXH64 seed 42, strict majority."""
    words = data.lower().split() if data else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.empty_like(ends)
    starts[0], starts[1:] = 0, ends[:-1] + 1
    n = max(1, len(words) - shingle + 1)
    ends = ends[min(shingle, len(words)) - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, HASH_CHUNK):
        cut = zip(starts[at:min(n, at + HASH_CHUNK)].tolist(), ends[at:at + HASH_CHUNK].tolist())
        h = np.array([digest(joined[a:b], SEED) for a, b in cut], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        got = [fingerprint(t, shingle) for t in b.column(1).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(np.array(got, np.uint64).view(np.int64)), b.column(2)], names=["doc_id", "fp", "text_hash"])


def _text_hash() -> Column:
    return F.xxhash64(F.col("text").cast("string"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id bigint, fp bigint, text_hash bigint)`` for every row; null and wordless texts: fp 0."""
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"),
                        _text_hash().alias("text_hash"))
            .mapInArrow(partial(_fingerprint_batches, shingle=shingle), "doc_id bigint, fp bigint, text_hash bigint"))


def _bands(fp: Column, max_bits: int) -> Column:
    """One shard key per bit band (band number in the high bits)."""
    cuts = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    keys = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1).cast("bigint"))
        keys.append(F.struct(F.lit(i).alias("band"), part.alias("value")))
    return F.array(*keys)


class Forest:
    """BK-trees of many shards, built and searched level by level.

    ``fp`` are the distinct fingerprints, ``tree`` the tree number of each.  The first of a
    tree is its root; of those at one distance from a node, the first is its child.
    """

    def __init__(self, fp: np.ndarray, tree: np.ndarray, radius: int):
        n = len(fp)
        self.fp, self.radius = fp, radius
        self.parent, self.edge = np.full(n, -1), np.zeros(n, np.int64)
        self.size = np.bincount(tree)[tree]
        self.levels: list[np.ndarray] = []
        alive, group = np.arange(n), tree
        while alive.size:
            _, first, at = np.unique(group, return_index=True, return_inverse=True)
            node = alive[first]
            if self.levels:
                self.parent[node], self.edge[node] = group[first] // 65, group[first] % 65
            else:
                self.root = node[at]
            self.levels.append(node)
            rest = np.ones(alive.size, bool)
            rest[first] = False
            centre, alive = node[at[rest]], alive[rest]
            group = centre * 65 + np.bitwise_count(fp[alive] ^ fp[centre])
        child = np.flatnonzero(self.parent >= 0)
        key = self.parent[child] * 65 + self.edge[child]
        order = np.argsort(key)
        self.child, self.key = child[order], key[order]
        # Below an edge within the radius, everything is linked to that edge's parent.
        self.near, self.label = np.full(n, -1), np.arange(n)
        for node in self.levels[1:]:
            up = self.parent[node]
            self.near[node] = np.where(self.edge[node] <= radius, up, self.near[up])
            hit = node[self.near[node] >= 0]
            self.label[hit] = self.label[self.near[hit]]
        self._mark()

    def _mark(self) -> None:
        """``uniform[x]``: the whole subtree of x has x's label."""
        self.uniform = np.ones(len(self.fp), bool)
        for node in reversed(self.levels[1:]):
            up = self.parent[node]
            np.logical_and.at(self.uniform, up, self.uniform[node] & (self.label[node] == self.label[up]))

    def build_links(self) -> tuple[np.ndarray, np.ndarray]:
        x = np.flatnonzero(self.near >= 0)
        return self.fp[x], self.fp[self.near[x]]

    def search(self, fps: np.ndarray, root: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs within the radius with different labels, one for each pair of
        labels (queries of label -1: all)."""
        q, v, r = np.arange(len(fps)), root, self.radius
        found = []
        while q.size:
            d = np.bitwise_count(fps[q] ^ self.fp[v]).astype(np.int64)
            hit = (d <= r) & (label[q] != self.label[v])
            found.append((q[hit], v[hit]))
            lo = np.searchsorted(self.key, v * 65 + np.maximum(d - r, 0))
            hi = np.searchsorted(self.key, v * 65 + np.minimum(d + r, 64), "right")
            many = hi - lo
            q = np.repeat(q, many)
            first = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
            v = self.child[first + np.arange(len(q))]
            go = ~(self.uniform[v] & (self.label[v] == label[q]))
            q, v = q[go], v[go]
        q, v = (np.concatenate(x) for x in zip(*found))
        own = np.where(label[q] >= 0, label[q], -1 - q)
        _, first = np.unique(np.stack([own, self.label[v]]), axis=1, return_index=True)
        return q[first], v[first]

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the labels of linked nodes, so that later searches skip more."""
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for x, y in zip(self.label[a].tolist(), self.label[b].tolist()):
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        if up:
            new = np.arange(len(self.fp))
            for x in up:
                new[x] = top(x)
            self.label = new[self.label]
            self._mark()


def _pieces(cost: np.ndarray) -> list[slice]:
    """Consecutive queries whose trees have at most FRONTIER nodes together."""
    cuts = np.flatnonzero(np.diff(np.cumsum(cost) // FRONTIER, prepend=0)).tolist()
    edges = [0, *[c for c in cuts if c], len(cost)]
    return [slice(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row of each."""
    sizes = np.diff(column.offsets.to_numpy())
    return (column.flatten().to_numpy(zero_copy_only=False).view(np.uint64),
            np.repeat(np.arange(len(column)), sizes))


def _link_batches(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Batches of (tree's fingerprints, other block's fingerprints or an empty list); an empty
    list means that the tree's own members are the queries."""
    for b in batches:
        if not b.num_rows:
            continue
        fp, tree = _flat(b.column(0))
        other, of = _flat(b.column(1))
        forest = Forest(fp, tree, radius)
        links = []
        alone = ~np.isin(tree, of)
        if alone.any():
            links.append(tuple(x[alone[np.flatnonzero(forest.near >= 0)]] for x in forest.build_links()))
            own = np.flatnonzero(alone)
            pieces = _pieces(forest.size[own])
            for part in pieces:
                x = own[part]
                q, v = forest.search(fp[x], forest.root[x], forest.label[x])
                links.append((fp[x[q]], fp[v]))
                if len(pieces) > 1:
                    forest.merge(x[q], v)
        if len(other):
            start = np.full(b.num_rows, -1)
            start[tree] = forest.root
            for part in _pieces(np.bincount(tree, minlength=b.num_rows)[of]):
                none = np.full(len(other[part]), -1)
                q, v = forest.search(other[part], start[of[part]], none)
                links.append((other[part][q], fp[v]))
        u, v = (np.concatenate(x).view(np.int64) for x in zip(*links))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def links(fps: DataFrame, max_bits: int = MAX_BITS, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links ``(u, v)`` between the distinct values of ``fps.fp``: pairs of at most ``max_bits``
    different bits, enough of them to connect all that any such pairs connect."""
    shard = (fps.select("fp").distinct()
             .select("fp", F.explode(_bands(F.col("fp"), max_bits)).alias("s"))
             .select("fp", "s.band", "s.value"))
    shard = staged(shard, "simhash-shards")
    large = (shard.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"))
             .filter(F.col("n") > tree_size)
             .select("band", "value", F.ceil(F.col("n") / tree_size).alias("trees")))
    block = (shard.join(large, ["band", "value"], "left")
             .withColumn("part", F.pmod(F.xxhash64("fp"), F.coalesce("trees", F.lit(1))))
             .groupBy("band", "value", "part")
             .agg(F.sort_array(F.collect_list("fp")).alias("fps"), F.max("trees").alias("trees"))
             .filter(F.size("fps") > F.when(F.col("trees").isNull(), 1).otherwise(0)))
    own = block.select("fps", F.expr("CAST(array() AS array<bigint>)").alias("other"))
    cut = block.filter("trees IS NOT NULL").select("band", "value", "part", "fps")
    across = (cut.alias("t").join(cut.alias("q"), ["band", "value"])
              .filter("t.part < q.part").select("t.fps", F.col("q.fps").alias("other")))
    return own.unionByName(across).mapInArrow(partial(_link_batches, radius=max_bits), LINKS)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS, tree_size: int = TREE_SIZE) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text, ...)``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_bits``
    different bits, the row's own included.  Defined cases: null, empty and wordless texts have
    fingerprint 0 and are linked like any other; rows of equal fingerprint are one
    component; repeated rows appear as often as they came; a null doc_id never names a
    component (a component of null ids only has a null id); an empty table gives none;
    other columns are ignored.
    """
    fps, node, comp, large = _components(docs, shingle, max_bits, tree_size)
    comp = comp.select("label", F.col("least.doc_id").alias("component_id"), "n")
    own = F.broadcast(comp.filter(F.col("n") > large).select("label", "component_id"))
    named = (node.join(own, "label").select("fp", "component_id").unionByName(
        node.join(own, "label", "left_anti").join(comp.filter(F.col("n") <= large), "label")
        .select("fp", "component_id")))
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def _components(docs: DataFrame, shingle: int, max_bits: int,
                tree_size: int) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Fingerprints, their labels ``(fp, least, label)``, the labels' smallest rows ``(label, least, n)``, and the
    number of fingerprints beyond which a label is large (fewer than LARGE_LABELS labels are)."""
    fps = staged(fingerprints(docs, shingle), "simhash-fp")
    row = F.struct("doc_id", F.col("fp").alias("own"), "text_hash")
    rep = fps.groupBy("fp").agg(F.coalesce(F.min(F.when(F.col("doc_id").isNotNull(), row)), F.min(row)).alias("least"))
    star = star_components(links(fps, max_bits, tree_size))
    node, seen = staged_with(
        rep.join(star.select(F.col("u").alias("fp"), "v"), "fp", "left")
        .select("fp", "least", F.coalesce("v", "fp").alias("label")), "simhash-labels", n=F.count(F.lit(1)))
    some = F.when(F.col("least.doc_id").isNotNull(), F.col("least"))
    comp = staged(node.groupBy("label").agg(F.coalesce(F.min(some), F.min("least")).alias("least"),
                                            F.count(F.lit(1)).alias("n")), "simhash-components")
    return fps, node, comp, (seen.get("n") or 0) // LARGE_LABELS


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS,
                         max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one its component is named by.

    Of rows that share this doc_id, the one with the smallest fingerprint of the component stays (then the smallest
    hash of its text; of equal rows, one).  Rows without a doc_id are kept: they cannot be named.
    """
    _, _, comp, _ = _components(docs, shingle, max_bits, TREE_SIZE)
    doc, text = free_names(docs, "__keep", "__text")
    keep = (comp.filter("least.doc_id IS NOT NULL")
            .select(F.col("least.doc_id").alias(doc), F.col("least.text_hash").alias(text)).distinct())
    named = docs.filter("doc_id IS NOT NULL").withColumn(text, _text_hash())
    kept = (named.join(keep.withColumnRenamed(text, text + "_"),
                       (named["doc_id"].cast("bigint") == F.col(doc)) & (named[text] == F.col(text + "_")), "left_semi")
            .dropDuplicates(["doc_id", text]).drop(text))
    return kept.unionByName(docs.filter("doc_id IS NULL"))
