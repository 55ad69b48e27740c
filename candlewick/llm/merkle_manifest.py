"""Merkle manifest of a dataset: a persistent hash tree, built and versioned in aligned blocks.

A row is a leaf; the leaves of a group (here: a language) are ordered and numbered, every two consecutive
nodes become one until one is left, and the groups' roots are joined in the same way.

* Leaves are dealt into blocks of 2**LEVELS consecutive numbers.  A block is aligned with the tree, so its root is a
  node of the tree, whatever the other blocks hold.  Blocks of block roots make the next levels, and so on: every
  group that a task sees has at most 2**LEVELS members, and there are log2(n) / LEVELS rounds.
* Inside a block the tree is persistent: changing a leaf makes a version that copies the leaf's ancestors and
  shares every other node with the versions before.  Above the block, a version goes on as one new node per
  level, made from the untouched siblings, which come to the block by an equi-join on its number: the versions
  of a table never meet in one task.

Digests are lower-case hex SHA-256 of the concatenated hex digests of the children.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.common import staged, staged_with

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10
#: A version is made of the leaves whose crc32 of the decimal doc_id this divides.
TAMPER = 7


def join_digests(parts: Sequence[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


class PersistentTree:
    """Binary hash tree over a block's nodes, ``levels`` high; a version is the number of its root.

    Nodes are kept in three lists and never change.  A level's last node without a neighbour has one child.
    """

    def __init__(self, leaves: Sequence[str], levels: int):
        self.digest = list(leaves)
        self.left, self.right = [-1] * len(leaves), [-1] * len(leaves)
        self.levels = levels
        row = list(range(len(leaves)))
        for _ in range(levels):
            row = [self._node(row[i], row[i + 1] if i + 1 < len(row) else -1) for i in range(0, len(row), 2)]
        if len(row) != 1:
            raise ValueError(f"{len(leaves)} leaves have more than {levels} levels")
        self.root = row[0]

    def _node(self, left: int, right: int) -> int:
        self.left.append(left)
        self.right.append(right)
        parts = [self.digest[left], self.digest[right]] if right >= 0 else [self.digest[left]]
        self.digest.append(join_digests(parts))
        return len(self.digest) - 1

    def _down(self, root: int, at: int) -> list[tuple[int, bool]]:
        """(node, goes right) from the root to the leaf at place ``at``."""
        steps, node = [], root
        for level in reversed(range(self.levels)):
            right = bool(at >> level & 1)
            steps.append((node, right))
            node = self.right[node] if right else self.left[node]
        return steps

    def with_leaf(self, root: int, at: int, digest: str) -> int:
        """A new version: the leaf at ``at`` replaced, its ancestors copied, all other nodes shared."""
        self.digest.append(digest)
        self.left.append(-1)
        self.right.append(-1)
        new = len(self.digest) - 1
        for node, right in reversed(self._down(root, at)):
            new = self._node(self.left[node], new) if right else self._node(new, self.right[node])
        return new

    def path(self, root: int, at: int) -> list[str]:
        """The leaf's siblings, from its level up: ``L`` or ``R`` (the sibling's side) and its digest; empty
        where a node has no sibling."""
        out = []
        for node, right in reversed(self._down(root, at)):
            other = self.left[node] if right else self.right[node]
            out.append("" if other < 0 else ("L" if right else "R") + self.digest[other])
        return out


def fold(digest: str, path: Sequence[str]) -> str:
    """The root that a node and the siblings on its path lead to."""
    for step in path:
        digest = join_digests([digest] if not step else [step[1:], digest] if step[0] == "L" else [digest, step[1:]])
    return digest


def levels_in_block(n: int, most: int) -> int:
    """Levels that a block of a group of ``n`` nodes has."""
    return min(most, (n - 1).bit_length())


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of the columns, each as its UTF-8 length, a colon and its text; ``-`` for null."""
    part = lambda c: F.when(c.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))
    return F.sha2(F.concat(*[part(c.cast("string")) for c in columns]).cast("binary"), 256)


def numbered(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows(g, ...)`` with ``pos``, the place (from 0) in the group ``g`` by ``order``, which must be unique there,
    and ``n``, the group's size.

    Rows are dealt into ranges of (g, order); a place is that inside the range, and the sizes of the
    group's earlier ranges.  A group of any size is spread over the ranges.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = staged(rows.repartitionByRange(parts, "g", *order).withColumn("part", F.spark_partition_id()), name)
    sizes = dealt.groupBy("g", "part").agg(F.count(F.lit(1)).alias("size"))
    own, before = Window.partitionBy("g"), Window.partitionBy("g").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = sizes.select("g", "part", F.sum("size").over(own).alias("n"),
                         F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("g", "part").orderBy(*order))
    return (dealt.withColumn("at", inside).join(sizes, ["g", "part"])
            .withColumn("pos", F.col("start") + F.col("at") - 1).drop("part", "start", "at"))


def in_blocks(nodes: DataFrame, most: int, *columns: str) -> DataFrame:
    """``(g, block, n, nodes)``: the nodes (pos and ``columns``) of every block, in order."""
    return (nodes.groupBy("g", F.shiftright("pos", most).alias("block"))
            .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", *columns))).alias("nodes")))


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    for i in range(b.num_rows):  # one block at a time
        yield b.slice(i, 1).to_pylist()[0]


def _root_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = [(r["g"], r["block"], -(-r["n"] // (1 << most)),
                (t := PersistentTree([x["digest"] for x in r["nodes"]], levels_in_block(r["n"], most))).digest[t.root])
               for r in _rows(b)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
            zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["g", "pos", "n", "digest"])


def block_roots(blocks: DataFrame, most: int = LEVELS) -> DataFrame:
    """``(g, pos, n, digest)``: the blocks' roots as nodes, ``most`` levels above the blocks' own."""
    return blocks.mapInArrow(partial(_root_batches, most=most), "g string, pos bigint, n bigint, digest string")


def _path_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for r in _rows(b):
            tree = PersistentTree([x["digest"] for x in r["nodes"]], levels_in_block(r["n"], most))
            k = len(r["nodes"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["g"]] * k, pa.string()), pa.array([x["pos"] for x in r["nodes"]], pa.int64()),
                 pa.array([tree.path(tree.root, i) + r["path"] for i in range(k)], pa.list_(pa.string())),
                 pa.array([r["subroot"]] * k, pa.string()), pa.array([r["root"]] * k, pa.string())],
                names=["g", "pos", "path", "subroot", "root"])


PATHS = "g string, pos bigint, path array<string>, subroot string, root string"


def upwards(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """(the levels' blocks, the one node left of each group) of ``nodes(g, pos, n, digest)``."""
    levels = []
    nodes, seen = staged_with(nodes, name, n=F.max("n"))
    while (seen.get("n") or 0) > 1:
        levels.append(staged(in_blocks(nodes, most, "digest"), f"{name}-blocks"))
        nodes, seen = staged_with(block_roots(levels[-1], most), name, n=F.max("n"))
    return levels, nodes


def downwards(levels: list[DataFrame], top: DataFrame, most: int) -> DataFrame:
    """Paths of the lowest level's nodes, given ``top``, the paths of the groups' last nodes."""
    paths = top
    for blocks in reversed(levels):
        above = paths.withColumnRenamed("pos", "block")
        paths = blocks.join(above, ["g", "block"]).select("g", "n", "nodes", "path", "subroot", "root").mapInArrow(
            partial(_path_batches, most=most), PATHS)
    return paths


def _leaf_batches(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    types = (pa.int64(), *[pa.string()] * 5, pa.bool_())
    for b in batches:
        for r in _rows(b):
            nodes = r["nodes"]
            tree = PersistentTree([x["digest"] for x in nodes], levels_in_block(r["n"], most))
            out = []
            for i, x in enumerate(nodes):
                own = tree.path(tree.root, i)
                if x["tampered"] is None:
                    folded = fold(x["digest"], own + r["path"])
                else:
                    version = tree.with_leaf(tree.root, i, x["tampered"])
                    folded = fold(tree.digest[version], r["path"])
                proof = join_digests([s[1:] for s in own + r["path"]])
                out.append((x["doc_id"], x["digest"], r["subroot"], r["root"], proof, folded, folded == r["root"]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names=names)


def is_tampered(doc_id: Column) -> Column:
    """crc32 of the decimal doc_id is divisible by TAMPER; not for a null one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % TAMPER == 0, F.lit(False))


def manifest(docs: DataFrame, most: int = LEVELS) -> DataFrame:
    """One row for each of ``docs(doc_id, source, lang, n_chars, text)``: its leaf digest, the root of its language
    and of the table, the digest of its proof (siblings from the leaf to the root), and the root that follows from
    these siblings and the leaf, n_chars one larger where :func:`is_tampered` says so.

    Defined cases: a null column is ``-`` in the leaf, a null n_chars stays null when tampered with; null
    languages are a group, before all others; a null doc_id comes first in its group; rows that repeat a doc_id
    are leaves of their own, ordered by digest (equal ones in any order: they are the same); a group of
    one leaf has it as its root, a table of one group that group's; an empty table gives no rows; other columns
    are ignored.  ``most``: levels of a block.
    """
    own = {c: F.col(c) for c in COLUMNS}
    larger = own | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    lang = F.col("lang").cast("string")
    leaves = staged(docs.select(
        F.when(lang.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), lang)).alias("g"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        leaf_digest(list(own.values())).alias("digest"),
        F.when(is_tampered(F.col("doc_id")), leaf_digest(list(larger.values()))).alias("tampered"),
        F.monotonically_increasing_id().alias("row")), "merkle-leaves")
    places = numbered(leaves, ["doc_id", "digest", "row"], "merkle-places")
    blocks = staged(in_blocks(places, most, "digest", "doc_id", "tampered"), "merkle-blocks")
    levels, subroots = upwards(block_roots(blocks, most), most, "merkle-level")

    # The groups' roots are the leaves of one more tree.
    groups = subroots.select(F.lit("").alias("g"), F.col("g").alias("group"), "digest")
    top = staged(numbered(groups, ["group"], "merkle-groups"), "merkle-top")
    top_levels, root = upwards(top.select("g", "pos", "n", "digest"), most, "merkle-top-level")
    root = root.select("g", "pos", F.expr("CAST(array() AS array<string>)").alias("path"),
                       F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    start = downwards(top_levels, root, most).drop("g", "subroot").join(top, "pos").select(
        F.col("group").alias("g"), F.lit(0).cast("bigint").alias("pos"), "path", F.col("digest").alias("subroot"), "root")
    paths = downwards(levels, start, most).withColumnRenamed("pos", "block")
    return blocks.join(paths, ["g", "block"]).select("n", "nodes", "path", "subroot", "root").mapInArrow(
        partial(_leaf_batches, most=most), "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
                       "folded_root string, verified boolean")
