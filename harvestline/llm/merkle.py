"""Merkle manifest of a dataset: one 16-ary hash tree a source, one tree over the sources.

A row's leaf is the hash of its fields.  The leaves of a source ascend by
doc_id; every 16 neighbours become their parent until one node, the subroot,
remains.  The subroots in the order of the sources make the root likewise.

A tree is stored as aligned subtrees (blocks) of ``BLOCK_LEVELS`` levels above
their leaves, one row a block: its digests lie in van Emde Boas order, that is
the upper half of the levels first, then each subtree of the lower half, each
split again in the same way, so neighbours in the tree are neighbours in
memory at every scale.  ``address`` computes a node's place; construction and
the retrieval of siblings go by it.  Block roots are the leaves of the next
tier of blocks, until a tree has one block.

``build`` makes and stores the blocks, tier by tier; ``proofs`` hands the
siblings down from the root, tier by tier, and folds every leaf (or what is
given in its place) up to the root again.  A task holds one block at a time
(4,096 leaves), whatever the size of a source.

Defined results: a null field is hashed as ``-`` and differs from an empty
one; a null source is a source of its own, the first; null doc_ids come first
in their source; rows that repeat a doc_id follow one another by digest, and
equal rows are equal leaves; very long texts are hashed whole; a source of
one row is its own subroot; an empty table has no root, no block and no
proof; columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.keys import surrogate_key
from .common import bounded_side, prepare, stored

ARITY = 16
BLOCK_LEVELS = 3
BLOCK_LEAVES = ARITY ** BLOCK_LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCKS = "tree long, n long, block long, root binary, nodes binary, ids array<long>, altered array<binary>"
_PATHS = "tree long, block long, last boolean, subroot string, root string, slots array<int>, siblings array<string>"
_PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def row_digest(**fields: Column) -> Column:
    """The digest of a row's fields, in hexadecimal; ``fields`` replace columns by name."""
    def part(name):
        value = fields.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return F.sha2(F.concat(*[part(name) for name in FIELDS]), 256)


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def tree_size(height: int) -> int:
    """Nodes of a complete tree of ``height`` levels, its leaves included."""
    return (ARITY ** height - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, height: int) -> np.ndarray:
    """Van Emde Boas places of the nodes ``index`` at ``depth`` (root: 0) of a
    complete tree of ``height`` levels."""
    index = np.asarray(index, np.int64)
    at = np.zeros_like(index)
    while height > 1:
        top = height // 2
        if depth < top:
            height = top
        else:
            width = ARITY ** (depth - top)
            at = at + tree_size(top) + index // width * tree_size(height - top)
            index, depth, height = index % width, depth - top, height - top
    return at


@lru_cache(maxsize=64)
def _level(depth: int, height: int) -> np.ndarray:
    return address(depth, np.arange(ARITY ** depth), height)


def levels_for(n: int) -> int:
    """Levels of the tree over ``n`` nodes, the leaves' included."""
    height = 1
    while ARITY ** (height - 1) < n:
        height += 1
    return height


class Subtree:
    """One block: ``n`` leaves, digests as hexadecimal text by address."""

    def __init__(self, n: int, height: int, nodes: bytes | None = None):
        self.n, self.height = n, height
        raw = bytes(32 * tree_size(height)) if nodes is None else nodes
        self.text = np.frombuffer(raw.hex().encode(), np.uint8).reshape(-1, 64).copy()

    @classmethod
    def build(cls, leaves: list[bytes], height: int) -> Subtree:
        block = cls(len(leaves), height)
        at = _level(height - 1, height)[:len(leaves)]
        block.text[at] = np.frombuffer(b"".join(leaves).hex().encode(), np.uint8).reshape(-1, 64)
        for depth in range(height - 2, -1, -1):
            for parent in range(block.count(depth)):
                node = digest(block.run(depth + 1, parent))
                block.text[_level(depth, height)[parent]] = np.frombuffer(node, np.uint8)
        return block

    def count(self, depth: int) -> int:
        return -(-self.n // ARITY ** (self.height - 1 - depth))

    def run(self, depth: int, parent: int) -> bytes:
        """The children, at ``depth``, of one parent, one after another."""
        end = min(ARITY * (parent + 1), self.count(depth))
        return self.text[_level(depth, self.height)[ARITY * parent:end]].tobytes()

    def node(self, depth: int, index: int) -> bytes:
        return self.text[_level(depth, self.height)[index]].tobytes()

    def nodes(self) -> bytes:
        return bytes.fromhex(self.text.tobytes().decode())

    def paths(self, above: tuple) -> Iterator[tuple]:
        """By leaf: ((slot in its run, the run's others), ...) from the leaf up, then ``above``."""
        def under(depth, index, path):
            if depth == self.height - 1:
                yield path
                return
            members = self.run(depth + 1, index)
            for slot in range(len(members) // 64):
                others = members[:64 * slot] + members[64 * (slot + 1):]
                yield from under(depth + 1, ARITY * index + slot, ((slot, others), *path))
        return under(0, 0, above)


def fold(node: bytes, path: tuple) -> bytes:
    """The root that ``node`` leads to along ``path``."""
    for slot, others in path:
        node = digest(others[:64 * slot] + node + others[64 * slot:])
    return node


def _block_height(n: int) -> int:
    """Levels of a block in a tier of ``n`` nodes."""
    return levels_for(n) if n <= BLOCK_LEAVES else BLOCK_LEVELS + 1


def _build_task(batches: Iterator[pa.RecordBatch]):
    schema = pa.schema([("tree", pa.int64()), ("n", pa.int64()), ("block", pa.int64()), ("root", pa.binary()),
                        ("nodes", pa.binary()), ("ids", pa.list_(pa.int64())), ("altered", pa.list_(pa.binary()))])
    for batch in batches:
        for row in range(batch.num_rows):
            tree, n, block = (batch.column(c)[row].as_py() for c in ("tree", "n", "block"))
            members = batch.column("members")[row].values
            built = Subtree.build(members.field("node").to_pylist(), _block_height(n))
            yield pa.RecordBatch.from_pylist([{
                "tree": tree, "n": n, "block": block, "root": bytes.fromhex(built.node(0, 0).decode()), "nodes": built.nodes(),
                "ids": members.field("id").to_pylist(), "altered": members.field("altered").to_pylist()}], schema)


def _tier(nodes: DataFrame, name: str) -> DataFrame:
    """Stored blocks over ``nodes`` (tree, n, position, node, id, altered)."""
    prepare(nodes.sparkSession)
    width = F.lit(BLOCK_LEAVES)
    grouped = (nodes.groupBy("tree", "n", (F.col("position") - F.pmod("position", width)).alias("first"))
                    .agg(F.sort_array(F.collect_list(F.struct("position", "node", "id", "altered"))).alias("members"))
                    .select("tree", "n", F.expr(f"first div {BLOCK_LEAVES}").alias("block"), "members"))
    return stored(grouped.mapInArrow(_build_task, _BLOCKS), name)


def _tiers(nodes: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """Tiers of blocks, from the leaves up; ``largest`` is the node count of the largest tree."""
    tiers = [_tier(nodes, name)]
    while largest > BLOCK_LEAVES:
        largest = -(-largest // BLOCK_LEAVES)
        upper = tiers[-1].where(F.col("n") > BLOCK_LEAVES).select(
            "tree", F.expr(f"(n + {BLOCK_LEAVES - 1}) div {BLOCK_LEAVES}").alias("n"), F.col("block").alias("position"),
            F.col("root").alias("node"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("altered"))
        tiers.append(_tier(upper, name))
    return tiers


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree: the roots of those blocks that are the only one in their tier."""
    found = [t.where(F.col("n") <= BLOCK_LEAVES).select("tree", "root") for t in tiers]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


@dataclass
class Manifest:
    """The sources, and the stored blocks: tiers of the sources' trees, and of the
    tree over the sources, whose ``ids`` are the sources' trees."""

    sources: DataFrame  # source, tree, n (its rows), position (its place among the sources)
    trees: list[DataFrame]
    top: list[DataFrame]

    def root(self) -> str | None:
        row = _roots(self.top).select(F.lower(F.hex("root"))).first() if self.top else None
        return row and row[0]


def build(docs: DataFrame, altered: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (FIELDS).  ``altered``, a digest in hexadecimal
    or null by row, is kept beside the leaf, for ``proofs`` to fold in its place."""
    prepare(docs.sparkSession)
    known = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.col("source"),
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("place"),
        F.unhex(row_digest()).alias("node"),
        (F.lit(None).cast("binary") if altered is None else F.unhex(altered)).alias("altered"),
        F.monotonically_increasing_id().alias("uid"))  # spreads equal rows over the range partitions
    leaves = surrogate_key(stored(known, "leaves"), ["place", "id", "node", "uid"], "rank", materialize=True)
    # a tree is named by the rank of its first leaf
    sources = leaves.groupBy("place").agg(F.min("source").alias("source"), F.min("rank").alias("tree"), F.count(F.lit(1)).alias("n"))
    sources = stored(surrogate_key(stored(sources, "sources"), ["tree"], "k").select(
        "place", "source", "tree", "n", (F.col("k") - 1).alias("position")), "sources")
    count, largest = sources.agg(F.count(F.lit(1)), F.max("n")).first()
    if not count:
        return Manifest(sources.drop("place"), [], [])
    nodes = leaves.join(bounded_side(sources.select("place", "tree", "n")), "place").select(
        "tree", "n", (F.col("rank") - F.col("tree")).alias("position"), "node", "id", "altered")
    trees = _tiers(nodes, largest, "tree-blocks")
    subroots = _roots(trees).join(bounded_side(sources.select("tree", "position")), "tree").select(
        F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), "position", F.col("root").alias("node"),
        F.col("tree").alias("id"), F.lit(None).cast("binary").alias("altered"))
    return Manifest(sources.drop("place"), trees, _tiers(subroots, count, "top-blocks"))


def _blocks_with_paths(batches: Iterator[pa.RecordBatch]):
    """(row, block, path above it) of joined rows, one at a time."""
    for batch in batches:
        for at in range(batch.num_rows):
            row = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
            above = tuple((slot, others.encode()) for slot, others in zip(row["slots"], row["siblings"]))
            yield row, Subtree(len(row["ids"]), _block_height(row["n"]), row["nodes"]), above


def _hand_down(to_sources: bool):
    """By leaf of a block, its path for the block that it is the root of: one of
    the next tier below, or, from the tree over the sources, the last of a source's tree."""
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("last", pa.bool_()), ("subroot", pa.string()),
                        ("root", pa.string()), ("slots", pa.list_(pa.int32())), ("siblings", pa.list_(pa.string()))])

    def run(batches):
        for row, block, above in _blocks_with_paths(batches):
            out = []
            for i, path in enumerate(block.paths(above)):
                if to_sources:
                    child = {"tree": row["ids"][i], "block": 0, "last": True, "subroot": block.node(block.height - 1, i).decode()}
                else:
                    child = {"tree": row["tree"], "block": BLOCK_LEAVES * row["block"] + i, "last": False, "subroot": row["subroot"]}
                out.append(child | {"root": row["root"], "slots": [s for s, _ in path], "siblings": [o.decode() for _, o in path]})
            yield pa.RecordBatch.from_pylist(out, schema)
    return run


def _prove(batches: Iterator[pa.RecordBatch]):
    for row, block, above in _blocks_with_paths(batches):
        leaves, proofs, folded = [], [], []
        for i, path in enumerate(block.paths(above)):
            leaf = block.node(block.height - 1, i)
            leaves.append(leaf.decode())
            proofs.append(digest(b"".join(others for _, others in path)).decode())
            other = row["altered"][i]
            folded.append(fold(leaf if other is None else other.hex().encode(), path).decode())
        n, root = len(leaves), row["root"]
        yield pa.RecordBatch.from_arrays(
            [pa.array(row["ids"], pa.int64()), pa.array(leaves), pa.array([row["subroot"]] * n), pa.array([root] * n),
             pa.array(proofs), pa.array(folded), pa.array([f == root for f in folded])],
            ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def _joined(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path above each."""
    keyed = blocks.select("tree", "n", "block", (F.col("n") <= BLOCK_LEAVES).alias("last"), "nodes", "ids", "altered")
    return keyed.join(bounded_side(paths), ["tree", "block", "last"]).drop("last")


def proofs(manifest: Manifest) -> DataFrame:
    """One row a leaf: its digest, its source's subroot, the root, the digest of its
    siblings from its run up to the root, and the root that it (or the altered
    digest in its place) folds up to along them."""
    spark = manifest.sources.sparkSession
    paths = spark.createDataFrame([(0, 0, True, None, manifest.root(), [], [])], _PATHS)
    if not manifest.top:
        return spark.createDataFrame([], _PROOFS)
    for k, blocks in reversed(list(enumerate(manifest.top))):
        paths = stored(_joined(blocks, paths).mapInArrow(_hand_down(k == 0), _PATHS), "paths")
    to_sources, lower = paths, None
    for blocks in reversed(manifest.trees):
        above = to_sources if lower is None else to_sources.unionByName(lower)
        if blocks is manifest.trees[0]:
            return _joined(blocks, above).mapInArrow(_prove, _PROOFS)
        lower = stored(_joined(blocks, above).mapInArrow(_hand_down(False), _PATHS), "paths")
