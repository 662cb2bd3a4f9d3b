"""Merkle manifest of a dataset: a tree of digests per source, one over the sources, and a version per changed leaf."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headrace.llm.ordered import with_positions
from headrace.llm.tables import Workspace, ship_library

FANOUT = 16

# Levels that one task works through: an aligned block holds up to 16 ** 3 nodes.
BLOCK_LEVELS = 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_NODES = "tree string, _pos long, _count long, digest string"
_RUNS = "array<struct<left:string,right:string>>"
_PROOFS = "doc_id {0}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows write alike; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(_field, values)), 256)


class BlockTree:
    """The nodes of an aligned block. A version is the number of its root.

    Nodes never change: a changed leaf adds copies of its ancestors, and every other node is
    shared with the versions before.
    """

    def __init__(self, leaves: list[str], levels: int):
        self.digests, self.children, self.levels = list(leaves), [()] * len(leaves), levels
        level = list(range(len(leaves)))
        for _ in range(levels):
            level = [self._node(tuple(level[at:at + FANOUT])) for at in range(0, len(level), FANOUT)]
        (self.root,) = level

    def _node(self, children: tuple[int, ...]) -> int:
        self.digests.append(digest("".join([self.digests[c] for c in children])))
        self.children.append(children)
        return len(self.children) - 1

    def changed(self, leaf: str, position: int, version: int | None = None, levels: int | None = None) -> int:
        """A version with another leaf at a position."""
        version, levels = (self.root, self.levels) if version is None else (version, levels)
        if not levels:
            self.digests.append(leaf)
            self.children.append(())
            return len(self.children) - 1
        slot, rest = divmod(position, FANOUT ** (levels - 1))
        nodes = self.children[version]
        return self._node((*nodes[:slot], self.changed(leaf, rest, nodes[slot], levels - 1), *nodes[slot + 1:]))

    def runs(self, position: int) -> list[tuple[str, str]]:
        """The siblings' digests before and after, from the leaf's level up."""
        found, node = [], self.root
        for level in range(self.levels - 1, -1, -1):
            slot, position = divmod(position, FANOUT ** level)
            nodes = self.children[node]
            found.append(tuple("".join([self.digests[c] for c in side]) for side in (nodes[:slot], nodes[slot + 1:])))
            node = nodes[slot]
        return found[::-1]


def height(count: int) -> int:
    """Levels above `count` nodes."""
    levels = 0
    while count > 1:
        count, levels = -(-count // FANOUT), levels + 1
    return levels


def _block(nodes: pa.Table, levels: int) -> tuple[pa.Table, BlockTree]:
    nodes = nodes.sort_by("_pos")
    return nodes, BlockTree(nodes["digest"].to_pylist(), min(levels, height(nodes["_count"][0].as_py())))


def _in_blocks(nodes: DataFrame, levels: int):
    return nodes.groupBy("tree", F.expr(f"_pos div {FANOUT ** levels}").alias("_block"))


def climb(work: Workspace, nodes: DataFrame, levels: int = BLOCK_LEVELS) -> list[DataFrame]:
    """The nodes, the roots of their blocks, the roots of those blocks' blocks, up to one row per tree.

    Each step groups 16 ** levels neighbours in a task and leaves one row of them.
    """
    size = FANOUT ** levels

    def parent(nodes: pa.Table) -> pa.Table:
        nodes, block = _block(nodes, levels)
        return pa.table({"tree": nodes["tree"][:1], "_pos": [nodes["_pos"][0].as_py() // size],
                         "_count": [-(-nodes["_count"][0].as_py() // size)], "digest": [block.digests[block.root]]})

    steps = [nodes]
    while (steps[-1].agg(F.max("_count")).first()[0] or 0) > 1:
        steps.append(work.save(_in_blocks(steps[-1].select("tree", "_pos", "_count", "digest"), levels)
                               .applyInArrow(parent, _NODES)))
    return steps


def _paths(nodes: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    if not nodes.num_rows:
        return pa.table({"tree": pa.array([], pa.string()), "_pos": pa.array([], pa.int64()),
                         "path": pa.array([], _RUN_TYPE), "subroot": pa.array([], pa.string()),
                         "root": pa.array([], pa.string())})
    nodes, block = _block(nodes, levels)
    rest = [(run["left"], run["right"]) for run in above["path"][0].as_py()]
    paths = [[{"left": a, "right": b} for a, b in block.runs(i) + rest] for i in range(nodes.num_rows)]
    same = {name: pa.repeat(above[name][0], nodes.num_rows) for name in ("subroot", "root")}
    return pa.table({"tree": nodes["tree"], "_pos": nodes["_pos"], "path": pa.array(paths, _RUN_TYPE), **same})


_RUN_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def descend(work: Workspace, steps: list[DataFrame], top: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """The path, the siblings on the way up, of every node of the first step.

    `top` has the path, subroot and root of the nodes above the last step. A block's root hands its path
    down to the nodes in it, one step a time.
    """
    paths = top
    for nodes in reversed(steps):
        below = _in_blocks(nodes, levels).cogroup(paths.groupBy("tree", "_pos"))
        paths = work.save(below.applyInArrow(lambda n, a: _paths(n, a, levels), f"tree string, _pos long, path {_RUNS}, subroot string, root string"))
    return paths


def fold(node: str, path: list[tuple[str, str]]) -> str:
    """The root that a node and the siblings on its way up give."""
    for left, right in path:
        node = digest(left + node + right)
    return node


def _proofs(nodes: pa.Table, above: pa.Table, levels: int) -> pa.Table:
    ids = nodes["doc_id"].type
    if not nodes.num_rows:
        return pa.table({"doc_id": pa.array([], ids), **{name: pa.array([], pa.string()) for name in (
            "leaf", "subroot", "root", "proof_sha256", "folded_root")}})
    nodes, block = _block(nodes, levels)
    path = [(run["left"], run["right"]) for run in above["path"][0].as_py()]
    rest = "".join([left + right for left, right in path])
    unchanged = fold(block.digests[block.root], path)
    proofs, roots = [], []
    for position, leaf in enumerate(nodes["tampered"].to_pylist()):
        runs = block.runs(position)
        proofs.append(digest("".join([left + right for left, right in runs]) + rest))
        # the version's block ends here; its copied ancestors go on among the nodes of the blocks above
        roots.append(unchanged if leaf is None else fold(block.digests[block.changed(leaf, position)], path))
    same = {name: pa.repeat(above[name][0], nodes.num_rows) for name in ("subroot", "root")}
    return pa.table({"doc_id": nodes["doc_id"], "leaf": nodes["digest"], **same, "proof_sha256": proofs,
                     "folded_root": roots})


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def manifest(docs: DataFrame, tampered: Column | None = None, text: Column | None = None,
             levels: int = BLOCK_LEVELS) -> DataFrame:
    """The digest of every document, its proof up to the dataset's root, and what tampering does to it.

    Each source is a tree over its documents by doc_id, nulls first, 16 nodes to a parent; the
    sources' roots, by source, nulls first, are the leaves of one more tree. Where `tampered` is
    true the document's text is `text`: by default where 5 divides the CRC of the id, A-Z in
    lower case. Every tampered leaf is a version of its own that shares all nodes but its
    ancestors; folded_root is that version's root. A task holds a block of 16 ** levels nodes.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified. A null in any
    column is a field of its own kind, and so is an empty text. Documents of one id stand next to each other, by
    digest; equal rows are as many leaves. A null id is never tampered. Other columns are ignored;
    no rows give no rows. Several passes over written tables of digests follow one over the texts.
    """
    spark = docs.sparkSession
    ship_library(spark)
    work = Workspace(spark)
    if tampered is None:
        tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    values = {name: F.col(name) for name in FIELDS}
    other = values | {"text": lower_ascii(F.col("text")) if text is None else text}
    tree = F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit(""))
    leaves = work.save(docs.select(
        tree.alias("tree"), "doc_id", leaf_digest(*values.values()).alias("digest"),
        F.when(tampered, leaf_digest(*other.values())).alias("tampered"), F.monotonically_increasing_id().alias("_row")))
    nodes = work.save(with_positions(work, leaves, "tree", "doc_id", "digest", "_row").drop("_row"))

    steps = climb(work, nodes, levels)
    subroots = steps[-1].select(F.lit("").alias("all"), "tree", "digest")
    sources = with_positions(work, subroots, "all", "tree").select(
        F.col("all").alias("tree"), "_pos", "_count", "digest", F.col("tree").alias("source"))
    sources = work.save(sources)
    upper = climb(work, sources, levels)
    root = upper[-1].select("tree", "_pos", F.array().cast(_RUNS).alias("path"), F.col("digest").alias("subroot"),
                            F.col("digest").alias("root"))
    ways = descend(work, upper[:-1], root, levels)
    top = (sources.join(ways.select("_pos", "path", "root"), "_pos")
           .select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("_pos"), "path",
                   F.col("digest").alias("subroot"), "root"))
    above = descend(work, steps[1:-1], top, levels)
    ids = nodes.schema["doc_id"].dataType.simpleString()
    proofs = (_in_blocks(nodes, levels).cogroup(above.groupBy("tree", "_pos"))
              .applyInArrow(lambda n, a: _proofs(n, a, levels), _PROOFS.format(ids)))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
