"""Merkle manifest of a dataset as a persistent, path-copying tree.

Every row is a leaf; the leaves of a group, in order, form a tree of runs of 8,
and the groups' roots form another.  Both are cut into aligned blocks of
8^HEIGHT nodes: a task builds the tree of one block, and the block's root is
a node of the table of the next level, until one block is left.  Going down
again, every block gets the path above it: the siblings to the left and to the
right, level by level.  In a leaf block each changed leaf then makes a version
of the block's tree: immutable nodes, of which only the ancestors of the leaf
are copied and all others shared.  The version goes on above the block by
copying the ancestors along the block's path, so the tasks of the upper levels
never see the versions: their work is one node for 4096 leaves.

Digests are sha256 in lowercase hex; a run's digest is that of its nodes' hex
joined.  A partial block beside a full one is raised to the same height (a run
may be of one node).

Defined cases: nulls are encoded as ``-``, a null key sorts first and is never
tampered with; rows of one key are ordered by digest; repeated rows are leaves
of their own (equal ones are interchangeable); a null group is the first
group; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.ranks import ranked
from threadlens.llm.shared import ship, written

FAN, HEIGHT = 8, 4

PATH = "array<struct<left: string, right: string>>"
ARROW_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


class Node(NamedTuple):
    digest: str
    children: tuple["Node", ...]


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def parent(children: tuple[Node, ...]) -> Node:
    return Node(digest("".join([c.digest for c in children])), children)


class Version(NamedTuple):
    """One version of a block's tree."""

    root: Node
    height: int

    @classmethod
    def build(cls, digests: list[str], least: int = 0) -> Version:
        """The tree of a block, raised to a height of ``least``."""
        level, height = [Node(d, ()) for d in digests], 0
        while len(level) > 1 or height < least:
            level = [parent(tuple(level[i: i + FAN])) for i in range(0, len(level), FAN)]
            height += 1
        return cls(level[0], height)

    def replaced(self, at: int, leaf: str) -> Version:
        """The version with another leaf ``at`` a place; it shares every node but the leaf's ancestors."""

        def copy(node: Node, height: int) -> Node:
            if not height:
                return Node(leaf, ())
            i = at // FAN ** (height - 1) % FAN
            below = node.children
            return parent((*below[:i], copy(below[i], height - 1), *below[i + 1:]))

        return Version(copy(self.root, self.height), self.height)

    def path(self, at: int) -> list[dict[str, str]]:
        """Siblings of the place's node, level by level upwards."""
        out, node = [], self.root
        for height in range(self.height, 0, -1):
            i = at // FAN ** (height - 1) % FAN
            out.append({"left": "".join([c.digest for c in node.children[:i]]), "right": "".join([c.digest for c in node.children[i + 1:]])})
            node = node.children[i]
        return out[::-1]


def raised(node: str, path: list[dict[str, str]]) -> str:
    """The root above a path in the version that has ``node`` at its foot."""
    for beside in path:
        node = digest(beside["left"] + node + beside["right"])
    return node


def _tree(key: tuple, rows: pa.Table, height: int) -> Version:
    """The tree of a block's rows in order; a block after the first has the height of a full one."""
    return Version.build(rows["digest"].to_pylist(), height if key[1].as_py() > 0 else 0)


def _block(height: int) -> Column:
    return F.expr(f"pos div {FAN**height} AS block")


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    """(grp, pos, digest) -> (grp, pos, digest) of the roots of the blocks."""
    ship(nodes.sparkSession)

    def root(key: tuple, rows: pa.Table) -> pa.Table:
        tree = _tree(key, rows.sort_by("pos"), height)
        return pa.table({"grp": [key[0].as_py()], "pos": [key[1].as_py()], "digest": [tree.root.digest]})

    return nodes.select("grp", "pos", "digest").groupBy("grp", _block(height)).applyInArrow(root, "grp string, pos long, digest string")


def _levels(nodes: DataFrame, name: str, height: int) -> list[DataFrame]:
    """The node tables of all levels of blocks; the last holds one root per group."""
    out = [nodes]
    while len(out) == 1 or (out[-1].agg(F.max("pos")).first()[0] or 0) > 0:
        out.append(written(_blocks(out[-1], height), f"merkle-{name}"))
    return out


def _together(nodes: DataFrame, above: DataFrame, work: Callable, schema: str, height: int) -> DataFrame:
    """``work`` on each block of ``nodes`` (a tree and its rows by place) and the one row of ``above`` that belongs to it."""
    ship(nodes.sparkSession)

    def run(key: tuple, rows: pa.Table, of: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        return work(rows, _tree(key, rows, height), of.to_pylist()[0])

    return nodes.groupBy("grp", _block(height)).cogroup(above.groupBy("grp", F.col("pos").alias("block"))).applyInArrow(run, schema)


def _paths(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Nodes (grp, pos, digest) and the paths (grp, pos, path) of their blocks -> the paths of the nodes."""

    def down(rows: pa.Table, tree: Version, of: dict) -> pa.Table:
        paths = [tree.path(i) + of["path"] for i in range(rows.num_rows)]
        return pa.table({"grp": rows["grp"], "pos": rows["pos"], "path": pa.array(paths, ARROW_PATH)})

    return _together(nodes.select("grp", "pos", "digest"), above, down, f"grp string, pos long, path {PATH}", height)


def _down(levels: list[DataFrame], top: DataFrame, name: str, height: int) -> DataFrame:
    """Paths (grp, pos, path) of the blocks of ``levels[0]``, from those of the groups' roots."""
    paths = top
    for nodes in reversed(levels[1:-1]):
        paths = written(_paths(nodes, paths, height), f"merkle-paths-{name}")
    return paths


def manifest(leaves: DataFrame, with_path: bool = False, height: int = HEIGHT) -> DataFrame:
    """(grp, id, leaf, changed) -> id, leaf, subroot, root, proof_sha256, folded_root, and the path if asked, of every leaf.

    ``grp`` is a string without nulls; groups are in bytewise order, the leaves
    of one by id (null first), then leaf.  ``changed`` is the leaf's tampered
    digest, or null: then the original leaf is put in again.  ``path`` holds all
    siblings on the way to the root, ``proof_sha256`` is their digest and
    ``folded_root`` the root of the version with the changed leaf.  A task's
    block holds 8^``height`` nodes.
    """
    placed = ranked(leaves, "grp", [F.col("id").asc_nulls_first(), F.col("leaf")], "merkle-leaves").withColumn("digest", F.col("leaf"))
    low = _levels(placed, "groups", height)
    subroots = low[-1].select(F.lit("").alias("all"), F.col("grp").alias("of"), F.col("digest").alias("subroot"))
    tops = written(ranked(subroots, "all", [F.col("of")], "merkle-subroots").select(
        F.col("all").alias("grp"), "pos", "of", F.col("subroot").alias("digest")), "merkle-tops")
    high = _levels(tops, "tops", height)
    top = high[-1].select("grp", F.lit(0).cast("long").alias("pos"), F.array().cast(PATH).alias("path"))
    above = _paths(tops, _down(high, top, "tops", height), height)
    root = F.broadcast(high[-1].select("grp", F.col("digest").alias("root")))  # one row
    above = written(tops.join(above, ["grp", "pos"]).join(root, "grp").select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "path"), "merkle-above")
    paths = _down(low, above.select("grp", "pos", "path"), "groups", height).join(above.select("grp", "subroot", "root"), "grp")

    def versions(rows: pa.Table, tree: Version, of: dict) -> pa.Table:
        upper = of["path"]
        beyond = "".join([s["left"] + s["right"] for s in upper])
        paths = [tree.path(i) for i in range(rows.num_rows)]
        proofs = [digest("".join([s["left"] + s["right"] for s in p]) + beyond) for p in paths]
        new = [c or d for c, d in zip(rows["changed"].to_pylist(), rows["leaf"].to_pylist())]
        folded = [raised(tree.replaced(i, d).root.digest, upper) for i, d in enumerate(new)]
        n = rows.num_rows
        out = {"id": rows["id"], "leaf": rows["leaf"], "subroot": [of["subroot"]] * n, "root": [of["root"]] * n, "proof_sha256": proofs, "folded_root": folded}
        return pa.table({**out, "path": pa.array([p + upper for p in paths], ARROW_PATH)} if with_path else out)

    columns = f"id {dict(placed.dtypes)['id']}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return _together(placed, paths, versions, columns + (f", path {PATH}" if with_path else ""), height)


def encoded(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; ``-`` if null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def row_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """Leaves of a document table, by language; where ``tampered`` holds, ``changed`` is the leaf with A-Z in the text lowered."""
    leaf = lambda text: row_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("grp"), F.col("doc_id").alias("id"),
        leaf(F.col("text")).alias("leaf"), F.when(tampered, leaf(lowered)).alias("changed"))


def op12_merkle_versions(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every document."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = manifest(document_leaves(docs, tampered), height=height).withColumnRenamed("id", "doc_id")
    return out.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))
