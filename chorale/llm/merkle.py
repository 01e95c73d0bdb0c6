"""A Merkle manifest of a dataset, with proofs from a few stored levels.

Leaves are digests of rows. Each group's leaves, in the order of their keys,
form a tree in which every ``FAN`` consecutive nodes become one; the groups'
roots form a tree of the same shape, whose root stands for the dataset.

Only every ``STEP``-th level is stored. To extract proofs, the nodes of a
stored level meet in aligned subtrees of ``FAN ** STEP`` nodes, whatever the
size of a group. A task computes the levels in between anew, emits for each
node its siblings on the way up, followed by those of its subtree's top, and
forgets them. Work goes down from the roots: the upper part of a proof is handed
on once a subtree, not once a leaf.

Defined results: a null field is ``-`` in its row's digest and differs from an
empty one; rows of null groups are a group of their own, the first; null keys
come first, and rows that share a key are ordered by their digests, so
repeated rows are leaves of their own; texts of any length are
hashed whole; other columns are ignored; an empty table has an empty manifest
without a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chorale.llm.common import equi, ranked
from chorale.session import materialize

# Children of a node, and levels from one stored level to the next.
FAN, STEP = 16, 2
BLOCK = FAN**STEP
# Characters of a digest.
WIDTH = 64
_PATH = "array<struct<left:string,right:string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def field(value: Column) -> Column:
    """How a value enters a digest: ``-`` for null, else its UTF-8 byte count, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row."""
    return F.sha2(F.concat(*map(field, values)), 256)


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def _risen(level: list[str], block: int) -> list[list[str]]:
    """A subtree's levels from its stored nodes to its top."""
    # A first block that is not full is its whole tree, which ends at one node.
    whole = block == 0 and len(level) < BLOCK
    levels = [level]
    for _ in range(STEP):
        if whole and len(levels[-1]) == 1:
            break
        low = levels[-1]
        levels.append([_digest("".join(low[i : i + FAN])) for i in range(0, len(low), FAN)])
    return levels


def _top(key: tuple, nodes: pa.Table) -> pa.Table:
    tree, block = key[0].as_py(), key[1].as_py()
    hashes = nodes.sort_by("at").column("hash").to_pylist()
    return pa.table({"tree": [tree], "at": [block], "hash": [_risen(hashes, block)[-1][0]]})


def _extracted(key: tuple, nodes: pa.Table, above: pa.Table) -> pa.Table:
    """Each stored node of a subtree with its siblings, level by level, and those of the subtree's top."""
    nodes = nodes.sort_by("at")
    levels = _risen(nodes.column("hash").to_pylist(), key[1].as_py())
    upper = above.column("path")[0].as_py()
    runs = [["".join(low[i : i + FAN]) for i in range(0, len(low), FAN)] for low in levels[:-1]]
    left, right, offsets = [], [], [0]
    for i in range(nodes.num_rows):
        at = i
        for joined in runs:
            text, place = joined[at // FAN], at % FAN * WIDTH
            left.append(text[:place])
            right.append(text[place + WIDTH :])
            at //= FAN
        left += [s["left"] for s in upper]
        right += [s["right"] for s in upper]
        offsets.append(len(left))
    sides = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
    path = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), sides).cast(_SIDES)
    out = nodes.drop_columns(["block"])
    for name in ("subroot", "root"):
        out = out.append_column(name, pa.array([above.column(name)[0].as_py()] * nodes.num_rows, pa.string()))
    return out.append_column("path", path)


@dataclass(frozen=True)
class Manifest:
    """Stored levels, leaves first: of the groups' trees, and of the tree of their roots.

    A level has tree, at (place in its level) and hash; leaves also have
    ``row``, what was carried along. The last level of either tree holds its
    roots.
    """

    groups: list[DataFrame]
    roots: list[DataFrame]
    root: str | None


def _stored(leaves: DataFrame, name: str) -> list[DataFrame]:
    levels = [leaves]
    while levels[-1].agg(F.max("at")).first()[0]:
        blocks = levels[-1].select("tree", "at", "hash", F.expr(f"at div {BLOCK}").alias("block"))
        levels.append(materialize(blocks.groupBy("tree", "block").applyInArrow(_top, "tree string, at long, hash string"), name))
    return levels


def build(leaves: DataFrame, group: str, key: str, leaf: str = "leaf", carry: Sequence[str] = ()) -> Manifest:
    """The manifest of ``leaves`` (group, key, leaf, and what proofs carry along)."""
    # Groups by name in byte order, null before all.
    name = F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    rows = leaves.select(
        name.alias("tree"), F.col(leaf).alias("hash"), F.col(key).alias("key"), F.struct(key, *carry).alias("row")
    )
    # Ranking reads its rows twice; texts are hashed once.
    placed = ranked(materialize(rows, "digests"), ["tree"], [F.col("key"), F.col("hash")], "leaves", "at")
    groups = _stored(materialize(placed.select("tree", "at", "hash", "row"), "leaves"), "nodes")
    subroots = groups[-1].select(F.lit("").alias("tree"), "hash", F.col("tree").alias("key"))
    subroots = materialize(ranked(subroots, ["tree"], [F.col("key")], "subroots", "at"), "subroots")
    roots = _stored(subroots, "roots")
    last = roots[-1].first()
    return Manifest(groups, roots, last["hash"] if last else None)


def _down(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the nodes of ``levels[0]``, from those of the last level (``tops``: tree, at, subroot, root, path)."""
    if len(levels) == 1:
        return equi(levels[0], tops, ["tree", "at"])
    for level in reversed(levels[:-1]):
        blocks = level.withColumn("block", F.expr(f"at div {BLOCK}"))
        above = tops.select("tree", F.col("at").alias("block"), "subroot", "root", "path")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in level.schema)
        tops = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(
            _extracted, f"{schema}, subroot string, root string, path {_PATH}"
        )
    return tops


def proofs(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Per leaf: its row, hash, subroot, root and path (siblings left and right of it, level by level).

    With ``wanted`` (one column, named as the key), only subtrees that hold a
    wanted leaf are opened, and only wanted leaves come back.
    """
    none = F.array().cast(_PATH)
    root = F.lit(manifest.root).cast("string")
    last = manifest.roots[-1].select("tree", "at", F.col("hash").alias("subroot"), root.alias("root"), none.alias("path"))
    heads = _down(manifest.roots, last)
    # The roots of the groups are the leaves of the upper tree.
    tops = heads.select(F.col("key").alias("tree"), F.lit(0).cast("long").alias("at"), F.col("hash").alias("subroot"), "root", "path")
    levels = list(manifest.groups)
    if wanted is None:
        return _down(levels, tops)
    key = wanted.columns[0]

    def asked(leaves: DataFrame) -> DataFrame:
        return equi(leaves.withColumn(key, F.col(f"row.{key}")), wanted.distinct(), [key], "left_semi").drop(key)

    block = F.expr(f"at div {BLOCK}").alias("block")
    blocks = materialize(asked(levels[0]).select("tree", block).distinct(), "opened")
    for i, level in enumerate(levels[:-1]):
        levels[i] = level.withColumn("block", block).join(blocks, ["tree", "block"], "left_semi").drop("block")
        blocks = blocks.select("tree", F.expr(f"block div {BLOCK}").alias("block")).distinct()
    return asked(_down(levels, tops))


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """The digest of a path's siblings, in order."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)
