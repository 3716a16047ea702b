"""A Merkle manifest of a table: per source a tree over its rows, one root over the sources, a proof per row.

Every row is a leaf, the hash of its columns. Per source the leaves ascend by id; every ``FAN`` consecutive nodes become one
until one is left, the subroot of the source. The subroots, in the order of their sources, form a tree of the same kind.

Trees are cut into superblocks of ``LEVELS`` levels, so that no task holds a source. Upward, each superblock is reduced by
itself, and the nodes that come out are the leaves of the next layer, until every tree has one node; a layer is ``FAN ** LEVELS``
times smaller than the one below. Downward, a superblock is cogrouped with the one row that its node got from the layer above: the
siblings on the way from there to the root. A single applyInPandas call then reduces the superblock again, joins its own
siblings with the outer ones and folds every leaf up to the root. What a task holds is one superblock and one path.

Positions come from one range partitioning of the leaves by source and id: the partitions' counts per source, summed up.
Only hashes, ids and sources are moved; texts are hashed where they are read.

Defined results: nulls are hashed as ``-`` and differ from empty texts. Rows without an id come first in their source, and
the null source before all others. Rows that share an id are ordered by their hashes; equal rows are leaves of their
own. A text of any length is hashed whole. A tree of one leaf has that leaf as its root and a proof of no siblings. An empty table
has no rows and no root. Columns other than those named in ``COLUMNS`` are not hashed.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from .common import stage, whole

#: Nodes that become one, and levels of a superblock.
FAN, LEVELS = 16, 2
#: The columns that make a leaf, in this order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: One row in so many, by the crc32 of its id, is tampered with in a trial.
TAMPERED = 5

#: Bytes of a hash.
SIZE = 32

NODES = "tree string, at long, node binary"
#: ``path`` has two entries a level, what stands left and what stands right of the node, each as hashes back to back.
PATHS = "tree string, block long, path array<binary>, subroot binary, root binary"


def leaf(columns: list[Column]) -> Column:
    """sha256 of the values as text: ``-`` where null, else the number of their UTF-8 bytes, a colon and the value."""
    parts = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))
             for c in columns]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def tampered(text: Column) -> Column:
    """The text with A-Z in lower case. Other letters stay, so ``lower`` is right for ASCII texts only."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def digest(nodes: bytes) -> bytes:
    """The hash of nodes that lie back to back, each taken as hexadecimal text."""
    return sha256(nodes.hex().encode()).digest()


def positions(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``at``, their place in the order within their tree from 0, and ``size``, the number of rows of the tree."""
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    # consecutive within a partition; the upper bits are the partition
    ranged = stage(ranged.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)))
    runs = ranged.groupBy(tree, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    # as many rows as trees and partitions together; of one tree at most as many as partitions
    before = Window.partitionBy(tree).orderBy("_part")
    runs = runs.select(tree, "_part", (F.sum("_n").over(before) - F.col("_n") - F.col("_first")).alias("_shift"),
                       F.sum("_n").over(Window.partitionBy(tree)).alias("size"))
    return ranged.join(runs, [tree, "_part"]).withColumn("at", F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")


def _tree(frame: pd.DataFrame, height: int) -> list[bytes]:
    """A superblock's levels, from its nodes to its top: ``height`` of them, or until one node is left if it is its whole tree."""
    levels, high = [b"".join(frame["node"])], height if int(frame["size"].iloc[0]) > FAN ** height else None
    while len(levels[-1]) > SIZE if high is None else len(levels) <= high:
        last = levels[-1]
        levels.append(b"".join([digest(last[k:k + FAN * SIZE]) for k in range(0, len(last), FAN * SIZE)]))
    return levels


def _reduced(frame: pd.DataFrame, height: int) -> pd.DataFrame:
    top = _tree(frame.sort_values("at", kind="stable"), height)[-1]
    return pd.DataFrame({"tree": [frame["tree"].iloc[0]], "at": [int(frame["block"].iloc[0])], "node": [top]})


def siblings(levels: list[bytes], place: int) -> list[bytes]:
    """What stands left and right of a leaf's node in its run, level by level."""
    out = []
    for level in levels[:-1]:
        first = (place - place % FAN) * SIZE
        out += [level[first:place * SIZE], level[(place + 1) * SIZE:first + FAN * SIZE]]
        place //= FAN
    return out


def fold(node: bytes, path: list[bytes]) -> bytes:
    """The root that a node and its siblings, level by level, lead to."""
    for before, after in zip(path[::2], path[1::2]):
        node = digest(before + node + after)
    return node


def _paths(frame: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    """The siblings on the way to the root for each node of a superblock, which is a superblock of the layer below."""
    frame = frame.sort_values("at", kind="stable")
    levels, above = _tree(frame, height), list(outer["path"].iloc[0])
    return pd.DataFrame({"tree": frame["tree"], "block": frame["at"], "path": [siblings(levels, k) + above for k in range(len(frame))],
                         "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})


def _proofs(frame: pd.DataFrame, outer: pd.DataFrame, height: int) -> pd.DataFrame:
    """Local reduction, joined proof and folding of every leaf of a superblock."""
    frame = frame.sort_values("at", kind="stable")
    levels, above, proofs, folded = _tree(frame, height), list(outer["path"].iloc[0]), [], []
    for k, seen in enumerate(frame["seen"]):
        path = siblings(levels, k) + above
        proofs.append(digest(b"".join(path)).hex())
        folded.append(fold(seen, path).hex())
    root = outer["root"].iloc[0].hex()
    return pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "leaf": [n.hex() for n in frame["node"]], "subroot": outer["subroot"].iloc[0].hex(),
                         "root": root, "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})


def _blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("at") / FAN ** height))


def upward(nodes: DataFrame, height: int = LEVELS) -> list[DataFrame]:
    """Layers of (tree, at, node, size, ...), each made of the superblocks of the one before; in the last, every tree has one node."""
    layers = [nodes]
    while layers[-1].filter("size > 1").limit(1).count():
        here = layers[-1].select("tree", "at", "node", "size")
        several = _blocks(here.filter("size > 1"), height)
        sizes = several.groupBy("tree").agg((F.floor((F.max("size") - 1) / FAN ** height) + 1).alias("size"))
        up = several.groupBy("tree", "block").applyInPandas(lambda frame: _reduced(frame, height), NODES)
        layers.append(stage(up.join(sizes, "tree").unionByName(here.filter("size = 1"))))
    return layers


def _cogrouped(nodes: DataFrame, outer: DataFrame, make: Callable, schema: str | StructType, height: int) -> DataFrame:
    """``make`` of each superblock and the one row that its top has from above."""
    keyed = outer.withColumnsRenamed({"tree": "_tree", "block": "_block"})
    return _blocks(nodes, height).groupBy("tree", "block").cogroup(keyed.groupBy("_tree", "_block")).applyInPandas(
        lambda frame, above: make(frame, above, height), schema)


def downward(layers: list[DataFrame], top: DataFrame, height: int = LEVELS) -> DataFrame:
    """(tree, block, path, subroot, root) for the superblocks below ``layers``, whose last one has one node per tree."""
    for nodes in reversed(layers):
        # a tree of one node has nothing to add
        single = top.join(nodes.filter("size = 1").select("tree"), "tree", "left_semi")
        several = top.join(nodes.filter("size > 1 AND at = 0").select("tree"), "tree", "left_semi")
        top = stage(_cogrouped(nodes.filter("size > 1"), several, _paths, PATHS, height).unionByName(single))
    return top


def verified_rows(docs: DataFrame, source: str = "source", columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", text_col: str = "text",
                  tamper_every: int = TAMPERED, height: int = LEVELS) -> DataFrame:
    """One row per input row: its id, leaf, subroot, root and proof, and what its tampered form folds to.

    The rows whose id has a crc32 that ``tamper_every`` divides are tampered with: their text loses its capital letters.
    """
    own, changed = ([F.col(c) if c != text_col else t for c in columns] for t in (F.col(text_col), tampered(F.col(text_col))))
    hit = F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(tamper_every)) == 0, F.lit(False))
    # the null source comes before all others, which keep their order byte by byte
    tree = F.when(F.col(source).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), whole(F.col(source))))
    leaves = docs.select(tree.alias("tree"), F.col(id_col).alias("doc_id"), leaf(own).alias("node"), F.when(hit, leaf(changed)).alias("changed"))
    # staged, or the ranges of the partitioning would be found by hashing every text once more
    layers = upward(stage(positions(stage(leaves), "tree", ["doc_id", "node", "changed"])
                          .withColumn("seen", F.coalesce("changed", "node")).drop("changed")), height)
    subroots = layers[-1].select(F.lit("sources").alias("tree"), F.col("tree").alias("source"), "node")
    over = upward(stage(positions(subroots, "tree", ["source"])), height)
    start = over[-1].select("tree", F.col("at").alias("block"), F.array().cast("array<binary>").alias("path"),
                            F.col("node").alias("subroot"), F.col("node").alias("root"))
    # from the place among the subroots back to the source
    tops = over[0].join(downward(over, start, height).select(F.col("block").alias("at"), "path", "root"), "at").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("block"), "path", F.col("node").alias("subroot"), "root")
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("leaf", "string").add("subroot", "string").add("root", "string").add(
        "proof_sha256", "string").add("folded_root", "string").add("verified", "boolean")
    return _cogrouped(layers[0], downward(layers[1:], stage(tops), height), _proofs, schema, height)
