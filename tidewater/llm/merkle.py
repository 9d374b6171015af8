"""A Merkle manifest of a dataset as a persistent path-copying tree.

Every row is a leaf: the digest of its named columns, each written as ``-`` for
null or as its UTF-8 byte count, ``:`` and the value. Per group the leaves, in
order of the key, are paired level by level (a last node without a partner is
hashed alone) until one is left, the group's subroot; the subroots, in order of
the group (null first, then by bytes), are paired the same way into the root.

Levels are built by aligned blocks of ``1 << block_levels`` nodes: a block holds
exactly the subtree of its nodes, so one task builds it alone and hands one
node on. The blocks' nodes are the leaves of the next round, of a thousandth
of the size, until every group has one node. Nothing but row counts reaches
the driver.

A changed leaf makes a version of the tree. Nodes are never overwritten: the
version copies the changed leaf's ancestors, first inside its block, then along
the block's steps through the upper rounds, and shares all other nodes with the
first version. ``versions`` returns each leaf's siblings (``path``: ``<`` or ``>``
and the digest of a sibling to the left or right, ``.`` where there is none) and
the copied nodes of each change.

Defined results: rows with a null key come first and rows of equal keys are in
order of their digests; empty and very long texts are values like others;
repeated rows are leaves of their own; a null group is a group; an empty table
gives empty results; columns not named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import broadcast_if_small, keep_table, map_batches

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_LEVELS = 10
#: Bytes of a row of block paths: 64 digits a step, three rounds of blocks.
PATH_BYTES = 2600
VERSIONS = ("doc_id bigint, lang string, position bigint, leaf string, subroot string, root string, "
            "path array<string>, copies array<string>, folded_root string")


# ---- the tree, in one block ------------------------------------------------------------------

def node(children: str) -> str:
    return sha256(children.encode()).hexdigest()


def grow(nodes: Sequence[str], n_levels: int) -> list[Sequence[str]]:
    """All levels above ``nodes``, ``nodes`` first."""
    levels = [nodes]
    for _ in range(n_levels):
        below = levels[-1]
        levels.append([node("".join(below[i:i + 2])) for i in range(0, len(below), 2)])
    return levels


def steps(levels: Sequence[Sequence[str]], i: int) -> list[str]:
    """The siblings met from node ``i`` of the first level up to the last one."""
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append("." if j >= len(level) else ("<" if j < i else ">") + level[j])
        i >>= 1
    return out


def copy_path(digest: str, path: Sequence[str]) -> list[str]:
    """The nodes a version does not share: ``digest`` and its ancestors along ``path``."""
    copies = [digest]
    for step in path:
        own = copies[-1]
        copies.append(node(step[1:] + own if step[0] == "<" else own + step[1:]))
    return copies


def levels_inside(size: int, block_levels: int) -> int:
    """Levels of a block in a tree of ``size`` nodes."""
    return min(block_levels, (size - 1).bit_length())


# ---- leaves and their places -----------------------------------------------------------------

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: Sequence[str], changes: Mapping[str, Column] | None = None) -> Column:
    changes = changes or {}
    whole = F.concat(*[_field(changes.get(c, F.col(c))) for c in columns])
    return F.unhex(F.sha2(whole.cast("binary"), 256))


def _place(rows: DataFrame, name: str) -> DataFrame:
    """``pos`` (from 0) of each row in its ``group`` by (key, digest), and the group's ``size``.

    One range-partitioned sort numbers all rows; a row's place is its number, less the first
    number of its group in the partition, plus the group's rows in the partitions before.
    """
    place = rows.metadataColumn("_metadata")
    order = [F.col("group"), F.col("key").asc_nulls_first(), F.col("digest"), F.col("tie")]
    numbered = keep_table(
        rows.withColumn("tie", F.xxhash64(place["file_path"], place["row_index"]))
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
        .withColumn("number", F.monotonically_increasing_id()), name)
    numbered = numbered.withColumn("part", F.shiftright("number", 33))
    spans = numbered.groupBy("group", "part").agg(F.min("number").alias("low"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("group")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = keep_table(spans.select("group", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift"),
                                    F.sum("n").over(own).alias("size")), f"{name}-spans")
    return (numbered.join(broadcast_if_small(spans, 64), ["group", "part"])
            .withColumn("pos", F.col("number") + F.col("shift")).drop("part", "number", "shift"))


def _blocks(placed: DataFrame, block_levels: int, *values: str) -> DataFrame:
    """One row a block: ``nodes`` in order, at most ``1 << block_levels`` of them."""
    return (placed.groupBy("group", F.shiftright("pos", block_levels).alias("block"))
            .agg(F.sort_array(F.collect_list(F.struct("pos", *values))).alias("nodes"), F.max("size").alias("size")))


# ---- rounds of blocks ------------------------------------------------------------------------

def _raise_blocks(blocks: DataFrame, name: str, block_levels: int, with_steps: bool) -> DataFrame:
    """(group, pos, size, digest, below): each block's upper node, and if asked the steps of every node below it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            grown = [grow([d.hex() for d in r["digests"]], levels_inside(r["size"], block_levels)) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("block"),
                 pa.array([-(-r["size"] >> block_levels) for r in rows], pa.int64()),
                 pa.array([bytes.fromhex(g[-1][0]) for g in grown], pa.binary()),
                 pa.array([[steps(g, i) for i in range(len(g[0]))] if with_steps else None
                           for r, g in zip(rows, grown, strict=True)], pa.list_(pa.list_(pa.string())))],
                ["group", "pos", "size", "digest", "below"])

    narrow = blocks.select("group", "block", "size", F.col("nodes.digest").alias("digests"))
    return keep_table(map_batches(narrow, run, "group string, pos bigint, size bigint, digest binary, "
                                  "below array<array<string>>"), name)


def _climb(nodes: DataFrame, name: str, block_levels: int) -> tuple[DataFrame, DataFrame]:
    """(group, pos, path) of every node up to its group's top, and the tops (group, digest)."""
    rounds = []
    nodes = nodes.select("group", "pos", "size", "digest")
    leaves = nodes
    while (nodes.agg(F.max("size")).first()[0] or 0) > 1:
        raised = _raise_blocks(_blocks(nodes, block_levels, "digest"), f"{name}-{len(rounds)}", block_levels, with_steps=True)
        rounds.append(raised)
        nodes = raised.select("group", "pos", "size", "digest")
    tops = nodes.select("group", "digest")
    if not rounds:
        return leaves.select("group", "pos", F.array().cast("array<string>").alias("path")), tops
    paths = None
    for number, raised in reversed(list(enumerate(rounds))):
        # a round's node stands at (block << block_levels) + its index in the block
        here = raised.select("group", F.col("pos").alias("above"), F.posexplode("below").alias("i", "path"))
        here = here.withColumn("pos", F.shiftleft("above", block_levels) + F.col("i"))
        if paths is not None:
            upper = paths.select("group", F.col("pos").alias("above"), F.col("path").alias("rest"))
            here = (here.join(broadcast_if_small(upper, PATH_BYTES), ["group", "above"])
                    .withColumn("path", F.concat("path", "rest")))
        paths = keep_table(here.select("group", "pos", "path"), f"{name}-paths-{number}")
    return paths, tops


# ---- the manifest ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    blocks: DataFrame   # group, block, size, nodes (pos, key, digest, changed)
    paths: DataFrame    # group, block, path (up to the root), subroot, root
    block_levels: int

    def groups(self) -> DataFrame:
        """(lang, n_leaves, subroot, root) of every group."""
        sizes = self.blocks.where("block = 0").select("group", F.col("size").alias("n_leaves"))
        tops = self.paths.where("block = 0").select("group", "subroot", "root")
        return sizes.join(tops, "group").select(_group_value(), "n_leaves", "subroot", "root")

    def versions(self) -> DataFrame:
        """One row a leaf: its proof, and the version that its change makes (``VERSIONS``)."""
        asked = self.blocks.join(broadcast_if_small(self.paths, PATH_BYTES), ["group", "block"])
        asked = asked.select(_group_value(), "size", "path", "subroot", "root", F.col("nodes.pos").alias("pos"),
                             F.col("nodes.key").alias("key"), F.col("nodes.digest").alias("digest"),
                             F.col("nodes.changed").alias("changed"))
        block_levels = self.block_levels
        return map_batches(asked, lambda batches: _versions(batches, block_levels), VERSIONS)


def _group_value() -> Column:
    return F.when(F.col("group") != "", F.substr("group", F.lit(2))).alias("lang")


def _versions(batches: Iterator[pa.RecordBatch], block_levels: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("position", pa.int64()), ("leaf", pa.string()),
                        ("subroot", pa.string()), ("root", pa.string()), ("path", pa.list_(pa.string())),
                        ("copies", pa.list_(pa.string())), ("folded_root", pa.string())])
    for batch in batches:
        for block in batch.to_pylist():
            leaves = [d.hex() for d in block["digest"]]
            levels = grow(leaves, levels_inside(block["size"], block_levels))
            upper = block["path"]
            top = levels[-1][0]
            shared = copy_path(top, upper)  # by every version that leaves the block with its first node
            paths, copies, folded = [], [], []
            for i, change in enumerate(block["changed"]):
                inner = steps(levels, i)
                own = copy_path(change.hex() if change else leaves[i], inner)
                rest = shared if own[-1] == top else copy_path(own[-1], upper)
                paths.append(inner + upper)
                copies.append(own + rest[1:] if change else None)
                folded.append(rest[-1])
            n = len(leaves)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, field.type) for values, field in zip(
                    (block["key"], [block["lang"]] * n, block["pos"], leaves, [block["subroot"]] * n,
                     [block["root"]] * n, paths, copies, folded), schema, strict=True)], schema=schema)


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, group: str = "lang", key: str = "doc_id",
          where: Column | None = None, changes: Mapping[str, Column] | None = None,
          block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``docs``; rows that meet ``where`` also get the leaf that ``changes`` make of them."""
    changed = F.when(where, leaf(columns, changes)) if where is not None else F.lit(None).cast("binary")
    name = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null sorts first
    leaves = keep_table(docs.select(name.alias("group"), F.col(key).cast("long").alias("key"),
                                    leaf(columns).alias("digest"), changed.alias("changed")), "leaves")
    blocks = keep_table(_blocks(_place(leaves, "placed-leaves"), block_levels, "key", "digest", "changed"), "leaf-blocks")
    paths, subroots = _climb(_raise_blocks(blocks, "block-roots", block_levels, with_steps=False), "group-rounds", block_levels)
    subroots = keep_table(subroots.select(F.lit("").alias("group"), F.col("group").alias("key"), "digest"), "subroots")
    placed = keep_table(_place(subroots, "placed-subroots"), "placed-groups")
    tops, root = _climb(placed, "root-rounds", block_levels)
    by_group = (placed.join(tops, ["group", "pos"]).join(root.select("group", F.col("digest").alias("root")), "group")
                .select(F.col("key").alias("group"), F.col("path").alias("rest"),
                        F.lower(F.hex("digest")).alias("subroot"), F.lower(F.hex("root")).alias("root")))
    by_group = keep_table(by_group, "group-paths")
    paths = paths.join(broadcast_if_small(by_group, PATH_BYTES), "group")
    return Manifest(blocks, keep_table(paths.select("group", F.col("pos").alias("block"),
                                                    F.concat("path", "rest").alias("path"), "subroot", "root"), "block-paths"),
                    block_levels)
