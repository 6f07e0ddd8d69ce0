"""Merkle manifest of a dataset, with a witness per row.

Every row is a leaf; the leaves of a group, in order, are hashed 16 at a time
until one node remains, and the groups' nodes likewise give the root. A
witness holds a leaf's siblings level by level, so a row alone proves that it
belongs to the root.

Witnesses grow with the tree. A task appends the aligned runs of a block (256
leaves) in order: an open subtree keeps the nodes under it, which are the
partial witness that all its leaves share, and each completed sibling extends
it. A block's root is a further append for the next round, in blocks of its
own, so round r handles one 256th of the nodes of round r - 1. Witnesses of
upper rounds are attached to whole blocks and meet the leaves at the end.
Whatever share of the rows a group holds, a block is 256 rows.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .ranks import ranked

FAN = 16
#: Levels that a block raises, and the nodes it takes.
LEVELS = 2
BLOCK = FAN ** LEVELS


def field(col: Column) -> Column:
    """A value as bytes that no other value has: ``-`` for null, else its
    length in UTF-8 bytes, a colon and the value (integers decimal)."""
    text = col.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(*cols: Column) -> Column:
    return digest(*map(field, cols))


def node(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Appender:
    """Appends nodes in order. ``levels[l]`` holds the nodes of level l: those
    after its last complete run are open, and every leaf below them reads its
    siblings there as they come in."""

    def __init__(self, levels: int = LEVELS):
        self.levels: list[list[str]] = [[] for _ in range(levels + 1)]

    def append(self, one: str) -> None:
        for level in self.levels[:-1]:
            level.append(one)
            if len(level) % FAN:
                return
            one = node(level[-FAN:])
        self.levels[-1].append(one)

    def close(self, alone: bool) -> tuple[list[list[str]], str]:
        """(levels below the root, root). A block that is a whole tree ends as
        soon as one node remains; another one is raised to its full height."""
        for l, level in enumerate(self.levels):
            if l + 1 == len(self.levels) or alone and len(level) == 1:
                return self.levels[:l], level[0]
            open_run = level[FAN * len(self.levels[l + 1]):]
            if open_run:
                self.levels[l + 1].append(node(open_run))
        raise ValueError("no node was appended")


_BLOCKS = "grp string, block long, done boolean, root string, levels array<binary>, rows array<{row}>"


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per block of ``nodes`` (grp, rank, hash, row): its root, whether
    it is its group's whole tree, its rows in order, and for each level the
    hashes one after the other."""
    row = nodes.schema["row"].dataType

    def append(key, table):
        table = table.sort_by("rank")
        block, alone = key[1].as_py(), key[1].as_py() == 0 and table.num_rows < BLOCK
        tree = Appender()
        for one in table.column("hash").to_pylist():
            tree.append(one)
        levels, root = tree.close(alone)
        rows = table.column("row").combine_chunks()
        rows = rows.chunk(0) if isinstance(rows, pa.ChunkedArray) else rows
        return pa.table({
            "grp": pa.array([key[0].as_py()], pa.string()), "block": pa.array([block], pa.int64()), "done": pa.array([alone]),
            "root": pa.array([root]), "levels": pa.array([["".join(x).encode() for x in levels]], pa.list_(pa.binary())),
            "rows": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)})

    with_block = nodes.withColumn("block", F.floor(F.col("rank") / BLOCK))
    return with_block.groupBy("grp", "block").applyInArrow(append, _BLOCKS.format(row=row.simpleString()))


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Staged blocks of every round, the leaves' first."""
    rounds = []
    while True:
        blocks = stage(nodes.sparkSession, _blocks(nodes), "merkle-blocks")
        rounds.append(blocks)
        more = blocks.filter("not done")
        if more.isEmpty():
            return rounds
        nodes = more.select("grp", F.col("block").alias("rank"), F.col("root").alias("hash"), F.struct("block").alias("row"))


#: (row, its siblings within the block) of each row of a block: 4 bits of a
#: place choose the sibling of a level, 64 bytes are a hash.
_OWN = """transform(rows, (x, i) -> struct(x AS row, i AS place, transform(levels, (v, l) -> struct(
    CAST(substring(v, shiftright(i, 4 * l + 4) * 1024 + 1, shiftright(i, 4 * l) % 16 * 64) AS STRING) AS left,
    CAST(substring(v, shiftright(i, 4 * l) * 64 + 65, (15 - shiftright(i, 4 * l) % 16) * 64) AS STRING) AS right)) AS own))"""


def _witnesses(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(grp, row, witness, top) of every leaf, from the blocks and, per group,
    what lies above its tree: tops (grp, up, top)."""
    tops = tops.withColumnRenamed("grp", "__grp")
    above = None
    for blocks in reversed(rounds):
        met = blocks.filter("done").join(tops, F.col("grp").eqNullSafe(F.col("__grp"))).drop("__grp")
        if above is not None:
            parents = above.select(F.col("grp").alias("__grp"), F.col("row.block").alias("__block"), F.col("witness").alias("up"), "top")
            rest = blocks.filter("not done").join(
                parents, F.col("grp").eqNullSafe(F.col("__grp")) & (F.col("block") == F.col("__block")))
            met = met.unionByName(rest.drop("__grp", "__block"))
        one = met.select("grp", "up", "top", F.explode(F.expr(_OWN)).alias("one"))
        above = one.select("grp", "one.row", F.concat("one.own", "up").alias("witness"), "top")
    return above


def manifest(rows: DataFrame, group_col: str, order_col: str, leaf_col: str) -> DataFrame:
    """``rows`` (staged) with ``subroot`` (of the row's group), ``root`` and
    ``witness``: per level, from the leaf's to the root's, the siblings before
    and after as hexadecimal digits (both empty where there are none).

    A group's leaves stand by ``order_col`` (null first), ties by leaf, so rows
    repeated in full have equal leaves next to each other; groups stand by
    name, null first. A null group is a group, a lone leaf its own subroot and,
    as the only group, the root. An empty table gives an empty one.
    """
    spark = rows.sparkSession
    packed = rows.select(F.col(group_col).cast("string").alias("grp"), F.col(order_col).alias("__order"),
                         F.col(leaf_col).alias("hash"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    # the staged rows are read again in each use, so no row changes its place
    leaves = ranked(packed, "grp", [F.col("__order"), F.col("hash")], name="merkle-leaves")
    rounds = _rounds(leaves.select("grp", "rank", "hash", "row"))
    roots = rounds[0].filter("done").select("grp", "root")
    for blocks in rounds[1:]:
        roots = roots.unionByName(blocks.filter("done").select("grp", "root"))
    groups = stage(spark, roots.select(F.lit("").alias("all"), "grp", F.col("root").alias("hash"),
                                       F.struct("grp", "root").alias("row")), "merkle-groups")
    upper = _rounds(ranked(groups, "all", [F.col("grp")], name="merkle-groups").select(F.col("all").alias("grp"), "rank", "hash", "row"))
    root = upper[-1].filter("done").select("grp", F.expr("CAST(array() AS array<struct<left: string, right: string>>)").alias("up"),
                                           F.col("root").alias("top"))
    tops = _witnesses(upper, root).select(F.col("row.grp").alias("grp"), F.col("witness").alias("up"),
                                          F.struct(F.col("row.root").alias("subroot"), F.col("top").alias("root")).alias("top"))
    out = _witnesses(rounds, stage(spark, tops, "merkle-tops"))
    return out.select("row.*", "top.subroot", "top.root", "witness")


def proof(witness: Column) -> Column:
    """All siblings of a witness, level by level, left to right."""
    return F.array_join(F.transform(witness, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf_hash: Column, witness: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(witness, leaf_hash, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
