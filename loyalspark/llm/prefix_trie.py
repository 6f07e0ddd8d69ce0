"""Trie of conversations that share their first turns.

A node is a sequence of turns that some conversation begins with. It is named
by its depth and a 128-bit digest of the sequence, which ``ranks.ranked``
computes as running sums over sorted rows, so a conversation of any length is
spread over tasks.

Most prefixes belong to one conversation alone. A count-min sketch of all
digests (saturating at two) tells: an estimate of one proves a singleton, as a
sketch never counts too few. Singletons lie at the tail of a conversation, and
their nodes are emitted where they are. Only prefixes that may be shared are
shuffled and grouped exactly, with map-side combining; what the sketch took
for shared by mistake is settled there too. The sketch has at most
``MAX_CELLS`` bytes; beyond that more prefixes are shuffled, none is lost.

Sums over subtrees need no walk down the trie. A conversation is counted at
each of its prefixes, so a subtree's leaves are the members that represent a
childless node, and its saved tokens are those of members at nodes where a
smaller member holds the turns already.

Keys with many rows (root, first turns that a third of all conversations
share) are joined through ``join_hot``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_hot, mix, stage, tasks_for
from .ranks import ranked

#: Cells of the sketch, a byte each, in ``SKETCH_ROWS`` rows.
MAX_CELLS = 1 << 25
SKETCH_ROWS = 2
_CHUNK = 1 << 16
#: Partial sketches that one task merges at once.
_MERGE = 64

WORD = "[^\\x20\\x09-\\x0D]+"
EMPTY = hashlib.sha256(b"").hexdigest()

KEY = ["depth", "p1", "p2"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, tokens): turns without their texts; t1 and t2
    are halves of a digest of role and text. Null role or text counts as
    empty; rows without conv_id belong to no conversation and are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)

    def half(at: int):
        # 8 digits at a time: 16 may exceed a signed long
        high, low = (F.conv(F.substring(told, at + k, 8), 16, 10).cast("long") for k in (0, 8))
        return F.shiftleft(high, 32).bitwiseOR(low)

    rows = conversations.filter("conv_id is not null")
    return rows.select("conv_id", "turn", half(1).alias("t1"), half(17).alias("t2"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"))


#: Order of the digests' hexadecimal digits: halves as unsigned numbers.
_BY_DIGEST = ("t1 < 0", "t1", "t2 < 0", "t2")


def in_order(rows: DataFrame) -> DataFrame:
    """Turn rows (staged) with ``rank``, their place in their conversation by
    turn (null first); turns of one number stand by digest."""
    return ranked(rows, "conv_id", [F.col("turn"), *map(F.expr, _BY_DIGEST)], name="turns")


def _cells(depth: np.ndarray, p1: np.ndarray, p2: np.ndarray, width: int) -> list[np.ndarray]:
    a = p1.view(np.uint64) + mix(depth.astype(np.uint64) + np.uint64(1))
    b = p2.view(np.uint64) ^ a
    return [mix(x.copy()) & np.uint64(width - 1) for x in (a, b)]


def sketch(prefixes: DataFrame, width: int) -> list[np.ndarray]:
    """The count-min sketch of staged prefixes (depth, p1, p2): one array per
    row, saturating at 2. Tasks count their own rows, chunks of cells are
    merged ``_MERGE`` at a time; the driver receives the finished cells."""
    chunk = min(_CHUNK, width)

    def count(batches):
        from pyspark import TaskContext
        have = [np.zeros(width, np.uint8) for _ in range(SKETCH_ROWS)]
        for b in batches:
            columns = [b.column(c).to_numpy() for c in KEY]
            for row, cells in zip(have, _cells(*columns, width)):
                cells, n = np.unique(cells, return_counts=True)
                row[cells] = np.minimum(2, row[cells] + np.minimum(n, 2).astype(np.uint8))
        task = TaskContext.get().partitionId()
        for r, row in enumerate(have):
            for k in range(0, width, chunk):
                part = row[k: k + chunk]
                if part.any():
                    yield _packed([r * (width // chunk) + k // chunk], [task // _MERGE], [part])

    def _packed(chunks, nodes, parts):
        ones = [np.flatnonzero(p == 1).astype(np.uint16).tobytes() for p in parts]
        more = [np.flatnonzero(p == 2).astype(np.uint16).tobytes() for p in parts]
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int32()), pa.array(nodes, pa.int32()), pa.array(ones, pa.binary()),
                                           pa.array(more, pa.binary())], names=["chunk", "node", "ones", "more"])

    def merge(key, table):
        cells = np.zeros(chunk, np.uint8)
        for ones, more in zip(table.column("ones").to_pylist(), table.column("more").to_pylist()):
            at = np.frombuffer(ones, np.uint16)
            cells[at] = np.minimum(2, cells[at] + 1)
            cells[np.frombuffer(more, np.uint16)] = 2
        return pa.Table.from_batches([_packed([key[0].as_py()], [key[1].as_py() // _MERGE], [cells])])

    schema = "chunk int, node int, ones binary, more binary"
    partial = prefixes.select(*KEY).mapInArrow(count, schema)
    nodes = -(-prefixes.rdd.getNumPartitions() // _MERGE)
    while True:
        partial = partial.groupBy("chunk", "node").applyInArrow(merge, schema)
        if nodes <= 1:
            break
        nodes = -(-nodes // _MERGE)
    out = [np.zeros(width, np.uint8) for _ in range(SKETCH_ROWS)]
    for c, _, ones, more in partial.collect():
        r, k = divmod(c, width // chunk)
        out[r][k * chunk + np.frombuffer(ones, np.uint16).astype(np.int64)] = 1
        out[r][k * chunk + np.frombuffer(more, np.uint16).astype(np.int64)] = 2
    return out


def screened(prefixes: DataFrame, width: int) -> DataFrame:
    """Staged prefixes with ``shared`` and ``under_shared``: whether the
    sketch leaves it possible that another conversation has the prefix, or its
    parent (``depth`` - 1, q1, q2). The root counts as shared."""
    spark = prefixes.sparkSession
    held = spark.sparkContext.broadcast([row.tobytes() for row in sketch(prefixes.filter("depth > 0"), width)])
    names = prefixes.columns
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in prefixes.schema], "shared boolean, under_shared boolean"])

    def flag(batches):
        rows = [np.frombuffer(x, np.uint8) for x in held.value]

        def possible(depth, p1, p2):
            return (depth <= 0) | np.logical_and.reduce([row[c] > 1 for row, c in zip(rows, _cells(depth, p1, p2, width))])

        for b in batches:
            depth, p1, p2, q1, q2 = (b.column(c).to_numpy() for c in (*KEY, "q1", "q2"))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(possible(depth, p1, p2)), pa.array(possible(depth - 1, q1, q2))],
                                             names=[*names, "shared", "under_shared"])

    return prefixes.mapInArrow(flag, schema)


def _id_list_digests(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of staged (depth, p1, p2, conv_id): digest
    of a node's ids, ascending, joined by commas.

    The ids of all nodes are sorted by range, so a node with many is spread
    over tasks, which join them to pieces of some 4 KB. A digest is a chain,
    so a node's pieces are fed to it one after the other, never held together.
    """
    spark = ends.sparkSession
    order = [*KEY, "conv_id"]
    spread = ends.select(*order).repartitionByRange(tasks_for(spark, ends.count(), 1_000_000), *order).sortWithinPartitions(*order)
    schema = "depth long, p1 long, p2 long, part int, seq long, ids string"

    def join(batches):
        from pyspark import TaskContext
        part, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            keys = [b.column(c).to_numpy() for c in KEY]
            ids = b.column("conv_id").to_numpy()
            new = np.flatnonzero(np.any([np.append(True, k[1:] != k[:-1]) for k in keys], axis=0)) if len(ids) else []
            out = []
            for lo, hi in zip(new, [*new[1:], len(ids)]):
                for at in range(lo, hi, 400):
                    out.append((*(int(k[lo]) for k in keys), part, seq, ",".join(map(str, ids[at: min(hi, at + 400)].tolist()))))
                    seq += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=[x.split()[0] for x in schema.split(", ")])

    pieces = stage(spark, spread.mapInArrow(join, schema), "trie-ids")

    def chain(batches):
        key, state = None, None
        for b in batches:
            done = []
            for d, a, c, ids in zip(*(b.column(x).to_pylist() for x in (*KEY, "ids"))):
                if (d, a, c) != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (d, a, c), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _digests(done)
        if key is not None:
            yield _digests([(*key, state.hexdigest())])

    def _digests(rows):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=[*KEY, "ends_sha256"])

    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "part", "seq").select(*KEY, "ids")
            .mapInArrow(chain, "depth long, p1 long, p2 long, ends_sha256 string"))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row per node of the trie of staged ``rows`` (conv_id, place, t1, t2,
    tokens): a conversation's turns by ``place``, ascending, plus one row for
    the conversation itself, with null place and zero t1, t2 and tokens, which
    makes it a member of the root even if it has no turns.

    Returns conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs, n_children, n_leaves (childless nodes in the subtree),
    saved_tokens (over the subtree, the tokens of each node's last turn times
    its members but one) and ends_sha256 (digest of the ids, ascending and
    comma-joined, of members that end at the node). An empty table has no
    node. Turns of one place stand by digest.
    """
    spark = rows.sparkSession
    walked = ranked(rows, "conv_id", [F.col("place"), *map(F.expr, _BY_DIGEST)], sums=["tokens"], hashes=["t1", "t2"], name="trie-turns")
    prefixes = stage(spark, walked.select(
        "conv_id", F.col("rank").alias("depth"), F.col("t1_upto").alias("p1"), F.col("t2_upto").alias("p2"),
        F.col("t1_before").alias("q1"), F.col("t2_before").alias("q2"), "tokens", F.col("tokens_before").alias("above"), "last"), "trie-prefixes")
    n = max(prefixes.count(), 1)
    width = min(MAX_CELLS // SKETCH_ROWS, max(1 << 10, 1 << (4 * n - 1).bit_length()))
    told = stage(spark, screened(prefixes, width), "trie-screened")
    alone, maybe = told.filter("not shared"), stage(spark, told.filter("shared").drop("shared", "under_shared"), "trie-shared")

    # exact groups of the prefixes that may be shared
    groups = stage(spark, maybe.groupBy(*KEY).agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n_convs"), F.sum(F.col("last").cast("long")).alias("n_ends"),
        F.min(F.when(F.col("last"), F.col("conv_id"))).alias("first_end"), F.min("q1").alias("q1"), F.min("q2").alias("q2"),
        F.min("above").alias("above")), "trie-groups")
    members = stage(spark, join_hot(maybe.drop("q1", "q2", "above"), groups.select(
        *KEY, "least", F.col("n_ends").alias("ends"), (F.col("n_ends") == F.col("n_convs")).alias("childless")), KEY), "trie-members")

    # per conversation: tokens of turns that a smaller member holds too, and
    # whether it stands for a childless node; a tail of its own is one
    held = F.col("conv_id") != F.col("least")
    convs = stage(spark, members.groupBy("conv_id").agg(
        F.sum(F.when(held, F.col("tokens")).otherwise(0)).alias("spared"),
        F.min(F.when(F.col("last"), (~held & F.col("childless")).cast("long")).otherwise(1)).alias("leaf")), "trie-convs")
    with_convs = join_hot(members.select("conv_id", *KEY, "least"), convs, ["conv_id"])
    below = with_convs.groupBy(*KEY).agg(F.sum("leaf").alias("n_leaves"), F.sum(F.when(held, F.col("spared")).otherwise(0)).alias("spared"))

    # children: groups, and singletons right under a group
    border = stage(spark, alone.filter("under_shared"), "trie-border")
    up = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    children = (groups.filter("depth > 0").select(*up).unionAll(border.select(*up)).groupBy(*KEY).agg(F.count("*").alias("n_children")))
    parent = groups.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("least").alias("parent_conv_id"))
    parent_key = ["depth", "q1", "q2"]

    # ends of groups: one id is digested in place
    ends = stage(spark, members.filter("last and ends > 1").select(*KEY, "conv_id"), "trie-ends")
    digests = _id_list_digests(ends)
    nodes = (groups.join(below, KEY, "left").join(children, KEY, "left").join(digests, KEY, "left"))
    nodes = stage(spark, nodes.select(
        *KEY, F.col("least").alias("conv_id"), "q1", "q2", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        (F.col("spared") - (F.col("n_convs") - 1) * F.col("above")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.when(F.col("n_ends") == 0, F.lit(EMPTY)).otherwise(F.sha2(F.col("first_end").cast("string"), 256))).alias("ends_sha256")),
        "trie-nodes")

    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    # a group whose parent is no group was taken for shared below a singleton
    inner = join_hot(nodes.filter("depth > 0"), parent, parent_key, how="left").withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))

    def single(df: DataFrame) -> DataFrame:
        one = F.lit(1).cast("long")
        return (df.withColumn("n_convs", one).withColumn("n_leaves", one).withColumn("saved_tokens", F.lit(0).cast("long"))
                .withColumn("n_children", F.when(F.col("last"), 0).otherwise(1).cast("long"))
                .withColumn("ends_sha256", F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(EMPTY)))

    tails = single(alone.filter("not under_shared").withColumn("parent_conv_id", F.col("conv_id")))
    first = single(join_hot(border, parent, parent_key))
    parts = [x.select(*columns) for x in (root, inner, tails, first)]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
