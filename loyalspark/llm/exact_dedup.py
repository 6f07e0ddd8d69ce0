"""Exact de-duplication by a tree-merge of sorted digest runs.

Every partition sorts its documents' digests into a run: one row per digest
with the identifier that would stay and the number of copies. Runs are merged
in binomial rounds: in every round ``fan_in`` neighbouring nodes exchange
their runs, split into as many digest ranges as nodes meet, and each range is
merged in order by one task; so the number of merging tasks stays the same
from round to round, and after the last one a single node holds every digest,
spread by range. Copies combine at every level before they are exchanged: a
text that a third of all rows share is one row per run, then one per node, and
never gathers in one task.

A digest match is verified at every level: rows merge only when the SHA-256,
the length in bytes and an independent 64-bit hash of the text all agree.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, stage, text_or_empty

KEY = ["digest", "n_bytes", "proof"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple = ()) -> DataFrame:
    """(id, digest, n_bytes, proof) and ``more`` columns per row; a null text
    counts as empty."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).alias("n_bytes"), F.xxhash64(text).alias("proof"), *more)


def _merge(batches):
    """One row per (node, digest, n_bytes, proof) of rows in that order, the
    row to keep first: its id, and the sum of sizes. Rows arrive in Arrow
    batches; only the last group of a batch waits for the next one."""
    wait = None
    for b in batches:
        if not b.num_rows:
            continue
        if wait is not None:
            b = pa.Table.from_batches([wait, b]).combine_chunks().to_batches()[0]
        new = np.zeros(b.num_rows, bool)
        new[0] = True
        for name in ("node", *KEY):
            column = b.column(name)
            new[1:] |= pc.not_equal(column.slice(1), column.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(new)
        sizes = np.add.reduceat(b.column("group_size").to_numpy(), first)
        rows = pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()) if f.name == "group_size" else b.column(f.name).take(pa.array(first))
                                           for f in b.schema], schema=b.schema)
        yield rows.slice(0, len(first) - 1)
        wait = rows.slice(len(first) - 1)
    if wait is not None:
        yield wait


def _in_runs(run: DataFrame, keep: str) -> DataFrame:
    """The sorted run of each partition, merged. The merging task reads its rows in
    order, so the plan keeps the sort."""
    best = F.col("keep_id").desc_nulls_last() if keep == "largest" else F.col("keep_id").asc_nulls_last()
    return run.sortWithinPartitions("node", *KEY, best).mapInArrow(_merge, run.schema)


def tree_merge(rows: DataFrame, keep: str = "largest", leaves: int = 256, fan_in: int = 16) -> DataFrame:
    """(digest, n_bytes, proof, keep_id, group_size): one row per distinct text.

    The kept id is the largest (or smallest), null only where no row of the
    text has one. An empty table gives no rows.
    """
    run = _in_runs(rows.select(*KEY, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                               F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("node")), keep)
    nodes = leaves
    while True:
        nodes = -(-nodes // fan_in)
        # the digest's first 16 bits give its range
        part = F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int") * F.lit(-(-leaves // nodes))
        run = (run.withColumn("node", F.floor(F.col("node") / fan_in).cast("int"))
               .repartition("node", F.floor(part / 65536)))
        run = _in_runs(run, keep)
        if nodes <= 1:
            return run.drop("node")


def with_groups(rows: DataFrame, keep: str = "largest", share: int = 1000) -> DataFrame:
    """Staged ``rows`` with ``keep_id`` and ``group_size`` of their text.

    Texts that hold more than one ``share``-th of all rows are fewer than
    ``share``: their group is broadcast and their rows stay where they are. The
    others meet their group by digest.
    """
    groups = stage(rows.sparkSession, tree_merge(rows, keep), "groups")
    large = F.col("group_size") > F.lit(max((groups.agg(F.sum("group_size")).first()[0] or 0) // share, 100))
    hot = F.broadcast(groups.filter(large))
    return rows.join(hot, KEY).unionByName(
        rows.join(hot.select(*KEY), KEY, "left_anti").join(groups.filter(~large), KEY))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "largest") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row.

    Rows with equal text form a group; the one with the largest (or smallest)
    id stays. A null id never wins over an id; in a group without any id
    ``keep_id`` is null and every row is kept. Rows that repeat both id and
    text all report ``kept``; ``exact_dedup`` leaves one of them. Texts of any
    length count by their digest; an empty table gives no rows. Other columns
    are not looked at.
    """
    rows = stage(docs.sparkSession, digests(docs, id_col, text_col), "digests")
    return with_groups(rows, keep).select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size"), F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged.

    An id that occurs with several texts is settled per (id, text); of rows
    that repeat both one stays. A row without an id goes where a row with one
    has its text; else one such row stays.
    """
    out = stage(docs.sparkSession, exact_groups(docs, id_col, text_col, keep), "exact-groups")
    decided = out.select(F.col(id_col).alias("id"), F.unhex("text_sha256").alias("sha"), "kept")
    return keep_rows(docs, decided, id_col, text_col)
