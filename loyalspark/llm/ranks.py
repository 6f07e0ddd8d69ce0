"""Places, running sums and prefix digests of rows in their group, for groups
of any size.

All rows are dealt by range of (group, order), so a group that holds any share
of them is spread over tasks. Each task scans its sorted rows; a group that
began in an earlier task carries that task's state on. The state is one row
per task, so the driver folds as many rows as there are tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, tasks_for

#: Odd base of the prefix digests.
BASE = 0x9E3779B97F4A7C15
_WORD = 1 << 64


def powers(ranks: np.ndarray) -> np.ndarray:
    """BASE ** rank modulo 2 ** 64, by squaring."""
    out, square, left = np.ones(len(ranks), np.uint64), BASE, ranks.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square), out)
        left, square = left >> np.uint64(1), square * square % _WORD
    return out


def _longs(column) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _scanner(group: str, sums: list[str], hashes: list[str]):
    """Function of a task's sorted batches: adds the place and the state ahead
    of each row, as far as this task's rows tell."""

    def scan(batches):
        from pyspark import TaskContext
        part, seen, count, before, held = TaskContext.get().partitionId(), 0, 0, None, None
        state = dict.fromkeys((*sums, *hashes), np.uint64(0))
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            column = b.column(group)
            codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            new = np.append(True, codes[1:] != codes[:-1])
            new[0] = not seen or column[0].as_py() != before
            if held is not None:
                yield _ended(held, bool(new[0]))
            place = np.arange(n)
            start = np.maximum.accumulate(np.where(new, place, -1))
            begun, at = start >= 0, np.maximum(start, 0)
            rank = np.where(begun, place - at, place + count)
            groups = np.cumsum(new) + seen
            out = [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(rank.astype(np.int64)), pa.array(groups == 1)]
            names = [*b.schema.names, "__part", "rank", "__head"]
            for c in (*sums, *hashes):
                own = _longs(b.column(c)) * (powers(rank) if c in hashes else np.uint64(1))
                upto = np.append(np.uint64(0), np.cumsum(own, dtype=np.uint64))
                ahead = upto[:-1] + np.where(begun, np.uint64(0) - upto[at], state[c])
                behind = ahead + own
                state[c] = behind[-1]
                out += [pa.array(ahead.view(np.int64)), pa.array(behind.view(np.int64))]
                names += [f"{c}_before", f"{c}_upto"]
            count, before, seen = int(rank[-1]) + 1, column[n - 1].as_py(), int(groups[-1])
            held = (pa.RecordBatch.from_arrays(out, names=names), new[1:])
        if held is not None:
            yield _ended(held, None)

    return scan


def _ended(held: tuple, next_is_new: bool | None) -> pa.RecordBatch:
    """A batch with ``last``: whether the next row begins another group; null
    where only a later task knows."""
    batch, new = held
    return batch.append_column("last", pa.array([*new.tolist(), next_is_new], pa.bool_()))


def _carries(runs: DataFrame, group: str, sums: list[str], hashes: list[str]):
    """By task: rows and state of its first group in earlier tasks, and
    whether its last row ends a group. One row per task is read."""
    both = [*sums, *hashes]
    first = {r[0]: r[1] for r in runs.filter("__head and rank = 0").select("__part", group).collect()}
    tails = runs.filter("last is null").select("__part", group, "__head", "rank", *[f"{c}_upto" for c in both]).collect()
    size = max(first, default=-1) + 1
    ahead, ends = np.zeros(size, np.int64), np.ones(size, bool)
    state = {c: np.zeros(size, np.uint64) for c in both}
    previous = None
    for part, g, whole, rank, *upto in sorted(tails, key=lambda r: r[0]):
        if previous is not None and previous[1] == first[part]:
            ends[previous[0]] = False
            ahead[part] = previous[2]
            for c in both:
                state[c][part] = previous[3][c]
        rows, total = rank + 1, {c: v % _WORD for c, v in zip(both, upto)}
        if whole:
            shift = pow(BASE, int(ahead[part]), _WORD)
            rows += int(ahead[part])
            total = {c: (v * (shift if c in hashes else 1) + int(state[c][part])) % _WORD for c, v in total.items()}
        previous = (part, g, rows, total)
    return ahead, ends, state


def ranked(rows: DataFrame, group: str, order: list, sums: list[str] = (), hashes: list[str] = (),
           name: str = "ranked") -> DataFrame:
    """``rows`` (staged, so that a task run again reads the same) with
    ``rank``, the place in its group from 0 in ``order`` (nulls first), and
    ``last``, whether it is the group's last row. For each long column s of
    ``sums``: ``s_before`` and ``s_upto``, the sums over the rows ahead without
    and with the row. For each long t of ``hashes`` likewise, with the digest
    sum(t * BASE ** rank) modulo 2 ** 64, which tells sequences apart.

    A null group is a group; rows that agree in ``order`` stand in any order;
    null numbers count as 0; an empty table gives an empty one.
    """
    spark = rows.sparkSession
    sums, hashes = list(sums), list(hashes)
    keys = [F.col(group), *order, F.col("__row")]
    spread = (rows.withColumn("__row", F.monotonically_increasing_id())
              .repartitionByRange(tasks_for(spark, rows.count(), 1_000_000), *keys).sortWithinPartitions(*keys).drop("__row"))
    plain = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema]
    more = [f"`{c}_{side}` long" for c in (*sums, *hashes) for side in ("before", "upto")]
    runs = stage(spark, spread.mapInArrow(_scanner(group, sums, hashes), ", ".join(
        [*plain, "__part int, rank long, __head boolean", *more, "last boolean"])), name)
    ahead, ends, state = _carries(runs, group, sums, hashes)
    kept = [*rows.columns, "rank", *[f"{c}_{side}" for c in (*sums, *hashes) for side in ("before", "upto")], "last"]

    def carry(batches):
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("__part").to_numpy()
            head = b.column("__head").to_numpy(zero_copy_only=False)
            behind = np.where(head, ahead[part], 0)
            shift = powers(behind)
            out = {c: b.column(c) for c in kept}
            out["rank"] = pa.array(b.column("rank").to_numpy() + behind)
            for c in (*sums, *hashes):
                add = np.where(head, state[c][part], np.uint64(0))
                for side in ("before", "upto"):
                    value = _longs(b.column(f"{c}_{side}")) * (shift if c in hashes else np.uint64(1))
                    out[f"{c}_{side}"] = pa.array((value + add).view(np.int64))
            last = b.column("last")
            told = last.fill_null(False).to_numpy(zero_copy_only=False)
            out["last"] = pa.array(np.where(last.is_null().to_numpy(zero_copy_only=False), ends[part], told))
            yield pa.RecordBatch.from_arrays(list(out.values()), names=kept)

    return runs.mapInArrow(carry, ", ".join([*plain, "rank long", *more, "last boolean"]))
