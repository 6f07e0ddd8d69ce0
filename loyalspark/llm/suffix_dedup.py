"""Removal of byte strings that occur more than once, by a distributed
difference-cover suffix sort cut off at the length that counts.

With a difference cover D modulo v, any two suffixes have an offset below v at
which both are sampled (position mod v in D). The steps:

1. Sort sampled triples. Each sampled suffix is named by a triple of blocks,
   and, recursing on names, by a triple of such names: 9 blocks, at least
   ``length - v + 1`` bytes. Names are fingerprints, so every task gives equal
   strings equal names without an exchange per level; they are dealt to tasks
   by range and sorted, and equal neighbours mark the samples whose prefix
   occurs elsewhere. All others are ranked for good and drop out.
2. Merge the remaining suffixes. A string of ``length`` bytes that occurs twice
   covers a marked sample within its first v bytes, so only suffixes shortly
   before a marked sample are left. They are named by their first ``length``
   bytes (96 bits), dealt by range and sorted.
3. Compare adjacent prefixes: equal neighbours are repeats. Their bytes are
   covered and removed.

What travels is packed: a task sends the sorted distinct names of its bucket
of texts to each range, and gets one bit per name back; as it can work out the
same names again, no position is ever sent. A name that occurs in a bucket
many times is sent once, so a passage that a third of all texts share costs a
range one name per bucket. Step 2 runs in passes over parts of the name space,
so that no pass moves much more than the input's size. Buckets and ranges have
a fixed size; their number grows with the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, slices, stage, text_or_empty, utf8
from .words import powers

# Difference covers (every residue is a difference of two members).
COVERS = {
    3: (1, 2),
    7: (1, 2, 4),
    13: (0, 1, 3, 9),
    31: (1, 5, 11, 24, 25, 27),
    57: (0, 1, 6, 15, 22, 26, 45, 55),
}
#: Bytes of text in a bucket and of names in a range, both about.
BUCKET_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
#: Bytes of a name in step 2.
NAME_BYTES = 12

_A, _B = 0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1
_TABLES = [mix(np.arange(1 + k, 257 + k, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) for k in (0, 1000)]


class Prefixes:
    """Fingerprints of any byte strings of one slice of texts."""

    def __init__(self, raw: np.ndarray, lane: int = 0):
        base = (_A, _B)[lane]
        self.back = powers(pow(base, -1, 1 << 64), len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_TABLES[lane][raw] * powers(base, len(raw)), dtype=np.uint64, out=self.sums[1:])

    def name(self, at: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[at + length] - self.sums[at]) * self.back[at])

    def triple(self, at: np.ndarray, block: int, level: int) -> np.ndarray:
        """Name of three names of the level below; level 0 names a block."""
        if level == 0:
            return self.name(at, block)
        step = block * 3 ** (level - 1)
        out = self.triple(at, block, level - 1)
        for k in (1, 2):
            out *= np.uint64(0xD6E8FEB86659FD93)
            out += self.triple(at + k * step, block, level - 1)
        return mix(out)


class Shape:
    """Cover, block size and counts of one run; the same in every task."""

    def __init__(self, length: int, ranges: int = 1, passes: int = 1):
        self.length, self.ranges, self.passes = length, ranges, passes
        fit = [v for v in COVERS if (length - v + 1) // 9 >= 1 and v <= length // 3]
        if not fit:
            raise ValueError("strings of 11 bytes or more can be searched for")
        self.period = max(fit)
        self.block = (length - self.period + 1) // 9
        self.cover = np.zeros(self.period, bool)
        self.cover[list(COVERS[self.period])] = True

    def range_of(self, names: np.ndarray, ranges: int) -> np.ndarray:
        return ((names >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


class Bucket:
    """The texts of a bucket in an order that every pass finds again."""

    def __init__(self, table: pa.Table):
        table = table.take(pa.array(np.argsort(table.column("k").to_numpy(), kind="stable")))
        self.ids = table.column("id").combine_chunks()
        self.raw, self.offsets = utf8(table.column("text"))

    def pieces(self, shape: Shape):
        """(bytes, offsets, sampled suffixes, their texts) slice by slice."""
        longest = int(np.diff(self.offsets).max(initial=0))
        places = np.flatnonzero(np.resize(shape.cover, max(0, longest - 9 * shape.block + 1)))
        for lo, hi in slices(self.offsets):
            off = self.offsets[lo: hi + 1] - self.offsets[lo]
            count = np.searchsorted(places, np.diff(off) - 9 * shape.block, side="right")
            text = np.repeat(np.arange(hi - lo), count)
            at = places[np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)] + off[text]
            yield self.raw[self.offsets[lo]: self.offsets[hi]], off, at, text

    def samples(self, shape: Shape):
        """Names of all sampled suffixes, in order."""
        return np.concatenate([np.zeros(0, np.uint64)] + [
            Prefixes(raw).triple(at, shape.block, 2) for raw, _, at, _ in self.pieces(shape)])

    def windows(self, shape: Shape, told: pa.Table):
        """(hi, lo, starts): names and starts of all remaining suffixes, those
        within a period before a sampled suffix whose name repeats."""
        names = self.samples(shape)
        order, first, count = _distinct(names)
        marked = np.zeros(len(names), bool)
        marked[order] = np.repeat(_replied(told, count, "samples"), count)
        hi, lo, starts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        done = base = 0
        for raw, off, at, text in self.pieces(shape):
            mark = marked[done: done + len(at)]
            done += len(at)
            at, text = at[mark], text[mark]
            from_, to = np.maximum(at - shape.period + 1, off[text]), np.minimum(at, off[text + 1] - shape.length)
            fits = from_ <= to
            edge = (np.bincount(from_[fits], minlength=len(raw) + 1) - np.bincount(to[fits] + 1, minlength=len(raw) + 1))
            begin = np.flatnonzero(np.cumsum(edge[:-1]))
            if len(begin):
                hi.append(Prefixes(raw).name(begin, shape.length))
                lo.append((Prefixes(raw, 1).name(begin, shape.length) >> np.uint64(32)).astype(np.uint32))
                starts.append(begin + base)
            base += len(raw)
        return np.concatenate(hi), np.concatenate(lo), np.concatenate(starts)


def _distinct(hi: np.ndarray, lo: np.ndarray | None = None):
    """(order, first, count): sorted order, where each distinct name first
    stands in it, and how often it occurs."""
    order = np.argsort(hi)
    h = hi[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if lo is not None:
        low = lo[order]
        if len(h) and (~new[1:] & (low[1:] != low[:-1])).any():
            order = np.lexsort((lo, hi))
            h, low = hi[order], lo[order]
            new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(h)))


def _dealt(bucket: int, parts: np.ndarray, data: np.ndarray) -> pa.Table:
    """One row (part, bucket, names) per part, from sorted parts."""
    cut = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(parts) else np.zeros(0, np.int64)
    ends = np.append(cut, len(parts)).astype(np.int64) * data.itemsize
    names = pa.Array.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())])
    return pa.table({"part": pa.array(parts[cut].astype(np.int64)), "bucket": pa.array(np.full(len(cut), bucket, np.int64)),
                     "names": names.cast(pa.binary())})


def _compared(kind) -> callable:
    """Sorts the names of a range and compares neighbours: one bit per name."""
    def run(key, table):
        sent = [np.frombuffer(x.as_buffer(), kind) for x in table.column("names")]
        names = np.concatenate(sent)
        if kind == np.dtype("<u4"):
            order = np.argsort(names)
            equal = names[order][1:] == names[order][:-1]
        else:
            order = np.argsort(np.ascontiguousarray(names["hi"]))
            h, low = names["hi"][order], names["lo"][order]
            if (low[1:] != low[:-1])[h[1:] == h[:-1]].any():
                order = np.lexsort((names["lo"], names["hi"]))
                h, low = names["hi"][order], names["lo"][order]
            equal = (h[1:] == h[:-1]) & (low[1:] == low[:-1])
        hit = np.zeros(len(names), bool)
        hit[order[1:][equal]] = True
        hit[order[:-1][equal]] = True
        cut = np.cumsum([len(x) for x in sent])[:-1]
        return pa.table({
            "bucket": table.column("bucket"), "part": table.column("part"),
            "n": pa.array([len(x) for x in sent], pa.int64()), "hits": pa.array([int(x.sum()) for x in np.split(hit, cut)], pa.int64()),
            "bits": pa.array([np.packbits(x).tobytes() for x in np.split(hit, cut)], pa.binary())})
    return run


_WIDE = np.dtype([("hi", "<u8"), ("lo", "<u4")])
_SENT = "part long, bucket long, names binary"
_REPLY = "bucket long, part long, n long, hits long, bits binary"


def _replied(table: pa.Table, count: np.ndarray, step: str) -> np.ndarray:
    """Whether each distinct name of the bucket repeats, here or elsewhere."""
    rows = sorted((r for r in table.to_pylist() if r["step"] == step), key=lambda r: r["part"])
    bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool) for r in rows]
    told = np.concatenate(bits) if bits else np.zeros(0, bool)
    if len(told) != len(count):
        raise RuntimeError("names of a bucket differ between passes: the input changed meanwhile")
    return told | (count > 1)


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   bucket_bytes: int = BUCKET_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, n_bytes, spans, kept) for every row of ``docs``.

    ``spans`` are the maximal byte ranges covered by a string of ``length``
    bytes that also starts anywhere else (same text included, overlaps count);
    ``kept`` are the other bytes, in order. Matches never cross texts and are
    judged on the input. Null and empty texts have no bytes; equal rows are
    texts like any other and so repeat each other. Other columns are not
    looked at. A task holds one bucket, or one text that is larger than that.

    Names of 96 bits and the range they fall in make a false match less likely
    than 1 in 10 ** 6 up to 10 ** 13 remaining suffixes.
    """
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    total = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    shape = Shape(length)
    ranges = max(1, -(-4 * total * int(shape.cover.sum()) // shape.period // range_bytes))
    # by id and text: no id, however frequent, gathers in one bucket
    texts = src.withColumn("k", F.xxhash64("id", "text")).withColumn("bucket", F.pmod(F.col("k"), F.lit(buckets)))

    def sample(key, table):
        names = Bucket(table).samples(shape)
        order, first, _ = _distinct(names)
        names = names[order][first]
        return _dealt(key[0].as_py(), shape.range_of(names, ranges), (names & np.uint64(0xFFFFFFFF)).astype("<u4"))

    sent = texts.groupBy("bucket").applyInArrow(sample, _SENT)
    replies = stage(spark, sent.groupBy("part").applyInArrow(_compared(np.dtype("<u4")), _REPLY)
                    .withColumn("step", F.lit("samples")), "suffix-samples")
    left = (replies.agg(F.sum("hits")).first()[0] or 0) * shape.period // int(shape.cover.sum())
    passes = min(NAME_BYTES, max(1, -(-NAME_BYTES * left // max(1, total))))
    parts = max(1, -(-NAME_BYTES * left // range_bytes // passes)) * passes

    def remaining(t: int):
        lowest, highest = t * parts // passes, (t + 1) * parts // passes

        def run(key, table, told):
            bucket = Bucket(table)
            hi, lo, _ = bucket.windows(shape, told)
            part = shape.range_of(hi, parts)
            mine = (part >= lowest) & (part < highest)
            hi, lo = hi[mine], lo[mine]
            order, first, _ = _distinct(hi, lo)
            out = np.empty(len(first), _WIDE)
            out["hi"], out["lo"] = hi[order][first], lo[order][first]
            return _dealt(key[0].as_py(), shape.range_of(out["hi"], parts), out)
        return run

    told = replies
    for t in range(passes):
        sent = texts.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(remaining(t), _SENT)
        told = told.unionByName(stage(
            spark, sent.groupBy("part").applyInArrow(_compared(_WIDE), _REPLY).withColumn("step", F.lit("windows")),
            f"suffix-windows-{t}"))

    kind = src.schema["id"].dataType.simpleString()

    def cover(key, table, told):
        bucket = Bucket(table)
        hi, lo, starts = bucket.windows(shape, told)
        order, first, count = _distinct(hi, lo)
        hit = np.zeros(len(hi), bool)
        hit[order] = np.repeat(_replied(told, count, "windows"), count)
        at, size = starts[hit], len(bucket.raw) + 1
        gone = np.cumsum(np.bincount(at, minlength=size) - np.bincount(at + length, minlength=size))[:-1] > 0
        before = np.concatenate([[0], np.cumsum(gone)])[bucket.offsets]
        spans, kept = [], []
        for a, b, n in zip(bucket.offsets[:-1].tolist(), bucket.offsets[1:].tolist(), np.diff(before).tolist()):
            if not n:
                spans.append([])
                kept.append(bucket.raw[a:b].tobytes())
                continue
            step = np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8))
            spans.append([{"start": x, "end": y} for x, y in
                          zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist())])
            kept.append(bucket.raw[a:b][~gone[a:b]].tobytes())
        return pa.table({"id": bucket.ids, "n_bytes": pa.array(np.diff(bucket.offsets), pa.int64()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                         "kept": pa.array(kept, pa.binary())})

    out = texts.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(
        cover, f"id {kind}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
    return out.withColumnRenamed("id", id_col)

