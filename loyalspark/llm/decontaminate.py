"""Benchmark decontamination.

The benchmark's normalised word windows form a hash set that every task gets;
tasks scan the word windows of their documents, look hits up, verify them on
the words themselves and mark every word inside an occurrence. The set is
broadcast in blocks of at most ``MAX_WINDOWS`` windows, so its size is bounded
however large the benchmark is; each further block is one more scan.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import slices, stage, text_or_empty, utf8

#: Words in a window.
WINDOW = 13
#: Windows in one broadcast set: about 80 MB in a task at most.
MAX_WINDOWS = 200_000
_BITS = 20


class WindowSet:
    """Windows of one block: per length a bitmap, and the exact text of each."""

    def __init__(self, rows):
        self.items: dict[bytes, list[str]] = defaultdict(list)
        by_size: dict[int, set[bytes]] = defaultdict(set)
        for size, text, item in rows:
            self.items[text].append(item)
            by_size[size].add(text)
        self.hashes: dict[int, np.ndarray] = {}
        self.maybe: dict[int, np.ndarray] = {}
        for size, texts in by_size.items():
            raw, offsets = utf8(pa.array([t.decode("utf-8") for t in texts]))
            s, e, first = W.words(raw, offsets)
            h = np.unique(W.windows(W.word_hashes(raw, s, e), size)[first[:-1]])
            self.hashes[size] = h
            self.maybe[size] = np.zeros(1 << _BITS, bool)
            self.maybe[size][(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def hits(self, raw, s, e, owner, hashes):
        """(first word, size, item ids) of every verified occurrence."""
        for size, known in self.hashes.items():
            w = W.windows(hashes, size)
            at = np.flatnonzero(self.maybe[size][(w >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = at[owner[at] == owner[at + size - 1]]
            k = np.searchsorted(known, w[at])
            at = at[known[np.minimum(k, len(known) - 1)] == w[at]]
            for i in at.tolist():
                ids = self.items.get(W.text_of(raw, s, e, i, i + size))
                if ids:
                    yield i, size, ids


def mark(windows: WindowSet, raw, offsets, ranges, items):
    """Per text: (n_words, n_hit, item ids, byte spans, word ranges), with the
    word ranges and ids that earlier blocks found added to this block's."""
    s, e, first = W.words(raw, offsets)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    diff = np.zeros(len(s) + 1, np.int64)
    found = {i: set(x) for i, x in enumerate(items) if x}
    for i, spans in enumerate(ranges):
        for r in spans or ():
            diff[first[i] + r["start"]] += 1
            diff[first[i] + r["end"]] -= 1
    for i, size, ids in windows.hits(raw, s, e, owner, W.word_hashes(raw, s, e)):
        found.setdefault(int(owner[i]), set()).update(ids)
        diff[i] += 1
        diff[i + size] -= 1
    hit = np.cumsum(diff[:-1]) > 0
    total = np.concatenate([[0], np.cumsum(hit)])
    out = []
    for i in range(n):
        lo, hi = first[i], first[i + 1]
        n_hit, spans, runs = int(total[hi] - total[lo]), [], []
        if n_hit:
            step = np.diff(np.concatenate([[False], hit[lo:hi], [False]]).astype(np.int8))
            for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
                runs.append({"start": a, "end": b})
                spans.append({"start": int(s[lo + a] - offsets[i]), "end": int(e[lo + b - 1] - offsets[i])})
        out.append((int(hi - lo), n_hit, sorted(found.get(i, ())), spans, runs))
    return out


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """(size, text, item): the windows of every item, as bytes of words joined
    by a space. An item with fewer words than ``window`` is one window; one
    without words has none. A null id is written ``null``."""
    def run(batches):
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            s, e, first = W.words(raw, offsets)
            rows = []
            for i, item in enumerate(b.column("item").to_pylist()):
                lo, hi = int(first[i]), int(first[i + 1])
                size = min(window, hi - lo)
                rows += [(size, W.text_of(raw, s, e, k, k + size), item)
                         for k in range(lo, hi - size + 1) if size]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.string())], names=["size", "text", "item"])

    src = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"),
                           text_or_empty(text_col).alias("text"))
    return src.mapInArrow(run, "size int, text binary, item string").distinct()


def window_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
                  window: int = WINDOW, limit: int = MAX_WINDOWS):
    """The benchmark's windows as WindowSets of at most about ``limit`` windows
    each; all rows of a window fall in one block."""
    spark = benchmark.sparkSession
    rows = stage(spark, benchmark_windows(benchmark, id_col, text_col, window), "windows")
    blocks = max(1, -(-2 * rows.count() // limit)) if limit else 1
    for k in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k) if blocks > 1 else rows
        yield WindowSet([(r.size, bytes(r.text), r.item) for r in part.toLocalIterator()])


SPANS = "array<struct<start: long, end: long>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
         limit: int = MAX_WINDOWS) -> DataFrame:
    """(id, n_words, n_hit, items, spans) for every row of ``docs``.

    ``spans`` are the byte ranges of maximal runs of hit words in the UTF-8
    text. A null text has no words. An empty benchmark hits nothing. Rows that
    repeat are each judged; other columns are not looked at.
    """
    spark = docs.sparkSession
    out = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"),
                      F.lit(None).cast("array<string>").alias("items"), F.lit(None).cast(SPANS).alias("ranges"))
    kind = out.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, text string, n_words long, n_hit long, items array<string>, "
              f"spans {SPANS}, ranges {SPANS}")
    blocks = window_blocks(benchmark, item_col, item_text, window, limit)
    windows = next(blocks)
    while windows is not None:
        known, following = spark.sparkContext.broadcast(windows), next(blocks, None)

        def run(batches, known=known, last=following is None):
            for b in batches:
                raw, offsets = utf8(b.column("text"))
                ranges, items = b.column("ranges").to_pylist(), b.column("items").to_pylist()
                rows = []
                for lo, hi in slices(offsets):
                    rows += mark(known.value, raw[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo],
                                 ranges[lo:hi], items[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.nulls(len(rows), pa.string()) if last else b.column("text"),
                     pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                     pa.array([r[2] for r in rows], pa.list_(pa.string())),
                     pa.array([r[3] for r in rows], _SPANS), pa.array([r[4] for r in rows], _SPANS)],
                    names=["id", "text", "n_words", "n_hit", "items", "spans", "ranges"])

        out = out.select("id", "text", "items", "ranges").mapInArrow(run, schema)
        if following is not None:  # one block's set in a task at a time
            out = stage(spark, out, "scan")
        windows = following
    return out.select(F.col("id").alias(id_col), "n_words", "n_hit", "items", "spans")


def contaminated(n_hit, n_words):
    """A document is contaminated when hit words are 5 % of its words or more."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", mode: str = "documents",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  limit: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` without contaminated rows (``mode="documents"``) or with every
    hit span cut out of the texts (``mode="spans"``); all columns stay.

    Each row is packed as one struct that travels beside its text, so any
    column names and types do and nothing is shuffled.
    """
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    packed = packed.withColumn("text", F.col("row").getField(text_col).cast("string"))
    found = scan(packed, benchmark, "row", "text", item_col, item_text, window, limit)
    if mode == "documents":
        return found.filter(~contaminated(F.col("n_hit"), F.col("n_words"))).select("row.*")
    whole = F.encode(text_or_empty(f"row.{text_col}"), "utf-8")
    edges = F.concat(F.array(F.lit(0).cast("long")),
                     F.flatten(F.transform("spans", lambda x: F.array(x["start"], x["end"]))))
    kept = F.transform(F.sequence(F.lit(0), F.size("spans")), lambda k: F.decode(F.substring(
        whole, F.element_at(edges, 2 * k + 1).cast("int") + 1,
        (F.coalesce(F.try_element_at(edges, 2 * k + 2), F.octet_length(whole).cast("long"))
         - F.element_at(edges, 2 * k + 1)).cast("int")), "utf-8"))
    cut = found.withColumn("__cut", F.when(F.size("spans") > 0, F.array_join(kept, ""))
                           .otherwise(F.col("row").getField(text_col)))
    return cut.select(*[F.col("__cut").alias(c) if c == text_col else F.col("row").getField(c).alias(c)
                        for c in names])
