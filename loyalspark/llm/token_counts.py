"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are additive, so a batch of
inserts, deletes and revised counts is kept as signed sums: one small table of
deltas per batch, combined map-side before the only shuffle. A batch is
committed by writing the folder that its name determines, so committing it
again replaces equal rows and changes nothing. ``compact`` folds batches into
a new base that also lists their names; a batch named there no longer counts
when it is committed again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, text_or_empty, utf8

KEYS = ["source", "lang", "tokenizer"]
_SCHEMA = "source string, lang string, tokenizer string, docs long, tokens long"
_LISTED = "name string"

# Classes of bytes of UTF-8: 1 digit, 2 letter (ASCII letters and every byte of
# a longer character), 3 printable ASCII mark, 0 anything else.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 3
_CLASS[48:58] = 1
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = 2


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])[offsets]
    return np.diff(total)


def _runs(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of runs in each text; no run spans two texts."""
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    start[first] = inside[first]
    return _per_text(start, offsets)


def words(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Runs of digits and letters."""
    return _runs((kinds == 1) | (kinds == 2), offsets)


def words_and_digits(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Runs of letters, and each digit by itself."""
    return _runs(kinds == 2, offsets) + _per_text(kinds == 1, offsets)


def pieces(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words, and each mark by itself."""
    return words(kinds, offsets) + _per_text(kinds == 3, offsets)


def count_tokens(docs: DataFrame, counters: dict, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with a long column per counter, each a
    function of (classes of bytes, offsets). Null counts as empty."""
    others = [c for c in docs.columns if c != text_col]
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), text_or_empty(text_col).alias("text"))

    def run(batches):
        for b in batches:
            raw, offsets = utf8(b.column("text"))
            found = {name: [] for name in counters}
            for lo, hi in slices(offsets):
                kinds, off = _CLASS[raw[offsets[lo]: offsets[hi]]], offsets[lo: hi + 1] - offsets[lo]
                for name, f in counters.items():
                    found[name].append(f(kinds, off))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), *[pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for x in found.values()]],
                names=["row", *found])

    out = src.mapInArrow(run, f"row {src.schema['row'].dataType.simpleString()}, " + ", ".join(f"`{c}` long" for c in counters))
    return out.select("row.*", *[F.col(f"`{c}`") for c in counters])


def deltas(counted: DataFrame, counts: dict[str, Column], sign: int = 1, docs: int = 1) -> DataFrame:
    """Signed rows of ``counted`` (source, lang, ...): one per document and
    tokenizer version. ``docs=0`` changes tokens only."""
    rows = F.array(*[F.struct(F.lit(name).alias("tokenizer"), c.cast("long").alias("n")) for name, c in counts.items()])
    out = counted.select(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                         F.explode(rows).alias("c"))
    return out.select("source", "lang", "c.tokenizer", F.lit(sign * docs).cast("long").alias("docs"),
                      (F.coalesce("c.n", F.lit(0)) * sign).alias("tokens"))


def inserts(counted: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return deltas(counted, counts)


def deletes(counted: DataFrame, counts: dict[str, Column]) -> DataFrame:
    return deltas(counted, counts, sign=-1)


def revisions(counted: DataFrame, old: dict[str, Column], new: dict[str, Column]) -> DataFrame:
    """Counts that a tokenizer version gave before and gives now."""
    return deltas(counted, old, sign=-1, docs=0).unionByName(deltas(counted, new, docs=0))


class Rollup:
    """Totals under one folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def commit(self, batch: str, changes: DataFrame) -> None:
        """Add a batch of signed rows; a batch of the same name is replaced,
        so a job that ran twice or was cut off can simply be run again."""
        if not batch or not all(c.isalnum() or c in "-_." for c in batch) or batch.startswith((".", "_")):
            raise ValueError("a batch's name consists of letters, digits, '-', '_' and '.'")
        summed = changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        self._write(summed, f"deltas/batch={batch}")

    def _write(self, df: DataFrame, where: str) -> None:
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{where}")

    def _read(self, where: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{where}")
        except Exception as e:  # an absent folder is an empty rollup
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise

    def _base(self) -> int:
        """Number of the latest complete base; 0 without any."""
        done = self._read("bases", _LISTED + ", base int")
        return done.agg(F.max("base")).first()[0] or 0 if done is not None else 0

    def _open(self, base: int) -> DataFrame | None:
        """Batches that the base does not hold."""
        held = self._read("deltas", _SCHEMA + ", batch string")
        if held is None or not base:
            return held
        listed = self.spark.read.schema(_LISTED).parquet(f"{self.path}/bases/base={base}")
        return held.join(listed, F.col("batch") == F.col("name"), "left_anti")

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, docs, tokens); groups that have come down
        to nothing are left out. Null sources and languages are groups."""
        base = self._base()
        parts = [self._open(base)]
        if base:
            parts.append(self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/totals/base={base}"))
        parts = [p.select(*KEYS, "docs", "tokens") for p in parts if p is not None]
        if not parts:
            return self.spark.createDataFrame([], _SCHEMA)
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return (rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs != 0 or tokens != 0"))

    def compact(self) -> None:
        """Fold all batches into a new base. The list of names is written
        last and makes the base count, so a cut-off run changes nothing."""
        base = self._base()
        held = self._open(base)
        if held is None:
            return
        names = held.select(F.col("batch").alias("name")).distinct()
        if base:
            names = names.unionByName(self.spark.read.schema(_LISTED).parquet(f"{self.path}/bases/base={base}"))
        self._write(self.totals(), f"totals/base={base + 1}")
        self._write(names, f"bases/base={base + 1}")
