"""Shared helpers: tables, shared-folder staging, Arrow text buffers."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Text bytes handled at once inside a task: numpy temporaries take about 60
# times this. A longer single text is a slice of its own.
SLICE_BYTES = 1 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that
    their Python workers can import it wherever the driver was started."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        where = tempfile.mkdtemp(prefix="llm-ship-")
        name = shutil.make_archive(f"{where}/{os.path.basename(root)}", "zip", os.path.dirname(root), os.path.basename(root))
        spark.sparkContext.addPyFile(name)
        _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a scratch
    folder of this machine only where that is unset (tests, local runs)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


#: The shuffle files behind a staged table go as soon as it is written.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    and survives lost executors."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEAN_UP) if before is None else spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def tasks_for(spark: SparkSession, rows: int, per_task: int) -> int:
    """Number of tasks that deals ``rows`` in shares of ``per_task`` at most."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows // per_task))


def join_hot(left: DataFrame, right: DataFrame, on: list[str], share: int = 1000, how: str = "inner") -> DataFrame:
    """Inner or left join of a staged ``left`` with a staged ``right``, which has one
    row per key, where few keys may hold most rows of ``left``.

    Keys with more than one ``share``-th of the left rows are less than
    ``share`` in number, so their right rows are broadcast and their left rows
    stay where they are; all other rows are shuffled by key.
    """
    total = left.count()
    counts = left.groupBy(*on).count().filter(F.col("count") > max(total // share, 100))
    hot = counts.drop("count").collect()
    if not hot:
        return left.join(right, on, how)
    few = F.broadcast(left.sparkSession.createDataFrame(hot, left.select(*on).schema))
    return (left.join(few, on, "left_semi").join(F.broadcast(right.join(few, on, "left_semi")), on, how)
            .unionByName(left.join(few, on, "left_anti").join(right, on, how)))


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; null is
    empty. Text i is ``bytes[offsets[i]:offsets[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[column.offset: column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges (lo, hi) whose texts together take about ``limit`` bytes."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def size_of(df: DataFrame, limit: int) -> bool:
    """Whether a staged table has at most ``limit`` rows."""
    return df.limit(limit + 1).count() <= limit


def join_small(left: DataFrame, right: DataFrame, on, how: str, limit: int) -> DataFrame:
    """Join with a staged ``right``: broadcast up to ``limit`` rows of it, a
    shuffle join (split at hot keys by adaptive execution) beyond."""
    return left.join(F.broadcast(right) if size_of(right, limit) else right, on, how)


#: Rows (about 50 bytes each) of a table of dropped documents that may be broadcast.
MAX_BROADCAST_IDS = 500_000


def keep_rows(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that ``decided`` (id, sha, kept; staged) keeps, all
    columns unchanged. Rows are told apart by id and SHA-256 of the text; of
    kept rows that repeat both, one stays. A null id is an id like any other.

    Only the dropped ids travel, unless they are too many for a broadcast.
    """
    lost = stage(docs.sparkSession, decided.filter(~F.col("kept")).select(
        F.col("id").alias("__id"), F.col("sha").alias("__sha")).distinct(), "lost")
    sha = F.unhex(F.sha2(text_or_empty(text_col), 256))
    side = F.broadcast(lost) if size_of(lost, MAX_BROADCAST_IDS) else lost
    rest = docs.join(side, F.col(id_col).eqNullSafe(F.col("__id")) & (sha == F.col("__sha")), "left_anti")
    repeated = decided.filter("kept").groupBy("id", "sha").count().filter("count > 1").limit(1).count()
    return rest.withColumn("__sha", sha).dropDuplicates([id_col, "__sha"]).drop("__sha") if repeated else rest
