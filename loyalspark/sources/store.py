"""Sources and sinks: S1-S6, S14 helpers.

Snapshots are parquet tables partitioned by ``ref_date``; re-running a date
replaces exactly that date (dynamic partition overwrite), and a date whose
new result is empty is removed, as the delete-then-append of the original
jobs does.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.functions.expr import as_date


@dataclass(frozen=True)
class Sources:
    """S3: logical database/table name -> storage path.

    ``root/<database>/<table>`` with databases ``loyalty-system``,
    ``education-platform`` (origins) and ``analytics`` (target).
    """
    root: str

    def path(self, database: str, table: str) -> str:
        return os.path.join(self.root, database, table)


def read_source(spark: SparkSession, sources: Sources, database: str, table: str, jdbc: dict | None = None) -> DataFrame:
    """Scan an origin table: parquet below the root, or with ``jdbc``
    options (``url``, ``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``, ...) a database read in parallel ranges."""
    if jdbc:
        return spark.read.format("jdbc").options(dbtable=table, **jdbc).load()
    return spark.read.parquet(sources.path(database, table))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Scan a derived table; of a published one its current version."""
    now = current_version(spark, path)
    return spark.read.parquet(os.path.join(path, now[1]) if now else path)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _hadoop_fs(spark, path)
    return fs.exists(p)


def write_snapshot(df: DataFrame, path: str, dates=None, date_col: str = "ref_date") -> None:
    """S4 + S6: idempotent dated write.

    ``df`` is written with ``partitionBy(date_col)`` and dynamic partition
    overwrite, which replaces the dates present in ``df`` and leaves every
    other date untouched; files are published only when all tasks succeeded,
    so a failed run keeps the old partitions. Only then are those of the
    requested ``dates`` removed that the run did not write (an empty re-run
    clears its date). The target is created on first run.
    """
    spark = df.sparkSession
    wanted = sorted({as_date(x) for x in (dates or [])})

    def files(d) -> set:
        fs, p, _ = _hadoop_fs(spark, os.path.join(path, f"{date_col}={d.isoformat()}"))
        return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()

    before = {d: files(d) for d in wanted}
    (df.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(date_col).parquet(path))
    for d in wanted:  # file names carry the write's id: unchanged ones are old
        if before[d] and files(d) == before[d]:
            fs, p, _ = _hadoop_fs(spark, os.path.join(path, f"{date_col}={d.isoformat()}"))
            fs.delete(p, True)


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of all files below a folder: another value
    whenever its tables changed."""
    fs, p, _ = _hadoop_fs(spark, path)
    files, out = fs.listFiles(p, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def bytes_of(spark: SparkSession, paths) -> int:
    """Bytes of the files at or below the paths that exist."""
    total = 0
    for path in paths:
        fs, p, _ = _hadoop_fs(spark, path)
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    return total


def dates_of(spark: SparkSession, path: str, date_col: str = "ref_date") -> list:
    """Dates of a dated table, in order, from its folders' names."""
    fs, p, _ = _hadoop_fs(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(as_date(n.split("=", 1)[1]) for n in names if n.startswith(f"{date_col}="))


def read_date(spark: SparkSession, path: str, day, date_col: str = "ref_date") -> DataFrame:
    """One date of a dated table; other dates are not even listed."""
    one = os.path.join(path, f"{date_col}={as_date(day).isoformat()}")
    return spark.read.option("basePath", path).parquet(one)


def drop_dates(spark: SparkSession, path: str, since, date_col: str = "ref_date") -> None:
    """Remove the dates from ``since`` on."""
    for d in dates_of(spark, path, date_col):
        if d >= as_date(since):
            fs, p, _ = _hadoop_fs(spark, os.path.join(path, f"{date_col}={d.isoformat()}"))
            fs.delete(p, True)


class PublishConflict(RuntimeError):
    """Another writer published first."""


_POINTERS = "_versions"


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file unless it exists; the file system lets one of
    several writers through."""
    fs, p, jvm = _hadoop_fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        out = fs.create(p, False)
    except Exception as e:
        if "AlreadyExists" in str(e) or "already exists" in str(e):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def current_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, folder) that a published table's latest pointer names."""
    fs, p, jvm = _hadoop_fs(spark, os.path.join(path, _POINTERS))
    numbers = [int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()] if fs.exists(p) else []
    if not numbers:
        return None
    last = max(numbers)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(p, str(last)))
    try:
        return last, bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def publish(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Full replace. The rows go to a folder of their own; the pointer that
    makes it the table is created last, under the number after the one that
    was current when the write began. So a failed write leaves the table as it
    was, and of two writers that began from one version the second gets a
    ``PublishConflict``. Readers follow the pointer (``read_table``); the
    version before stays for those still at it, older ones are removed."""
    spark = df.sparkSession
    before = current_version(spark, path)
    folder = f"data-{uuid.uuid4().hex}"
    w = df.write.mode("errorifexists")
    number = before[0] + 1 if before else 1
    fs, p, jvm = _hadoop_fs(spark, path)
    try:
        (w.partitionBy(partition_by) if partition_by else w).parquet(os.path.join(path, folder))
    except Exception:
        fs.delete(jvm.org.apache.hadoop.fs.Path(p, folder), True)
        raise
    if not create_once(spark, os.path.join(path, _POINTERS, str(number)), folder):
        fs.delete(jvm.org.apache.hadoop.fs.Path(p, folder), True)
        raise PublishConflict(f"{path} was published by another writer meanwhile")
    held = {folder, before[1] if before else None}
    for old in range(max(1, number - 10), number - 1):
        pointer = jvm.org.apache.hadoop.fs.Path(p, f"{_POINTERS}/{old}")
        if fs.exists(pointer):
            stream = fs.open(pointer)
            name = bytes(stream.readAllBytes()).decode()
            stream.close()
            if name not in held:
                fs.delete(jvm.org.apache.hadoop.fs.Path(p, name), True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared checkpoint folder and
    read it back: iterative consumers (model fitting) then scan a compact
    table instead of recomputing the lineage, and the table survives the
    loss of executors."""
    from loyalspark.session import scratch_path
    return materialize(df, scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}"))


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to a shared folder and read it back (cuts lineage and
    survives executor loss, unlike a machine-local checkpoint)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
