"""The corpus pipeline: from raw documents to token ids.

``STAGES`` lists (name, function) in order; each function takes (spark, docs,
sf_dir), works on all that its predecessor kept and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``. All but the
last return the columns they were given. Every stage takes null, empty and
repeated texts, empty tables and extra columns, as its operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.llm import bpe, decontaminate, exact_dedup, minhash, quality
from loyalspark.llm.common import ship, stage, table
from loyalspark.llm.queries import TOKENIZER


#: Rows of an Arrow batch, so that a worker and its executor hold a few MB of
#: text at a time; Spark's 10,000 documents are tens of MB on both sides.
BATCH_ROWS = "2000"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession) -> None:
    """Sends the package to the executors and, where the session sets no batch
    size of its own, sets ``BATCH_ROWS``."""
    ship(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rule ensemble, fitted on labelled ones of
    ``docs``, rejects."""
    ready(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays, the one with the largest id."""
    ready(spark)
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, the smallest id."""
    ready(spark)
    return minhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold benchmark passages for 5 % of their
    words or more."""
    ready(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, which is given as token ids: ``ids`` (32-bit
    little-endian), their number and digest, and the decoded text's digest."""
    ready(spark)
    others = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "ids_sha256", "decoded_sha256")]
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text")
    return bpe.encode_decode(packed, TOKENIZER, "row", "text").select(
        "row.*", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: The trained classifier and near-duplicate classes are beyond SQL; tests/llm
#: holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(spark, function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
