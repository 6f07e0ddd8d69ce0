"""Streaming jobs: T1 score JSON requests as they arrive, T2 daily increment.

T1: ``readStream`` of text files with one request per line: an object, a list
of objects, or either inside ``{"data": ...}``. An object has ``IdCliente`` or
``user_id`` and the model's features. Objects that are no JSON, have no id, or
hold a feature's value that is not of its type go to a reject sink with their
text; the rest are scored with the latest model, whose own stages cast and
impute them. Each micro-batch owns the folder of its number and replaces it,
so a batch that is replayed after a failure is not doubled.

T2: ``Trigger.AvailableNow`` over the transactions folder; each micro-batch
re-runs the dated snapshots of the days it touched and, as late activity
changes every later state, of all later dates that were already written
(idempotent dated writes).
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loyalspark.ml.score import check_features, load_latest

ID_NAMES = ("IdCliente", "user_id")


def request_schema(features: dict) -> T.StructType:
    """Schema of one scoring request: its id, under either name, and the
    feature columns (name -> type)."""
    fields = [T.StructField(n, T.StringType()) for n in ID_NAMES]
    return T.StructType([*fields, *(T.StructField(n, T.DataType.fromDDL(t) if isinstance(t, str) else t) for n, t in features.items())])


def parse_requests(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(request, text, bad) per requested object of ``lines`` (value); a line
    that holds none is one bad row. The two readings of a line, typed and as
    text, have the same objects in the same order."""
    body = F.ltrim(F.coalesce(F.get_json_object("value", "$.data"), "value"))
    # a single object is a list of one
    body = F.when(body.startswith("{"), F.concat(F.lit("["), body, F.lit("]"))).otherwise(body)
    typed = F.from_json(body, T.ArrayType(schema))
    plain = F.from_json(body, T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    objects = lines.select("value", F.explode_outer(F.arrays_zip(typed.alias("request"), plain.alias("text"))).alias("o"))
    request, text = F.col("o.request"), F.col("o.text")
    wrong = [F.try_element_at(text, F.lit(n)).isNotNull() & request[n].isNull() for n in schema.names]
    missing = F.coalesce(*[request[n] for n in ID_NAMES]).isNull()
    bad = F.coalesce(request.isNull() | missing, F.lit(True))
    for w in wrong:
        bad = bad | F.coalesce(w, F.lit(False))
    return objects.select(request.alias("request"), F.coalesce(F.to_json(text), "value").alias("text"), bad.alias("bad"))


def score_stream(spark: SparkSession, model_root: str, in_dir: str, out_dir: str, checkpoint: str,
                 features: dict, trigger_once: bool = True):
    """Start the scoring stream; returns the ``StreamingQuery``. Scores
    have ``IdCliente`` and ``user_id``, both the request's id."""
    model, meta = load_latest(spark, model_root)
    check_features(meta, features)
    schema = request_schema(features)

    def handle(batch: DataFrame, epoch: int) -> None:
        found = parse_requests(batch, schema)
        good = found.filter(~F.col("bad")).select("request.*").withColumn("user_id", F.coalesce(*ID_NAMES)).withColumn("IdCliente", F.col("user_id"))
        scored = model.transform(good).select("IdCliente", "user_id", vector_to_array("probability")[1].alias("score"))
        scored.write.mode("overwrite").parquet(os.path.join(out_dir, "scores", f"batch={epoch}"))
        found.filter("bad").select("text").write.mode("overwrite").parquet(os.path.join(out_dir, "rejected", f"batch={epoch}"))

    w = spark.readStream.text(in_dir).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="10 seconds")
    return w.start()


def run_incremental(spark: SparkSession, tx_dir: str, tx_schema: T.StructType, snapshot_path: str,
                    checkpoint: str, build):
    """For each new batch of transaction files, rebuild the dated
    snapshots of the days the batch touches and of every later date in the
    snapshot table. ``build(tx_df, cutoffs)`` is a multi-cut-off operator over
    the transaction table (e.g. ``segmentation_backfill``), which it reads up
    to the last of these dates; returns the ``StreamingQuery``."""
    from loyalspark.sources.store import _exists, write_snapshot

    def handle(batch: DataFrame, epoch: int) -> None:
        # distinct calendar days: bounded by the calendar, not by the data
        days = {r[0] for r in batch.select(F.to_date("ts").alias("d")).distinct().collect()}
        if not days:
            return
        if _exists(spark, snapshot_path):
            written = spark.read.parquet(snapshot_path).filter(F.col("ref_date") > F.lit(min(days)))
            days |= {r[0] for r in written.select("ref_date").distinct().collect()}
        cuts = sorted(d + _dt.timedelta(days=1) for d in days)
        full = spark.read.schema(tx_schema).parquet(tx_dir)
        write_snapshot(build(full, cuts), snapshot_path, sorted(days))

    stream = spark.readStream.schema(tx_schema).parquet(tx_dir)
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
