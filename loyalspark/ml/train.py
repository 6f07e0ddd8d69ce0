"""M16-M20 as one step: fit a pipeline on an ABT, assess it on every split,
save it with what scoring needs to check, and log the run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.ml import assess, model as mm, prepare as mp
from loyalspark.ml.score import log_run, save_model
from loyalspark.sources.store import stage


def raw_features(table: DataFrame) -> dict[str, str]:
    """Columns of an ABT that the policy knows, with their types."""
    return {c: k for c, k in table.dtypes if c in mp.feature_columns(table) and c != "split" and mp.rule_for(c)}


def pipeline_for(table: DataFrame, kind: str, **params):
    """(pipeline, train rows, raw features): the whole pipeline from raw rows
    to score, over the features that separate the labels of the train split."""
    train = table.filter((F.col("tag") != "OOT") & (F.col("split") == "train"))
    types = {c: k for c, k in table.dtypes if c in mp.feature_columns(table) and c != "split"}
    dropped = set(mp.drop_uninformative(train.drop("split"))[1])
    numeric = [c for c, k in types.items() if c not in mm.CATEGORICAL and k in ("bigint", "int", "double")
               and c not in dropped and mp.rule_for(c)]
    states = [c for c in mm.CATEGORICAL if c in types]
    pipeline = mm.build_pipeline(numeric, states, kind, prepare=mp.policy_stages(types, numeric), **params)
    return pipeline, train, [*numeric, *states]


def train(spark: SparkSession, abt: DataFrame, model_root: str, runs_path: str, kind: str = "rf",
          grid: dict | str | None = None, label: str = "label", **params) -> dict:
    """Split ``abt`` (in-time rows by label, out-of-time rows by tag), fit on
    the train rows, with a grid search where ``grid`` is given, and return the
    saved metadata: features, accuracy and AUC per split, parameters."""
    table = stage(mp.stratified_split(abt, label), "model_table")
    pipeline, rows, features = pipeline_for(table, kind, **params)
    if grid:
        fitted = mm.tune(pipeline, rows, grid, label)
        best = fitted.bestModel
        params = {**params, "cv_auc": max(fitted.avgMetrics)}
    else:
        best = pipeline.fit(rows)
    part = F.when(F.col("tag") == "OOT", "oot").otherwise(F.col("split"))
    scored = stage(mm.predict(best, table).withColumn("part", part), "scored")
    metrics = {f"{r['split']}_{name}": r[name] for r in assess.metrics(scored, label, split="part").collect() for name in ("accuracy", "auc")}
    meta = {"kind": kind, "label": label, "features": features, "metrics": metrics, "params": params}
    meta["path"] = save_model(spark, best, meta, model_root)
    log_run(spark, runs_path, {"problem": "classification", "target": label, "model": meta["path"]}, {"model_name": kind, **params}, metrics, features)
    return meta
