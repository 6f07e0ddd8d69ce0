"""Model artefacts, batch scoring and run log: S14, M28, M29.

Artefacts are versioned folders ``<root>/v<N>/`` holding the Spark
``PipelineModel`` and, written last, a one-row JSON metadata table (feature
list, metrics, parameters); ``load_latest`` picks the highest version that has
it. A version's number is claimed by a file that only one writer can create.
Runs are appended as rows of a ``runs`` table.
"""

from __future__ import annotations

import datetime as _dt
import json
import os

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.sources.store import _exists, _hadoop_fs, create_once, publish


def _versions(spark: SparkSession, root: str) -> list[int]:
    fs, p, _ = _hadoop_fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("v") and name[1:].isdigit():
            out.append(int(name[1:]))
    return sorted(out)


def save_model(spark: SparkSession, model: PipelineModel, meta: dict, root: str) -> str:
    """Save as the next version; returns its folder."""
    v = max(_versions(spark, root), default=0) + 1
    while not create_once(spark, os.path.join(root, "_claims", f"v{v}"), ""):
        v += 1
    path = os.path.join(root, f"v{v}")
    model.write().overwrite().save(os.path.join(path, "model"))
    meta = dict(meta, version=v, saved_at=_dt.datetime.now(_dt.timezone.utc).isoformat())
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").json(
        os.path.join(path, "meta"))
    return path


def load_latest(spark: SparkSession, root: str):
    """(PipelineModel, metadata dict) of the highest version."""
    vs = [v for v in _versions(spark, root) if _exists(spark, os.path.join(root, f"v{v}", "meta", "_SUCCESS"))]
    if not vs:
        raise FileNotFoundError(f"no model version under {root}")
    path = os.path.join(root, f"v{vs[-1]}")
    meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
    return PipelineModel.load(os.path.join(path, "model")), meta


def score_frame(model: PipelineModel, df: DataFrame, keys=("ref_date", "user_id")) -> DataFrame:
    """Probability of the positive class for every row, keyed."""
    from pyspark.ml.functions import vector_to_array
    return model.transform(df).select(*keys, vector_to_array("probability")[1].alias("score"))


def score_batch(spark: SparkSession, model_root: str, table: DataFrame, out_path: str | None = None,
                keys=("ref_date", "user_id")) -> DataFrame:
    """Latest model on the raw scoring table -> (ref_date, user_id,
    score); the model's own stages cast and impute it. The table has to have
    the features that were saved with the model. Published under ``out_path``
    where given, replacing the scores there as a whole."""
    model, meta = load_latest(spark, model_root)
    check_features(meta, table.columns)
    scored = score_frame(model, table, keys)
    if out_path:
        publish(scored, out_path)
    return scored


def check_features(meta: dict, columns) -> None:
    missing = sorted(set(meta.get("features") or ()) - set(columns))
    if missing:
        raise ValueError(f"model version {meta.get('version')} needs features that are not there: {missing}")


def log_run(spark: SparkSession, runs_path: str, tags: dict, params: dict, metrics: dict,
            features: list[str]) -> None:
    """Append one row (tags, parameters, metrics, feature list) to the runs table."""
    row = (_dt.datetime.now(_dt.timezone.utc).isoformat(), json.dumps(tags), json.dumps(params),
           json.dumps(metrics), json.dumps(list(features)))
    (spark.createDataFrame([row], "logged_at string, tags string, params string, metrics string, features string")
     .write.mode("append").parquet(runs_path))


def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    return spark.read.parquet(runs_path).orderBy(F.desc("logged_at"))
