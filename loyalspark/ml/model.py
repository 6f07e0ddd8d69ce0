"""Model fitting: M16-M21 (Spark ML estimators, no scikit-learn).

* ``build_pipeline``  StringIndexer + OneHotEncoder for the state columns,
                      VectorAssembler, and a random forest (150 trees, min
                      leaf 30), decision tree (min leaf 10) or GBT classifier.
                      The pipeline starts with the preparation stages of
                      ``prepare.policy_stages``, so the saved model takes raw
                      feature rows. AdaBoost is in ``adaboost.py``.
* ``tune``            ``CrossValidator`` (3 folds, ROC AUC) over a grid,
                      by default the one of ``GRIDS``.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.ml.adaboost import AdaBoostClassifier

CATEGORICAL = ("state_current", "state_d28")

# Trees grow until their leaves are too small to split; 30 is as deep as
# Spark's trees go.
MAX_DEPTH = 30

# Parameter grids of the tuned models (the original's values): 48, 36 and 6 points.
GRIDS = {
    "adaboost": {"maxIter": [50, 100, 150, 200, 500, 1000], "stepSize": [0.001, 0.01, 0.05, 0.1, 0.2, 0.5, 0.9, 0.99]},
    "rf": {"numTrees": [50, 100, 150, 200, 500, 1000], "minInstancesPerNode": [3, 5, 10, 20, 30, 50]},
    "dt": {"minInstancesPerNode": [3, 5, 10, 20, 30, 50]},
}


def classifier(kind: str = "rf", label: str = "label", **params):
    if kind == "rf":
        # rows keep their node of every tree: a level would else walk each row
        # down all trees from the root; the model is the same
        p = dict(numTrees=150, minInstancesPerNode=30, maxDepth=MAX_DEPTH, seed=42, cacheNodeIds=True)
        p.update(params)
        return RandomForestClassifier(labelCol=label, featuresCol="features", **p)
    if kind == "dt":
        p = dict(minInstancesPerNode=10, maxDepth=MAX_DEPTH, seed=42)
        p.update(params)
        return DecisionTreeClassifier(labelCol=label, featuresCol="features", **p)
    if kind == "gbt":
        p = dict(maxIter=50, stepSize=0.1, maxDepth=3, seed=42)
        p.update(params)
        return GBTClassifier(labelCol=label, featuresCol="features", **p)
    if kind == "adaboost":
        return AdaBoostClassifier(labelCol=label, featuresCol="features", **{"maxIter": 150, "stepSize": 0.1, **params})
    raise ValueError(kind)


def feature_stages(numeric: list[str], categorical: list[str]) -> list:
    stages, oh = [], []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
    if categorical:
        oh = [f"{c}__oh" for c in categorical]
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=oh,
                                    dropLast=False, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=list(numeric) + oh, outputCol="features", handleInvalid="keep"))
    return stages


def build_pipeline(numeric: list[str], categorical: list[str] = (), kind: str = "rf",
                   label: str = "label", prepare: list = (), **params) -> Pipeline:
    """Preparation (``prepare.policy_stages``), encoding and model as one
    pipeline, saved and loaded as a whole."""
    return Pipeline(stages=[*prepare, *feature_stages(numeric, list(categorical)), classifier(kind, label, **params)])


def tune(pipeline: Pipeline, train: DataFrame, grid: dict | str, label: str = "label", folds: int = 3,
         parallelism: int = 2, seed: int = 42):
    """Grid search with k-fold CV on ROC AUC, refit on all ``train``.
    ``grid`` maps parameters to values, or names one of ``GRIDS``."""
    grid = GRIDS[grid] if isinstance(grid, str) else grid
    est = pipeline.getStages()[-1]
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=b.build(),
                        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0),
                        numFolds=folds, parallelism=parallelism, seed=seed)
    return cv.fit(train)


def with_score(scored: DataFrame) -> DataFrame:
    """Probability of the positive class as a double column ``score``."""
    return scored.withColumn("score", vector_to_array("probability")[1])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's output and ``score``."""
    return with_score(model.transform(df))
