"""Binary SAMME boosting (Zhu et al., 2009) over decision stumps.

Features are cut into at most ``maxBins`` (255 at most) bins once; the binned
rows are staged as one compact column of bytes, with their weights. A round is
one scan of that table: every task brings its rows' weights up to date with the
stumps found since they were written and adds them up per feature, bin and
label. Tasks' sums are merged in Spark, ``MERGE`` at a time, so the driver gets
at most that many arrays of features x bins. After ``REWEIGH`` rounds the
weights are written anew, so a row never replays more stumps than that. The
model is a list of (feature, threshold,
side) with weights; it scores with one column expression over the feature
vector, and is saved as parameters.
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol,
                                     HasRawPredictionCol, HasStepSize)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.session import scratch_path


#: Rounds after which rows are written with their weights; tasks' sums merged at once.
REWEIGH, MERGE = 50, 64


class _AdaBoostParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol):
    pass


class AdaBoostModel(Model, _AdaBoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Stumps: where feature <= threshold the vote is ``votes`` (+1 or -1),
    else its opposite, with weight ``alphas``."""
    features = Param(Params._dummy(), "features", "feature of each stump", TypeConverters.toListInt)
    thresholds = Param(Params._dummy(), "thresholds", "threshold of each stump", TypeConverters.toListFloat)
    votes = Param(Params._dummy(), "votes", "vote at or below the threshold", TypeConverters.toListFloat)
    alphas = Param(Params._dummy(), "alphas", "weight of each stump", TypeConverters.toListFloat)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(features=[], thresholds=[], votes=[], alphas=[], size=0)

    def _transform(self, df: DataFrame) -> DataFrame:
        stumps = F.array(*[F.struct(F.lit(int(f)).alias("f"), F.lit(float(t)).alias("t"), F.lit(float(v * a)).alias("v"))
                           for f, t, v, a in zip(*(self.getOrDefault(p) for p in ("features", "thresholds", "votes", "alphas")))])
        total = sum(self.getOrDefault("alphas"))
        if total:
            out = df.withColumn("__x", vector_to_array(self.getFeaturesCol()))
            # a missing value is above every threshold, as in training
            vote = F.aggregate(stumps, F.lit(0.0), lambda s, x: s + F.when(
                F.element_at("__x", x["f"] + 1) <= x["t"], x["v"]).otherwise(-x["v"]))
            out = out.withColumn("__f", vote / F.lit(total)).drop("__x")
        else:
            out = df.withColumn("__f", F.lit(0.0))
        p = 1 / (1 + F.exp(-2 * F.col("__f")))
        return (out.withColumn(self.getRawPredictionCol(), array_to_vector(F.array(-F.col("__f"), F.col("__f"))))
                .withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - p, p)))
                .withColumn(self.getPredictionCol(), (F.col("__f") > 0).cast("double")).drop("__f"))

    @property
    def featureImportances(self):
        """Share of the votes' weight that each feature decides."""
        from pyspark.ml.linalg import Vectors
        out = np.zeros(self.getOrDefault("size"))
        for f, a in zip(self.getOrDefault("features"), self.getOrDefault("alphas")):
            out[f] += a
        return Vectors.dense(out / out.sum() if out.sum() else out)


class AdaBoostClassifier(Estimator, _AdaBoostParams, HasMaxIter, HasStepSize, DefaultParamsReadable, DefaultParamsWritable):
    maxBins = Param(Params._dummy(), "maxBins", "bins a feature is cut into at most", TypeConverters.toInt)

    def __init__(self, **params):
        super().__init__()
        self._setDefault(maxIter=150, stepSize=0.1, maxBins=64, labelCol="label", featuresCol="features")
        self._set(**params)

    def _fit(self, df: DataFrame) -> AdaBoostModel:
        spark, bins = df.sparkSession, self.getOrDefault("maxBins")
        if not 2 <= bins <= 255:
            raise ValueError(f"maxBins is {bins}; a bin is stored in one byte, so 2 to 255 are possible")
        rows = df.select(vector_to_array(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        first = rows.first()
        size = len(first["x"]) if first else 0
        model = AdaBoostModel()
        self._copyValues(model)
        if not size:
            return model._set(size=0)
        # one aggregate for all cut points: at most bins - 1 per feature
        at = [i / bins for i in range(1, bins)]
        cuts = rows.agg(*[F.percentile_approx(F.nanvl(F.col("x")[i], F.lit(None)), at, 10_000).alias(f"c{i}") for i in range(size)]).first()
        edges = [np.unique(np.array([v for v in (cuts[i] or []) if v is not None], float)) for i in range(size)]

        def binned(batches):
            for b in batches:
                x = np.array(b.column("x").to_pylist(), float).reshape(b.num_rows, size)
                codes = np.empty(x.shape, np.uint8)
                for i, e in enumerate(edges):
                    codes[:, i] = np.searchsorted(e, x[:, i], side="left")  # NaN goes last
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in codes], pa.binary()), b.column("y"), pa.array(np.ones(len(codes)))],
                                                 names=["x", "y", "w"])

        def staged(frame: DataFrame) -> DataFrame:
            path = scratch_path(spark, f"adaboost-{uuid.uuid4().hex}")
            frame.write.parquet(path)
            return spark.read.parquet(path)

        data = staged(rows.mapInArrow(binned, "x binary, y double, w double"))
        tasks = data.rdd.getNumPartitions()
        width = max(len(e) for e in edges) + 1
        stumps: list[tuple[int, int, float, float]] = []

        def weighed(b, found):
            """(codes, labels, weights) of a batch after the stumps ``found``."""
            codes = np.frombuffer(b"".join(b.column("x").to_pylist()), np.uint8).reshape(-1, size)
            y, w = b.column("y").to_numpy(), b.column("w").to_numpy().copy()
            for f, cut, vote, alpha in found:
                wrong = np.where(codes[:, f] <= cut, vote, -vote) != np.where(y > 0, 1.0, -1.0)
                w[wrong] *= math.exp(alpha)
            return codes, y, w

        def reweighed(found):
            def run(batches):
                for b in batches:
                    yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y"), pa.array(weighed(b, found)[2])], names=["x", "y", "w"])
            return run

        def histogram(found):
            def run(batches):
                from pyspark import TaskContext
                sums = np.zeros((2, size, width))
                for b in batches:
                    if not b.num_rows:
                        continue
                    codes, y, w = weighed(b, found)
                    for k in (0, 1):
                        mine = (y > 0) == k
                        for f in range(size):
                            sums[k, f] += np.bincount(codes[mine, f], w[mine], width)
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([sums.tobytes()], pa.binary())],
                                                 names=["t", "s"])
            return run

        def merged(key, table):
            # in the order of the tasks, so that a fit can be repeated
            parts = table.sort_by("t").column("s").to_pylist()
            total = sum((np.frombuffer(p) for p in parts), np.zeros(2 * size * width))
            return pa.table({"t": pa.array([key[0].as_py()], pa.int32()), "s": pa.array([total.tobytes()], pa.binary())})

        written = 0
        for _ in range(self.getMaxIter()):
            if len(stumps) - written >= REWEIGH:
                data, written = staged(data.mapInArrow(reweighed(stumps[written:]), "x binary, y double, w double")), len(stumps)
                tasks = data.rdd.getNumPartitions()
            parts = data.mapInArrow(histogram(stumps[written:]), "t int, s binary")
            left = tasks
            while left > MERGE:
                parts = parts.groupBy(F.floor(F.col("t") / MERGE).cast("int").alias("n")).applyInArrow(merged, "t int, s binary")
                left = -(-left // MERGE)
            parts = sorted(parts.collect())
            sums = sum((np.frombuffer(p["s"]) for p in parts), np.zeros(2 * size * width)).reshape(2, size, width)
            below = np.cumsum(sums, axis=2)
            whole = below[:, :, -1:]
            all_w = float(whole[:, 0].sum())
            gini = np.zeros((size, width))
            for side in (below, whole - below):
                n = side.sum(axis=0)
                gini += np.divide(2 * side[0] * side[1], n, out=np.zeros_like(n), where=n > 0)
            for f, e in enumerate(edges):
                gini[f, len(e):] = np.inf
            f, cut = np.unravel_index(int(np.argmin(gini)), gini.shape)
            if not np.isfinite(gini[f, cut]) or not all_w:
                break
            vote = 1.0 if below[1, f, cut] > below[0, f, cut] else -1.0
            rest = whole[:, f, 0] - below[:, f, cut]
            other = 1.0 if rest[1] > rest[0] else -1.0
            if other == vote:  # both sides vote alike: the split says nothing more
                vote_err = below[0, f, cut] + rest[0] if vote > 0 else below[1, f, cut] + rest[1]
                best = min(((float(below[0, g, c] + whole[1, g, 0] - below[1, g, c]), g, c, 1.0) for g in range(size) for c in range(len(edges[g]))),
                           default=None)
                flip = min(((float(below[1, g, c] + whole[0, g, 0] - below[0, g, c]), g, c, -1.0) for g in range(size) for c in range(len(edges[g]))),
                           default=None)
                error, f, cut, vote = min(x for x in (best, flip) if x)
                if error >= vote_err or error >= 0.5 * all_w:
                    break
            error = below[0, f, cut] + whole[1, f, 0] - below[1, f, cut] if vote > 0 else below[1, f, cut] + whole[0, f, 0] - below[0, f, cut]
            share = max(float(error) / all_w, 1e-10)
            if share >= 0.5:
                break
            stumps.append((int(f), int(cut), vote, self.getStepSize() * math.log((1 - share) / share)))
            if share <= 1e-10:
                break
        return model._set(features=[s[0] for s in stumps], thresholds=[float(edges[s[0]][s[1]]) for s in stumps],
                          votes=[s[2] for s in stumps], alphas=[s[3] for s in stumps], size=size)
