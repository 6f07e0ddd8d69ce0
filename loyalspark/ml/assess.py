"""Model assessment: M22-M27.

Curves have one row per distinct score, counted by partial aggregation and
summed up by ``plans.running``, which deals them by range: no task holds them
all. ``digits`` rounds scores first, as a named opt-in for shorter curves.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.plans.running import running_sums


def metrics(scored: DataFrame, label: str = "label", score: str = "score",
            prediction: str = "prediction", split: str | None = None) -> DataFrame:
    """Accuracy and exact ROC AUC (per split when given), in one pass.

    AUC is the share of (positive, negative) pairs in the right order, ties
    counting half: from the rows per distinct score, each score's positives
    beat all negatives below it. The running count goes over distinct scores.
    """
    part = F.col(split).cast("string") if split else F.lit(None).cast("string")
    y = F.col(label).cast("long")
    per = scored.groupBy(part.alias("split"), F.col(score).cast("double").alias("s")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.sum((F.col(prediction) == F.col(label)).cast("long")).alias("ok"))
    run = running_sums(per, "s", ["neg"], group="split")
    wins = run.withColumn("wins", F.col("pos") * (F.col("cum_neg") - F.col("neg") / 2))
    p, n = F.sum("pos"), F.sum("neg")
    return wins.groupBy("split").agg((F.sum("ok") / (p + n)).alias("accuracy"),
                                     F.try_divide(F.sum("wins"), (p * n).cast("double")).alias("auc"))


def _bins(scored: DataFrame, label: str, score: str, digits: int | None) -> DataFrame:
    s = F.col(score).cast("double")
    return (scored.groupBy((s if digits is None else F.round(s, digits)).alias("threshold"))
            .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                 F.sum((1 - F.col(label)).cast("long")).alias("neg")))


def roc_curve(scored: DataFrame, label: str = "label", score: str = "score", digits: int | None = None) -> DataFrame:
    """(threshold, tpr, fpr) with "score >= threshold" predicted positive,
    one row per distinct score (of ``digits`` places where given)."""
    b = running_sums(_bins(scored, label, score, digits), "threshold", ["pos", "neg"], descending=True)
    return (b.select("threshold", F.try_divide("cum_pos", "all_pos").alias("tpr"), F.try_divide("cum_neg", "all_neg").alias("fpr"))
            .orderBy(F.desc("threshold")))


def lift_curve(scored: DataFrame, label: str = "label", score: str = "score", digits: int | None = None) -> DataFrame:
    """Cumulative population share, precision and lift over the base rate."""
    b = running_sums(_bins(scored, label, score, digits), "threshold", ["pos", "neg"], descending=True)
    cum_n, n = F.col("cum_pos") + F.col("cum_neg"), F.col("all_pos") + F.col("all_neg")
    base = F.col("all_pos") / n
    prec = F.col("cum_pos") / cum_n
    return (b.select("threshold", (cum_n / n).alias("population"), prec.alias("precision"),
                     F.try_divide(prec, base).alias("lift"))
            .orderBy(F.desc("threshold")))


def confusion(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rows = true label, columns = predicted 0 / 1."""
    return (scored.groupBy(F.col(label).cast("long").alias("label"))
            .pivot(prediction, [0.0, 1.0]).count()
            .select("label", F.coalesce(F.col("`0.0`"), F.lit(0)).cast("long").alias("pred_0"),
                    F.coalesce(F.col("`1.0`"), F.lit(0)).cast("long").alias("pred_1"))
            .orderBy("label"))


def baseline(df: DataFrame, label: str = "label", split: str | None = None) -> DataFrame:
    """Constant predictors: always 0 (accuracy = share of 0) and the base
    rate as score (AUC of a constant = 0.5)."""
    keys = [split] if split else []
    return (df.groupBy(*keys).agg(
                F.count(F.lit(1)).cast("long").alias("n"),
                F.avg(F.col(label).cast("double")).alias("base_rate"),
                F.avg((F.col(label) == 0).cast("double")).alias("accuracy_zero"))
            .withColumn("auc_constant", F.lit(0.5)))


def importance(model, df: DataFrame) -> DataFrame:
    """Feature importances of the last stage of a fitted pipeline (or of
    a tuned one), ranked descending. Names come from the vector that the
    pipeline assembles from ``df``."""
    model = getattr(model, "bestModel", model)
    stages = getattr(model, "stages", [model])
    at = stages[-1].getFeaturesCol()
    field = PipelineModel(stages[:-1]).transform(df).schema[at]
    groups = field.metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for g in groups.values() for a in g}
    rows = [(names.get(i, f"f{i}"), float(v)) for i, v in enumerate(stages[-1].featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"))
