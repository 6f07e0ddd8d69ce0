"""Feature profiling over wide tables: G36-G41, M1, M9-M15 helpers.

Every profile is one aggregate job over all columns at once (no per-column
loops of jobs) and is returned long (one row per feature) with ``stack``.
Medians and quartiles are exact and interpolated, by selection in refining
histograms over all columns at once (``plans.running``): no buffer grows with
the number of distinct values. ``approx=accuracy`` is the named opt-in for one
pass with a bounded sketch, within 1/accuracy in rank.
Means are sums of decimals over a count, so they do not depend on the order
in which partitions are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from loyalspark.plans.running import exact_quantiles


def mean(x) -> Column:
    """Mean over decimals with nine places."""
    return F.sum(x.cast("decimal(28,9)")).cast("double") / F.nullif(F.count(x), F.lit(0))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def _long(row_df: DataFrame, names: list[str], prefix: str, value: str) -> DataFrame:
    """One-row wide aggregate -> (feature, value) rows."""
    pairs = ", ".join(f"'{n}', `{prefix}{n}`" for n in names)
    return row_df.selectExpr(f"stack({len(names)}, {pairs}) as (feature, {value})")


def null_rates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of NULLs per column -> (feature, null_rate)."""
    cols = cols or df.columns
    agg = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("double")).alias(f"nr_{c}") for c in cols])
    return _long(agg, cols, "nr_", "null_rate")


def label_median_ratio(df: DataFrame, label: str, cols: list[str], approx: int | None = None) -> DataFrame:
    """Per feature, mean and median for label 1 and 0 and the ratio
    (median1 + 0.001) / (median0 + 0.001)."""
    aggs = []
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        for v in (0, 1):
            sel = F.when(F.col(label) == v, x)
            aggs += [mean(sel).alias(f"mean{v}_{c}"), *([F.percentile_approx(sel, 0.5, approx).alias(f"med{v}_{c}")] if approx else [])]
    row = df.agg(*aggs)
    medians = [f"`med{v}_{{c}}`" if approx else "CAST(NULL AS DOUBLE)" for v in (0, 1)]
    parts = ", ".join(f"'{c}', `mean0_{c}`, `mean1_{c}`, " + ", ".join(m.format(c=c) for m in medians) for c in cols)
    long = row.selectExpr(f"stack({len(cols)}, {parts}) as (feature, mean0, mean1, median0, median1)")
    if not approx:
        # two rows per column
        found = exact_quantiles(df.filter(F.col(label).isin(0, 1)).withColumn("__y", F.col(label).cast("int")), cols, [0.5], "__y")
        both = found.groupBy("feature").agg(*[F.max(F.when(F.col("__y") == str(v), F.col("q")[0])).alias(f"median{v}") for v in (0, 1)])
        long = long.drop("median0", "median1").join(F.broadcast(both), "feature", "left").select("feature", "mean0", "mean1", "median0", "median1")
    return (long.withColumn("median_ratio", (F.col("median1") + 0.001) / (F.col("median0") + 0.001))
            .orderBy(F.desc_nulls_last("median_ratio")))  # O4: most informative first


def uninformative(ratios: DataFrame, drop_null: bool = True) -> DataFrame:
    """Features whose median ratio is 1 (or NULL, main variant)."""
    cond = F.col("median_ratio") == 1.0
    if drop_null:
        cond = cond | F.col("median_ratio").isNull()
    return ratios.filter(cond).select("feature")


def label_rate(df: DataFrame, category: str, label: str = "label") -> DataFrame:
    """Label rate and rows per category."""
    return (df.groupBy(category).agg(F.count(F.lit(1)).cast("long").alias("n"),
                                     F.avg(F.col(label).cast("double")).alias("label_rate"))
            .orderBy(category))


def split_summary(df: DataFrame, split: str = "tag", label: str = "label") -> DataFrame:
    """Rows, positives and label rate per split."""
    return (df.groupBy(split).agg(F.count(F.lit(1)).cast("long").alias("n"),
                                  F.sum(F.col(label)).cast("long").alias("positives"),
                                  F.avg(F.col(label).cast("double")).alias("label_rate"))
            .orderBy(split))


def describe_by(df: DataFrame, group: str, cols: list[str], approx: int | None = None) -> DataFrame:
    """Count, mean, stddev, min, quartiles, max per group and column."""
    aggs = [F.count(F.lit(1)).cast("long").alias("n")]
    for c in cols:
        x = F.col(f"`{c}`").cast("double")
        aggs += [mean(x).alias(f"{c}_mean"), F.stddev(x).alias(f"{c}_std"), F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
        if approx:
            q = F.percentile_approx(x, [0.25, 0.5, 0.75], approx)
            aggs += [q[i].alias(f"{c}_{name}") for i, name in enumerate(("p25", "p50", "p75"))]
    out = df.groupBy(group).agg(*aggs)
    if not approx:
        found = exact_quantiles(df, cols, [0.25, 0.5, 0.75], group).withColumnRenamed(group, "__g")
        wide = found.groupBy("__g").agg(*[F.max(F.when(F.col("feature") == c, F.col("q")[i])).alias(f"{c}_{name}")
                                          for c in cols for i, name in enumerate(("p25", "p50", "p75"))])
        out = out.join(wide, F.col(group).cast("string").eqNullSafe(F.col("__g")), "left").drop("__g")
    order = [group, "n", *[f"{c}_{s}" for c in cols for s in ("mean", "std", "min", "p25", "p50", "p75", "max")]]
    return out.select(*order).orderBy(group)


def minmax(df: DataFrame, cols: list[str], suffix: str = "_scaled") -> DataFrame:
    """M1: (x - min) / (max - min) with min and max as a scalar subquery (one
    row); constant columns -> 0."""
    ends = df.agg(F.struct(*[F.min(c).cast("double").alias(f"lo_{c}") for c in cols],
                           *[F.max(c).cast("double").alias(f"hi_{c}") for c in cols]).alias("e")).scalar()
    out = df.withColumn("__ends", ends)
    for c in cols:
        lo, hi = F.col("__ends")[f"lo_{c}"], F.col("__ends")[f"hi_{c}"]
        x = F.when(hi > lo, (F.col(c).cast("double") - lo) / (hi - lo)).when(F.col(c).isNotNull(), F.lit(0.0))
        out = out.withColumn(f"{c}{suffix}", x)
    return out.drop("__ends")


def onehot(df: DataFrame, column: str, categories: list, prefix: str | None = None) -> DataFrame:
    """M15 (native form): one 0/1 column per fitted category; NULL or unseen
    values are 0 everywhere."""
    prefix = prefix or column
    import re
    out = df
    for v in categories:
        name = f"{prefix}_" + re.sub(r"[^0-9a-zA-Z]+", "_", str(v)).strip("_").lower()
        out = out.withColumn(name, F.when(F.col(column) == F.lit(v), 1).otherwise(0).cast("long"))
    return out


