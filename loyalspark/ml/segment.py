"""Frequency-value segmentation with k-means and cluster-quality indices: M2-M6.

Quality indices are computed from one grouped aggregate per cluster (counts,
means, variances) plus, for Davies-Bouldin, one pass joining each point with
the k-row centroid table. Curves over many k come from ``kmeans_sweep``.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.ml.kmeans_sweep import indices, sweep


def _vec(df: DataFrame, cols: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


def kmeans(df: DataFrame, cols: list[str], k: int = 5, seed: int = 42, max_iter: int = 1000,
           prediction: str = "segment") -> DataFrame:
    """M2: k-means labels (k=5, seed 42, up to 1000 iterations)."""
    v = _vec(df, cols)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol=prediction).fit(v)
    return model.transform(v).drop("features")


def total_sum_squares(df: DataFrame, cols: list[str]) -> DataFrame:
    """(k = 1, wcss): the sum of squares about the mean of all rows."""
    return df.agg(sum((F.var_pop(c) * F.count(c) for c in cols), F.lit(0.0)).alias("wcss")).select(
        F.lit(1).alias("k"), F.coalesce("wcss", F.lit(0.0)).alias("wcss"))


def elbow(df: DataFrame, cols: list[str], ks=range(1, 11), seed: int = 42, max_iter: int = 1000) -> DataFrame:
    """M3: (k, wcss) for each k, over scaled or raw columns, all k together
    (``kmeans_sweep``)."""
    got = sweep(df, cols, ks, seed, max_iter)
    return df.sparkSession.createDataFrame(sorted(got.wcss.items()), "k int, wcss double")


def silhouette(df: DataFrame, cols: list[str], ks=range(2, 11), seed: int = 42, max_iter: int = 1000) -> DataFrame:
    """M4: silhouette for each k, on squared Euclidean distances (linear in the
    rows). It ranks k as the plain Euclidean silhouette does where clusters are
    compact, but is another number: that one needs the distances of all pairs
    of rows, which no cluster can hold at scale."""
    got = indices(sweep(df, cols, ks, seed, max_iter), len(cols))
    return df.sparkSession.createDataFrame([(k, v[2]) for k, v in sorted(got.items())], "k int, silhouette double")


def index_sweep(df: DataFrame, cols: list[str], ks=range(2, 11), seed: int = 42, max_iter: int = 1000) -> DataFrame:
    """M5 + M6: Calinski-Harabasz and Davies-Bouldin of the k-means labels for
    each k."""
    got = indices(sweep(df, cols, ks, seed, max_iter), len(cols))
    return df.sparkSession.createDataFrame([(k, v[0], v[1]) for k, v in sorted(got.items())],
                                           "k int, calinski_harabasz double, davies_bouldin double")


def calinski_harabasz(df: DataFrame, cols: list[str], cluster: str) -> DataFrame:
    """M5: between-cluster / within-cluster dispersion ratio for a fixed
    cluster column, from one aggregate per cluster."""
    per = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"c_{c}") for c in cols],
                                  *[(F.var_pop(c) * F.count(F.lit(1))).alias(f"w_{c}") for c in cols])
    total = per.agg(F.count(F.lit(1)).cast("int").alias("k"), F.sum("n").alias("n"),
                    sum((F.sum(f"w_{c}") for c in cols), F.lit(0.0)).alias("w"),
                    sum((F.sum(F.col("n") * F.col(f"c_{c}") ** 2) - F.sum(F.col("n") * F.col(f"c_{c}")) ** 2 / F.sum("n")
                         for c in cols), F.lit(0.0)).alias("b"))
    k, n, w = F.col("k"), F.col("n"), F.col("w")
    return total.select("k", F.when((k > 1) & (n > k) & (w > 0), (F.col("b") / (k - 1)) / (w / (n - k))).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cols: list[str], cluster: str) -> DataFrame:
    """M6: mean over clusters of the worst (s_i + s_j) / d(c_i, c_j), with s
    the mean Euclidean distance of a cluster's points to its centroid. The
    points meet the k centroids in one join; pairs of clusters are k x k rows
    by the definition of the index."""
    cents = df.groupBy(cluster).agg(*[F.avg(c).alias(f"c_{c}") for c in cols])
    near = F.sqrt(sum(((F.col(c) - F.col(f"c_{c}")) ** 2 for c in cols), F.lit(0.0)))
    spread = (df.join(cents, cluster).groupBy(cluster, *[f"c_{c}" for c in cols]).agg(F.avg(near).alias("s")))
    each = F.struct(F.col(cluster).alias("k"), F.col("s"), *[F.col(f"c_{c}") for c in cols])
    far = lambda a, b: F.sqrt(sum(((a[f"c_{c}"] - b[f"c_{c}"]) ** 2 for c in cols), F.lit(0.0)))
    worst = lambda a: F.array_max(F.transform(
        F.filter("all", lambda b: b["k"] != a["k"]), lambda b: (a["s"] + b["s"]) / F.nullif(far(a, b), F.lit(0.0))))
    return (spread.agg(F.collect_list(each).alias("all"))
            .select(F.size("all").cast("int").alias("k"), F.transform("all", worst).alias("w"))
            .select("k", F.try_divide(F.aggregate("w", F.lit(0.0), lambda x, y: x + y), F.col("k").cast("double")).alias("davies_bouldin")))
