"""All k of a k-means curve at once, against plain recomputation."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loyalspark.ml import segment as ms
from loyalspark.ml.kmeans_sweep import indices, sweep

COLS = ["a", "b"]


def _blobs(n=60, seed=3):
    r = np.random.default_rng(seed)
    mid = [(0.1, 0.1), (0.9, 0.2), (0.5, 0.9)]
    # a coarse grid, so that points repeat
    return [tuple(float(v) for v in np.round(r.normal(mid[i % 3], 0.05), 2)) for i in range(n)]


@pytest.fixture(scope="module")
def blobs(spark):
    return spark.createDataFrame(_blobs(), "a double, b double")


def _labels(x, cl):
    return np.array([[math.dist(p, c.centre) ** 2 for c in cl] for p in x]).argmin(1)


def test_sums_are_those_of_the_labels(blobs):
    x = np.array(_blobs())
    got = sweep(blobs, COLS, range(1, 6), tol=1e-12)
    for k, cl in got.clusters.items():
        lab = _labels(x, cl)
        assert sorted(set(lab)) == list(range(len(cl)))
        for j, c in enumerate(cl):
            mine = x[lab == j]
            assert c.n == len(mine)
            assert np.allclose(c.mean, mine.mean(0))
            assert math.isclose(c.variance, ((mine - mine.mean(0)) ** 2).sum(1).mean(), abs_tol=1e-9)
            # at rest: no centre would move by more than the tolerance
            assert math.dist(c.mean, c.centre) <= 1e-5
        assert math.isclose(got.wcss[k], sum(math.dist(p, cl[j].centre) ** 2 for p, j in zip(x, lab)), rel_tol=1e-9)
    ws = [got.wcss[k] for k in range(1, 6)]
    assert all(a >= b for a, b in zip(ws, ws[1:]))
    one = ms.total_sum_squares(blobs, COLS).collect()[0]["wcss"]
    assert math.isclose(ws[0], one, rel_tol=1e-9)


def test_three_blobs_are_found(blobs):
    got = sweep(blobs, COLS, [3])
    x = np.array(_blobs())
    want = sum(((x[i::3] - x[i::3].mean(0)) ** 2).sum() for i in range(3))
    assert math.isclose(got.wcss[3], want, rel_tol=1e-6)


def test_indices_equal_those_of_the_labelled_rows(spark, blobs):
    got = sweep(blobs, COLS, [2, 3, 4])
    ind = indices(got, 2)
    x = _blobs()
    for k, cl in got.clusters.items():
        lab = _labels(np.array(x), cl)
        df = spark.createDataFrame([(*p, int(j)) for p, j in zip(x, lab)], "a double, b double, c int")
        ch = ms.calinski_harabasz(df, COLS, "c").collect()[0]["calinski_harabasz"]
        db = ms.davies_bouldin(df, COLS, "c").collect()[0]["davies_bouldin"]
        sil = ClusteringEvaluator(featuresCol="v", predictionCol="c").evaluate(
            VectorAssembler(inputCols=COLS, outputCol="v").transform(df))
        assert np.allclose(ind[k], (ch, db, sil), rtol=1e-9)


def test_same_result_for_any_layout(blobs):
    a = sweep(blobs.repartition(1), COLS, range(1, 5))
    b = sweep(blobs.repartition(7).orderBy(F.desc("a")), COLS, range(1, 5))
    for k in range(1, 5):
        assert np.allclose([c.centre for c in a.clusters[k]], [c.centre for c in b.clusters[k]])


def test_few_points_nulls_and_empty(spark):
    rows = [(1.0, 1.0)] * 5 + [(2.0, 0.0), (None, 1.0), (float("nan"), 0.0), (0.0, None), (-0.0, 3.0), (0.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = sweep(df, COLS, [1, 3, 6])
    assert got.wcss[3] == got.wcss[6] == 0.0
    assert sorted(c.n for c in got.clusters[6]) == [1, 2, 5]
    ch, db, sil = indices(got, 2)[6]
    # no spread inside clusters; the row alone in its cluster counts as 0
    assert ch is None and db == 0.0 and math.isclose(sil, 7 / 8)
    none = df.filter(F.lit(False))
    assert [tuple(r) for r in ms.elbow(none, COLS, [1, 2]).collect()] == [(1, 0.0), (2, 0.0)]
    assert [tuple(r) for r in ms.silhouette(none, COLS, [2]).collect()] == [(2, None)]
    assert [tuple(r) for r in ms.index_sweep(df.limit(1), COLS, [2]).collect()] == [(2, None, None)]


def test_one_scan_per_round_serves_every_k(spark, blobs):
    tracker, group = spark.sparkContext.statusTracker(), "sweep-jobs"
    spark.sparkContext.setJobGroup(group, "count")
    try:
        sweep(blobs, COLS, range(1, 11), max_iter=1, starts=2)
        jobs = len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # staging, ten seeds, a round and the labels at rest, each one job or (adaptive) a few, for 20 runs
    assert jobs <= 3 * 13
