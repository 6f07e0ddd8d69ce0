"""ML helpers, S10 and small operators."""

import datetime as dt
import os
import warnings

from pyspark.sql import functions as F

from conftest import SF001
from loyalspark.ml import assess as ma
from loyalspark.ml import model as mm
from loyalspark.ml import prepare as mp
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import target as tg
from loyalspark.operators import transactional as tr
from loyalspark.sources import fixtures as fx
from loyalspark.sources.calendar import date_spine, select_fixed, spine_dates

D = dt.date


def _table(spark):
    tx = fx.tx_events_thin(spark, "/root/testdata/sf0.01")
    cuts = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)]
    lab = tg.label(lc.segmentation_backfill(tx, cuts), 7, "main")
    fs = tr.fs_transactional(tx, cuts, "main").drop("cutoff")
    return lab.join(fs, ["user_id", "ref_date"]).drop("future_state").cache()


def test_unparsable_cutoff_gives_empty_result(spark):
    tx = fx.tx_orders(spark, SF001)
    out = lc.segmentation_backfill(tx, ["not-a-date"])
    assert out.count() == 0 and "state" in out.columns
    assert lc.segmentation_backfill(tx, ["2000-01-01", "bad"]).count() == \
        lc.segmentation_snapshot(tx, D(2000, 1, 1)).count()


def test_unparsable_date_on_every_entry_point(spark):
    tx = fx.tx_orders(spark, SF001)
    assert lc.frequency_value(tx, "bad").count() == 0
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        assert lc.life_cycle(tx, "bad").count() == 0
    assert any("bad" in str(w.message) for w in told)


def test_empty_spines(spark):
    assert date_spine(spark, "2024-02-02", "2024-02-01").count() == 0
    assert date_spine(spark, "2024-01-02", "2024-01-30", "month").count() == 0
    for pad in (False, True):
        for lo, hi in (("2024-01-15", "2024-03-10"), ("2024-01-01", "2024-03-01"), ("2024-01-02", "2024-01-30"), ("2024-03-02", "2024-02-01")):
            assert [r.cutoff for r in date_spine(spark, lo, hi, "month", pad).collect()] == spine_dates(lo, hi, "month", pad), (lo, hi, pad)


def test_zoned_timestamps_count_in_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = spark.createDataFrame([(1, 7, 1706745600, 5)], "tx_id long, user_id long, s long, points long")  # 2024-02-01 00:00 UTC
    try:
        for zone in ("UTC", "America/Sao_Paulo", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            tx = rows.select("tx_id", "user_id", F.timestamp_seconds("s").alias("ts"), "points")
            assert lc.life_cycle(tx, "2024-02-03").first().last_age == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_spines_and_select_fixed(spark):
    assert [r.cutoff for r in date_spine(spark, "2024-01-15", "2024-03-10", "month").collect()] == \
        [D(2024, 2, 1), D(2024, 3, 1)]
    assert spine_dates("2024-01-15", "2024-03-10", "month", pad=True) == [D(2024, 2, 1), D(2024, 3, 1), D(2024, 4, 1)]
    df = spark.createDataFrame([(1, 2)], "a long, b long")
    assert select_fixed(df, ["b", "c", "a"]).collect()[0].asDict() == {"b": 2, "c": 0, "a": 1}


FEATS = ["active_days_life", "tx_life", "pts_net_life", "hours_life", "active_days_d56", "age_days"]


def test_tune_importance_curves(spark):
    t = _table(spark)
    cv = mm.tune(mm.build_pipeline(FEATS, [], "dt"), t, {"maxDepth": [2, 4]}, folds=2)
    imp = ma.importance(cv, t).collect()
    assert {r.feature for r in imp} == set(FEATS) and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    scored = mm.with_score(cv.bestModel.transform(t))
    tprs = [r.tpr for r in ma.roc_curve(scored).collect()]
    assert tprs == sorted(tprs) and abs(tprs[-1] - 1.0) < 1e-9
    assert sum(r.pred_0 + r.pred_1 for r in ma.confusion(scored).collect()) == t.count()


def test_metrics_are_exact(spark):
    rows = [(0, 0.1, 0.0, "a"), (1, 0.1, 1.0, "a"), (1, 0.9, 1.0, "a"), (0, 0.4, 1.0, "a"), (1, 0.3, 0.0, "b")]
    df = spark.createDataFrame(rows, "label int, score double, prediction double, part string")
    got = {r.split: (r.accuracy, r.auc) for r in ma.metrics(df, split="part").collect()}
    assert got == {"a": (0.75, 0.625), "b": (0.0, None)}


def _sklearn_like_adaboost(x, y, rounds, rate):
    """Boosting over all midpoints, as defined."""
    import math
    w, votes = [1.0] * len(y), [0.0] * len(y)
    for _ in range(rounds):
        best = None
        for f in range(len(x[0])):
            for t in sorted({r[f] for r in x})[:-1]:
                for side in (1, -1):
                    e = sum(wi for wi, r, yi in zip(w, x, y) if (side if r[f] <= t else -side) != (1 if yi else -1))
                    if best is None or e < best[0] - 1e-12:
                        best = (e, f, t, side)
        e, f, t, side = best
        err = max(e / sum(w), 1e-10)
        if err >= 0.5:
            break
        a = rate * math.log((1 - err) / err)
        for i, r in enumerate(x):
            h = side if r[f] <= t else -side
            votes[i] += a * h
            if h != (1 if y[i] else -1):
                w[i] *= math.exp(a)
    return [v > 0 for v in votes]


def test_adaboost_learns_and_is_saved(spark, scratch):
    import random
    rnd = random.Random(4)
    x = [[rnd.random(), rnd.random(), float(rnd.randint(0, 3))] for _ in range(120)]
    y = [int(r[0] + 0.5 * r[1] > 0.8) for r in x]
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(i, float(yi), Vectors.dense(r)) for i, (r, yi) in enumerate(zip(x, y))], ["i", "label", "features"])
    model = mm.classifier("adaboost", maxIter=25, stepSize=0.5, maxBins=128).fit(df)
    path = os.path.join(scratch, "ada")
    model.save(path)
    from loyalspark.ml.adaboost import AdaBoostModel
    for m in (model, AdaBoostModel.load(path)):
        out = m.transform(df).orderBy("i").collect()
        right = sum(int(r.prediction) == yi for r, yi in zip(out, y))
        brute = sum(p == bool(yi) for p, yi in zip(_sklearn_like_adaboost(x, y, 25, 0.5), y))
        assert right >= brute - 6 and right >= 110
        assert all(abs(r.probability[1] - 1 / (1 + 2.718281828459045 ** (-2 * r.rawPrediction[1]))) < 1e-9 for r in out)


def test_adaboost_weights_written_and_sums_merged(spark, monkeypatch):
    """Weights written every three rounds and sums merged two at a time give
    the stumps of a fit that does neither."""
    import random

    import pytest
    from pyspark.ml.linalg import Vectors

    from loyalspark.ml import adaboost
    rnd = random.Random(9)
    rows = [(float((a := rnd.random()) + rnd.random() / 3 > 0.6), Vectors.dense([a, rnd.random(), float(rnd.randint(0, 5))])) for _ in range(300)]
    df = spark.createDataFrame(rows, ["label", "features"]).repartition(7)
    found = []
    for reweigh, merge in ((50, 64), (3, 2)):
        monkeypatch.setattr(adaboost, "REWEIGH", reweigh)
        monkeypatch.setattr(adaboost, "MERGE", merge)
        m = mm.classifier("adaboost", maxIter=10, stepSize=0.5).fit(df)
        found.append([[round(v, 9) for v in m.getOrDefault(p)] for p in ("features", "thresholds", "votes", "alphas")])
    assert found[0] == found[1] and len(found[0][0]) == 10
    with pytest.raises(ValueError, match="maxBins"):
        mm.classifier("adaboost", maxBins=300).fit(df)


def test_saved_pipeline_scores_raw_rows_as_in_training(spark, scratch):
    """Rows with missing values get the same score in training, after loading
    and through the scoring job."""
    from loyalspark.ml.score import load_latest, save_model, score_batch
    t = _table(spark).withColumn("gap_mean_life", F.when(F.col("user_id") % 3 == 0, F.col("gap_mean_life")))
    t = t.withColumn("state_current", F.when(F.col("user_id") % 2 == 0, F.col("state"))).drop("state")
    types = {c: k for c, k in t.dtypes if c in mp.feature_columns(t) and mp.rule_for(c)}
    numeric = [c for c in types if c != "state_current"]
    for kind, params in (("rf", {"numTrees": 5}), ("dt", {}), ("adaboost", {"maxIter": 6})):
        p = mm.build_pipeline(numeric, ["state_current"], kind, prepare=mp.policy_stages(types), **params)
        model = p.fit(t)
        root = os.path.join(scratch, kind)
        save_model(spark, model, {}, root)
        want = {(r.ref_date, r.user_id): r.score for r in mm.predict(model, t).collect()}
        got = {(r.ref_date, r.user_id): r.score for r in score_batch(spark, root, t.drop("label")).collect()}
        assert got == want and len(want) == t.count()
        filled = mp.impute(t)  # the table training would have seen
        assert {(r.ref_date, r.user_id): r.score for r in mm.predict(load_latest(spark, root)[0], filled).collect()} == want
        cv = mm.tune(p, t, {"maxIter": [2, 4]} if kind == "adaboost" else {"minInstancesPerNode": [5, 50]}, folds=2)
        assert len(cv.avgMetrics) == 2


def test_policy_stages_without_survivors(spark):
    import pytest
    with pytest.raises(ValueError):
        mp.policy_stages({"frequency": "bigint"}, keep=[])
    assert len(mp.policy_stages({"frequency": "bigint", "state_current": "string"}, keep=[], on_empty="pass")) == 1


def test_default_grids():
    size = {k: 1 for k in mm.GRIDS}
    for k, grid in mm.GRIDS.items():
        for v in grid.values():
            size[k] *= len(v)
    assert size == {"adaboost": 48, "rf": 36, "dt": 6}


def test_default_grids_hold_the_values_of_the_original():
    leaves, rounds = [3, 5, 10, 20, 30, 50], [50, 100, 150, 200, 500, 1000]
    assert mm.GRIDS == {"dt": {"minInstancesPerNode": leaves}, "rf": {"minInstancesPerNode": leaves, "numTrees": rounds},
                        "adaboost": {"maxIter": rounds, "stepSize": [0.001, 0.01, 0.05, 0.1, 0.2, 0.5, 0.9, 0.99]}}


def test_policy_impute_and_drop(spark):
    t = _table(spark)
    t2, dropped = mp.drop_uninformative(t)
    assert set(dropped) <= set(t.columns) and len(t2.columns) == len(t.columns) - len(dropped)
    prof = mp.feature_profile(t).collect()
    assert all(r.null_rate is not None for r in prof)
    sp = mp.stratified_split(t)
    assert sp.columns == [*t.columns, "split"] and sp.count() == t.count()
    for r in sp.groupBy("label").agg(F.count("*").alias("n"), F.sum((F.col("split") == "test").cast("int")).alias("k")).collect():
        assert r.k == int(0.2 * r.n + 0.5)


def test_clean_names_and_out_of_time(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "ABT"), (D(2024, 1, 2), "OOT"), (D(2024, 1, 2), "ABT")], ["ref_date", "tag"])
    assert mp.clean_names(df.withColumnRenamed("tag", "a b-c.d")).columns == ["ref_date", "a_b_c_d"]
    assert [x.count() for x in mp.split_oot(df)] == [2, 1]
    assert [x.count() for x in mp.split_oot(df, how="date")] == [1, 2]
