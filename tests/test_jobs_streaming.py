"""Job registry / daily chain on a Sources layout, and the scoring stream."""

import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F

from conftest import SF001
from loyalspark.ml import model as mm
from loyalspark.ml.score import load_latest, log_run, read_runs, save_model, score_batch
from loyalspark.plans.jobs import JOBS, run_chain, run_fs_all, run_job, run_predict, run_train
from loyalspark.sources import fixtures as fx
from loyalspark.sources.store import PublishConflict, Sources, current_version, publish, read_table
from loyalspark.streaming.score import score_stream

D = dt.date


def _layout(spark, root):
    src = Sources(root)
    w = lambda df, db, t: df.write.mode("overwrite").parquet(src.path(db, t))
    w(fx.tx_orders(spark, SF001), "loyalty-system", "transactions")
    w(fx.tx_items(spark, SF001), "loyalty-system", "transaction_items")
    w(fx.products(spark, SF001), "loyalty-system", "products")
    w(fx.edu_done(spark, SF001), "education-platform", "episodes_done")
    w(fx.edu_register(spark, SF001), "education-platform", "episodes")
    w(fx.edu_rewards(spark, SF001), "education-platform", "rewards")
    w(fx.edu_skills(spark, SF001), "education-platform", "skills")
    # bridge to loyalty ids of the same type as the transactions' user_id
    w(spark.read.parquet(f"{SF001}/customer.parquet").select(
        F.col("c_custkey").alias("user"), F.col("c_custkey").alias("customer_id")),
      "education-platform", "user_bridge")
    return src


def test_run_job_and_chain(spark, scratch):
    src = _layout(spark, os.path.join(scratch, "db"))
    cuts = run_job(spark, "life_cycle", D(1999, 11, 1), D(2000, 1, 1), src)
    lc_t = spark.read.parquet(src.path("analytics", "life_cycle"))
    assert lc_t.select("ref_date").distinct().count() == len(cuts) == 62
    n_once = lc_t.count()
    run_job(spark, "life_cycle", D(1999, 11, 1), D(2000, 1, 1), src)  # idempotent
    assert spark.read.parquet(src.path("analytics", "life_cycle")).count() == n_once
    run_chain(spark, D(2000, 1, 1), src, "refs")
    fs_all = read_table(spark, src.path("analytics", "fs_all"))
    assert fs_all.count() > 0 and "state_current" in fs_all.columns and "n_complete" in fs_all.columns
    assert set(JOBS) == {"life_cycle", "fs_transactional", "fs_education", "fs_life_cycle", "labels", "abt"}
    # the step-by-step preset reads the snapshot of the cut-off day itself
    run_chain(spark, D(2000, 1, 1), src, "main")
    assert spark.read.parquet(src.path("analytics", "fs_life_cycle")).filter("ref_date = '1999-12-31'").count() > 0
    # label and ABT jobs read the stored tables
    for name in ("fs_transactional", "fs_education", "fs_life_cycle"):
        run_job(spark, name, D(1999, 12, 1), D(1999, 12, 3), src, cfg="refs")
    run_job(spark, "labels", D(1999, 12, 1), D(1999, 12, 3), src)
    run_job(spark, "abt", D(1999, 12, 1), D(1999, 12, 3), src)
    abt = spark.read.parquet(src.path("analytics", "abt"))
    assert abt.count() > 0 and {"label", "tag", "state_current", "tx_life", "n_complete"} <= set(abt.columns)
    # the chain's end: a model from the ABT, scores of the scoring table. The
    # fixture's customers are never loyal, so labels that features tell stand in
    marked = abt.withColumn("label", (F.col("tx_life") + F.col("user_id") % 3 > 9).cast("long"))
    marked.write.parquet(os.path.join(scratch, "marked"))
    spark.read.parquet(os.path.join(scratch, "marked")).write.mode("overwrite").partitionBy("ref_date").parquet(src.path("analytics", "abt"))
    meta = run_train(spark, src, "dt", oot_from=D(1999, 12, 2))
    assert {f"{s}_{m}" for s in ("train", "test", "oot") for m in ("accuracy", "auc")} == set(meta["metrics"])
    run = read_runs(spark, src.path("analytics", "runs")).collect()
    assert len(run) == 1 and json.loads(run[0].features) == meta["features"] and json.loads(run[0].metrics) == meta["metrics"]
    run_fs_all(spark, src)  # the latest date
    run_predict(spark, src)
    table, scores = (read_table(spark, src.path("analytics", t)) for t in ("fs_all", "score"))
    assert scores.count() == table.filter("age_days is not null").count() > 0
    assert scores.columns == ["ref_date", "user_id", "score"] and scores.filter("score between 0 and 1").count() == scores.count()
    # the daily chain scores by itself once there is a model
    before = current_version(spark, src.path("analytics", "score"))[0]
    run_chain(spark, D(1999, 12, 3), src, "refs")
    assert current_version(spark, src.path("analytics", "score"))[0] == before + 1
    # a scoring table that lacks a feature is refused by name
    with pytest.raises(ValueError, match=meta["features"][0]):
        score_batch(spark, src.path("analytics", "models"), table.drop(meta["features"][0]))


def test_publish_switches_whole_tables(spark, scratch):
    path = os.path.join(scratch, "t")
    publish(spark.range(3).toDF("x"), path)
    held = read_table(spark, path)
    # a failing write leaves the table as it was
    broken = spark.range(4).select(F.raise_error(F.lit("no")).cast("long").alias("x"))
    with pytest.raises(Exception, match="no"):
        publish(broken, path)
    assert read_table(spark, path).count() == 3 and current_version(spark, path)[0] == 1

    # two writers from one version: the second is told, the first one's rows stay
    import loyalspark.sources.store as store
    stale = current_version(spark, path)
    publish(spark.range(5).toDF("x"), path)
    real = store.current_version
    try:
        store.current_version = lambda *a: stale
        with pytest.raises(PublishConflict):
            publish(spark.range(9).toDF("x"), path)
    finally:
        store.current_version = real
    assert read_table(spark, path).count() == 5
    assert held.count() == 3  # a reader of the version before goes on
    for n in (6, 7):
        publish(spark.range(n).toDF("x"), path)
    assert read_table(spark, path).count() == 7 and len([f for f in os.listdir(path) if f.startswith("data-")]) == 2


def test_model_versions_batch_and_stream(spark, scratch):
    tx = fx.tx_orders(spark, SF001)
    from loyalspark.operators import lifecycle as lc
    from loyalspark.operators import target as tg
    from loyalspark.operators import transactional as tr
    cuts = [D(1998, 1, 5) + dt.timedelta(days=28 * i) for i in range(26)]
    lab = tg.label(lc.segmentation_backfill(tx, cuts), 28, "main")
    fs = tr.fs_transactional(tx, cuts, "main").drop("cutoff")
    data = lab.join(fs, ["user_id", "ref_date"])
    feats = ["active_days_life", "tx_life", "pts_net_life", "hours_life"]
    model = mm.build_pipeline(feats, [], "dt").fit(data)
    root = os.path.join(scratch, "models")
    save_model(spark, model, {"features": feats}, root)
    save_model(spark, model, {"features": feats}, root)
    m, meta = load_latest(spark, root)
    assert meta["version"] == 2 and meta["features"] == feats
    scored = score_batch(spark, root, data.select("ref_date", "user_id", *feats), os.path.join(scratch, "score"))
    assert scored.count() == data.count() == read_table(spark, os.path.join(scratch, "score")).count()
    log_run(spark, os.path.join(scratch, "runs"), {"model": "dt"}, {"depth": 10}, {"auc": 0.5}, feats)
    assert read_runs(spark, os.path.join(scratch, "runs")).count() == 1

    in_dir = os.path.join(scratch, "requests")
    os.makedirs(in_dir)
    one = {"user_id": "a", "active_days_life": 3, "tx_life": 4, "pts_net_life": 10, "hours_life": 0.0}
    many = [dict(one, user_id="b"), dict(one, user_id="c", tx_life=9)]
    with open(os.path.join(in_dir, "r1.json"), "w") as fh:
        fh.write(json.dumps(one) + "\n" + json.dumps(many) + "\n" + "{not json\n")
    out = os.path.join(scratch, "stream_out")
    with open(os.path.join(in_dir, "r2.json"), "w") as fh:  # the service's envelope and its id's name
        named = {**{k: v for k, v in one.items() if k != "user_id"}, "IdCliente": "d"}
        fh.write(json.dumps({"data": named}) + "\n" + json.dumps({"data": [dict(named, IdCliente="e"), dict(one, user_id="f")]}) + "\n")
        fh.write(json.dumps({"data": {k: v for k, v in one.items() if k != "user_id"}}) + "\n")       # no id
        fh.write(json.dumps([dict(one, user_id="g", tx_life="many"), dict(one, user_id="h", tx_life=None)]) + "\n")  # one wrong value
    q = score_stream(spark, root, in_dir, out, os.path.join(scratch, "ckpt"),
                     {"active_days_life": "bigint", "tx_life": "bigint", "pts_net_life": "bigint",
                      "hours_life": "double"})
    q.awaitTermination(120)
    scores = spark.read.parquet(os.path.join(out, "scores"))
    assert sorted(r.user_id for r in scores.collect()) == ["a", "b", "c", "d", "e", "f", "h"]
    assert scores.filter("IdCliente = user_id").count() == 7
    rejected = sorted(r.text for r in spark.read.parquet(os.path.join(out, "rejected")).collect())
    assert len(rejected) == 3 and "{not json" in rejected and sum("many" in r for r in rejected) == 1


def test_incremental_stream_rebuilds_touched_days(spark, scratch):
    from loyalspark.operators import lifecycle as lc
    from loyalspark.streaming.score import run_incremental
    tx = fx.tx_events_thin(spark, SF001)
    tx_dir = os.path.join(scratch, "tx")
    tx.filter(F.to_date("ts") < F.lit(D(2024, 1, 20))).write.parquet(tx_dir)
    snap = os.path.join(scratch, "life_cycle")
    ck = os.path.join(scratch, "ckpt_inc")
    q = run_incremental(spark, tx_dir, tx.schema, snap, ck, lc.segmentation_backfill)
    q.awaitTermination(120)
    first = spark.read.parquet(snap).select("ref_date").distinct().count()
    # a new file with later activity: only the touched days are (re)built
    tx.filter(F.to_date("ts") >= F.lit(D(2024, 1, 20))).write.mode("append").parquet(tx_dir)
    q = run_incremental(spark, tx_dir, tx.schema, snap, ck, lc.segmentation_backfill)
    q.awaitTermination(120)
    out = spark.read.parquet(snap)
    assert out.select("ref_date").distinct().count() > first
    day = tx.agg(F.max(F.to_date("ts"))).first()[0]
    expect = lc.segmentation_snapshot(tx, day + dt.timedelta(days=1))
    got = out.filter(F.col("ref_date") == F.lit(day)).select(*expect.columns)
    assert got.count() == expect.count() > 0
    assert got.exceptAll(expect).count() == 0 and expect.exceptAll(got).count() == 0


def test_late_file_rebuilds_later_dates(spark, scratch):
    from loyalspark.operators import lifecycle as lc
    from loyalspark.streaming.score import run_incremental
    tx = fx.tx_events_thin(spark, SF001)
    tx_dir, snap, ck = (os.path.join(scratch, x) for x in ("tx", "life_cycle", "ck"))
    late = F.to_date("ts") == F.lit(D(2024, 1, 9))
    tx.filter(~late).write.parquet(tx_dir)
    run_incremental(spark, tx_dir, tx.schema, snap, ck, lc.segmentation_backfill).awaitTermination(120)
    dates = {r[0] for r in spark.read.parquet(snap).select("ref_date").distinct().collect()}
    assert max(dates) > D(2024, 1, 9)
    assert tx.filter(late).count() > 0
    tx.filter(late).write.mode("append").parquet(tx_dir)
    run_incremental(spark, tx_dir, tx.schema, snap, ck, lc.segmentation_backfill).awaitTermination(120)
    want = lc.segmentation_backfill(tx, [d + dt.timedelta(days=1) for d in sorted(dates | {D(2024, 1, 9)})])
    got = spark.read.parquet(snap).select(*want.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_replayed_batch_is_not_doubled(spark, scratch):
    import shutil
    data = spark.createDataFrame([(i, float(i % 2), i % 3) for i in range(60)], "user_id int, label double, tx_life int")
    root, in_dir, out, ck = (os.path.join(scratch, x) for x in ("models", "in", "out", "ck"))
    save_model(spark, mm.build_pipeline(["tx_life"], [], "dt").fit(data), {}, root)
    os.makedirs(in_dir)
    with open(os.path.join(in_dir, "a.json"), "w") as fh:
        fh.write('{"user_id": "x", "tx_life": 1}\n')
    for _ in range(2):  # the second run has lost the commit log and replays batch 0
        score_stream(spark, root, in_dir, out, ck, {"tx_life": "int"}).awaitTermination(120)
        assert spark.read.parquet(os.path.join(out, "scores")).count() == 1
        for log in ("commits", "offsets", "sources"):
            shutil.rmtree(os.path.join(ck, log), ignore_errors=True)
