"""Snapshot sink idempotency, labels and cohorts."""

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF001
from loyalspark.config import MAIN
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import target as tg
from loyalspark.sources import fixtures as fx
from loyalspark.sources.store import write_snapshot

D = dt.date


def test_write_snapshot_idempotent_and_empty_rerun(spark, scratch):
    tx = fx.tx_orders(spark, SF001)
    cuts = [D(2000, 1, 1), D(2000, 2, 1)]
    snap = lc.segmentation_backfill(tx, cuts, MAIN)
    path = os.path.join(scratch, "life_cycle")
    write_snapshot(snap, path, [c - dt.timedelta(days=1) for c in cuts])
    once = spark.read.parquet(path).count()
    write_snapshot(snap, path, [c - dt.timedelta(days=1) for c in cuts])
    assert spark.read.parquet(path).count() == once == snap.count()
    # re-run of one date with an empty result removes that date only
    empty = snap.filter(F.lit(False))
    write_snapshot(empty, path, [D(2000, 1, 31)])
    left = spark.read.parquet(path)
    assert left.filter(F.col("ref_date") == F.lit(D(2000, 1, 31))).count() == 0
    assert left.filter(F.col("ref_date") == F.lit(D(1999, 12, 31))).count() > 0


def test_failed_write_keeps_the_old_dates(spark, scratch):
    import pytest
    path = os.path.join(scratch, "t")
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)], "ref_date date, v long")
    write_snapshot(df, path, [D(2024, 1, 1), D(2024, 1, 2)])
    broken = df.withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        write_snapshot(broken, path, [D(2024, 1, 1), D(2024, 1, 2)])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 2]


def test_label_immature_and_mature_only(spark):
    rows = [(D(2024, 1, 1), 1, "02-FIEL"), (D(2024, 1, 8), 1, "02-FIEL"),
            (D(2024, 1, 1), 2, "03-TURISTA"), (D(2024, 1, 8), 2, "04-DESENCANTADO"),
            (D(2024, 1, 8), 3, "05-ZUMBI")]
    snaps = spark.createDataFrame(rows, "ref_date date, user_id long, state string")
    lab = {(r.ref_date, r.user_id): r.label for r in tg.label(snaps, 7, MAIN).collect()}
    assert lab == {(D(2024, 1, 1), 1): 1, (D(2024, 1, 1), 2): 0, (D(2024, 1, 8), 1): 0,
                   (D(2024, 1, 8), 2): 0}
    mature = tg.label(snaps, 7, MAIN, mature_only=True).collect()
    assert {(r.ref_date, r.user_id) for r in mature} == {(D(2024, 1, 1), 1), (D(2024, 1, 1), 2)}


def test_cohort_at_most_k_per_user_and_deterministic(spark):
    tx = fx.tx_events_thin(spark, SF001)
    snaps = lc.segmentation_backfill(tx, [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)], MAIN)
    lab = tg.label(snaps, 7, MAIN)
    c1 = tg.cohort(lab, 2, 42, train=(D(2024, 1, 1), D(2024, 1, 25)), oot=(D(2024, 1, 26), D(2024, 1, 30)))
    per_user = c1.groupBy("tag", "user_id").count()
    assert per_user.filter("count > 2").count() == 0
    c2 = tg.cohort(lab, 2, 42, train=(D(2024, 1, 1), D(2024, 1, 25)), oot=(D(2024, 1, 26), D(2024, 1, 30)))
    assert c1.exceptAll(c2).count() == 0


def test_keyed_abt_equals_feature_store_abt(spark):
    from loyalspark.plans import catalog as C
    d = "/root/testdata/sf0.001"
    a = C.abt_frame(spark, d)
    b = C.abt_frame_keyed(spark, d).select(*a.columns)
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
