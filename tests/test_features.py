"""Feature-store edge cases (FIXTURES §4) and properties."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001, tx_frame
from loyalspark.config import MAIN, REFS
from loyalspark.operators import education as ed
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import lifecycle_features as lf
from loyalspark.operators import transactional as tr
from loyalspark.sources import fixtures as fx

D = dt.date
CUT = D(2024, 2, 1)


def test_single_transaction_and_zero_denominators(spark):
    tx = tx_frame(spark, [
        (1, 1, "2024-01-31 10:00:00", 5),                                   # one tx, one day
        (2, 2, "2024-01-01 09:00:00", 5), (3, 2, "2024-01-01 15:30:00", -2),  # no activity in D7
    ])
    rows = {r.user_id: r for r in tr.fs_transactional(tx, [CUT], MAIN).collect()}
    u1, u2 = rows[1], rows[2]
    assert u1.hours_life == 0.0 and u1.gap_mean_life is None and u1.active_days_d7 == 1
    assert u2.active_days_d7 == 0 and u2.tx_per_day_d7 == 0.0 and u2.pts_pos_d7 == 0
    assert abs(u2.hours_life - 6.5) < 1e-9
    assert u2.pts_neg_life == 2
    refs = {r.user_id: r for r in tr.fs_transactional(tx, [CUT], REFS).collect()}
    assert refs[2].pts_neg_life == -2
    # refs age: fractional days from the first timestamp to cutoff - 1
    assert abs(refs[2].age_days - (30 - 9 / 24)) < 1e-9


def test_daypart_counts_sum_to_rows(spark):
    tx = fx.tx_events(spark, SF001)
    fs = tr.fs_transactional(tx, [D(2024, 1, 31)], MAIN)
    bad = fs.filter(F.col("tx_morning") + F.col("tx_afternoon") + F.col("tx_night") != F.col("tx_life"))
    assert bad.count() == 0


def test_daypart_edges(spark):
    hours = [9, 10, 14, 15, 21, 22]
    tx = tx_frame(spark, [(i, 1, f"2024-01-30 {h:02d}:00:00", 1) for i, h in enumerate(hours)])
    r = tr.fs_transactional(tx, [CUT], MAIN).collect()[0]
    assert (r.tx_morning, r.tx_afternoon, r.tx_night) == (2, 2, 2)


def test_product_share_can_exceed_one(spark):
    tx = tx_frame(spark, [(1, 1, "2024-01-10 10:00:00", 1)])
    items = spark.createDataFrame([(1, 10), (1, 10), (1, 11)], "tx_id long, product_id long")
    prods = spark.createDataFrame([(10, "A", "x"), (11, "B", "y")], "product_id long, name string, category string")
    cfg = MAIN.with_features(products=("A", "B"), categories=("x",))
    r = tr.fs_transactional(tx, [CUT], cfg, items=items, products=prods).collect()[0]
    assert r.share_prod_a == 2.0 and r.share_prod_b == 1.0 and r.share_cat_x == 2.0
    rr = tr.fs_transactional(tx, [CUT], REFS.with_features(products=("A", "B"), categories=("x",)),
                             items=items, products=prods).collect()[0]
    assert abs(rr.share_prod_a - 2 / 3) < 1e-12


def test_duplicate_completion_and_bridge(spark):
    ts = dt.datetime(2024, 1, 5)
    done = spark.createDataFrame([(1, "c1", "e1", ts), (1, "c1", "e1", ts), (2, "c1", "e1", ts),
                                  (3, "c2", "e1", ts)], "user long, course string, episode string, ts timestamp_ntz")
    reg = spark.createDataFrame([("c1", "e1"), ("c2", "e1"), ("c2", "e2")], "course string, episode string")
    rew = spark.createDataFrame([(1, ts), (9, ts)], "user long, ts timestamp_ntz")
    sk = spark.createDataFrame([], "user long, ts timestamp_ntz")
    bridge = spark.createDataFrame([(1, "C1"), (3, "C3"), (9, "C9")], "user long, customer_id string")
    out = {r.user: r for r in ed.fs_education(done, reg, rew, sk, bridge, [CUT], ["c1", "c2"], MAIN).collect()}
    assert set(out) == {1, 3}  # user 2 not in the bridge, user 9 has a reward but no episode
    assert out[1].share_c1 == 2.0 and out[1].n_complete == 0 and out[1].n_in_progress == 0
    assert out[3].share_c2 == 0.5 and out[3].n_in_progress == 1 and out[3].share_c1 is None
    assert out[1].days_since_activity == 27.0


def test_state_shares_sum_to_one(spark):
    tx = fx.tx_events_thin(spark, SF001)
    snaps = lc.segmentation_backfill(tx, [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(31)], REFS)
    fs = lf.fs_life_cycle(snaps, [D(2024, 1, 31)], REFS)
    pct = [c for c in fs.columns if c.startswith("pct_")]
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in pct), F.lit(0.0))
    bad = fs.filter(F.col(pct[0]).isNotNull() & (F.abs(total - 1.0) > 1e-9))
    assert bad.count() == 0
    assert fs.count() > 0
