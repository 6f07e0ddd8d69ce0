"""As-of plans against brute force, and multi-cut-off == single cut-off."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF001, tx_frame
from loyalspark.config import MAIN, REFS
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import metrics as mt
from loyalspark.plans.asof import Cutoffs, Frame, asof_rollup
from loyalspark.sources import fixtures as fx

D = dt.date


def _random_days(seed=7, users=6, span=90):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        for d in rnd.sample(range(span), rnd.randint(1, 25)):
            rows.append((u, D(2024, 1, 1) + dt.timedelta(days=d), rnd.randint(-5, 20)))
    return rows


def test_asof_rollup_matches_brute_force(spark):
    rows = _random_days()
    days = spark.createDataFrame(rows, "user_id long, day date, v long")
    cuts = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(0, 100, 3)]
    got = asof_rollup(days, ["user_id"], Cutoffs(cuts),
                      [Frame("s7", "sum", "v", 7), Frame("n28", "count", "v", 28),
                       Frame("life", "sum", "v", None), Frame("first", "min", "day", None)]).collect()
    got = {(r.user_id, r.cutoff): r for r in got}
    exp = {}
    for c in cuts:
        for u in {r[0] for r in rows}:
            hist = sorted((d, v) for uu, d, v in rows if uu == u and d < c)
            if not hist:
                continue
            in7 = [v for d, v in hist if d >= c - dt.timedelta(days=7)]
            in28 = [v for d, v in hist if d >= c - dt.timedelta(days=28)]
            exp[(u, c)] = (sum(in7) if in7 else None, len(in28), sum(v for _, v in hist), hist[0][0],
                           hist[-1][0], hist[-2][0] if len(hist) > 1 else None)
    assert set(got) == set(exp)
    for k, e in exp.items():
        r = got[k]
        assert (r.s7, r.n28, r.life, r.first, r.last_day, r.prev_day) == e, (k, r, e)


def test_backfill_filtered_equals_single_cutoff(spark):
    tx = fx.tx_orders(spark, SF001)
    cuts = [D(1998, 7, 1), D(2000, 1, 1), D(2001, 8, 1)]
    multi = lc.segmentation_backfill(tx, cuts, MAIN)
    for c in cuts:
        single = lc.segmentation_snapshot(tx, c, MAIN)
        part = multi.filter(F.col("ref_date") == F.lit(c - dt.timedelta(days=1)))
        assert single.exceptAll(part).count() == 0
        assert part.exceptAll(single).count() == 0


def test_every_active_user_has_one_state(spark):
    tx = fx.tx_events_thin(spark, SF001)
    snap = lc.segmentation_snapshot(tx, D(2024, 1, 31), REFS)
    assert snap.filter(F.col("state").isNull()).count() == 0
    assert snap.groupBy("user_id").count().filter("count > 1").count() == 0
    n_users = tx.filter(F.col("ts") < F.lit(D(2024, 1, 31))).select("user_id").distinct().count()
    assert snap.count() == n_users


def test_lookback_midnight_bounds(spark):
    # midnight exactly at cutoff - 28 is kept, midnight at the cut-off is dropped
    tx = tx_frame(spark, [(1, 1, "2024-01-03 00:00:00", 10), (2, 1, "2024-01-31 00:00:00", 10),
                          (3, 1, "2024-01-02 23:59:59", 10)])
    fv = lc.frequency_value(tx, D(2024, 1, 31)).collect()
    assert len(fv) == 1 and fv[0].frequency == 1 and fv[0].points_pos == 10
    snap = lc.segmentation_snapshot(tx, D(2024, 1, 31)).collect()[0]
    assert snap.frequency == 1 and snap.last_age == 28 and snap.first_age == 29


def test_mau_matches_range_join(spark):
    tx = fx.tx_events_thin(spark, SF001)
    got = {r.ref_day: (r.days_in_window, r.mau) for r in mt.mau(tx).collect()}
    daily = {(r.user_id, r.day) for r in mt.daily_users(tx).collect()}
    days = sorted({d for _, d in daily})
    for r in days:
        win = [(u, d) for u, d in daily if d <= r and (r - d).days < 28]
        assert got[r] == (len({d for _, d in win}), len({u for u, _ in win}))


def test_mau_at_least_dau(spark):
    tx = fx.tx_events(spark, SF001)
    j = mt.mau(tx).join(mt.dau(tx), F.col("ref_day") == F.col("day"))
    assert j.filter(F.col("mau") < F.col("dau")).count() == 0
