"""C17 from activity spans and day by day, against the window over snapshots."""

import datetime as dt
import random

from conftest import tx_frame
from loyalspark.config import MAIN, REFS
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import lifecycle_features as lf
from loyalspark.operators import state_history as sh
from loyalspark.sources.calendar import spine_dates

D = dt.date
SINCE, LAST = D(2024, 1, 1), D(2024, 4, 20)


def tx(spark):
    r = random.Random(8)
    rows, k = [], 0
    for user in range(40):
        day = r.randrange(-40, 80)
        while day < 115:
            for _ in range(r.choice([1, 1, 2])):
                rows.append((k, user, (dt.datetime(2024, 1, 1, r.randrange(24)) + dt.timedelta(days=day)).isoformat(sep=" "), r.randrange(-50, 900)))
                k += 1
            day += r.choice([1, 2, 6, 7, 8, 9, 13, 14, 15, 16, 27, 28, 29, 30, 31, 60])
    return tx_frame(spark, rows)


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)) for r in df.collect()), key=str)


def test_spans_are_the_daily_states(spark):
    t = tx(spark)
    cuts = spine_dates(SINCE, LAST)
    want = {(r.user_id, (r.ref_date - D(1970, 1, 1)).days + 1): r.state for r in lc.segmentation_backfill(t, cuts, MAIN).collect()}
    got = {}
    for r in sh.state_spans(t, SINCE, LAST, MAIN).collect():
        for c in range(r.lo, r.hi + 1):
            assert (r.user_id, c) not in got
            got[r.user_id, c] = r.state
    assert got == want


def test_daily_equals_window(spark):
    t = tx(spark)
    for cfg in (MAIN, REFS, MAIN.with_features(lc_current_offset=1)):
        off = cfg.features.lc_current_offset
        # at offset 0 the snapshot of the cut-off day itself has to exist
        snapshots = lc.segmentation_backfill(t, spine_dates(SINCE, LAST + dt.timedelta(days=1)), cfg)
        for cuts in ([LAST], [SINCE + dt.timedelta(days=k) for k in (off, 1, 10, 29, 30, 31, 80)]):
            got = rows(sh.fs_life_cycle_daily(t, cuts, SINCE, cfg))
            assert got == rows(lf.fs_life_cycle(snapshots, cuts, cfg)) and got
    keys = spark.createDataFrame([(3, LAST), (4, LAST)], "user_id long, cutoff date")
    assert {r.user_id for r in sh.fs_life_cycle_daily(t, [LAST], SINCE, REFS, keys=keys).collect()} <= {3, 4}
    assert sh.fs_life_cycle_daily(t, ["no date"], SINCE, REFS).count() == 0


def test_advance_equals_window(spark, scratch):
    t = tx(spark)
    for cfg in (MAIN, REFS):
        off = cfg.features.lc_current_offset
        path = f"{scratch}/{cfg.name}"
        lc.segmentation_backfill(t, spine_dates(SINCE, D(2024, 3, 10)), cfg).write.partitionBy("ref_date").parquet(path)
        snapshots = spark.read.parquet(path)
        day = D(2024, 2, 28)
        state = sh.begin(snapshots, day, cfg)
        for _ in range(5):
            day += dt.timedelta(days=1)
            state.write.parquet(f"{path}-state/{day}")
            today = snapshots.filter(snapshots.ref_date == day)
            state = sh.advance(spark.read.parquet(f"{path}-state/{day}"), today, day, cfg)
        cut = day + dt.timedelta(days=off)
        assert rows(sh.features_of(state, cfg)) == rows(lf.fs_life_cycle(snapshots, [cut], cfg))
        assert rows(sh.features_of(sh.begin(snapshots, day, cfg), cfg)) == rows(sh.features_of(state, cfg))


def test_users_that_miss_days(spark):
    """Rows missing from a snapshot, and a day without a snapshot."""
    day = lambda k: D(2024, 1, 1) + dt.timedelta(days=k)
    data = [(day(k), u, MAIN.lifecycle.labels[(k + u) % 7], k % 4 or None) for k in range(50) for u in range(3) if not (u == 1 and k % 3 == 0) and k != 20]
    snaps = spark.createDataFrame(data, "ref_date date, user_id long, state string, frequency long")
    state, last = sh.begin(snaps, day(0), MAIN), 0
    for k in [k for k in range(1, 44) if k != 20]:
        rows_now = [tuple(r) for r in state.collect()]
        state = sh.advance(spark.createDataFrame(rows_now, state.schema), snaps.filter(snaps.ref_date == day(k)), day(k), MAIN, gap=k - last)
        last = k
    assert rows(sh.features_of(state, MAIN)) == rows(lf.fs_life_cycle(snaps, [day(43)], MAIN))


def test_job_reads_two_partitions_and_rebuilds_after_late_snapshots(spark, scratch):
    from loyalspark.plans import jobs
    from loyalspark.sources.store import Sources, dates_of
    src = Sources(scratch)
    t = tx(spark)
    t.write.parquet(src.path(jobs.LOYALTY, "transactions"))
    table, states = src.path(jobs.ANALYTICS, "life_cycle"), src.path(jobs.ANALYTICS, "life_cycle_state")
    jobs.run_job(spark, "life_cycle", D(2024, 2, 1), D(2024, 3, 10), src, cfg=REFS)

    def stored(cut):
        jobs.run_job(spark, "fs_life_cycle", cut, cut, src, cfg=REFS)
        at = spark.read.parquet(src.path(jobs.ANALYTICS, "fs_life_cycle"))
        return rows(at.filter(at.cutoff == cut))

    def want(cut):
        return rows(lf.fs_life_cycle(spark.read.parquet(table), [cut], REFS))

    assert stored(D(2024, 2, 10)) == want(D(2024, 2, 10))
    assert stored(D(2024, 3, 1)) == want(D(2024, 3, 1))
    day = D(2024, 3, 1)
    plan = jobs.next_states(spark, src, day, REFS)
    folders = {f.rsplit("/", 1)[0] for f in plan.inputFiles()}
    assert {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in folders} == {
        "life_cycle/ref_date=2024-03-01", "life_cycle_state/ref_date=2024-02-29"}
    assert stored(D(2024, 3, 5)) == want(D(2024, 3, 5))
    # a snapshot that changes later drops the states from its date on
    more = tx_frame(spark, [(90000 + i, 500 + i, "2024-02-20 10:00:00", 5) for i in range(3)])
    more.write.mode("append").parquet(src.path(jobs.LOYALTY, "transactions"))
    jobs.run_job(spark, "life_cycle", D(2024, 2, 21), D(2024, 3, 10), src, cfg=REFS)
    assert dates_of(spark, states) == [D(2024, 2, 9)]
    assert stored(D(2024, 3, 5)) == want(D(2024, 3, 5)) and any(r for r in stored(D(2024, 3, 5)) if 500 in r)
