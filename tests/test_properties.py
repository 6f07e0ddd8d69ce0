"""Property tests (hypothesis): as-of rollup and life-cycle snapshot against a
brute-force model on random small histories."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loyalspark.config import MAIN
from loyalspark.functions.classify import classify_lifecycle  # noqa: F401
from loyalspark.operators import lifecycle as lc

D0 = dt.date(2024, 1, 1)

histories = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 60), st.integers(-30, 200)),
    min_size=1, max_size=40)
cutoff_sets = st.lists(st.integers(1, 70), min_size=1, max_size=6, unique=True)


def _expected(rows, cut):
    out = {}
    for u in {r[0] for r in rows}:
        days = sorted({D0 + dt.timedelta(days=d) for uu, d, _ in rows if uu == u and D0 + dt.timedelta(days=d) < cut})
        if not days:
            continue
        win = [(D0 + dt.timedelta(days=d), p) for uu, d, p in rows
               if uu == u and cut - dt.timedelta(days=28) <= D0 + dt.timedelta(days=d) < cut]
        freq = len({d for d, _ in win}) if win else None
        pos = sum(p for _, p in win if p > 0) if win else None
        out[u] = ((cut - days[0]).days, (cut - days[-1]).days,
                  (cut - days[-2]).days if len(days) > 1 else None, freq, pos)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=histories, cuts=cutoff_sets)
def test_backfill_matches_brute_force(spark, rows, cuts):
    data = [(i, u, dt.datetime.combine(D0 + dt.timedelta(days=d), dt.time(12)), p, "k")
            for i, (u, d, p) in enumerate(rows)]
    tx = spark.createDataFrame(data, "tx_id long, user_id long, ts timestamp_ntz, points long, kind string")
    cut_dates = [D0 + dt.timedelta(days=c) for c in cuts]
    got = lc.segmentation_backfill(tx, cut_dates, MAIN).collect()
    by_cut = {}
    for r in got:
        by_cut.setdefault(r.ref_date + dt.timedelta(days=1), {})[r.user_id] = (
            r.first_age, r.last_age, r.prev_age, r.frequency, r.points_pos)
    for c in cut_dates:
        assert by_cut.get(c, {}) == _expected(rows, c)
