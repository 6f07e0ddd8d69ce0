"""The education store at one cut-off: the rows of many, by grouped sums."""

import datetime as dt

from loyalspark.config import MAIN, REFS
from loyalspark.operators import education as ed

CUT = dt.date(2024, 2, 1)


def _store(spark, cuts, cfg):
    def frame(rows, schema):
        return spark.createDataFrame([tuple(dt.datetime.fromisoformat(x) if ":" in str(x) else x for x in r) for r in rows], schema)

    done = frame([
        (1, "c1", "e1", "2024-01-03 10:00:00"), (1, "c1", "e2", "2024-01-05 10:00:00"),  # complete
        (1, "c2", "e1", "2024-01-09 10:00:00"),                                          # in progress
        (2, "c2", "e1", "2024-01-09 10:00:00"), (2, "c2", "e1", "2024-01-09 11:00:00"),
        (2, "c2", "e9", "2024-01-20 11:00:00"), (2, "c2", "e8", "2024-01-21 11:00:00"),  # more than the register has
        (3, "gone", "e1", "2024-01-09 10:00:00"), (3, None, "e1", "2024-01-10 10:00:00"),  # no course of the register
        (3, "c4", "e1", "2024-01-11 10:00:00"),                                          # none of the slugs
        (4, "c1", "e1", "2024-02-01 00:00:00"),                                          # at the cut-off: after it
        (6, "c1", "e1", "2024-01-09 10:00:00"),                                          # not on the bridge
    ], "user long, course string, episode string, ts timestamp_ntz")
    reg = frame([("c1", "e1"), ("c1", "e2"), ("c2", "e1"), ("c2", "e2"), ("c2", "e3"), ("c4", "e1")], "course string, episode string")
    rewards = frame([(1, "2024-01-20 08:00:00"), (5, "2024-01-20 08:00:00")], "user long, ts timestamp_ntz")
    skills = frame([(1, "2024-01-02 08:00:00"), (2, "2024-03-01 08:00:00")], "user long, ts timestamp_ntz")
    bridge = frame([(i, f"C{i}") for i in range(1, 6)], "user long, customer_id string")
    return ed.fs_education(done, reg, rewards, skills, bridge, cuts, ["c1", "c2", "c3", "gone"], cfg)


def test_one_cutoff_has_the_rows_of_many(spark):
    for cfg in (MAIN, REFS):
        one = _store(spark, [CUT], cfg)
        many = _store(spark, [dt.date(2024, 1, 6), CUT], cfg).filter(f"cutoff = DATE'{CUT}'")
        assert one.dtypes == many.dtypes
        assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
        assert sorted(r.user for r in one.collect()) == [1, 2, 3]


def test_one_cutoff_needs_no_windows(spark):
    plan = _store(spark, [CUT], MAIN)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_no_valid_cutoff_gives_no_rows(spark):
    import warnings
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert _store(spark, ["no date"], MAIN).count() == 0
