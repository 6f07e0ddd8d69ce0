"""Boundary tests for the two rule chains (FIXTURES §4), both presets."""

import itertools

import pytest
from pyspark.sql import functions as F

from loyalspark.config import MAIN, REFS
from loyalspark.functions.classify import classify_lifecycle, classify_rfv


def expected_state(first, last, prev, labels):
    cu, lo, rg, rb, to, de, zo = labels
    gap = None if prev is None else prev - last
    if first <= 7:
        return cu
    if last <= 7 and gap is not None and gap <= 14:
        return lo
    if last <= 7 and gap is not None and 15 <= gap <= 27:
        return rg
    if last <= 7 and gap is not None and gap >= 28:
        return rb
    if 8 <= last <= 14:
        return to
    if 15 <= last <= 28:
        return de
    if last > 28:
        return zo
    return None


def expected_rfv_main(f, v, labels):
    lu, la, po, un, ha, hy, ef = labels
    if f is None:
        return None
    if f < 5 and v < 900:
        return lu
    if 5 <= f <= 10 and v < 900:
        return la
    if f >= 10 and v < 900:
        return po
    if f < 10 and 900 <= v <= 1500:
        return un
    if f >= 10 and 900 <= v <= 1500:
        return ha
    if f < 10 and v > 1500:
        return hy
    if f >= 10 and v > 1500:
        return ef
    return None


def expected_rfv_refs(f, v, labels):
    lu, la, po, un, ha, hy, ef = labels
    if f is None:
        return None
    if f <= 10 and v >= 1500:
        return hy
    if f > 10 and v >= 1500:
        return ef
    if f <= 10 and v >= 750:
        return un
    if f > 10 and v >= 750:
        return ha
    if f < 5:
        return lu
    if f <= 10:
        return la
    return po


@pytest.mark.parametrize("preset", [MAIN, REFS])
def test_lifecycle_boundaries(spark, preset):
    ages = [1, 7, 8, 14, 15, 28, 29, 40]
    gaps = [None, 14, 15, 27, 28]
    rows = []
    for first, last, gap in itertools.product(ages, ages, gaps):
        if last > first:
            continue
        prev = None if gap is None else last + gap
        if prev is not None and prev > first:
            continue
        rows.append((first, last, prev))
    df = spark.createDataFrame(rows, "first_age long, last_age long, prev_age long")
    got = df.withColumn("s", classify_lifecycle("first_age", "last_age", "prev_age", preset.lifecycle)).collect()
    for r in got:
        assert r.s == expected_state(r.first_age, r.last_age, r.prev_age, preset.lifecycle.labels), r


def test_single_visit_user_is_curious_or_aging(spark):
    # one active day: first = last, no previous day
    df = spark.createDataFrame([(5, 5, None), (10, 10, None), (30, 30, None)],
                               "first_age long, last_age long, prev_age long")
    got = [r.s for r in df.select(classify_lifecycle("first_age", "last_age", "prev_age",
                                                     MAIN.lifecycle).alias("s")).collect()]
    assert got == ["01-CURIOSO", "03-TURISTA", "05-ZUMBI"]


@pytest.mark.parametrize("preset,ref", [(MAIN, expected_rfv_main), (REFS, expected_rfv_refs)])
def test_rfv_grid_boundaries(spark, preset, ref):
    freqs = [None, 1, 4, 5, 9, 10, 11, 28]
    values = [0, 749, 750, 899, 900, 1499, 1500, 1501, 5000]
    rows = [(f, v) for f in freqs for v in values]
    df = spark.createDataFrame(rows, "f long, v long")
    got = df.withColumn("c", classify_rfv("f", "v", preset.rfv)).collect()
    for r in got:
        assert r.c == ref(r.f, r.v, preset.rfv.labels), r


def test_rfv_main_potential_cluster_unit(spark):
    # "20" (frequency > 10 and value < 900) never occurs in the fixtures
    df = spark.createDataFrame([(11, 100), (10, 100)], "f long, v long")
    got = [r.c for r in df.select(classify_rfv("f", "v", MAIN.rfv).alias("c")).collect()]
    assert got == ["20.POTENCIAL", "01.PREGUIÇOSO"]
