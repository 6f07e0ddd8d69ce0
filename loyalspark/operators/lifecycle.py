"""Recency life cycle and frequency-value segmentation.

C7 life_cycle, C8 frequency_value, C9 rfv_cluster, C10 cluster_sizes,
C11 segmentation_snapshot, C12 segmentation_backfill, C13 life_cycle_report,
C14 life_cycle_matrix.

Single cut-off and many cut-offs share one plan (``plans.asof``): the input
is reduced to one row per user and day, each user-day is exploded to the
cut-offs for which it is the latest activity, and the 28-day frequency-value
window is a ``rangeBetween(-28, -1)`` frame over the same user partition.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import LifecycleCfg, Preset, RfvCfg, preset as _preset
from loyalspark.functions.classify import classify_lifecycle, classify_rfv
from loyalspark.functions.expr import as_date, days_between, utc
from loyalspark.plans.asof import Cutoffs, Frame, asof_rollup, current_rows
from loyalspark.sources.calendar import lookback


def _user_days(tx: DataFrame, last_cutoff) -> DataFrame:
    """One row per (user, day) before the last cut-off with the daily point
    sums needed by the frequency-value window (partial aggregation runs
    before the shuffle, so a hot user is already collapsed per day)."""
    p = F.col("points")
    return (utc(tx).filter(F.col("ts") < F.lit(as_date(last_cutoff)))
            .groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.sum(F.when(p > 0, p).otherwise(0)).alias("pts_pos"),
                 F.sum(F.when(p > 0, p).otherwise(F.abs(p))).alias("pts_total"),
                 F.sum(F.when(p < 0, F.abs(p)).otherwise(0)).alias("pts_redeem"))
            .withColumn("is_day", F.lit(1)))


def segmentation_backfill(tx: DataFrame, cutoffs, cfg: Preset | str = "main",
                          lookback_days: int | None = None) -> DataFrame:
    """The ``life_cycle`` snapshot table for many cut-offs in one job.

    Output: ref_date (= cutoff - 1), user_id, first_age, last_age, prev_age,
    state, frequency, points_pos, points_gain, points_redeem, cluster. One
    row per user with activity before each cut-off; frequency/value columns
    are NULL when the user had no activity in the look-back window.
    """
    cfg = _preset(cfg)
    lc: LifecycleCfg = cfg.lifecycle
    k = lookback_days or lc.lookback_days
    cuts = Cutoffs(cutoffs)
    ud = _user_days(tx, cuts.last)
    fv = asof_rollup(
        ud, ["user_id"], cuts,
        [Frame("first_day", "min", "day", None),
         Frame("frequency", "sum", "is_day", k), Frame("points_pos", "sum", "pts_pos", k),
         Frame("points_redeem", "sum", "pts_redeem", k)])
    c = F.col("cutoff")
    out = fv.select(
        F.date_sub(c, 1).alias("ref_date"), "user_id",
        days_between(c, "first_day").alias("first_age"),
        days_between(c, "last_day").alias("last_age"),
        days_between(c, "prev_day").alias("prev_age"),
        F.col("frequency").cast("long").alias("frequency"),
        F.col("points_pos").cast("long").alias("points_pos"),
        F.col("points_pos").cast("long").alias("points_gain"),
        F.col("points_redeem").cast("long").alias("points_redeem"))
    return (out.withColumn("state", classify_lifecycle("first_age", "last_age", "prev_age", lc))
            .withColumn("cluster", classify_rfv("frequency", "points_pos", cfg.rfv))
            .select("ref_date", "user_id", "first_age", "last_age", "prev_age", "state",
                    "frequency", "points_pos", "points_gain", "points_redeem", "cluster"))


def segmentation_snapshot(tx: DataFrame, cutoff, cfg: Preset | str = "main") -> DataFrame:
    """C11: the ``life_cycle`` snapshot at one cut-off."""
    return segmentation_backfill(tx, [cutoff], cfg)


def life_cycle(tx: DataFrame, cutoff, cfg: Preset | str = "main") -> DataFrame:
    """Ages (first / last / penultimate active day, in days before the
    cut-off) and the recency state for every user active before it."""
    cfg = _preset(cfg)
    cuts = Cutoffs([cutoff])
    daily = (utc(tx).filter(F.col("ts") < F.lit(cuts.last))
             .select("user_id", F.to_date("ts").alias("day")).distinct())
    cur = current_rows(daily, ["user_id"], cuts)
    c = F.col("cutoff")
    return (cur.select(
                "user_id",
                days_between(c, "first_day").alias("first_age"),
                days_between(c, "last_day").alias("last_age"),
                days_between(c, "prev_day").alias("prev_age"))
            .withColumn("state", classify_lifecycle("first_age", "last_age", "prev_age", cfg.lifecycle)))


def nth_latest(tx: DataFrame, cutoff, n: int = 2) -> DataFrame:
    """(user_id, day) of the n-th latest active day before the cut-off, for
    users with that many. Planned as a window group limit over user-days."""
    cuts = Cutoffs([cutoff])
    tx = utc(tx).filter((F.col("ts") < F.lit(cuts.last)) & F.lit(cuts.valid))
    daily = tx.select("user_id", F.to_date("ts").alias("day")).distinct()
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("day")))
    return daily.withColumn("_n", place).filter(F.col("_n") == n).drop("_n")


def frequency_value(tx: DataFrame, cutoff, days: int = 28) -> DataFrame:
    """Per user over [cutoff - days, cutoff): active days and
    positive / absolute / gained / redeemed points. The window filter is on
    the bare timestamp and reaches the parquet scan."""
    p = F.col("points")
    return (lookback(utc(tx), cutoff, days)
            .groupBy("user_id")
            .agg(F.countDistinct(F.to_date("ts")).cast("long").alias("frequency"),
                 F.sum(F.when(p > 0, p).otherwise(0)).cast("long").alias("points_pos"),
                 F.sum(F.when(p > 0, p).otherwise(F.abs(p))).cast("long").alias("points_total"),
                 F.sum(F.when(p > 0, p).otherwise(0)).cast("long").alias("points_gain"),
                 F.sum(F.when(p < 0, F.abs(p)).otherwise(0)).cast("long").alias("points_redeem")))


def rfv_cluster(fv: DataFrame, cfg: Preset | RfvCfg | str = "main",
                frequency: str = "frequency", value: str = "points_pos") -> DataFrame:
    """Add the frequency x value ``cluster`` label."""
    rcfg = cfg if isinstance(cfg, RfvCfg) else _preset(cfg).rfv
    return fv.withColumn("cluster", classify_rfv(frequency, value, rcfg))


def trim(df: DataFrame, column: str, maximum) -> DataFrame:
    """P10: outlier trim ``column < maximum``."""
    return df.filter(F.col(column) < maximum)


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    """Rows per cluster."""
    return (clustered.groupBy("cluster").agg(F.count(F.lit(1)).cast("long").alias("n"))
            .orderBy("cluster"))


def at_latest(df: DataFrame, column: str = "ref_date") -> DataFrame:
    """The rows of the latest date, joined with the one-row maximum
    of the date column (over a stored table a scan of that column alone)."""
    last = df.agg(F.max(column).alias(column))
    return df.join(F.broadcast(last), column, "left_semi")


def life_cycle_report(lc: DataFrame, ref_date=None, cfg: Preset | str = "main") -> DataFrame:
    """Users per state at ``ref_date`` (default: latest), zombies
    excluded."""
    cfg = _preset(cfg)
    if ref_date is not None:
        at = lc.filter(F.col("ref_date") == F.lit(as_date(ref_date)))
    else:
        at = at_latest(lc)
    return (at.filter(F.col("state") != cfg.lifecycle.zombie)
            .groupBy("ref_date", "state").agg(F.count(F.lit(1)).cast("long").alias("n"))
            .orderBy("ref_date", "state"))


def state_column(label: str) -> str:
    return "n_" + re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")


def life_cycle_matrix(lc: DataFrame, cfg: Preset | str = "main", normalise: bool = False) -> DataFrame:
    """Snapshot date x state counts (zombie omitted, fixed
    column order, missing = 0, ``yyyy-MM`` label). ``normalise=True`` gives
    row percentages. The pivot value list is explicit: no extra job and a
    stable schema."""
    cfg = _preset(cfg)
    states = [s for s in cfg.lifecycle.labels if s != cfg.lifecycle.zombie]
    m = (lc.groupBy("ref_date").pivot("state", states).count().na.fill(0, subset=states))
    cols = [F.col(f"`{s}`").cast("long").alias(state_column(s)) for s in states]
    m = m.select("ref_date", F.date_format("ref_date", "yyyy-MM").alias("month"), *cols)
    if normalise:
        names = [state_column(s) for s in states]
        total = sum((F.col(n) for n in names), F.lit(0))
        m = m.select("ref_date", "month",
                     *[(F.lit(100.0) * F.col(n) / total).alias(n.replace("n_", "pct_", 1)) for n in names])
    return m.orderBy("ref_date")
