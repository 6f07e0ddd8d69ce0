"""The two CASE rule chains as native ``when`` expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loyalspark.config import LifecycleCfg, RfvCfg
from loyalspark.functions.expr import between, col


def classify_lifecycle(first_age, last_age, prev_age, cfg: LifecycleCfg = LifecycleCfg()) -> Column:
    """Recency state from ages in days before the cut-off (first match wins).

    curious: first age <= 7; loyal / regained / reborn: last age <= 7 with a
    gap to the previous active day of <= 14 / 15..27 / >= 28; tourist: last
    age 8..14; disenchanted: 15..28; zombie: > 28. A missing previous day
    leaves the gap NULL, so none of the three "recent" branches match.
    """
    fa, la, pa = col(first_age), col(last_age), col(prev_age)
    curious, loyal, regained, reborn, tourist, disenchanted, zombie = cfg.labels
    gap = pa - la
    recent = la <= cfg.recent_max_age
    return (
        F.when(fa <= cfg.curious_max_first_age, F.lit(curious))
        .when(recent & (gap <= cfg.loyal_max_gap), F.lit(loyal))
        .when(recent & between(gap, cfg.loyal_max_gap + 1, cfg.regained_max_gap), F.lit(regained))
        .when(recent & (gap > cfg.regained_max_gap), F.lit(reborn))
        .when(between(la, cfg.recent_max_age + 1, cfg.tourist_max_age), F.lit(tourist))
        .when(between(la, cfg.tourist_max_age + 1, cfg.disenchanted_max_age), F.lit(disenchanted))
        .when(la > cfg.disenchanted_max_age, F.lit(zombie))
    )


def classify_rfv(frequency, value, cfg: RfvCfg = RfvCfg()) -> Column:
    """Frequency (active days in 28) x value (positive points in 28) cluster.

    ``main`` grid: value cuts 900 / 1500 (1500 inclusive in the middle tier),
    frequency cuts 5 / 10, first match wins, so frequency 10 with value < 900
    falls in the "lazy" tier. ``refs`` grid: value cuts 750 / 1500 (>=),
    high value tested first, frequency <= 10 vs > 10, < 5.
    NULL frequency (no activity in the window) gives NULL.
    """
    f, v = col(frequency), col(value)
    lurker, lazy, potential, undecided, hard, hyper, efficient = cfg.labels
    if cfg.variant == "main":
        return (
            F.when((f < 5) & (v < 900), F.lit(lurker))
            .when(between(f, 5, 10) & (v < 900), F.lit(lazy))
            .when((f >= 10) & (v < 900), F.lit(potential))
            .when((f < 10) & between(v, 900, 1500), F.lit(undecided))
            .when((f >= 10) & between(v, 900, 1500), F.lit(hard))
            .when((f < 10) & (v > 1500), F.lit(hyper))
            .when((f >= 10) & (v > 1500), F.lit(efficient))
        )
    return (
        F.when((f <= 10) & (v >= 1500), F.lit(hyper))
        .when((f > 10) & (v >= 1500), F.lit(efficient))
        .when((f <= 10) & (v >= 750), F.lit(undecided))
        .when((f > 10) & (v >= 750), F.lit(hard))
        .when(f < 5, F.lit(lurker))
        .when(f <= 10, F.lit(lazy))
        .when(f > 10, F.lit(potential))
    )
