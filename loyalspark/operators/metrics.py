"""Activity metrics: C1 DAU, C2 rolling MAU, C3/C4 monthly smoothing and
means, C5 histograms, C6 activity bounds, C22 user drill-down."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.functions.expr import day_number, utc


def daily_users(tx: DataFrame) -> DataFrame:
    """Distinct (user_id, day)."""
    return utc(tx).select("user_id", F.to_date("ts").alias("day")).distinct()


def dau(tx: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct active users per day (``day``, ``dau``).

    Exact distinct count is planned as a (day, user) partial de-duplication
    before the shuffle, so hot users or days do not concentrate raw rows.
    ``approx=True`` switches to HyperLogLog for very large inputs.
    """
    agg = (F.approx_count_distinct("user_id") if approx else F.countDistinct("user_id"))
    return (utc(tx).groupBy(F.to_date("ts").alias("day"))
            .agg(agg.cast("long").alias("dau"))
            .orderBy("day"))


def mau(tx: DataFrame, window: int = 28) -> DataFrame:
    """Rolling distinct users over ``window`` days for each active day.

    Returns ``ref_day, days_in_window, mau``. Instead of the range join
    ``day <= ref < day + window`` (a nested loop in Spark), every user-day
    becomes a coverage interval [day, min(day + window - 1, next_day - 1)];
    a user's intervals are disjoint, so users active in the window of day r
    = number of intervals covering r = running sum of +1/-1 deltas. Only
    per-day aggregates (bounded by the calendar, not by the data) reach the
    final ordered window.
    """
    daily = daily_users(tx)
    w = Window.partitionBy("user_id").orderBy("day")
    nxt = F.lead("day").over(w)
    cover_end = F.least(F.date_add("day", window - 1),
                        F.coalesce(F.date_sub(nxt, 1), F.date_add("day", window - 1)))
    iv = daily.select(F.col("day").alias("start"), cover_end.alias("end"))
    # every active day starts an interval: one explode yields the +1 (active)
    # and -1 delta rows, so the input is read and shuffled once
    ev = iv.select(F.explode(F.array(
        F.struct(F.col("start").alias("day"), F.lit(1).alias("delta"), F.lit(1).alias("active")),
        F.struct(F.date_add("end", 1).alias("day"), F.lit(-1).alias("delta"), F.lit(0).alias("active")))).alias("e"))
    merged = (ev.select("e.*")
              .groupBy("day").agg(F.sum("delta").alias("delta"), F.max("active").alias("active"))
              .withColumn("_dn", day_number("day")))
    # single ordered pass over one row per calendar day
    wo = Window.orderBy("_dn")
    return (merged.select(
                F.col("day").alias("ref_day"), "active",
                F.sum("active").over(wo.rangeBetween(-(window - 1), 0)).cast("long").alias("days_in_window"),
                F.sum("delta").over(wo.rangeBetween(Window.unboundedPreceding, 0)).cast("long").alias("mau"))
            .filter(F.col("active") == 1)
            .drop("active")
            .orderBy("ref_day"))


def monthly_mean(metric: DataFrame, day_col: str = "day", value_col: str = "dau") -> DataFrame:
    """Mean of a daily metric per month label ``yyyy-MM``."""
    return (metric.groupBy(F.date_format(day_col, "yyyy-MM").alias("month"))
            .agg(F.avg(value_col).alias(f"{value_col}_mean"))
            .orderBy("month"))


def monthly_smoothing(metric: DataFrame, day_col: str = "day", value_col: str = "dau") -> DataFrame:
    """Daily metric plus the mean of its calendar month on every row."""
    w = Window.partitionBy(F.trunc(day_col, "MM"))
    return metric.withColumn(f"{value_col}_monthly", F.avg(value_col).over(w))


def histogram(df: DataFrame, column: str, bins="sturges", by: list | None = None) -> DataFrame:
    """Equal-width histogram over shared edges.

    ``bins`` is an int or ``'sturges'`` (ceil(log2 n) + 1). Edges span
    [min, max] of the whole column; the maximum falls in the last bin. With
    ``by`` (e.g. year, month) counts and densities (count / (n_group * width))
    are computed per group on the same edges. The edges are a scalar subquery
    (one row); the counts one grouped aggregate.
    """
    by = list(by or [])
    nb = (F.ceil(F.log2(F.count(column))) + 1 if bins == "sturges" else F.lit(int(bins))).cast("long")
    lo, hi = F.min(column).cast("double"), F.max(column).cast("double")
    edges = df.agg(F.struct(lo.alias("lo"), nb.alias("nb"), F.when(hi > lo, (hi - lo) / nb).otherwise(F.lit(1.0)).alias("width"))
                   .alias("e")).scalar()
    e = F.col("__e")
    placed = df.filter(F.col(column).isNotNull()).withColumn("__e", edges)
    bin_ = F.least(F.floor((F.col(column) - e["lo"]) / e["width"]).cast("long"), e["nb"] - 1)
    counted = (placed.groupBy(*by, bin_.alias("bin")).agg(F.count(F.lit(1)).alias("count"), F.first("__e").alias("__e")))
    # per-group totals: one row per (group, bin), bounded by the bin count
    wg = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    return (counted.select(
                *by, "bin",
                (e["lo"] + F.col("bin") * e["width"]).alias("bin_lo"),
                (e["lo"] + (F.col("bin") + 1) * e["width"]).alias("bin_hi"),
                F.col("count").cast("long").alias("count"),
                (F.col("count") / (F.sum("count").over(wg) * e["width"])).alias("density"))
            .orderBy(*by, "bin"))


def user_history(tx: DataFrame, user_id) -> DataFrame:
    """Per-timestamp drill-down for one user (points by kind)."""
    p = F.col("points")
    return (tx.filter(F.col("user_id") == F.lit(user_id))
            .groupBy("user_id", "ts")
            .agg(F.countDistinct(F.to_date("ts")).cast("long").alias("frequency"),
                 F.sum(F.when(p > 0, p).otherwise(0)).cast("long").alias("points_pos"),
                 F.sum(F.when(p > 0, p).otherwise(F.abs(p))).cast("long").alias("points_total"),
                 F.sum(F.when(p < 0, F.abs(p)).otherwise(0)).cast("long").alias("points_redeem"),
                 F.count(F.lit(1)).cast("long").alias("n_tx"))
            .orderBy("user_id", F.desc("ts")))
