"""Date spines, activity bounds and the canonical projections / filters.

S7 daily spine, S8 month-start spine, S9 first/last activity, P3 look-back
filter, P11 complete rows, P13 fixed columns. Filters are written on the bare ``ts`` column so they reach the
parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.functions.expr import as_date


def date_spine(spark: SparkSession, start, stop, step: str = "day", pad: bool = False) -> DataFrame:
    """Inclusive spine of cut-off dates as a one-column DataFrame ``cutoff``.

    ``step='month'`` keeps the month starts in [start, stop] (the compact
    variant's "dates ending in 01"); with ``pad=True`` one more month start is
    appended when the last start lies before ``stop`` (step-by-step variant).
    """
    bounds = spark.range(1).select(F.lit(as_date(start)).alias("first_day"), F.lit(as_date(stop)).alias("last_day"))
    return spine_between(bounds, step, pad)


def spine_between(bounds: DataFrame, step: str = "day", pad: bool = False) -> DataFrame:
    """The same spine between two date columns ``first_day`` and ``last_day``
    (such as ``activity_bounds``); empty where nothing lies between them."""
    if step not in ("day", "month"):
        raise ValueError(f"unknown step {step!r}")
    lo, hi = F.col("first_day"), F.col("last_day")
    if step == "month":
        lo = F.when(F.dayofmonth(lo) == 1, lo).otherwise(F.add_months(F.trunc(lo, "MM"), 1))
        if pad:  # one more start after a month that is already under way
            hi = F.when((F.dayofmonth(hi) > 1) & (lo <= F.add_months(F.trunc(hi, "MM"), 1)),
                        F.add_months(F.trunc(hi, "MM"), 1)).otherwise(hi)
    days = F.sequence(lo, hi, F.expr(f"INTERVAL 1 {step.upper()}"))
    return bounds.select(F.explode(F.when(lo <= hi, days)).alias("cutoff"))


def spine_dates(start, stop, step: str = "day", pad: bool = False) -> list[_dt.date]:
    """Driver-side list of the same spine (parameters, not data)."""
    start, stop = as_date(start), as_date(stop)
    out = []
    if step == "day":
        d = start
        while d <= stop:
            out.append(d)
            d += _dt.timedelta(days=1)
        return out
    d = start if start.day == 1 else (start.replace(day=1) + _dt.timedelta(days=32)).replace(day=1)
    while d <= stop:
        out.append(d)
        d = (d + _dt.timedelta(days=32)).replace(day=1)
    if pad and stop.replace(day=1) < stop:
        out.append((stop.replace(day=1) + _dt.timedelta(days=32)).replace(day=1))
    return out


def activity_bounds(tx: DataFrame) -> DataFrame:
    """First and last active day of the whole table (one row)."""
    return tx.agg(F.min(F.to_date("ts")).alias("first_day"),
                  F.max(F.to_date("ts")).alias("last_day"))


def lookback(tx: DataFrame, cutoff, days: int = 28, ts_col: str = "ts") -> DataFrame:
    """``cutoff - days <= ts < cutoff``; midnight at ``cutoff - days`` is kept.
    An unparsable cut-off keeps nothing (S10)."""
    try:
        c = as_date(cutoff)
    except ValueError:
        return tx.filter(F.lit(False))
    lo = c - _dt.timedelta(days=days)
    return tx.filter((F.col(ts_col) >= F.lit(lo)) & (F.col(ts_col) < F.lit(c)))


def drop_incomplete(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``subset``."""
    return df.dropna(subset=list(subset))


def select_fixed(df: DataFrame, columns: list[str], fill=0) -> DataFrame:
    """Exactly ``columns`` in that order; absent ones are created as
    the constant ``fill``."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns])
