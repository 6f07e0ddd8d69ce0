"""Scalar column helpers (all native Spark expressions, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0
MICROS_PER_HOUR = 3_600_000_000.0


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> _dt.date:
    """Parse a cut-off given as ``date``/``datetime``/``'YYYY-MM-DD'``."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    return _dt.date.fromisoformat(str(d))


def utc(df, column: str = "ts"):
    """``df`` with ``column`` as a UTC wall-clock timestamp, whatever time zone
    the session is set to (F5); a timestamp without zone is taken as UTC."""
    if df.schema[column].dataType.simpleString() != "timestamp":
        return df
    return df.withColumn(column, F.to_utc_timestamp(column, F.current_timezone()).cast("timestamp_ntz"))


def safe_ratio(a, b, default: float | None = 0.0) -> Column:
    """``COALESCE(1.0 * a / NULLIF(b, 0), default)`` as a double."""
    r = F.try_divide(col(a).cast("double"), col(b).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def ratio_or_null(a, b) -> Column:
    """``a / b`` as a double, NULL when ``b`` is 0 or NULL."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def day_number(c) -> Column:
    """Days since 1970-01-01 of a date column (for range frames)."""
    return F.unix_date(col(c).cast("date"))


def days_between(later, earlier) -> Column:
    """whole days between two dates as BIGINT."""
    return F.datediff(col(later), col(earlier)).cast("long")


def micros_between(earlier, later) -> Column:
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later))


def fractional_days(earlier, later) -> Column:
    """``JULIANDAY(later) - JULIANDAY(earlier)`` on timestamps."""
    return micros_between(earlier, later).cast("double") / F.lit(MICROS_PER_DAY)


def hours_between(earlier, later) -> Column:
    """24 * fraction-of-day difference, i.e. hours."""
    return micros_between(earlier, later).cast("double") / F.lit(MICROS_PER_HOUR)


def hash_order(seed, *cols) -> Column:
    """Deterministic pseudo-random order key, reproducible in SQL as
    ``md5(concat_ws('-', seed, cols...))``."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[col(c).cast("string") for c in cols]))


def between(c, lo, hi) -> Column:
    return (col(c) >= lo) & (col(c) <= hi)


def daypart(hour_col, morning=(10, 14), afternoon=(15, 21)) -> dict:
    """Boolean columns for morning / afternoon / night."""
    h = col(hour_col)
    return {
        "morning": between(h, *morning),
        "afternoon": between(h, *afternoon),
        "night": (h > afternoon[1]) | (h < morning[0]),
    }
