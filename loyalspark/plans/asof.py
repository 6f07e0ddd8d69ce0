"""Point-in-time plans for many cut-off dates in one job.

The original jobs run one query per cut-off date. Here every operator takes a
list of cut-offs and reads its input once:

* ``Cutoffs``        the sorted cut-off list, as a literal array plus a small
                     calendar (day -> number of cut-offs <= day). Both are
                     bounded by the cut-off span, never by the data.
* ``current_rows``   from distinct (key, day) rows with ``lag``/``lead``, each
                     active day d is the latest activity for exactly the
                     cut-offs c with d < c <= next active day. A calendar
                     lookup turns that into an index range that is exploded,
                     so the output is exactly keys x cut-offs, no range join.
* ``asof_rollup``    measures over frames that end the day before each cut-off:
                     for one cut-off a grouped aggregate, for many markers
                     among the day rows and ``rangeBetween`` frames.

Every window is partitioned by the entity key over rows that were first
reduced to one row per key and day, so a hot key holds at most one row per
calendar day plus one per cut-off.
"""

from __future__ import annotations

import datetime as _dt
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loyalspark.functions.expr import as_date


@dataclass
class Cutoffs:
    dates: list

    def __init__(self, dates):
        ds, bad = set(), []
        for d in (dates if isinstance(dates, (list, tuple, set)) else [dates]):
            try:
                ds.add(as_date(d))
            except (TypeError, ValueError):
                bad.append(d)
        if bad:  # S10: they contribute no rows, which is worth knowing in a backfill
            warnings.warn(f"no dates, left out: {bad}", stacklevel=2)
        # no valid cut-off: keep a sentinel date for the plan shape and mark
        # the list invalid, so the as-of plans return no rows
        self.valid = bool(ds)
        ds = sorted(ds) or [_dt.date(1970, 1, 1)]
        self.dates = ds

    @property
    def n(self) -> int:
        return len(self.dates)

    @property
    def first(self) -> _dt.date:
        return self.dates[0]

    @property
    def last(self) -> _dt.date:
        return self.dates[-1]

    def array(self) -> Column:
        return F.array(*[F.lit(d) for d in self.dates])

    def frame(self, spark: SparkSession) -> DataFrame:
        """One-column DataFrame ``cutoff``."""
        return spark.range(1).select(F.explode(self.array()).alias("cutoff"))

    def calendar(self, spark: SparkSession) -> DataFrame:
        """``(cal_day, cal_idx)`` for every day in [first, last]; ``cal_idx`` =
        number of cut-offs <= cal_day. Each cut-off lists the days up to the
        next one, so the cost is the span, whatever the number of cut-offs."""
        ends = [d - _dt.timedelta(days=1) for d in self.dates[1:]] + [self.last]
        spans = F.array(*[F.struct(F.lit(a).alias("lo"), F.lit(b).alias("hi"), F.lit(i).alias("cal_idx"))
                          for i, (a, b) in enumerate(zip(self.dates, ends), 1)])
        return (spark.range(1).select(F.inline(spans))
                .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("cal_day"), "cal_idx"))


def _index_of(df: DataFrame, day_col: str, out_col: str, cuts: Cutoffs, cal: DataFrame) -> DataFrame:
    """Add ``out_col`` = number of cut-offs <= ``day_col`` (NULL day -> n)."""
    c = F.col(day_col)
    lk = cal.select(F.col("cal_day").alias(f"_{out_col}_d"), F.col("cal_idx").alias(f"_{out_col}_i"))
    joined = df.join(F.broadcast(lk), c == F.col(f"_{out_col}_d"), "left")
    idx = (F.when(c.isNull(), F.lit(cuts.n))
           .when(c < F.lit(cuts.first), F.lit(0))
           .when(c >= F.lit(cuts.last), F.lit(cuts.n))
           .otherwise(F.col(f"_{out_col}_i")))
    return joined.withColumn(out_col, idx).drop(f"_{out_col}_d", f"_{out_col}_i")


def current_rows(daily: DataFrame, keys: list, cuts: Cutoffs, day_col: str = "day") -> DataFrame:
    """(keys, cutoff, first_day, last_day, prev_day) for every key active
    before each cut-off. ``daily`` holds distinct (keys, day)."""
    spark = daily.sparkSession
    cal = cuts.calendar(spark)
    if not cuts.valid:
        daily = daily.filter(F.lit(False))
    w = Window.partitionBy(*keys).orderBy(day_col)
    d = daily.select(
        *keys, F.col(day_col).alias("last_day"),
        F.lag(day_col).over(w).alias("prev_day"),
        F.lead(day_col).over(w).alias("next_day"),
        F.min(day_col).over(Window.partitionBy(*keys)).alias("first_day"))
    d = _index_of(d, "last_day", "_lo", cuts, cal)
    d = _index_of(d, "next_day", "_hi", cuts, cal)
    idx = F.explode(F.when(F.col("_hi") > F.col("_lo"),
                           F.sequence(F.col("_lo") + 1, F.col("_hi"))))
    arr = cuts.array()
    return (d.select(*keys, "first_day", "last_day", "prev_day", idx.alias("_i"))
            .select(*keys, F.element_at(arr, F.col("_i")).alias("cutoff"),
                    "first_day", "last_day", "prev_day"))


@dataclass(frozen=True)
class Frame:
    """One windowed aggregate: ``func(column)`` over the ``days`` before the
    cut-off (``None`` = all history before the cut-off)."""
    name: str
    func: str          # sum | count | min | max | avg
    column: str
    days: int | None = None


_FUNCS = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg}


def _at_one_cutoff(days: DataFrame, keys: list, cutoff: _dt.date, frames: list, day_col: str, gap: str | None) -> DataFrame:
    """``asof_rollup`` for one cut-off: a grouped aggregate with conditional
    measures. The day before each day comes from one ``lag`` on the grouping
    keys (planned only where the gap or ``prev_day`` is asked for)."""
    before = F.lag(day_col).over(Window.partitionBy(*keys).orderBy(day_col))
    d = days.filter(F.col(day_col) < F.lit(cutoff)).withColumn("_prev", before)
    if gap:
        d = d.withColumn(gap, F.datediff(day_col, "_prev").cast("long"))
    outs = [F.max(day_col).alias("last_day"), F.max("_prev").alias("prev_day")]
    for fr in frames:
        x = F.col(fr.column)
        if fr.days is not None:
            x = F.when(F.col(day_col) >= F.lit(cutoff - _dt.timedelta(days=fr.days)), x)
        outs.append(_FUNCS[fr.func](x).alias(fr.name))
    return d.groupBy(*keys).agg(*outs).select(*keys, F.lit(cutoff).alias("cutoff"), "last_day", "prev_day", *[f.name for f in frames])


def asof_rollup(days: DataFrame, keys: list, cuts: Cutoffs, frames: list,
                day_col: str = "day", gap: str | None = None,
                requested: DataFrame | None = None) -> DataFrame:
    """Single-pass as-of aggregation over per-key daily facts.

    ``days`` holds one row per (keys, day) with measure columns. In one window
    over the key partition every day row gets ``prev_day`` (lag) and the
    cut-off index range (day, next active day]; each row then emits itself
    plus one marker row per cut-off for which it is the latest activity, with
    a single ``explode``. The frame window runs on the same partitioning (no
    further shuffle, no re-scan of the input) and only the marker rows are
    kept. Output: keys, cutoff, last_day, prev_day and one column per frame;
    exactly one row per key and cut-off after the key's first day. With
    ``gap`` set, a measure of that name = days since the previous active day
    (computed on the full history) is available to the frames.

    ``requested`` (keys, cutoff) restricts the output to those pairs (e.g. a
    training cohort): the requested cut-offs are gathered per key (at most one
    entry per cut-off) and joined on the keys, which is the same shuffle the
    window needs; the explode then emits only requested markers.
    """
    spark = days.sparkSession
    if not cuts.valid:
        days = days.filter(F.lit(False))
    if cuts.n == 1 and requested is None:
        return _at_one_cutoff(days, keys, cuts.last, frames, day_col, gap)
    cal = cuts.calendar(spark)
    measures = sorted({f.column for f in frames})
    if requested is not None:
        req = (requested.select(*keys, "cutoff").distinct()
               .groupBy(*keys).agg(F.collect_set("cutoff").alias("_req")))
        days = days.join(req, list(keys), "inner")
    w = Window.partitionBy(*keys).orderBy(day_col)
    d = days.select(*keys, *[c for c in days.columns if c not in keys and c != day_col],
                    F.col(day_col).alias("_day"),
                    F.lag(day_col).over(w).alias("_prev"),
                    F.lead(day_col).over(w).alias("_next"))
    if gap:
        d = d.withColumn(gap, F.datediff("_day", "_prev").cast("long"))
    d = _index_of(d, "_day", "_lo", cuts, cal)
    d = _index_of(d, "_next", "_hi", cuts, cal)
    types = {f.name: f.dataType for f in d.schema.fields}
    types["_day"] = types["_prev"]

    def row(cutoff, dn, marker, fact: bool):
        fields = [cutoff.alias("cutoff"), dn.alias("_dn"), F.lit(marker).alias("_marker"),
                  F.col("_day").alias("last_day"), F.col("_prev").alias("prev_day")]
        for m in measures:
            src = "_day" if m == day_col else m
            fields.append((F.col(src) if fact else F.lit(None).cast(types[src])).alias(m))
        return F.struct(*fields)

    arr = cuts.array()
    fact = row(F.lit(None).cast("date"), F.unix_date("_day"), False, True)
    idx = (F.when(F.col("_hi") > F.col("_lo"), F.sequence(F.col("_lo") + 1, F.col("_hi")))
           .otherwise(F.array().cast("array<int>")))
    if requested is not None:
        idx = F.filter(idx, lambda i: F.array_contains(F.col("_req"), F.element_at(arr, i)))
    mk = F.transform(idx, lambda i: row(F.element_at(arr, i), F.unix_date(F.element_at(arr, i)), True, False))
    u = d.select(*keys, F.explode(F.concat(F.array(fact), mk)).alias("_r")).select(*keys, "_r.*")
    base = Window.partitionBy(*keys).orderBy("_dn")
    outs = []
    for fr in frames:
        lo = Window.unboundedPreceding if fr.days is None else -int(fr.days)
        outs.append(_FUNCS[fr.func](F.col(fr.column)).over(base.rangeBetween(lo, -1)).alias(fr.name))
    return (u.select(*keys, "cutoff", "_marker", "last_day", "prev_day", *outs)
            .filter(F.col("_marker")).drop("_marker"))
