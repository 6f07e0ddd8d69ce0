"""C17: life-cycle feature store, read from the ``life_cycle`` snapshot table.

Per user and cut-off c (offset o: current snapshot at c - o; the step-by-step
variant uses o = 0, i.e. it reads the snapshot stamped on the cut-off day
itself, one day of look-ahead; the compact variant uses o = 1):

* current state and frequency, and the state of the snapshot at c - 29;
* share of all snapshots before c spent in each of the seven states;
* frequency divided by the mean frequency of the user's current state;
* (step-by-step variant) own mean frequency over the latest 7 snapshot rows
  and over all rows within the 14 calendar days ending at the current
  snapshot, and the two ratios.

Many cut-offs are one job: state counts are ``rangeBetween(unbounded, -1)``
frames, the 14-day mean a ``rangeBetween(-13, 0)`` frame and the "latest 7
rows" mean uses six ``lag`` columns, all over the user's snapshot rows.
"""

from __future__ import annotations

import datetime as _dt
import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import Preset, preset as _preset
from loyalspark.plans.asof import Cutoffs


def pct_column(label: str) -> str:
    return "pct_" + re.sub(r"[^0-9a-z]+", "_", label.lower()).strip("_")


def fs_life_cycle(lc: DataFrame, cutoffs, cfg: Preset | str = "main",
                  keys: DataFrame | None = None) -> DataFrame:
    """C17 for one or many cut-offs in one window pass.

    ``lc`` = segmentation snapshots (ref_date, user_id, state, frequency, ...).
    Over each user's snapshot rows ordered by date, every row r gets: the
    state of the snapshot 29 - o days earlier (a one-day range frame), the
    state counts of all snapshots before r + o (frame ``(unbounded, o - 1)``),
    the 14-day mean frequency (frame ``(-13, 0)``) and the latest-7-rows mean
    (six lags). The rows that are current for a cut-off (``ref_date + o`` in
    the list) are kept; the per-state mean frequency (cut-offs x 7 rows) is
    broadcast back.
    """
    cfg = _preset(cfg)
    fc = cfg.features
    labels = cfg.lifecycle.labels
    cuts = Cutoffs(cutoffs)
    off = fc.lc_current_offset
    dn = F.unix_date("ref_date")
    # later snapshots play no part: the filter reaches the date partitions
    last = cuts.last - _dt.timedelta(days=min(off, 1))
    base = lc.filter(F.col("ref_date") <= F.lit(last)).select("ref_date", "user_id", "state", "frequency")
    w = Window.partitionBy("user_id").orderBy(dn)
    d28 = 29 - off
    cols = [
        "ref_date", "user_id", "state", "frequency",
        F.first("state").over(w.rangeBetween(-d28, -d28)).alias("state_d28"),
        F.count(F.lit(1)).over(w.rangeBetween(Window.unboundedPreceding, off - 1)).alias("_n"),
        *[F.sum(F.when(F.col("state") == s, 1).otherwise(0))
          .over(w.rangeBetween(Window.unboundedPreceding, off - 1)).alias(f"_c{i}")
          for i, s in enumerate(labels)],
    ]
    if fc.moving_average:
        wl = Window.partitionBy("user_id").orderBy("ref_date")
        cols += [*[F.lag("frequency", k).over(wl).alias(f"_f{k}") for k in range(1, 7)],
                 *[F.lag(dn, k).over(wl).alias(f"_d{k}") for k in range(1, 7)],
                 F.avg("frequency").over(w.rangeBetween(-13, 0)).alias("avg_freq_d14")]
    wanted = [c - _dt.timedelta(days=off) for c in cuts.dates] if cuts.valid else []
    cur = base.select(*cols).filter(F.col("ref_date").isin(wanted)).withColumn("cutoff", F.date_add("ref_date", off))
    if fc.moving_average:
        rowcur = F.unix_date("ref_date")
        terms = [(F.col("frequency"), F.lit(True))] + [
            (F.col(f"_f{k}"), F.col(f"_d{k}") >= rowcur - 13) for k in range(1, 7)]
        s7 = sum((F.when(ok & v.isNotNull(), v).otherwise(0) for v, ok in terms), F.lit(0))
        n7 = sum((F.when(ok & v.isNotNull(), 1).otherwise(0) for v, ok in terms), F.lit(0))
        cur = cur.withColumn("avg_freq_d7", F.try_divide(s7.cast("double"), n7.cast("double")))
    return finish(cur, cfg, keys)


def finish(cur: DataFrame, cfg: Preset, keys: DataFrame | None = None) -> DataFrame:
    """The store's columns from one row per user and cut-off: state, frequency,
    state_d28, the number of snapshots before the cut-off (``_n``) and of those
    in each state (``_c0`` ...), and the own mean frequencies. The per-state
    mean is over all users, also where ``keys`` asks for few."""
    fc, labels = cfg.features, cfg.lifecycle.labels
    cur = cur.withColumnRenamed("state", "state_current")
    group = cur.groupBy("cutoff", "state_current").agg(F.avg("frequency").alias("avg_freq_group"))
    if keys is not None:
        cur = cur.join(keys.select("user_id", "cutoff").distinct(), ["user_id", "cutoff"], "left_semi")
    # cut-offs x 7 states by construction
    out = cur.join(F.broadcast(group), ["cutoff", "state_current"], "left")

    def over(x, y):
        return F.try_divide(x.cast("double"), y.cast("double"))

    f = F.col("frequency")
    shares = [over(F.col(f"_c{i}"), F.when(F.col("_n") > 0, F.col("_n"))).alias(pct_column(s)) for i, s in enumerate(labels)]
    sel = [F.date_sub("cutoff", 1).alias("ref_date"), "cutoff", "user_id", "state_current", "frequency",
           "state_d28", *shares, "avg_freq_group", over(f, F.col("avg_freq_group")).alias("ratio_freq_group")]
    if fc.moving_average:
        sel += ["avg_freq_d7", "avg_freq_d14", over(f, F.col("avg_freq_d7")).alias("ratio_freq_d7"),
                over(f, F.col("avg_freq_d14")).alias("ratio_freq_d14")]
    return out.select(*sel)
