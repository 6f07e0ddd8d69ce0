"""Labels, cohorts and analytical base tables.

C19 label: "in the loyal state ``horizon`` days later" via the time-shifted
self-join (user, ref_date + horizon) = (user, ref_date) — an equi-join, one
row per key on both sides. A row whose future snapshot does not exist yet is
labelled 0 (immature), as in the original; ``mature_only=True`` drops it.

C20 cohort: at most k rows per user in a deterministic pseudo-random order
(md5 of seed, user and date — reproducible in SQL), tagged ABT / OOT.

C21 abt / C18 fs_all: point-in-time left joins of the feature stores on
(user_id, ref_date).

C23 label_pairs: both sides of the horizon pair for one snapshot date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import Preset, preset as _preset
from loyalspark.functions.expr import as_date, hash_order
from loyalspark.operators.lifecycle import at_latest


def label(lc: DataFrame, horizon: int = 28, cfg: Preset | str = "main", positive: str | None = None,
          lo=None, hi=None, extra=None, exclude_zombie: bool = True, mature_only: bool = False) -> DataFrame:
    """(ref_date, user_id, state, future_state, label).

    ``lo <= ref_date <= hi`` (optionally OR ``ref_date = extra``) restricts the
    base rows; ``exclude_zombie`` drops rows currently in the zombie state.
    """
    cfg = _preset(cfg)
    pos = positive or cfg.lifecycle.loyal
    base = lc.select("ref_date", "user_id", "state")
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col("ref_date") >= F.lit(as_date(lo)))
    if hi is not None:
        cond = cond & (F.col("ref_date") <= F.lit(as_date(hi)))
    if extra is not None:
        cond = cond | (F.col("ref_date") == F.lit(as_date(extra)))
    t1 = base.filter(cond)
    if exclude_zombie:
        t1 = t1.filter(F.col("state") != cfg.lifecycle.zombie)
    t2 = base.select("user_id", F.date_sub("ref_date", horizon).alias("ref_date"),
                     F.col("state").alias("future_state"))
    how = "inner" if mature_only else "left"
    return (t1.join(t2, ["user_id", "ref_date"], how)
            .select("ref_date", "user_id", "state", "future_state",
                    F.when(F.col("future_state") == pos, 1).otherwise(0).cast("long").alias("label")))


def sample_per_user(df: DataFrame, k: int = 2, seed: int = 42, key: str = "user_id",
                    date_col: str = "ref_date") -> DataFrame:
    """Keep at most ``k`` rows per user in md5 order. The
    ``row_number() <= k`` filter is planned as a window group limit (top-k
    computed before the full sort)."""
    w = Window.partitionBy(key).orderBy(hash_order(seed, key, date_col), date_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k).drop("_rn")


def cohort(labels: DataFrame, k: int = 2, seed: int = 42, train=None, oot=None) -> DataFrame:
    """C20 + U2: sampled training cohort (``tag='ABT'``) plus the sampled
    out-of-time cohort (``tag='OOT'``). ``train`` / ``oot`` are (lo, hi)
    inclusive date ranges; each is sampled independently."""
    def part(rng, tag):
        d = labels
        if rng is not None:
            d = d.filter(F.col("ref_date").between(F.lit(as_date(rng[0])), F.lit(as_date(rng[1]))))
        return (sample_per_user(d, k, seed)
                .select("ref_date", "user_id", "label", F.lit(tag).alias("tag")))
    out = part(train, "ABT")
    if oot is not None:
        out = out.unionByName(part(oot, "OOT"))
    return out


def point_in_time_join(base: DataFrame, stores: list, keys=("user_id", "ref_date"),
                       require: list | None = None) -> DataFrame:
    """Left-join each feature store on (user_id, ref_date); stores
    listed in ``require`` (by index) must match (inner join). Store columns
    other than the keys are prefixed only when they collide."""
    keys = list(keys)
    out = base
    seen = set(base.columns)
    for i, st in enumerate(stores):
        cols = [c for c in st.columns if c not in keys]
        ren = [F.col(c).alias(c if c not in seen else f"s{i}_{c}") for c in cols]
        seen.update(c if c not in seen else f"s{i}_{c}" for c in cols)
        how = "inner" if require and i in require else "left"
        out = out.join(st.select(*keys, *ren), keys, how)
    return out


def abt(cohort_df: DataFrame, fs_tx: DataFrame, fs_lc: DataFrame, fs_ed: DataFrame | None = None,
        require_lc: bool = False) -> DataFrame:
    """Cohort + transactional, life-cycle and education features at
    each row's own ref_date (never a later snapshot)."""
    stores = [fs_tx.drop("cutoff"), fs_lc.drop("cutoff")]
    if fs_ed is not None:
        stores.append(fs_ed.drop("cutoff"))
    return point_in_time_join(cohort_df, stores, require=[1] if require_lc else None)


def fs_all(fs_tx: DataFrame, fs_lc: DataFrame, fs_ed: DataFrame | None, ref_date=None) -> DataFrame:
    """Scoring table = all features at the latest transactional date."""
    stores = [s.drop("cutoff") for s in (fs_lc, fs_ed) if s is not None]
    if ref_date is None:
        return point_in_time_join(at_latest(fs_tx).drop("cutoff"), stores)
    at = F.col("ref_date") == F.lit(as_date(ref_date))
    return point_in_time_join(fs_tx.filter(at).drop("cutoff"), [s.filter(at) for s in stores])


def label_pairs(lc: DataFrame, ref_date, state: str | None = None, horizon: int = 28,
                month_start_only: bool = True, limit: int | None = None) -> DataFrame:
    """Both sides of the horizon pair at one snapshot date (optionally
    only when it is a month start, and only users in ``state``)."""
    d = as_date(ref_date)
    t1 = lc.filter(F.col("ref_date") == F.lit(d))
    if month_start_only:
        t1 = t1.filter(F.dayofmonth("ref_date") == 1)
    if state is not None:
        t1 = t1.filter(F.col("state") == state)
    t2 = lc.filter(F.col("ref_date") == F.lit(d + _dt.timedelta(days=horizon)))
    out = t1.alias("a").join(t2.alias("b"), F.col("a.user_id") == F.col("b.user_id"), "left").select(
        F.col("a.ref_date").alias("t1_ref_date"), F.col("a.user_id").alias("t1_user_id"),
        F.col("a.state").alias("t1_state"), F.col("b.ref_date").alias("t2_ref_date"),
        F.col("b.state").alias("t2_state"))
    return out.orderBy("t1_user_id").limit(limit) if limit else out
