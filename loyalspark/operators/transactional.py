"""Transactional feature store (55 features per user and cut-off).

Plan (one job for any number of cut-offs):

1. ``tx`` before the last cut-off -> one row per (user, day) with the number
   of transactions, net / positive / negative points, day-part counts
   and first / last timestamp (partial aggregation before the shuffle).
2. Line items of those transactions are counted per transaction (joined with
   the products that match a name or category), so the transaction join is 1:1 instead
   of a fan-out, then summed per (user, day).
3. ``lag(day)`` per user gives the gap to the previous active day on the full
   history (the D28 mean gap uses that history, as the original does).
4. Markers (user, cutoff) for every cut-off after the user's first day; all
   D7 / D14 / D28 / D56 / lifetime measures are ``rangeBetween`` frames of one
   window pass over the user's day rows.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import DAYPART_AFTERNOON, DAYPART_MORNING, FeatureCfg, Preset, preset as _preset
from loyalspark.functions.expr import daypart, fractional_days, hours_between, ratio_or_null, safe_ratio, utc
from loyalspark.plans.asof import Cutoffs, Frame, asof_rollup


def slug(value: str) -> str:
    return re.sub(r"[^0-9a-z]+", "_", value.lower()).strip("_")


def _wname(w) -> str:
    return "life" if w is None else f"d{w}"


def product_flags(items: DataFrame, products: DataFrame, fcfg: FeatureCfg, tx: DataFrame | None = None) -> DataFrame:
    """Per transaction (only those of ``tx`` when given): number of line items
    and matches per named product / category. Only products that match some
    name or category take part in the join."""
    if tx is not None:
        items = items.join(tx.select("tx_id"), "tx_id", "left_semi")
    flags = [(f"cnt_cat_{slug(c)}", F.col("category") == c) for c in fcfg.categories]
    flags += [(f"cnt_prod_{slug(n)}", F.col("name") == n) for n in fcfg.products]
    prod = products.filter(reduce(or_, (cond for _, cond in flags), F.lit(False))).select(
        "product_id", *[F.when(cond, 1).otherwise(0).alias(nm) for nm, cond in flags])
    per_item = items.select("tx_id", "product_id").join(prod, "product_id", "left")
    return per_item.groupBy("tx_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        *[F.sum(F.coalesce(F.col(nm), F.lit(0))).alias(nm) for nm, _ in flags])


def user_days(tx: DataFrame, fcfg: FeatureCfg, per_tx: DataFrame | None = None) -> DataFrame:
    """One row per (user_id, day): transactions, net / positive / negative
    points, day-part counts, first / last timestamp, and with ``per_tx`` the
    fanned-out row count and product / category matches (a transaction without
    items counts as one row). ``tx_id`` is unique, so transactions are rows
    and the day's sums combine before the only shuffle."""
    p = F.col("points")
    dp = daypart(F.hour("ts"), DAYPART_MORNING, DAYPART_AFTERNOON)
    neg = F.when(p < 0, p).otherwise(0) if fcfg.signed_negative_points \
        else F.when(p < 0, F.abs(p)).otherwise(0)
    t, extra = tx, []
    if per_tx is not None:
        t = t.join(per_tx, "tx_id", "left")
        extra = [F.sum(F.greatest(F.coalesce(F.col("n_items"), F.lit(0)), F.lit(1))).alias("fan_rows")]
        extra += [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in per_tx.columns if c.startswith("cnt_")]
    return (t.groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.count("tx_id").alias("n_tx"),
                 F.sum(p).alias("pts_net"),
                 F.sum(F.when(p > 0, p).otherwise(0)).alias("pts_pos"),
                 F.sum(neg).alias("pts_neg"),
                 F.count(F.when(dp["morning"], F.col("tx_id"))).alias("n_morning"),
                 F.count(F.when(dp["afternoon"], F.col("tx_id"))).alias("n_afternoon"),
                 F.count(F.when(dp["night"], F.col("tx_id"))).alias("n_night"),
                 F.min("ts").alias("first_ts"),
                 F.max("ts").alias("last_ts"),
                 *extra)
            .withColumn("hours", hours_between("first_ts", "last_ts"))
            .withColumn("is_day", F.lit(1)).withColumn("n_rows", F.col("n_tx")))


def fs_transactional(tx: DataFrame, cutoffs, cfg: Preset | str = "main",
                     items: DataFrame | None = None, products: DataFrame | None = None,
                     keys: DataFrame | None = None, unique_tx: bool = True) -> DataFrame:
    """C15 for one or many cut-offs. ``tx_id`` identifies a transaction; with
    ``unique_tx=False`` repeated rows of one are dropped first. Without ``items``/``products`` the
    product-share block is omitted; ``keys`` (user_id, cutoff) restricts the
    output to those pairs (point-in-time features of a cohort)."""
    cfg = _preset(cfg)
    fc = cfg.features
    cuts = Cutoffs(cutoffs)
    with_products = items is not None and products is not None
    tx = utc(tx).filter(F.col("ts") < F.lit(cuts.last))
    if not unique_tx:
        tx = tx.dropDuplicates(["tx_id"])
    per_tx = product_flags(items, products, fc, tx) if with_products else None
    ud = user_days(tx, fc, per_tx)
    share_cols = [c for c in ud.columns if c.startswith("cnt_")]

    wins = [None] + list(fc.windows)
    frames = []
    for win in wins:
        s = _wname(win)
        frames += [Frame(f"active_days_{s}", "sum", "is_day", win),
                   Frame(f"tx_{s}", "sum", "n_tx", win),
                   Frame(f"pts_net_{s}", "sum", "pts_net", win),
                   Frame(f"pts_pos_{s}", "sum", "pts_pos", win),
                   Frame(f"pts_neg_{s}", "sum", "pts_neg", win),
                   Frame(f"hours_{s}", "sum", "hours", win)]
    frames += [Frame("rows_life", "sum", "n_rows", None),
               Frame("morning_life", "sum", "n_morning", None),
               Frame("afternoon_life", "sum", "n_afternoon", None),
               Frame("night_life", "sum", "n_night", None),
               Frame("first_day_life", "min", "day", None),
               Frame("first_ts_life", "min", "first_ts", None),
               Frame("gap_sum_life", "sum", "gap", None),
               Frame("gap_n_life", "count", "gap", None),
               Frame("gap_sum_d28", "sum", "gap", 28),
               Frame("gap_n_d28", "count", "gap", 28)]
    if with_products:
        frames += [Frame("fan_rows_life", "sum", "fan_rows", None)]
        frames += [Frame(f"{c}_life", "sum", c, None) for c in share_cols]
    agg = asof_rollup(ud, ["user_id"], cuts, frames, gap="gap", requested=keys)

    c = F.col("cutoff")
    if fc.fractional_age:
        age = fractional_days("first_ts_life", F.date_sub(c, 1).cast("timestamp_ntz"))
    else:
        age = F.datediff(c, F.col("first_day_life")).cast("double")
    out = [F.date_sub(c, 1).alias("ref_date"), c.alias("cutoff"), F.col("user_id"), age.alias("age_days")]
    z = lambda n: F.coalesce(F.col(n), F.lit(0)).cast("long")
    for base in ("active_days", "tx", "pts_net", "pts_pos", "pts_neg"):
        out += [z(f"{base}_{_wname(win)}").alias(f"{base}_{_wname(win)}") for win in wins]
    tx_den = "tx_life" if fc.daypart_denominator == "distinct_tx" else "rows_life"
    out += [z("morning_life").alias("tx_morning"), z("afternoon_life").alias("tx_afternoon"),
            z("night_life").alias("tx_night"),
            ratio_or_null("morning_life", tx_den).alias("pct_morning"),
            ratio_or_null("afternoon_life", tx_den).alias("pct_afternoon"),
            ratio_or_null("night_life", tx_den).alias("pct_night")]
    out += [safe_ratio(z(f"tx_{_wname(win)}"), z(f"active_days_{_wname(win)}")).alias(f"tx_per_day_{_wname(win)}")
            for win in wins]
    out += [(z("active_days_d28").cast("double") / F.lit(28.0)).alias("pct_active_mau")]
    out += [F.coalesce(F.col(f"hours_{_wname(win)}"), F.lit(0.0)).alias(f"hours_{_wname(win)}") for win in wins]
    out += [ratio_or_null("gap_sum_life", "gap_n_life").alias("gap_mean_life"),
            ratio_or_null("gap_sum_d28", "gap_n_d28").alias("gap_mean_d28")]
    if with_products:
        den = "tx_life" if fc.product_denominator == "distinct_tx" else "fan_rows_life"
        out += [ratio_or_null(F.coalesce(F.col(f"{sc}_life"), F.lit(0)), den).alias(sc.replace("cnt_", "share_", 1))
                for sc in share_cols]
    # stage: pre-compute the life rows/tx columns the ratios refer to
    return agg.select(*out)
