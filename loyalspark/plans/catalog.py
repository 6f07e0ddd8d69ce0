"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each entry runs one operator over the whole driver tables (through the
fixture views of ``sources.fixtures``). ``oracle_sql.build()`` holds the
matching DuckDB SQL. Doubles are rounded to 6 places for the comparison.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from loyalspark.config import MAIN, REFS
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import metrics as mt
from loyalspark.session import bound_tasks
from loyalspark.sources import calendar as cal
from loyalspark.sources import fixtures as fx
from loyalspark.sources.calendar import spine_dates
from loyalspark.sources.store import bytes_of

D = _dt.date


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns for a stable value hash."""
    cols = [F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
            for f in df.schema.fields]
    return df.select(*cols)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        def query(spark, sf_dir):
            bound_tasks(spark, bytes_of(spark, fx.paths(sf_dir)))
            return finish(fn(spark, sf_dir))
        QUERIES[name] = query
        QUERIES[name].__doc__ = fn.__doc__
        QUERIES[name].__name__ = name
        return fn
    return deco


# ------------------------------------------------------------------ metrics

@register("dau")
def _dau(spark, d):
    return mt.dau(fx.tx_events(spark, d))


@register("dau_orders")
def _dau_orders(spark, d):
    return mt.dau(fx.tx_orders(spark, d))


@register("dau_monthly_mean")
def _dau_monthly_mean(spark, d):
    return mt.monthly_mean(mt.dau(fx.tx_events(spark, d)))


@register("dau_smoothed")
def _dau_smoothed(spark, d):
    return mt.monthly_smoothing(mt.dau(fx.tx_events(spark, d)))


@register("dau_histogram")
def _dau_histogram(spark, d):
    daily = mt.dau(fx.tx_events(spark, d)).withColumn("dau", F.col("dau").cast("double"))
    return mt.histogram(daily, "dau", bins=30)


@register("dau_histogram_by_month")
def _dau_histogram_by_month(spark, d):
    daily = (mt.dau(fx.tx_orders(spark, d)).withColumn("dau", F.col("dau").cast("double"))
             .withColumn("year", F.year("day").cast("long"))
             .withColumn("month", F.month("day").cast("long")))
    return mt.histogram(daily, "dau", bins="sturges", by=["year", "month"])


@register("mau_rolling_28")
def _mau(spark, d):
    return mt.mau(fx.tx_events_thin(spark, d), 28)


@register("mau_rolling_28_events")
def _mau_ev(spark, d):
    return mt.mau(fx.tx_events(spark, d), 28)


@register("mau_rolling_28_orders")
def _mau_ord(spark, d):
    return mt.mau(fx.tx_orders(spark, d), 28)


@register("activity_bounds")
def _bounds(spark, d):
    return cal.activity_bounds(fx.tx_orders(spark, d))


@register("mau_smoothed")
def _mau_smoothed(spark, d):
    return mt.monthly_smoothing(mt.mau(fx.tx_events(spark, d), 28), "ref_day", "mau")


@register("date_spine_day")
def _spine_day(spark, d):
    return cal.spine_between(cal.activity_bounds(fx.tx_orders(spark, d)))


@register("date_spine_month")
def _spine_month(spark, d):
    return cal.spine_between(cal.activity_bounds(fx.tx_orders(spark, d)), "month")


@register("date_spine_month_padded")
def _spine_month_padded(spark, d):
    return cal.spine_between(cal.activity_bounds(fx.tx_orders(spark, d)), "month", pad=True)


@register("user_history")
def _user_history(spark, d):
    return mt.user_history(fx.tx_events(spark, d), 7)


# ---------------------------------------------------------------- lifecycle

EV_CUT = D(2024, 1, 31)
ORD_CUT = D(2000, 1, 1)
DAILY_CUTS = spine_dates(D(2024, 1, 2), D(2024, 1, 31))
MONTHLY_CUTS = spine_dates(D(1998, 1, 1), D(2001, 8, 1), "month")


@register("lifecycle_snapshot_main")
def _lc_main(spark, d):
    return lc.life_cycle(fx.tx_events_thin(spark, d), EV_CUT, MAIN)


@register("lifecycle_snapshot_refs")
def _lc_refs(spark, d):
    return lc.life_cycle(fx.tx_events_thin(spark, d), EV_CUT, REFS)


@register("lifecycle_snapshot_orders")
def _lc_orders(spark, d):
    return lc.life_cycle(fx.tx_orders(spark, d), ORD_CUT, MAIN)


@register("third_latest_day")
def _third_latest(spark, d):
    return lc.nth_latest(fx.tx_orders(spark, d), ORD_CUT, 3)


@register("frequency_value")
def _fv(spark, d):
    return lc.frequency_value(fx.tx_events_thin(spark, d), EV_CUT)


@register("frequency_value_orders")
def _fv_orders(spark, d):
    return lc.frequency_value(fx.tx_orders(spark, d), ORD_CUT)


@register("frequency_value_trimmed")
def _fv_trimmed(spark, d):
    return lc.trim(lc.frequency_value(fx.tx_events(spark, d), EV_CUT), "points_pos", 3000)


@register("rfv_cluster_main")
def _rfv_main(spark, d):
    return lc.rfv_cluster(lc.frequency_value(fx.tx_events_thin(spark, d), EV_CUT), MAIN)


@register("rfv_cluster_refs")
def _rfv_refs(spark, d):
    return lc.rfv_cluster(lc.frequency_value(fx.tx_events_thin(spark, d), EV_CUT), REFS)


@register("rfv_cluster_events")
def _rfv_events(spark, d):
    return lc.rfv_cluster(lc.frequency_value(fx.tx_events(spark, d), EV_CUT), MAIN)


@register("cluster_sizes")
def _cluster_sizes(spark, d):
    return lc.cluster_sizes(lc.rfv_cluster(lc.frequency_value(fx.tx_events_thin(spark, d), EV_CUT), MAIN))


@register("segmentation_snapshot")
def _seg(spark, d):
    return lc.segmentation_snapshot(fx.tx_orders(spark, d), ORD_CUT, MAIN)


@register("segmentation_complete_rows")
def _seg_complete(spark, d):
    return cal.drop_incomplete(_seg(spark, d), ["frequency", "prev_age"])


@register("segmentation_fixed_columns")
def _seg_fixed(spark, d):
    return cal.select_fixed(_seg(spark, d), ["user_id", "state", "not_there", "frequency"])


@register("segmentation_snapshot_refs")
def _seg_refs(spark, d):
    return lc.segmentation_snapshot(fx.tx_events_thin(spark, d), EV_CUT, REFS)


@register("segmentation_backfill_daily")
def _seg_daily(spark, d):
    return lc.segmentation_backfill(fx.tx_events_thin(spark, d), DAILY_CUTS, MAIN)


@register("segmentation_backfill_monthly")
def _seg_monthly(spark, d):
    return lc.segmentation_backfill(fx.tx_orders(spark, d), MONTHLY_CUTS, MAIN)


@register("lifecycle_report_latest")
def _report(spark, d):
    snapshots = lc.segmentation_backfill(fx.tx_orders(spark, d), MONTHLY_CUTS, MAIN)
    return lc.life_cycle_report(snapshots, MONTHLY_CUTS[-1] - _dt.timedelta(days=1))


@register("lifecycle_matrix")
def _matrix(spark, d):
    return lc.life_cycle_matrix(lc.segmentation_backfill(fx.tx_orders(spark, d), MONTHLY_CUTS, MAIN))


@register("lifecycle_matrix_pct")
def _matrix_pct(spark, d):
    return lc.life_cycle_matrix(lc.segmentation_backfill(fx.tx_orders(spark, d), MONTHLY_CUTS, MAIN),
                                normalise=True)


# ------------------------------------------------------- transactional store

from loyalspark.operators import transactional as tr  # noqa: E402

ORD_FEATURES = MAIN.with_features(products=fx.ORD_PRODUCTS, categories=fx.ORD_CATEGORIES)
ORD_FEATURES_REFS = REFS.with_features(products=fx.ORD_PRODUCTS, categories=fx.ORD_CATEGORIES)


def _fs_tx_orders(spark, d, cuts, cfg):
    return tr.fs_transactional(fx.tx_orders(spark, d), cuts, cfg,
                               items=fx.tx_items(spark, d), products=fx.products(spark, d))


@register("fs_transactional_main")
def _fs_tx_main(spark, d):
    return _fs_tx_orders(spark, d, [ORD_CUT], ORD_FEATURES)


@register("fs_transactional_refs")
def _fs_tx_refs(spark, d):
    return _fs_tx_orders(spark, d, [ORD_CUT], ORD_FEATURES_REFS)


@register("fs_transactional_events")
def _fs_tx_events(spark, d):
    return tr.fs_transactional(fx.tx_events(spark, d), [EV_CUT], MAIN)


@register("fs_transactional_backfill")
def _fs_tx_backfill(spark, d):
    return tr.fs_transactional(fx.tx_events_thin(spark, d), spine_dates(D(2024, 1, 5), D(2024, 1, 31)), MAIN)


@register("fs_transactional_monthly")
def _fs_tx_monthly(spark, d):
    return _fs_tx_orders(spark, d, spine_dates(D(1999, 1, 1), D(2000, 12, 1), "month"), ORD_FEATURES_REFS)


# ------------------------------------------------------------ education store

from loyalspark.operators import education as ed  # noqa: E402


def _edu(spark, d, cuts, cfg, keys=None):
    return ed.fs_education(fx.edu_done(spark, d), fx.edu_register(spark, d), fx.edu_rewards(spark, d),
                           fx.edu_skills(spark, d), fx.edu_bridge(spark, d), cuts, fx.edu_slugs(), cfg,
                           keys=keys)


@register("course_progress")
def _course_progress(spark, d):
    return ed.course_progress(fx.edu_done(spark, d), fx.edu_register(spark, d), [ORD_CUT])


@register("course_pivot")
def _course_pivot(spark, d):
    prog = ed.course_progress(fx.edu_done(spark, d), fx.edu_register(spark, d), [ORD_CUT])
    return ed.course_pivot(prog, fx.edu_slugs())


@register("course_last_activity")
def _course_last_activity(spark, d):
    prog = ed.course_progress(fx.edu_done(spark, d), fx.edu_register(spark, d), [ORD_CUT])
    keys = prog.select("user", "cutoff").distinct()
    rec = ed.last_activity([fx.edu_skills(spark, d), fx.edu_rewards(spark, d), fx.edu_done(spark, d)],
                           [ORD_CUT])
    return keys.join(rec, ["user", "cutoff"], "left")


@register("fs_education")
def _fs_education(spark, d):
    return _edu(spark, d, [ORD_CUT], MAIN)


@register("fs_education_refs")
def _fs_education_refs(spark, d):
    return _edu(spark, d, [ORD_CUT], REFS)


@register("fs_education_monthly")
def _fs_education_monthly(spark, d):
    return _edu(spark, d, spine_dates(D(1999, 1, 1), D(2000, 12, 1), "month"), MAIN)


# ------------------------------------------------------- life-cycle features

from loyalspark.operators import lifecycle_features as lf  # noqa: E402
from loyalspark.operators import state_history as sh  # noqa: E402
from loyalspark.sources.store import folder_state, stage  # noqa: E402

LC_DAILY_CUTS = spine_dates(D(2024, 1, 1), D(2024, 1, 31))


def lc_daily(spark, d, cfg=MAIN):
    """LC_DAILY: segmentation backfill of EV_THIN for every day of January 2024."""
    return lc.segmentation_backfill(fx.tx_events_thin(spark, d), LC_DAILY_CUTS, cfg)


@register("fs_life_cycle")
def _fs_lc(spark, d):
    return lf.fs_life_cycle(lc_daily(spark, d), [D(2024, 1, 30)], MAIN)


@register("fs_life_cycle_refs")
def _fs_lc_refs(spark, d):
    return lf.fs_life_cycle(lc_daily(spark, d, REFS), [D(2024, 1, 31)], REFS)


@register("fs_life_cycle_backfill")
def _fs_lc_backfill(spark, d):
    return lf.fs_life_cycle(lc_daily(spark, d), spine_dates(D(2024, 1, 8), D(2024, 1, 30)), MAIN)


@register("fs_life_cycle_daily")
def _fs_lc_daily(spark, d):
    return sh.fs_life_cycle_daily(fx.tx_events_thin(spark, d), spine_dates(D(2024, 1, 8), D(2024, 1, 30)), D(2024, 1, 1), MAIN)


@register("fs_life_cycle_incremental")
def _fs_lc_incremental(spark, d):
    """Three days on from the first state table, each from the one before."""
    snapshots = stage(lc_daily(spark, d), "lc_daily")
    states = stage(sh.begin(snapshots, D(2024, 1, 27), MAIN), "lc_states")
    for day in spine_dates(D(2024, 1, 28), D(2024, 1, 30)):
        states = stage(sh.advance(states, snapshots.filter(F.col("ref_date") == F.lit(day)), day, MAIN), "lc_states")
    return sh.features_of(states, MAIN)


# -------------------------------------------------------- labels, cohort, ABT

from loyalspark.operators import target as tg  # noqa: E402

COHORT_TRAIN = (D(2024, 1, 4), D(2024, 1, 26))
COHORT_OOT = (D(2024, 1, 27), D(2024, 1, 30))
ABT_CUTS = spine_dates(D(2024, 1, 5), D(2024, 1, 31))
ABT_PRESET = MAIN.with_features(lc_current_offset=1)
# daily snapshots over the whole order history up to the cut-off
LC_ORD_SINCE = D(1995, 1, 7)


def labels_7d(spark, d):
    return tg.label(lc_daily(spark, d), 7, MAIN, lo=D(2024, 1, 4), hi=D(2024, 1, 30))


def cohort_7d(spark, d):
    return tg.cohort(labels_7d(spark, d), 2, 42, train=COHORT_TRAIN, oot=COHORT_OOT)


def edu_by_user(fs_ed):
    """Education store keyed by the loyalty user id (bridge id 'C<n>')."""
    return (fs_ed.withColumn("user_id", F.expr("cast(substring(customer_id, 2) as bigint)"))
            .drop("customer_id", "user"))


@register("label_7d")
def _label_7d(spark, d):
    return labels_7d(spark, d)


@register("label_7d_mature")
def _label_7d_mature(spark, d):
    return tg.label(lc_daily(spark, d), 7, MAIN, lo=D(2024, 1, 4), hi=D(2024, 1, 30), mature_only=True)


@register("label_7d_extra_date")
def _label_7d_extra(spark, d):
    return tg.label(lc_daily(spark, d), 7, MAIN, lo=D(2024, 1, 4), hi=D(2024, 1, 10), extra=D(2024, 1, 20))


@register("label_28d_orders")
def _label_28d_orders(spark, d):
    cuts = [D(1998, 1, 5) + _dt.timedelta(days=28 * i) for i in range(0, 26)]
    return tg.label(lc.segmentation_backfill(fx.tx_orders(spark, d), cuts, MAIN), 28, MAIN)


@register("label_pairs")
def _label_pairs(spark, d):
    return tg.label_pairs(lc_daily(spark, d), D(2024, 1, 1), horizon=7)


@register("label_pairs_top")
def _label_pairs_top(spark, d):
    return tg.label_pairs(lc_daily(spark, d), D(2024, 1, 1), horizon=7, limit=10)


@register("cohort_sample")
def _cohort(spark, d):
    return cohort_7d(spark, d)


def abt_frame(spark, d):
    """Cohort + the three feature stores at every cut-off, joined point in
    time: the plain form, which the tests hold the keyed one against."""
    fs_tx = tr.fs_transactional(fx.tx_events_thin(spark, d), ABT_CUTS, ABT_PRESET)
    fs_lc = lf.fs_life_cycle(lc_daily(spark, d), ABT_CUTS, ABT_PRESET)
    fs_ed = edu_by_user(_edu(spark, d, ABT_CUTS, ABT_PRESET))
    return tg.abt(cohort_7d(spark, d), fs_tx, fs_lc, fs_ed)


def abt_frame_keyed(spark, d, require_lc=False):
    """The same ABT with snapshots and cohort staged once and features
    computed only for the cohort's (user, cutoff) pairs."""
    snapshots = stage(lc_daily(spark, d), "lc_daily")
    lab = tg.label(snapshots, 7, MAIN, lo=D(2024, 1, 4), hi=D(2024, 1, 30))
    coh = stage(tg.cohort(lab, 2, 42, train=COHORT_TRAIN, oot=COHORT_OOT), "cohort")
    keys = coh.select("user_id", F.date_add("ref_date", 1).alias("cutoff"))
    fs_tx = tr.fs_transactional(fx.tx_events_thin(spark, d), ABT_CUTS, ABT_PRESET, keys=keys)
    fs_lc = lf.fs_life_cycle(snapshots, ABT_CUTS, ABT_PRESET, keys=keys)
    ed_keys = keys.select(F.col("user_id").alias("user"), "cutoff")
    fs_ed = edu_by_user(_edu(spark, d, ABT_CUTS, ABT_PRESET, keys=ed_keys))
    return tg.abt(coh, fs_tx, fs_lc, fs_ed, require_lc=require_lc)


_STAGED: dict[tuple, object] = {}


def staged_abt(spark, d):
    """The ABT as one table that all its consumers read: staged by the first
    of them in an application, per input folder and state of its files."""
    key = (spark.sparkContext.applicationId, d, folder_state(spark, d))
    if key not in _STAGED:
        _STAGED[key] = stage(abt_frame_keyed(spark, d), "abt")
    return _STAGED[key]


@register("abt")
def _abt(spark, d):
    return abt_frame_keyed(spark, d)


@register("abt_with_life_cycle")
def _abt_lc(spark, d):
    return abt_frame_keyed(spark, d, require_lc=True)


@register("fs_all")
def _fs_all(spark, d):
    fs_tx = _fs_tx_orders(spark, d, [ORD_CUT], ORD_FEATURES_REFS)
    fs_lc = sh.fs_life_cycle_daily(fx.tx_orders(spark, d), [ORD_CUT], LC_ORD_SINCE, REFS)
    fs_ed = edu_by_user(_edu(spark, d, [ORD_CUT], REFS))
    return tg.fs_all(fs_tx, fs_lc, fs_ed)


# --------------------------------------------------------- profiling and ML

from loyalspark.ml import assess as ma  # noqa: E402
from loyalspark.ml import model as mm  # noqa: E402
from loyalspark.ml import prepare as mp  # noqa: E402
from loyalspark.ml import segment as ms  # noqa: E402
from loyalspark.ml.train import pipeline_for  # noqa: E402
from loyalspark.operators import profile as pf  # noqa: E402
from loyalspark.config import LIFECYCLE_LABELS_MAIN, NON_USER_MAIN  # noqa: E402

PROFILE_COLS = ["frequency", "active_days_d28", "tx_life", "pts_pos_d28", "hours_d7", "gap_mean_life",
                "pct_02_fiel", "avg_freq_group", "days_since_activity", "n_in_progress"]
IMPUTE_COLS = ["state_current", "state_d28", "frequency", "gap_mean_life", "days_since_activity",
               "hours_d7", "share_brand_1", "pct_02_fiel", "avg_freq_group", "tx_per_day_d28"]
STATE_VOCAB = list(LIFECYCLE_LABELS_MAIN) + [NON_USER_MAIN]


@register("feature_null_rate")
def _null_rate(spark, d):
    abt_df = staged_abt(spark, d)
    return pf.null_rates(abt_df, mp.feature_columns(abt_df))


@register("feature_label_median_ratio")
def _median_ratio(spark, d):
    return pf.label_median_ratio(staged_abt(spark, d), "label", PROFILE_COLS)


@register("uninformative_features")
def _uninformative(spark, d):
    return pf.uninformative(pf.label_median_ratio(staged_abt(spark, d), "label", PROFILE_COLS))


@register("feature_profile")
def _feature_profile(spark, d):
    return mp.feature_profile(staged_abt(spark, d))


@register("stratified_split_sizes")
def _split_sizes(spark, d):
    return (mp.stratified_split(staged_abt(spark, d)).groupBy("label", "split")
            .agg(F.count(F.lit(1)).alias("n")))


@register("out_of_time_sizes")
def _oot_sizes(spark, d):
    parts = zip(("before", "latest"), mp.split_oot(staged_abt(spark, d), how="date"))
    counts = [p.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit(name)) for name, p in parts]
    return counts[0].unionByName(counts[1])


@register("label_rate_by_state")
def _label_rate(spark, d):
    return pf.label_rate(staged_abt(spark, d), "state_current")


@register("split_label_rate")
def _split_rate(spark, d):
    return pf.split_summary(staged_abt(spark, d), "tag")


@register("describe_by_cluster")
def _describe(spark, d):
    seg = lc.segmentation_snapshot(fx.tx_orders(spark, d), ORD_CUT, MAIN)
    return pf.describe_by(seg.filter(F.col("cluster").isNotNull()), "cluster", ["frequency", "points_pos"])


def _fv_scaled(spark, d):
    fv = lc.rfv_cluster(lc.frequency_value(fx.tx_events(spark, d), EV_CUT), MAIN)
    return pf.minmax(fv, ["frequency", "points_pos"])


@register("minmax_scale")
def _minmax(spark, d):
    return _fv_scaled(spark, d)


@register("impute_policy")
def _impute(spark, d):
    return mp.impute(staged_abt(spark, d)).select("ref_date", "user_id", *IMPUTE_COLS)


@register("onehot_states")
def _onehot(spark, d):
    df = mp.impute(staged_abt(spark, d)).select("ref_date", "user_id", "state_current")
    return pf.onehot(df, "state_current", STATE_VOCAB, prefix="is")


def _fv_thin_scaled(spark, d):
    fv = lc.rfv_cluster(lc.frequency_value(fx.tx_events_thin(spark, d), EV_CUT), MAIN)
    return pf.minmax(fv, ["frequency", "points_pos"])


@register("calinski_harabasz")
def _ch(spark, d):
    return ms.calinski_harabasz(_fv_thin_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], "cluster")


@register("davies_bouldin")
def _db(spark, d):
    return ms.davies_bouldin(_fv_thin_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], "cluster")


def _scored_fixed(spark, d):
    """ABT with a fixed score column (28-day activation) for curve formulas."""
    return (staged_abt(spark, d).select("ref_date", "user_id", "label", "tag", "pct_active_mau")
            .withColumn("score", F.coalesce(F.col("pct_active_mau"), F.lit(0.0)))
            .withColumn("prediction", (F.col("score") >= 0.5).cast("double")))


@register("roc_curve")
def _roc(spark, d):
    return ma.roc_curve(_scored_fixed(spark, d))


@register("lift_curve")
def _lift(spark, d):
    return ma.lift_curve(_scored_fixed(spark, d))


@register("confusion")
def _confusion(spark, d):
    return ma.confusion(_scored_fixed(spark, d))


@register("baseline")
def _baseline(spark, d):
    return ma.baseline(staged_abt(spark, d), "label", "tag")


@register("metrics_fixed_score")
def _metrics_fixed(spark, d):
    return ma.metrics(_scored_fixed(spark, d), split="tag")


@register("wcss_one_cluster")
def _wcss_one(spark, d):
    return ms.total_sum_squares(_fv_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"])


# rows-only (model fits and k-means labels are not SQL-expressible)

@register("kmeans_segments")
def _kmeans(spark, d):
    return ms.kmeans(_fv_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], k=5).select(
        "user_id", "segment")


@register("elbow")
def _elbow(spark, d):
    return ms.elbow(_fv_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], range(1, 11))


@register("elbow_raw")
def _elbow_raw(spark, d):
    return ms.elbow(_fv_scaled(spark, d), ["frequency", "points_pos"], range(1, 11))


@register("cluster_indices")
def _cluster_indices(spark, d):
    return ms.index_sweep(_fv_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], range(2, 11))


@register("silhouette")
def _silhouette(spark, d):
    return ms.silhouette(_fv_scaled(spark, d), ["frequency_scaled", "points_pos_scaled"], range(2, 11))


def model_table(spark, d):
    """Raw ABT with its stratified split, staged for iterative fitting."""
    return stage(mp.stratified_split(staged_abt(spark, d)), "model_table")


def fit_model(t, kind, **params):
    """The whole pipeline, from raw rows to score, and its train rows."""
    return pipeline_for(t, kind, **params)[:2]


def _train_score(spark, d, kind):
    t = model_table(spark, d)
    pipeline, train = fit_model(t, kind)
    return mm.predict(pipeline.fit(train), t).select("ref_date", "user_id", "tag", "split", "label", "score", "prediction")


@register("train_score_rf")
def _train_rf(spark, d):
    return _train_score(spark, d, "rf")


@register("train_score_dt")
def _train_dt(spark, d):
    return _train_score(spark, d, "dt")


@register("train_score_adaboost")
def _ada(spark, d):
    return _train_score(spark, d, "adaboost")


@register("model_metrics")
def _metrics(spark, d):
    s = _train_rf(spark, d).withColumn("part", F.when(F.col("tag") == "OOT", "oot").otherwise(F.col("split")))
    return ma.metrics(stage(s, "scored"), split="part")


@register("feature_importance")
def _importance(spark, d):
    pipeline, train = fit_model(model_table(spark, d), "adaboost")
    return ma.importance(pipeline.fit(train), train)


@register("tune_tree")
def _tune(spark, d):
    """Cross-validated AUC of every point of the tree's default grid."""
    pipeline, train = fit_model(model_table(spark, d), "dt")
    cv = mm.tune(pipeline, train, "dt")
    return spark.createDataFrame([(int(v), float(a)) for v, a in zip(mm.GRIDS["dt"]["minInstancesPerNode"], cv.avgMetrics)],
                                 "min_instances int, auc double")


@register("score_batch")
def _score_batch(spark, d):
    """A saved model, loaded again and run over the raw table."""
    from loyalspark.ml import score as mscore
    from loyalspark.session import scratch_path
    t = model_table(spark, d)
    pipeline, train, features = pipeline_for(t, "adaboost")
    root = scratch_path(spark, f"models-{spark.sparkContext.applicationId}")
    mscore.save_model(spark, pipeline.fit(train), {"kind": "adaboost", "features": features}, root)
    return mscore.score_batch(spark, root, t)


# ------------------------------------------- transactional store sub-blocks

def _w(prefix):
    return [f"{prefix}_{w}" for w in ("life", "d7", "d14", "d28", "d56")]


TX_BLOCKS = {
    "tx_ages": ("EV", ["age_days"]),
    "tx_active_days": ("EV", _w("active_days") + ["pct_active_mau"]),
    "tx_counts": ("EV", _w("tx") + _w("tx_per_day")),
    "tx_points": ("EV", _w("pts_net") + _w("pts_pos") + _w("pts_neg")),
    "tx_dayparts": ("EV", ["tx_morning", "tx_afternoon", "tx_night", "pct_morning", "pct_afternoon", "pct_night"]),
    "tx_hours": ("EV", _w("hours")),
    "tx_gaps": ("EV_THIN", ["gap_mean_life", "gap_mean_d28"]),
    "tx_product_share": ("ORD", ["share_cat_" + tr.slug(c) for c in fx.ORD_CATEGORIES]
                         + ["share_prod_" + tr.slug(p) for p in fx.ORD_PRODUCTS]),
}


def _tx_block(name, fixture, cols):
    def q(spark, d):
        if fixture == "ORD":
            fs = _fs_tx_orders(spark, d, [ORD_CUT], ORD_FEATURES)
        else:
            fs = tr.fs_transactional(fx.TX_BUILDERS[fixture](spark, d), [EV_CUT], MAIN)
        return fs.select("ref_date", "user_id", *cols)
    q.__doc__ = f"Transactional store block {name} on {fixture}."
    return q


for _name, (_fix, _cols) in TX_BLOCKS.items():
    register(_name)(_tx_block(_name, _fix, _cols))


#: The feature policy as SQL rows for the oracle (its patterns without
#: look-ahead, which no column of the ABT needs).
POLICY_SQL = " UNION ALL ".join(
    f"SELECT {i} AS step, '{r.group}' AS policy_group, '{r.pattern.split('|^share_(?!')[0]}' AS pattern, '{r.action}' AS action, "
    f"'{r.dtype}' AS dtype, '{r.note}' AS note" for i, r in enumerate(mp.POLICY, 1))
