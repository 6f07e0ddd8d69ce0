"""Course-platform (education) feature store.

Per user and cut-off: progress share per course (completed episodes before
the cut-off / episodes in the register), number of courses completed
(share = 1) and in progress (0 < share < 1), one pivoted share column per
course slug, and days since the last activity across episodes, rewards and
skills. Users appear only if they completed an episode before the cut-off
and are mapped to a loyalty customer id through the bridge (inner join).

Many cut-offs are one job: cumulative episode counts per (user, course) and
the latest activity per user are ``rangeBetween(unbounded, -1)`` frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.config import Preset, preset as _preset
from loyalspark.functions.expr import as_date, fractional_days
from loyalspark.operators.transactional import slug
from loyalspark.plans.asof import Cutoffs, Frame, asof_rollup


def episodes_per_course(register: DataFrame) -> DataFrame:
    """Register episodes per course."""
    return register.groupBy("course").agg(F.count("episode").cast("long").alias("total_eps"))


def course_progress(done: DataFrame, register: DataFrame, cutoffs) -> DataFrame:
    """G25 + J11: (user, course, cutoff, n_eps, total_eps, share)."""
    cuts = Cutoffs(cutoffs)
    facts = (done.filter(F.col("ts") < F.lit(cuts.last))
             .groupBy("user", "course", F.to_date("ts").alias("day"))
             .agg(F.count("episode").alias("n")))
    prog = asof_rollup(facts, ["user", "course"], cuts, [Frame("n_eps", "sum", "n", None)])
    return (prog.join(episodes_per_course(register), "course", "left")
            .select("user", "course", "cutoff", F.col("n_eps").cast("long").alias("n_eps"), "total_eps",
                    F.try_divide(F.col("n_eps").cast("double"), F.col("total_eps").cast("double")).alias("share")))


def course_pivot(progress: DataFrame, slugs, fill_zero: bool = False) -> DataFrame:
    """G26 + G27: counters and one share column per slug per (user, cutoff).
    The value list is explicit, so no extra job and a stable schema."""
    slugs = list(slugs)
    s = F.col("share")
    counters = progress.groupBy("user", "cutoff").agg(
        F.sum(F.when(s == 1, 1).otherwise(0)).cast("long").alias("n_complete"),
        F.sum(F.when((s > 0) & (s < 1), 1).otherwise(0)).cast("long").alias("n_in_progress"),
        *[F.sum(F.when(F.col("course") == c, s).otherwise(F.lit(0.0) if fill_zero else F.lit(None)))
          .alias(f"share_{slug(c)}") for c in slugs])
    return counters


def last_activity(sources: list, cutoffs, fractional: bool = False) -> DataFrame:
    """G28 + U1: per user active before each cut-off, days from the latest
    activity (over all sources) to the cut-off. Whole days on dates (main)
    or fractional days on timestamps (refs)."""
    cuts = Cutoffs(cutoffs)
    acts = None
    for src in sources:
        part = src.select("user", "ts")
        acts = part if acts is None else acts.unionByName(part)
    facts = (acts.filter(F.col("ts") < F.lit(cuts.last))
             .groupBy("user", F.to_date("ts").alias("day"))
             .agg(F.max("ts").alias("last_ts")))
    latest = asof_rollup(facts, ["user"], cuts, [Frame("last_ts", "max", "last_ts", None)])
    if fractional:
        days = fractional_days("last_ts", F.col("cutoff").cast("timestamp_ntz"))
    else:
        days = F.datediff("cutoff", "last_day").cast("double")
    return latest.select("user", "cutoff", days.alias("days_since_activity"))


def fs_education(done: DataFrame, register: DataFrame, rewards: DataFrame, skills: DataFrame,
                 bridge: DataFrame, cutoffs, slugs, cfg: Preset | str = "main",
                 keys: DataFrame | None = None) -> DataFrame:
    """C16 for one or many cut-offs, in one pass over the three sources.

    Episodes, rewards and skills are unioned and reduced per (user, course,
    day); a (user, course) window gives cumulative episode counts and the
    integer deltas: episodes per pivoted course, and +1 / -1 when a course
    becomes complete (count = register total) or is in progress (below it).
    Per (user, day) these deltas, the courses' totals and the latest activity
    feed one as-of rollup per user; shares are ratios of exact counts. One
    cut-off is grouped sums instead, without days and windows.
    Users without a completed episode before the cut-off are dropped, and the
    bridge maps the rest to loyalty customer ids (inner join).

    Output: ref_date, cutoff, customer_id, user, n_complete, n_in_progress,
    share_<slug>..., days_since_activity. ``keys`` (user, cutoff) restricts
    the output to those course-platform users and cut-offs.
    """
    from pyspark.sql import Window
    fc = _preset(cfg).features
    slugs = list(slugs)
    cuts = Cutoffs(cutoffs)
    lim = F.col("ts") < F.lit(cuts.last)
    day = F.to_date("ts").alias("day")
    if keys is not None:  # other users' rows go before the shuffles
        asked = keys.select("user")
        done, rewards, skills = (s.join(asked, "user", "left_semi") for s in (done, rewards, skills))
    if cuts.n == 1 and keys is None:
        r = _at_one_cutoff(done.filter(lim), register, [rewards.filter(lim), skills.filter(lim)], cuts, slugs)
        return _store(r, bridge, slugs, fc)
    # only episodes have a course; rewards and skills never meet the register
    eps = (done.filter(lim).groupBy("user", "course", day).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
           .join(episodes_per_course(register), "course", "left"))
    other = rewards.filter(lim).select("user", "ts").unionByName(skills.filter(lim).select("user", "ts"))
    facts = eps.unionByName(other.groupBy("user", day).agg(F.max("ts").alias("last_ts"))
                            .withColumn("n", F.lit(0).cast("long")), allowMissingColumns=True)
    w = Window.partitionBy("user", "course").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    t = F.col("total_eps")
    complete = lambda x: F.when(x == t, 1).otherwise(0)
    progress = lambda x: F.when((x > 0) & (x < t), 1).otherwise(0)
    f = facts.select("user", "course", "day", "n", "last_ts", t, F.sum("n").over(w).alias("cum"))
    prev = F.col("cum") - F.col("n")
    per_day = f.groupBy("user", "day").agg(
        F.sum("n").alias("n_all"), F.max("last_ts").alias("last_ts"),
        F.sum(complete(F.col("cum")) - complete(prev)).alias("d_complete"),
        F.sum(progress(F.col("cum")) - progress(prev)).alias("d_progress"),
        *[F.sum(F.when(F.col("course") == c, F.col("n"))).alias(f"d_{i}") for i, c in enumerate(slugs)],
        *[F.max(F.when(F.col("course") == c, t)).alias(f"t_{i}") for i, c in enumerate(slugs)])
    frames = [Frame("n_eps", "sum", "n_all", None), Frame("last_ts", "max", "last_ts", None),
              Frame("n_complete", "sum", "d_complete", None), Frame("n_in_progress", "sum", "d_progress", None)]
    frames += [Frame(f"c_{i}", "sum", f"d_{i}", None) for i in range(len(slugs))]
    frames += [Frame(f"t_{i}", "max", f"t_{i}", None) for i in range(len(slugs))]
    r = asof_rollup(per_day, ["user"], cuts, frames, requested=keys).filter(F.col("n_eps") > 0)
    shares = [F.try_divide(F.col(f"c_{i}").cast("double"), F.col(f"t_{i}").cast("double")) for i in range(len(slugs))]
    return _store(r.select("user", "cutoff", "n_complete", "n_in_progress", "last_ts",
                           *[v.alias(f"s_{i}") for i, v in enumerate(shares)]), bridge, slugs, fc)


def _at_one_cutoff(done: DataFrame, register: DataFrame, others: list, cuts: Cutoffs, slugs: list) -> DataFrame:
    """Rows for ``_store`` from episodes, rewards and skills before the only
    cut-off: no day matters, so episodes are counted per (user, course), and a
    user's shares meet as one short map."""
    if not cuts.valid:
        done = done.filter(F.lit(False))
    n, t = F.col("n"), F.col("total_eps")
    per_course = (done.groupBy("user", "course").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
                  .join(episodes_per_course(register), "course", "left"))
    share = F.when(F.col("course").isin(*slugs), F.struct("course", F.try_divide(n.cast("double"), t.cast("double")).alias("share")))
    users = per_course.groupBy("user").agg(
        F.max("last_ts").alias("last_done"), F.sum(F.when(n == t, 1).otherwise(0)).alias("n_complete"),
        F.sum(F.when((n > 0) & (n < t), 1).otherwise(0)).alias("n_in_progress"), F.map_from_entries(F.collect_list(share)).alias("m"))
    acts = others[0].select("user", "ts").unionByName(others[1].select("user", "ts")).groupBy("user").agg(F.max("ts").alias("last_other"))
    return users.join(acts, "user", "left").select(
        "user", F.lit(cuts.last).alias("cutoff"), "n_complete", "n_in_progress", F.greatest("last_done", "last_other").alias("last_ts"),
        *[F.try_element_at("m", F.lit(c)).alias(f"s_{i}") for i, c in enumerate(slugs)])


def _store(r: DataFrame, bridge: DataFrame, slugs: list, fc) -> DataFrame:
    """The store's columns from one row per user and cut-off, with the share of
    each slug's course as ``s_<i>``."""
    shares = []
    for i, c in enumerate(slugs):
        v = F.col(f"s_{i}")
        shares.append((F.coalesce(v, F.lit(0.0)) if fc.course_fill_zero else v).alias(f"share_{slug(c)}"))
    if fc.fractional_edu_recency:
        days = fractional_days("last_ts", F.col("cutoff").cast("timestamp_ntz"))
    else:
        days = F.datediff("cutoff", F.to_date("last_ts")).cast("double")
    out = r.join(bridge.select("user", "customer_id"), "user", "inner")
    return out.select(F.date_sub("cutoff", 1).alias("ref_date"), "cutoff", "customer_id", "user",
                      F.col("n_complete").cast("long").alias("n_complete"),
                      F.col("n_in_progress").cast("long").alias("n_in_progress"), *shares,
                      days.alias("days_since_activity"))
