"""Job registry, backfill runs and the daily chain: S7/S8 S11 S12 S13.

A job turns (origin tables, cut-off list) into a dated snapshot table. One
run covers all requested cut-offs in one Spark job (the operators take the
whole cut-off list), then writes with the idempotent dated sink.

Storage layout (``Sources``): ``<root>/loyalty-system/transactions``,
``.../transaction_items``, ``.../products``, ``<root>/education-platform/
{episodes_done,episodes,rewards,skills,user_bridge}`` and the target
database ``<root>/analytics/<table>`` partitioned by ``ref_date``.
"""

from __future__ import annotations

import argparse
import datetime as _dt
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loyalspark.config import preset as _preset
from loyalspark.functions.expr import as_date
from loyalspark.operators import education as ed
from loyalspark.operators import lifecycle as lc
from loyalspark.operators import lifecycle_features as lf
from loyalspark.operators import state_history as sh
from loyalspark.operators import target as tg
from loyalspark.operators import transactional as tr
from loyalspark.sources.calendar import spine_dates
from loyalspark.sources.store import Sources, _exists, dates_of, drop_dates, publish, read_date, read_source, read_table, write_snapshot

LOYALTY, EDUCATION, ANALYTICS = "loyalty-system", "education-platform", "analytics"


@dataclass(frozen=True)
class Job:
    name: str
    origin: str
    target_table: str
    build: Callable[[SparkSession, Sources, list, object], DataFrame]


def _tx(spark, src):
    return read_source(spark, src, LOYALTY, "transactions")


def _build_life_cycle(spark, src, cuts, cfg):
    return lc.segmentation_backfill(_tx(spark, src), cuts, cfg)


def _build_fs_tx(spark, src, cuts, cfg):
    return tr.fs_transactional(_tx(spark, src), cuts, cfg,
                               items=read_source(spark, src, LOYALTY, "transaction_items"),
                               products=read_source(spark, src, LOYALTY, "products"))


def _build_fs_edu(spark, src, cuts, cfg):
    r = lambda t: read_source(spark, src, EDUCATION, t)
    # the pivot's columns: named in the preset, or else the register's courses
    slugs = cfg.features.courses or [
        x[0] for x in r("episodes").select("course").distinct().orderBy("course").collect()]
    return ed.fs_education(r("episodes_done"), r("episodes"), r("rewards"), r("skills"), r("user_bridge"),
                           cuts, slugs, cfg)


def next_states(spark: SparkSession, src: Sources, day, cfg) -> DataFrame | None:
    """The ``life_cycle_state`` rows of ``day``: the latest earlier ones merged
    with the day's snapshot. Reads two dates; only without earlier states, or
    with a snapshot between them and the day, the snapshots up to the day."""
    snapshots, states = src.path(ANALYTICS, "life_cycle"), src.path(ANALYTICS, "life_cycle_state")
    made = dates_of(spark, snapshots)
    if day not in made:
        return None
    before = max((d for d in dates_of(spark, states) if d < day), default=None)
    if before is None or any(before < d < day for d in made):
        return sh.begin(read_table(spark, snapshots), day, cfg)
    return sh.advance(read_date(spark, states, before), read_date(spark, snapshots, day), day, cfg, (day - before).days)


def _build_fs_lc(spark, src, cuts, cfg):
    """The store from state rows: those of its dates that are not there yet
    are made first, each from the one before."""
    off = cfg.features.lc_current_offset
    states = src.path(ANALYTICS, "life_cycle_state")
    wanted = [c - _dt.timedelta(days=off) for c in cuts]
    for day in wanted:
        if day not in dates_of(spark, states):
            rows = next_states(spark, src, day, cfg)
            if rows is not None:
                write_snapshot(rows, states, [day])
    if not any(day in dates_of(spark, states) for day in wanted):
        return lf.fs_life_cycle(read_table(spark, src.path(ANALYTICS, "life_cycle")), cuts, cfg)
    return sh.features_of(read_table(spark, states).filter(F.col("ref_date").isin(wanted)), cfg)


def _dates(cuts):
    return [c - _dt.timedelta(days=1) for c in cuts]


def _build_labels(spark, src, cuts, cfg):
    days = _dates(cuts)
    snapshots = read_table(spark, src.path(ANALYTICS, "life_cycle"))
    return tg.label(snapshots, HORIZON, cfg, lo=days[0], hi=days[-1])


def _build_abt(spark, src, cuts, cfg):
    """Sampled label rows with the stored features of their own date."""
    a = lambda t: read_table(spark, src.path(ANALYTICS, t)).filter(F.col("ref_date").between(*map(F.lit, span)))
    days = _dates(cuts)
    span = (days[0], days[-1])
    fs_ed = a("fs_education").drop("user").withColumnRenamed("customer_id", "user_id")
    return tg.abt(tg.cohort(a("labels"), 2, 42, train=span), a("fs_transactional"), a("fs_life_cycle"), fs_ed)


#: Days between a snapshot and the one its label looks at.
HORIZON = 28

JOBS: dict[str, Job] = {
    "life_cycle": Job("life_cycle", LOYALTY, "life_cycle", _build_life_cycle),
    "fs_transactional": Job("fs_transactional", LOYALTY, "fs_transactional", _build_fs_tx),
    "fs_education": Job("fs_education", EDUCATION, "fs_education", _build_fs_edu),
    "fs_life_cycle": Job("fs_life_cycle", ANALYTICS, "fs_life_cycle", _build_fs_lc),
    "labels": Job("labels", ANALYTICS, "labels", _build_labels),
    "abt": Job("abt", ANALYTICS, "abt", _build_abt),
}


def run_job(spark: SparkSession, name: str, start, stop, sources: Sources, monthly: bool = False,
            cfg="main") -> list:
    """S12 + S11: run one job for every cut-off in [start, stop] (daily, or
    month starts) as one Spark job and write the dated snapshots."""
    job = JOBS[name]
    cuts = spine_dates(start, stop, "month" if monthly else "day")
    if not cuts:
        return []
    df = job.build(spark, sources, cuts, _preset(cfg))
    if name == "life_cycle":  # states from these dates on hold what is replaced
        drop_dates(spark, sources.path(ANALYTICS, "life_cycle_state"), cuts[0] - _dt.timedelta(days=1))
    write_snapshot(df, sources.path(ANALYTICS, job.target_table),
                   [c - _dt.timedelta(days=1) for c in cuts])
    return cuts


def run_chain(spark: SparkSession, day, sources: Sources, cfg="refs") -> None:
    """The ordered daily chain for cut-off ``day`` — life_cycle ->
    fs_transactional -> fs_education -> fs_life_cycle -> fs_all, and the scores
    once a model was trained. Re-runnable for the same day (every step is an
    idempotent dated write, fs_all and the scores are published whole)."""
    d = as_date(day)
    # fs_life_cycle reads the snapshot stamped cut-off - offset; the job at
    # cut-off c writes the one stamped c - 1
    ahead = d + _dt.timedelta(days=1 - min(1, _preset(cfg).features.lc_current_offset))
    run_job(spark, "life_cycle", d, ahead, sources, cfg=cfg)
    for name in ("fs_transactional", "fs_education", "fs_life_cycle"):
        run_job(spark, name, d, d, sources, cfg=cfg)
    run_fs_all(spark, sources, d - _dt.timedelta(days=1))
    if _exists(spark, sources.path(ANALYTICS, MODELS)):
        run_predict(spark, sources)


#: Folders of the target database that hold no dated table.
MODELS, RUNS = "models", "runs"


def run_fs_all(spark: SparkSession, sources: Sources, ref_date=None) -> None:
    """C18 as a job: the scoring table of ``ref_date``, by default the latest
    of the stored transactional features."""
    a = lambda t: read_table(spark, sources.path(ANALYTICS, t))
    # the id bridge maps course-platform users to loyalty customer ids
    fs_ed = a("fs_education").drop("user").withColumnRenamed("customer_id", "user_id")
    out = tg.fs_all(a("fs_transactional"), a("fs_life_cycle"), fs_ed, ref_date=ref_date)
    publish(out, sources.path(ANALYTICS, "fs_all"))


def run_train(spark: SparkSession, sources: Sources, kind: str = "rf", oot_from=None, **params) -> dict:
    """Fit on the stored ABT; rows from ``oot_from`` on (by default those of
    the latest date) are held out as out-of-time. The model and its metadata
    become the next version, the run is logged."""
    from loyalspark.ml.train import train
    abt = read_table(spark, sources.path(ANALYTICS, "abt"))
    last = oot_from or abt.agg(F.max("ref_date")).first()[0]
    abt = abt.withColumn("tag", F.when(F.col("ref_date") >= F.lit(as_date(last)), "OOT").otherwise("ABT"))
    return train(spark, abt, sources.path(ANALYTICS, MODELS), sources.path(ANALYTICS, RUNS), kind, **params)


def run_predict(spark: SparkSession, sources: Sources) -> None:
    """M28 as a job: the latest model over the scoring table, published as
    ``score`` (ref_date, user_id, score)."""
    from loyalspark.ml.score import score_batch
    score_batch(spark, sources.path(ANALYTICS, MODELS), read_table(spark, sources.path(ANALYTICS, "fs_all")), sources.path(ANALYTICS, "score"))


def main(argv=None) -> None:
    """``spark-submit -m loyalspark.plans.jobs --job life_cycle --start ... --stop ...``"""
    ap = argparse.ArgumentParser(description="Run a dated snapshot job")
    ap.add_argument("--root", required=True)
    ap.add_argument("--job", choices=sorted(JOBS) + ["chain", "fs_all", "train", "predict"])
    ap.add_argument("--kind", default="rf", help="model to train: rf, dt, gbt or adaboost")
    ap.add_argument("--start", type=_dt.date.fromisoformat, default=_dt.date.today())
    ap.add_argument("--stop", type=_dt.date.fromisoformat, default=_dt.date.today())
    ap.add_argument("--monthly", action="store_true")
    ap.add_argument("--preset", choices=["main", "refs"], default="main")
    ap.add_argument("--list", action="store_true")
    args = ap.parse_args(argv)
    if args.list:
        for n, j in JOBS.items():
            print(f"{n}: {j.origin} -> {ANALYTICS}.{j.target_table}")
        return
    if args.start > args.stop:
        ap.error("--start must not be after --stop")
    from loyalspark.session import get_session
    spark = get_session("loyalspark-job")
    src = Sources(args.root)
    if args.job == "chain":
        run_chain(spark, args.stop, src, args.preset)
    elif args.job == "fs_all":
        run_fs_all(spark, src)
    elif args.job == "train":
        run_train(spark, src, args.kind)
    elif args.job == "predict":
        run_predict(spark, src)
    else:
        run_job(spark, args.job, args.start, args.stop, src, args.monthly, args.preset)


if __name__ == "__main__":
    main()
