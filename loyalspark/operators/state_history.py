"""C17 without a pass over the snapshot history: two forms.

**From activity** (``fs_life_cycle_daily``): with a snapshot every day, a
user's state between two active days depends on ages alone, so it changes on a
handful of dates. ``state_spans`` cuts the time after each active day at those
dates; a user's snapshots in a state are lengths of spans, counted without ever
making a snapshot row. The work is the number of active days, whatever the
length of the history.

**Day by day** (``advance``): the table ``life_cycle_state`` has one row per
user and date with all that the store asks of the past: snapshots so far in
each state, and the latest states and frequencies. A day's rows are yesterday's
merged with the day's snapshot by user, so a daily run reads two partitions.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.config import Preset, preset as _preset
from loyalspark.functions.classify import classify_lifecycle
from loyalspark.functions.expr import as_date, utc
from loyalspark.operators.lifecycle import segmentation_backfill
from loyalspark.operators.lifecycle_features import finish
from loyalspark.plans.asof import Cutoffs

#: Days of states and of frequencies that a state row carries, today's first.
STATES, FREQUENCIES = 30, 14


def state_spans(tx: DataFrame, since, until, cfg: Preset | str = "main") -> DataFrame:
    """(user_id, lo, hi, state): runs of daily cut-offs lo..hi (day numbers)
    within since..until over which a user's state is the same, in one window
    over the user's active days. A run may be followed by one of equal state.
    """
    cfg = _preset(cfg)
    lc = cfg.lifecycle
    first, last = ((as_date(x) - _dt.date(1970, 1, 1)).days for x in (since, until))
    days = (utc(tx).filter(F.col("ts") < F.lit(as_date(until))).select("user_id", F.unix_date(F.to_date("ts")).alias("day")).distinct())
    w = Window.partitionBy("user_id").orderBy("day")
    days = days.select("user_id", "day", F.lag("day").over(w).alias("prev"), F.lead("day").over(w).alias("next"),
                       F.min("day").over(w).alias("first"))
    # a cut-off belongs to the latest active day before it
    days = days.select("user_id", "day", "prev", "first", F.greatest(F.col("day") + 1, F.lit(first)).alias("lo"),
                       F.least(F.coalesce("next", F.lit(last)), F.lit(last)).alias("hi")).filter("lo <= hi")
    # ages at which the rules change
    turns = F.array(F.col("first") + lc.curious_max_first_age + 1, *[
        F.col("day") + age + 1 for age in (lc.recent_max_age, lc.tourist_max_age, lc.disenchanted_max_age)])
    starts = F.array_sort(F.array_distinct(F.concat(F.array("lo"), F.filter(turns, lambda x: (x > F.col("lo")) & (x <= F.col("hi"))))))
    days = days.withColumn("starts", starts)
    runs = F.transform("starts", lambda x, i: F.struct(
        x.alias("lo"), F.coalesce(F.get("starts", i + 1) - 1, F.col("hi")).alias("hi")))
    spans = days.select("user_id", "day", "prev", "first", F.explode(runs).alias("r")).select("user_id", "day", "prev", "first", "r.*")
    state = classify_lifecycle(F.col("lo") - F.col("first"), F.col("lo") - F.col("day"), F.col("lo") - F.col("prev"), lc)
    return spans.select("user_id", "lo", "hi", state.alias("state"))


def state_counts(spans: DataFrame, cutoffs, cfg: Preset | str = "main") -> DataFrame:
    """(user_id, cutoff, _n, _c0 ...): snapshots dated before each cut-off, all
    and by state. One cut-off is a grouped sum; many are running sums over a
    user's spans, read off the span that holds the cut-off."""
    cfg = _preset(cfg)
    cuts = Cutoffs(cutoffs)
    number = [(c - _dt.date(1970, 1, 1)).days for c in cuts.dates]
    labels = cfg.lifecycle.labels
    if not cuts.valid:
        spans = spans.filter(F.lit(False))

    def sums(length: Column, total) -> list[Column]:
        return [total(length).alias("_n"), *[total(F.when(F.col("state") == s, length).otherwise(0)).alias(f"_c{i}") for i, s in enumerate(labels)]]

    if cuts.n == 1:
        at = F.lit(number[0])
        return (spans.filter(F.col("lo") <= at).groupBy("user_id").agg(*sums(F.least("hi", at) - F.col("lo") + 1, F.sum))
                .select("user_id", F.lit(cuts.last).alias("cutoff"), "_n", *[f"_c{i}" for i in range(len(labels))]))
    ahead = Window.partitionBy("user_id").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    run = spans.select("user_id", "lo", "hi", "state", *sums(F.col("hi") - F.col("lo") + 1, lambda x: F.coalesce(F.sum(x).over(ahead), F.lit(0))))
    held = F.filter(F.array(*map(F.lit, number)), lambda c: (c >= F.col("lo")) & (c <= F.col("hi")))
    at = run.withColumn("c", F.explode(held)).withColumn("own", F.col("c") - F.col("lo") + 1)
    return at.select("user_id", F.date_from_unix_date("c").alias("cutoff"), (F.col("_n") + F.col("own")).alias("_n"), *[
        (F.col(f"_c{i}") + F.when(F.col("state") == s, F.col("own")).otherwise(0)).alias(f"_c{i}") for i, s in enumerate(labels)])


def fs_life_cycle_daily(tx: DataFrame, cutoffs, since, cfg: Preset | str = "main", keys: DataFrame | None = None) -> DataFrame:
    """C17 over daily snapshots with cut-offs ``since`` up to each cut-off,
    straight from the transactions: equal to ``fs_life_cycle`` over
    ``segmentation_backfill`` of all those days. Snapshots are made only for
    the dates that a cut-off looks at by itself: its current one, the one of
    29 days before, and those of the moving averages."""
    cfg = _preset(cfg)
    cuts, start = Cutoffs(cutoffs), as_date(since)
    off = cfg.features.lc_current_offset
    looks = {}
    for c in cuts.dates if cuts.valid else []:
        for back in {off, 29, *(range(off, off + FREQUENCIES) if cfg.features.moving_average else ())}:
            made = c - _dt.timedelta(days=back - 1)  # the snapshot of date d has cut-off d + 1
            if made >= start:
                looks.setdefault(made, []).append((c, back))
    spark = tx.sparkSession
    spans = state_spans(tx, start, max([cuts.last, *looks]), cfg)
    rows = spark.createDataFrame([(made - _dt.timedelta(days=1), c, back) for made, found in looks.items() for c, back in found],
                                 "ref_date date, cutoff date, back int")
    # cut-offs x 16 rows at most
    seen = segmentation_backfill(tx, sorted(looks), cfg).select("ref_date", "user_id", "state", "frequency").join(F.broadcast(rows), "ref_date")
    now, near = F.col("back") == off, F.col("back").between(off, off + FREQUENCIES - 1)
    cur = seen.groupBy("user_id", "cutoff").agg(
        F.max(F.when(now, F.col("state"))).alias("state"), F.max(F.when(now, F.col("frequency"))).alias("frequency"),
        F.max(F.when(F.col("back") == 29, F.col("state"))).alias("state_d28"),
        F.avg(F.when(near & (F.col("back") < off + 7), F.col("frequency"))).alias("avg_freq_d7"),
        F.avg(F.when(near, F.col("frequency"))).alias("avg_freq_d14")).filter("state is not null")
    return finish(cur.join(state_counts(spans, cuts.dates if cuts.valid else [], cfg), ["user_id", "cutoff"], "left"), cfg, keys)


# ----------------------------------------------------------- day by day

def _row(user, ref_date, state, frequency, days, states, frequencies) -> list[Column]:
    return [ref_date.alias("ref_date"), user.alias("user_id"), state.alias("state"), frequency.cast("long").alias("frequency"),
            days.alias("days"), F.slice(states, 1, STATES).alias("states"), F.slice(frequencies, 1, FREQUENCIES).alias("frequencies")]


def advance(previous: DataFrame, snapshot: DataFrame, ref_date, cfg: Preset | str = "main", gap: int = 1) -> DataFrame:
    """The state rows of ``ref_date`` from those of ``gap`` days before and the
    day's snapshot: one merge by user. Users new in the snapshot begin with
    it; users missing from it stay, with a null state, until they come back."""
    labels = _preset(cfg).lifecycle.labels
    p = previous.select("user_id", F.col("days").alias("p_days"), F.col("states").alias("p_states"), F.col("frequencies").alias("p_freqs"))
    s = snapshot.select("user_id", "state", "frequency")
    both = p.join(s, "user_id", "full_outer")
    none = [F.array(*[F.lit(None).cast(t)] * (gap - 1)) if gap > 1 else F.array().cast(f"array<{t}>") for t in ("string", "long")]
    before = F.coalesce("p_days", F.array(*[F.lit(0).cast("long")] * len(labels)))
    names = F.array(*map(F.lit, labels))
    days = F.zip_with(before, names, lambda n, label: n + F.coalesce((label == F.col("state")).cast("long"), F.lit(0).cast("long")))
    return both.select(*_row(
        F.col("user_id"), F.lit(as_date(ref_date)), F.col("state"), F.col("frequency"), days,
        F.concat(F.array("state"), none[0], F.coalesce("p_states", F.array().cast("array<string>"))),
        F.concat(F.array(F.col("frequency").cast("long")), none[1], F.coalesce("p_freqs", F.array().cast("array<long>")))))


def begin(snapshots: DataFrame, ref_date, cfg: Preset | str = "main") -> DataFrame:
    """The state rows of ``ref_date`` from all snapshots up to it: the start of
    the table, one grouped pass with at most a month of values per user."""
    labels, at = _preset(cfg).lifecycle.labels, as_date(ref_date)
    rows = snapshots.filter(F.col("ref_date") <= F.lit(at)).withColumn("back", F.datediff(F.lit(at), F.col("ref_date")))
    recent = F.map_from_entries(F.collect_list(F.when(F.col("back") < STATES, F.struct("back", F.struct("state", F.col("frequency").cast("long").alias("frequency"))))))
    held = rows.groupBy("user_id").agg(
        recent.alias("m"), F.array(*[F.sum((F.col("state") == s).cast("long")) for s in labels]).alias("days"))
    place = F.sequence(F.lit(0), F.lit(STATES - 1))
    return held.select(*_row(
        F.col("user_id"), F.lit(at), F.try_element_at("m", F.lit(0))["state"], F.try_element_at("m", F.lit(0))["frequency"], F.col("days"),
        F.transform(place, lambda i: F.try_element_at("m", i)["state"]), F.transform(place, lambda i: F.try_element_at("m", i)["frequency"])))


def features_of(states: DataFrame, cfg: Preset | str = "main", keys: DataFrame | None = None) -> DataFrame:
    """C17 from state rows of the cut-offs' current dates."""
    cfg = _preset(cfg)
    off, labels = cfg.features.lc_current_offset, cfg.lifecycle.labels
    # the current snapshot counts as before the cut-off only if it is dated so
    own = F.lit(0).cast("long") if off else F.lit(1).cast("long")
    counts = [F.col("days")[i] - F.when(F.col("state") == s, own).otherwise(0) for i, s in enumerate(labels)]

    def average(values: Column) -> Column:
        known = F.filter(values, lambda x: x.isNotNull())
        return F.try_divide(F.aggregate(known, F.lit(0).cast("long"), lambda a, x: a + x).cast("double"), F.size(known).cast("double"))

    near = F.arrays_zip(F.slice("states", 1, FREQUENCIES).alias("s"), F.slice("frequencies", 1, FREQUENCIES).alias("f"))
    rows = F.transform(F.slice(F.filter(near, lambda x: x["s"].isNotNull()), 1, 7), lambda x: x["f"])
    cur = states.filter("state is not null").select(
        "ref_date", F.date_add("ref_date", off).alias("cutoff"), "user_id", "state", "frequency",
        F.get("states", F.lit(29 - off)).alias("state_d28"), sum(counts[1:], counts[0]).alias("_n"),
        *[c.alias(f"_c{i}") for i, c in enumerate(counts)], average(rows).alias("avg_freq_d7"),
        average(F.slice("frequencies", 1, FREQUENCIES)).alias("avg_freq_d14"))
    return finish(cur, cfg, keys)
