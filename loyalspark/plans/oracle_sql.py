"""DuckDB SQL of the registered queries, the correctness oracle.

Derived from the rules of SURVEY §2.13, not from the Spark plans: a user's
history is one sorted list of day records, and a cut-off looks at the part of
the list before it (list functions); the transactional store is filtered
aggregates over one user-day table. Doubles are rounded to 6 places on both
sides; means of doubles are taken over decimals, so no sum depends on order.
"""

from __future__ import annotations

import re

from loyalspark.config import LIFECYCLE_LABELS_MAIN, MAIN, NON_USER_MAIN, REFS, Preset
from loyalspark.sources import fixtures as fx

WINDOWS = {"life": None, "d7": 7, "d14": 14, "d28": 28, "d56": 56}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def pick(rules: list[tuple[str, str]]) -> str:
    """Label of the first rule that holds."""
    return "CASE " + " ".join(f"WHEN {cond} THEN {q(label)}" for label, cond in rules) + " END"


def state_of(p: Preset, first: str, last: str, prev: str) -> str:
    """State from the ages of the first, last and last but one active day."""
    curious, loyal, regained, reborn, tourist, disenchanted, zombie = p.lifecycle.labels
    pause = f"({prev} - {last})"
    return pick([(curious, f"{first} <= 7"), (loyal, f"{last} <= 7 AND {pause} < 15"),
                 (regained, f"{last} <= 7 AND {pause} < 28"), (reborn, f"{last} <= 7 AND {pause} >= 28"),
                 (tourist, f"{last} BETWEEN 8 AND 14"), (disenchanted, f"{last} BETWEEN 15 AND 28"), (zombie, f"{last} > 28")])


def cluster_of(p: Preset, f: str = "frequency", v: str = "points_pos") -> str:
    lurker, lazy, potential, undecided, hard, hyper, efficient = p.rfv.labels
    if p.rfv.variant == "main":
        return pick([(lurker, f"{v} < 900 AND {f} < 5"), (lazy, f"{v} < 900 AND {f} <= 10"), (potential, f"{v} < 900 AND {f} > 10"),
                     (undecided, f"{v} <= 1500 AND {f} < 10"), (hard, f"{v} <= 1500 AND {f} >= 10"),
                     (hyper, f"{v} > 1500 AND {f} < 10"), (efficient, f"{v} > 1500 AND {f} >= 10")])
    return pick([(hyper, f"{v} >= 1500 AND {f} <= 10"), (efficient, f"{v} >= 1500 AND {f} > 10"),
                 (undecided, f"{v} >= 750 AND {f} <= 10"), (hard, f"{v} >= 750 AND {f} > 10"),
                 (lurker, f"{f} < 5"), (lazy, f"{f} <= 10"), (potential, f"{f} > 10")])


def dates(*days: str) -> str:
    return f"SELECT unnest([{', '.join(f'DATE {q(d)}' for d in days)}]) AS cutoff"


def every(start: str, stop: str, step: str = "1 DAY") -> str:
    return f"SELECT unnest(generate_series(DATE '{start}', DATE '{stop}', INTERVAL {step}))::DATE AS cutoff"


def mean(x: str) -> str:
    """Mean over decimals with nine places."""
    return f"CAST(sum(CAST({x} AS DECIMAL(28, 9))) AS DOUBLE) / nullif(count({x}), 0)"


# ------------------------------------------------------------- histories

def user_days(tx: str) -> str:
    """One row per user and active day."""
    return f"""SELECT user_id, ts::DATE AS day, count(DISTINCT tx_id) AS n_tx, count(tx_id) AS n_rows, sum(points) AS net,
       sum(greatest(points, 0)) AS pos, sum(least(points, 0)) AS neg, min(ts) AS t0, max(ts) AS t1,
       count(tx_id) FILTER (hour(ts) BETWEEN 10 AND 14) AS mo, count(tx_id) FILTER (hour(ts) BETWEEN 15 AND 21) AS af,
       count(tx_id) FILTER (hour(ts) NOT BETWEEN 10 AND 21) AS ni
FROM ({tx}) GROUP BY ALL"""


def known_at(tx: str, cuts: str) -> str:
    """(cutoff, user_id, h): the day records before the cut-off, in order."""
    return f"""SELECT * FROM (
  SELECT cutoff, user_id, list_filter(h, lambda x: x.d < cutoff) AS h
  FROM (SELECT user_id, list({{'d': day, 'pos': pos, 'neg': neg}} ORDER BY day) AS h FROM ({user_days(tx)}) GROUP BY user_id), ({cuts})
) WHERE len(h) > 0"""


def life_cycle(tx: str, cuts: str, p: Preset) -> str:
    ages = f"""SELECT cutoff, user_id, h, cutoff - h[1].d AS first_age, cutoff - h[-1].d AS last_age, cutoff - h[-2].d AS prev_age
FROM ({known_at(tx, cuts)})"""
    return f"SELECT *, {state_of(p, 'first_age', 'last_age', 'prev_age')} AS state FROM ({ages})"


def segmentation(tx: str, cuts: str, p: Preset = MAIN, days: int = 28) -> str:
    """The dated snapshot: ages, state, and frequency and value of the last
    ``days`` days (null without activity in them)."""
    recent = f"SELECT *, list_filter(h, lambda x: x.d >= cutoff - {days}) AS r FROM ({life_cycle(tx, cuts, p)})"
    return f"""SELECT *, {cluster_of(p)} AS cluster FROM (
  SELECT cutoff - 1 AS ref_date, user_id, first_age, last_age, prev_age, state, nullif(len(r), 0) AS frequency,
         list_sum(list_transform(r, lambda x: x.pos))::BIGINT AS points_pos, list_sum(list_transform(r, lambda x: x.pos))::BIGINT AS points_gain,
         list_sum(list_transform(r, lambda x: -x.neg))::BIGINT AS points_redeem
  FROM ({recent}))"""


def snapshot_states(tx: str, cutoff: str, p: Preset) -> str:
    return f"SELECT user_id, first_age, last_age, prev_age, state FROM ({life_cycle(tx, dates(cutoff), p)})"


def frequency_value(tx: str, cutoff: str, days: int = 28) -> str:
    return f"""SELECT user_id, count(*) AS frequency, sum(pos)::BIGINT AS points_pos, sum(pos - neg)::BIGINT AS points_total,
       sum(pos)::BIGINT AS points_gain, sum(-neg)::BIGINT AS points_redeem
FROM ({user_days(tx)}) WHERE DATE '{cutoff}' - day BETWEEN 1 AND {days} GROUP BY user_id"""


def clustered(fv: str, p: Preset = MAIN) -> str:
    return f"SELECT *, {cluster_of(p)} AS cluster FROM ({fv})"


def daily(tx: str) -> str:
    return f"SELECT day, count(*) AS dau FROM ({user_days(tx)}) GROUP BY day"


def rolling(tx: str, days: int = 28) -> str:
    """Every active day of a user counts for the ``days`` dates from it on."""
    return f"""SELECT ref_day, count(DISTINCT day) AS days_in_window, count(DISTINCT user_id) AS mau FROM (
  SELECT user_id, day, unnest(generate_series(day, day + {days - 1}, INTERVAL 1 DAY))::DATE AS ref_day FROM ({user_days(tx)})
) SEMI JOIN (SELECT DISTINCT day AS ref_day FROM ({user_days(tx)})) USING (ref_day) GROUP BY ref_day"""


def monthly(metric: str, day: str, value: str) -> str:
    return f"""SELECT m.*, round(month_mean, 6) AS {value}_monthly FROM ({metric}) m
JOIN (SELECT date_trunc('month', {day}) AS mo, avg({value}) AS month_mean FROM ({metric}) GROUP BY 1) ON date_trunc('month', {day}) = mo"""


def histogram(values: str, bins: str, by: tuple = ()) -> str:
    """``values`` has a column x and the ``by`` columns."""
    keys = "".join(f"{k}, " for k in by)
    return f"""WITH v AS ({values}),
g AS (SELECT min(x) AS lo, {bins} AS nb, CASE WHEN max(x) > min(x) THEN (max(x) - min(x)) / ({bins}) ELSE 1.0 END AS width FROM v),
placed AS (SELECT {keys}least(floor((x - lo) / width)::BIGINT, nb - 1) AS bin FROM v, g),
counted AS (SELECT {keys}bin, count(*) AS n FROM placed GROUP BY ALL),
whole AS (SELECT {keys}sum(n) AS total FROM counted {'GROUP BY ALL' if by else ''})
SELECT {keys}bin, round(lo + bin * width, 6) AS bin_lo, round(lo + (bin + 1) * width, 6) AS bin_hi, n AS count,
       round(n / (total * width), 6) AS density
FROM counted {'JOIN whole USING (' + ', '.join(by) + ')' if by else ', whole'}, g"""


def activity() -> dict:
    o, ev, thin, ords = {}, fx.SQL_EV, fx.SQL_EV_THIN, fx.SQL_ORD
    o["dau"] = daily(ev)
    o["dau_orders"] = daily(ords)
    o["dau_monthly_mean"] = f"SELECT strftime(day, '%Y-%m') AS month, round(avg(dau), 6) AS dau_mean FROM ({daily(ev)}) GROUP BY 1"
    o["dau_smoothed"] = monthly(daily(ev), "day", "dau")
    o["dau_histogram"] = histogram(f"SELECT dau::DOUBLE AS x FROM ({daily(ev)})", "30")
    o["dau_histogram_by_month"] = histogram(
        f"SELECT year(day) AS year, month(day) AS month, dau::DOUBLE AS x FROM ({daily(ords)})",
        "ceil(log2(count(x)))::BIGINT + 1", ("year", "month"))
    o["mau_rolling_28"], o["mau_rolling_28_events"], o["mau_rolling_28_orders"] = rolling(thin), rolling(ev), rolling(ords)
    o["mau_smoothed"] = monthly(rolling(ev), "ref_day", "mau")
    o["activity_bounds"] = f"SELECT min(ts)::DATE AS first_day, max(ts)::DATE AS last_day FROM ({ords})"
    spine = f"SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY))::DATE AS cutoff FROM ({o['activity_bounds']})"
    o["date_spine_day"] = spine
    o["date_spine_month"] = f"SELECT cutoff FROM ({spine}) WHERE day(cutoff) = 1"
    o["date_spine_month_padded"] = f"""SELECT cutoff FROM ({spine}) WHERE day(cutoff) = 1
UNION ALL SELECT (date_trunc('month', last_day) + INTERVAL 1 MONTH)::DATE FROM ({o['activity_bounds']}) WHERE day(last_day) > 1"""
    o["user_history"] = f"""SELECT user_id, ts, 1::BIGINT AS frequency, sum(greatest(points, 0))::BIGINT AS points_pos,
       sum(abs(points))::BIGINT AS points_total, sum(greatest(-points, 0))::BIGINT AS points_redeem, count(*) AS n_tx
FROM ({ev}) WHERE user_id = 7 GROUP BY ALL"""
    return o


def segments() -> dict:
    o, ev, thin, ords = {}, fx.SQL_EV, fx.SQL_EV_THIN, fx.SQL_ORD
    cut, year = "2024-01-31", "2000-01-01"
    o["lifecycle_snapshot_main"] = snapshot_states(thin, cut, MAIN)
    o["lifecycle_snapshot_refs"] = snapshot_states(thin, cut, REFS)
    o["lifecycle_snapshot_orders"] = snapshot_states(ords, year, MAIN)
    o["third_latest_day"] = f"SELECT user_id, h[-3].d AS day FROM ({known_at(ords, dates(year))}) WHERE len(h) >= 3"
    o["frequency_value"] = frequency_value(thin, cut)
    o["frequency_value_orders"] = frequency_value(ords, year)
    o["frequency_value_trimmed"] = f"SELECT * FROM ({frequency_value(ev, cut)}) WHERE points_pos < 3000"
    o["rfv_cluster_main"] = clustered(frequency_value(thin, cut))
    o["rfv_cluster_refs"] = clustered(frequency_value(thin, cut), REFS)
    o["rfv_cluster_events"] = clustered(frequency_value(ev, cut))
    o["cluster_sizes"] = f"SELECT cluster, count(*) AS n FROM ({o['rfv_cluster_main']}) GROUP BY cluster"
    o["segmentation_snapshot"] = segmentation(ords, dates(year))
    o["segmentation_complete_rows"] = f"SELECT * FROM ({o['segmentation_snapshot']}) WHERE frequency IS NOT NULL AND prev_age IS NOT NULL"
    o["segmentation_fixed_columns"] = f"SELECT user_id, state, 0 AS not_there, frequency FROM ({o['segmentation_snapshot']})"
    o["segmentation_snapshot_refs"] = segmentation(thin, dates(cut), REFS)
    o["segmentation_backfill_daily"] = segmentation(thin, every("2024-01-02", cut))
    months = segmentation(ords, every("1998-01-01", "2001-08-01", "1 MONTH"))
    o["segmentation_backfill_monthly"] = months
    o["lifecycle_report_latest"] = f"""SELECT ref_date, state, count(*) AS n FROM ({months})
WHERE ref_date = DATE '2001-07-31' AND state <> {q(MAIN.lifecycle.zombie)} GROUP BY ALL"""
    from loyalspark.operators.lifecycle import state_column
    names = {s: state_column(s) for s in MAIN.lifecycle.labels if s != MAIN.lifecycle.zombie}
    counts = ", ".join(f"count(*) FILTER (state = {q(s)}) AS {n}" for s, n in names.items())
    o["lifecycle_matrix"] = f"SELECT ref_date, strftime(ref_date, '%Y-%m') AS month, {counts} FROM ({months}) GROUP BY ref_date"
    shares = ", ".join(f"round(100.0 * {n} / ({' + '.join(names.values())}), 6) AS {n.replace('n_', 'pct_', 1)}" for n in names.values())
    o["lifecycle_matrix_pct"] = f"SELECT ref_date, month, {shares} FROM ({o['lifecycle_matrix']})"
    return o


# ------------------------------------------------------ transactional store

def transactional(tx: str, cuts: str, p: Preset = MAIN, with_products: bool = True, products: tuple = fx.ORD_PRODUCTS,
                  categories: tuple = fx.ORD_CATEGORIES) -> str:
    """Every feature is an aggregate over the user-day rows before the
    cut-off, filtered by age; gaps are between neighbouring active days."""
    from loyalspark.operators.transactional import slug
    fc = p.features
    out = {}

    def within(days):
        return "" if days is None else f" FILTER (cutoff - day <= {days})"

    sums = {"active_days": "1", "tx": "n_tx", "pts_net": "net", "pts_pos": "pos",
            "pts_neg": "neg" if fc.signed_negative_points else "-neg"}
    for name, x in sums.items():
        for w, days in WINDOWS.items():
            out[f"{name}_{w}"] = f"coalesce(sum({x}){within(days)}, 0)::BIGINT"
    for w, days in WINDOWS.items():
        out[f"hours_{w}"] = f"round(coalesce(sum(date_diff('microsecond', t0, t1) / 3600000000.0){within(days)}, 0), 6)"
        n, d = f"sum(n_tx){within(days)}", f"count(*){within(days)}"
        out[f"tx_per_day_{w}"] = f"round(coalesce({n} / nullif({d}, 0), 0), 6)"
    tx_total = "sum(n_tx)" if fc.daypart_denominator == "distinct_tx" else "sum(n_rows)"
    for name, x in {"morning": "mo", "afternoon": "af", "night": "ni"}.items():
        out[f"tx_{name}"] = f"sum({x})::BIGINT"
        out[f"pct_{name}"] = f"round(sum({x}) / nullif({tx_total}, 0), 6)"
    out["pct_active_mau"] = "round((count(*) FILTER (cutoff - day <= 28)) / 28.0, 6)"
    out["gap_mean_life"] = "round(avg(gap), 6)"
    out["gap_mean_d28"] = "round(avg(gap) FILTER (cutoff - day <= 28), 6)"
    out["age_days"] = ("round(date_diff('microsecond', min(t0), CAST(cutoff - 1 AS TIMESTAMP)) / 86400000000.0, 6)"
                       if fc.fractional_age else "(cutoff - min(day))::DOUBLE")
    items = ""
    if with_products:
        wanted = {f"share_cat_{slug(c)}": f"category = {q(c)}" for c in categories} | \
                 {f"share_prod_{slug(n)}": f"name = {q(n)}" for n in products}
        total = "sum(n_tx)" if fc.product_denominator == "distinct_tx" else "sum(fan)"
        for k, name in enumerate(wanted):
            out[name] = f"round(sum(i{k}) / {total}, 6)"
        hits = ", ".join(f"count(*) FILTER ({c}) AS c{k}" for k, c in enumerate(wanted.values()))
        per_tx = f"SELECT tx_id, count(*) AS n_items, {hits} FROM ({fx.SQL_ITEMS}) LEFT JOIN ({fx.SQL_PRODUCTS}) USING (product_id) GROUP BY tx_id"
        per_day = ", ".join(f"coalesce(sum(c{k}), 0) AS i{k}" for k in range(len(wanted)))
        items = f""" JOIN (SELECT user_id, ts::DATE AS day, sum(greatest(coalesce(n_items, 0), 1)) AS fan, {per_day}
  FROM ({tx}) LEFT JOIN ({per_tx}) USING (tx_id) GROUP BY ALL) USING (user_id, day)"""
    cols = ",\n       ".join(f"{x} AS {name}" for name, x in out.items())
    return f"""SELECT cutoff - 1 AS ref_date, cutoff, user_id,
       {cols}
FROM (SELECT *, day - lag(day) OVER (PARTITION BY user_id ORDER BY day) AS gap FROM ({user_days(tx)}){items})
JOIN ({cuts}) ON day < cutoff GROUP BY cutoff, user_id"""


def transactional_stores() -> dict:
    ords, one = fx.SQL_ORD, dates("2000-01-01")
    return {
        "fs_transactional_main": transactional(ords, one),
        "fs_transactional_refs": transactional(ords, one, REFS),
        "fs_transactional_events": transactional(fx.SQL_EV, dates("2024-01-31"), with_products=False),
        "fs_transactional_backfill": transactional(fx.SQL_EV_THIN, every("2024-01-05", "2024-01-31"), with_products=False),
        "fs_transactional_monthly": transactional(ords, every("1999-01-01", "2000-12-01", "1 MONTH"), REFS),
    }


def transactional_blocks() -> dict:
    from loyalspark.plans.catalog import TX_BLOCKS
    o = {}
    for name, (fixture, cols) in TX_BLOCKS.items():
        base = (transactional(fx.SQL_ORD, dates("2000-01-01")) if fixture == "ORD"
                else transactional(fx.TX_SQL[fixture], dates("2024-01-31"), with_products=False))
        o[name] = f"SELECT ref_date, user_id, {', '.join(cols)} FROM ({base})"
    return o


# ---------------------------------------------------------- education store

def progress(cuts: str) -> str:
    """Episodes done before the cut-off over the episodes of the register."""
    return f"""SELECT "user", course, cutoff, n_eps, total_eps, n_eps / total_eps AS share FROM (
  SELECT "user", course, cutoff, count(episode) AS n_eps FROM ({fx.SQL_EDU_DONE}), ({cuts}) WHERE ts < cutoff GROUP BY ALL
) LEFT JOIN (SELECT course, count(episode) AS total_eps FROM ({fx.SQL_EDU_REGISTER}) GROUP BY course) USING (course)"""


def course_table(cuts: str, p: Preset) -> str:
    from loyalspark.operators.transactional import slug
    shares = ", ".join(
        f"round(max(share) FILTER (course = {q(c)}), 6) AS share_{slug(c)}" if not p.features.course_fill_zero else
        f"round(coalesce(max(share) FILTER (course = {q(c)}), 0), 6) AS share_{slug(c)}" for c in fx.edu_slugs())
    return f"""SELECT cutoff, "user", count(*) FILTER (share = 1) AS n_complete, count(*) FILTER (share > 0 AND share < 1) AS n_in_progress, {shares}
FROM ({progress(cuts)}) GROUP BY cutoff, "user\""""


def recency(cuts: str, p: Preset) -> str:
    since = ("round(date_diff('microsecond', max(ts), CAST(cutoff AS TIMESTAMP)) / 86400000000.0, 6)"
             if p.features.fractional_edu_recency else "(cutoff - max(ts)::DATE)::DOUBLE")
    acts = " UNION ALL ".join(f'SELECT "user", ts FROM ({s})' for s in (fx.SQL_EDU_DONE, fx.SQL_EDU_REWARDS, fx.SQL_EDU_SKILLS))
    return f'SELECT cutoff, "user", {since} AS days_since_activity FROM ({acts}), ({cuts}) WHERE ts < cutoff GROUP BY cutoff, "user"'


def education(cuts: str, p: Preset) -> str:
    return f"""SELECT cutoff - 1 AS ref_date, customer_id, c.*, days_since_activity
FROM ({course_table(cuts, p)}) c JOIN ({recency(cuts, p)}) USING (cutoff, "user") JOIN ({fx.SQL_EDU_BRIDGE}) USING ("user")"""


def education_stores() -> dict:
    one = dates("2000-01-01")
    return {
        "course_progress": f'SELECT * REPLACE (round(share, 6) AS share) FROM ({progress(one)})',
        "course_pivot": course_table(one, MAIN),
        "course_last_activity": f"""SELECT "user", cutoff, days_since_activity FROM ({recency(one, MAIN)})
SEMI JOIN ({progress(one)}) USING ("user", cutoff)""",
        "fs_education": education(one, MAIN),
        "fs_education_refs": education(one, REFS),
        "fs_education_monthly": education(every("1999-01-01", "2000-12-01", "1 MONTH"), MAIN),
    }


# --------------------------------------------------------- life-cycle store

def january(p: Preset = MAIN) -> str:
    """Snapshots of EV_THIN for every day of January 2024."""
    return segmentation(fx.SQL_EV_THIN, every("2024-01-01", "2024-01-31"), p)


def life_cycle_store(snapshots: str, cuts: str, p: Preset) -> str:
    """From each user's list of snapshots: the one at the cut-off less the
    offset, the one 28 days before the last, and shares of all before."""
    from loyalspark.operators.lifecycle_features import pct_column
    off = p.features.lc_current_offset
    shares = ", ".join(f"round(len(list_filter(past, lambda x: x.s = {q(s)})) / nullif(len(past), 0), 6) AS {pct_column(s)}"
                       for s in p.lifecycle.labels)
    moving = ""
    if p.features.moving_average:
        moving = """, round(list_avg(near[-7:].list_transform(lambda x: x.f)), 6) AS avg_freq_d7,
       round(list_avg(list_transform(near, lambda x: x.f)), 6) AS avg_freq_d14,
       round(frequency / nullif(list_avg(near[-7:].list_transform(lambda x: x.f)), 0), 6) AS ratio_freq_d7,
       round(frequency / nullif(list_avg(list_transform(near, lambda x: x.f)), 0), 6) AS ratio_freq_d14"""
    return f"""WITH h AS (SELECT user_id, list({{'d': ref_date, 's': state, 'f': frequency}} ORDER BY ref_date) AS h FROM ({snapshots}) GROUP BY user_id),
seen AS (SELECT cutoff, user_id, list_filter(h, lambda x: x.d = cutoff - {off}) AS now, list_filter(h, lambda x: x.d = cutoff - 29) AS earlier,
              list_filter(h, lambda x: x.d < cutoff) AS past,
              list_filter(h, lambda x: x.d BETWEEN cutoff - {off + 13} AND cutoff - {off}) AS near FROM h, ({cuts})),
cur AS (SELECT *, now[1].s AS state_current, now[1].f AS frequency, earlier[1].s AS state_d28 FROM seen WHERE len(now) = 1),
grp AS (SELECT cutoff, state_current, avg(frequency) AS group_mean FROM cur GROUP BY ALL)
SELECT cutoff - 1 AS ref_date, cutoff, user_id, state_current, frequency, state_d28, {shares},
       round(group_mean, 6) AS avg_freq_group, round(frequency / nullif(group_mean, 0), 6) AS ratio_freq_group{moving}
FROM cur JOIN grp USING (cutoff, state_current)"""


def life_cycle_stores() -> dict:
    return {
        "fs_life_cycle": life_cycle_store(january(), dates("2024-01-30"), MAIN),
        "fs_life_cycle_refs": life_cycle_store(january(REFS), dates("2024-01-31"), REFS),
        "fs_life_cycle_daily": life_cycle_store(january(), every("2024-01-08", "2024-01-30"), MAIN),
        "fs_life_cycle_incremental": life_cycle_store(january(), dates("2024-01-30"), MAIN),
        "fs_life_cycle_backfill": life_cycle_store(january(), every("2024-01-08", "2024-01-30"), MAIN),
    }


# ----------------------------------------------------- labels, cohorts, ABT

def labels(snapshots: str, horizon: int, p: Preset = MAIN, keep: str = "TRUE", mature: bool = False) -> str:
    """Each snapshot is counted once for its own date and once, as the
    future, for the date ``horizon`` days before."""
    return f"""SELECT ref_date, user_id, state, future_state, (future_state IS NOT DISTINCT FROM {q(p.lifecycle.loyal)})::BIGINT AS label FROM (
  SELECT ref_date, user_id, max(now) AS state, max(later) AS future_state FROM (
    SELECT ref_date, user_id, state AS now, NULL AS later FROM ({snapshots}) UNION ALL
    SELECT ref_date - {horizon}, user_id, NULL, state FROM ({snapshots})
  ) GROUP BY ref_date, user_id
) WHERE state <> {q(p.lifecycle.zombie)} AND ({keep}){' AND future_state IS NOT NULL' if mature else ''}"""


COHORT_TRAIN = ("2024-01-04", "2024-01-26")
COHORT_OOT = ("2024-01-27", "2024-01-30")
ABT_CUTS = ("2024-01-05", "2024-01-31")
ABT_PRESET = MAIN.with_features(lc_current_offset=1)
LC_ORD_CUTS = ("1995-01-07", "2000-01-01")
WEEK = "ref_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-30'"


def cohort(label_q: str, k: int, seed: int, parts: dict) -> str:
    tag = pick([(t, f"ref_date BETWEEN DATE '{lo}' AND DATE '{hi}'") for t, (lo, hi) in parts.items()])
    return f"""SELECT ref_date, user_id, label, tag FROM (SELECT *, {tag} AS tag FROM ({label_q})) WHERE tag IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY tag, user_id ORDER BY md5('{seed}-' || user_id || '-' || ref_date), ref_date) <= {k}"""


def education_by_user(cuts: str, p: Preset) -> str:
    """Education store keyed by the loyalty user id (bridge id 'C<n>')."""
    return f'SELECT customer_id[2:]::BIGINT AS user_id, * EXCLUDE (customer_id, "user", cutoff) FROM ({education(cuts, p)})'


def joined(base: str, *stores: str, how: str = "LEFT") -> str:
    sql = f"SELECT * FROM ({base})"
    for i, s in enumerate(stores):
        sql += f"\n{how if i == 1 else 'LEFT'} JOIN ({s}) USING (user_id, ref_date)"
    return sql


def abt_sql(how: str = "LEFT") -> str:
    cuts = every(*ABT_CUTS)
    lab = labels(january(), 7, MAIN, WEEK)
    return joined(cohort(lab, 2, 42, {"ABT": COHORT_TRAIN, "OOT": COHORT_OOT}),
                  f"SELECT * EXCLUDE (cutoff) FROM ({transactional(fx.SQL_EV_THIN, cuts, ABT_PRESET, with_products=False)})",
                  f"SELECT * EXCLUDE (cutoff) FROM ({life_cycle_store(january(), cuts, ABT_PRESET)})",
                  education_by_user(cuts, ABT_PRESET), how=how)


def targets() -> dict:
    o = {}
    snaps = january()
    o["label_7d"] = labels(snaps, 7, MAIN, WEEK)
    o["label_7d_mature"] = labels(snaps, 7, MAIN, WEEK, mature=True)
    o["label_7d_extra_date"] = labels(snaps, 7, MAIN, "ref_date BETWEEN DATE '2024-01-04' AND DATE '2024-01-10' OR ref_date = DATE '2024-01-20'")
    o["label_28d_orders"] = labels(segmentation(fx.SQL_ORD, every("1998-01-05", "1999-12-20", "28 DAY")), 28)
    pairs = f"""SELECT a.ref_date AS t1_ref_date, a.user_id AS t1_user_id, a.state AS t1_state, b.ref_date AS t2_ref_date, b.state AS t2_state
FROM (FROM ({snaps}) WHERE ref_date = DATE '2024-01-01') a LEFT JOIN (FROM ({snaps}) WHERE ref_date = DATE '2024-01-08') b USING (user_id)"""
    o["label_pairs"] = pairs
    o["label_pairs_top"] = f"{pairs} ORDER BY t1_user_id LIMIT 10"
    o["cohort_sample"] = cohort(o["label_7d"], 2, 42, {"ABT": COHORT_TRAIN, "OOT": COHORT_OOT})
    o["abt"] = abt_sql()
    o["abt_with_life_cycle"] = abt_sql("INNER")
    one = dates("2000-01-01")
    o["fs_all"] = joined(f"SELECT * EXCLUDE (cutoff) FROM ({transactional(fx.SQL_ORD, one, REFS)})",
                         f"SELECT * EXCLUDE (cutoff) FROM ({life_cycle_store(segmentation(fx.SQL_ORD, every(*LC_ORD_CUTS), REFS), one, REFS)})",
                         education_by_user(one, REFS))
    return o


# ------------------------------------------------------ profiles and curves

PROFILE_COLS = ["frequency", "active_days_d28", "tx_life", "pts_pos_d28", "hours_d7", "gap_mean_life", "pct_02_fiel",
                "avg_freq_group", "days_since_activity", "n_in_progress"]
IMPUTED = {"frequency": 0, "gap_mean_life": 1000.0, "days_since_activity": 1000.0, "hours_d7": 0.0, "share_brand_1": 0.0,
           "pct_02_fiel": 0.0, "avg_freq_group": 1000.0, "tx_per_day_d28": 0.0}


def scaled(fv: str) -> str:
    """Min-max scaled frequency and value."""
    parts = ", ".join(f"coalesce(({c} - min({c}) OVER ()) / nullif((max({c}) OVER () - min({c}) OVER ())::DOUBLE, 0), 0.0) AS {c}_scaled"
                      for c in ("frequency", "points_pos"))
    return f"SELECT *, {parts} FROM ({fv})"


def profiles() -> dict:
    from loyalspark.plans.catalog import POLICY_SQL
    abt, o = abt_sql(), {}
    o["feature_null_rate"] = f"""SELECT feature, round(avg((v IS NULL)::INT), 6) AS null_rate
FROM (SELECT COLUMNS(* EXCLUDE (ref_date, user_id, label, tag))::VARCHAR FROM ({abt})) UNPIVOT INCLUDE NULLS (v FOR feature IN (COLUMNS(*)))
GROUP BY feature"""
    o["feature_profile"] = f"""SELECT r.feature, null_rate, null_rate > 0 AS has_null, policy_group, action, dtype, note, step
FROM ({o['feature_null_rate']}) r LEFT JOIN ({POLICY_SQL}) p ON regexp_matches(r.feature, p.pattern)
QUALIFY row_number() OVER (PARTITION BY r.feature ORDER BY step) = 1"""
    longer = " UNION ALL ".join(f"SELECT '{c}' AS feature, label, {c}::DOUBLE AS x FROM abt" for c in PROFILE_COLS)
    by_label = ", ".join(f"round({mean(f'CASE WHEN label = {v} THEN x END')}, 6) AS mean{v}, "
                         f"quantile_cont(x, 0.5) FILTER (label = {v}) AS m{v}" for v in (0, 1))
    o["feature_label_median_ratio"] = f"""WITH abt AS ({abt})
SELECT feature, mean0, mean1, round(m0, 6) AS median0, round(m1, 6) AS median1, round((m1 + 0.001) / (m0 + 0.001), 6) AS median_ratio
FROM (SELECT feature, {by_label} FROM ({longer}) GROUP BY feature)"""
    o["uninformative_features"] = f"SELECT feature FROM ({o['feature_label_median_ratio']}) WHERE median_ratio = 1 OR median_ratio IS NULL"
    o["out_of_time_sizes"] = f"""SELECT tag, count(*) AS n, CASE WHEN late THEN 'latest' ELSE 'before' END AS part
FROM (SELECT tag, ref_date = max(ref_date) OVER () AS late FROM ({abt})) GROUP BY ALL"""
    o["label_rate_by_state"] = f"SELECT state_current, count(*) AS n, round(avg(label), 6) AS label_rate FROM ({abt}) GROUP BY state_current"
    o["split_label_rate"] = f"SELECT tag, count(*) AS n, sum(label)::BIGINT AS positives, round(avg(label), 6) AS label_rate FROM ({abt}) GROUP BY tag"
    desc = ", ".join(f"""round({mean(c)}, 6) AS {c}_mean, round(stddev_samp({c}), 6) AS {c}_std, min({c})::DOUBLE AS {c}_min,
  round(quantile_cont({c}, 0.25), 6) AS {c}_p25, round(quantile_cont({c}, 0.5), 6) AS {c}_p50, round(quantile_cont({c}, 0.75), 6) AS {c}_p75,
  max({c})::DOUBLE AS {c}_max""" for c in ("frequency", "points_pos"))
    o["describe_by_cluster"] = f"""SELECT cluster, count(*) AS n, {desc} FROM ({segmentation(fx.SQL_ORD, dates('2000-01-01'))})
WHERE cluster IS NOT NULL GROUP BY cluster"""
    o["minmax_scale"] = f"""SELECT * REPLACE (round(frequency_scaled, 6) AS frequency_scaled, round(points_pos_scaled, 6) AS points_pos_scaled)
FROM ({scaled(clustered(frequency_value(fx.SQL_EV, '2024-01-31')))})"""
    points = f"""pts AS (SELECT cluster, frequency_scaled AS x, points_pos_scaled AS y FROM ({scaled(clustered(frequency_value(fx.SQL_EV_THIN, '2024-01-31')))})),
ctr AS (SELECT cluster, count(*) AS m, avg(x) AS cx, avg(y) AS cy FROM pts GROUP BY cluster),
dev AS (SELECT cluster, x, y, cx, cy, (x - cx) ** 2 + (y - cy) ** 2 AS d2 FROM pts JOIN ctr USING (cluster))"""
    o["calinski_harabasz"] = f"""WITH {points}
SELECT k::INT AS k, CASE WHEN k > 1 AND n > k AND within > 0 THEN round(((total - within) / (k - 1)) / (within / (n - k)), 6) END AS calinski_harabasz
FROM (SELECT count(*) AS n, count(DISTINCT cluster) AS k, sum(d2) AS within FROM dev),
     (SELECT var_pop(x) * count(*) + var_pop(y) * count(*) AS total FROM pts)"""
    o["davies_bouldin"] = f"""WITH {points}, s AS (SELECT cluster, cx, cy, avg(sqrt(d2)) AS s FROM dev GROUP BY ALL)
SELECT count(*)::INT AS k, round(avg(worst), 6) AS davies_bouldin FROM (
  SELECT a.cluster, max((a.s + b.s) / sqrt((a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2)) AS worst FROM s a, s b WHERE a.cluster <> b.cluster GROUP BY ALL)"""
    states = ", ".join(f"coalesce({c}, {q(NON_USER_MAIN)}) AS {c}" for c in ("state_current", "state_d28"))
    filled = ", ".join(f"round(coalesce({c}, {v}), 6) AS {c}" if isinstance(v, float) else f"coalesce({c}, {v}) AS {c}" for c, v in IMPUTED.items())
    o["impute_policy"] = f"SELECT ref_date, user_id, {states}, {filled} FROM ({abt}) WHERE age_days IS NOT NULL"
    onehot = ", ".join(f"(state_current = {q(v)})::BIGINT AS is_{re.sub('[^0-9a-zA-Z]+', '_', v).strip('_').lower()}"
                       for v in [*LIFECYCLE_LABELS_MAIN, NON_USER_MAIN])
    o["onehot_states"] = f"SELECT ref_date, user_id, state_current, {onehot} FROM ({o['impute_policy']})"
    o["stratified_split_sizes"] = f"""SELECT label, split, count(*) AS n FROM (
  SELECT label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42-' || user_id || '-' || ref_date), user_id, ref_date)
              <= round(0.2 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END AS split FROM ({abt})) GROUP BY ALL"""
    above = f"""WITH s AS (SELECT label, coalesce(pct_active_mau, 0.0) AS score FROM ({abt})), t AS (SELECT DISTINCT score AS threshold FROM s),
a AS (SELECT threshold, count(*) AS n, sum(label) AS pos FROM t JOIN s ON score >= threshold GROUP BY threshold),
w AS (SELECT count(*) AS all_n, sum(label) AS all_pos FROM s)
SELECT round(threshold, 6) AS threshold, """
    o["roc_curve"] = above + "round(pos / all_pos, 6) AS tpr, round((n - pos) / (all_n - all_pos), 6) AS fpr FROM a, w"
    o["lift_curve"] = above + "round(n / all_n, 6) AS population, round(pos / n, 6) AS precision, round((pos / n) / (all_pos / all_n), 6) AS lift FROM a, w"
    o["confusion"] = f"""SELECT label::BIGINT AS label, count(*) FILTER (coalesce(pct_active_mau, 0) < 0.5) AS pred_0,
       count(*) FILTER (pct_active_mau >= 0.5) AS pred_1 FROM ({abt}) GROUP BY label"""
    o["metrics_fixed_score"] = f"""WITH s AS (SELECT tag AS split, label, coalesce(pct_active_mau, 0.0) AS score FROM ({abt}))
SELECT split, accuracy, auc FROM (SELECT split, round(avg(((score >= 0.5)::INT = label)::INT), 6) AS accuracy FROM s GROUP BY split)
LEFT JOIN (SELECT split, round(avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END), 6) AS auc
      FROM (FROM s WHERE label = 1) p JOIN (FROM s WHERE label = 0) n USING (split) GROUP BY split) USING (split)"""
    o["wcss_one_cluster"] = f"""SELECT 1 AS k, round(var_pop(frequency_scaled) * count(*) + var_pop(points_pos_scaled) * count(*), 6) AS wcss
FROM ({scaled(clustered(frequency_value(fx.SQL_EV, '2024-01-31')))})"""
    o["baseline"] = f"""SELECT tag, count(*) AS n, round(avg(label), 6) AS base_rate, round(1 - avg(label), 6) AS accuracy_zero, 0.5::DOUBLE AS auc_constant
FROM ({abt}) GROUP BY tag"""
    return o


def build() -> dict:
    o = {}
    for part in (activity, segments, transactional_stores, transactional_blocks, education_stores, life_cycle_stores, targets, profiles):
        o.update(part())
    return o
