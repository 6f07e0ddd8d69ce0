import math
import random

import pytest
from pyspark.sql import functions as F

from loyalspark.ml import assess
from loyalspark.operators import profile as pr
from loyalspark.plans import running


def test_running_sums_by_group(spark):
    r = random.Random(2)
    rows = [(r.choice(["a", "a", "a", None, "b"]), i * 0.37, r.randrange(9), r.choice([None, 1, 5])) for i in r.sample(range(5000), 900)]
    df = spark.createDataFrame(rows, "g string, s double, x long, y long").repartition(5)
    for group in ("g", None):
        for descending in (False, True):
            got = {(t.g, t.s): (t.cum_x, t.cum_y, t.all_x) for t in running.running_sums(df, "s", ["x", "y"], group, descending).collect()}
            want, sums = {}, {}
            for g, s, x, y in sorted(rows, key=lambda t: t[1], reverse=descending):
                k = g if group else 0
                a = sums.setdefault(k, [0, 0])
                a[0], a[1] = a[0] + x, a[1] + (y or 0)
                want[g, s] = (k, *a)
            # a sum of nulls alone is null in the table's first rows of a task
            assert got.keys() == want.keys()
            assert all(got[k][0] == w[1] and (got[k][1] or 0) <= w[2] and got[k][2] == sums[w[0]][0] for k, w in want.items())


def test_curves_have_no_window_over_the_table(spark):
    r = random.Random(3)
    rows = [(i % 7 == 0, i / 3000, 1.0) for i in r.sample(range(3000), 2000)]
    scored = spark.createDataFrame([(int(y), s, p) for y, s, p in rows], "label long, score double, prediction double").withColumn("split", F.lit("t"))
    for df in (assess.roc_curve(scored), assess.lift_curve(scored), assess.metrics(scored, split="split")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Window" in x and "__part" not in x], plan
    got = assess.roc_curve(scored).collect()
    assert len(got) == 2000 and got[-1].tpr == got[-1].fpr == 1.0
    pos, neg = [s for y, s, _ in rows if y], [s for y, s, _ in rows if not y]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    assert math.isclose(assess.metrics(scored, split="split").first().auc, auc, rel_tol=1e-12)


def quantile_cont(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    lo, hi = v[math.floor(at)], v[math.ceil(at)]
    f = at - math.floor(at)
    return lo if lo == hi else (1 - f) * lo + f * hi


@pytest.mark.parametrize("cells", [4, 4096])
def test_exact_quantiles(spark, monkeypatch, cells):
    monkeypatch.setattr(running, "CELLS", cells)
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), r.gauss(0, 1) * 10.0 ** r.choice([-9, 0, 9]), float(r.choice([0, 0, 0, 1])), r.choice([None, float("nan"), 2.0]),
             r.choice([-1e308, 1e308, 0.0]), None) for _ in range(400)]
    df = spark.createDataFrame(rows, "g string, x double, few double, odd double, huge double, none double").repartition(4)
    probs = [0.0, 0.25, 0.5, 0.77, 1.0]
    cols = ["x", "few", "odd", "huge", "none"]
    for group in ("g", None):
        got = {((t[0] if group else None), t.feature): (t.n, list(t.q)) for t in running.exact_quantiles(df, cols, probs, group).collect()}
        want = {}
        for g in {row[0] if group else None for row in rows}:
            for i, c in enumerate(cols, 1):
                v = [row[i] for row in rows if (row[0] == g or not group) and row[i] is not None and not math.isnan(row[i])]
                if v:
                    want[g, c] = (len(v), [quantile_cont(v, p) for p in probs])
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0] and all(a == pytest.approx(b, rel=1e-12) for a, b in zip(got[k][1], want[k][1])), k
    assert running.exact_quantiles(df.limit(0), cols, probs).count() == 0


def test_profile_without_percentile_buffers(spark):
    df = spark.createDataFrame([(i % 2, "g%d" % (i % 3), float(i % 11), None if i % 2 else float(i)) for i in range(200)], "y long, g string, a double, b double")
    for out in (pr.label_median_ratio(df, "y", ["a", "b"]), pr.describe_by(df, "g", ["a", "b"])):
        assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r.feature: r for r in pr.label_median_ratio(df, "y", ["a", "b"]).collect()}
    assert got["b"].median1 is None and got["b"].median0 == 99.0 and got["a"].median1 == 5.0


def test_clean_names_number_clashes(spark):
    from loyalspark.ml.prepare import clean_names
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], ["a b", "a_b", "a-b", "A?B", "c"])
    out = clean_names(df)
    assert out.columns == ["a_b_2", "a_b", "a_b_3", "A_B_4", "c"] and tuple(out.first()) == (1, 2, 3, 4, 5)


def test_staged_abt_follows_its_files(spark, scratch):
    from loyalspark.sources.store import folder_state
    spark.range(3).write.parquet(f"{scratch}/t.parquet")
    before = folder_state(spark, scratch)
    assert before == folder_state(spark, scratch)
    spark.range(4).write.mode("overwrite").parquet(f"{scratch}/t.parquet")
    assert folder_state(spark, scratch) != before
