"""k-means for every k at once: M3, M4, M5, M6 over one staged table of points.

An elbow, silhouette or index curve needs k-means for a whole range of k. Here
all of them, and several starts of each, advance together:

* equal points become one row with their number of rows as weight, written to
  the shared folder once;
* seeds of all starts are drawn by D^2 sampling, one scan for each further
  seed: a point's key is exponential with rate weight x D^2, from a hash of its
  coordinates, and the smallest key wins. The first k seeds of a start seed its
  run for k, so the draw serves every k and does not depend on the file layout;
* a Lloyd round is one scan for all runs that still move. Tasks hand over sums
  per (run, cluster), Spark merges them, and only those, at most
  starts x (1 + ... + max k) rows, reach the driver as new centres;
* the indices come from the last round's sums and one more scan.

Rows with a null or NaN coordinate are left out. With fewer distinct points
than k, each point is a cluster of its own. An empty table gives a sum of
squares of 0 and null indices.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loyalspark.sources.store import stage

STARTS = 4


@dataclass(frozen=True)
class Cluster:
    """Rows, centre used for labels, mean of its rows, and their mean squared
    distances to the centre and to the mean."""
    n: float
    centre: list
    mean: list
    cost: float
    variance: float


@dataclass(frozen=True)
class Sweep:
    """The best run of each k: its non-empty clusters and sum of squares."""
    points: DataFrame
    clusters: dict
    wcss: dict


def weighted_points(df: DataFrame, cols: list[str], seed: int) -> DataFrame:
    """(x0, x1, ..., w, h): distinct points, their numbers of rows and a hash."""
    # adding 0.0 makes -0.0 and 0.0 one point
    xs = [(F.col(c).cast("double") + F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(cols)]
    names = [f"x{i}" for i in range(len(cols))]
    whole = reduce(and_, (F.col(x).isNotNull() & ~F.isnan(x) for x in names))
    return df.select(*xs).filter(whole).groupBy(*names).agg(
        F.count(F.lit(1)).cast("double").alias("w")).withColumn("h", F.xxhash64(*names, F.lit(seed)))


def _seeds(points: DataFrame, dim: int, most: int, starts: int) -> list[list[list[float]]]:
    """Up to ``most`` seeds of every start, fewer if there are fewer points."""
    names = [f"x{i}" for i in range(dim)]
    chosen: list[list[list[float]]] = [[] for _ in range(starts)]

    def nearest_keys(step):
        def least(batches):
            import numpy as np
            import pyarrow as pa
            top = {}
            for b in batches:
                x = np.column_stack([b.column(n).to_numpy(zero_copy_only=False) for n in names])
                w, h = b.column("w").to_numpy(zero_copy_only=False), b.column("h").to_numpy(zero_copy_only=False)
                for s in range(starts):
                    with np.errstate(over="ignore", divide="ignore"):
                        z = h.view(np.uint64) + np.uint64((s * most + step + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
                        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
                        u = (((z ^ (z >> np.uint64(31))) >> np.uint64(11)) + 0.5) / 2.0 ** 53
                        rate = w
                        if chosen[s]:
                            rate = w * np.min([((x - np.array(c)) ** 2).sum(1) for c in chosen[s]], axis=0)
                        key = np.where(rate > 0, -np.log(u) / rate, np.inf)
                    i = min(np.flatnonzero(key == key.min()), key=lambda i: tuple(x[i]))
                    if np.isfinite(key[i]):
                        top[s] = min(top.get(s, (np.inf,)), (float(key[i]), *x[i].tolist()))
            if top:
                cols = list(zip(*[(s, *v) for s, v in top.items()]))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.float64()) for i, c in enumerate(cols)],
                                                 names=["s", "key", *names])
        return least

    schema = "s int, key double, " + ", ".join(f"{n} double" for n in names)
    for step in range(most):
        found = points.mapInArrow(nearest_keys(step), schema).groupBy("s").agg(F.min(F.struct("key", *names)).alias("at")).collect()
        for r in found:
            chosen[r["s"]].append([r["at"][n] for n in names])
        # the distinct points of every start are used up at the same step
        if not found:
            break
    return chosen


def _scan(points: DataFrame, dim: int, width: int, per_run: dict, sums) -> dict:
    """One scan: {run: {cluster: sums}}. ``sums(x, w, model)`` gives, for a
    batch of points, one row of ``width`` numbers per cluster of a run."""
    names = [f"x{i}" for i in range(dim)]

    def totals(batches):
        import numpy as np
        import pyarrow as pa
        total = {}
        for b in batches:
            x = np.column_stack([b.column(n).to_numpy(zero_copy_only=False) for n in names])
            w = b.column("w").to_numpy(zero_copy_only=False)
            for run, model in per_run.items():
                got = sums(x, w, model)
                total[run] = total[run] + got if run in total else got
        rows = [(run, j, *v) for run, t in total.items() for j, v in enumerate(t.tolist())]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int32(), *[pa.float64()] * width])],
                names=["run", "j", *[f"v{i}" for i in range(width)]])

    schema = "run int, j int, " + ", ".join(f"v{i} double" for i in range(width))
    out: dict = {run: {} for run in per_run}
    for r in (points.mapInArrow(totals, schema).groupBy("run", "j")
              .agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(width)]).collect()):
        out[r["run"]][r["j"]] = list(r[2:])
    return out


def _label_sums(dim: int):
    def sums(x, w, centres):
        import numpy as np
        c = np.array(centres)
        d2 = sum((x[:, i, None] - c[None, :, i]) ** 2 for i in range(dim))
        j = d2.argmin(1)
        count = lambda v: np.bincount(j, weights=v, minlength=len(c))
        return np.column_stack([count(w), count(w * d2[np.arange(len(j)), j]), *[count(w * x[:, i]) for i in range(dim)]])
    return sums


def _index_sums(dim: int):
    def sums(x, w, clusters):
        import numpy as np
        centre, mean = np.array([c[0] for c in clusters]), np.array([c[1] for c in clusters])
        variance, n = np.array([c[2] for c in clusters]), np.array([c[3] for c in clusters])
        square = lambda m: sum((x[:, i, None] - m[None, :, i]) ** 2 for i in range(dim))
        at = np.arange(len(x))
        j = square(centre).argmin(1)
        to_mean = square(mean)
        # mean squared distance to the rows of a cluster = that to its mean + its variance
        far = to_mean + variance
        own = far[at, j] * n[j] / np.maximum(n[j] - 1, 1)
        far[at, j] = np.inf
        other = far.min(1)
        top = np.maximum(own, other)
        with np.errstate(invalid="ignore", divide="ignore"):
            s = np.where((n[j] > 1) & (top > 0) & np.isfinite(other), (other - own) / top, 0.0)
        count = lambda v: np.bincount(j, weights=v, minlength=len(n))
        return np.column_stack([count(w * np.sqrt(to_mean[at, j])), count(w * s)])
    return sums


def sweep(df: DataFrame, cols: list[str], ks, seed: int = 42, max_iter: int = 1000, tol: float = 1e-4,
          starts: int = STARTS) -> Sweep:
    """k-means of ``cols`` for every k of ``ks``: of each k the best of
    ``starts`` runs. A run rests when its centres' squared moves sum to ``tol``
    x the mean variance of the columns or less, or after ``max_iter`` rounds;
    its labels are those of the centres where it rests."""
    ks, dim = sorted({int(k) for k in ks}), len(cols)
    if not ks or ks[0] < 1:
        raise ValueError("k must be 1 or more")
    points = stage(weighted_points(df, cols, seed), "kmeans-points")
    seeds = _seeds(points, dim, ks[-1], starts)
    if not seeds[0]:
        return Sweep(points, {k: [] for k in ks}, {k: 0.0 for k in ks})
    runs = [(k, s) for k in ks for s in range(starts)]
    centres = {i: seeds[s][:k] for i, (k, s) in enumerate(runs)}
    moving, resting, done, limit = set(centres), set(), {}, None
    for step in range(max_iter + 1):
        got = _scan(points, dim, 2 + dim, {i: centres[i] for i in moving | resting}, _label_sums(dim))
        if limit is None:
            limit = tol * _mean_variance(got[0], centres[0], dim)
        for i, by in got.items():
            clusters, after, moved = [], [], 0.0
            for j, c in enumerate(centres[i]):
                n, cost, *total = by[j]
                # a cluster without points keeps its centre
                mean = [t / n for t in total] if n > 0 else c
                shift = math.dist(mean, c)
                moved += shift * shift
                after.append(mean)
                if n > 0:
                    clusters.append(Cluster(n, c, mean, cost / n, max(cost / n - shift * shift, 0.0)))
            done[i] = clusters
            if i in moving:
                centres[i] = after
                if moved <= limit:
                    moving.discard(i)
                    resting.add(i)
            else:
                resting.discard(i)
        if step + 1 == max_iter:
            resting, moving = moving | resting, set()
        if not moving and not resting:
            break
    cost = {i: sum(c.n * c.cost for c in clusters) for i, clusters in done.items()}
    best = {k: min((i for i, r in enumerate(runs) if r[0] == k), key=lambda i: (cost[i], i)) for k in ks}
    return Sweep(points, {k: done[i] for k, i in best.items()}, {k: cost[i] for k, i in best.items()})


def _mean_variance(by: dict, centres: list, dim: int) -> float:
    """Mean variance of the columns, from the sums of any one run: the
    clusters' costs about their means and the spread of those means."""
    n = sum(v[0] for v in by.values())
    mid = [sum(v[2 + i] for v in by.values()) / n for i in range(dim)]
    total = 0.0
    for j, (m, cost, *sums) in by.items():
        if m > 0:
            mean = [t / m for t in sums]
            total += cost - m * math.dist(mean, centres[j]) ** 2 + m * math.dist(mean, mid) ** 2
    return max(total, 0.0) / n / dim


def indices(result: Sweep, dim: int) -> dict[int, tuple]:
    """{k: (calinski_harabasz, davies_bouldin, silhouette)} of the best runs, in
    one more scan. The silhouette is on squared Euclidean distances; a row that
    is alone in its cluster counts as 0."""
    models = {k: [(c.centre, c.mean, c.variance, c.n) for c in cl] for k, cl in result.clusters.items() if len(cl) > 1}
    out: dict[int, tuple] = {k: (None, None, None) for k in result.clusters}
    if not models:
        return out
    got = _scan(result.points, dim, 2, models, _index_sums(dim))
    for k, by in got.items():
        cl, m = result.clusters[k], len(result.clusters[k])
        n = sum(c.n for c in cl)
        within = sum(c.n * c.variance for c in cl)
        mid = [sum(c.n * c.mean[i] for c in cl) / n for i in range(dim)]
        between = sum(c.n * math.dist(c.mean, mid) ** 2 for c in cl)
        ch = (between / (m - 1)) / (within / (n - m)) if n > m and within > 0 else None
        spread = [by[j][0] / c.n for j, c in enumerate(cl)]
        worst = [max((spread[a] + spread[b]) / math.dist(cl[a].mean, cl[b].mean)
                     for b in range(m) if b != a and cl[a].mean != cl[b].mean) for a in range(m)]
        out[k] = (ch, sum(worst) / m, sum(by[j][1] for j in range(m)) / n)
    return out
