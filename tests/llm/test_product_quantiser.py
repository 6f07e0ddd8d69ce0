import math

import numpy as np
import pytest
from llm_rows import SF01, shipped  # noqa: F401

from loyalspark.llm import common, product_quantiser as P
from loyalspark.llm.queries import op13_embedding_near_dedup

COLUMNS = ["vec_id", "n_links", "component_id", "kept"]


def plain(rows, threshold=0.95):
    """All pairs: (id, links, component, kept), sorted."""
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, label = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for size in {len(rows[i][1]) for i in good}:
        at = [i for i in good if len(rows[i][1]) == size]
        x = np.array([rows[i][1] for i in at], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            links[at[a]] += 1
            links[at[b]] += 1
            i, j = top(at[a]), top(at[b])
            label[i] = j
    least = {}
    for i in good:
        least[top(i)] = min(least.get(top(i), rows[i][0]), rows[i][0])
    out = [(k, links[i], least[top(i)] if i in set(good) else k) for i, (k, _) in enumerate(rows)]
    return sorted([(k, n, c, k == c) for k, n, c in out], key=str)


def run(spark, rows, kind="double", **more):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr(
        "*", "1 AS label", "'x' AS id", "2 AS cid", "3 AS weight", "4 AS v", "5 AS list").repartition(4)
    return sorted((tuple(r[c] for c in COLUMNS) for r in P.near_vectors(frame, **more).collect()), key=str)


def noisy(r, centre, n, least, most):
    """n vectors at cosines between least and most of the centre."""
    z = r.standard_normal((n, len(centre)))
    z -= (z @ centre)[:, None] * centre
    z /= np.linalg.norm(z, axis=1)[:, None]
    c = r.uniform(least, most, n)[:, None]
    return c * centre + np.sqrt(1 - c * c) * z


@pytest.fixture(scope="module")
def hot_rows():
    """A third of the rows about one vector, a group as wide as the threshold,
    chains, exact copies and far vectors."""
    r = np.random.default_rng(4)
    far = r.standard_normal((700, 24))
    far /= np.linalg.norm(far, axis=1)[:, None]
    tight = noisy(r, far[0], 400, 0.988, 0.9999)
    wide = noisy(r, far[1], 150, 0.95, 0.99)
    chain = [far[2]]
    for _ in range(30):
        chain.append(noisy(r, chain[-1] / np.linalg.norm(chain[-1]), 1, 0.955, 0.96)[0])
    all_ = np.concatenate([far, tight, wide, np.array(chain), far[5:25], far[5:15]]) * r.uniform(0.1, 9, (1311, 1))
    all_[-30:-10] = all_[5:25]
    all_[-10:] = all_[5:15]
    return [(int(i), v.tolist()) for i, v in zip(r.permutation(1311), all_)]


def test_one_list_finds_all(spark, hot_rows):
    assert run(spark, hot_rows) == plain(hot_rows)


def test_many_lists_recall(spark, hot_rows, monkeypatch):
    """Small lists, blocks and a small sample: recall over links, none wrong."""
    monkeypatch.setattr(P, "LIST", 16)
    monkeypatch.setattr(P, "BLOCK", 50)
    monkeypatch.setattr(P, "TRAIN_VECTORS", 900)
    got, want = run(spark, hot_rows), plain(hot_rows)
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)


def test_coding_error_never_hides_a_link():
    r = np.random.default_rng(0)
    x = r.standard_normal((3000, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = np.concatenate([noisy(r, v, 1, 0.95, 0.97) for v in x])
    index = P.Index(x, 3000, 0.95)
    assert len(index.coarse[0]) > 1
    lists = index.lists(y)[:, 0]
    codes, error = index.encode(y, lists)
    for number in np.unique(lists):
        at = np.flatnonzero(lists == number)
        may = index.candidates(x, index.centre(np.array([number])), codes[at], error[at])
        assert may[(x @ y[at].T) >= 0.95].all() and may.mean() < 0.9


def test_lists_are_the_nearest(spark):
    r = np.random.default_rng(3)
    x = r.standard_normal((500, 8))
    index = P.Index(x / np.linalg.norm(x, axis=1)[:, None], 500 * 64, 0.95)
    got = index.lists(x, 9)
    k = len(index.coarse[1])
    d = P.squares(x, index.centre(np.arange(len(index.coarse[0]) * k)))
    assert np.allclose(np.take_along_axis(d, got, 1), np.sort(d, axis=1)[:, :9])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]),
            (9, [1.0, 0.0, 0.0]), (10, [5.0, -0.0, 0.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (None, None), (12, [1e-300, 1e-301]), (13, [1e300, 1e299]),
            (14, [0.0, 1.0]), (7, [0.0, 1.0])]
    want = plain([(k, [x / 1e300 for x in v] if k == 13 else [x * 1e300 for x in v] if k == 12 else v) for k, v in rows])
    assert run(spark, rows) == want
    assert run(spark, [(1, [1.0])]) == [(1, 0, 1, True)]
    assert run(spark, []) == []


def test_query_against_all_pairs(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF01}/embeddings.parquet").collect()]
    got = op13_embedding_near_dedup(spark, SF01)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_components_with_a_hub(spark):
    links = [(0, i) for i in range(1, 1500)] + [(2000 + i, 2001 + i) for i in range(60)] + [(5, 2000), (9, 9)]
    frame = common.stage(spark, spark.createDataFrame(links, "a long, b long"), "t")
    got = {r.node: r.label for r in P.components(spark, frame).collect()}
    assert got == {**{i: 0 for i in range(1500)}, **{2000 + i: 0 for i in range(61)}}
