import hashlib
import random

import duckdb
import numpy as np
import pytest
from llm_rows import LONG, shipped  # noqa: F401

from loyalspark.llm import common, prefix_trie
from loyalspark.llm.oracle import OP11
from loyalspark.llm.queries import op11_conversation_trie


def plain(convs):
    """convs: {id: [(turn, words)]} -> rows of the trie, walked top down."""
    out = []

    def walk(members, depth, parent):
        least = min(members)
        ends = sorted(c for c in members if len(convs[c]) == depth)
        kids = {}
        for c in members:
            if len(convs[c]) > depth:
                kids.setdefault(convs[c][depth][0], []).append(c)
        words = convs[least][depth - 1][1] if depth else 0
        leaves, saved = (0, 0) if kids else (1, 0)
        saved += (len(members) - 1) * words
        for k in kids.values():
            below = walk(k, depth + 1, least)
            leaves, saved = leaves + below[0], saved + below[1]
        out.append((least, depth, parent, len(members), len(kids), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
        return leaves, saved

    if convs:
        walk(list(convs), 0, None)
    return sorted(out, key=str)


def trie(spark, convs):
    rows = [(c, None, 0, 0, 0) for c in convs]
    for c, turns in convs.items():
        for k, (name, words) in enumerate(turns):
            d = hashlib.sha256(name.encode()).digest()
            rows.append((c, k, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:16], "big", signed=True), words))
    frame = spark.createDataFrame(rows, "conv_id long, place long, t1 long, t2 long, tokens long").repartition(6)
    got = prefix_trie.prefix_trie(common.stage(spark, frame, "t")).collect()
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got), key=str)


@pytest.fixture(scope="module")
def shared_convs():
    """Copies, prefixes of one another, a first turn that half of them share,
    turns in changed order, no turns, and one long conversation."""
    r = random.Random(5)
    size = {t: 1 + i for i, t in enumerate("abcdefgh")}
    convs = {}
    for c in r.sample(range(-50, 5000), 400):
        turns = (["a"] if r.random() < 0.5 else []) + [r.choice("abcdefgh") for _ in range(r.choice([0, 0, 1, 2, 3, 5]))]
        convs[c] = [(t, size[t]) for t in turns]
    convs |= {c: [("x", 2), ("y", 3)] for c in range(6000, 6900)}
    convs[7000] = [(f"long {i}", i) for i in range(700)]
    convs[7001] = convs[7000][:500]
    convs[7002] = convs[7000]
    return convs


def test_against_walk(spark, shared_convs):
    assert trie(spark, shared_convs) == plain(shared_convs)


def test_small_sketch_loses_nothing(spark, shared_convs, monkeypatch):
    """A sketch of 64 cells a row takes everything for shared."""
    monkeypatch.setattr(prefix_trie, "MAX_CELLS", 128)
    some = {c: t for c, t in shared_convs.items() if c < 6100}
    assert trie(spark, some) == plain(some)


def test_sketch_never_counts_too_few(spark):
    r = np.random.default_rng(1)
    names = r.integers(-(1 << 62), 1 << 62, (500, 2))
    picks = np.concatenate([np.arange(500), r.integers(0, 60, 300)])
    frame = spark.createDataFrame([(1, int(a), int(b)) for a, b in names[picks]], "depth long, p1 long, p2 long").repartition(70)
    staged = common.stage(spark, frame, "t")
    for width in (64, 1 << 18):
        rows = prefix_trie.sketch(staged, width)
        cells = prefix_trie._cells(np.ones(500, np.int64), names[:, 0].copy(), names[:, 1].copy(), width)
        estimate = np.minimum.reduce([row[c] for row, c in zip(rows, cells)])
        assert (estimate >= np.minimum(2, np.bincount(picks, minlength=500))).all()
    assert (estimate == 1).sum() > 400


def test_small_tables(spark):
    assert trie(spark, {}) == []
    for convs in ({5: []}, {5: [("a", 1)]}, {5: [("a", 1)], 6: [("a", 1)]}, {1: [], 2: []}):
        assert trie(spark, convs) == plain(convs)


def test_query_on_odd_tables(spark, scratch):
    r = random.Random(2)
    rows = []
    for c in range(0, 260):
        if c % 20 == 0 and c > 200:
            continue  # its base is absent
        for k in range(r.choice([1, 2, 3, 6])):
            rows.append((c, k if c % 7 else None, r.choice(["user", "assistant", None]), r.choice(["hi there", "hi  there", "", None, "a b\tc"])))
    rows += [(9, 1, "user", "again")] * 2 + [(None, 0, "user", "no conversation"), (300, 0, "user", LONG), (321, 0, "user", LONG), (-3, 1, "user", "minus")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS depth", "2 AS rank", "'x' AS tokens", "3 AS t1").repartition(3).write.parquet(f"{scratch}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{scratch}/conversations.parquet/*.parquet')")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = sorted((tuple(x[c] for c in cols) for x in op11_conversation_trie(spark, scratch).collect()), key=str)
    want = con.execute(OP11)
    assert [d[0] for d in want.description] == cols
    assert got == sorted(want.fetchall(), key=str) and len(got) > 300
