import hashlib

import pyarrow as pa
from llm_rows import CLASHES, ODD, frame, shipped  # noqa: F401

from loyalspark.llm import common
from loyalspark.llm import exact_dedup as E

ROWS = [*ODD, *((100 + i, f"copy {i % 3}") for i in range(60)), (300, "copy 1"), (9, "copy 1")]


def groups(rows, keep=max):
    by = {}
    for i, t in rows:
        by.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in by[t or ""] if x is not None]
        best = keep(ids) if ids else None
        out.append((i, best, len(by[t or ""]), i == best, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_groups(frame):
    for keep, f in (("largest", max), ("smallest", min)):
        got = E.exact_groups(frame(ROWS), keep=keep).collect()
        assert sorted(map(tuple, got), key=str) == groups(ROWS, f)


def test_tree_of_several_rounds(frame):
    rows = E.digests(frame(ROWS).repartition(23))
    flat = {tuple(r) for r in E.tree_merge(rows, leaves=1, fan_in=2).select("proof", "keep_id", "group_size").collect()}
    deep = {tuple(r) for r in E.tree_merge(rows, leaves=32, fan_in=2).select("proof", "keep_id", "group_size").collect()}
    assert flat == deep and len(flat) == len({t or "" for _, t in ROWS})


def test_rounds_sort_and_merge_runs(frame):
    plan = E.tree_merge(E.digests(frame(ROWS)), leaves=256, fan_in=16)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == plan.count("Sort [node") == 3 and plan.count("Exchange hashpartitioning(node") == 2
    assert "Aggregate" not in plan


def test_merge_across_batches():
    rows = [(0, bytes([d]), 1, 7, i) for d in (1, 2, 2, 2, 2, 3) for i in (9, 4)] + [(1, b"\x03", 1, 7, 1), (1, b"\x03", 1, 8, 1)]
    schema = pa.schema([("node", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int32()), ("proof", pa.int64()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64())])
    want = [(0, 1, 7, 9, 2), (0, 2, 7, 9, 8), (0, 3, 7, 9, 2), (1, 3, 7, 1, 1), (1, 3, 8, 1, 1)]
    for size in (1, 2, 3, 5, 50):
        parts = [rows[k: k + size] for k in range(0, len(rows), size)] + [[]]
        batches = [pa.RecordBatch.from_arrays([pa.array([*c], f.type) for c, f in zip(zip(*[(*r, 1) for r in part]) if part else [()] * 6, schema)],
                                              schema=schema) for part in parts]
        got = [r for b in E._merge(iter(batches)) for r in b.to_pylist()]
        assert [(r["node"], r["digest"][0], r["proof"], r["keep_id"], r["group_size"]) for r in got] == want


def test_one_text_in_most_rows(frame):
    rows = [(i, "the same" if i % 3 else f"text {i}") for i in range(3000)]
    got = {r.doc_id: (r.keep_id, r.group_size) for r in E.exact_groups(frame(rows)).collect()}
    assert got == {i: (2999, 2000) if i % 3 else (i, 1) for i in range(3000)}


def test_dedup_keeps_rows_whole(frame, monkeypatch):
    want = set()
    for i, _, _, kept, _ in groups(ROWS):
        if kept:
            want.add(i)
    for bound in (common.MAX_BROADCAST_IDS, 0):
        monkeypatch.setattr(common, "MAX_BROADCAST_IDS", bound)
        got = E.exact_dedup(frame(ROWS))
        assert got.columns == ["doc_id", "text", *[c.split()[-1] for c in CLASHES]]
        ids = [r.doc_id for r in got.collect()]
        assert set(ids) == want and len(ids) == len(want)
        assert [r.text for r in got.filter("doc_id is null").collect()] == ["no id"]


def test_empty(frame):
    assert E.exact_groups(frame([])).count() == 0
    assert E.exact_dedup(frame([])).count() == 0
