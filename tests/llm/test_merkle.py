import hashlib
import random
import zlib

import duckdb
from llm_rows import CLASHES, LONG, shipped  # noqa: F401
from pyspark.sql import functions as F

from loyalspark.llm import common, merkle
from loyalspark.llm.oracle import OP12
from loyalspark.llm.queries import op12_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings of each leaf by level) by plain recursion."""
    steps = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for lo in range(0, len(nodes), 16):
            run = nodes[lo: lo + 16]
            for j in range(len(run)):
                for i in under[lo + j]:
                    steps[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(h(*run))
            groups.append([i for u in under[lo: lo + 16] for i in u])
        nodes, under = up, groups
    return nodes[0], steps


def plain(rows):
    """rows: (id, source, leaf) -> (id, leaf, subroot, root, steps)"""
    by = {}
    for i, s, d in rows:
        by.setdefault(s, []).append((i is not None, i or 0, d, i))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    subs = {s: tree([m[2] for m in sorted(by[s], key=lambda m: m[:3])]) for s in order}
    root, upper = tree([subs[s][0] for s in order])
    out = []
    for s, up in zip(order, upper):
        for m, steps in zip(sorted(by[s], key=lambda m: m[:3]), subs[s][1]):
            out.append((m[3], m[2], subs[s][0], root, tuple(steps + up)))
    return sorted(out, key=str)


def run(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, source string, leaf string").selectExpr("*", *CLASHES)
    staged = common.stage(spark, frame.repartition(5), "t")
    out = merkle.manifest(staged, "source", "doc_id", "leaf")
    folded = out.withColumn("folded", merkle.fold(F.col("leaf"), F.col("witness"))).collect()
    assert all(r.folded == r.root for r in folded)
    assert {c.split()[-1] for c in CLASHES} <= set(out.columns)
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.witness)) for r in folded), key=str)


def test_appender_is_the_tree():
    for n in (1, 2, 15, 16, 17, 31, 32, 255, 256):
        nodes = [h(str(i)) for i in range(n)]
        a = merkle.Appender()
        for x in nodes:
            a.append(x)
        assert a.close(alone=True)[1] == tree(nodes)[0]


def test_against_recursion(spark):
    r = random.Random(1)
    # sizes around a run (16), a block (256) and a block of blocks; twenty groups take two levels of groups
    sizes = {"big": 5000, "b": 1, "c": 16, "d": 17, "e": 256, "f": 257, None: 300, "": 3, "é": 2, **{f"s{i}": 1 for i in range(20)}}
    rows = [(i, s, h(f"{s}{i}")) for s, n in sizes.items() for i in r.sample(range(100_000), n)]
    assert run(spark, rows) == plain(rows)


def test_ties_and_odd_rows(spark):
    rows = [(1, "a", h("x"))] * 20 + [(1, "a", h("y")), (None, "a", h("z")), (None, None, h("z")), (None, None, h("z"))]
    assert run(spark, rows) == plain(rows)
    assert run(spark, [(5, "a", h("x"))]) == [(5, h("x"), h("x"), h("x"), ())]
    assert run(spark, []) == []


def test_leaf_tells_fields_apart(spark):
    row = spark.createDataFrame([("1", "a-", "a", "-"), ("-1", None, "é", "")], "a string, b string, c string, d string")
    got = [r[0] for r in row.select(merkle.leaf(*map(F.col, "abcd"))).collect()]
    assert got == [h("1:1", "2:a-", "1:a", "1:-"), h("2:-1", "-", "2:é", "0:")]


def test_query_on_odd_tables(spark, scratch):
    """Against the SQL and against plain Python, with tampered rows."""
    docs = [(i, "Text %d" % i if i % 3 else None, "en" if i % 4 else None, "s%d" % (i % 3) if i % 5 else None, i if i % 2 else None) for i in range(700)]
    docs += [(7, "Text 7", "en", "s1", 7)] * 2 + [(None, "NO ID", None, None, None), (701, LONG.upper(), "de", "s1", 1), (702, "", "", "", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS leaf", "'x' AS root", "2 AS rank").coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    got = sorted((tuple(r) for r in op12_merkle_manifest(spark, scratch).collect()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    sql = [r for r in con.execute(OP12).fetchall()]
    # without an id there is no checksum: the SQL's CRC is null and the row untouched
    assert got == sorted(sql, key=str)
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    want = plain([(d[0], d[3], h(*[field(v) for v in (d[0], d[3], d[2], d[4], d[1])])) for d in docs])
    assert [r[:4] for r in got] == [w[:4] for w in want]
    assert [r[4] for r in got] == [h(*[a + b for a, b in w[4]]) for w in want]
    bad = {r[0] for r in got if not r[6]}
    assert bad == {d[0] for d in docs if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0 and d[1] and d[1] != d[1].lower()}
