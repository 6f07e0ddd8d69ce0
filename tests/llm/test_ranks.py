import random

from llm_rows import shipped  # noqa: F401
from pyspark.sql import functions as F

from loyalspark.llm import common
from loyalspark.llm.ranks import BASE, ranked


def plain(rows):
    by = {}
    for g, k, v in rows:
        by.setdefault(g, []).append((k is not None, k or 0, v or 0))
    out = []
    for g, members in by.items():
        total = poly = 0
        members.sort()
        for i, (_, k, v) in enumerate(members):
            out.append((g, k, v, i, total, poly, (poly + v * pow(BASE, i, 1 << 64)) % (1 << 64), i == len(members) - 1))
            total += v
            poly = out[-1][6]
    return sorted(out, key=str)


def check(spark, rows, parts):
    frame = spark.createDataFrame(rows, "g string, k long, v long").repartition(7)
    staged = common.stage(spark, frame.withColumn("h", F.col("v")), "t")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = ranked(staged, "g", [F.col("k"), F.col("v")], sums=["v"], hashes=["h"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    word = 1 << 64
    got = [(r.g, r.k or 0, r.v or 0, r["rank"], r.v_before, r.h_before % word, r.h_upto % word, r.last) for r in got]
    assert sorted(got, key=str) == plain(rows)


def test_groups_over_many_tasks(spark):
    r = random.Random(3)
    # one group holds most rows, so it spans several tasks; null groups, places and values
    rows = [(r.choice(["hot"] * 8 + [None, "", "b", "c"]), r.choice([None, *range(300)]), r.randrange(-(1 << 40), 1 << 40)) for _ in range(900)]
    for parts in (1, 5, 23):
        check(spark, rows, parts)


def test_ties_one_group_and_empty(spark):
    check(spark, [("a", 1, 1)] * 40, 6)
    check(spark, [(None, None, None)] * 3, 4)
    check(spark, [("a", 1, 1)], 4)
    check(spark, [], 4)


def test_join_hot_keeps_all_rows(spark):
    left = common.stage(spark, spark.createDataFrame([("hot", i) for i in range(900)] + [(f"k{i % 40}", i) for i in range(300)] + [(None, 1)],
                                                     "k string, v long"), "left")
    right = common.stage(spark, spark.createDataFrame([("hot", 1), *[(f"k{i}", 2) for i in range(30)], ("none", 3)], "k string, w long"), "right")
    want = sorted(map(tuple, left.join(right, ["k"]).collect()))
    for share in (1, 3, 1000):
        assert sorted(map(tuple, common.join_hot(left, right, ["k"], share).select("k", "v", "w").collect())) == want
