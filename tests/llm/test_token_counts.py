import re

import pytest
from llm_rows import ODD, frame, shipped  # noqa: F401
from pyspark.sql import functions as F

from loyalspark.llm import token_counts as C


@pytest.fixture()
def rollup(spark, scratch):
    return C.Rollup(spark, f"{scratch}/rollup")


def rows(spark, *r):
    return spark.createDataFrame(list(r), "source string, lang string, n long")


def have(rollup):
    return {tuple(r) for r in rollup.totals().collect()}


def test_deltas_add_up(spark, rollup):
    n = {"v1": F.col("n")}
    assert have(rollup) == set()
    a = rows(spark, ("s", "en", 5), ("s", "en", 7), (None, None, 1), ("t", "de", 9))
    rollup.commit("1", C.inserts(a, n))
    assert have(rollup) == {("s", "en", "v1", 2, 12), (None, None, "v1", 1, 1), ("t", "de", "v1", 1, 9)}
    rollup.commit("2", C.deletes(rows(spark, ("s", "en", 5), ("t", "de", 9)), n))
    rollup.commit("3", C.revisions(rows(spark, ("s", "en", 7)), n, {"v1": F.col("n") + 1}))
    rollup.commit("4", C.inserts(rows(spark, ("s", "en", 3)), {"v2": F.col("n"), "v3": F.lit(None)}))
    assert have(rollup) == {("s", "en", "v1", 1, 8), (None, None, "v1", 1, 1), ("s", "en", "v2", 1, 3), ("s", "en", "v3", 1, 0)}


def test_commits_are_idempotent_and_survive_compaction(spark, rollup):
    n = {"v1": F.col("n")}
    one, two = C.inserts(rows(spark, ("s", "en", 5)), n), C.inserts(rows(spark, ("s", "en", 2)), n)
    for _ in range(2):
        rollup.commit("one", one)
    assert have(rollup) == {("s", "en", "v1", 1, 5)}
    rollup.compact()
    rollup.commit("one", one)  # a replay after compaction
    assert have(rollup) == {("s", "en", "v1", 1, 5)}
    rollup.commit("two", two)
    rollup.compact()
    rollup.commit("one", one)
    assert have(rollup) == {("s", "en", "v1", 2, 7)}
    rollup.commit("none", one.limit(0))
    assert have(rollup) == {("s", "en", "v1", 2, 7)}


def test_a_cut_off_compaction_changes_nothing(spark, rollup):
    n = {"v1": F.col("n")}
    rollup.commit("one", C.inserts(rows(spark, ("s", "en", 5)), n))
    rollup._write(rollup.totals(), "totals/base=1")  # the list of names is missing
    assert have(rollup) == {("s", "en", "v1", 1, 5)}


def test_names_and_counts(frame, rollup, spark):
    with pytest.raises(ValueError):
        rollup.commit("../x", rows(spark))
    counters = {"w": C.words, "d": C.words_and_digits, "p": C.pieces}
    rows_ = ODD + [(50, "A1b 23, é!"), (51, "a1"), (52, "1a"), (53, "\u2028x\u00a0")]
    got = C.count_tokens(frame(rows_), counters).collect()
    rules = {"w": "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "d": "[0-9]|[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
             "p": "[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"}
    want = sorted((str(i), *(len(re.findall(x, t or "")) for x in rules.values())) for i, t in rows_)
    assert sorted((str(r.doc_id), r.w, r.d, r.p) for r in got) == want and "text" not in got[0].asDict()
    assert C.count_tokens(frame([]), counters).count() == 0


def test_query_on_repeated_rows_and_rows_without_id(spark, scratch):
    """Against the SQL: one row of each text counts."""
    import duckdb

    from loyalspark.llm.oracle import OP9
    from loyalspark.llm.queries import op9_token_counts
    rows = [(1, "a b 12", "en", "s"), (1, "a b 12", "en", "s"), (None, "no id 7", "de", "s"), (None, "no id 7", "de", "s"), (2, "a b 12", "en", "s"),
            (3, None, None, None), (4, "", None, None), (None, "x-y", "en", None), (5, "x-y", "en", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS id", "2 AS row", "3 AS kept").coalesce(
        1).write.parquet(f"{scratch}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{scratch}/documents.parquet/*.parquet')")
    cols = ["source", "lang", "tokenizer", "docs", "tokens"]
    got = sorted((tuple(r[c] for c in cols) for r in op9_token_counts(spark, scratch).collect()), key=str)
    assert got == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({OP9})").fetchall(), key=str)
