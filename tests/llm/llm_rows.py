"""Rows that every operator must take, and fixtures of these tests."""

import pytest

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

LONG = "long words repeat " * 20_000

#: (doc_id, text) with nulls, empty and very long texts, ties and repeated rows.
ODD = [(1, None), (2, ""), (3, "   \n"), (4, LONG), (5, LONG), (6, "one"), (6, "one"), (None, "no id"), (None, None),
       (7, "\x00 odd \x1f bytes é 漢字 <|endoftext|>"), (8, "!!! ???")]

#: Columns whose names operators use inside.
CLASHES = ["'x' AS id", "1 AS node", "2 AS k", "'h' AS host", "'r' AS rule", "3 AS bucket", "'b' AS bands", "array(1) AS spans",
           "'i' AS items", "'l' AS label", "0 AS row", "'s' AS sha", "1 AS n_words", "'p' AS path", "'v' AS cut"]


@pytest.fixture(autouse=True)
def shipped(spark):
    from loyalspark.llm.common import ship
    ship(spark)


@pytest.fixture()
def frame(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(list(rows), schema).selectExpr("*", *CLASHES)
    return make
