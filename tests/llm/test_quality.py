import zlib

import pytest
from llm_rows import CLASHES, ODD, SF01, frame, shipped  # noqa: F401

from loyalspark.llm import quality as Q
from loyalspark.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    got = QUERIES["op6_quality_classifier"](spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    unseen = [r for r in rows if r.held_out]
    assert len(unseen) > 40
    assert sum(r.predicted == r.quality for r in unseen) / len(unseen) > 0.93


def test_statistics_of_odd_texts(frame):
    df = Q.statistics(frame(ODD), "text", ["doc_id"])
    rows = df.collect()
    assert len(rows) == len(ODD) and all(v is not None for r in rows for v in tuple(r)[1:])
    blank = [r for r in rows if r.doc_id in (1, 2, 3)]
    assert all(r["__s_upper"] == 0 and r["__s_distinct"] == 0 for r in blank)


def test_paths_of_a_tree():
    text = """Model: uid=rf, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     If (feature 0 <= 0.75)
      Predict: 1.0
     Else (feature 0 > 0.75)
      Predict: 0.0
"""
    assert Q.tree_paths(text, ["a", "b"]) == {
        (("a", None, 0.5),), (("a", None, 0.5), ("b", None, 2.0)), (("a", None, 0.5), ("b", 2.0, None)),
        (("a", 0.5, None),), (("a", 0.5, 0.75),), (("a", 0.75, None),)}


def test_constant_models_and_empty(frame, spark):
    docs = frame([(i, f"text {i}") for i in range(20)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.fit(docs, none) == Q.RuleEnsemble(0.0)
    good = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    model = Q.fit(docs, good)
    assert not model.rules and {r.predicted for r in Q.score(docs, model).collect()} == {1}
    assert Q.score(frame([]), model).count() == 0 and Q.keep_good(frame([]), model).count() == 0


def test_rules_as_columns(frame):
    model = Q.RuleEnsemble(-1.0, [((("bang", 0.01, None), ("words", None, 3.0)), -2.0), ((("words", 0.1, None),), 3.0)])
    got = {r.doc_id: r.score for r in Q.score(frame([(1, "good words"), (2, "bad!"), (3, None)]), model).collect()}
    assert [got[i] for i in (1, 2, 3)] == pytest.approx([0.880797, 0.5, 0.268941], abs=1e-6)
    kept = Q.keep_good(frame([(1, "good words"), (2, "bad!"), (3, None), (3, None)]), model)
    assert kept.columns == ["doc_id", "text", *[c.split()[-1] for c in CLASHES]]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_model_does_not_depend_on_layout_or_run(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    one = Q.fit(docs, labels)
    # another order, other numbers of files and of plans made before
    other = Q.fit(docs.repartition(5).sortWithinPartitions("text"), labels.repartition(3))
    assert [r for r, _ in one.rules] == [r for r, _ in other.rules]
    assert all(abs(a - b) < 1e-9 for (_, a), (_, b) in zip(one.rules, other.rules))
