"""Quality classifier: a sparse rule ensemble over text statistics.

A forest of shallow trees is grown on labelled documents; every path from a
root to a node is a rule, a conjunction of bounds on statistics. A logistic
model with a lasso penalty weighs the rules, most of which drop out, and the
ones left are compiled into one Spark column expression, so scoring is native
and needs one scan without any shuffle. Statistics come from whole texts.

Only the fit uses a sample: at most ``train_rows`` labelled rows, taken evenly
by a hash of the id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: Labelled rows that a fit uses at most (about 20 numbers each).
TRAIN_ROWS = 20_000
#: Share of the id hash's buckets that is held out, as the contract fixes.
FOLDS = 5

#: Statistics per character: name -> pattern (or literal text) that is counted.
_PER_CHAR = {
    "upper": r"\p{Lu}",
    "digit": r"\p{N}",
    "bar": r"\|",
    "mark": r"[#$%&*@^~<>{}\[\]=+\\]",
    "bang": "!",
    "stop": r"[.?:;]",
    "comma": ",",
}


def held_out(doc_id: str | Column) -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def statistics(docs: DataFrame, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep`` columns plus one double per statistic (``__s_*``). Texts
    without words have every ratio at 0; a null text counts as empty."""
    text = text_or_empty(text_col)
    d = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("__text"))
    d = d.select(
        *[F.col(f"`{c}`") for c in keep], "__text",
        F.filter(F.split("__text", r"[\s\x00]+"), lambda w: w != "").alias("__words"),
        F.filter(F.split("__text", "\n"), lambda w: w != "").alias("__lines"))
    chars = F.char_length("__text").cast("double")
    d = d.select(
        *[F.col(f"`{c}`") for c in keep], chars.alias("__chars"),
        F.size("__words").cast("double").alias("__n_words"),
        F.size(F.array_distinct("__words")).cast("double").alias("__n_distinct"),
        F.size("__lines").cast("double").alias("__n_lines"),
        F.size(F.array_distinct("__lines")).cast("double").alias("__n_distinct_lines"),
        F.coalesce(F.array_max(F.transform("__words", F.length)), F.lit(0)).cast("double").alias("__longest"),
        F.regexp_count("__text", F.lit(r",\p{L}")).cast("double").alias("__glued"),
        *[F.regexp_count("__text", F.lit(p)).cast("double").alias(f"__c_{n}") for n, p in _PER_CHAR.items()])

    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    stats = {
        "words": F.log1p("__n_words"), "lines": F.log1p("__n_lines"), "word_length": ratio("__chars", "__n_words"),
        "distinct": ratio("__n_distinct", "__n_words"), "distinct_lines": ratio("__n_distinct_lines", "__n_lines"),
        "line_words": F.log1p(ratio("__n_words", "__n_lines")), "longest": F.log1p("__longest"),
        "glued": ratio("__glued", "__n_words"), **{n: ratio(f"__c_{n}", "__chars") for n in _PER_CHAR},
    }
    return d.select(*[F.col(f"`{c}`") for c in keep], *[c.alias(f"__s_{n}") for n, c in stats.items()])


#: Names of the statistics, in the order of the trees' features.
STATS = ["words", "lines", "word_length", "distinct", "distinct_lines", "line_words", "longest", "glued", *_PER_CHAR]


@dataclass
class RuleEnsemble:
    """Weighted rules; a rule is a set of (statistic, lower, upper) bounds,
    lower exclusive and upper inclusive, either may be None."""
    intercept: float
    rules: list[tuple[tuple, float]] = field(default_factory=list)

    def column(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule_column(rule), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def rule_column(rule: tuple) -> Column:
    out = None
    for name, lower, upper in rule:
        for test in ([F.col(f"__s_{name}") > lower] if lower is not None else []) + \
                    ([F.col(f"__s_{name}") <= upper] if upper is not None else []):
            out = test if out is None else out & test
    return out


def tree_paths(debug: str, names: list[str]) -> set[tuple]:
    """Every path of a forest, from the text form of its trees."""
    paths: set[tuple] = set()
    stack: list[tuple[int, str, str, float]] = []
    for line in debug.splitlines():
        m = re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) ([-+\d.eE]+|Infinity|-Infinity)\)", line)
        if line.lstrip().startswith("Tree"):
            stack = []
        if not m:
            continue
        depth = len(m[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, names[int(m[3])], m[4], float(m[5])))
        bounds: dict[str, list] = {}
        for _, name, op, value in stack:
            b = bounds.setdefault(name, [None, None])
            if op == ">":
                b[0] = value if b[0] is None else max(b[0], value)
            else:
                b[1] = value if b[1] is None else min(b[1], value)
        paths.add(tuple(sorted((n, lo, hi) for n, (lo, hi) in bounds.items())))
    return paths


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train_rows: int = TRAIN_ROWS, trees: int = 24, depth: int = 4,
        penalty: float = 0.001, seed: int = 7) -> RuleEnsemble:
    """Fit on labelled documents that are not held out.

    Null labels are skipped; an id with several labels has their mean, rounded
    up at one half. Without labelled documents, or with one class only, the
    ensemble is a constant.
    """
    import math
    spark = docs.sparkSession
    y = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
         .groupBy(F.col(id_col).alias("__id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("label")))
    n = y.count()
    if n == 0:
        return RuleEnsemble(0.0)
    cells = 1 << 20
    share = min(cells, cells * train_rows // n)
    y = y.filter(F.pmod(F.xxhash64("__id"), F.lit(cells)) < share)
    texts = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__t"))
    picked = texts.join(F.broadcast(y), F.col("__doc") == F.col("__id"))  # train_rows rows at most
    x = stage(spark, statistics(picked, "__t", ["__doc", "label"]).select(
        "__doc", "label", F.array(*[f"__s_{s}" for s in STATS]).alias("x")), "quality-scanned")
    # the sample alone is dealt anew, by a hash of its ids: bagging follows the
    # order of rows, which neither file layout nor range sampling then changes
    x = stage(spark, x.repartition(8, F.xxhash64("__doc")).sortWithinPartitions("x", "label").drop("__doc"), "quality-train")
    total = {r["label"]: r["count"] for r in x.groupBy("label").count().collect()}
    if len(total) < 2:
        return RuleEnsemble(0.0 if not total else math.log(1e3) * (1 if 1.0 in total else -1))
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="onethird", subsamplingRate=0.6, minInstancesPerNode=3, seed=seed,
    ).fit(x.select("label", array_to_vector("x").alias("features")))
    rules = sorted(tree_paths(forest.toDebugString, STATS), key=repr)
    named = x.select("label", *[F.col("x")[i].alias(f"__s_{s}") for i, s in enumerate(STATS)])
    hits = named.select("label", F.array(*[F.when(rule_column(r), 1.0).otherwise(0.0) for r in rules]).alias("h"))
    hits = stage(spark, hits, "quality-rules")
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=penalty, elasticNetParam=1.0,
                               maxIter=60, standardization=True).fit(
        hits.select("label", array_to_vector("h").alias("features")))
    weights = model.coefficients.toArray()
    return RuleEnsemble(float(model.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w])


def score(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) for every row, repeated rows included.

    A null text counts as empty and is scored like any other; a text of any
    length is scored whole; an empty table gives no rows; other columns are not
    looked at.
    """
    s = statistics(docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__t")), "__t", ["__id"])
    s = s.select(F.col("__id").alias(id_col), model.column().alias("score"))
    return s.select(id_col, held_out(id_col).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows predicted good, all columns unchanged, without any shuffle."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    packed = packed.withColumn("__t", F.col("__row").getField(text_col))
    s = statistics(packed, "__t", ["__row"])
    # the row number keeps the optimiser from moving the filter below the
    # statistics, where every rule would work them out again
    s = s.select("__row", model.column().alias("__score"), F.monotonically_increasing_id().alias("__n"))
    return s.filter((F.col("__score") >= threshold) & (F.col("__n") >= 0)).select("__row.*")
