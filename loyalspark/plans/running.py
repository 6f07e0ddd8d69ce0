"""Running sums and exact quantiles whose work is spread whatever the number of
distinct values.

``running_sums``: rows are dealt by range of the order column, so each task
holds an interval of values; one row of totals per task gives the offsets, and
sums run inside the intervals. No ordered window spans the whole table.

``exact_quantiles``: selection by refining histograms, for all columns, groups
and probabilities at once. A round counts the values of each open interval in
``CELLS`` cells, with each cell's least and greatest value; the cell that holds
a wanted rank is the next round's interval, until it holds one value. A round
is one scan with map-side combining, its result bounded by the cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loyalspark.sources.store import stage

#: Cells of an interval in a round of ``exact_quantiles``.
CELLS = 4096


def running_sums(df: DataFrame, order: str, sums: list[str], group: str | None = None, descending: bool = False) -> DataFrame:
    """``df`` with, per ``group``, the sums of the long columns ``sums`` over
    all rows up to and with this one in ``order`` (``cum_<name>``) and over
    all rows (``all_<name>``). Rows that are equal in ``order`` should be
    summed up before; without a group the whole table is one."""
    spark = df.sparkSession
    key = F.col(group) if group else F.lit(0)
    by = F.col(order).desc() if descending else F.col(order).asc()
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    dealt = stage(df.withColumn("__g", key).repartitionByRange(n, F.col("__g"), by).withColumn("__part", F.spark_partition_id()), "running")
    # one row per group and task; a group's rows of totals are one short array
    totals = dealt.groupBy("__g", "__part").agg(*[F.sum(c).alias(c) for c in sums])
    lists = totals.groupBy("__g").agg(F.array_sort(F.collect_list(F.struct("__part", *sums))).alias("t"))

    def total(rows: Column, c: str) -> Column:
        return F.aggregate(rows, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x[c], F.lit(0)))

    offsets = lists.select("__g", F.explode("t").alias("x"), "t").select(
        F.col("__g").alias("__h"), F.col("x.__part").alias("__p"),
        *[total(F.filter("t", lambda y: y["__part"] < F.col("x.__part")), c).alias(f"__before_{c}") for c in sums],
        *[total(F.col("t"), c).alias(f"all_{c}") for c in sums])
    w = Window.partitionBy("__g", "__part").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.select("*", *[F.sum(c).over(w).alias(f"__run_{c}") for c in sums])
    out = local.join(offsets, F.col("__g").eqNullSafe(F.col("__h")) & (F.col("__part") == F.col("__p")))
    return out.select(*df.columns, *[(F.col(f"__run_{c}") + F.col(f"__before_{c}")).alias(f"cum_{c}") for c in sums], *[f"all_{c}" for c in sums])


def exact_quantiles(df: DataFrame, cols: list[str], probabilities: list[float], group: str | None = None) -> DataFrame:
    """(group, feature, n, q): per group and column the exact quantiles, with
    linear interpolation between the two nearest ranks, as one array in the
    order of ``probabilities``. Nulls and NaN are left out; a column without
    values in a group has no row. ``n`` counts the values."""
    g = F.col(group).cast("string") if group else F.lit(None).cast("string")
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in cols])
    values = stage(df.select(g.alias("g"), F.inline(pairs)).filter(F.col("x").isNotNull() & ~F.isnan("x")), "quantile-values")
    place = F.col("p") * (F.col("n") - 1)
    ends = values.groupBy("g", "feature").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    wanted = stage(ends.withColumn("p", F.explode(F.array(*[F.lit(float(p)) for p in sorted(set(probabilities))]))).select(
        "g", "feature", "n", "p", "lo", "hi", F.explode(F.array(F.floor(place), F.ceil(place))).alias("want")).distinct()
        .withColumn("rank", F.col("want")), "quantile-wanted")
    found = None
    while True:
        done = wanted.filter("lo = hi").select("g", "feature", "n", "p", "want", F.col("lo").alias("x"))
        found = done if found is None else found.unionAll(done)
        open_ = wanted.filter("lo < hi")
        if open_.isEmpty():
            break
        spans = open_.select(F.col("g").alias("h"), F.col("feature").alias("f"), "lo", "hi").distinct()
        near = values.join(spans, F.col("g").eqNullSafe(F.col("h")) & (F.col("feature") == F.col("f")) & F.col("x").between(F.col("lo"), F.col("hi")))
        # halves first, so that no difference of two numbers overflows
        share = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        cell = F.when(F.col("x") == F.col("hi"), CELLS).otherwise(F.least(F.floor(share * CELLS), F.lit(CELLS - 1)))
        cells = near.groupBy("h", "f", "lo", "hi", cell.alias("cell")).agg(F.count("*").alias("k"), F.min("x").alias("least"), F.max("x").alias("most"))
        w = Window.partitionBy("h", "f", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("ahead", F.coalesce(F.sum("k").over(w), F.lit(0)))
        c, t = cells.alias("c"), open_.alias("t")
        hit = t.join(c, F.col("t.g").eqNullSafe(F.col("c.h")) & (F.col("t.feature") == F.col("c.f")) & (F.col("t.lo") == F.col("c.lo"))
                     & (F.col("t.hi") == F.col("c.hi")) & (F.col("t.rank") >= F.col("c.ahead")) & (F.col("t.rank") < F.col("c.ahead") + F.col("c.k")))
        wanted = stage(hit.select("t.g", "t.feature", "t.n", "t.p", F.col("c.least").alias("lo"), F.col("c.most").alias("hi"), "t.want",
                                  (F.col("t.rank") - F.col("c.ahead")).alias("rank")), "quantile-wanted")
    at = place - F.floor(place)
    two = found.groupBy("g", "feature", "n", "p").agg(F.min_by("x", "want").alias("a"), F.max_by("x", "want").alias("b"))
    one = two.withColumn("v", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((1 - at) * F.col("a") + at * F.col("b")))
    held = F.map_from_entries(F.collect_list(F.struct("p", "v")))
    return one.groupBy("g", "feature").agg(F.max("n").alias("n"), held.alias("m")).select(
        F.col("g").alias(group or "g"), "feature", "n", F.array(*[F.element_at("m", F.lit(float(p))) for p in probabilities]).alias("q"))
