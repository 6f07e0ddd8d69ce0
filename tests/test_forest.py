"""The forest's rows keep their nodes between the levels."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from loyalspark.ml import model as mm


def test_rows_keep_their_nodes_and_the_forest_is_the_same(spark):
    x = spark.range(0, 600, 1, 3).select(*[(F.hash("id", F.lit(i)) % 50).cast("double").alias(f"x{i}") for i in range(4)])
    rows = VectorAssembler(inputCols=x.columns, outputCol="features").transform(
        x.withColumn("label", (F.col("x0") + F.col("x1") * F.col("x2") / 20 > 0).cast("long")))
    forest = mm.classifier("rf", numTrees=6, minInstancesPerNode=5)
    assert forest.getCacheNodeIds()
    walked = forest.copy({forest.cacheNodeIds: False})
    assert forest.fit(rows).toDebugString.split("\n")[1:] == walked.fit(rows).toDebugString.split("\n")[1:]
