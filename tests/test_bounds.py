"""A task's share of the work is bounded whatever the input's size."""

from pyspark.sql import functions as F

from loyalspark.session import PARTITION_BYTES, bound_tasks

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_shuffles_start_with_partitions_for_the_input(spark):
    s = spark.newSession()
    s.conf.set(ADVISORY, "1k")
    s.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    bound_tasks(s, 50 * PARTITION_BYTES)
    groups = s.range(0, 100_000, 1, 4).groupBy((F.col("id") % 5000).alias("k")).count()
    assert groups.rdd.getNumPartitions() > 8  # the session's own number
    assert s.conf.get(ADVISORY) == "1k"
    bound_tasks(s, PARTITION_BYTES)
    assert s.conf.get(INITIAL) == "50"
    bound_tasks(s, 60 * PARTITION_BYTES)
    assert s.conf.get(INITIAL) == "60"


def test_a_session_s_own_settings_stay(spark):
    s = spark.newSession()
    s.conf.set(INITIAL, "3")
    bound_tasks(s, 50 * PARTITION_BYTES)
    assert s.conf.get(INITIAL) == "3"
    assert s.conf.get(ADVISORY) == "8m"


def test_every_query_bounds_its_tasks(spark, monkeypatch):
    from conftest import SF001
    from loyalspark.plans import catalog
    seen = []
    monkeypatch.setattr(catalog, "bound_tasks", lambda s, n: seen.append(n))
    catalog.QUERIES["fs_transactional_main"](spark, SF001)
    assert seen and seen[0] > 0


def test_keyed_education_drops_other_users_before_the_shuffles(spark):
    from conftest import SF001
    from loyalspark.plans import catalog
    keys = spark.sql("SELECT 1L AS user, DATE'2000-12-01' AS cutoff")
    df = catalog._edu(spark, SF001, [catalog.ORD_CUT], catalog.MAIN, keys=keys)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") >= 3
