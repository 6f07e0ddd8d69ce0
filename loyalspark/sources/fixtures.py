"""Canonical views over the driver tables (see FIXTURES.md).

Each view exists twice: as a Spark DataFrame builder and as the identical
SQL text used by the DuckDB oracle. Canonical transaction columns are
``tx_id bigint, user_id bigint, ts timestamp, points bigint, kind string``.

* ``EV``      dense activity: every event is a transaction.
* ``EV_THIN`` every event of EV, moved to the visit days of a per-user rhythm
              so that every life-cycle state occurs.
* ``ORD``     sparse long history: orders as transactions, line items as
              the transaction-product bridge and parts as the product register.
* ``EDU``     a course platform derived from orders / line items / parts.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EV_START = _dt.date(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def paths(sf_dir: str) -> list:
    """The tables that the views read."""
    return [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("customer", "part", "orders", "lineitem", "events")]


# ---------------------------------------------------------------- Spark side

def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    sign = F.when(F.col("event_type") == "error", F.lit(-1)).otherwise(F.lit(1))
    return ev.select(
        F.col("event_id").alias("tx_id"),
        F.col("user_id"),
        F.col("ts"),
        (sign * F.floor(F.col("value") * 2).cast("long")).cast("long").alias("points"),
        F.col("event_type").alias("kind"),
    )


def tx_events_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event, moved to its user's latest visit day (an event before the
    first visit day moves to that one); the time of day stays."""
    tx = tx_events(spark, sf_dir)
    uid = F.col("user_id")
    di = F.datediff(F.to_date("ts"), F.lit(EV_START))
    every, start = F.lit(1) + uid % 29, (uid % 7) * 4
    latest = di - (di + uid) % every
    first = F.least(start + (every - (start + uid) % every) % every, F.lit(29))
    shift = (F.when(latest >= start, latest).otherwise(first) - di).cast("int")
    return tx.withColumn("ts", F.timestamp_add("DAY", shift, "ts"))


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    sign = F.when(F.col("o_orderstatus") == "F", F.lit(-1)).otherwise(F.lit(1))
    return o.select(
        F.col("o_orderkey").alias("tx_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("ts"),
        (sign * F.floor(F.col("o_totalprice") / 200).cast("long")).cast("long").alias("points"),
        F.col("o_orderpriority").alias("kind"),
    )


def tx_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_partkey").alias("product_id"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("name"),
        F.col("p_brand").alias("category"))


# Two brands stand in for the two grouped categories of the original store.
ORD_CATEGORIES = ("Brand#11", "Brand#22")
ORD_PRODUCTS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def edu_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Course register: distinct (course, episode) = (brand, type)."""
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("course"), F.col("p_type").alias("episode")).distinct()


def edu_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completed episodes: first order date of each (customer, brand, type)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return (o.join(li, o.o_orderkey == li.l_orderkey)
            .join(p, li.l_partkey == p.p_partkey)
            .groupBy(F.col("o_custkey").alias("user"), F.col("p_brand").alias("course"),
                     F.col("p_type").alias("episode"))
            .agg(F.min("o_orderdate").alias("ts")))


def edu_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("user"), F.col("o_orderdate").alias("ts"))


def edu_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.col("o_custkey").alias("user"), F.col("o_orderdate").alias("ts"))


def edu_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id bridge course-platform user -> loyalty customer id.

    Only part of the customers are registered on both platforms; the
    fixture models that with the customer-key rule of FIXTURES.md.
    """
    c = table(spark, sf_dir, "customer")
    return c.filter((F.col("c_custkey") % 10) < 6).select(
        F.col("c_custkey").alias("user"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"))


def edu_slugs() -> tuple:
    return tuple(f"Brand#{i}" for i in range(1, 26))


# ---------------------------------------------------------------- SQL side
# Same views as SQL text (DuckDB dialect) for the oracle.

SQL_EV = """SELECT event_id AS tx_id, user_id, ts,
       CAST((CASE WHEN event_type = 'error' THEN -1 ELSE 1 END) * CAST(floor(value * 2) AS BIGINT) AS BIGINT) AS points,
       event_type AS kind
FROM events"""

SQL_EV_THIN = f"""SELECT tx_id, user_id, ts + to_days(CAST(CASE WHEN di - (di + user_id) % every >= start THEN di - (di + user_id) % every
         ELSE least(start + (every - (start + user_id) % every) % every, 29) END - di AS INTEGER)) AS ts, points, kind
FROM (SELECT *, ts::DATE - DATE '2024-01-01' AS di, 1 + user_id % 29 AS every, user_id % 7 * 4 AS start FROM ({SQL_EV}))"""

SQL_ORD = """SELECT o_orderkey AS tx_id, o_custkey AS user_id, o_orderdate AS ts,
       CAST((CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END) * CAST(floor(o_totalprice / 200) AS BIGINT) AS BIGINT) AS points,
       o_orderpriority AS kind
FROM orders"""

SQL_ITEMS = "SELECT l_orderkey AS tx_id, l_partkey AS product_id FROM lineitem"
SQL_PRODUCTS = "SELECT p_partkey AS product_id, p_type AS name, p_brand AS category FROM part"

SQL_EDU_REGISTER = "SELECT DISTINCT p_brand AS course, p_type AS episode FROM part"
SQL_EDU_DONE = """SELECT o.o_custkey AS \"user\", p.p_brand AS course, p.p_type AS episode, min(o.o_orderdate) AS ts
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2, 3"""
SQL_EDU_REWARDS = "SELECT o_custkey AS \"user\", o_orderdate AS ts FROM orders WHERE o_orderstatus = 'F'"
SQL_EDU_SKILLS = "SELECT o_custkey AS \"user\", o_orderdate AS ts FROM orders WHERE o_orderpriority = '1-URGENT'"
SQL_EDU_BRIDGE = "SELECT c_custkey AS \"user\", 'C' || CAST(c_custkey AS VARCHAR) AS customer_id FROM customer WHERE c_custkey % 10 < 6"


TX_BUILDERS = {"EV": tx_events, "EV_THIN": tx_events_thin, "ORD": tx_orders}
TX_SQL = {"EV": SQL_EV, "EV_THIN": SQL_EV_THIN, "ORD": SQL_ORD}
