"""Subject tables derived from the benchmark tables for the survival queries.

lineitem trial: one subject per line of arms A (reference) and R (treated);
analysis = supplier; full time = quantity; event = line status F; lock 30,
or 45 for the record per analysis, whose curves then pass one half.

orders trial: one subject per order of status F (reference) and O (treated);
analysis = customer nation; full time = days from the order date to the last
order date of the table; every subject has its event at the full time; lock
1500; drop-outs: orders whose first hash draw % 100 < 16, at the second draw
% 1500, kept when earlier than the full time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import hash_u32
from tessera.operators.survival import admin_censor, apply_dropouts
from tessera.sources.tables import table

# fixed values of the two trial fixtures
LINE_LEVELS = ("A", "R")
LINE_LOCK = 30.0
LONG_LOCK = 45.0
ORDER_LEVELS = ("F", "O")
ORDER_LOCK = 1500.0
DROP_PERCENT = 16
DROP_SALT = "drop"


def lineitem_trial(spark: SparkSession, sf: str, lock: float = LINE_LOCK) -> DataFrame:
    li = table(spark, sf, "lineitem").filter(F.col("l_returnflag").isin(*LINE_LEVELS))
    subj = li.select(
        F.col("l_suppkey").alias("grp"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.col("l_returnflag").alias("arm"),
        F.col("l_quantity").alias("full_time"),
        (F.col("l_linestatus") == F.lit("F")).cast("int").alias("base_event"),
    )
    return (admin_censor(subj, "full_time", "base_event", lock)
            .withColumn("drop_out", F.lit(False))
            .drop("base_event"))


def orders_trial(spark: SparkSession, sf: str) -> DataFrame:
    """``orders`` is read once for the subjects and once for the drop-outs, which need no customer."""
    orders = table(spark, sf, "orders")
    last = orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]  # a DATE: no time zone involved
    timed = orders.filter(F.col("o_orderstatus").isin(*ORDER_LEVELS)).select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("arm"),
        F.datediff(F.lit(last), F.col("o_orderdate")).cast("double").alias("full_time"))
    cust = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("grp"))
    subj = (timed.join(cust, F.col("o_custkey") == F.col("c_custkey"))
            .select("grp", "o_orderkey", "arm", "full_time"))
    subj = admin_censor(subj, "full_time", F.lit(1), ORDER_LOCK)
    drops = (timed.select("o_orderkey", "full_time",
                          (hash_u32("o_orderkey", salt=DROP_SALT, offset=0) % 100).alias("__u"),
                          (hash_u32("o_orderkey", salt=DROP_SALT, offset=1) % int(ORDER_LOCK))
                          .cast("double").alias("drop_time"))
             .filter((F.col("__u") < DROP_PERCENT) & (F.col("drop_time") < F.col("full_time")))
             .select("o_orderkey", "drop_time"))
    return apply_dropouts(subj, drops, "o_orderkey")


# SQL twins of the fixtures, for the DuckDB oracles
def lineitem_trial_sql(lock: float = LINE_LOCK) -> str:
    return f"""
  SELECT l_suppkey AS grp, l_orderkey, l_linenumber, l_partkey, l_returnflag AS arm,
         l_quantity AS full_time,
         CASE WHEN l_quantity > {lock} THEN 0 ELSE CAST(l_linestatus = 'F' AS INTEGER) END AS event,
         least(l_quantity, {lock}) AS time, FALSE AS drop_out
  FROM lineitem WHERE l_returnflag IN ('A', 'R')
"""


LINEITEM_TRIAL_SQL = lineitem_trial_sql()

ORDERS_TRIAL_SQL = """
  WITH s AS (
    SELECT c_nationkey AS grp, o_orderkey, o_orderstatus AS arm,
           CAST(date_diff('day', CAST(o_orderdate AS DATE),
                CAST((SELECT max(o_orderdate) FROM orders) AS DATE)) AS DOUBLE) AS full_time
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus IN ('F', 'O')),
  c AS (
    SELECT *, CASE WHEN full_time > 1500 THEN 0 ELSE 1 END AS event0,
           least(full_time, 1500.0) AS time0,
           ('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), 'drop')), 1, 8))::BIGINT % 100 AS u,
           CAST(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), 'drop')), 9, 8))::BIGINT % 1500 AS DOUBLE) AS dt
    FROM s)
  SELECT grp, o_orderkey, arm, full_time,
         CASE WHEN u < 16 AND dt < full_time THEN 0 ELSE event0 END AS event,
         CASE WHEN u < 16 AND dt < full_time THEN dt ELSE time0 END AS time,
         (u < 16 AND dt < full_time) AS drop_out
  FROM c
"""
