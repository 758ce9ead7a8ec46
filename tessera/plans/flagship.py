"""Flagship: order -> ship duration, capped price, group mean back, by class."""

from pyspark.sql import functions as F

from tessera.functions.scalars import minutes_between
from tessera.functions.staging import stage
from tessera.operators.clean import cap_iqr
from tessera.operators.relational import group_mean_back
from tessera.plans.registry import query


def fare_profile(t):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice",
                           "l_returnflag", "l_shipdate")
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    j = j.select("l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", minutes_between("o_orderdate", "l_shipdate").alias("dur_min"))
    j = stage(j, "flagship-lines")  # read for the fences, the group means and the result
    j = cap_iqr(j, ["l_extendedprice"])
    j = group_mean_back(j, ["l_partkey", "l_suppkey"], "l_extendedprice", "mean_ps")
    return j.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("dur_min"), 4).alias("avg_minutes"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price_capped"),
        F.round(F.avg("mean_ps"), 4).alias("avg_group_mean"))


@query("flagship_fare_profile", """
WITH j AS (SELECT l.*, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 6e7 AS dur_min
           FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey),
c0 AS (SELECT *, greatest(l_extendedprice, 0.0) AS price FROM j),
q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM c0),
c1 AS (SELECT c0.*, least(price, q3 + 1.5 * (q3 - q1)) AS price_c FROM c0, q),
g AS (SELECT *, avg(price_c) OVER (PARTITION BY l_partkey, l_suppkey) AS mean_ps FROM c1)
SELECT l_returnflag, count(*) AS n, round(avg(dur_min), 4) AS avg_minutes,
       round(avg(price_c), 4) AS avg_price_capped, round(avg(mean_ps), 4) AS avg_group_mean
FROM g GROUP BY l_returnflag
""")
def q_flagship(spark, t):
    return fare_profile(t)
