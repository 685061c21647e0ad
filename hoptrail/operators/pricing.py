"""The two order-and-lineitem queries used to load-test an installation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pricing_summary(lineitem: DataFrame) -> DataFrame:
    return (
        lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("count_order"),
            F.sum("l_quantity").alias("sum_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def top_open_orders(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    segment: str,
    day: date,
    limit: int = 10,
) -> DataFrame:
    """Orders of a segment placed before `day` with most revenue shipped after it.

    Lines are added up per order before the join: the shuffle then carries one
    row per order, and an order with very many lines is no hot key. Which side
    is broadcast is left to Spark's size statistics.
    """
    revenue = (
        lineitem.where(F.col("l_shipdate") > F.lit(day))
        .groupBy("l_orderkey")
        .agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    )
    wanted = orders.where(F.col("o_orderdate") < F.lit(day)).join(
        customer.where(F.col("c_mktsegment") == segment),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    return (
        revenue.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_orderkey", "o_orderdate", "o_orderpriority")
        .agg(F.sum("revenue").alias("revenue"))
        .select("l_orderkey", "revenue", "o_orderdate", "o_orderpriority")
        .orderBy(F.desc("revenue"), F.asc("o_orderdate"))
        .limit(limit)
    )
