"""Trace lookup, value lists, top consumers and read-only SQL."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.plans.filters import EVERYTHING, TraceFilter

# Columns a lookup may filter on, and those of which one is required.
LOOKUP_COLUMNS = (
    "year", "month", "day", "hour", "zona", "id_transaccion", "endpoint", "status_response",
)
TIME_PARTITIONS = ("year", "month", "day")
DEFAULT_LIMIT = 100


def find_traces(traces: DataFrame, filters: dict, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Traces equal to all given values, oldest first, at most `limit`.

    Unknown names and null values are ignored. Without a year, month or day the
    call is refused, as it would read every partition.
    """
    given = {
        name: filters[name] for name in LOOKUP_COLUMNS if filters.get(name) is not None
    }
    if not any(name in given for name in TIME_PARTITIONS):
        raise ValueError("give at least one of year, month or day")
    condition = reduce(
        Column.__and__, [F.col(name) == F.lit(value) for name, value in given.items()]
    )
    return (
        traces.where(condition)
        .orderBy(F.asc_nulls_last("event_timestamp"), F.asc_nulls_last("id_transaccion"))
        .limit(limit)
    )


_READS = re.compile(r"\s*(SELECT|WITH)\b", re.IGNORECASE)
# Nodes of an analysed query that leave the engine, by class name.
_ESCAPES = ("CallMethodViaReflection", "ScriptTransformation")


def _nodes(plan) -> Iterator:
    """Plans and expressions of an analysed query, those of its subqueries included."""
    todo = [plan]
    while todo:
        node = todo.pop()
        yield node
        found = [node.children(), node.innerChildren()]
        if _has(node, "expressions"):
            found.append(node.expressions())
        if _has(node, "plan"):
            todo.append(node.plan())
        for nodes in found:
            todo += [nodes.apply(i) for i in range(nodes.size())]


def _has(node, name: str) -> bool:
    return any(m.getName() == name and not m.getParameterTypes() for m in node.getClass().getMethods())


def run_select(spark: SparkSession, sql: str, args: dict | list | None = None) -> DataFrame:
    """Run a SELECT (or WITH ... SELECT); values are bound, never pasted in.

    The text is placed as a subquery, where Spark's grammar admits queries only. What the
    analysed query consists of decides whether it runs: no scripts, no calls into the JVM
    and no commands, however they are spelled. Only tables of the catalog and views are read,
    not files by their path.
    """
    if not _READS.match(sql):
        raise ValueError("only SELECT queries are allowed")
    # A copy of the session, with its views, in which a path is no table.
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    copy.conf.set("spark.sql.runSQLOnFiles", "false")
    found = copy.sql(f"SELECT * FROM (\n{sql}\n)", args=args)
    command = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.plans.logical.Command")
    for node in _nodes(found._jdf.queryExecution().analyzed()):
        if node.getClass().getSimpleName() in _ESCAPES or command.isInstance(node):
            raise ValueError("scripts, JVM calls and commands are not allowed")
    return found


def transaction(traces: DataFrame, id_transaccion: str) -> DataFrame:
    """All hops of one transaction in time order."""
    return (
        traces.where(F.col("id_transaccion") == id_transaccion)
        .orderBy(F.asc_nulls_last("date_transaction"))
        .select("id_transaccion", "id_recurso", "id_consumer", "endpoint", "status_response")
    )


def recent_traces(traces: DataFrame, limit: int = 10) -> DataFrame:
    return (
        traces.select("event_timestamp", "endpoint", "status_response", "zona")
        .orderBy(F.desc_nulls_last("event_timestamp"))
        .limit(limit)
    )


def zones(traces: DataFrame) -> DataFrame:
    return traces.select("zona").distinct()


def endpoints(traces: DataFrame, chosen_zones: list[str] | None = None) -> DataFrame:
    chosen = TraceFilter(zones=chosen_zones).apply(traces)
    return chosen.select("endpoint").distinct()


def consumers(traces: DataFrame) -> DataFrame:
    return traces.select("id_consumer").distinct()


def top_consumers(traces: DataFrame, limit: int = 10) -> DataFrame:
    return (
        traces.groupBy("id_consumer")
        .agg(F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), F.asc_nulls_last("id_consumer"))
        .limit(limit)
    )


def zone_consumers(traces: DataFrame, zone: str) -> DataFrame:
    return (
        traces.where(F.col("zona") == zone)
        .groupBy("id_consumer")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.avg("time_transaction").alias("avg_latency"),
        )
        .orderBy(F.desc("total"), F.asc_nulls_last("id_consumer"))
    )


def status_by_zone(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return (
        flt.apply(traces)
        .groupBy("zona", "status_response")
        .agg(F.count(F.lit(1)).alias("total"))
    )


def row_count(traces: DataFrame) -> DataFrame:
    return traces.agg(F.count(F.lit(1)).alias("total"))
