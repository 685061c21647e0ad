"""The dashboard's panels from roll-up rows instead of traces.

Each has the columns of its namesake in `dashboard` or `graph`; `rows` come from
`hoptrail.plans.rollup.partials` or `hoptrail.streaming.rollup.rollup_view`. Counts, sums and
means are exact; percentiles are within the rank error of the sketches. A selection is of
whole minutes, as a roll-up row can't be divided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import percent
from hoptrail.operators import dashboard, graph
from hoptrail.plans.filters import EVERYTHING, TraceFilter, whole_minutes
from hoptrail.plans.numbering import number_rows
from hoptrail.plans.rollup import CALLER, mean_time, merged, spread_of_time
from hoptrail.plans.services import node


def _chosen(rows: DataFrame, flt: TraceFilter, by_endpoint: bool = True) -> DataFrame:
    timed = rows.withColumn("event_timestamp", F.col("minute"))
    return whole_minutes(flt).apply(timed, by_endpoint)


def success_rate(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return merged(_chosen(rows, flt), []).select(percent(F.col("ok"), F.col("requests")).alias("tasa_exito"))


def _by_minute(rows: DataFrame, flt: TraceFilter, *keys: str, **options) -> DataFrame:
    found = merged(_chosen(rows, flt), ["minute", *keys], **options)
    return found.orderBy(F.asc_nulls_last("minute"))


def volume_by_minute(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _by_minute(rows, flt, "zona").select(
        F.col("minute").alias("time"), F.col("zona").alias("metric"), F.col("requests").alias("volumen")
    )


def errors_by_minute(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _by_minute(rows, flt).select(
        F.col("minute").alias("time"), F.col("requests").alias("peticiones_totales"), F.col("errors").alias("errores")
    )


def bytes_by_minute(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _by_minute(rows, flt).select(
        F.col("minute").alias("time"), F.col("received").alias("bytes_recibidos"), F.col("sent").alias("bytes_enviados")
    )


def latency_by_minute(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _by_minute(rows, flt, percents=[95]).select(
        F.col("minute").alias("time"), mean_time().alias("latencia_promedio"), F.col("p95").alias("latencia_p95")
    )


def endpoint_summary(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    found = merged(_chosen(rows, flt), ["zona", "endpoint"], percents=[95, 99])
    return dashboard.summary_columns(
        found.withColumn("n", F.col("requests")).withColumns({"mean": mean_time(), "stddev": spread_of_time()})
    )


def service_nodes(rows: DataFrame, flt: TraceFilter = EVERYTHING, merge: bool = False) -> DataFrame:
    counted = (
        _chosen(rows, flt, by_endpoint=False)
        .groupBy(*CALLER, "zona", "service")
        .agg(F.sum("requests").alias("requests"), F.sum(F.when(F.col("named"), F.col("requests")).otherwise(0)).alias("named"))
    )
    return graph.ends_of(counted.select(*graph.caller_columns(), "zona", "service", "requests", "named"), merge)


def service_calls(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    found = merged(_chosen(rows, flt, by_endpoint=False).where("named"), [graph.caller_columns()[0], node().alias("target")])
    return found.select("source", "target", "requests", mean_time().alias("mean_latency"))


def service_edges(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return number_rows(graph.edge_columns(service_calls(rows, flt)), ["source", "target"])


def zone_matrix(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    found = merged(_chosen(rows, flt, by_endpoint=False), ["source_zone", "zona"])
    return graph.matrix_columns(
        found.select(
            "source_zone",
            "zona",
            F.col("requests").alias("total_requests"),
            F.round(mean_time(), 1).alias("avg_latency_ms"),
            F.round(F.col("longest").cast("double"), 1).alias("max_latency_ms"),
            F.round(percent(F.col("server_errors"), F.col("requests")), 2).alias("error_rate_pct"),
            F.round(percent(F.col("ok"), F.col("requests")), 2).alias("success_rate_pct"),
        )
    )


def service_error_ranking(rows: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    found = merged(_chosen(rows, flt, by_endpoint=False).where("named"), ["zona", "service"])
    return graph.ranking_columns(found.select("zona", "service", F.col("requests").alias("total"), F.col("server_errors").alias("failures")))
