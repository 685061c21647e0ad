"""Time-series panels and the per-endpoint summary.

Output names are the dashboard's own column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import is_2xx, is_4xx, is_5xx, is_error, percent
from hoptrail.plans.filters import EVERYTHING, TraceFilter
from hoptrail.plans.latency import latency_profile


def _per_minute(traces: DataFrame, flt: TraceFilter) -> DataFrame:
    minute = F.date_trunc("minute", F.col("event_timestamp"))
    return flt.apply(traces).withColumn("time", minute)


def _in_time_order(df: DataFrame) -> DataFrame:
    return df.orderBy(F.asc_nulls_last("time"))


def success_rate(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Percentage of 2xx answers; null without traces."""
    return flt.apply(traces).agg(
        percent(F.count_if(is_2xx()), F.count(F.lit(1))).alias("tasa_exito")
    )


def requests_per_second(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Traces over the seconds they span: whole number, and as a double.

    Both are null when no trace has a time, as there is no span then.
    """
    span = flt.apply(traces).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_timestamp").alias("first"),
        F.max("event_timestamp").alias("last"),
    )
    whole_seconds = F.timestamp_diff("SECOND", F.col("first"), F.col("last"))
    seconds = F.when(whole_seconds.isNotNull(), F.greatest(whole_seconds, F.lit(1)))
    return span.withColumn("seconds", seconds).selectExpr(
        "n div seconds AS rps", "n / cast(seconds AS double) AS rps_exact"
    )


def volume_by_minute(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _in_time_order(
        _per_minute(traces, flt)
        .groupBy("time", F.col("zona").alias("metric"))
        .agg(F.count(F.lit(1)).alias("volumen"))
    )


def errors_by_minute(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _in_time_order(
        _per_minute(traces, flt)
        .groupBy("time")
        .agg(
            F.count(F.lit(1)).alias("peticiones_totales"),
            F.count_if(is_error()).alias("errores"),
        )
    )


def bytes_by_minute(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    return _in_time_order(
        _per_minute(traces, flt)
        .groupBy("time")
        .agg(
            F.sum("req_body_size").alias("bytes_recibidos"),
            F.sum("resp_body_size").alias("bytes_enviados"),
        )
    )


def latency_by_minute(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    profile = latency_profile(_per_minute(traces, flt), ["time"], percents=[95], spread=False)
    return _in_time_order(
        profile.select(
            "time",
            F.col("mean").alias("latencia_promedio"),
            F.col("p95").alias("latencia_p95"),
        )
    )


def endpoint_summary(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Twelve figures per zone and endpoint, busiest first."""
    sizes = {
        name: F.col(column).cast("double")
        for name, column in (("received", "req_body_size"), ("sent", "resp_body_size"))
    }
    profile = latency_profile(
        flt.apply(traces),
        ["zona", "endpoint"],
        percents=[95, 99],
        measures={
            "ok": F.count_if(is_2xx()),
            "client_errors": F.count_if(is_4xx()),
            "server_errors": F.count_if(is_5xx()),
            **{name: F.sum(size) for name, size in sizes.items()},
            **{f"{name}_n": F.count(size) for name, size in sizes.items()},
        },
    )
    return summary_columns(profile)


def summary_columns(profile: DataFrame) -> DataFrame:
    """The summary's columns and order, from totals per zone and endpoint."""
    return profile.select(
        F.col("zona").alias("Zona"),
        F.col("endpoint").alias("API / Endpoint"),
        F.col("n").alias("Total Solicitudes"),
        percent(F.col("ok"), F.col("n")).alias("Tasa de Exito"),
        F.col("client_errors").alias("Errores 4xx"),
        F.col("server_errors").alias("Errores 5xx"),
        F.col("mean").alias("Latencia Prom"),
        F.col("p95").alias("Latencia p95"),
        F.col("p99").alias("Latencia p99"),
        F.col("stddev").alias("Desviacion Latencia"),
        F.try_divide("received", "received_n").alias("Payload In Prom"),
        F.try_divide("sent", "sent_n").alias("Payload Out Prom"),
    ).orderBy(
        F.desc_nulls_last("Total Solicitudes"),
        F.asc_nulls_last("Zona"),
        F.asc_nulls_last("API / Endpoint"),
    )
