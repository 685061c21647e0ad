"""Service graph, zone matrix and service error ranking.

These views follow the zone choice of a filter, not its endpoint choice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.callers import EXTERNAL, UNKNOWN
from hoptrail.functions.traces import is_2xx, is_5xx, percent, present
from hoptrail.plans.filters import EVERYTHING, TraceFilter
from hoptrail.plans.numbering import number_rows
from hoptrail.plans.services import node, per_service

# Fixed value: title of the node that stands for all outside callers.
CLIENTS = "clients"


def caller_columns() -> list[Column]:
    """Node id, title and zone of the caller."""
    zone, service = F.col("source_zone"), F.col("source_service")
    outside = (
        (F.col("consumer_type") == EXTERNAL) | zone.isNull() | zone.isin("", UNKNOWN)
    )
    return [
        F.when(outside, EXTERNAL).otherwise(F.concat(zone, F.lit("/"), service)).alias("source"),
        F.when(outside, CLIENTS).otherwise(service).alias("caller"),
        F.when(outside, EXTERNAL).otherwise(zone).alias("caller_zone"),
    ]


def service_nodes(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, merge: bool = False
) -> DataFrame:
    """Callers with their request count, and services called, with 0.

    A node that both calls and is called has two rows; `merge` adds them up.
    The traces are scanned once: pairs are counted first, and only the few
    counted pairs are then taken apart into their two ends.
    """
    named = present("id_recurso")
    pairs = per_service(
        flt.apply(traces, by_endpoint=False),
        caller_columns(),
        {"requests": F.count(F.lit(1)), "named": F.count_if(named)},
    )
    return ends_of(pairs, merge)


def ends_of(pairs: DataFrame, merge: bool) -> DataFrame:
    """Counted pairs of caller and service taken apart into nodes."""
    ends = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.lit(0).alias("end"),
                    F.col("source").alias("id"),
                    F.col("caller").alias("title"),
                    F.col("caller_zone").alias("subtitle"),
                    "requests",
                ),
                F.struct(
                    F.lit(1).alias("end"),
                    node().alias("id"),
                    F.col("service").alias("title"),
                    F.col("zona").alias("subtitle"),
                    F.lit(0).cast("bigint").alias("requests"),
                ),
            )
        ).alias("e"),
        "named",
    ).where("e.end = 0 OR named > 0")
    keys = ["e.id", "e.title", "e.subtitle"] + ([] if merge else ["e.end"])
    return (
        ends.groupBy(*keys)
        .agg(F.sum("e.requests").alias("mainstat"))
        .select("id", "title", "subtitle", "mainstat")
    )


def service_calls(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Observed calls: source, target, number of requests, mean latency."""
    calls = per_service(
        flt.apply(traces, by_endpoint=False).where(present("id_recurso")),
        caller_columns()[:1],
        {
            "requests": F.count(F.lit(1)),
            "time": F.sum(F.col("time_transaction").cast("double")),
            "timed": F.count("time_transaction"),
        },
    )
    # A target of unknown service is null in every zone, hence added up once more.
    return (
        calls.groupBy("source", node().alias("target"))
        .agg(
            F.sum("requests").alias("requests"),
            F.try_divide(F.sum("time"), F.sum("timed")).alias("mean_latency"),
        )
    )


def service_edges(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Graph edges with a running id; both figures as text for the panel."""
    return number_rows(edge_columns(service_calls(traces, flt)), ["source", "target"])


def edge_columns(calls: DataFrame) -> DataFrame:
    return calls.select(
        "source",
        "target",
        F.col("requests").cast("string").alias("mainstat"),
        F.round("mean_latency", 0).cast("string").alias("secondarystat"),
    )


def zone_matrix(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Zone to zone traffic.

    Rows are grouped by the raw source zone, so a null, an empty and an
    `external` zone stay separate rows although they share one label.
    """
    total = F.count(F.lit(1))
    return matrix_columns(
        flt.apply(traces, by_endpoint=False)
        .groupBy("source_zone", "zona")
        .agg(
            total.alias("total_requests"),
            F.round(F.avg("time_transaction"), 1).alias("avg_latency_ms"),
            F.round(F.max("time_transaction").cast("double"), 1).alias("max_latency_ms"),
            F.round(percent(F.count_if(is_5xx()), total), 2).alias("error_rate_pct"),
            F.round(percent(F.count_if(is_2xx()), total), 2).alias("success_rate_pct"),
        )
    )


def matrix_columns(totals: DataFrame) -> DataFrame:
    return (
        totals.select(
            F.coalesce(F.nullif("source_zone", F.lit("")), F.lit(EXTERNAL)).alias("origen"),
            F.col("zona").alias("destino"),
            "total_requests",
            "avg_latency_ms",
            "max_latency_ms",
            "error_rate_pct",
            "success_rate_pct",
        )
        .orderBy(F.desc_nulls_last("total_requests"), "origen", "destino")
    )


def service_error_ranking(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    totals = per_service(
        flt.apply(traces, by_endpoint=False).where(present("id_recurso")),
        [],
        {"total": F.count(F.lit(1)), "failures": F.count_if(is_5xx())},
    )
    return ranking_columns(totals)


def ranking_columns(totals: DataFrame) -> DataFrame:
    return totals.select(
        node().alias("servicio"),
        F.round(percent(F.col("failures"), F.col("total")), 2).alias("error_rate_pct"),
        "total",
    ).orderBy(F.desc_nulls_last("error_rate_pct"), F.asc_nulls_last("servicio"))


def service_catalogue(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Services seen per zone, one row each zone with a sorted list."""
    return (
        per_service(flt.apply(traces, by_endpoint=False), [], {"n": F.count(F.lit(1))})
        .where("service IS NOT NULL")
        .groupBy("zona")
        .agg(F.sort_array(F.collect_set("service")).alias("services"))
    )


def edge_drift(declared: DataFrame, calls: DataFrame, traces_per_service: DataFrame) -> DataFrame:
    """Declared against observed calls inside each zone.

    `declared` comes from the topology manifests, `calls` from `service_calls`
    and `traces_per_service` from `requests_per_service`. `status` is
    `missing` (declared, never seen), `undeclared` (seen, not declared) or
    `matched`; `observed_share` is calls per request the caller answered, to be
    read against the declared `probability`.
    """
    return _drift(declared, calls, traces_per_service).drop("served")


def _drift(declared: DataFrame, calls: DataFrame, traces_per_service: DataFrame) -> DataFrame:
    wanted = (
        declared.where("target IS NOT NULL")
        .select(
            F.concat("zone", F.lit("/"), "app").alias("source"),
            F.concat("zone", F.lit("/"), "target").alias("target"),
            "probability",
        )
        .groupBy("source", "target")
        .agg(F.sum("probability").alias("probability"))
    )
    seen = calls.where(F.col("source") != EXTERNAL).select("source", "target", "requests")
    served = traces_per_service.select(F.col("node").alias("source"), "served")
    return (
        wanted.join(seen, ["source", "target"], "full_outer")
        .join(served, "source", "left")
        .select(
            "source",
            "target",
            F.when(F.col("requests").isNull(), "missing")
            .when(F.col("probability").isNull(), "undeclared")
            .otherwise("matched")
            .alias("status"),
            "probability",
            F.coalesce("requests", F.lit(0)).alias("requests"),
            F.try_divide(F.coalesce("requests", F.lit(0)).cast("double"), "served").alias(
                "observed_share"
            ),
            "served",
        )
    )


def requests_per_service(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Requests answered by each service, as `node` (`zone/service`) and `served`."""
    totals = per_service(
        flt.apply(traces, by_endpoint=False), [], {"served": F.count(F.lit(1))}
    )
    return totals.where("service IS NOT NULL").select(node().alias("node"), "served")


# Coefficients of the rational approximation of the normal tail by Abramowitz and
# Stegun (26.2.17), off by less than 7.5e-8.
_TAIL_SCALE = 0.2316419
_TAIL = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def _two_sided(z: Column) -> Column:
    """Chance that a normal value is as far from 0 as `z`."""
    far = F.abs(z)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(_TAIL_SCALE) * far)
    sum_ = F.lit(0.0)
    for c in reversed(_TAIL):
        sum_ = (sum_ + F.lit(c)) * t
    return F.least(F.lit(1.0), F.lit(2.0 / math.sqrt(2 * math.pi)) * F.exp(-far * far / 2) * sum_)


def edge_drift_significance(
    declared: DataFrame,
    calls: DataFrame,
    traces_per_service: DataFrame,
    z: float = 1.959964,
    rate: float = 0.05,
) -> DataFrame:
    """`edge_drift` with what chance alone explains.

    `share_low` and `share_high` are the Wilson score interval of the observed share (95 % by
    default), `p_value` is that of the score test against the declared probability, and `drifted`
    marks the edges whose share differs, at a false-discovery rate of at most `rate` over all
    edges (Benjamini and Hochberg). An edge whose caller answered nothing is not tested. Calls
    beyond one per request count as one, a probability above 1 as 1. An undeclared edge has
    probability 0; there, and at 1, any other share has the p-value 0.

    Edges are pairs of services, so they are few, and are ranked by p-value in one task.
    """
    n = F.col("served").cast("double")
    share = F.least(F.col("requests") / n, F.lit(1.0))
    expected = F.least(F.coalesce("probability", F.lit(0.0)), F.lit(1.0))
    shrunk = F.lit(1.0) + F.lit(z * z) / n
    middle = (share + F.lit(z * z / 2) / n) / shrunk
    half = F.lit(z) / shrunk * F.sqrt(share * (F.lit(1.0) - share) / n + F.lit(z * z / 4) / (n * n))
    error = F.sqrt(expected * (F.lit(1.0) - expected) / n)
    p_value = (
        F.when(share == expected, 1.0)
        .when((expected <= 0) | (expected >= 1), 0.0)
        .otherwise(_two_sided((share - expected) / error))
    )
    tested = _drift(declared, calls, traces_per_service).withColumns(
        {
            name: F.when(n > 0, value)
            for name, value in {
                "share_low": F.greatest(middle - half, F.lit(0.0)),
                "share_high": F.least(middle + half, F.lit(1.0)),
                "p_value": p_value,
            }.items()
        }
    )
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy(F.asc_nulls_last("p_value")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    allowed = F.lit(rate) * F.count("p_value").over(upto) / F.count("p_value").over(everything)
    # The greatest p-value that keeps the rate takes all lesser ones along.
    kept = tested.withColumn("_kept", F.when(F.col("p_value") <= allowed, F.col("p_value")))
    limit = F.max("_kept").over(everything)
    return kept.withColumn("drifted", F.coalesce(F.col("p_value") <= limit, F.lit(False))).drop("_kept", "served")
