"""Detectors for scans, floods and failure cascades, and rolling statistics.

Thresholds are parameters: they depend on an installation's normal traffic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.traces import is_5xx, present
from hoptrail.plans.filters import EVERYTHING, TraceFilter
from hoptrail.plans.services import node, per_service


def _timed(traces: DataFrame, flt: TraceFilter, seconds: int) -> DataFrame:
    """Traces that have a time, with their tumbling window `w`, aligned to the epoch."""
    window = F.window("event_timestamp", f"{seconds} seconds")
    return flt.apply(traces).withColumn("w", window)


def scanners(
    traces: DataFrame,
    flt: TraceFilter = EVERYTHING,
    window_seconds: int = 60,
    min_requests: int = 20,
    min_share_404: float = 0.5,
    min_paths: int = 5,
) -> DataFrame:
    """Callers probing many paths with mostly 404 answers, per window.

    Paths are counted in two steps, so the distinct count needs no row twice
    and a busy scanner is spread over its paths first.
    """
    per_path = (
        _timed(traces, flt, window_seconds)
        .groupBy("w", "id_consumer", "endpoint")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("status_response") == 404).alias("n404"),
        )
    )
    return (
        per_path.groupBy("w", "id_consumer")
        .agg(
            F.sum("n").alias("requests"),
            F.sum("n404").alias("not_found"),
            F.count("endpoint").alias("paths"),
        )
        .withColumn("share_404", F.col("not_found") / F.col("requests").cast("double"))
        .where(
            (F.col("requests") >= min_requests)
            & (F.col("share_404") >= min_share_404)
            & (F.col("paths") >= min_paths)
        )
        .select(
            F.col("w.start").alias("window_start"),
            "id_consumer",
            "requests",
            "not_found",
            "paths",
            "share_404",
        )
    )


def floods(
    traces: DataFrame,
    flt: TraceFilter = EVERYTHING,
    window_seconds: int = 60,
    trailing: int = 10,
    min_requests: int = 100,
    factor: float = 5.0,
) -> DataFrame:
    """Windows in which one caller hits one endpoint far above its trailing mean.

    The mean is over the `trailing` windows before, idle ones counting as zero; windows before
    the selection are read for it, and a window that reaches into the selection counts whole.
    Each window partition holds counts per time window, not traces.
    """
    counts = (
        _timed(traces, flt.reaching_back((trailing + 1) * window_seconds), window_seconds)
        .groupBy("w", "zona", "endpoint", "id_consumer")
        .agg(F.count(F.lit(1)).alias("requests"))
        .select(
            F.col("w.start").alias("window_start"), "zona", "endpoint", "id_consumer", "requests"
        )
        .withColumn("_at", F.unix_seconds("window_start"))
    )
    before = (
        Window.partitionBy("zona", "endpoint", "id_consumer")
        .orderBy("_at")
        .rangeBetween(-trailing * window_seconds, -1)
    )
    mean = F.coalesce(F.sum("requests").over(before), F.lit(0)) / F.lit(float(trailing))
    return (
        counts.withColumn("trailing_mean", mean)
        .where(
            (F.col("requests") >= min_requests)
            & (F.col("requests") > F.lit(factor) * F.col("trailing_mean"))
            & flt.reaches(F.col("window_start"), window_seconds)
        )
        .drop("_at")
    )


def failures_by_minute(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Requests and 5xx answers per service (`zone/service`) and minute."""
    totals = per_service(
        _timed(traces, flt, 60).where(present("id_recurso")),
        ["w"],
        {"requests": F.count(F.lit(1)), "failures": F.count_if(is_5xx())},
    )
    return totals.select(
        F.col("w.start").alias("minute"),
        node().alias("service"),
        "requests",
        "failures",
        (F.col("failures") / F.col("requests").cast("double")).alias("failure_share"),
    )


def cascades(
    traces: DataFrame,
    edges: DataFrame,
    flt: TraceFilter = EVERYTHING,
    min_share: float = 0.0,
) -> DataFrame:
    """Failure share per service and minute beside that of each service it calls.

    `edges` has `source` and `target` nodes (`zone/service`): declared ones from
    the manifests or observed ones. Requests to a resource without a service
    name are left to `failures_by_minute`, as no edge can name it. A callee idle
    in that minute, like a missing one, has 0 requests and no share.
    """
    # The same rows serve as callers and as callees, so one shuffle serves both.
    failing = failures_by_minute(traces, flt).where(
        "minute IS NOT NULL AND service IS NOT NULL"
    )
    callers = failing.where(F.col("failure_share") >= min_share)
    callees = failing.select(
        "minute",
        F.col("service").alias("callee"),
        F.col("requests").alias("callee_requests"),
        F.col("failure_share").alias("callee_failure_share"),
    )
    calls = edges.select(F.col("source").alias("service"), F.col("target").alias("callee"))
    joined = callers.join(calls.distinct(), "service", "left").join(
        callees, ["minute", "callee"], "left"
    )
    return joined.withColumn("callee_requests", F.coalesce("callee_requests", F.lit(0)))


def status_shares(windowed: DataFrame, keys: list) -> DataFrame:
    """Request statistics of each window; for batches and streams alike.

    Here every status below 300 counts as 2xx, 300 to 499 as 4xx, and a missing
    status as an error.
    """
    status = F.col("status_response")
    total = F.count(F.lit(1))
    classes = {
        "2xx": status < 300,
        "4xx": (status >= 300) & (status < 500),
        "5xx": status >= 500,
        "err": status.isNull(),
    }
    counted = windowed.groupBy(*keys).agg(
        total.alias("requests"),
        *[F.count_if(test).alias(f"n_{name}") for name, test in classes.items()],
        F.avg("time_transaction").alias("mean_latency"),
    )
    return counted.withColumns(
        {
            f"pct_{name}": F.col(f"n_{name}") * F.lit(100.0) / F.col("requests")
            for name in classes
        }
    )


def rolling_stats(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, window_seconds: int = 30
) -> DataFrame:
    """Status shares and mean latency of each 30-second window."""
    stats = status_shares(_timed(traces, flt, window_seconds), ["w"])
    return stats.select(F.col("w.start").alias("window_start"), *stats.columns[1:])
