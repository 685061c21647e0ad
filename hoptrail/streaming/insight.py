"""Streaming forms of sessions, rolling statistics and the detectors of scans, floods and cascades.

Results are meant for append mode: a window is emitted once the watermark has
passed its end. `lateness` is how late a trace may arrive and still count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import is_5xx, is_error, present, service_node
from hoptrail.operators import detect


def _watermarked(traces: DataFrame, lateness: str) -> DataFrame:
    return traces.withWatermark("event_timestamp", lateness)


def session_stream(
    traces: DataFrame, gap_seconds: int = 1800, lateness: str = "10 minutes"
) -> DataFrame:
    """Closed sessions per caller; a pause of exactly the gap does not end one."""
    session = F.session_window("event_timestamp", f"{gap_seconds} seconds")
    closed = (
        _watermarked(traces, lateness)
        .groupBy(session.alias("session"), "id_consumer")
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_error()).alias("errors"))
    )
    start = F.col("session.start")
    end = F.timestamp_add("SECOND", F.lit(-gap_seconds), F.col("session.end"))
    return closed.select(
        "id_consumer",
        start.alias("session_start"),
        end.alias("session_end"),
        "requests",
        "errors",
        ((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0)).alias("duration_s"),
    )


def rolling_stats_stream(
    traces: DataFrame, window_seconds: int = 30, lateness: str = "1 minute"
) -> DataFrame:
    return detect.rolling_stats(_watermarked(traces, lateness), window_seconds=window_seconds)


def scanner_stream(traces: DataFrame, lateness: str = "1 minute", **thresholds) -> DataFrame:
    return detect.scanners(_watermarked(traces, lateness), **thresholds)


def flood_stream(
    traces: DataFrame,
    window_seconds: int = 60,
    trailing: int = 10,
    min_requests: int = 100,
    factor: float = 5.0,
    lateness: str = "1 minute",
) -> DataFrame:
    """`detect.floods` of a stream: a window far above the mean of the `trailing` before it.

    Two stateful steps: requests are counted per window, and a closed window's count goes into the
    spans of `trailing` windows and one more that it is in. The last window of a span is
    judged by those before; idle ones are missing from the sum, so they count as zero.
    State holds one count per key and window, and leaves with the watermark.
    """
    keys = ["zona", "endpoint", "id_consumer"]
    counts = (
        _watermarked(traces, lateness)
        .groupBy(F.window("event_timestamp", f"{window_seconds} seconds").alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    span = F.window("w", f"{(trailing + 1) * window_seconds} seconds", f"{window_seconds} seconds")
    judged = F.timestamp_add("SECOND", F.lit(-window_seconds), F.col("span.end"))
    # Which of a span's windows is the last is told by its own start, kept beside its count.
    spans = (
        counts.withColumns({"at": F.col("w.start"), "span": span})
        .groupBy("span", *keys)
        .agg(
            F.sum(F.when(F.col("at") == judged, F.col("n"))).alias("requests"),
            F.sum(F.when(F.col("at") < judged, F.col("n"))).alias("before"),
        )
    )
    mean = F.coalesce("before", F.lit(0)) / F.lit(float(trailing))
    return spans.select(
        judged.alias("window_start"), *keys, "requests", mean.alias("trailing_mean")
    ).where((F.col("requests") >= min_requests) & (F.col("requests") > F.lit(factor) * F.col("trailing_mean")))


def cascade_stream(
    traces: DataFrame, edges: DataFrame, min_share: float = 0.0, lateness: str = "1 minute"
) -> DataFrame:
    """`detect.cascades` of a stream, with a fixed table of edges.

    Failures are counted per service and minute on both sides of a stream-stream join, callers
    with their callees in the same minute. A minute's rows leave the state once the watermark has
    passed it; a callee idle in that minute is reported then, with 0 requests.
    """

    def failing() -> DataFrame:
        counted = (
            _watermarked(traces, lateness)
            .where(present("id_recurso"))
            .groupBy(F.window("event_timestamp", "60 seconds").alias("w"), service_node().alias("service"))
            .agg(F.count(F.lit(1)).alias("requests"), F.count_if(is_5xx()).alias("failures"))
        )
        share = F.col("failures") / F.col("requests").cast("double")
        return counted.where("service IS NOT NULL").withColumn("failure_share", share)

    calls = edges.select(F.col("source").alias("service"), F.col("target").alias("callee")).distinct()
    callers = failing().where(F.col("failure_share") >= min_share).join(calls, "service", "left")
    callees = failing().select(
        F.col("w").alias("callee_w"),
        F.col("service").alias("called"),
        F.col("requests").alias("callee_requests"),
        F.col("failure_share").alias("callee_failure_share"),
    )
    met = callers.join(callees, (F.col("w") == F.col("callee_w")) & (F.col("callee") == F.col("called")), "left")
    return met.select(
        F.col("w.start").alias("minute"),
        "service",
        "requests",
        "failures",
        "failure_share",
        "callee",
        F.coalesce("callee_requests", F.lit(0)).alias("callee_requests"),
        "callee_failure_share",
    )
