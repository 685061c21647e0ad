"""Load over the day: profile, phases, overlay events and rising zones."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.traces import cell_start, hour_of_day
from hoptrail.plans.filters import EVERYTHING, TraceFilter

# Expected load by hour of day; straight lines between the points.
DAILY_CURVE = (
    (0, 0.1), (5, 0.1), (8, 0.7), (12, 1.0), (13, 1.0), (17, 0.8), (20, 0.3), (24, 0.1),
)
# Phases of the day and the hour each one ends.
DAY_PHASES = (
    ("night", 5), ("morning_ramp", 8), ("morning_peak", 12),
    ("midday_peak", 13), ("afternoon", 17), ("evening_decline", 20), ("night", 24),
)


class OverlayEvent(NamedTuple):
    """Something expected to change the load at an hour of the day."""

    kind: str
    at_hour: float
    duration_hours: float


def _first_match(cases: Sequence[tuple[Column, Column]]) -> Column:
    matched = F.lit(None)
    for condition, value in reversed(cases):
        matched = F.when(condition, value).otherwise(matched)
    return matched


def expected_load(hour: Column, curve: Sequence[tuple[float, float]] = DAILY_CURVE) -> Column:
    """The curve's value at an hour; piecewise linear."""
    return _first_match(
        [
            (
                (hour >= h0) & (hour < h1),
                F.lit(float(m0)) + (hour - h0) / F.lit(float(h1 - h0)) * F.lit(m1 - m0),
            )
            for (h0, m0), (h1, m1) in zip(curve, curve[1:])
        ]
    )


def day_phase(hour: Column) -> Column:
    return _first_match([(hour < end, F.lit(name)) for name, end in DAY_PHASES])


def load_profile(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    """Requests per hour of day against the expected curve, both relative to their peak."""
    hourly = (
        flt.apply(traces)
        .where(F.col("event_timestamp").isNotNull())
        .groupBy(F.hour("event_timestamp").alias("hour_of_day"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    # At most 24 rows are left here, so one window over all of them is safe.
    peak = F.max("requests").over(Window.partitionBy())
    return hourly.select(
        "hour_of_day",
        day_phase(F.col("hour_of_day")).alias("phase"),
        "requests",
        (F.col("requests") / peak.cast("double")).alias("observed"),
        expected_load(F.col("hour_of_day")).alias("expected"),
    ).withColumn("deviation", F.col("observed") - F.col("expected"))


def volume_by_phase(traces: DataFrame, flt: TraceFilter = EVERYTHING) -> DataFrame:
    phase = day_phase(hour_of_day(F.col("event_timestamp")))
    return (
        flt.apply(traces)
        .groupBy(phase.alias("phase"), "zona")
        .agg(F.count(F.lit(1)).alias("requests"), F.avg("time_transaction").alias("mean_latency"))
    )


def tag_events(
    traces: DataFrame, events: Sequence[OverlayEvent], flt: TraceFilter = EVERYTHING
) -> DataFrame:
    """Add `event`: the first event whose interval [at, at + duration) holds the trace.

    The events are configuration, so they become one CASE expression: no join.
    """
    hour = hour_of_day(F.col("event_timestamp"))
    cases = [
        ((hour >= e.at_hour) & (hour < e.at_hour + e.duration_hours), F.lit(e.kind))
        for e in events
    ]
    return flt.apply(traces).withColumn("event", _first_match(cases).cast("string"))


def rising_zones(
    traces: DataFrame,
    flt: TraceFilter = EVERYTHING,
    step_seconds: int = 5,
    steps: int = 3,
) -> DataFrame:
    """Steps that end a strict rise of a zone's requests over `steps` steps.

    A step without traffic counts as zero; steps before the selection are read to tell a rise,
    and a step that reaches into the selection counts whole. The window per zone runs over counts
    per step, so its size depends on the time span and not on the traffic.
    """
    step = cell_start(F.col("event_timestamp"), step_seconds)
    counts = (
        flt.reaching_back((steps + 1) * step_seconds)
        .apply(traces)
        .where(F.col("event_timestamp").isNotNull())
        .groupBy("zona", step.alias("step"))
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    in_order = Window.partitionBy("zona").orderBy("step")
    width = step_seconds * 1_000_000

    # Only the oldest count of a rise can be zero, i.e. have no row.
    def count_before(back: int) -> Column:
        adjacent = F.lag("step", back).over(in_order) == F.col("step") - back * width
        return F.when(adjacent, F.lag("requests", back).over(in_order)).otherwise(0)

    names = [f"_back{back}" for back in range(1, steps + 1)]
    past = counts.withColumns({name: count_before(i) for i, name in enumerate(names, 1)})
    rises = F.lit(True)
    for newer, older in zip(["requests", *names], names):
        rises = rises & (F.col(newer) > F.col(older))
    in_selection = flt.reaches(F.timestamp_micros("step"), step_seconds)
    return past.where(rises & in_selection).select(
        "zona",
        F.timestamp_micros("step").alias("step_start"),
        "requests",
        F.col(names[-1]).alias("requests_before"),
    )
