"""Sessions of a caller and the shopping funnel over them.

A session goes on while the pause between two requests is at most the gap.
Traces are first reduced to one row per caller and time cell as wide as the
gap: requests inside a cell always share a session. That reduction combines on
the map side, so even a caller holding a third of all traces leaves at most
`time span / gap` rows for the window that joins cells into sessions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoptrail.functions.callers import person_kind
from hoptrail.functions.traces import cell_start, is_error
from hoptrail.plans.filters import EVERYTHING, TraceFilter

# The endpoint behind each step of a visit, in order.
FUNNEL_STEPS = {
    "browsing": "/catalog-api/products",
    "checkout": "/orders-api/checkout",
    "validating": "/auth-api/validate",
}


def _sessions(
    traces: DataFrame, gap_seconds: int, measures: dict[str, Column], parts: dict[str, Column] | None = None
) -> DataFrame:
    """Sessions with their measures added up; of `parts` they have the cells' values in order."""
    parts = parts or {}
    cell = cell_start(F.col("event_timestamp"), gap_seconds)
    cells = (
        traces.where(F.col("event_timestamp").isNotNull())
        .groupBy("id_consumer", cell.alias("cell"))
        .agg(
            F.min("event_timestamp").alias("first"),
            F.max("event_timestamp").alias("last"),
            *[m.alias(name) for name, m in (measures | parts).items()],
        )
    )
    in_order = Window.partitionBy("id_consumer").orderBy("cell")
    pause = F.unix_micros("first") - F.unix_micros(F.lag("last").over(in_order))
    starts = F.when(pause.isNull() | (pause > gap_seconds * 1_000_000), 1).otherwise(0)
    return (
        cells.withColumn("starts", starts)
        .withColumn("session", F.sum("starts").over(in_order))
        .groupBy("id_consumer", "session")
        .agg(
            F.min("first").alias("session_start"),
            F.max("last").alias("session_end"),
            *[F.sum(name).alias(name) for name in measures],
            *[F.array_sort(F.collect_list(F.struct("cell", name)))[name].alias(name) for name in parts],
        )
    )


def sessions(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, gap_seconds: int = 1800
) -> DataFrame:
    """Requests, errors and duration of every session of every caller."""
    measures = {"requests": F.count(F.lit(1)), "errors": F.count_if(is_error())}
    duration = F.unix_micros("session_end") - F.unix_micros("session_start")
    return _sessions(flt.apply(traces), gap_seconds, measures).select(
        "id_consumer",
        "session_start",
        "session_end",
        "requests",
        "errors",
        (duration / F.lit(1_000_000.0)).alias("duration_s"),
    )


def funnel(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, gap_seconds: int = 1800
) -> DataFrame:
    """Per kind of person: sessions reaching each step, and conversion per step.

    A session reaches a step when it has a request of it and reached the step
    before. Callers that are no persons are counted as `other`.
    """
    visits = _sessions(
        flt.apply(traces),
        gap_seconds,
        {step: F.count_if(F.col("endpoint") == url) for step, url in FUNNEL_STEPS.items()},
    )
    reached, so_far = {}, F.lit(True)
    for step in FUNNEL_STEPS:
        so_far = so_far & (F.col(step) > 0)
        reached[step] = F.count_if(so_far)
    return _by_kind(visits, reached)


def ordered_funnel(
    traces: DataFrame, flt: TraceFilter = EVERYTHING, gap_seconds: int = 1800
) -> DataFrame:
    """The funnel with its steps in order: a session reaches a step when it has a request of it
    no earlier than the first request with which it reached the step before.

    Log times are whole seconds, so requests of one second count as being in order. A time cell is
    reduced to what it does to a visitor: for each step reached before it, the step reached after
    it. That is read from the cell's distinct (second, step) pairs, at most `gap_seconds` times
    the number of steps, however busy the caller. A session then follows its cells in order.
    """
    steps = list(FUNNEL_STEPS)
    n = len(steps)
    number = F.lit(None).cast("long")
    for i, url in enumerate(FUNNEL_STEPS.values(), 1):
        number = F.when(F.col("endpoint") == url, F.lit(i).cast("long")).otherwise(number)
    # One number for a second and a step, ordered by both.
    seen = F.array_sort(F.collect_set(F.unix_seconds("event_timestamp") * (n + 1) + number))

    def after(before: int) -> Column:
        return F.aggregate(
            seen,
            F.lit(before).cast("long"),
            lambda state, x: F.when(F.pmod(x, F.lit(n + 1)) == state + 1, state + 1).otherwise(state),
        )

    counts = {step: F.count_if(F.col("endpoint") == url) for step, url in FUNNEL_STEPS.items()}
    visits = _sessions(flt.apply(traces), gap_seconds, counts, {"moves": F.array(*[after(i) for i in range(n)])})
    state = F.aggregate(
        "moves", F.lit(0).cast("long"), lambda s, cell: F.coalesce(F.get(cell, s.cast("int")), s)
    )
    return _by_kind(
        visits.withColumn("reached", state),
        {step: F.count_if(F.col("reached") >= i) for i, step in enumerate(steps, 1)},
    )


def _by_kind(visits: DataFrame, reached: dict[str, Column]) -> DataFrame:
    """Sessions that reached each step and conversions, per kind of person."""
    steps = list(FUNNEL_STEPS)
    counted = visits.groupBy(
        F.coalesce(person_kind(F.col("id_consumer")), F.lit("other")).alias("kind")
    ).agg(
        F.count(F.lit(1)).alias("sessions"),
        *[count.alias(f"{step}_sessions") for step, count in reached.items()],
        *[F.sum(step).alias(f"{step}_requests") for step in steps],
    )
    return counted.withColumns(
        {
            f"{before}_to_{after}": F.try_divide(
                F.col(f"{after}_sessions").cast("double"), f"{before}_sessions"
            )
            for before, after in zip(steps, steps[1:])
        }
    )
