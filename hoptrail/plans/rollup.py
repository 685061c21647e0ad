"""Partial results per minute that may be added up over any range of time.

A roll-up row holds counts, sums and a latency sketch of one minute, endpoint, answering
service and caller. All of them merge: rows of the same keys, wherever they come from, are
added up, and so are those of more minutes or fewer keys. Percentiles come from merged KLL
sketches; an observed value is returned whose rank is off by at most `RANK_ERROR` (with
99 % confidence), and exactly the right one while a sketch has seen at most `SKETCH` durations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import is_2xx, is_4xx, is_5xx, is_error, present, service_name
from hoptrail.schema import PARTITION_COLUMNS

#: Size parameter of the sketches, and the normalised rank error it stands for.
SKETCH = 800
RANK_ERROR = 2.296 / SKETCH**0.9723
CALLER = ["consumer_type", "source_zone", "source_service"]
KEYS = [*PARTITION_COLUMNS, "minute", "endpoint", "service", "named", *CALLER]
#: Spark types of what the roll-up table stores.
ROLLUP_DDL = (
    "year int, month int, day int, hour int, zona string, minute timestamp, endpoint string, service string, "
    "named boolean, consumer_type string, source_zone string, source_service string, requests bigint, ok bigint, "
    "client_errors bigint, server_errors bigint, errors bigint, received bigint, received_n bigint, sent bigint, "
    "sent_n bigint, time bigint, timed bigint, squares decimal(38,0), longest bigint, sketch binary"
)
ROLLUP_COLUMNS = [field.split()[0] for field in ROLLUP_DDL.replace("(38,0)", "").split(", ")]


def sums() -> dict[str, Column]:
    """Counts and sums by name; a merge adds them up."""
    exact = F.col("time_transaction").cast("decimal(19,0)")
    return {
        "requests": F.count(F.lit(1)),
        "ok": F.count_if(is_2xx()),
        "client_errors": F.count_if(is_4xx()),
        "server_errors": F.count_if(is_5xx()),
        "errors": F.count_if(is_error()),
        "received": F.sum("req_body_size"),
        "received_n": F.count("req_body_size"),
        "sent": F.sum("resp_body_size"),
        "sent_n": F.count("resp_body_size"),
        "time": F.sum("time_transaction"),
        "timed": F.count("time_transaction"),
        # Exact, so that the order of adding up doesn't matter.
        "squares": F.sum(exact * exact),
    }


def partials(traces: DataFrame, more_keys: Sequence[Column] = ()) -> DataFrame:
    """Roll-up rows of these traces, for batches and streams alike.

    `named` tells whether the trace names a resource, `service` is null where its name has none.
    Traces without a time are in rows without a minute.
    """
    keyed = traces.withColumns(
        {
            "minute": F.date_trunc("minute", "event_timestamp"),
            "service": service_name(F.col("id_recurso")),
            "named": F.coalesce(present("id_recurso"), F.lit(False)),
        }
    )
    return keyed.groupBy(*KEYS, *more_keys).agg(
        *[measure.alias(name) for name, measure in sums().items()],
        F.max("time_transaction").alias("longest"),
        F.kll_sketch_agg_bigint("time_transaction", F.lit(SKETCH)).alias("sketch"),
    )


def merged(rows: DataFrame, keys: Sequence[Column | str], percents: Sequence[int] = ()) -> DataFrame:
    """Roll-up rows added up by `keys`, with `p<percent>` where asked for.

    Merging combines on the map side: per task and key one sketch of bounded size is shuffled.
    """
    results = [F.sum(name).alias(name) for name in sums()] + [F.max("longest").alias("longest")]
    if percents:
        results.append(F.kll_merge_agg_bigint("sketch", F.lit(SKETCH)).alias("sketch"))
    found = rows.groupBy(*keys).agg(*results)
    # An empty sketch has no quantile to ask for.
    ranks = {
        f"p{p}": F.when(
            F.col("timed") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(p / 100)).cast("double")
        )
        for p in percents
    }
    return found.withColumns(ranks).drop("sketch") if percents else found


def mean_time() -> Column:
    return F.try_divide(F.col("time").cast("double"), F.col("timed"))


def spread_of_time() -> Column:
    """Sample standard deviation of latency; null below two durations."""
    off = F.col("squares").cast("double") - F.col("time").cast("double") * mean_time()
    return F.when(F.col("timed") > 1, F.sqrt(F.greatest(off, F.lit(0.0)) / (F.col("timed") - 1)))
