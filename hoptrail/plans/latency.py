"""Mean, spread and percentiles of latency from a latency histogram.

Durations are whole milliseconds, so rows are first counted per key *and*
duration. That step combines on the map side and spreads even a single hot key
over its durations; what is left per key is one row per distinct duration,
whatever the number of traces. Percentiles taken from it are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LATENCY = "time_transaction"


def latency_profile(
    df: DataFrame,
    keys: Sequence[str],
    percents: Sequence[int],
    measures: dict[str, Column] | None = None,
    spread: bool = True,
) -> DataFrame:
    """Per key: `n`, `mean`, `stddev` (if `spread`), `p<percent>` and the measures.

    A measure is a count or a sum, so that partial results may be added up.
    Percentiles are observed values: the least one with at least that share of
    the traces at or below it. Null durations count in `n` only.
    """
    measures = measures or {}
    histogram = df.groupBy(*keys, LATENCY).agg(
        F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in measures.items()]
    )

    # One order for both frames, so that the rows are sorted once.
    by_latency = Window.partitionBy(*keys).orderBy(LATENCY)
    per_key = by_latency.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upwards = by_latency.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latency, timed = F.col(LATENCY).cast("double"), F.col("_timed")
    ranked = histogram.withColumn(
        "_timed", F.when(F.col(LATENCY).isNotNull(), F.col("n")).otherwise(0)
    ).withColumns(
        {"_all": F.sum(timed).over(per_key), "_upto": F.sum(timed).over(upwards)}
        | ({"_total": F.sum(latency * timed).over(per_key)} if spread else {})
    )

    def percentile(percent: int) -> Column:
        reached = F.col("_upto") * 100 >= F.col("_all") * percent
        return F.min(F.when(reached, latency)).alias(f"p{percent}")

    results = [
        F.sum("n").alias("n"),
        F.try_divide(F.sum(latency * timed), F.sum(timed)).alias("mean"),
        *[percentile(p) for p in percents],
        *[F.sum(name).alias(name) for name in measures],
    ]
    if spread:
        off_mean = latency - F.try_divide("_total", "_all")
        freedom = F.sum(timed) - 1
        variance = F.try_divide(F.sum(timed * off_mean * off_mean), freedom)
        results.append(F.when(freedom > 0, F.sqrt(variance)).alias("stddev"))
    return ranked.groupBy(*keys).agg(*results)
