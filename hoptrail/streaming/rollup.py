"""Minute roll-up kept by a stream over the landed files, and the view that completes it.

The stream reads what `start_landing` has committed. Its state is keyed by the minutes of the
traces *and* by when their file landed, and the watermark follows the landing: a trace may be
late by any time, it is never late to land. Once a span of landing has passed the watermark,
its partial results are appended to the roll-up and leave the state. A minute has one partial
result per span in which some of its traces landed; readers add them up.

The query's checkpoint tells up to when landed files are rolled up. `rollup_view` takes the
stored partial results up to there, and rolls up the few files that landed since.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from hoptrail.plans.rollup import ROLLUP_COLUMNS, ROLLUP_DDL, partials
from hoptrail.schema import PARTITION_COLUMNS, TRACE_DDL
from hoptrail.sources.files import exists, list_names, read_text

#: Length of a span of landing.
SPAN_SECONDS = 120
LANDED = "_landed"
SPAN_END = "span_end"
_STORED = f"{ROLLUP_DDL}, {SPAN_END} timestamp"


def landing_stream(spark: SparkSession, root: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the traces of one landing root, each file once it is committed."""
    reader = spark.readStream.schema(TRACE_DDL)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(root).withColumn(LANDED, F.col("_metadata.file_modification_time"))


def rollup_stream(landed: DataFrame, span_seconds: int = SPAN_SECONDS, delay: str = "0 seconds") -> DataFrame:
    """Partial results of closed spans, for append mode.

    One sink writes a root's files batch after batch, so they arrive in the order in which they
    landed; `delay` is for roots with several writers, whose files may come in another order.
    """
    span = F.window(LANDED, f"{span_seconds} seconds")
    rolled = partials(landed.withWatermark(LANDED, delay), [span.alias("span")])
    return rolled.select(*ROLLUP_COLUMNS, F.col("span.end").alias(SPAN_END))


def start_rollup(
    spark: SparkSession,
    landing_root: str,
    rollup_root: str,
    checkpoint: str,
    trigger: dict | None = None,
    span_seconds: int = SPAN_SECONDS,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Keep the roll-up of one landing root, by zone and hour of the traces, every 2 minutes by default."""
    rolled = rollup_stream(landing_stream(spark, landing_root, files_per_batch), span_seconds)
    return (
        rolled.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .option("path", rollup_root)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 minutes"}))
        .start()
    )


def rolled_up_to(spark: SparkSession, checkpoint: str) -> datetime:
    """Landing time before which all files' traces are in spans that the sink has committed.

    The last committed batch closed all spans that ended by the watermark it ran with; a span
    that holds the watermark is open still, which costs the reader no more than that span's files.
    """
    none = datetime.fromtimestamp(0, timezone.utc)
    commits = [int(n) for n in list_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    if not commits:
        return none
    # First line: version; second: the batch's watermark and configuration.
    meta = json.loads(read_text(spark, f"{checkpoint}/offsets/{max(commits)}").split("\n")[1])
    return none + timedelta(milliseconds=meta["batchWatermarkMs"])


def rollup_view(
    spark: SparkSession, landing_root: str, rollup_root: str, checkpoint: str, span_seconds: int = SPAN_SECONDS
) -> DataFrame:
    """Roll-up rows of all that has landed, each trace in one of them.

    The boundary is read first and both sides obey it, so a batch that commits in between
    doubles nothing. Files before it are left out by their time when the scan is planned: of
    closed spans no trace file is opened.
    """
    edge = rolled_up_to(spark, checkpoint).timestamp() // span_seconds * span_seconds
    boundary = F.timestamp_seconds(F.lit(int(edge)))
    landed = spark.read.schema(TRACE_DDL).parquet(landing_root)
    fresh = partials(landed.where(F.col("_metadata.file_modification_time") >= boundary))
    if not exists(spark, rollup_root):
        return fresh.select(*ROLLUP_COLUMNS)
    stored = spark.read.schema(_STORED).parquet(rollup_root).where(F.col(SPAN_END) <= boundary)
    return stored.select(*ROLLUP_COLUMNS).unionByName(fresh.select(*ROLLUP_COLUMNS))
