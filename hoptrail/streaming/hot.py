"""Recent-window table: the last minutes of traces as JSON payloads.

Each micro-batch owns one slot, `query=<zone and query id>/batch_id=<n>/ingest_ms=<time>`. A
replayed batch overwrites its slot, so nothing is doubled; another zone, or a query with a
new checkpoint, whose ids start again at 0, has slots of its own. Readers pick slots by the
partition value `ingest_ms`; slots past their time are dropped by folder.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from hoptrail.functions.traces import iso_time
from hoptrail.sources.files import delete, exists, list_names

# Fixed value: how long a trace stays in the table.
RETENTION_SECONDS = 15 * 60
SLOT_DDL = "zona string, payload string, query string, batch_id bigint, ingest_ms bigint"


def _now_ms() -> int:
    return int(time.time() * 1000)


def payload(columns: Sequence[str]) -> Column:
    """The columns as one JSON object, nulls kept, the event time as ISO text."""
    fields = [
        iso_time(F.col(name)).alias(name) if name == "event_timestamp" else F.col(name)
        for name in columns
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def write_slot(batch: DataFrame, batch_id: int, root: str, now_ms: int, owner: str = "batch") -> None:
    (
        batch.select("zona", payload(batch.columns).alias("payload"))
        .withColumn("ingest_ms", F.lit(now_ms).cast("bigint"))
        .write.mode("overwrite")
        .partitionBy("ingest_ms")
        .parquet(f"{root}/query={owner}/batch_id={batch_id}")
    )


def _values(names: list[str], key: str) -> list[int]:
    """Partition values of the folders `<key>=<value>`, in order."""
    pairs = [name.partition("=") for name in names]
    return sorted(int(value) for found, _, value in pairs if found == key)


def drop_expired(
    spark: SparkSession, root: str, now_ms: int, retention_seconds: int = RETENTION_SECONDS
) -> int:
    """Delete slots older than twice the retention; returns how many.

    The second span is grace for readers that listed a slot just in time. Every slot is
    looked at: only its time says whether it is wanted, not its id.
    """
    oldest, dropped = now_ms - 2 * retention_seconds * 1000, 0
    for query in list_names(spark, root):
        for batch in list_names(spark, f"{root}/{query}") if query.startswith("query=") else []:
            slot = f"{root}/{query}/{batch}"
            times = _values(list_names(spark, slot), "ingest_ms")
            if times and max(times) < oldest:
                delete(spark, slot)
                dropped += 1
    return dropped


def read_recent(
    spark: SparkSession,
    root: str,
    retention_seconds: int = RETENTION_SECONDS,
    now_ms: int | None = None,
) -> DataFrame:
    """Payloads that arrived within the retention; none before the first batch."""
    if not exists(spark, root):
        return spark.createDataFrame([], SLOT_DDL)
    oldest = (now_ms or _now_ms()) - retention_seconds * 1000
    slots = spark.read.schema(SLOT_DDL).parquet(root)
    return slots.where(F.col("ingest_ms") > oldest)


def query_id(spark: SparkSession) -> str:
    """Id of the streaming query whose batch is being written; its checkpoint keeps it."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_hot(
    traces: DataFrame,
    root: str,
    checkpoint: str,
    trigger: dict | None = None,
    retention_seconds: int = RETENTION_SECONDS,
    clock: Callable[[], int] = _now_ms,
    zone: str = "all",
) -> StreamingQuery:
    """Write traces to the recent-window table, every 5 seconds by default.

    A failing write fails the batch, which is then run again in full.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        now_ms = clock()
        write_slot(batch, batch_id, root, now_ms, f"{zone}-{query_id(batch.sparkSession)}")
        drop_expired(batch.sparkSession, root, now_ms, retention_seconds)

    return (
        traces.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
