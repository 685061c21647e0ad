"""From log messages to the landing table and the recent-window table.

Both sinks run as queries of their own, with their own checkpoint and trigger,
over one normalisation plan: one may fail or lag without the other.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from hoptrail.functions.callers import NO_CALLER
from hoptrail.functions.traces import present
from hoptrail.plans.normalize import normalize_messages
from hoptrail.schema import PARTITION_COLUMNS, RECORD_COLUMNS
from hoptrail.sources.files import exists, read_text, write_text
from hoptrail.sources.lake import SINK_LOG
from hoptrail.streaming.hot import start_hot

# Names the query that a landing root belongs to; the underscore hides it from reads.
OWNER = "_owner"


def _query_id(spark, checkpoint: str) -> str | None:
    """The id that a query keeps in its checkpoint."""
    path = f"{checkpoint}/metadata"
    if not exists(spark, path):
        return None
    return json.loads(read_text(spark, path))["id"]


def _claim(spark, root: str, checkpoint: str) -> None:
    """Refuse a root that another query, or one with another checkpoint, has written to.

    A sink takes batch ids that its log has for committed and drops them without an error.
    """
    if not exists(spark, f"{root}/{SINK_LOG}"):
        return
    mine = _query_id(spark, checkpoint)
    owner = f"{root}/{OWNER}"
    theirs = read_text(spark, owner) if exists(spark, owner) else mine
    if mine is None or mine != theirs:
        raise ValueError(f"{root} belongs to another query or checkpoint; use a root per zone and query")


def start_landing(
    traces: DataFrame, root: str, checkpoint: str, trigger: dict | None = None, retention: str | None = None
) -> StreamingQuery:
    """Append traces to Parquet by zone and hour, every 2 minutes by default.

    The file sink commits each batch once, also when it is run again. Row
    counts are reported by the query's progress (`landing`), without a second
    pass. A late trace goes to the hour of its own time. A root belongs to one query and
    its checkpoint; any other is refused.

    The sink's log names all files ever written. With `retention` (such as `30 days`) it forgets older
    ones, whether or not they were compacted: it must be longer than compaction may fall behind.
    """
    spark = traces.sparkSession
    _claim(spark, root, checkpoint)
    counted = traces.observe(
        "landing",
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_timestamp").isNull()).alias("unreadable"),
    )
    query = (
        counted.writeStream.format("parquet")
        .partitionBy(*PARTITION_COLUMNS)
        .options(**({"retention": retention} if retention else {}))
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "2 minutes"}))
        .start()
    )
    if not exists(spark, f"{root}/{OWNER}"):
        write_text(spark, f"{root}/{OWNER}", query.id)
    return query


def without_resent(traces: DataFrame, within: str = "1 hour") -> DataFrame:
    """A stream of traces without those sent again.

    Shippers and brokers deliver at least once. A trace is dropped if one with the same
    transaction, caller, callee, time and all else that the record holds arrived up to `within`
    before, also across restarts. State is a digest per trace, kept for `within` after arrival;
    the watermark follows arrival, so a trace is never dropped for being late. A trace without a
    transaction id can't be told from another like it: all of those stay, and so do unreadable
    messages.
    """
    known = present("id_transaccion") & (F.col("id_transaccion") != NO_CALLER)
    marked = traces.where(known).withColumns(
        {"_arrived": F.current_timestamp(), "_mark": F.md5(F.to_json(F.struct(*RECORD_COLUMNS)))}
    )
    once = marked.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_mark"])
    return once.drop("_arrived", "_mark").unionByName(traces.where(~known))


def start_ingest(
    messages: DataFrame,
    zone: str,
    landing: str,
    hot: str,
    checkpoints: str,
    trigger: dict | None = None,
    resent_within: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Start both queries over a stream of messages with a `value` column.

    Zones may share `landing` and `hot`: each has a root of its own in them. With
    `resent_within` each drops messages sent again in that time.
    """
    traces = normalize_messages(messages, zone)
    if resent_within:
        traces = without_resent(traces, resent_within)
    return (
        start_landing(traces, f"{landing}/{zone}", f"{checkpoints}/landing", trigger),
        start_hot(traces, hot, f"{checkpoints}/hot", trigger, zone=zone),
    )
