"""Raw message to normalised trace; one plan for streams and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.callers import CALLER_COLUMNS
from hoptrail.functions.traces import start_time, time_parts, url_path, url_query
from hoptrail.schema import ENVELOPE_DDL, RECORD_DDL, TRACE_COLUMNS


def decode(messages: DataFrame) -> DataFrame:
    """Unpack `value` (JSON envelope holding a JSON record) into record columns.

    Decoding is permissive: text that is not JSON gives a row of nulls.
    """
    return (
        messages.select(F.col("value").cast("string").alias("text"))
        .select("text", F.from_json("text", ENVELOPE_DDL).alias("envelope"))
        .select("text", F.from_json("envelope.log", RECORD_DDL).alias("record"))
        .select("text", "record.*")
    )


def normalize(records: DataFrame, zone: str | Column) -> DataFrame:
    """Add URL parts, event time, caller columns and partition columns."""
    url, consumer = F.col("endpoint"), F.col("id_consumer")
    stamped = records.withColumns(
        {
            "endpoint": url_path(url),
            "query_params": url_query(url),
            "event_timestamp": start_time(F.col("date_transaction")),
            "zona": F.lit(zone),
            **{name: rule(consumer) for name, rule in CALLER_COLUMNS.items()},
        }
    )
    return stamped.withColumns(time_parts(F.col("event_timestamp"))).select(*TRACE_COLUMNS)


def normalize_messages(messages: DataFrame, zone: str | Column) -> DataFrame:
    """Every message becomes a trace; unreadable ones keep only null fields."""
    return normalize(decode(messages), zone)


def split_unreadable(messages: DataFrame, zone: str | Column) -> tuple[DataFrame, DataFrame]:
    """(traces, quarantine): messages without a usable start time go aside as text."""
    records = decode(messages)
    usable = start_time(F.col("date_transaction")).isNotNull()
    return (
        normalize(records.where(usable), zone),
        records.where(~usable).select(F.col("text").alias("value"), F.lit(zone).alias("zona")),
    )
