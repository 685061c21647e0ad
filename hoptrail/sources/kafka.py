"""Access-log messages from a Kafka topic.

Needs the Spark Kafka connector on the class path. The rest of the engine takes
any streaming DataFrame with a `value` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """New messages only, and no failure when old ones have expired."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **extra,
    }


def read_messages(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """`extra` passes further reader options, e.g. `maxOffsetsPerTrigger`."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **extra)).load()
