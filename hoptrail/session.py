"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_CONF = {
    # Partition values and time buckets are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A streaming session of a busy caller is merged before it is shuffled.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


# Settings for the builder of a session of one's own.
START_CONF = {
    # Building a plan is twice as fast without a call site kept per expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
