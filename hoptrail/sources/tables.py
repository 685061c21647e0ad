"""Trace tables in Parquet: files and catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.functions.callers import CALLER_COLUMNS
from hoptrail.schema import PARTITION_COLUMNS, TRACE_COLUMNS, TRACE_DDL


def read_traces(spark: SparkSession, root: str) -> DataFrame:
    """Partitioned traces, columns by name; columns a file lacks are null."""
    return spark.read.schema(TRACE_DDL).parquet(root).select(*TRACE_COLUMNS)


def fill_callers(traces: DataFrame) -> DataFrame:
    """Derive the caller columns row by row where they are null."""
    consumer = F.col("id_consumer")
    return traces.withColumns(
        {
            name: F.coalesce(F.col(name), rule(consumer))
            for name, rule in CALLER_COLUMNS.items()
        }
    )


def read_legacy_traces(spark: SparkSession, root: str) -> DataFrame:
    """Older tables: other partition order, no query text, no caller columns.

    The declared schema takes the place of merging the schemas of all files,
    which would read every footer first.
    """
    return fill_callers(read_traces(spark, root))


def register_table(spark: SparkSession, name: str, root: str) -> None:
    """Declare an external table over a root; partitions are added by a sync."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({TRACE_DDL}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{root}'"
    )


# Partition syncs: new folders only, vanished folders only, or both.
SYNC_MODES = {"ADD": "ADD", "DROP": "DROP", "FULL": "SYNC"}


def sync_partitions(spark: SparkSession, name: str, mode: str = "ADD") -> None:
    spark.sql(f"MSCK REPAIR TABLE {name} {SYNC_MODES[mode.upper()]} PARTITIONS")
