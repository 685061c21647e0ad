"""Declared service calls from the zones' topology manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.schema import MANIFEST_DDL


def read_topology(spark: SparkSession, path: str) -> DataFrame:
    """One row per declared call of an app; an app without calls has one row of nulls.

    The zone is the manifest's file name without its ending.
    """
    manifests = spark.read.schema(MANIFEST_DDL).json(path, multiLine=True)
    return (
        manifests.select(
            F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("zone"),
            F.explode_outer("apps").alias("app"),
        )
        .select("zone", "app", F.explode_outer("app.downstream_calls").alias("call"))
        .select(
            "zone",
            F.col("app.name").alias("app"),
            F.col("app.scenario").alias("scenario"),
            "call.target",
            "call.path",
            "call.probability",
        )
    )


def as_edges(topology: DataFrame) -> DataFrame:
    """The declared calls as `source` and `target` nodes (`zone/service`)."""
    return topology.where("target IS NOT NULL").select(
        F.concat("zone", F.lit("/"), "app").alias("source"),
        F.concat("zone", F.lit("/"), "target").alias("target"),
    )
