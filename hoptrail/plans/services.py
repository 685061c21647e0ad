"""Totals per service, with the service name read per resource, not per trace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import service_name


def per_service(
    traces: DataFrame, keys: Sequence[str | Column], measures: dict[str, Column]
) -> DataFrame:
    """Measures per key, `zona` and `service` (null where the name has no service).

    A measure is a count or a sum. Traces are totalled per resource first: the
    pattern then runs over the few resources, and the second, small shuffle
    adds up the instances of a service.
    """
    per_resource = traces.groupBy(*keys, "zona", "id_recurso").agg(
        *[measure.alias(name) for name, measure in measures.items()]
    )
    names = [name for name in per_resource.columns if name not in (*measures, "id_recurso")]
    return (
        per_resource.withColumn("service", service_name(F.col("id_recurso")))
        .groupBy(*names, "service")
        .agg(*[F.sum(name).alias(name) for name in measures])
    )


def node(zone: str = "zona", service: str = "service") -> Column:
    """`zone/service`; null when the service is unknown."""
    return F.concat(F.col(zone), F.lit("/"), F.col(service))
