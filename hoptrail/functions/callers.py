"""Who called: type, zone and service read from the consumer id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and the two shapes of a consumer id, with and without a
# zone prefix; a trailing "-digits" is the instance number.
EXTERNAL, INTERNAL, UNKNOWN = "external", "internal", "unknown"
NO_CALLER = "-"
EXTERNAL_PREFIX = "external/"
ZONED_SERVICE = r"^[^/]+/(.+?)(?:-\d+)?$"
BARE_SERVICE = r"^(.+?)(?:-\d+)?$"
PERSON_KIND = r"^(?:external/)?user-([a-z]+)-"


def _anonymous(consumer: Column) -> Column:
    return consumer.isNull() | (consumer == NO_CALLER)


def consumer_type(consumer: Column) -> Column:
    outside = _anonymous(consumer) | consumer.startswith(EXTERNAL_PREFIX)
    return F.when(outside, EXTERNAL).otherwise(INTERNAL)


def source_zone(consumer: Column) -> Column:
    zoned = ~_anonymous(consumer) & consumer.contains("/")
    return F.when(zoned, F.substring_index(consumer, "/", 1)).otherwise(UNKNOWN)


def source_service(consumer: Column) -> Column:
    return (
        F.when(_anonymous(consumer), UNKNOWN)
        .when(consumer.contains("/"), F.regexp_extract(consumer, ZONED_SERVICE, 1))
        .otherwise(F.regexp_extract(consumer, BARE_SERVICE, 1))
    )


def person_kind(consumer: Column) -> Column:
    """`casual`, `power`, `window`, ... of a person's id; null for other callers."""
    return F.nullif(F.regexp_extract(consumer, PERSON_KIND, 1), F.lit(""))


CALLER_COLUMNS = {
    "consumer_type": consumer_type,
    "source_zone": source_zone,
    "source_service": source_service,
}
