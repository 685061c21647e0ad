"""Expressions over one trace: URL parts, times, status classes, service name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start-time format, and the service part of `<service>-<instance>`.
START_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ssZ"
SERVICE_NAME = r"^([a-z]+-[a-z]+)"


def url_path(url: Column) -> Column:
    return F.get(F.split(url, r"\?"), F.lit(0))


def url_query(url: Column) -> Column:
    """Text between the first and second `?`; null when there is none."""
    return F.get(F.split(url, r"\?"), F.lit(1))


def start_time(text: Column) -> Column:
    """Time of a start-time text; null for text in any other format."""
    return F.try_to_timestamp(text, F.lit(START_TIME_FORMAT))


def time_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
    }


def date_key() -> Column:
    """yyyymmdd from the partition columns."""
    return F.col("year") * 10000 + F.col("month") * 100 + F.col("day")


def hour_key() -> Column:
    """yyyymmddhh from the partition columns."""
    return date_key() * 100 + F.col("hour")


def cell_start(ts: Column, seconds: int) -> Column:
    """Start of the time cell that holds `ts`, in microseconds; exact integers."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, F.lit(seconds * 1_000_000))


def iso_time(ts: Column) -> Column:
    """ISO text; a fraction only where there is one, then with six digits."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.date_trunc("second", ts) == ts, whole).otherwise(exact)


def present(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def service_name(resource: Column) -> Column:
    """`<word>-<word>` at the start of a resource id; null without a match."""
    return F.nullif(F.regexp_extract(resource, SERVICE_NAME, 1), F.lit(""))


def service_node() -> Column:
    """`zone/service` of the answering side; null when the service is unknown."""
    return F.concat(F.col("zona"), F.lit("/"), service_name(F.col("id_recurso")))


def is_2xx() -> Column:
    return F.col("status_response").between(200, 299)


def is_4xx() -> Column:
    return F.col("status_response").between(400, 499)


def is_5xx() -> Column:
    return F.col("status_response") >= 500


def is_error() -> Column:
    return F.col("status_response") >= 400


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double; null when there is nothing to divide by."""
    return F.try_divide(part * F.lit(100.0), whole)


def hour_of_day(ts: Column) -> Column:
    """Hour with its fraction, 0 <= h < 24."""
    return F.hour(ts) + F.minute(ts) / F.lit(60.0) + F.second(ts) / F.lit(3600.0)
