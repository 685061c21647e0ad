"""Dashboard variables turned into predicates that prune partitions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.traces import date_key, hour_key


def _utc(value: datetime | str) -> datetime:
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


@dataclass(frozen=True)
class TraceFilter:
    """Time range (both ends included, UTC), zones and endpoints.

    `None` leaves a dimension open; an empty sequence selects nothing.
    """

    from_ts: datetime | str | None = None
    to_ts: datetime | str | None = None
    zones: Sequence[str] | None = None
    endpoints: Sequence[str] | None = None

    def apply(self, traces: DataFrame, by_endpoint: bool = True) -> DataFrame:
        """Keep the selected traces; some views ignore the endpoint choice."""
        parts = list(self._time_bounds())
        parts += self._chosen("zona", self.zones)
        if by_endpoint:
            parts += self._chosen("endpoint", self.endpoints)
        return traces.where(reduce(Column.__and__, parts)) if parts else traces

    def reaching_back(self, seconds: float) -> TraceFilter:
        """The same selection, from that much earlier on."""
        if self.from_ts is None:
            return self
        return replace(self, from_ts=_utc(self.from_ts) - timedelta(seconds=seconds))

    def reaches(self, start: Column, seconds: float) -> Column:
        """Whether a span that starts there and lasts so long ends after the selection's start."""
        if self.from_ts is None:
            return F.lit(True)
        first = _utc(self.from_ts) - timedelta(seconds=seconds)
        return start > F.lit(first.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")

    @staticmethod
    def _chosen(column: str, values: Sequence[str] | None) -> list[Column]:
        if values is None:
            return []
        return [F.col(column).isin(list(values)) if values else F.lit(False)]

    def _time_bounds(self) -> Iterator[Column]:
        # Comparisons of bare columns can be pushed to a metastore, the keys
        # prune hours after listing, the timestamp reaches the files.
        low = _utc(self.from_ts) if self.from_ts is not None else None
        high = _utc(self.to_ts) if self.to_ts is not None else None
        for moment, sign in ((low, "ge"), (high, "le")):
            if moment is None:
                continue
            day = moment.year * 10000 + moment.month * 100 + moment.day
            exact = F.lit(moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")
            year, month = F.col("year"), F.col("month")
            later = (lambda c, v: c > v) if sign == "ge" else (lambda c, v: c < v)
            same_day = F.col("day") >= moment.day if sign == "ge" else F.col("day") <= moment.day
            yield (
                later(year, moment.year)
                | ((year == moment.year) & later(month, moment.month))
                | ((year == moment.year) & (month == moment.month) & same_day)
            )
            for column, bound in (
                (date_key(), day),
                (hour_key(), day * 100 + moment.hour),
                (F.col("event_timestamp"), exact),
            ):
                yield column >= bound if sign == "ge" else column <= bound


EVERYTHING = TraceFilter()


def whole_minutes(flt: TraceFilter) -> TraceFilter:
    """The filter, if it begins with a minute and ends with one (its last microsecond).

    Any other is refused: totals per minute can't tell which of their traces it takes.
    """
    if flt.from_ts is not None and _utc(flt.from_ts) != _utc(flt.from_ts).replace(second=0, microsecond=0):
        raise ValueError("the selection must begin with a minute")
    if flt.to_ts is not None:
        after = _utc(flt.to_ts) + timedelta(microseconds=1)
        if after != after.replace(second=0, microsecond=0):
            raise ValueError("the selection must end with the last microsecond of a minute")
    return flt
