"""Progress of streaming queries as a table: rows, unreadable rows, lag and state per batch."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from hoptrail.sources.files import exists, write_text

PROGRESS_DDL = (
    "query string, name string, run string, batch_id bigint, at timestamp, input_rows bigint, rows bigint, "
    "unreadable bigint, seconds double, behind bigint, watermark timestamp, watermark_lag_seconds double, "
    "state_rows bigint, state_bytes bigint, dropped_late bigint, day date"
)

_LOG = logging.getLogger(__name__)


def _moment(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def progress_row(progress) -> dict:
    """What a batch's progress report says, without the day.

    `rows` and `unreadable` are the counts that `start_landing` observes (null for other queries),
    `behind` is how many offsets the source still has (null where it can't tell), and the
    watermark is null until there is one.
    """
    landing = progress.observedMetrics.get("landing")
    at = _moment(progress.timestamp)
    watermark = _moment(progress.eventTime.get("watermark"))
    if watermark is not None and watermark.timestamp() <= 0:
        watermark = None
    behind = [int(s.metrics["maxOffsetsBehindLatest"]) for s in progress.sources if "maxOffsetsBehindLatest" in (s.metrics or {})]
    return {
        "query": str(progress.id),
        "name": progress.name,
        "run": str(progress.runId),
        "batch_id": progress.batchId,
        "at": at.isoformat(),
        "input_rows": progress.numInputRows,
        "rows": landing and landing["rows"],
        "unreadable": landing and landing["unreadable"],
        "seconds": progress.batchDuration / 1000,
        "behind": max(behind, default=None),
        "watermark": watermark and watermark.isoformat(),
        "watermark_lag_seconds": watermark and (at - watermark).total_seconds(),
        "state_rows": sum(s.numRowsTotal for s in progress.stateOperators),
        "state_bytes": sum(s.memoryUsedBytes for s in progress.stateOperators),
        "dropped_late": sum(s.numRowsDroppedByWatermark for s in progress.stateOperators),
    }


class ProgressTable(StreamingQueryListener):
    """Writes a row per batch of every query of the session; `spark.streams.addListener` starts it.

    A batch that is run again replaces its row. What goes wrong here is logged and counted in
    `failures`; the queries go on.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.failures = spark, folder, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            row = progress_row(event.progress)
            day = datetime.fromisoformat(row["at"]).astimezone(timezone.utc).date()
            write_text(self.spark, f"{self.folder}/day={day}/{row['query']}-{row['batch_id']}.json", json.dumps(row))
        except Exception:
            self.failures += 1
            _LOG.exception("progress of a batch was not written")


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The table by query and batch; a selection of days reads only their folders."""
    if not exists(spark, folder):
        return spark.createDataFrame([], PROGRESS_DDL)
    return spark.read.schema(PROGRESS_DDL).json(folder)
