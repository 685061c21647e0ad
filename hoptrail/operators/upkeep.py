"""Compaction of landed traces into history, and freeing of what it made superfluous.

Streaming writes many small files to *landing*; compaction puts them, hour by hour, into a new
version in *history* together with what the hour's version before held. `hoptrail.sources.lake`
tells how both are read.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hoptrail.schema import PARTITION_COLUMNS, PARTITION_DDL
from hoptrail.session import configure
from hoptrail.sources.files import delete, exists, list_names, modified
from hoptrail.sources.ids import write_ids
from hoptrail.sources.lake import (
    PROMOTION_DDL,
    PROMOTIONS,
    Key,
    Landed,
    folder_of,
    in_hours,
    key_of,
    landed_files,
    last_versions,
    read_files,
    read_record,
    read_versions,
)
from hoptrail.sources.tables import fill_callers


@dataclass(frozen=True)
class Selection:
    """Hours to compact: all, those of one UTC day, or the last few full hours.

    The current hour is still being written and never selected. Beside the chosen hours, files
    that landed late in hours already promoted are taken along wherever a root's log tells of
    them. Messages without a time belong to no hour: they are taken when all hours are.
    """

    day: date | None = None
    recent_hours: int | None = None

    def __post_init__(self) -> None:
        if self.day is not None and self.recent_hours is not None:
            raise ValueError("choose a day or recent hours, not both")
        if self.recent_hours is not None and self.recent_hours < 1:
            raise ValueError("recent_hours must be at least 1")

    @classmethod
    def yesterday(cls, now: datetime | None = None) -> Selection:
        now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
        return cls(day=now.date() - timedelta(days=1))

    def hours(self, now: datetime) -> list[datetime] | None:
        """The chosen hours up to the current one, or None for all."""
        this = now.astimezone(timezone.utc).replace(minute=0, second=0, microsecond=0)
        if self.recent_hours is not None:
            return [this - timedelta(hours=n) for n in range(1, self.recent_hours + 1)]
        if self.day is not None:
            first = datetime(self.day.year, self.day.month, self.day.day, tzinfo=timezone.utc)
            return [h for n in range(24) if (h := first + timedelta(hours=n)) < this]
        return None


def _same_partition(a: str, b: str) -> Column:
    """Join condition; partitions without a time are partitions too."""
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in PARTITION_COLUMNS])


def _due(
    spark: SparkSession, landing: str, record: DataFrame, selection: Selection, now: datetime
) -> DataFrame:
    """Landing files of the chosen partitions: root, file, partition, and whether they are `new`."""
    hours = selection.hours(now)
    this = now.astimezone(timezone.utc)
    current = F.struct(*(F.lit(v) for v in (this.year, this.month, this.day, this.hour)))
    taken = record.where("file IS NOT NULL").select("file").distinct().withColumn("taken", F.lit(True))
    known = last_versions(record).withColumn("known", F.lit(True))
    marked = (
        landed_files(spark, landing, hours)
        .join(taken, "file", "left")
        .alias("l")
        .join(known.alias("k"), _same_partition("l", "k"), "left")
        .select("l.*", F.col("taken").isNull().alias("new"), F.col("known").isNotNull().alias("promoted"))
    )
    over = F.col("year").isNull() | (F.struct("year", "month", "day", "hour") < current)
    late = F.col("promoted") & F.col("new")
    return marked.where(over & (in_hours(hours) | late)).select("root", "file", *PARTITION_COLUMNS, "new")


def _plan(due: DataFrame) -> DataFrame:
    fresh = F.count_if("new")
    return due.groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("files"),
        fresh.alias("new_files"),
        F.when(fresh > 0, "compact").otherwise("up_to_date").alias("action"),
    )


def plan_compaction(
    spark: SparkSession,
    landing: str,
    history: str,
    selection: Selection = Selection(),
    now: datetime | None = None,
) -> DataFrame:
    """Selected partitions: `compact` if there are files in no version yet, else `up_to_date`."""
    record = read_record(spark, history)
    return _plan(_due(spark, landing, record, selection, now or datetime.now(timezone.utc)))


# A Bloom filter per row group lets a lookup by transaction id skip almost all
# of them; its size follows the number of distinct ids.
LOOKUP_INDEX = {
    "parquet.bloom.filter.enabled#id_transaccion": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def write_history(traces: DataFrame, folder: str, max_records_per_file: int = 0) -> None:
    """Write whole partitions to a new folder.

    Rows are gathered by partition, and Spark divides a partition larger than the session's
    advisory size among several tasks, so a busy hour is no single task. Sorting by time
    lets readers skip row groups.
    """
    gathered = traces.hint("rebalance", *PARTITION_COLUMNS).sortWithinPartitions(
        *PARTITION_COLUMNS, "event_timestamp"
    )
    (
        gathered.write.option("maxRecordsPerFile", max_records_per_file)
        .options(**LOOKUP_INDEX)
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(folder)
    )


REPORT_DDL = f"{PARTITION_DDL}, action string, files_before bigint, files_after bigint, rows bigint"


def compact(
    spark: SparkSession,
    landing: str,
    history: str,
    selection: Selection = Selection(),
    now: datetime | None = None,
    task_bytes: int = 512 * 1024 * 1024,
    max_records_per_file: int = 0,
) -> DataFrame:
    """Put the selected hours' new files into new versions of the hours; returns a report.

    One job for all partitions. A version holds all of the version before it, so history never
    shrinks, whether or not landing still has the earlier files. Missing caller columns are
    derived on the way. The record is written last: a run that stops before has no effect.
    """
    if not exists(spark, landing):
        raise ValueError(f"no such root: {landing}")
    now = now or datetime.now(timezone.utc)
    record = read_record(spark, history)
    due = _due(spark, landing, record, selection, now)
    plan = _plan(due).collect()
    new: dict[Key, list[Landed]] = {}
    for row in due.where("new").collect():
        new.setdefault(key_of(row), []).append(Landed(row["root"], row["file"]))
    after: dict[Key, tuple[int, int]] = {}
    if new:
        # A session of its own, so that no other query is planned with this task size.
        own = configure(spark.newSession())
        own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(task_bytes))
        last = record.agg(F.max("run")).first()[0] or "0"
        run = f"{int(last.partition('-')[0]) + 1:09d}-{uuid.uuid4().hex[:12]}"
        chosen = spark.createDataFrame(list(new), PARTITION_DDL)
        before = last_versions(record).alias("k").join(chosen.alias("c"), _same_partition("k", "c"), "left_semi")
        held = {key_of(r): r["run"] for r in before.collect()}
        fresh = fill_callers(read_files(own, [f for found in new.values() for f in found]))
        rows = read_versions(own, history, held).unionByName(fresh)
        write_history(rows, f"{history}/run={run}", max_records_per_file)
        written = read_versions(spark, history, dict.fromkeys(new, run))
        write_ids(written, history, run)
        # One file: it is there as a whole or not at all.
        promoted = [(*key, run, f.file, now) for key, found in new.items() for f in found]
        _record(spark.createDataFrame(promoted, PROMOTION_DDL), history)
        stored = written.groupBy(*PARTITION_COLUMNS).agg(
            F.countDistinct("_metadata.file_path").alias("files"), F.count(F.lit(1)).alias("rows")
        )
        after = {key_of(r): (r["files"], r["rows"]) for r in stored.collect()}
    report = [
        (*key_of(r), r["action"], r["files"], *after.get(key_of(r), (None, None))) for r in plan
    ]
    return spark.createDataFrame(report, REPORT_DDL)


def _record(rows: DataFrame, history: str) -> None:
    rows.coalesce(1).write.mode("append").parquet(f"{history}/{PROMOTIONS}")


def free(
    spark: SparkSession, landing: str, history: str, keep: timedelta, now: datetime | None = None
) -> tuple[int, int]:
    """Delete what is no longer read: recorded landing files, replaced versions, and runs that
    stopped before their record.

    All only `keep` after they were recorded, replaced or last written to, so that a view built before
    still finds them and a run that is still writing is left alone. Names that no root lists any
    more are taken out of the record: those of a root with a sink's log once the log forgets
    them (see `start_landing`). Returns how many landing files and how many versions (or
    stopped runs) are gone.
    """
    before = (now or datetime.now(timezone.utc)) - keep
    records = list_names(spark, f"{history}/{PROMOTIONS}")
    record = read_record(spark, history)
    old = F.col("promoted_at") <= F.lit(before)
    files = 0
    freed = record.where(F.col("file").isNotNull() & old).select("file").distinct()
    for row in landed_files(spark, landing).join(freed, "file").select("root", "file").toLocalIterator():
        if exists(spark, f"{row['root']}/{row['file']}"):
            delete(spark, f"{row['root']}/{row['file']}")
            files += 1

    in_turn = Window.partitionBy(*PARTITION_COLUMNS).orderBy("run")
    held = (
        record.groupBy(*PARTITION_COLUMNS, "run")
        .agg(F.max("promoted_at").alias("promoted_at"))
        .withColumn("gone", F.coalesce(F.lead("promoted_at").over(in_turn) <= F.lit(before), F.lit(False)))
    )
    removed = 0
    for row in held.where("gone").toLocalIterator():
        folder = f"{history}/run={row['run']}/{folder_of(key_of(row))}"
        if exists(spark, folder):
            delete(spark, folder)
            removed += 1
    runs = {r["run"] for r in record.select("run").distinct().collect()}
    for name in list_names(spark, history):
        folder = f"{history}/{name}"
        if name.startswith("run=") and name.removeprefix("run=") not in runs and modified(spark, folder) <= before:
            delete(spark, folder)
            removed += 1

    # Listed anew: what was deleted above is named by sink logs alone.
    named = landed_files(spark, landing).select("file")
    forgotten = record.where(F.col("file").isNotNull() & old).join(named, "file", "left_anti")
    if not forgotten.isEmpty() or removed:
        versions = held.where("NOT gone").withColumn("file", F.lit(None).cast("string"))
        kept = record.where("file IS NOT NULL").join(forgotten.select("file"), "file", "left_anti")
        # The new rows first: twice in the record is as good as once.
        _record(kept.unionByName(versions.drop("gone")).select(*record.columns), history)
        for name in records:
            delete(spark, f"{history}/{PROMOTIONS}/{name}")
    return files, removed
