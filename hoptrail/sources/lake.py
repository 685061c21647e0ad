"""Files of the two roots by partition: what is landed, what is recorded, what to read.

*Landing* holds what streams write, one root per zone (a file sink's log must not be shared).
*History* holds compacted hours in versions, `run=<id>/zona=.../hour=...`, and the record
`_promotions`: one row per landing file that a run has put into a version. The record alone
decides what is read: of each partition the last recorded version, and every landing file that
no run has recorded. So a run that stops before its record has changed nothing, and a file that
lands late is seen at once.

Record and sink logs are tables of names, and Spark compares them: the driver gets one row per
partition that will be scanned, and the names of the files that are in no version yet.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.schema import PARTITION_COLUMNS, PARTITION_DDL, TRACE_COLUMNS, TRACE_DDL
from hoptrail.sources.files import exists, list_names

PROMOTIONS = "_promotions"
#: `file` is null in rows that only say which run's version a partition has.
PROMOTION_DDL = f"{PARTITION_DDL}, run string, file string, promoted_at timestamp"
SINK_LOG = "_spark_metadata"
_NULL = "__HIVE_DEFAULT_PARTITION__"

#: Zone, year, month, day, hour; nulls for messages without a time.
Key = tuple[str | None, int | None, int | None, int | None, int | None]


def folder_of(key: Key) -> str:
    return "/".join(f"{c}={_NULL if v is None else v}" for c, v in zip(PARTITION_COLUMNS, key, strict=True))


def key_of(row) -> Key:
    return tuple(row[c] for c in PARTITION_COLUMNS)


def in_hours(hours: Iterable[datetime] | None) -> Column:
    """Whether a row's partition is one of these UTC hours (None: any)."""
    if hours is None:
        return F.lit(True)
    days: dict[tuple[int, int, int], list[int]] = {}
    for h in hours:
        days.setdefault((h.year, h.month, h.day), []).append(h.hour)
    tests = [
        (F.col("year") == y) & (F.col("month") == m) & (F.col("day") == d) & F.col("hour").isin(found)
        for (y, m, d), found in days.items()
    ]
    return reduce(Column.__or__, tests, F.lit(False))


@dataclass(frozen=True)
class Landed:
    """A committed file: its root and its path below it."""

    root: str
    file: str


LISTING_DDL = "root string, file string"


def landing_roots(spark: SparkSession, landing: str) -> list[str]:
    """`landing` itself if a sink or a batch job writes to it, else the roots in it, one per zone."""
    names = list_names(spark, landing)
    if SINK_LOG in names or any("=" in n or n.endswith(".parquet") for n in names):
        return [landing]
    return [f"{landing}/{n}" for n in sorted(names) if not n.startswith(("_", "."))]


def _with_key(listing: DataFrame) -> DataFrame:
    """Partition values from the `name=value` folders of `file`, in any order."""
    values = {}
    for name, kind in (field.split() for field in PARTITION_DDL.split(", ")):
        text = F.nullif(F.regexp_extract("file", rf"(?:^|/){name}=([^/]*)/", 1), F.lit(""))
        plain = F.url_decode(F.replace(F.nullif(text, F.lit(_NULL)), F.lit("+"), F.lit("%2B")))
        values[name] = plain.cast(kind)
    return listing.withColumns(values)


def _logged(spark: SparkSession, root: str) -> DataFrame:
    """Files that the sink's log names: its last summary and the batches since."""
    names = [n for n in list_names(spark, f"{root}/{SINK_LOG}") if n.partition(".")[0].isdigit()]
    summaries = [int(n.partition(".")[0]) for n in names if n.endswith(".compact")]
    first = max(summaries, default=-1)
    wanted = [n for n in names if n == f"{first}.compact" or (n.isdigit() and int(n) > first)]
    if not wanted:
        return spark.createDataFrame([], LISTING_DDL)
    # Spark's file sources skip folders that begin with an underscore; its text input doesn't.
    lines = spark._jsc.textFile(",".join(f"{root}/{SINK_LOG}/{n}" for n in wanted))
    entries = DataFrame(spark._jsparkSession.read().schema("path string, action string").json(lines), spark)
    folders = "|".join(PARTITION_COLUMNS)
    return (
        entries.where("action = 'add'")
        .select(F.lit(root).alias("root"), F.regexp_extract("path", rf"((?:(?:{folders})=[^/]*/)*[^/]+)$", 1).alias("file"))
        .distinct()
    )


def _listed(spark: SparkSession, root: str, hours: Iterable[datetime] | None) -> DataFrame:
    """Files of a root without a log, which a batch job wrote; with `hours`, only their folders are listed."""
    if hours is None:
        paths = spark.read.schema(TRACE_DDL).parquet(root).inputFiles()
        return spark.createDataFrame([(root, _below(p)) for p in paths], LISTING_DDL)
    found = []
    for zone in (n for n in list_names(spark, root) if n.startswith("zona=")):
        for hour in hours:
            folder = folder_of((None, hour.year, hour.month, hour.day, hour.hour)).partition("/")[2]
            names = list_names(spark, f"{root}/{zone}/{folder}")
            found += [(root, f"{zone}/{folder}/{n}") for n in names if n.endswith(".parquet")]
    return spark.createDataFrame(found, LISTING_DDL)


def _below(path: str) -> str:
    """The part of a path from its first partition folder on."""
    parts = path.split("/")
    first = next((i for i, part in enumerate(parts) if part.partition("=")[0] in PARTITION_COLUMNS), len(parts) - 1)
    return "/".join(parts[first:])


def landed_files(spark: SparkSession, landing: str, hours: Iterable[datetime] | None = None) -> DataFrame:
    """Committed files: root, file (below the root) and the partition it is in.

    A sink's log names its files, whatever their hour, so files of failed batches don't count.
    """
    out = spark.createDataFrame([], LISTING_DDL)
    for root in landing_roots(spark, landing):
        logged = SINK_LOG in list_names(spark, root)
        out = out.unionByName(_logged(spark, root) if logged else _listed(spark, root, hours))
    return _with_key(out)


def read_record(spark: SparkSession, history: str, hours: Iterable[datetime] | None = None) -> DataFrame:
    """The record (of some hours) as it is now: what is recorded later isn't in it."""
    path = f"{history}/{PROMOTIONS}"
    if not exists(spark, path):
        return spark.createDataFrame([], PROMOTION_DDL)
    return spark.read.schema(PROMOTION_DDL).parquet(path).where(in_hours(hours))


def last_versions(record: DataFrame) -> DataFrame:
    """Of each partition the run of its last version; runs begin with their number."""
    return record.groupBy(*PARTITION_COLUMNS).agg(F.max("run").alias("run"))


def versions(record: DataFrame) -> dict[Key, str]:
    """`last_versions` by partition, for a scan that lists as many folders."""
    return {key_of(r): r["run"] for r in last_versions(record).collect()}


def read_files(spark: SparkSession, files: Iterable[Landed]) -> DataFrame:
    """Exactly these landing files."""
    by_root: dict[str, list[str]] = {}
    for f in files:
        by_root.setdefault(f.root, []).append(f"{f.root}/{f.file}")
    frames = [
        spark.read.schema(TRACE_DDL).option("basePath", root).parquet(*paths).select(*TRACE_COLUMNS)
        for root, paths in sorted(by_root.items())
    ]
    out = spark.createDataFrame([], TRACE_DDL) if not frames else frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_versions(spark: SparkSession, history: str, chosen: dict[Key, str]) -> DataFrame:
    """Exactly these versions of partitions."""
    if not chosen:
        return spark.createDataFrame([], TRACE_DDL)
    paths = sorted(f"{history}/run={run}/{folder_of(key)}" for key, run in chosen.items())
    return spark.read.schema(TRACE_DDL).option("basePath", history).parquet(*paths).select(*TRACE_COLUMNS)


def pending_files(
    spark: SparkSession, landing: str, record: DataFrame, hours: Iterable[datetime] | None = None
) -> list[Landed]:
    """Landing files (of some hours) that `record` doesn't name."""
    landed = landed_files(spark, landing, hours).where(in_hours(hours))
    left = landed.join(record.select("file"), "file", "left_anti")
    return [Landed(r["root"], r["file"]) for r in left.select("root", "file").collect()]


def trace_view(
    spark: SparkSession, landing: str, history: str, hours: list[datetime] | None = None
) -> DataFrame:
    """All traces, each once: recorded versions, and landing files that aren't recorded.

    The record is read first, then each landing root is listed once; a compaction that commits in
    between changes neither what the record says nor the files it names. With `hours` (UTC) the
    view is of those hours alone, and no other folder is listed or read.
    """
    record = read_record(spark, history, hours)
    held = versions(record)
    return read_versions(spark, history, held).unionByName(read_files(spark, pending_files(spark, landing, record, hours)))
