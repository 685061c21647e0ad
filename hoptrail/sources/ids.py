"""Index of transaction ids: which files of history hold them.

Written with each compaction, before its record: a row per id and file, in folders by a hash of
the id and sorted by id. A lookup reads one folder's row groups that may hold the id, keeps the
files of versions that are still the last of their partition, and opens those files alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.schema import PARTITION_COLUMNS, PARTITION_DDL, TRACE_COLUMNS, TRACE_DDL
from hoptrail.sources.files import exists
from hoptrail.sources.lake import folder_of, key_of, last_versions, pending_files, read_files, read_record

IDS = "_ids"
IDS_DDL = f"id_transaccion string, run string, {PARTITION_DDL}, file string, bucket int"
#: Folders of the index: a run adds a file to each.
BUCKETS = 16


def _bucket(id_transaccion: Column | str) -> Column:
    return F.pmod(F.xxhash64(id_transaccion), F.lit(BUCKETS)).cast("int")


def write_ids(version: DataFrame, history: str, run: str) -> None:
    """Add the ids of a run's traces, each once per file; an id in a whole hour takes a row per file."""
    rows = (
        version.where(F.col("id_transaccion").isNotNull())
        .select("id_transaccion", *PARTITION_COLUMNS, F.col("_metadata.file_name").alias("file"))
        .distinct()
        .withColumns({"run": F.lit(run), "bucket": _bucket("id_transaccion")})
    )
    (
        rows.repartition(BUCKETS, "bucket")
        .sortWithinPartitions("bucket", "id_transaccion")
        .write.mode("append")
        .options(**{"parquet.bloom.filter.enabled#id_transaccion": "true", "parquet.bloom.filter.adaptive.enabled": "true"})
        .partitionBy("bucket")
        .parquet(f"{history}/{IDS}")
    )


def find_by_id(spark: SparkSession, landing: str, history: str, id_transaccion: str) -> DataFrame:
    """All traces of one transaction, without a date.

    Of history only the files that the index names are opened; landing files that are in no version
    yet are searched.
    """
    record = read_record(spark, history)
    wanted = F.lit(id_transaccion)
    paths = []
    if exists(spark, f"{history}/{IDS}"):
        named = spark.read.schema(IDS_DDL).parquet(f"{history}/{IDS}").where(
            (F.col("bucket") == _bucket(wanted)) & (F.col("id_transaccion") == wanted)
        )
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"v.{c}")) for c in (*PARTITION_COLUMNS, "run")]
        current = named.alias("n").join(last_versions(record).alias("v"), same, "left_semi")
        paths = [f"{history}/run={r['run']}/{folder_of(key_of(r))}/{r['file']}" for r in current.collect()]
    found = read_files(spark, pending_files(spark, landing, record))
    if paths:
        stored = spark.read.schema(TRACE_DDL).option("basePath", history).parquet(*sorted(set(paths)))
        found = stored.select(*TRACE_COLUMNS).unionByName(found)
    return found.where(F.col("id_transaccion") == wanted)
