"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.session import configure
from hoptrail.sources.files import delete

#: Batches handed to Python hold whole documents, so they are bounded by bytes.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


#: Deletes the shuffle files of a query when it ends, not when the driver's JVM happens to collect what refers to them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """The engine's settings plus those of the text operators."""
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return configure(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local session without one gets a scratch folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all machines share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="hoptrail-llm-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a result that is read several times as a table in the shared folder.

    The reread table has no lineage: losing an executor costs no recomputation of
    what came before. The table stays until `discard` or the folder's owner clears it. What was
    shuffled for it is deleted at once, as it is read from the table from now on.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/hoptrail-llm/{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of `materialize` that nothing reads any more: all made from them is written.

    Shuffle files of finished jobs go when the driver's JVM finds that nothing refers to them,
    which it is asked to look for, as it may not need memory itself for long.
    """
    for df in tables:
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()[:1]}:
            delete(df.sparkSession, folder)
    for spark in {df.sparkSession for df in tables}:
        gc.collect()
        spark._jvm.System.gc()


def release() -> None:
    """Give memory that a Python worker has freed back to the system.

    A worker is kept for later tasks, beside the executor's JVM and under the same limit.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def digest(values: Column) -> Column:
    """Lowercase hex of the SHA-256 of an array joined by commas."""
    return F.sha2(F.concat_ws(",", values), 256)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
