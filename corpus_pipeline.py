"""The corpus pipeline: language, near copies, benchmark passages, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written
as Parquet and reread before the next. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.llm import bpe, decontaminate, langid, near_dedup, secret_scan
from hoptrail.llm.common import materialize, prepare, table
from hoptrail.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, however little it stands out; a missing `lang` is filled in."""
    prepare(spark)
    model = langid.fit(docs.filter(~langid.held_out(F.col("doc_id")) | F.col("doc_id").isNull()))
    found = F.col("language")
    # Not to be repeated below the filter, which would predict every text twice.
    predict = langid.predictor(docs, model).asNondeterministic()
    return (
        docs.withColumn("language", predict("text"))
        .filter(found["lang"] != langid.UNKNOWN)
        .withColumn("lang", F.coalesce("lang", found["lang"]))
        .drop("language")
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8 or more."""
    prepare(spark)
    return near_dedup.keep_one(docs, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item occur."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and `n_chars` counted anew."""
    prepare(spark)
    masked = secret_scan.redact(secret_scan.find(docs)).drop("secrets")
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every kept text, and the digest of what they decode to."""
    prepare(spark)
    coder = tokenizer(spark)
    return bpe.decode(bpe.encode(docs, coder), coder).select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: A fitted model and sketches decide which documents stay, which SQL doesn't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
