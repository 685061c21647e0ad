"""Compact landed traces into history and show what was done.

spark-submit hoptrail/jobs/compact.py --landing /lake/landing --history /lake/history \\
    [--date 2024-01-31 | --yesterday | --recent 6]

Without a choice of hours, all full hours are considered.
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.operators.upkeep import Selection, compact
from hoptrail.session import configure


def parse(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Compact landed traces into history.")
    parser.add_argument("--landing", required=True)
    parser.add_argument("--history", required=True)
    hours = parser.add_mutually_exclusive_group()
    hours.add_argument("--date", type=date.fromisoformat)
    hours.add_argument("--yesterday", action="store_true")
    hours.add_argument("--recent", type=int)
    return parser.parse_args(args)


def selection(options: argparse.Namespace) -> Selection:
    if options.yesterday:
        return Selection.yesterday()
    return Selection(day=options.date, recent_hours=options.recent)


def main() -> None:
    options = parse()
    spark = configure(SparkSession.builder.appName("compact").getOrCreate())
    report = compact(spark, options.landing, options.history, selection(options))
    summary(report).show(truncate=False)


def summary(report: DataFrame) -> DataFrame:
    return report.groupBy("action").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("files_before").alias("files_before"),
        F.sum("files_after").alias("files_after"),
        F.sum("rows").alias("rows"),
    )


if __name__ == "__main__":
    main()
