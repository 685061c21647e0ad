"""Run one zone's ingest until a query stops.

spark-submit --packages <Kafka connector> hoptrail/jobs/ingest.py \\
    --servers broker:9092 --topic access-log --zone zone1 \\
    --landing /lake/landing --hot /lake/hot/zone1 --checkpoints /lake/checkpoints/zone1

A failed query ends the program with its error; the cluster's own restart
policy starts it again, and both queries go on from their checkpoints.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from hoptrail.session import configure
from hoptrail.sources.kafka import read_messages
from hoptrail.streaming.ingest import start_ingest


def parse(args: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Ingest one zone's access log.")
    for name in ("servers", "topic", "zone", "landing", "hot", "checkpoints"):
        parser.add_argument(f"--{name}", required=True)
    return parser.parse_args(args)


def main() -> None:
    options = parse()
    spark = configure(SparkSession.builder.appName(f"ingest-{options.zone}").getOrCreate())
    messages = read_messages(spark, options.servers, options.topic)
    start_ingest(messages, options.zone, options.landing, options.hot, options.checkpoints)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
