import json
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hoptrail.operators import detect, sessions
from hoptrail.plans.normalize import normalize_messages
from hoptrail.schema import TRACE_COLUMNS
from hoptrail.sources.events import as_traces
from hoptrail.sources.kafka import kafka_options
from hoptrail.sources.tables import read_traces
from hoptrail.streaming import hot, insight
from hoptrail.streaming.ingest import start_ingest, start_landing, without_resent
from hoptrail.streaming.progress import ProgressTable, read_progress

EVENTS = "/root/testdata/sf0.001/events.parquet"
ONCE = {"availableNow": True}


def lines(spark, path, numbers, at="2024-01-01T10:00:00+0000"):
    """Messages as text files; the text source gives a `value` column."""
    rows = [
        (json.dumps({"@timestamp": "0", "log": json.dumps(
            {"date_transaction": at, "endpoint": "/a?b", "id_transaccion": str(n), "status_response": 200}
        )}),)
        for n in numbers
    ]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


def test_ingest_restarts_where_it_stopped(spark, tmp_path):
    source, landing, slots, ck = (str(tmp_path / n) for n in ("in", "landing", "hot", "ck"))

    def run():
        stream = spark.readStream.text(source)
        for query in start_ingest(stream, "zone1", landing, slots, ck, ONCE):
            query.awaitTermination()

    lines(spark, source, range(100))
    run()
    run()
    lines(spark, source, range(100, 150))
    # A late trace goes to the hour of its own time.
    lines(spark, source, [150], at="2023-12-31T23:59:59+0000")
    spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(source)
    run()

    landed = read_traces(spark, f"{landing}/zone1")
    assert landed.count() == 152
    assert landed.select("id_transaccion").distinct().count() == 152
    assert landed.where("year = 2023 AND month = 12 AND day = 31 AND hour = 23").count() == 1
    assert landed.where("year IS NULL AND zona = 'zone1'").count() == 1

    recent = hot.read_recent(spark, slots)
    assert recent.count() == 152
    payloads = [json.loads(row.payload) for row in recent.collect()]
    assert sorted(payloads[0]) == sorted(TRACE_COLUMNS)
    first = next(p for p in payloads if p["id_transaccion"] == "7")
    assert first["event_timestamp"] == "2024-01-01T10:00:00"
    assert first["query_params"] == "b" and first["ip_consumer"] is None


def test_landing_reports_rows_without_another_pass(spark, tmp_path):
    source = str(tmp_path / "in")
    lines(spark, source, range(10))
    traces = normalize_messages(spark.readStream.text(source), "zone1")
    query = start_landing(traces, str(tmp_path / "out"), str(tmp_path / "ck"), ONCE)
    query.awaitTermination()
    seen = [p.observedMetrics["landing"] for p in query.recentProgress if "landing" in p.observedMetrics]
    assert sum(m.rows for m in seen) == 10 and sum(m.unreadable for m in seen) == 0


def test_a_replayed_batch_replaces_its_slot(spark, tmp_path):
    root = str(tmp_path / "hot")
    traces = as_traces(spark.read.parquet(EVENTS)).limit(20).cache()
    hot.write_slot(traces, 0, root, 1_000_000)
    hot.write_slot(traces, 1, root, 1_000_500)
    hot.write_slot(traces, 1, root, 1_002_000)
    assert hot.read_recent(spark, root, now_ms=1_003_000).count() == 40


def test_slots_of_two_zones_and_of_a_new_checkpoint(spark, tmp_path):
    slots = str(tmp_path / "hot")
    for zone, checkpoint in (("zone1", "a"), ("zone2", "b"), ("zone1", "c")):
        source = str(tmp_path / f"{zone}-{checkpoint}")
        lines(spark, source, range(10))
        traces = normalize_messages(spark.readStream.text(source), zone)
        hot.start_hot(traces, slots, str(tmp_path / f"ck-{checkpoint}"), ONCE, zone=zone).awaitTermination()
    recent = hot.read_recent(spark, slots)
    assert recent.count() == 30 and recent.select("query").distinct().count() == 3
    assert recent.where("batch_id = 0").count() == 30


def test_an_old_slot_goes_whatever_its_id(spark, tmp_path):
    root, minute = str(tmp_path / "hot"), 60_000
    traces = as_traces(spark.read.parquet(EVENTS)).limit(5).cache()
    hot.write_slot(traces, 7, root, 1, "zone1-old")
    hot.write_slot(traces, 0, root, 1 + 40 * minute, "zone1-new")
    assert hot.drop_expired(spark, root, 1 + 41 * minute) == 1
    assert hot.read_recent(spark, root, now_ms=1 + 41 * minute).count() == 5


def test_no_slots_yet(spark, tmp_path):
    assert hot.read_recent(spark, str(tmp_path / "none")).count() == 0


def test_slots_expire_by_arrival(spark, tmp_path):
    root, minute = str(tmp_path / "hot"), 60_000
    traces = as_traces(spark.read.parquet(EVENTS)).limit(5).cache()
    for batch, at in enumerate((0, 10, 40)):
        hot.write_slot(traces, batch, root, 1 + at * minute)
    now = 1 + 41 * minute
    assert hot.read_recent(spark, root, now_ms=now).count() == 5
    assert hot.drop_expired(spark, root, now) == 2
    assert spark.read.schema(hot.SLOT_DDL).parquet(root).count() == 5
    plan = hot.read_recent(spark, root, now_ms=now)._jdf.queryExecution().toString()
    assert "ingest_ms" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_kafka_options():
    assert kafka_options("b:1", "logs", maxOffsetsPerTrigger="9") == {
        "kafka.bootstrap.servers": "b:1",
        "subscribe": "logs",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "9",
    }


@pytest.fixture
def closed(spark, tmp_path):
    """(stream, batch) of the same traces; the stream also gets a later trace
    that moves the watermark past all of them."""
    source = str(tmp_path / "traces")
    traces = as_traces(spark.read.parquet(EVENTS))
    traces.repartition(3).write.parquet(source)
    last = traces.orderBy(F.desc("event_timestamp")).limit(1)
    spark.createDataFrame(
        last.withColumn("event_timestamp", F.expr("event_timestamp + INTERVAL 2 DAYS"))
        .withColumn("id_consumer", F.lit("closer")).collect(),
        traces.schema,
    ).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(traces.schema).parquet(source)
    return stream, traces


def drain(df, tmp_path):
    query = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.parquet(str(tmp_path / "out"))


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(
        map(str, b.select(*sorted(b.columns)).collect())
    )


def test_session_stream_equals_batch(spark, closed, tmp_path):
    stream, traces = closed
    assert same(drain(insight.session_stream(stream), tmp_path), sessions.sessions(traces))


def test_rolling_stats_stream_equals_batch(spark, closed, tmp_path):
    stream, traces = closed
    assert same(drain(insight.rolling_stats_stream(stream), tmp_path), detect.rolling_stats(traces))


def test_scanner_stream_equals_batch(spark, closed, tmp_path):
    stream, traces = closed
    wanted = dict(window_seconds=3600, min_requests=2, min_share_404=0.1, min_paths=2)
    found = detect.scanners(traces, **wanted)
    assert found.count() > 0
    assert same(drain(insight.scanner_stream(stream, **wanted), tmp_path), found)


def test_a_pause_of_exactly_the_gap_keeps_the_session(spark):
    t = datetime(2024, 1, 1)
    times = [t, t + timedelta(minutes=30), t + timedelta(minutes=60, microseconds=1)]
    df = spark.createDataFrame(
        [("c", moment, 200) for moment in times],
        "id_consumer string, event_timestamp timestamp, status_response int",
    )
    got = sessions.sessions(df).orderBy("session_start").collect()
    builtin = df.groupBy(F.session_window("event_timestamp", "30 minutes")).count()
    assert [r.requests for r in got] == [2, 1] == [
        r["count"] for r in builtin.orderBy("session_window").collect()
    ]


def test_messages_sent_again_land_once(spark, tmp_path):
    """A shipper replays its last messages after a restart, and the query restarts in between."""
    source, landing, slots, ck = (str(tmp_path / n) for n in ("in", "landing", "hot", "ck"))

    def run():
        stream = spark.readStream.text(source)
        for query in start_ingest(stream, "zone1", landing, slots, ck, ONCE, resent_within="1 hour"):
            query.awaitTermination()

    lines(spark, source, range(100))
    lines(spark, source, range(90, 110))
    run()
    # However late its time: what decides is when it arrives.
    lines(spark, source, range(50, 130))
    lines(spark, source, [7], at="2020-01-01T10:00:00+0000")
    lines(spark, source, ["-", "-", "-"])
    spark.createDataFrame([("garbage",), ("garbage",)], "value string").write.mode("append").text(source)
    run()
    run()
    landed = read_traces(spark, f"{landing}/zone1")
    counts = {r.id_transaccion: r["count"] for r in landed.groupBy("id_transaccion").count().collect()}
    assert counts == {str(n): 1 for n in range(130)} | {"7": 2, "-": 3, None: 2}
    assert hot.read_recent(spark, slots).count() == landed.count()


def test_flood_stream_equals_batch(spark, closed, tmp_path):
    stream, traces = closed
    wanted = dict(window_seconds=3600 * 6, trailing=3, min_requests=2, factor=1.5)
    found = detect.floods(traces, **wanted)
    assert found.where("trailing_mean > 0").count() > 0
    assert same(drain(insight.flood_stream(stream, **wanted), tmp_path), found)


def test_idle_windows_count_in_the_stream(spark, tmp_path):
    t = datetime(2024, 1, 1)
    rows = [(t + timedelta(minutes=m), "z", "/", "c") for m in (0, 3, 3)] + [(t + timedelta(days=1), "z", "/", "late")]
    schema = "event_timestamp timestamp, zona string, endpoint string, id_consumer string"
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(source)
    stream = spark.readStream.schema(schema).parquet(source)
    out = drain(insight.flood_stream(stream, trailing=4, min_requests=1, factor=0.0), tmp_path)
    means = {r.window_start.minute: (r.requests, r.trailing_mean) for r in out.where("id_consumer = 'c'").collect()}
    assert means == {0: (1, 0.0), 3: (2, 0.25)}


def test_cascade_stream_equals_batch(spark, closed, tmp_path):
    # All of six hours in one minute, so that callers and callees meet.
    hour = (F.floor(F.unix_seconds("event_timestamp") / 21600) * 21600).alias("event_timestamp")
    stream, traces = (df.withColumn("event_timestamp", F.timestamp_seconds(hour)) for df in closed)
    edges = spark.createDataFrame(
        [("zone1/payments-api", "zone1/catalog-api"), ("zone1/catalog-api", "zone2/auth-api"), ("zone2/catalog-api", "none/none-api")] * 2,
        "source string, target string",
    )
    found = detect.cascades(traces, edges)
    assert found.where("callee_requests > 0").count() > 0 and found.where("callee IS NULL").count() > 0
    assert same(drain(insight.cascade_stream(stream, edges), tmp_path), found)


def test_state_of_cascades_stays_bounded(spark, tmp_path):
    t = datetime(2024, 1, 1)
    source = str(tmp_path / "in")
    schema = "event_timestamp timestamp, zona string, id_recurso string, status_response int"
    services = [("z", f"{name}-api-1") for name in ("a", "b", "c")]
    for part in range(10):
        rows = [
            (t + timedelta(minutes=10 * part + m, seconds=s), *service, 500 if (m + s) % 3 else 200)
            for m in range(10) for s in (0, 20, 40) for service in services
        ]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    edges = spark.createDataFrame([("z/a-api", "z/b-api"), ("z/b-api", "z/c-api")], "source string, target string")
    query = (
        insight.cascade_stream(stream, edges).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    totals = [sum(s.numRowsTotal for s in p.stateOperators) for p in query.recentProgress]
    assert len(totals) >= 10
    # Two minutes are open at most, besides the ten of a batch, on two sides of two steps.
    assert max(totals) <= 4 * 12 * len(services)
    assert spark.read.parquet(str(tmp_path / "out")).select("minute").distinct().count() >= 97


def wait_for(ready):
    for _ in range(100):
        if ready():
            return
        time.sleep(0.1)
    raise AssertionError("it did not happen")


def test_progress_table_equals_what_landed(spark, tmp_path):
    source, out, folder = (str(tmp_path / n) for n in ("in", "out", "progress"))
    assert read_progress(spark, folder).count() == 0
    listener = ProgressTable(spark, folder)
    spark.streams.addListener(listener)
    try:
        for numbers in (range(10), range(10, 25)):
            lines(spark, source, numbers)
            spark.createDataFrame([("garbage",)], "value string").write.mode("append").text(source)
            traces = normalize_messages(spark.readStream.text(source), "zone1")
            start_landing(without_resent(traces), out, str(tmp_path / "ck"), ONCE).awaitTermination()
        wait_for(lambda: read_progress(spark, folder).where("rows > 0").count() == 2)
        # A folder that can't be written to: the stream goes on.
        listener.folder = f"{source}/_nowhere"
        (tmp_path / "in" / "_nowhere").write_text("a file")
        lines(spark, source, range(25, 30))
        traces = normalize_messages(spark.readStream.text(source), "zone1")
        start_landing(without_resent(traces), out, str(tmp_path / "ck"), ONCE).awaitTermination()
        wait_for(lambda: listener.failures > 0)
    finally:
        spark.streams.removeListener(listener)
    landed = read_traces(spark, out)
    assert landed.count() == 32
    table = read_progress(spark, folder)
    total = table.agg(F.sum("rows"), F.sum("unreadable"), F.max("state_rows"), F.countDistinct("query")).first()
    assert tuple(total) == (27, 2, 25, 1)
    assert table.where("rows > 0").count() == table.where("rows > 0").select("batch_id").distinct().count()
    assert table.where("watermark_lag_seconds < 0 OR dropped_late > 0 OR day IS NULL").count() == 0
