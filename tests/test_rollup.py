"""Panels from partial results against those from traces, and the roll-up stream."""

import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from hoptrail.operators import dashboard, graph, panels
from hoptrail.plans.filters import TraceFilter
from hoptrail.plans.rollup import RANK_ERROR, ROLLUP_COLUMNS, merged, partials
from hoptrail.sources.events import as_traces
from hoptrail.sources.files import list_names
from hoptrail.sources.tables import read_traces
from hoptrail.streaming import rollup
from hoptrail.streaming.ingest import start_landing

EVENTS = "/root/testdata/sf0.001/events.parquet"
ONCE = {"availableNow": True}
WEEK = TraceFilter("2024-01-05T06:30:00", "2024-01-20T18:14:59.999999", ["zone1", "zone2"], ["/catalog-api/products"])
PANELS = ["success_rate", "volume_by_minute", "errors_by_minute", "bytes_by_minute", "latency_by_minute", "endpoint_summary"]
GRAPHS = ["service_nodes", "service_calls", "service_edges", "zone_matrix", "service_error_ranking"]


def plain(df):
    rounded = df.select(*[F.round(f"`{n}`", 6).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes])
    return sorted(map(str, rounded.collect()))


def messy(spark):
    """Traces with odd rows: no time, no resource, a nameless one, no duration, no status."""
    traces = as_traces(spark.read.parquet(EVENTS))
    k = F.col("req_body_size") % 9
    return traces.withColumns(
        {
            "event_timestamp": F.when(k != 1, F.col("event_timestamp")),
            "id_recurso": F.when(k == 2, F.lit("")).when(k == 3, F.lit("X")).when(k != 4, F.col("id_recurso")),
            "time_transaction": F.when(k != 5, F.col("time_transaction")),
            "status_response": F.when(k != 6, F.col("status_response")),
            "source_zone": F.when(k == 7, F.lit("")).when(k != 8, F.col("source_zone")),
        }
    )


@pytest.fixture(scope="module")
def traces(spark):
    return messy(spark).cache()


@pytest.fixture(scope="module")
def rows(traces):
    return partials(traces).cache()


@pytest.mark.parametrize("flt", [TraceFilter(), WEEK], ids=["all", "some"])
@pytest.mark.parametrize("name", PANELS + GRAPHS)
def test_panels_equal_those_from_traces(traces, rows, name, flt):
    expected = getattr(dashboard if name in PANELS else graph, name)(traces, flt)
    got = getattr(panels, name)(rows, flt)
    assert got.columns == expected.columns
    assert plain(got) == plain(expected)


def test_merged_nodes(traces, rows):
    assert plain(panels.service_nodes(rows, merge=True)) == plain(graph.service_nodes(traces, merge=True))


def test_a_selection_inside_a_minute_is_refused(rows):
    for flt in (TraceFilter("2024-01-05T06:30:01"), TraceFilter(None, "2024-01-05T06:30:00")):
        with pytest.raises(ValueError):
            panels.success_rate(rows, flt)


def test_percentiles_of_merged_sketches_are_within_their_bound(spark):
    n = 400_000
    id = F.col("id")
    traces = spark.range(n).select(
        F.timestamp_seconds(1_704_067_200 + id % 36_000).alias("event_timestamp"),
        (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) * (1 + id % 3)).alias("time_transaction"),
        *[F.lit("z" if t == "string" else 1).cast(t).alias(c) for c, t in [
            ("zona", "string"), ("year", "int"), ("month", "int"), ("day", "int"), ("hour", "int"), ("endpoint", "string"),
            ("id_recurso", "string"), ("consumer_type", "string"), ("source_zone", "string"), ("source_service", "string"),
            ("status_response", "int"), ("req_body_size", "bigint"), ("resp_body_size", "bigint"),
        ]],
    )
    rows = partials(traces)
    assert rows.count() == 600
    found = merged(rows, ["zona"], percents=[50, 95, 99]).first()
    for p in (50, 95, 99):
        value = found[f"p{p}"]
        least, most = traces.agg(
            F.avg((F.col("time_transaction") < value).cast("double")), F.avg((F.col("time_transaction") <= value).cast("double"))
        ).first()
        assert least - 2 * RANK_ERROR <= p / 100 <= most + 2 * RANK_ERROR
    assert found.requests == n


def test_stream_and_late_traces(spark, traces, tmp_path):
    """The view equals the batch at each step, and opens no file of a closed span."""
    source, landing, rolled, ck = (str(tmp_path / n) for n in ("in", "landing", "rolled", "ck"))

    def land(rows):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(traces.schema).parquet(source)
        start_landing(stream, landing, str(tmp_path / "landing-ck"), ONCE).awaitTermination()
        time.sleep(2.1)

    def roll():
        start_rollup = rollup.start_rollup(spark, landing, rolled, ck, ONCE, span_seconds=1)
        start_rollup.awaitTermination()

    def view():
        return rollup.rollup_view(spark, landing, rolled, ck, span_seconds=1)

    land(traces.where("day <= 10"))
    assert view().columns == ROLLUP_COLUMNS
    same = lambda: plain(panels.endpoint_summary(view())) == plain(dashboard.endpoint_summary(read_traces(spark, landing)))
    assert same()
    roll()
    land(traces.where("day > 10 AND day <= 20"))
    assert same()
    roll()
    # Two weeks late, and without a time: both land, so both are rolled up.
    land(traces.where("day > 20 OR day IS NULL").unionByName(traces.where("day = 2").limit(30)))
    roll()
    land(traces.where("day = 1").limit(3))
    roll()
    assert same()
    expected = read_traces(spark, landing)
    for name in PANELS + GRAPHS:
        assert plain(getattr(panels, name)(view())) == plain(getattr(dashboard if name in PANELS else graph, name)(expected))
    before = plain(panels.volume_by_minute(view()))
    total = expected.count()

    edge = rollup.rolled_up_to(spark, ck).timestamp() // 1
    closed = [p for p in tmp_path.glob("landing/zona*/**/*.parquet") if p.stat().st_mtime < edge - 1]
    assert len(closed) > 100
    for path in closed:
        os.truncate(path, 0)
    assert plain(panels.volume_by_minute(view())) == before
    assert merged(view(), []).first().requests == total


def test_a_run_begun_anew_doubles_nothing(spark, traces, tmp_path):
    landing, rolled, ck = (str(tmp_path / n) for n in ("landing", "rolled", "ck"))
    for day in (1, 2, 3):
        traces.where(f"day = {day}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(traces.schema).parquet(str(tmp_path / "in"))
        start_landing(stream, landing, str(tmp_path / "landing-ck"), ONCE).awaitTermination()
        time.sleep(1.2)
    for _ in range(2):
        rollup.start_rollup(spark, landing, rolled, ck, ONCE, span_seconds=1, files_per_batch=10).awaitTermination()
    # As if the last batch had been killed before its commit: it is run again, and its rows are not added twice.
    last = max(int(n) for n in list_names(spark, f"{ck}/commits") if n.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (tmp_path / "ck" / "commits" / name).unlink()
    view = rollup.rollup_view(spark, landing, rolled, ck, span_seconds=1)
    assert merged(view, []).first().requests == read_traces(spark, landing).count()
    rollup.start_rollup(spark, landing, rolled, ck, ONCE, span_seconds=1).awaitTermination()
    view = rollup.rollup_view(spark, landing, rolled, ck, span_seconds=1)
    assert merged(view, []).first().requests == read_traces(spark, landing).count()


def test_minutes_of_a_roll_up_prune_like_traces(spark, rows, tmp_path):
    rows.write.partitionBy("zona", "year", "month", "day", "hour").parquet(str(tmp_path / "r"))
    hour = datetime(2024, 1, 5, 6)
    flt = TraceFilter(hour, hour + timedelta(hours=1, microseconds=-1), ["zone1"])
    plan = panels.volume_by_minute(spark.read.parquet(str(tmp_path / "r")), flt)._jdf.queryExecution().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all(name in filters for name in ("zona", "year", "month", "day", "hour"))
