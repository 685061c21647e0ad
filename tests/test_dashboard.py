import statistics
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hoptrail.functions.traces import time_parts
from hoptrail.operators import dashboard, detect, graph, load
from hoptrail.plans.filters import TraceFilter
from hoptrail.plans.latency import latency_profile
from hoptrail.plans.numbering import number_rows
from hoptrail.schema import PARTITION_COLUMNS, TRACE_DDL
from hoptrail.sources.events import as_traces
from hoptrail.sources.tables import read_traces

EVENTS = "/root/testdata/sf0.001/events.parquet"


def traces(spark, *rows):
    names = [field.split()[0] for field in TRACE_DDL.split(", ")]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], TRACE_DDL)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("traces"))
    (
        as_traces(spark.read.parquet(EVENTS))
        .repartition(*PARTITION_COLUMNS)
        .write.partitionBy(*PARTITION_COLUMNS)
        .parquet(root + "/t")
    )
    return read_traces(spark, root + "/t")


def test_no_traces(spark):
    empty = traces(spark)
    assert dashboard.success_rate(empty).collect() == [(None,)]
    assert dashboard.requests_per_second(empty).collect() == [(None, None)]
    for query in (
        dashboard.volume_by_minute, dashboard.errors_by_minute, dashboard.bytes_by_minute,
        dashboard.latency_by_minute, dashboard.endpoint_summary, graph.service_nodes,
        graph.service_edges, graph.zone_matrix, graph.service_error_ranking,
    ):
        assert query(empty).count() == 0


def test_rate_of_a_single_instant(spark):
    one = {"event_timestamp": datetime(2024, 1, 1), "status_response": 200}
    assert dashboard.requests_per_second(traces(spark, one, one, one)).collect() == [(3, 3.0)]


def test_seconds_are_complete_seconds(spark):
    t = datetime(2024, 1, 1)
    rows = [{"event_timestamp": t + timedelta(milliseconds=m)} for m in (0, 500, 2900)]
    assert dashboard.requests_per_second(traces(spark, *rows)).collect() == [(1, 1.5)]


def test_zone_matrix_keeps_equal_labels_apart(spark):
    rows = [{"source_zone": z, "zona": "zone1", "status_response": 200} for z in (None, "", "external")]
    got = graph.zone_matrix(traces(spark, *rows)).collect()
    assert [(r.origen, r.total_requests) for r in got] == [("external", 1)] * 3


def test_nodes_and_edges_of_odd_traces(spark):
    rows = [
        # A legacy internal caller without a zone is drawn as external.
        {"consumer_type": "internal", "source_zone": "unknown", "source_service": "a-b",
         "id_recurso": "catalog-api-1", "zona": "z1", "time_transaction": 1},
        {"consumer_type": "internal", "source_zone": "z1", "source_service": "catalog-api",
         "id_recurso": "orders-api-2", "zona": "z1", "time_transaction": 2},
        # No resource: only a caller. A resource without a service name: a null node.
        {"consumer_type": "external", "source_zone": "external", "id_recurso": "", "zona": "z1"},
        {"consumer_type": "external", "source_zone": "external", "id_recurso": "X1", "zona": "z1",
         "time_transaction": 5},
    ]
    df = traces(spark, *rows)
    nodes = sorted((tuple(r) for r in graph.service_nodes(df).collect()), key=str)
    assert nodes == sorted(
        [
            ("external", "clients", "external", 3),
            ("z1/catalog-api", "catalog-api", "z1", 1),
            ("z1/catalog-api", "catalog-api", "z1", 0),
            ("z1/orders-api", "orders-api", "z1", 0),
            (None, None, "z1", 0),
        ],
        key=str,
    )
    merged = {r.id: r.mainstat for r in graph.service_nodes(df, merge=True).collect()}
    assert merged == {"external": 3, "z1/catalog-api": 1, "z1/orders-api": 0, None: 0}
    edges = {(r.source, r.target): (r.mainstat, r.secondarystat) for r in graph.service_edges(df).collect()}
    assert edges == {
        ("external", "z1/catalog-api"): ("1", "1.0"),
        ("z1/catalog-api", "z1/orders-api"): ("1", "2.0"),
        ("external", None): ("1", "5.0"),
    }


def test_numbers_are_consecutive(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    ids = [r.id for r in number_rows(df, ["a", "b"]).collect()]
    assert sorted(ids) == list(range(1, 2001))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 40))), min_size=1, max_size=60))
def test_latency_profile_against_brute_force(spark, values):
    df = spark.createDataFrame(values, "k string, time_transaction bigint")
    for row in latency_profile(df, ["k"], [50, 95, 99]).collect():
        mine = [v for k, v in values if k == row.k]
        timed = sorted(v for v in mine if v is not None)
        assert row.n == len(mine)
        for percent in (50, 95, 99):
            rank = -(-len(timed) * percent // 100)
            assert row[f"p{percent}"] == (timed[max(rank, 1) - 1] if timed else None)
        assert row.mean == (pytest.approx(statistics.fmean(timed)) if timed else None)
        assert row.stddev == (pytest.approx(statistics.stdev(timed)) if len(timed) > 1 else None)


def test_filter_prunes_partitions_and_reaches_the_files(spark, stored):
    flt = TraceFilter("2024-01-05T06:30:00", "2024-01-05T08:00:00+00:00", ["zone1"], ["/orders-api/checkout"])
    df = dashboard.success_rate(stored, flt)
    plan = df._jdf.queryExecution().executedPlan().toString()
    partition = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "zona" in partition and "year" in partition and "hour" in partition
    assert "event_timestamp" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<endpoint:string,status_response:int,event_timestamp:timestamp>" in plan
    kept = flt.apply(stored).select("_metadata.file_path").distinct().collect()
    assert all("/zona=zone1/year=2024/month=1/day=5/hour=" in r.file_path for r in kept)


def test_edges_share_one_exchange_and_need_no_job(spark):
    traces = as_traces(spark.read.parquet(EVENTS))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("edges", "building service_edges")
    edges = graph.service_edges(traces)
    assert list(tracker.getJobIdsForGroup("edges")) == []
    spark.sparkContext.setJobGroup("tests", "")
    edges.collect()
    assert "ReusedExchange" in edges._jdf.queryExecution().executedPlan().toString()


def test_a_range_over_new_year_bounds_bare_columns(spark, tmp_path):
    traces = as_traces(spark.read.parquet(EVENTS)).limit(50)
    shifted = traces.withColumns({"year": F.lit(2023), "month": F.lit(12), "day": F.lit(31)})
    traces.unionByName(shifted).write.partitionBy("year", "month", "day").saveAsTable("over_new_year")
    try:
        flt = TraceFilter("2023-12-31T20:00:00", "2024-01-01T04:00:00")
        plan = flt.apply(spark.table("over_new_year"))._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
        for bound in ("(year", "(month", "(day"):
            assert bound in filters
        assert "> 2023" in filters and "< 2024" in filters and ">= 31" in filters and "<= 1)" in filters
    finally:
        spark.sql("DROP TABLE over_new_year")


def test_windows_before_the_selection_are_read(spark):
    rows = [(f"2024-01-01 10:0{m}:30", "z", "/a", "c", 200) for m in range(6) for _ in range(10)]
    traces = spark.createDataFrame(rows, "t string, zona string, endpoint string, id_consumer string, status_response int")
    at = F.to_timestamp("t")
    traces = traces.withColumns({"event_timestamp": at} | {k: F.expr(f"{k}(to_timestamp(t))") for k in ("year", "month", "day", "hour")})
    steady = TraceFilter(from_ts="2024-01-01T10:05:00")
    options = {"window_seconds": 60, "trailing": 5, "min_requests": 5, "factor": 2.0}
    # Ten a minute all along is no flood, also where the selection begins.
    assert detect.floods(traces, steady, **options).count() == 0
    assert detect.floods(traces, **options).count() > 0
    assert load.rising_zones(traces, steady, step_seconds=60, steps=1).count() == 0


def test_filter_bounds_are_included(spark):
    t = datetime(2024, 1, 5, 6, 30)
    moments = spark.createDataFrame([(t,), (t + timedelta(hours=1),), (t - timedelta(microseconds=1),)], "event_timestamp timestamp")
    df = moments.withColumns(time_parts(F.col("event_timestamp")))
    assert TraceFilter(t, t + timedelta(hours=1)).apply(df).count() == 2
    assert TraceFilter(from_ts=t).apply(df).count() == 2
    assert TraceFilter(to_ts=t).apply(df).count() == 2
    year_wide = TraceFilter("2023-12-31T23:00:00", "2024-02-01T00:00:00")
    assert year_wide.apply(df).count() == 3


def test_open_and_empty_choices(spark, stored):
    assert TraceFilter().apply(stored).count() == stored.count()
    assert TraceFilter(zones=[]).apply(stored).count() == 0
    one = TraceFilter(endpoints=["/orders-api/checkout"])
    assert one.apply(stored).count() < stored.count() == one.apply(stored, by_endpoint=False).count()
