import json

import pytest

from hoptrail.operators import graph, lookup
from hoptrail.operators.pricing import top_open_orders
from hoptrail.schema import PARTITION_COLUMNS, TRACE_COLUMNS
from hoptrail.sources.events import as_traces
from hoptrail.sources.tables import read_traces, register_table, sync_partitions
from hoptrail.sources.topology import as_edges, read_topology

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def traces(spark):
    return as_traces(spark.read.parquet(f"{SF}/events.parquet")).cache()


def test_lookup_needs_a_time_partition(traces):
    for filters in ({}, {"hour": 3}, {"zona": "zone1", "year": None}, {"elsewhere": 1}):
        with pytest.raises(ValueError):
            lookup.find_traces(traces, filters)


def test_lookup_ignores_other_columns_and_limits(traces):
    found = lookup.find_traces(traces, {"month": 1, "id_consumer": "nobody", "status_response": 200})
    assert found.count() == 100
    assert lookup.find_traces(traces, {"day": 3, "hour": 5}, limit=10**6).count() == traces.where("day = 3 AND hour = 5").count()
    times = [r.event_timestamp for r in found.collect()]
    assert times == sorted(times)
    assert lookup.find_traces(traces, {"year": 2024, "zona": "zone1' OR '1'='1"}).count() == 0


def test_top_k_plans(traces):
    for df in (lookup.recent_traces(traces), lookup.top_consumers(traces), lookup.find_traces(traces, {"year": 2024})):
        assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()


def test_select_only(spark, traces, tmp_path):
    traces.createOrReplaceTempView("t")
    assert lookup.run_select(spark, " select count(*) AS n FROM t -- all").first().n == traces.count()
    assert lookup.run_select(spark, "SELECT zona FROM t WHERE endpoint = ?", ["' OR 1=1"]).count() == 0
    assert lookup.run_select(spark, "SELECT 'join using ''x'' or reflect (y)' AS text").count() == 1
    ordered = lookup.run_select(spark, "WITH d AS (SELECT DISTINCT zona FROM t) SELECT * FROM d ORDER BY zona DESC")
    assert [r.zona for r in ordered.collect()] == ["zone3", "zone2", "zone1"]
    for text in (
        "DROP TABLE t",
        "INSERT INTO t SELECT * FROM t",
        "SHOW TABLES",
        "SELECT TRANSFORM(zona) USING 'cat' AS (z) FROM t",
        "SELECT reflect('java.lang.System', 'exit', 1)",
        "SELECT `reflect`('java.lang.Math', 'abs', -7)",
        "SELECT reflect/**/('java.lang.Math', 'abs', -7)",
        "SELECT 1 WHERE 7 = (SELECT `java_method`('java.lang.Math', 'abs', -7))",
        "WITH x AS (SELECT `try_reflect`('java.lang.Math', 'abs', -7) AS a) SELECT a FROM x",
    ):
        with pytest.raises(ValueError):
            lookup.run_select(spark, text)
    path = str(tmp_path / "file")
    traces.limit(1).write.parquet(path)
    for text in (
        "SELECT * FROM text.`/etc/hostname`",
        "SELECT count(*) FROM binaryFile.`/etc/hostname`",
        f"SELECT * FROM parquet.`{path}`",
        f"WITH x AS (SELECT * FROM json.`{path}`) SELECT * FROM x",
        f"SELECT * FROM IDENTIFIER('parquet.`{path}`')",
        f"SELECT 1 WHERE EXISTS (SELECT * FROM org.apache.spark.sql.parquet.`{path}`)",
    ):
        with pytest.raises(Exception, match="cannot be found|REQUIRES_SINGLE_PART_NAMESPACE"):
            lookup.run_select(spark, text)
    assert spark.sql(f"SELECT * FROM parquet.`{path}`").count() == 1
    for text in ("WITH a AS (SELECT 1 AS x) INSERT INTO t SELECT * FROM a", "SELECT 1; DROP TABLE t"):
        with pytest.raises(Exception):
            lookup.run_select(spark, text)


def test_external_table_and_sync(spark, traces, tmp_path):
    root = str(tmp_path / "root")
    traces.where("day = 1").write.partitionBy(*PARTITION_COLUMNS).parquet(root)
    register_table(spark, "stored_traces", root)
    try:
        sync_partitions(spark, "stored_traces", "FULL")
        first = traces.where("day = 1").count()
        assert spark.table("stored_traces").count() == first
        assert spark.table("stored_traces").columns == TRACE_COLUMNS
        traces.where("day = 2").write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(root)
        sync_partitions(spark, "stored_traces")
        assert spark.table("stored_traces").count() == traces.where("day <= 2").count()
        gone = spark.table("stored_traces").select(*PARTITION_COLUMNS).first()
        before = spark.sql("SHOW PARTITIONS stored_traces").count()
        path = root + "/" + "/".join(f"{c}={gone[c]}" for c in PARTITION_COLUMNS)
        from hoptrail.sources.files import delete
        delete(spark, path)
        sync_partitions(spark, "stored_traces", "ADD")
        assert spark.sql("SHOW PARTITIONS stored_traces").count() == before
        sync_partitions(spark, "stored_traces", "FULL")
        assert spark.sql("SHOW PARTITIONS stored_traces").count() == before - 1
    finally:
        spark.sql("DROP TABLE stored_traces")
    assert read_traces(spark, root).count() > 0


@pytest.fixture
def manifests(tmp_path):
    apps = [
        {"name": "kiln-api", "scenario": "CALM",
         "downstream_calls": [{"target": "glaze-api", "path": "/glaze-api/mix", "probability": 0.6},
                              {"target": "clay-api", "path": "/clay-api/weigh", "probability": 0.2}]},
        {"name": "clay-api", "scenario": "JUMPY", "downstream_calls": []},
    ]
    (tmp_path / "zone1.json").write_text(json.dumps({"apps": apps}, indent=2))
    (tmp_path / "zone2.json").write_text(json.dumps({"apps": []}, indent=2))
    return str(tmp_path)


def test_topology(spark, manifests):
    rows = sorted((tuple(r) for r in read_topology(spark, manifests).collect()), key=str)
    assert rows == sorted(
        [
            ("zone1", "kiln-api", "CALM", "glaze-api", "/glaze-api/mix", 0.6),
            ("zone1", "kiln-api", "CALM", "clay-api", "/clay-api/weigh", 0.2),
            ("zone1", "clay-api", "JUMPY", None, None, None),
            ("zone2", None, None, None, None, None),
        ],
        key=str,
    )
    assert as_edges(read_topology(spark, manifests)).count() == 2


def test_edge_drift(spark, manifests):
    calls = spark.createDataFrame(
        [("zone1/kiln-api", "zone1/glaze-api", 30), ("zone1/glaze-api", "zone1/clay-api", 5), ("external", "zone1/kiln-api", 100)],
        "source string, target string, requests bigint",
    )
    served = spark.createDataFrame([("zone1/kiln-api", 100)], "node string, served bigint")
    got = {
        (r.source, r.target): (r.status, r.probability, r.requests, r.observed_share)
        for r in graph.edge_drift(read_topology(spark, manifests), calls, served).collect()
    }
    assert got == {
        ("zone1/kiln-api", "zone1/glaze-api"): ("matched", 0.6, 30, 0.3),
        ("zone1/kiln-api", "zone1/clay-api"): ("missing", 0.2, 0, 0.0),
        ("zone1/glaze-api", "zone1/clay-api"): ("undeclared", None, 5, None),
    }


def test_open_orders_plan_adds_up_before_the_join(spark):
    from datetime import date
    tables = [spark.read.parquet(f"{SF}/{n}.parquet") for n in ("customer", "orders", "lineitem")]
    df = top_open_orders(*tables, segment="BUILDING", day=date(1998, 3, 15))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert plan.index("Join") < plan.index("partial_sum((l_extendedprice")
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double,l_shipdate" in plan
