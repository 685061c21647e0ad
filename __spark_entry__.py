"""

Queries over traces read `events` through the mapping of
`hoptrail.sources.events`; the oracles state the same mapping in SQL.
Doubles are rounded on both sides, as the order of a float sum is not fixed.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoptrail.functions.callers import CALLER_COLUMNS
from hoptrail.functions.traces import date_key, url_path, url_query
from hoptrail.operators import chains, dashboard, detect, graph, load, lookup, panels, pricing
from hoptrail.operators import sessions as visits
from hoptrail.plans.filters import TraceFilter
from hoptrail.plans.normalize import normalize_messages, split_unreadable
from hoptrail.plans.rollup import partials
from hoptrail.schema import TRACE_COLUMNS
from hoptrail.session import configure
from hoptrail.sources.events import as_traces
from hoptrail.sources.tables import fill_callers
from hoptrail.streaming.hot import payload

try:
    import corpus_pipeline
    import hoptrail.llm.queries as llm
except ImportError:
    # Without the folder, or without a library that only it needs, the rest still works.
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_traces(_table(spark, sf_dir, "events"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.round(F.col(f"`{name}`"), DIGITS) for name, kind in df.dtypes if kind == "double"}
    )


def _over_traces(operator: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf_dir: _rounded(operator(_traces(spark, sf_dir), *args, **options))


def _over_rollup(panel: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: _rounded(panel(partials(_traces(spark, sf_dir))))


# A dashboard selection: 15 days, two of the zones, three of the endpoints.
SELECTION = TraceFilter(
    from_ts="2024-01-05T06:30:00",
    to_ts="2024-01-20T18:15:00",
    zones=["zone1", "zone2"],
    endpoints=["/catalog-api/products", "/orders-api/checkout", "/payments-api/checkout"],
)

OVERLAYS = [
    load.OverlayEvent("flash_sale", 11, 2),
    load.OverlayEvent("maintenance", 12.5, 3),
    load.OverlayEvent("backup", 22.75, 1.25),
]


def _messages(traces: DataFrame) -> DataFrame:
    """The traces as the log shipper would send them."""
    record = F.to_json(
        F.struct(
            "date_transaction",
            F.concat("endpoint", F.lit("?k="), F.col("req_body_size").cast("string")).alias(
                "endpoint"
            ),
            F.when(F.col("req_body_size") % 7 != 2, F.col("id_consumer")).alias("id_consumer"),
            F.when(F.col("req_body_size") % 7 == 3, F.lit(""))
            .when(F.col("req_body_size") % 7 != 4, F.col("id_recurso"))
            .alias("id_recurso"),
            "id_transaccion",
            F.concat(F.lit("10.0.0."), "req_body_size").alias("ip_consumer"),
            F.concat(F.lit("10.0.1."), "req_body_size").alias("ip_transaccion"),
            "req_body_size",
            (F.col("req_body_size") + 1).alias("resp_body_size"),
            # Some have no status, no consumer, no resource or an empty one.
            F.when(F.col("req_body_size") % 7 != 1, F.col("status_response")).alias("status_response"),
            "time_transaction",
            F.lit("GET").alias("tipo_operacion"),
        )
    )
    envelope = F.to_json(F.struct(F.lit("1704067200.0").alias("@timestamp"), record.alias("log")))
    return traces.select(envelope.cast("binary").alias("value"))


def _normalized(traces: DataFrame) -> DataFrame:
    return normalize_messages(_messages(traces), "zone9")


def _quarantine(traces: DataFrame) -> DataFrame:
    """What is put aside when the messages of failed requests are cut off."""
    cut = F.concat(F.lit("not json "), "id_transaccion").cast("binary")
    failed = traces.where("status_response >= 500").select(cut.alias("value"))
    messages = _messages(traces).unionByName(failed)
    return split_unreadable(messages, "zone9")[1].select(F.col("value").alias("raw"))


def _filled_callers(traces: DataFrame) -> DataFrame:
    """Caller columns derived anew where an older table lacks them."""
    lacking = traces.withColumns({name: F.lit(None).cast("string") for name in CALLER_COLUMNS})
    return fill_callers(lacking).select("id_transaccion", *CALLER_COLUMNS)


def _edge_drift(traces: DataFrame) -> DataFrame:
    declared = traces.sparkSession.createDataFrame(
        [("zone1", "orders-api", "search-api", 0.5)], "zone string, app string, target string, probability double"
    )
    return graph.edge_drift(
        declared, graph.service_calls(traces), graph.requests_per_service(traces)
    )


# Declared calls of several kinds: met by the traces, far off, never seen, of an idle caller.
DECLARED = [
    ("zone1", "orders-api", "search-api", 0.5),
    ("zone1", "orders-api", "catalog-api", 0.9),
    ("zone2", "orders-api", "auth-api", 0.2),
    ("zone2", "orders-api", "payments-api", 1.0),
    ("zone3", "orders-api", "orders-api", 0.25),
    ("zone3", "search-api", "auth-api", 0.1),
]


def _edge_drift_significance(traces: DataFrame) -> DataFrame:
    declared = traces.sparkSession.createDataFrame(
        DECLARED, "zone string, app string, target string, probability double"
    )
    return graph.edge_drift_significance(
        declared, graph.service_calls(traces), graph.requests_per_service(traces)
    )


def _caller_fields(traces: DataFrame) -> DataFrame:
    consumer = F.col("id_consumer")
    return traces.groupBy(
        "id_consumer", *[rule(consumer).alias(name) for name, rule in CALLER_COLUMNS.items()]
    ).agg(F.count(F.lit(1)).alias("total"))


def _date_volume(traces: DataFrame) -> DataFrame:
    return traces.groupBy(date_key().alias("date_key"), "hour").agg(
        F.count(F.lit(1)).alias("total")
    )


def _hot_payload(traces: DataFrame) -> DataFrame:
    return traces.select(
        "id_transaccion",
        payload(TRACE_COLUMNS).alias("payload"),
    )


def _url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id", url_path(url).alias("path"), url_query(url).alias("query_params")
    )


def _select(spark: SparkSession, sf_dir: str) -> DataFrame:
    _traces(spark, sf_dir).createOrReplaceTempView("hoptrail_traces")
    return lookup.run_select(
        spark,
        "WITH e AS (SELECT zona, status_response FROM hoptrail_traces "
        "WHERE status_response >= :least) "
        "SELECT zona, status_response, count(*) AS total FROM e GROUP BY 1, 2",
        {"least": 400},
    )


def _cascades(traces: DataFrame) -> DataFrame:
    return detect.cascades(traces, graph.service_calls(traces), min_share=0.01)


def _user_day_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces in which all requests of a user on one day share a transaction id."""
    events = _table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    return as_traces(
        events.withColumn("event_id", F.concat(F.col("user_id").cast("string"), F.lit("-"), day))
    )


def _chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.call_chains(_user_day_traces(spark, sf_dir))


def _call_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of a zone and day under one id; they nest, as each lasts a minute per millisecond."""
    events = _table(spark, sf_dir, "events")
    shared = F.concat((F.col("user_id") % 3).cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd"))
    longer = as_traces(events.withColumn("event_id", shared)).withColumn(
        "time_transaction", F.col("time_transaction") * 60_000
    )
    return chains.call_tree(longer, segment_seconds=3600, cell_seconds=3600).select(
        "id_transaccion", "hop", "caller", "callee", "parent_hop"
    )


def _catalogue(traces: DataFrame) -> DataFrame:
    return graph.service_catalogue(traces).withColumn("services", F.concat_ws(",", "services"))


def _pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(pricing.pricing_summary(_table(spark, sf_dir, "lineitem")))


def _open_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = [_table(spark, sf_dir, name) for name in ("customer", "orders", "lineitem")]
    return _rounded(pricing.top_open_orders(*tables, segment="BUILDING", day=date(1998, 3, 15)))


def entry(spark: SparkSession) -> DataFrame:
    """The per-endpoint summary of all traces."""
    return queries()["endpoint_summary"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = _engine_queries()
    if llm:
        found |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _engine_queries() -> dict[str, Query]:
    return {
        "success_rate": _over_traces(dashboard.success_rate),
        "requests_per_second": _over_traces(dashboard.requests_per_second),
        "volume_by_minute": _over_traces(dashboard.volume_by_minute),
        "errors_by_minute": _over_traces(dashboard.errors_by_minute),
        "bytes_by_minute": _over_traces(dashboard.bytes_by_minute),
        "latency_by_minute": _over_traces(dashboard.latency_by_minute),
        "endpoint_summary": _over_traces(dashboard.endpoint_summary),
        "selected_success_rate": _over_traces(dashboard.success_rate, SELECTION),
        "selected_requests_per_second": _over_traces(dashboard.requests_per_second, SELECTION),
        "selected_endpoint_summary": _over_traces(dashboard.endpoint_summary, SELECTION),
        "selected_volume_by_minute": _over_traces(dashboard.volume_by_minute, SELECTION),
        "selected_zone_matrix": _over_traces(graph.zone_matrix, SELECTION),
        "selected_errors_by_minute": _over_traces(dashboard.errors_by_minute, SELECTION),
        "selected_bytes_by_minute": _over_traces(dashboard.bytes_by_minute, SELECTION),
        "selected_latency_by_minute": _over_traces(dashboard.latency_by_minute, SELECTION),
        "selected_service_nodes": _over_traces(graph.service_nodes, SELECTION),
        "selected_service_edges": _over_traces(
            lambda traces: graph.service_edges(traces, SELECTION).drop("id")
        ),
        "selected_service_error_ranking": _over_traces(graph.service_error_ranking, SELECTION),
        "service_nodes": _over_traces(graph.service_nodes),
        "service_nodes_merged": _over_traces(graph.service_nodes, merge=True),
        "service_edges": _over_traces(lambda traces: graph.service_edges(traces).drop("id")),
        "service_edge_ids": _over_traces(lambda traces: graph.service_edges(traces).select("id")),
        "edge_drift": _over_traces(_edge_drift),
        "filled_callers": _over_traces(_filled_callers),
        "quarantine": _over_traces(_quarantine),
        "zone_matrix": _over_traces(graph.zone_matrix),
        "service_error_ranking": _over_traces(graph.service_error_ranking),
        "service_catalogue": _over_traces(_catalogue),
        "top_consumers": _over_traces(lookup.top_consumers),
        "zone_consumers": _over_traces(lookup.zone_consumers, "zone1"),
        "status_by_zone": _over_traces(lookup.status_by_zone),
        "row_count": _over_traces(lookup.row_count),
        "zones": _over_traces(lookup.zones),
        "endpoints": _over_traces(lookup.endpoints, ["zone1", "zone3"]),
        "consumers": _over_traces(lookup.consumers),
        "recent_traces": _over_traces(lookup.recent_traces),
        "find_traces": _over_traces(
            lookup.find_traces, {"year": 2024, "month": 1, "zona": "zone2", "status_response": 500}
        ),
        "transaction": _over_traces(lookup.transaction, "42"),
        "run_select": _select,
        "pricing_summary": _pricing,
        "top_open_orders": _open_orders,
        "normalized_messages": _over_traces(_normalized),
        "url_parts": _url_parts,
        "caller_fields": _over_traces(_caller_fields),
        "date_volume": _over_traces(_date_volume),
        "hot_payload": _over_traces(_hot_payload),
        "sessions": _over_traces(visits.sessions),
        "funnel": _over_traces(visits.funnel),
        "load_profile": _over_traces(load.load_profile),
        "volume_by_phase": _over_traces(load.volume_by_phase),
        "tagged_traces": _over_traces(
            lambda traces: load.tag_events(traces, OVERLAYS).select("id_transaccion", "event")
        ),
        "rising_zones": _over_traces(load.rising_zones, step_seconds=600, steps=3),
        "scanners": _over_traces(
            detect.scanners, window_seconds=86400, min_requests=3, min_share_404=0.3, min_paths=2
        ),
        "floods": _over_traces(
            detect.floods, window_seconds=3600, trailing=6, min_requests=3, factor=2.0
        ),
        "failures_by_minute": _over_traces(detect.failures_by_minute),
        "cascades": _over_traces(_cascades),
        "rolling_stats": _over_traces(detect.rolling_stats),
        "call_chains": _chains,
        "call_tree": _call_tree,
        "ordered_funnel": _over_traces(visits.ordered_funnel),
        "edge_drift_significance": _over_traces(_edge_drift_significance),
        "rolled_volume_by_minute": _over_rollup(panels.volume_by_minute),
        "rolled_latency_by_minute": _over_rollup(panels.latency_by_minute),
        "rolled_service_edges": _over_rollup(lambda rows: panels.service_edges(rows).drop("id")),
        "rolled_zone_matrix": _over_rollup(panels.zone_matrix),
        # The percentiles of groups this large are within a bound, not exact.
        "rolled_endpoint_summary": _over_rollup(
            lambda rows: panels.endpoint_summary(rows).drop("Latencia p95", "Latencia p99")
        ),
    }


# The `events` table as traces.
TRACES_SQL = """
WITH base AS (
  SELECT ts AS event_timestamp,
         CAST(event_id AS VARCHAR) AS id_transaccion,
         user_id, event_type,
         'zone' || (user_id % 3 + 1) AS zona,
         CASE event_type WHEN 'view' THEN '/catalog-api/products'
              WHEN 'click' THEN '/catalog-api/products'
              WHEN 'purchase' THEN '/orders-api/checkout'
              WHEN 'signup' THEN '/auth-api/validate'
              WHEN 'error' THEN '/payments-api/checkout' END AS endpoint,
         CASE event_type WHEN 'purchase' THEN 'orders-api-1' WHEN 'signup' THEN 'auth-api-1'
              WHEN 'error' THEN 'payments-api-1' ELSE 'catalog-api-1' END AS id_recurso,
         CASE user_id % 5 WHEN 1 THEN '-' WHEN 2 THEN 'external/user-casual-' || user_id
              WHEN 3 THEN 'zone' || (user_id % 3 + 1) || '/orders-api-1'
              WHEN 4 THEN 'catalog-api-1' END AS id_consumer,
         CASE user_id % 5 WHEN 3 THEN 'internal' WHEN 4 THEN 'internal'
              ELSE 'external' END AS consumer_type,
         CASE user_id % 5 WHEN 2 THEN 'external' WHEN 3 THEN 'zone' || (user_id % 3 + 1)
              ELSE 'unknown' END AS source_zone,
         CASE user_id % 5 WHEN 2 THEN 'user-casual' WHEN 3 THEN 'orders-api'
              WHEN 4 THEN 'catalog-api' ELSE 'unknown' END AS source_service,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(floor(value) AS BIGINT) AS time_transaction
  FROM events
), traces AS (
  SELECT *, k AS req_body_size, k * 7 AS resp_body_size,
         CASE WHEN event_type <> 'error' THEN 200 WHEN k < 50 THEN 500
              ELSE 404 END AS status_response,
         strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S+0000') AS date_transaction,
         CAST(year(event_timestamp) AS INTEGER) AS year,
         CAST(month(event_timestamp) AS INTEGER) AS month,
         CAST(day(event_timestamp) AS INTEGER) AS day,
         CAST(hour(event_timestamp) AS INTEGER) AS hour,
         regexp_extract(id_recurso, '^([a-z]+-[a-z]+)', 1) AS service,
         zona || '/' || regexp_extract(id_recurso, '^([a-z]+-[a-z]+)', 1) AS node,
         CASE WHEN consumer_type = 'external' OR source_zone IN ('', 'unknown') THEN 'external'
              ELSE source_zone || '/' || source_service END AS caller,
         hour(event_timestamp) + minute(event_timestamp) / 60.0
           + second(event_timestamp) / 3600.0 AS h
  FROM base
)"""

SELECTION_SQL = """
  year * 10000 + month * 100 + day BETWEEN 20240105 AND 20240120
  AND event_timestamp BETWEEN TIMESTAMP '2024-01-05 06:30:00' AND TIMESTAMP '2024-01-20 18:15:00'
  AND zona IN ('zone1', 'zone2')"""
ENDPOINT_SQL = """
  AND endpoint IN ('/catalog-api/products', '/orders-api/checkout', '/payments-api/checkout')"""

SUCCESS_SQL = """
SELECT round(100.0 * count(*) FILTER (status_response BETWEEN 200 AND 299)
             / nullif(count(*), 0), 6) AS tasa_exito
FROM traces"""

RPS_SQL = """
SELECT count(*) // greatest(date_sub('second', min(event_timestamp), max(event_timestamp)), 1)
         AS rps,
       round(count(*) / CAST(greatest(date_sub('second', min(event_timestamp),
             max(event_timestamp)), 1) AS DOUBLE), 6) AS rps_exact
FROM traces"""

VOLUME_SQL = """
SELECT date_trunc('minute', event_timestamp) AS time, zona AS metric, count(*) AS volumen
FROM traces"""

SUMMARY_SQL = """
SELECT zona AS "Zona", endpoint AS "API / Endpoint", count(*) AS "Total Solicitudes",
  round(100.0 * count(*) FILTER (status_response BETWEEN 200 AND 299) / count(*), 6)
    AS "Tasa de Exito",
  count(*) FILTER (status_response BETWEEN 400 AND 499) AS "Errores 4xx",
  count(*) FILTER (status_response >= 500) AS "Errores 5xx",
  round(avg(CAST(time_transaction AS DOUBLE)), 6) AS "Latencia Prom",
  quantile_disc(CAST(time_transaction AS DOUBLE), 0.95) AS "Latencia p95",
  quantile_disc(CAST(time_transaction AS DOUBLE), 0.99) AS "Latencia p99",
  round(stddev_samp(CAST(time_transaction AS DOUBLE)), 6) AS "Desviacion Latencia",
  round(avg(CAST(req_body_size AS DOUBLE)), 6) AS "Payload In Prom",
  round(avg(CAST(resp_body_size AS DOUBLE)), 6) AS "Payload Out Prom"
FROM traces"""

MATRIX_SQL = """
SELECT coalesce(nullif(source_zone, ''), 'external') AS origen, zona AS destino,
  count(*) AS total_requests,
  round(avg(time_transaction), 1) AS avg_latency_ms,
  round(CAST(max(time_transaction) AS DOUBLE), 1) AS max_latency_ms,
  round(100.0 * count(*) FILTER (status_response >= 500) / count(*), 2) AS error_rate_pct,
  round(100.0 * count(*) FILTER (status_response BETWEEN 200 AND 299) / count(*), 2)
    AS success_rate_pct
FROM traces"""

NODES_SQL = """, nodes AS (
  SELECT caller AS id,
         CASE WHEN caller = 'external' THEN 'clients' ELSE source_service END AS title,
         CASE WHEN caller = 'external' THEN 'external' ELSE source_zone END AS subtitle,
         count(*) AS mainstat
  FROM traces GROUP BY 1, 2, 3
  UNION ALL
  SELECT DISTINCT node, service, zona, CAST(0 AS BIGINT) FROM traces
  WHERE id_recurso IS NOT NULL AND id_recurso <> ''
)"""

SESSION_SQL = """, marked AS (
  SELECT *, CASE WHEN event_timestamp - lag(event_timestamp) OVER w <= INTERVAL 30 MINUTE
                 THEN 0 ELSE 1 END AS starts
  FROM traces WINDOW w AS (PARTITION BY id_consumer ORDER BY event_timestamp)
), numbered AS (
  SELECT *, sum(starts) OVER (PARTITION BY id_consumer ORDER BY event_timestamp) AS session
  FROM marked
)"""

FAILURES_SQL = """, failing AS (
  SELECT date_trunc('minute', event_timestamp) AS minute, node AS service,
         count(*) AS requests, count(*) FILTER (status_response >= 500) AS failures,
         round(count(*) FILTER (status_response >= 500) / count(*), 6) AS failure_share
  FROM traces GROUP BY 1, 2
)"""


def oracle_sql() -> dict[str, str]:
    found = _engine_sql()
    if llm:
        found |= llm.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


# The columns of a payload in their order; the event time as text, with a fraction if it has one.
_EVENT_TIME = """CASE WHEN date_trunc('second', event_timestamp) = event_timestamp
    THEN strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') END"""
_GIVEN = {"event_timestamp": _EVENT_TIME, "tipo_operacion": "'GET'"} | dict.fromkeys(
    ("ip_consumer", "ip_transaccion", "query_params"), "NULL"
)
PAYLOAD_FIELDS = ", ".join(f"'{name}': {_GIVEN.get(name, name)}" for name in TRACE_COLUMNS)
# Views also checked with the selection, and whether they follow its endpoints.
SELECTED = {
    "errors_by_minute": True,
    "bytes_by_minute": True,
    "latency_by_minute": True,
    "service_nodes": False,
    "service_edges": False,
    "service_error_ranking": False,
}


def _selected(sql: str, by_endpoint: bool) -> str:
    where = f"{SELECTION_SQL} {ENDPOINT_SQL if by_endpoint else ''}"
    picked = sql.replace("FROM traces", "FROM picked")
    return f", picked AS (SELECT * FROM traces WHERE {where}) {picked}"


def _engine_sql() -> dict[str, str]:
    over_traces = {
        "success_rate": SUCCESS_SQL,
        "requests_per_second": RPS_SQL,
        "volume_by_minute": f"{VOLUME_SQL} GROUP BY 1, 2",
        "errors_by_minute": """
            SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS time,
                   count(*) FILTER (status_response >= 400) AS errores,
                   count(*) AS peticiones_totales
            FROM traces GROUP BY ALL""",
        "bytes_by_minute": """
            SELECT date_trunc('minute', event_timestamp) AS time,
                   CAST(sum(req_body_size) AS BIGINT) AS bytes_recibidos,
                   CAST(sum(resp_body_size) AS BIGINT) AS bytes_enviados
            FROM traces GROUP BY 1""",
        "latency_by_minute": """
            SELECT date_trunc('minute', event_timestamp) AS time,
                   round(avg(CAST(time_transaction AS DOUBLE)), 6) AS latencia_promedio,
                   quantile_disc(CAST(time_transaction AS DOUBLE), 0.95) AS latencia_p95
            FROM traces GROUP BY 1""",
        "endpoint_summary": f"{SUMMARY_SQL} GROUP BY 1, 2",
        "selected_success_rate": f"{SUCCESS_SQL} WHERE {SELECTION_SQL} {ENDPOINT_SQL}",
        "selected_requests_per_second": f"{RPS_SQL} WHERE {SELECTION_SQL} {ENDPOINT_SQL}",
        "selected_endpoint_summary": (
            f"{SUMMARY_SQL} WHERE {SELECTION_SQL} {ENDPOINT_SQL} GROUP BY 1, 2"
        ),
        "selected_volume_by_minute": (
            f"{VOLUME_SQL} WHERE {SELECTION_SQL} {ENDPOINT_SQL} GROUP BY 1, 2"
        ),
        "selected_zone_matrix": f"{MATRIX_SQL} WHERE {SELECTION_SQL} GROUP BY source_zone, zona",
        "service_nodes": f"{NODES_SQL} SELECT * FROM nodes",
        "service_nodes_merged": f"""{NODES_SQL}
            SELECT id, title, subtitle, CAST(sum(mainstat) AS BIGINT) AS mainstat
            FROM nodes GROUP BY 1, 2, 3""",
        "service_edges": """
            SELECT caller AS source, node AS target, CAST(count(*) AS VARCHAR) AS mainstat,
                   CAST(round(avg(time_transaction), 0) AS VARCHAR) AS secondarystat
            FROM traces WHERE id_recurso <> '' GROUP BY 1, 2""",
        "service_edge_ids": """
            SELECT unnest(range(1, 1 + (SELECT count(DISTINCT (caller, node)) FROM traces
                                        WHERE id_recurso <> ''))) AS id""",
        "edge_drift": """
            , declared(source, target, probability) AS (VALUES
                ('zone1/orders-api', 'zone1/search-api', 0.5)),
            seen AS (SELECT caller AS source, node AS target, count(*) AS requests
                     FROM traces WHERE id_recurso <> '' AND caller <> 'external' GROUP BY 1, 2),
            answered AS (SELECT node AS source, count(*) AS served
                         FROM traces WHERE id_recurso <> '' GROUP BY 1)
            SELECT source, target, round(probability, 6) AS probability,
                   coalesce(requests, 0) AS requests,
                   CASE WHEN probability IS NULL THEN 'undeclared'
                        WHEN requests IS NULL THEN 'missing' ELSE 'matched' END AS status,
                   round(coalesce(requests, 0) / served, 6) AS observed_share
            FROM declared FULL JOIN seen USING (source, target) LEFT JOIN answered USING (source)""",
        "filled_callers": """
            SELECT id_transaccion, consumer_type, source_zone, source_service FROM traces""",
        "quarantine": """
            SELECT 'not json ' || id_transaccion AS raw FROM traces WHERE status_response >= 500""",
        "zone_matrix": f"{MATRIX_SQL} GROUP BY source_zone, zona",
        "service_error_ranking": """
            SELECT node AS servicio,
                   round(100.0 * count(*) FILTER (status_response >= 500) / count(*), 2)
                     AS error_rate_pct,
                   count(*) AS total
            FROM traces WHERE id_recurso <> '' GROUP BY node""",
        "service_catalogue": """
            SELECT zona, string_agg(DISTINCT service, ',' ORDER BY service) AS services
            FROM traces GROUP BY zona""",
        "top_consumers": """
            SELECT id_consumer, count(*) AS total FROM traces GROUP BY 1
            ORDER BY total DESC, id_consumer NULLS LAST LIMIT 10""",
        "zone_consumers": """
            SELECT id_consumer, count(*) AS total, round(avg(time_transaction), 6) AS avg_latency
            FROM traces WHERE zona = 'zone1' GROUP BY 1""",
        "status_by_zone": """
            SELECT zona, status_response, count(*) AS total FROM traces GROUP BY 1, 2""",
        "row_count": "SELECT count(*) AS total FROM traces",
        "zones": "SELECT DISTINCT zona FROM traces",
        "endpoints": "SELECT DISTINCT endpoint FROM traces WHERE zona IN ('zone1', 'zone3')",
        "consumers": "SELECT DISTINCT id_consumer FROM traces",
        "recent_traces": """
            SELECT event_timestamp, endpoint, status_response, zona FROM traces
            ORDER BY event_timestamp DESC LIMIT 10""",
        "find_traces": """
            SELECT date_transaction, endpoint, id_consumer, id_recurso, id_transaccion,
                   CAST(NULL AS VARCHAR) AS ip_consumer, CAST(NULL AS VARCHAR) AS ip_transaccion,
                   req_body_size, resp_body_size, status_response, time_transaction,
                   'GET' AS tipo_operacion, CAST(NULL AS VARCHAR) AS query_params,
                   event_timestamp, consumer_type, source_zone, source_service,
                   zona, year, month, day, hour
            FROM traces
            WHERE year = 2024 AND month = 1 AND zona = 'zone2' AND status_response = 500
            ORDER BY event_timestamp, id_transaccion LIMIT 100""",
        "transaction": """
            SELECT id_transaccion, id_recurso, id_consumer, endpoint, status_response
            FROM traces WHERE id_transaccion = '42'""",
        "run_select": """
            SELECT zona, status_response, count(*) AS total FROM traces
            WHERE status_response >= 400 GROUP BY 1, 2""",
        "normalized_messages": """
            SELECT date_transaction, endpoint, id_transaccion, 'GET' AS tipo_operacion,
                   CASE WHEN req_body_size % 7 <> 2 THEN id_consumer END AS id_consumer,
                   CASE req_body_size % 7 WHEN 3 THEN '' WHEN 4 THEN NULL
                        ELSE id_recurso END AS id_recurso,
                   '10.0.0.' || req_body_size AS ip_consumer,
                   '10.0.1.' || req_body_size AS ip_transaccion,
                   req_body_size, req_body_size + 1 AS resp_body_size,
                   CASE WHEN req_body_size % 7 <> 1 THEN status_response END AS status_response,
                   time_transaction, 'k=' || k AS query_params,
                   date_trunc('second', event_timestamp) AS event_timestamp,
                   CASE WHEN req_body_size % 7 = 2 THEN 'external'
                        ELSE consumer_type END AS consumer_type,
                   CASE WHEN req_body_size % 7 = 2 THEN 'unknown' ELSE source_zone END AS source_zone,
                   CASE WHEN req_body_size % 7 = 2 THEN 'unknown'
                        ELSE source_service END AS source_service,
                   'zone9' AS zona, year, month, day, hour
            FROM traces""",
        "caller_fields": """
            SELECT id_consumer, consumer_type, source_zone, source_service, count(*) AS total
            FROM traces GROUP BY ALL""",
        "date_volume": """
            SELECT year * 10000 + month * 100 + day AS date_key, hour, count(*) AS total
            FROM traces GROUP BY ALL""",
        "hot_payload": f"""
            SELECT id_transaccion, CAST(to_json({{{PAYLOAD_FIELDS}}}) AS VARCHAR) AS payload
            FROM traces""",
        "sessions": f"""{SESSION_SQL}
            SELECT id_consumer, min(event_timestamp) AS session_start,
                   max(event_timestamp) AS session_end, count(*) AS requests,
                   count(*) FILTER (status_response >= 400) AS errors,
                   round(date_sub('microsecond', min(event_timestamp), max(event_timestamp))
                         / 1000000.0, 6) AS duration_s
            FROM numbered GROUP BY id_consumer, session""",
        "funnel": f"""{SESSION_SQL}, visits AS (
              SELECT CASE WHEN starts_with(id_consumer, 'external/user-casual-') THEN 'casual'
                          ELSE 'other' END AS kind,
                     count(*) FILTER (endpoint = '/catalog-api/products') AS b,
                     count(*) FILTER (endpoint = '/orders-api/checkout') AS c,
                     count(*) FILTER (endpoint = '/auth-api/validate') AS v
              FROM numbered GROUP BY id_consumer, session)
            SELECT kind, count(*) AS sessions,
                   count(*) FILTER (b > 0) AS browsing_sessions,
                   count(*) FILTER (b > 0 AND c > 0) AS checkout_sessions,
                   count(*) FILTER (b > 0 AND c > 0 AND v > 0) AS validating_sessions,
                   CAST(sum(b) AS BIGINT) AS browsing_requests,
                   CAST(sum(c) AS BIGINT) AS checkout_requests,
                   CAST(sum(v) AS BIGINT) AS validating_requests,
                   round(count(*) FILTER (b > 0 AND c > 0)
                         / nullif(count(*) FILTER (b > 0), 0), 6) AS browsing_to_checkout,
                   round(count(*) FILTER (b > 0 AND c > 0 AND v > 0)
                         / nullif(count(*) FILTER (b > 0 AND c > 0), 0), 6)
                     AS checkout_to_validating
            FROM visits GROUP BY kind""",
        "load_profile": """, hourly AS (
              SELECT hour AS hour_of_day, count(*) AS requests FROM traces GROUP BY 1
            ), compared AS (
              SELECT hour_of_day,
                     CASE WHEN hour_of_day < 5 OR hour_of_day >= 20 THEN 'night'
                          WHEN hour_of_day < 8 THEN 'morning_ramp'
                          WHEN hour_of_day < 12 THEN 'morning_peak'
                          WHEN hour_of_day < 13 THEN 'midday_peak'
                          WHEN hour_of_day < 17 THEN 'afternoon'
                          ELSE 'evening_decline' END AS phase,
                     requests, requests / max(requests) OVER () AS observed,
                     CASE WHEN hour_of_day < 5 THEN 0.1::DOUBLE
                          WHEN hour_of_day < 8 THEN 0.1::DOUBLE + (hour_of_day - 5) * 0.2::DOUBLE
                          WHEN hour_of_day < 12 THEN 0.7::DOUBLE + (hour_of_day - 8) * 0.075::DOUBLE
                          WHEN hour_of_day < 13 THEN 1.0::DOUBLE
                          WHEN hour_of_day < 17 THEN 1.0::DOUBLE - (hour_of_day - 13) * 0.05::DOUBLE
                          WHEN hour_of_day < 20
                            THEN 0.8::DOUBLE - (hour_of_day - 17) * 0.5::DOUBLE / 3
                          ELSE 0.3::DOUBLE - (hour_of_day - 20) * 0.05::DOUBLE END AS expected
              FROM hourly)
            SELECT hour_of_day, phase, requests, round(observed, 6) AS observed,
                   round(expected, 6) AS expected, round(observed - expected, 6) AS deviation
            FROM compared""",
        "volume_by_phase": """
            SELECT CASE WHEN hour < 5 OR hour >= 20 THEN 'night' WHEN hour < 8 THEN 'morning_ramp'
                        WHEN hour < 12 THEN 'morning_peak' WHEN hour < 13 THEN 'midday_peak'
                        WHEN hour < 17 THEN 'afternoon' ELSE 'evening_decline' END AS phase,
                   zona, count(*) AS requests, round(avg(time_transaction), 6) AS mean_latency
            FROM traces GROUP BY 1, 2""",
        "tagged_traces": """
            SELECT id_transaccion,
                   CASE WHEN h >= 11 AND h < 13 THEN 'flash_sale'
                        WHEN h >= 12.5 AND h < 15.5 THEN 'maintenance'
                        WHEN h >= 22.75 AND h < 24 THEN 'backup' END AS event
            FROM traces""",
        "rising_zones": """, counts AS (
              SELECT zona, time_bucket(INTERVAL 10 MINUTE, event_timestamp) AS step,
                     count(*) AS n
              FROM traces GROUP BY 1, 2)
            SELECT a.zona, a.step AS step_start, a.n AS requests, coalesce(d.n, 0) AS requests_before
            FROM counts a
            JOIN counts b ON b.zona = a.zona AND b.step = a.step - INTERVAL 10 MINUTE
            JOIN counts c ON c.zona = a.zona AND c.step = a.step - INTERVAL 20 MINUTE
            LEFT JOIN counts d ON d.zona = a.zona AND d.step = a.step - INTERVAL 30 MINUTE
            WHERE a.n > b.n AND b.n > c.n AND c.n > coalesce(d.n, 0)""",
        "scanners": """
            SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, id_consumer,
                   count(*) AS requests, count(*) FILTER (status_response = 404) AS not_found,
                   count(DISTINCT endpoint) AS paths,
                   round(count(*) FILTER (status_response = 404) / count(*), 6) AS share_404
            FROM traces GROUP BY 1, 2
            HAVING count(*) >= 3 AND count(DISTINCT endpoint) >= 2
               AND count(*) FILTER (status_response = 404) / count(*) >= 0.3""",
        "floods": """, counts AS (
              SELECT date_trunc('hour', event_timestamp) AS window_start, zona, endpoint,
                     id_consumer, count(*) AS requests
              FROM traces GROUP BY ALL
            ), trailed AS (
              SELECT a.window_start, a.zona, a.endpoint, a.id_consumer, a.requests,
                     coalesce(sum(b.requests), 0) / 6.0::DOUBLE AS trailing_mean
              FROM counts a LEFT JOIN counts b
                ON b.zona = a.zona AND b.endpoint = a.endpoint
               AND b.id_consumer IS NOT DISTINCT FROM a.id_consumer
               AND b.window_start >= a.window_start - INTERVAL 6 HOUR
               AND b.window_start < a.window_start
              GROUP BY ALL)
            SELECT window_start, zona, endpoint, id_consumer, requests,
                   round(trailing_mean, 6) AS trailing_mean
            FROM trailed WHERE requests >= 3 AND requests > 2.0 * trailing_mean""",
        "failures_by_minute": f"{FAILURES_SQL} SELECT * FROM failing",
        "cascades": f"""{FAILURES_SQL}, calls AS (
              SELECT DISTINCT caller AS service, node AS callee FROM traces)
            SELECT f.minute, f.service, f.requests, f.failures, f.failure_share, c.callee,
                   coalesce(g.requests, 0) AS callee_requests, g.failure_share AS callee_failure_share
            FROM failing f LEFT JOIN calls c ON c.service = f.service
            LEFT JOIN failing g ON g.minute = f.minute AND g.service = c.callee
            WHERE f.failure_share >= 0.01""",
        "call_chains": """, chained AS (
              SELECT *, user_id || '-' || strftime(event_timestamp, '%Y%m%d') AS txn FROM traces)
            SELECT txn AS id_transaccion,
                   row_number() OVER (PARTITION BY txn ORDER BY event_timestamp,
                     time_transaction DESC, id_recurso, endpoint, caller,
                     status_response NULLS LAST) AS hop,
                   event_timestamp, caller,
                   node AS callee, endpoint, status_response, time_transaction
            FROM chained""",
        "call_tree": """, chained AS (
              SELECT *, user_id % 3 || '-' || strftime(event_timestamp, '%Y%m%d') AS txn,
                     time_transaction * 60000 AS ms FROM traces),
            hops AS (
              SELECT txn, caller, node AS callee, event_timestamp AS start,
                     event_timestamp + to_milliseconds(coalesce(ms, 0)) AS stop, coalesce(ms, 0) AS ms,
                     row_number() OVER (PARTITION BY txn ORDER BY event_timestamp,
                       time_transaction DESC, id_recurso, endpoint, caller,
                       status_response NULLS LAST) AS hop
              FROM chained)
            SELECT h.txn AS id_transaccion, h.hop, h.caller, h.callee,
                   arg_min(p.hop, (p.ms, -p.hop)) AS parent_hop
            FROM hops h LEFT JOIN hops p ON p.txn = h.txn AND p.callee = h.caller
              AND p.hop < h.hop AND p.start <= h.start AND p.stop >= h.stop
            GROUP BY ALL""",
        "ordered_funnel": f"""{SESSION_SQL}, stepped AS (
              SELECT id_consumer, session, date_trunc('second', event_timestamp) AS t, endpoint,
                     CASE WHEN starts_with(id_consumer, 'external/user-casual-') THEN 'casual'
                          ELSE 'other' END AS kind
              FROM numbered),
            first_step AS (
              SELECT id_consumer, session, any_value(kind) AS kind,
                     count(*) FILTER (endpoint = '/catalog-api/products') AS b,
                     count(*) FILTER (endpoint = '/orders-api/checkout') AS c,
                     count(*) FILTER (endpoint = '/auth-api/validate') AS v,
                     min(t) FILTER (endpoint = '/catalog-api/products') AS t1
              FROM stepped GROUP BY 1, 2),
            second_step AS (
              SELECT f.*, (SELECT min(t) FROM stepped s WHERE s.id_consumer IS NOT DISTINCT FROM f.id_consumer
                AND s.session = f.session AND s.endpoint = '/orders-api/checkout' AND s.t >= f.t1) AS t2
              FROM first_step f),
            visits AS (
              SELECT f.*, (SELECT min(t) FROM stepped s WHERE s.id_consumer IS NOT DISTINCT FROM f.id_consumer
                AND s.session = f.session AND s.endpoint = '/auth-api/validate' AND s.t >= f.t2) AS t3
              FROM second_step f)
            SELECT kind, count(*) AS sessions, count(t1) AS browsing_sessions,
                   count(t2) AS checkout_sessions, count(t3) AS validating_sessions,
                   CAST(sum(b) AS BIGINT) AS browsing_requests,
                   CAST(sum(c) AS BIGINT) AS checkout_requests,
                   CAST(sum(v) AS BIGINT) AS validating_requests,
                   round(count(t2) / nullif(count(t1), 0), 6) AS browsing_to_checkout,
                   round(count(t3) / nullif(count(t2), 0), 6) AS checkout_to_validating
            FROM visits GROUP BY kind""",
        "edge_drift_significance": f"""
            , declared(source, target, probability) AS (VALUES {", ".join(
                f"('{zone}/{app}', '{zone}/{target}', CAST({p} AS DOUBLE))" for zone, app, target, p in DECLARED)}),
            seen AS (SELECT caller AS source, node AS target, count(*) AS requests
                     FROM traces WHERE id_recurso <> '' AND caller <> 'external' GROUP BY 1, 2),
            answered AS (SELECT node AS source, CAST(count(*) AS DOUBLE) AS n
                         FROM traces WHERE id_recurso <> '' GROUP BY 1),
            edges AS (
              SELECT source, target, probability, coalesce(requests, 0) AS requests, n,
                     CASE WHEN probability IS NULL THEN 'undeclared'
                          WHEN requests IS NULL THEN 'missing' ELSE 'matched' END AS status,
                     least(coalesce(requests, 0) / n, 1) AS share,
                     least(coalesce(probability, 0), 1) AS p0, 1.959964 AS z
              FROM declared FULL JOIN seen USING (source, target) LEFT JOIN answered USING (source)),
            scored AS (
              SELECT *, abs(share - p0) / nullif(sqrt(p0 * (1 - p0) / n), 0) AS far,
                     1 / (1 + 0.2316419 * far) AS t
              FROM edges),
            tested AS (
              SELECT *, CASE WHEN n IS NULL THEN NULL WHEN share = p0 THEN 1 WHEN p0 IN (0, 1) THEN 0
                  ELSE least(1, 2 / sqrt(2 * pi()) * exp(-far * far / 2)
                    * (0.319381530 * t - 0.356563782 * t ** 2 + 1.781477937 * t ** 3
                       - 1.821255978 * t ** 4 + 1.330274429 * t ** 5)) END AS p_value
              FROM scored),
            limits AS (
              SELECT max(p_value) AS most FROM tested a
              WHERE p_value <= 0.05 * (SELECT count(*) FROM tested b WHERE b.p_value <= a.p_value)
                                    / (SELECT count(p_value) FROM tested))
            SELECT source, target, status, round(probability, 6) AS probability, requests,
                   round(requests / n, 6) AS observed_share,
                   CASE WHEN n > 0 THEN round(greatest((share + z * z / 2 / n - z * sqrt(share * (1 - share) / n + z * z / 4 / n / n))
                                  / (1 + z * z / n), 0), 6) END AS share_low,
                   CASE WHEN n > 0 THEN round(least((share + z * z / 2 / n + z * sqrt(share * (1 - share) / n + z * z / 4 / n / n))
                               / (1 + z * z / n), 1), 6) END AS share_high,
                   round(p_value, 6) AS p_value, coalesce(p_value <= most, false) AS drifted
            FROM tested, limits""",
        "rolling_stats": """
            SELECT time_bucket(INTERVAL 30 SECOND, event_timestamp) AS window_start,
                   count(*) AS requests,
                   count(*) FILTER (status_response < 300) AS n_2xx,
                   count(*) FILTER (status_response BETWEEN 300 AND 499) AS n_4xx,
                   count(*) FILTER (status_response >= 500) AS n_5xx,
                   count(*) FILTER (status_response IS NULL) AS n_err,
                   round(avg(time_transaction), 6) AS mean_latency,
                   round(100.0 * count(*) FILTER (status_response < 300) / count(*), 6) AS pct_2xx,
                   round(100.0 * count(*) FILTER (status_response BETWEEN 300 AND 499)
                         / count(*), 6) AS pct_4xx,
                   round(100.0 * count(*) FILTER (status_response >= 500) / count(*), 6) AS pct_5xx,
                   round(100.0 * count(*) FILTER (status_response IS NULL) / count(*), 6)
                     AS pct_err
            FROM traces GROUP BY 1""",
    }
    over_traces |= {
        f"rolled_{name}": over_traces[name]
        for name in ("volume_by_minute", "latency_by_minute", "service_edges", "zone_matrix")
    }
    over_traces["rolled_endpoint_summary"] = (
        f'SELECT * EXCLUDE ("Latencia p95", "Latencia p99") FROM ({over_traces["endpoint_summary"]})'
    )
    over_traces |= {
        f"selected_{name}": _selected(over_traces[name], by_endpoint)
        for name, by_endpoint in SELECTED.items()
    }
    return {name: f"{TRACES_SQL} {sql}" for name, sql in over_traces.items()} | {
        "pricing_summary": """
            SELECT l_returnflag, l_linestatus, count(*) AS count_order,
                   round(sum(l_quantity), 6) AS sum_qty, round(avg(l_extendedprice), 6) AS avg_price
            FROM lineitem GROUP BY 1, 2""",
        "top_open_orders": """
            WITH unshipped AS (
              SELECT l_orderkey, sum(l_extendedprice - l_extendedprice * l_discount) AS total
              FROM lineitem WHERE l_shipdate >= DATE '1998-03-16' GROUP BY l_orderkey
            ), builders AS (
              SELECT o_orderkey, o_orderdate, o_orderpriority
              FROM orders SEMI JOIN (FROM customer WHERE c_mktsegment = 'BUILDING')
                ON o_custkey = c_custkey
              WHERE o_orderdate <= DATE '1998-03-14'
            )
            SELECT l_orderkey, round(total, 6) AS revenue, o_orderdate, o_orderpriority
            FROM unshipped JOIN builders ON o_orderkey = l_orderkey
            ORDER BY total DESC, o_orderdate LIMIT 10""",
        "url_parts": """
            SELECT page_id, split_part(url, '?', 1) AS path,
                   CASE WHEN contains(url, '?') THEN split_part(url, '?', 2) END AS query_params
            FROM pages""",
    }
