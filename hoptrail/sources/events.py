"""Click events seen as traces, for installations without a proxy log.

Each event becomes one request: its type gives endpoint and service, its user
the zone and the caller, its property `k` the sizes and the kind of failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoptrail.functions.callers import CALLER_COLUMNS
from hoptrail.schema import TRACE_COLUMNS

FACTS = (
    "CAST(event_id AS STRING) AS id_transaccion",
    "CAST(ts AS TIMESTAMP) AS event_timestamp",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "floor(value) AS time_transaction",
    "event_type",
    "user_id",
    "concat('zone', user_id % 3 + 1) AS zona",
)

TRACE = (
    "date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ssZ\") AS date_transaction",
    """CASE event_type WHEN 'view' THEN '/catalog-api/products'
        WHEN 'click' THEN '/catalog-api/products'
        WHEN 'purchase' THEN '/orders-api/checkout'
        WHEN 'signup' THEN '/auth-api/validate'
        WHEN 'error' THEN '/payments-api/checkout' END AS endpoint""",
    """CASE user_id % 5 WHEN 1 THEN '-'
        WHEN 2 THEN concat('external/user-casual-', user_id)
        WHEN 3 THEN concat(zona, '/orders-api-1')
        WHEN 4 THEN 'catalog-api-1' END AS id_consumer""",
    """CASE event_type WHEN 'purchase' THEN 'orders-api-1'
        WHEN 'signup' THEN 'auth-api-1'
        WHEN 'error' THEN 'payments-api-1'
        ELSE 'catalog-api-1' END AS id_recurso""",
    "id_transaccion",
    "CAST(NULL AS STRING) AS ip_consumer",
    "CAST(NULL AS STRING) AS ip_transaccion",
    "CAST(k AS BIGINT) AS req_body_size",
    "CAST(k * 7 AS BIGINT) AS resp_body_size",
    """CASE WHEN event_type <> 'error' THEN 200 WHEN k < 50 THEN 500
        ELSE 404 END AS status_response""",
    "time_transaction",
    "'GET' AS tipo_operacion",
    "CAST(NULL AS STRING) AS query_params",
    "event_timestamp",
    "zona",
    "year(event_timestamp) AS year",
    "month(event_timestamp) AS month",
    "day(event_timestamp) AS day",
    "hour(event_timestamp) AS hour",
)


def as_traces(events: DataFrame) -> DataFrame:
    consumer = F.col("id_consumer")
    return (
        events.selectExpr(*FACTS)
        .selectExpr(*TRACE)
        .withColumns({name: rule(consumer) for name, rule in CALLER_COLUMNS.items()})
        .select(*TRACE_COLUMNS)
    )
