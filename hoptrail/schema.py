"""Column layouts of the data the engine reads and writes, as Spark DDL text."""

# Names and types of the proxy's access-log record.
RECORD_DDL = (
    "date_transaction string, endpoint string, id_consumer string, id_recurso string, "
    "id_transaccion string, ip_consumer string, ip_transaccion string, "
    "req_body_size bigint, resp_body_size bigint, status_response int, "
    "time_transaction bigint, tipo_operacion string"
)

# The log shipper's envelope; `log` holds the record as JSON text.
ENVELOPE_DDL = "`@timestamp` string, log string"

# Columns derived at ingest and the partition columns, in path order.
DERIVED_DDL = (
    "query_params string, event_timestamp timestamp, "
    "consumer_type string, source_zone string, source_service string"
)
PARTITION_DDL = "zona string, year int, month int, day int, hour int"

TRACE_DDL = f"{RECORD_DDL}, {DERIVED_DDL}, {PARTITION_DDL}"

# A topology manifest, one JSON document per zone.
MANIFEST_DDL = (
    "apps array<struct<name: string, scenario: string, "
    "downstream_calls: array<struct<target: string, path: string, probability: double>>>>"
)


def _names(ddl):
    return [field.split()[0] for field in ddl.split(", ")]


RECORD_COLUMNS = _names(RECORD_DDL)
PARTITION_COLUMNS = _names(PARTITION_DDL)
DATA_COLUMNS = RECORD_COLUMNS + _names(DERIVED_DDL)
TRACE_COLUMNS = DATA_COLUMNS + PARTITION_COLUMNS
