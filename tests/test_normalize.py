import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hoptrail.functions.callers import person_kind
from hoptrail.functions.traces import iso_time, service_name
from hoptrail.plans.normalize import normalize_messages, split_unreadable
from hoptrail.schema import TRACE_COLUMNS

RECORD = {
    "date_transaction": "2024-03-05T07:08:09+0000",
    "endpoint": "/catalog-api/products?page=2&q=x",
    "id_consumer": "zone1/orders-api-12",
    "id_recurso": "catalog-api-1",
    "id_transaccion": "t1",
    "ip_consumer": "10.0.0.1:80",
    "ip_transaccion": "10.0.0.2:80",
    "req_body_size": 10,
    "resp_body_size": 20,
    "status_response": 200,
    "time_transaction": 30,
    "tipo_operacion": "GET",
}


def message(**changes):
    record = {k: v for k, v in {**RECORD, **changes}.items() if v is not ...}
    return json.dumps({"@timestamp": 1709622489.5, "log": json.dumps(record)})


def frame(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf8"),) for t in texts], "value binary")


def one(spark, **changes):
    return normalize_messages(frame(spark, message(**changes)), "zone7").first()


def test_a_whole_record(spark):
    row = one(spark)
    assert row.asDict() == {
        **RECORD,
        "endpoint": "/catalog-api/products",
        "query_params": "page=2&q=x",
        "event_timestamp": datetime(2024, 3, 5, 7, 8, 9),
        "consumer_type": "internal",
        "source_zone": "zone1",
        "source_service": "orders-api",
        "zona": "zone7",
        "year": 2024,
        "month": 3,
        "day": 5,
        "hour": 7,
    }
    assert list(row.asDict()) == TRACE_COLUMNS


@pytest.mark.parametrize(
    "consumer, expected",
    [
        (None, ("external", "unknown", "unknown")),
        ("-", ("external", "unknown", "unknown")),
        ("zone1/orders-api-1", ("internal", "zone1", "orders-api")),
        ("zone1/orders-api", ("internal", "zone1", "orders-api")),
        ("zone1/a/b-3", ("internal", "zone1", "a/b")),
        ("external/user-casual-a1b2c3d4", ("external", "external", "user-casual-a1b2c3d4")),
        ("external/user-casual-12345678", ("external", "external", "user-casual")),
        ("catalog-api-1", ("internal", "unknown", "catalog-api")),
        ("user-casual-a1b2c3d4", ("internal", "unknown", "user-casual-a1b2c3d4")),
        ("zone1/", ("internal", "zone1", "")),
        ("/orders-api-1", ("internal", "", "")),
        ("", ("internal", "unknown", "")),
    ],
)
def test_callers(spark, consumer, expected):
    row = one(spark, id_consumer=consumer)
    assert (row.consumer_type, row.source_zone, row.source_service) == expected


@pytest.mark.parametrize(
    "url, path, query",
    [
        ("/a?x=1?y=2", "/a", "x=1"),
        ("/a", "/a", None),
        ("/a?", "/a", ""),
        ("?x", "", "x"),
        (None, None, None),
    ],
)
def test_url_parts(spark, url, path, query):
    row = one(spark, endpoint=url)
    assert (row.endpoint, row.query_params) == (path, query)


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2024-03-05T23:30:00-0200", datetime(2024, 3, 6, 1, 30)),
        ("2024-03-05T07:08:09+02:00", None),
        ("yesterday", None),
        (None, None),
    ],
)
def test_start_times(spark, text, parsed):
    row = one(spark, date_transaction=text)
    assert row.event_timestamp == parsed
    assert row.day == (parsed.day if parsed else None)


def test_unreadable_messages_are_kept_as_empty_traces(spark):
    texts = ["not json", json.dumps({"log": "{broken"}), json.dumps({"other": 1})]
    traces = normalize_messages(frame(spark, *texts), "zone7").collect()
    assert len(traces) == 3
    for row in traces:
        assert (row.consumer_type, row.source_zone, row.source_service) == (
            "external", "unknown", "unknown",
        )
        assert row.zona == "zone7" and row.year is None and row.endpoint is None


def test_a_quoted_number_stays_null_and_spares_the_rest(spark):
    row = one(spark, status_response="200", time_transaction=...)
    assert row.status_response is None and row.time_transaction is None
    assert row.endpoint == "/catalog-api/products"


def test_quarantine_splits_without_loss(spark):
    texts = [message(), "not json", message(date_transaction="never")]
    good, bad = split_unreadable(frame(spark, *texts), "zone7")
    assert good.count() == 1
    assert sorted(row.value for row in bad.collect()) == sorted(texts[1:])


def test_small_functions(spark):
    values = spark.createDataFrame(
        [("catalog-api-1", "external/user-power-1f", datetime(2024, 1, 1, 2, 3, 4)),
         ("X-api", "user-window-9", datetime(2024, 1, 1, 2, 3, 4, 50)),
         (None, "zone1/a-b-1", None)],
        "r string, c string, t timestamp",
    )
    got = values.select(
        service_name(F.col("r")).alias("s"), person_kind(F.col("c")).alias("k"), iso_time(F.col("t")).alias("t")
    ).collect()
    assert [tuple(r) for r in got] == [
        ("catalog-api", "power", "2024-01-01T02:03:04"),
        (None, "window", "2024-01-01T02:03:04.000050"),
        (None, None, None),
    ]
