import json
import math

import pytest

from fleetlake.functions.decode import CORRUPT, decode_lenient, decode_strict, parse_send_timestamp
from fleetlake.schema import COLUMNS, FEATURES, MESSAGE_SCHEMA

FULL = json.dumps(
    {"send_timestamp": "2024-01-01T00:00:00.000001", "machine": "machine-1-1", "timestamp": "7", "usage": "train",
     "label": 1, **{name: i / 3 for i, name in enumerate(FEATURES)}, "unknown": [1]}
)


def strict(messages, payload):
    return decode_strict(messages([payload]), corrupt=True).first()


def lenient(messages, payload):
    return decode_lenient(messages([payload])).first()


def test_strict_takes_all_fields(messages):
    row = strict(messages, FULL)
    assert (row.machine, row.timestamp, row.usage, row.label) == ("machine-1-1", "7", "train", 1.0)
    assert [row[name] for name in FEATURES] == [i / 3 for i in range(38)]
    assert decode_strict(messages([FULL])).columns == COLUMNS == MESSAGE_SCHEMA.names


@pytest.mark.parametrize("payload", ["not json", "null", "[]", '{"a":1', "12", '[{"machine":"m"}]'])
def test_strict_no_object(messages, payload):
    row = strict(messages, payload)
    assert all(row[name] is None for name in COLUMNS)
    assert row[CORRUPT] == payload


@pytest.mark.parametrize("payload", ["", None])
def test_strict_no_payload(messages, payload):
    assert all(value is None for value in strict(messages, payload))


def test_strict_mistyped_fields(messages):
    row = strict(messages, '{"machine":"m","label":"x","col_0":0.25}')
    assert (row.machine, row.label, row.col_0) == ("m", None, 0.25) and row[CORRUPT]
    row = strict(messages, '{"timestamp":123,"machine":"m","label":"1.0","col_0":NaN}')
    assert (row.timestamp, row.label) == ("123", None) and math.isnan(row.col_0)


def test_strict_carries_envelope_columns(messages):
    rows = decode_strict(messages([FULL, "x"]), keep=["partition", "offset"]).collect()
    assert [(row.partition, row.offset) for row in rows] == [(0, 0), (0, 1)]


@pytest.mark.parametrize(
    "label, kept",
    [
        ("1", 1), ("0", 0), ("1.9", 1), ("-1.9", -1), ("1e3", 1000), ("true", 1), ("false", 0),
        ('"1"', 1), ('" 2 "', 2), ('"+3"', 3), ('"1.0"', None), ('"x"', None), ('""', None), ('"NaN"', None),
        ("null", None), ("NaN", None), ("Infinity", None), ("-Infinity", None), ("[1]", None), ('{"a":1}', None),
        ("3000000000", None),
    ],
)
def test_lenient_label(messages, label, kept):
    row = lenient(messages, f'{{"machine":"m","label":{label}}}')
    assert (row and row.label) == kept
    row = lenient(messages, f'{{"machine":"m","col_3":"2.5","label":{label}}}')
    assert (row and (row.label, row.col_3)) == (None if kept is None else (kept, 2.5))


def test_lenient_label_absent(messages):
    assert lenient(messages, '{"machine":"m"}').label == 0
    row = lenient(messages, "{}")
    assert row.label == 0 and row.machine is None


@pytest.mark.parametrize(
    "payload",
    [
        "", None, "null", "[]", "12", '"x"', "not json", '{"a":1', "{'machine':'m'}", '[{"machine":"m"}]',
        '{"machine":"m"} more', '{"machine":"m"}{"machine":"n"}', '{"machine":"m"},{"machine":"n"}', '{"machine":"m"}]',
        '{"machine":"m"},', b'{"machine":"\xff"}',
    ],
)
def test_lenient_drops(messages, payload):
    assert lenient(messages, payload) is None


def test_lenient_fields(messages):
    row = lenient(messages, ' {"machine":"a","machine":"b","timestamp":5,"col_0":"0.5","col_1":NaN,"col_2":"x","col_9":1}\n')
    assert (row.machine, row.timestamp, row.col_0, row.col_2, row.col_9, row.col_3) == ("b", "5", 0.5, None, 1.0, None)
    assert math.isnan(row.col_1)


def test_send_time(spark):
    rows = spark.createDataFrame([("2024-01-01T00:00:00.000001",), ("garbage",), (None,)], "send_timestamp string")
    found = [row[0] for row in parse_send_timestamp(rows).selectExpr("unix_micros(send_timestamp)").collect()]
    assert found == [1704067200000001, None, None]


def test_send_time_follows_session_zone(spark):
    rows = spark.createDataFrame([("2024-01-01T09:00:00",)], "send_timestamp string")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        assert parse_send_timestamp(rows).selectExpr("unix_seconds(send_timestamp)").first()[0] == 1704067200
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
