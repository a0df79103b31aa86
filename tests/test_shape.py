import datetime
import json

import pytest
from pyspark.sql import functions as F

from fleetlake.functions import shape
from fleetlake.functions.catalog import catalog_stats, feature_catalog
from fleetlake.operators import counts, filters
from fleetlake.schema import COLUMNS, FEATURE_NAMES, FEATURES, GROUPS, KEY, TABLE_SCHEMA, TIERS
from fleetlake.sinks.export import preview
from fleetlake.sinks.topic import envelope


def test_dictionary_is_complete():
    assert len(FEATURE_NAMES) == len(set(FEATURE_NAMES)) == 38
    grouped = [name for _, names in GROUPS.values() for name in names]
    assert len(grouped) == len(set(grouped)) == 33 and set(grouped) <= set(FEATURE_NAMES)
    assert set(FEATURE_NAMES) - set(grouped) == set(FEATURE_NAMES[26:31])
    assert {name for _, names in TIERS.values() for name in names} <= set(FEATURE_NAMES)


def test_conform(spark):
    rows = spark.createDataFrame([("x", 1.9, "m", "0.5", "7")], "other string, label double, machine string, col_1 string, timestamp string")
    fixed = shape.conform(rows)
    assert fixed.schema.names == COLUMNS == TABLE_SCHEMA.names
    assert [f.dataType for f in fixed.schema] == [f.dataType for f in TABLE_SCHEMA]
    row = fixed.first()
    assert (row.label, row.machine, row.timestamp, row.col_1, row.col_0, row.usage) == (1, "m", "7", 0.5, None, None)


@pytest.mark.parametrize(
    "text, kind, num",
    [
        ("5", "int", 5.0), (" +5 ", "int", 5.0), ("-7", "int", -7.0), ("1.5", "float", 1.5), ("1e5", "float", 1e5),
        (".5", "float", 0.5), ("2.", "float", 2.0), ("view", "string", None), ("click", "string", None),
        ("", "string", None), ("1.2.3", "string", None), ("0x1", "string", None), ("1_0", "string", None), (None, None, None),
    ],
)
def test_sniff(spark, text, kind, num):
    row = shape.sniff_number(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.kind, row.num) == (kind, num)


def test_parse_fields_keeps_unknown_columns(spark):
    rows = spark.createDataFrame([("m", "01", "1", "2.5", "bad", "z", "q")], "machine string, timestamp string, label string, col_0 string, col_1 string, lab string, other string")
    row = shape.parse_fields(rows).first()
    assert row.asDict() == {"machine": "m", "timestamp": "01", "label": 1, "col_0": 2.5, "col_1": None, "lab": "z", "other": "q"}


def test_to_str_drops_bad_bytes(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xffb"),)], "b binary")
    assert rows.select(shape.to_str("b")).first()[0] == "ab"


def test_tag_stamp_encode(spark, samples):
    rows = shape.tag_split(samples([("machine-1", "7", "x", 3, 0.1)]).withColumn("label", F.lit(1)), "train")
    rows = shape.stamp_send_time(shape.conform(rows.drop("send_timestamp")), "2024-02-01 12:00:00.25")
    row = shape.encode_json(rows).first()
    assert bytes(row.key) == b"machine-1-train"
    body = json.loads(bytes(row.value))
    assert list(body) == COLUMNS
    assert body["send_timestamp"] == "2024-02-01T12:00:00.250000" and body["label"] == 0 and body["col_0"] == 0.1
    assert body["col_1"] is None
    test = shape.tag_split(rows, "test")
    assert test.schema["label"] == rows.schema["label"]


def test_stamp_now_is_iso_text(spark):
    text = shape.stamp_send_time(spark.range(1)).first().send_timestamp
    datetime.datetime.strptime(text, "%Y-%m-%dT%H:%M:%S.%f")


def test_envelope_keeps_a_key_in_one_partition(spark, samples):
    rows = samples([(f"machine-{i % 9}", str(i), "train" if i % 2 else "test", i, 0.0) for i in range(200)])
    sent = envelope(shape.conform(rows, keep=["offset"]), partitions=5, offset="offset")
    assert sent.groupBy("key").agg(F.count_distinct("partition").alias("n")).filter("n > 1").isEmpty()
    assert sent.filter("partition < 0 or partition >= 5").isEmpty()


def test_names_groups_and_fill(spark):
    rows = spark.createDataFrame([tuple([None, float("nan")] + [float(i) for i in range(2, 38)])], ", ".join(f"{n} double" for n in FEATURES))
    assert shape.rename_features(rows).columns == FEATURE_NAMES
    assert shape.select_group(rows, "memory", keep=[]).columns == ["col_4", "col_5", "col_6", "col_7", "col_16", "col_17"]
    assert shape.select_prefix(rows.withColumn("x", F.lit(1))).columns == FEATURES
    assert list(shape.fill_missing(rows).first())[:3] == [0.0, 0.0, 2.0]


def test_catalog(spark):
    rows = {row.feature: row for row in feature_catalog(spark).collect()}
    assert len(rows) == 38 and rows["si"].column == "col_16" and rows["si"].tier == 2 and rows["si"].influence == "high"
    assert rows["in_errs"].feature_group is None
    one = spark.createDataFrame([tuple([1.0] * 38)] * 3, ", ".join(f"{n} double" for n in FEATURES))
    stats = catalog_stats(one).collect()
    assert sum(row.n for row in stats) == 38 * 3 and {row["mean"] for row in stats} == {1.0}


def test_recent_boundary(spark):
    texts = ["2024-01-08T00:00:00.000000", "2024-01-07T23:59:59.999999", "2024-01-09", "bad", None]
    rows = spark.createDataFrame([(t,) for t in texts], "send_timestamp string")
    kept = [row[0] for row in filters.recent(rows, datetime.datetime(2024, 1, 15), 7).collect()]
    assert kept == [texts[0], texts[2]]
    typed = rows.withColumn("send_timestamp", F.try_to_timestamp("send_timestamp"))
    assert filters.recent(typed, "2024-01-15 00:00:00", 7).count() == 2
    assert filters.recent(typed, F.lit("2024-01-15").cast("timestamp"), 7).count() == 2


def test_split_valid(spark):
    rows = spark.createDataFrame([("m", "1", "train"), (None, "1", "test"), ("m", None, None)], "machine string, timestamp string, usage string")
    valid, bad = filters.split_valid(rows)
    assert valid.count() == 1
    assert sorted(row.reason for row in bad.collect()) == ["machine", "timestamp,usage"]


def test_guard_match_preview_counts(spark):
    rows = spark.createDataFrame([("m", str(i), "train" if i < 3 else "test") for i in range(6)] * 2, "machine string, timestamp string, usage string")
    assert filters.guard_empty(rows.filter("usage = 'none'")) and not filters.guard_empty(rows)
    assert filters.match_labels(rows, {"usage": "test"}, {"timestamp": "4|55"}).count() == 2
    assert [row.timestamp for row in preview(rows, 3, KEY).collect()] == ["0", "0", "1"]
    found = counts.stage_counts(rows, {"loaded": None, "train": F.col("usage") == "train"}).collect()
    assert [tuple(row) for row in found] == [("loaded", 12), ("train", 6), ("distinct_keys", 3)]
    assert counts.throughput(10, 4) == 2.5
    watched, seen = counts.counted(rows)
    assert len(watched.collect()) == seen.get["rows"] == 12
