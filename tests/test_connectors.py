"""What is handed to Spark's broker and database connectors; no broker or database runs here."""

import datetime

import pytest

from fleetlake.session import object_store_conf
from fleetlake.sinks.table import JdbcTable
from fleetlake.sources.jdbc import day_predicates, read_table_query
from fleetlake.sources.topic import BrokerTopic


def test_broker_options(spark):
    topic = BrokerTopic(spark, "h1:9092,h2:9092", "samples", minPartitions="64")
    assert topic.batch_options() == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092", "minPartitions": "64", "subscribe": "samples",
        "startingOffsets": "earliest", "endingOffsets": "latest",
    }
    assert topic.stream_options()["startingOffsets"] == "latest"
    assert topic.stream_options("earliest", 100)["maxOffsetsPerTrigger"] == "100"
    assert topic.write_options()["kafka.acks"] == "all" and topic.write_options()["topic"] == "samples"


def test_database_statements(spark):
    table = JdbcTable(spark, "jdbc:postgresql://h/db", "lake", user="u")
    created = table.create_sql()
    assert created.startswith("CREATE TABLE IF NOT EXISTS lake (send_timestamp TIMESTAMPTZ, machine TEXT, timestamp TEXT, usage TEXT, label INT, col_0 FLOAT,")
    assert created.endswith("col_37 FLOAT, PRIMARY KEY (machine, timestamp, usage))")
    merged = table.merge_sql("lake_staging_7")
    assert merged.startswith("INSERT INTO lake (send_timestamp, machine,") and " FROM lake_staging_7 " in merged
    assert merged.endswith("ON CONFLICT (machine, timestamp, usage) DO NOTHING")
    assert table.options["batchsize"] == "500"
    assert table.staging_sql("s") == ["CREATE TABLE IF NOT EXISTS s (LIKE lake)", "TRUNCATE s"]


def test_day_predicates_cover_everything_once():
    found = day_predicates("d", datetime.date(2024, 1, 1), 2)
    assert found == [
        "d < '2024-01-01' OR d IS NULL",
        "d >= '2024-01-01' AND d < '2024-01-02'",
        "d >= '2024-01-02' AND d < '2024-01-03'",
        "d >= '2024-01-03'",
    ]


def test_object_store_settings():
    names = {name.replace("__", "."): value for name, value in object_store_conf("k", "s", "e").items()}
    assert names == {"spark.hadoop.fs.s3a.access.key": "k", "spark.hadoop.fs.s3a.secret.key": "s", "spark.hadoop.fs.s3a.endpoint": "e"}


def test_query_on_a_file_table(spark, samples):
    from fleetlake.session import scratch
    from fleetlake.sinks.table import KeyedTable

    table = KeyedTable(spark, scratch(spark, "table")).ensure()
    table.append(samples([("m", "1", "train", 1, 1.0), ("m", "2", "test", 2, 2.0)]))
    assert [r.col_0 for r in read_table_query(table, "SELECT col_0 FROM {samples} WHERE usage = 'test'").collect()] == [2.0]


def test_database_merge_goes_through_staging(spark, samples, monkeypatch):
    done = []

    def append(self, rows, table):
        done.append((table, sorted((r.machine, r.timestamp, r.col_0) for r in rows.collect())))

    monkeypatch.setattr(JdbcTable, "_execute", lambda self, *statements: done.extend(statements))
    monkeypatch.setattr(JdbcTable, "_append", append)
    table = JdbcTable(spark, "jdbc:postgresql://h/db", "lake")
    rows = samples([("m", "1", "train", 5, 5.0), ("m", "1", "train", 2, 2.0)])
    table.insert_if_absent(rows, 7, writer="a-b")
    staging = done[2][0]
    assert staging.startswith("lake_staging_")
    assert done == [*table.staging_sql(staging), (staging, [("m", "1", 2.0)]), table.merge_sql(staging), f"DROP TABLE IF EXISTS {staging}"]
    table.insert_strict(rows)
    assert done[7][0] != staging and done[8] == table.copy_sql(done[7][0])


def test_staging_is_dropped_after_a_failure(spark, samples, monkeypatch):
    done = []

    def fail(self, rows, table):
        raise OSError("lost")

    monkeypatch.setattr(JdbcTable, "_execute", lambda self, *statements: done.extend(statements))
    monkeypatch.setattr(JdbcTable, "_append", fail)
    with pytest.raises(OSError):
        JdbcTable(spark, "jdbc:postgresql://h/db", "lake").insert_if_absent(samples([("m", "1", "train", 5, 5.0)]))
    assert done[-1].startswith("DROP TABLE IF EXISTS lake_staging_")
