"""The plans that make the operators hold at scale."""

import __spark_entry__ as entry
from fleetlake.operators.merge import KeyProfile, new_rows, not_in_target
from fleetlake.session import scratch
from fleetlake.sinks.table import KeyedTable

SF = "/root/testdata/sf0.001"


def plan(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_first_wins_limits_each_key_before_the_shuffle(spark):
    text = plan(entry.queries()["dedup_first_wins"](spark, SF))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_table_filters_reach_the_scan(spark):
    text = plan(entry.queries()["scan_table_pushdown"](spark, SF))
    assert "EqualTo(usage,train)" in text
    scanned = next(line for line in text.splitlines() if "ReadSchema" in line and "col_0" in line)
    assert "col_1:" not in scanned


def test_search_is_bounded_and_shuffles_only_small_sides(spark, samples):
    table = KeyedTable(spark, scratch(spark, "table")).ensure()
    table.append(samples([("m", str(i), "train", i, 0.0) for i in range(50)]))
    fresh = samples([("m", str(i), "train", i, 1.0) for i in range(45, 60)])
    small = plan(new_rows(fresh, table.read(), profile=KeyProfile(fresh)))
    assert "GreaterThanOrEqual(timestamp,45)" in small and "LessThanOrEqual(timestamp,59)" in small
    assert "Exchange hashpartitioning" not in small and "Exchange\n" not in small.replace("BroadcastExchange", "")
    scanned = next(line for line in small.splitlines() if "ReadSchema" in line)
    assert "col_0" not in scanned


def test_conflicts_count_before_the_shuffle(spark):
    text = plan(entry.queries()["sink_insert_strict_conflicts"](spark, SF))
    assert "partial_sum" in text and "Join" not in text


def test_newest_values_scan_only_the_look_back(spark):
    text = plan(entry.queries()["lag_by_group"](spark, SF))
    assert "GreaterThan(ts," in text and "LessThanOrEqual(ts," in text


def test_a_hot_key_is_split_in_a_conflict_join(spark, samples):
    table = KeyedTable(spark, scratch(spark, "table")).ensure()
    table.append(samples([("m", str(i), "train", i, 0.0) for i in range(0, 400, 2)]))
    incoming = spark.range(0, 44000, 1, 8).selectExpr(
        "'m' AS machine", "if(id < 40000, '7', string(id % 400)) AS timestamp", "'train' AS usage", "uuid() AS text"
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    before = {name: spark.conf.get(name) for name in small}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        left = not_in_target(incoming, table.read()).select("timestamp", "text")
        assert len(left.collect()) == 2000 + 40000
        assert "skew=true" in spark._jvm.PythonSQLUtils.explainString(left._jdf.queryExecution(), "simple")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _events(spark, n):
    from fleetlake.session import scratch

    base = scratch(spark, "tables")
    spark.range(n).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", "id % 7 AS user_id",
        "element_at(array('error', 'view', 'click', 'purchase', 'signup'), int(id % 5) + 1) AS event_type", "0.5D AS value", "'{\"k\": 1}' AS props",
    ).write.parquet(f"{base}/events.parquet")
    spark.createDataFrame([(1, "prose")], "doc_id long, text string").write.parquet(f"{base}/documents.parquet")
    return base


def test_chunk_files_grow_in_number_not_in_size(spark, monkeypatch):
    """Before, a topic of any size was written as eight files, each by one task."""
    from fleetlake.plans import queries
    from fleetlake.sources.topic import FileTopic

    asked, write, group = [], FileTopic.write, FileTopic.read_group
    monkeypatch.setattr(FileTopic, "write", lambda self, df, files=None: asked.append(files) or write(self, df, files))
    monkeypatch.setattr(FileTopic, "read_group", lambda self, max_files=None: asked.append(max_files) or group(self, max_files))
    base = _events(spark, 70)
    assert queries.stream_merge_chunked(spark, base).count() == 14
    monkeypatch.setattr(queries, "MANY", 30)
    assert queries.stream_merge_chunked(spark, base).count() == 14
    assert asked == [8, 2, 24, 6]


def test_damaged_messages_are_encoded_once(spark):
    """Before, a text that loses its last character was encoded twice, the second time for its length."""
    from fleetlake.plans import adapter

    frame = adapter.damaged_messages(spark, _events(spark, 5))
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("StructsToJsonEvaluator") == 5
    found = {row.offset: row.value.decode() for row in frame.collect()}
    assert found[-2] == '{"machine":"machine-1","label":1}' and found[-1] == '{"machine":"machine-0","timestamp":123}'
    assert found[-3].startswith('{"send_timestamp":') and found[-3].count("}") == 0
