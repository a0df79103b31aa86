import datetime
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import metrics
from fleetlake.session import scratch
from fleetlake.sources.metrics import BROKERS, LAG, METRIC_SCHEMA, OFFSET, UNDER_REPLICATED, metric_samples

START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


@pytest.fixture
def scraped(spark):
    return lambda rows: spark.createDataFrame(rows, METRIC_SCHEMA)


def offsets(points, topic="t", part=0):
    return [(at(s), OFFSET, topic, part, None, float(v)) for s, v in points]


def rates(df, **options):
    return {(r.topic, r.part, r.window_start): r.rate for r in metrics.counter_rate(df, **options).collect()}


def brute_rates(rows, window=300):
    series = {}
    for ts, _, topic, part, _, value in rows:
        seconds = (ts - START).total_seconds()
        series.setdefault((topic, part, at(seconds // window * window)), []).append((seconds, value))
    found = {}
    for name, points in series.items():
        points.sort()
        grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(points, points[1:]))
        if points[-1][0] > points[0][0]:
            found[name] = grown / (points[-1][0] - points[0][0])
    return found


def test_rate_with_restart_and_single_sample(scraped):
    rows = offsets([(0, 10), (60, 40), (120, 5), (299, 20), (300, 100), (600, 1), (601, 3)])
    found = rates(scraped(rows))
    assert found[("t", 0, at(0))] == pytest.approx((30 + 5 + 15) / 299)
    assert ("t", 0, at(300)) not in found
    assert found[("t", 0, at(600))] == pytest.approx(2.0)


@pytest.mark.parametrize("ranges", ["1", "3", "8", "50"])
def test_rate_is_the_same_for_any_ranges(spark, scraped, ranges):
    pick = random.Random(ranges)
    rows = []
    for part in range(3):
        points = [(s, pick.randrange(1000)) for s in sorted(pick.sample(range(1500), 120))]
        rows += offsets(points, part=part)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rates(scraped(rows)) == pytest.approx(brute_rates(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_burst_within_one_moment_is_split(spark, scraped):
    rows = scraped(offsets([(0, 0)] + [(1, v) for v in range(1, 2001)] + [(2, 2001)]))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "10")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rate = metrics.counter_rate(rows, order=("ts", "value"))
        assert [r.rate for r in rate.collect()] == [2001 / 2]
        ranged = rows.withColumn("window_start", F.window("ts", "5 minutes")["start"]).repartitionByRange("topic", "part", "window_start", "ts", "value")
        assert max(r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()) < 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.enabled")
    with pytest.raises(ValueError):
        metrics.counter_rate(rows, order=("value",))


def test_topic_rate(scraped):
    rows = offsets([(0, 0), (10, 20)], part=0) + offsets([(0, 0), (20, 20)], part=1)
    assert [r.rate for r in metrics.topic_rate(scraped(rows)).collect()] == [3.0]


def test_newest_and_lookback(scraped):
    rows = scraped(offsets([(0, 1), (100, 2), (400, 3)], part=0) + offsets([(0, 7)], part=1))
    newest = {r.part: (r.ts, r.value) for r in metrics.latest_per_series(rows, at(400), "1 hour").collect()}
    assert newest == {0: (at(400), 3.0), 1: (at(0), 7.0)}
    ordered = {r.part: (r.ts, r.value) for r in metrics.latest_per_series(rows, at(400), "1 hour", order=["ts", "value"]).collect()}
    assert ordered == newest
    instant = metrics.latest_per_series(rows, at(399))
    assert [(r.part, r.value) for r in instant.collect()] == [(0, 2.0)]


def test_sums_and_alerts(scraped):
    lag = [(at(0), LAG, t, p, g, v) for t, p, g, v in [("a", 0, "g0", 9000.0), ("a", 1, "g0", 500.0), ("b", 0, "g0", 500.0), ("b", 0, "g1", 9.0)]]
    old = [(at(-60), LAG, "a", 0, "g0", 1.0)]
    under = [(at(0), UNDER_REPLICATED, t, 0, None, v) for t, v in [("a", 1.0), ("b", 0.0)]]
    broker = [(at(0), BROKERS, None, None, None, 3.0)]
    rows = scraped(lag + old + under + broker)
    assert {r.consumergroup: r.total for r in metrics.lag_by_group(rows, as_of=at(1)).collect()} == {"g0": 10000.0, "g1": 9.0}
    by_topic = {(r.consumergroup, r.topic): r.total for r in metrics.lag_by_group_topic(rows, as_of=at(1)).collect()}
    assert by_topic == {("g0", "a"): 9500.0, ("g0", "b"): 500.0, ("g1", "b"): 9.0}
    assert {r.topic: r.total for r in metrics.under_replicated(rows, as_of=at(1)).collect()} == {"a": 1.0, "b": 0.0}
    assert [r.value for r in metrics.latest_gauges(rows, [BROKERS], at(1)).collect()] == [3.0]
    rules = [
        ("lag", LAG, "consumergroup", lambda total: total >= 10000),
        ("any lag", LAG, "consumergroup", lambda total: total >= 5),
        ("under_replicated", UNDER_REPLICATED, "topic", lambda total: total > 0),
    ]
    fired = sorted(tuple(r) for r in metrics.alert_rows(rows, rules, at(1)).collect())
    assert fired == [("any lag", "g0", 10000.0), ("any lag", "g1", 9.0), ("lag", "g0", 10000.0), ("under_replicated", "a", 1.0)]
    assert metrics.alert_rows(rows, rules, at(86400)).isEmpty()  # dead series raise no alert


def test_stored_samples(spark, scraped):
    path = scratch(spark, "metrics")
    scraped(offsets([(0, 1)]) + [(at(0), BROKERS, None, None, None, 3.0)]).write.parquet(path)
    assert metric_samples(spark, path).count() == 2
    assert [r.value for r in metric_samples(spark, path, [BROKERS]).collect()] == [3.0]
