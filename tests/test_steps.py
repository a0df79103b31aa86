"""Metric queries over a grid of steps, against brute force."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import steps
from fleetlake.sources.metrics import LAG, METRIC_SCHEMA, OFFSET, UNDER_REPLICATED
from tests.test_metrics import START, at, offsets, scraped  # noqa: F401


def moments(end, step):
    return [at(s) for s in range(0, end + 1, step)]


def brute_rates(rows, end, step, window):
    found = {}
    for moment in moments(end, step):
        series = {}
        for ts, _, topic, part, _, value in rows:
            if moment - datetime.timedelta(seconds=window) < ts <= moment:
                series.setdefault((topic, part), []).append((ts, value))
        for name, points in series.items():
            points.sort(key=lambda p: p[0])
            grown = sum(b - a if b >= a else b for (_, a), (_, b) in zip(points, points[1:]))
            seconds = (points[-1][0] - points[0][0]).total_seconds()
            if seconds > 0:
                found[(*name, moment)] = pytest.approx(grown / seconds)
    return found


def rates(df, end, step, window):
    grid = steps.Grid(START, at(end), f"{step} seconds")
    return {(r.topic, r.part, r.step): r.rate for r in steps.counter_rate_steps(df, grid, window=f"{window} seconds").collect()}


@pytest.mark.parametrize("ranges", ["1", "4", "40"])
def test_sliding_rates_equal_brute_force(spark, scraped, ranges):  # noqa: F811
    pick = random.Random(ranges)
    rows = []
    for part in range(3):
        rows += offsets([(s, pick.randrange(1000)) for s in sorted(pick.sample(range(-500, 1700), 90))], part=part)
    rows += offsets([(600 + i / 1000, (7 * i) % 50) for i in range(400)], topic="burst")  # most samples within half a second
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        for step, window in ((60, 300), (45, 20), (300, 60)):
            assert rates(scraped(rows), 1500, step, window) == brute_rates(rows, 1500, step, window)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_rate_of_restarts_stale_and_single_samples(scraped):  # noqa: F811
    rows = offsets([(-10, 7), (0, 10), (60, 40), (120, 5), (180, 5), (900, 1), (900, 3)])
    found = rates(scraped(rows), 1200, 60, 300)
    assert found["t", 0, at(0)] == pytest.approx(0.3) and found["t", 0, at(120)] == pytest.approx((3 + 30 + 5) / 130)
    assert found["t", 0, at(300)] == pytest.approx(5 / 120)  # after 0: the samples of 60, 120 and 180
    assert ("t", 0, at(420)) not in found and ("t", 0, at(600)) not in found and ("t", 0, at(900)) not in found
    assert rates(scraped(rows).limit(0), 1200, 60, 300) == {}


def test_newest_values_equal_brute_force_and_end_on_time(spark, scraped):  # noqa: F811
    pick = random.Random(5)
    rows = [(at(s), LAG, pick.choice("ab"), pick.randrange(2), pick.choice(["g", None]), float(s)) for s in pick.sample(range(-900, 3000), 150)]
    grid = steps.Grid(START, at(2400), "100 seconds")
    found = {(r.topic, r.part, r.consumergroup, r.step): (r.ts, r.value) for r in steps.latest_steps(scraped(rows), grid, "250 seconds").collect()}
    wanted = {}
    for moment in moments(2400, 100):
        for ts, _, topic, part, group, value in sorted(rows):
            if moment - datetime.timedelta(seconds=250) < ts <= moment:
                wanted[topic, part, group, moment] = (ts, value)
    assert found == wanted
    one = scraped([(at(100), LAG, "t", 0, "g", 1.0)])
    assert [r.step for r in steps.latest_steps(one, steps.Grid(START, at(600), "50 seconds"), "150 seconds").orderBy("step").collect()] == [at(100), at(150), at(200)]


def test_ties_are_told_apart_by_further_columns(spark, scraped):  # noqa: F811
    rows = scraped([(at(10), LAG, "t", 0, "g", v) for v in (5.0, 9.0, 7.0)]).withColumn("n", F.col("value"))
    found = steps.latest_steps(rows, steps.Grid(START, at(60), "30 seconds"), order=["ts", "n"]).collect()
    assert [(r.step, r.value) for r in found] == [(at(30), 9.0), (at(60), 9.0)] or {r.value for r in found} == {9.0}
    with pytest.raises(ValueError):
        steps.latest_steps(rows, steps.Grid(START, at(60)), order=["n"])


def test_alerts_at_each_step(scraped):  # noqa: F811
    rows = [(at(0), LAG, "a", 0, "g", 6000.0), (at(0), LAG, "b", 0, "g", 5000.0), (at(90), LAG, "b", 0, "g", 1.0), (at(60), UNDER_REPLICATED, "a", 0, None, 2.0)]
    rules = [("lag", LAG, "consumergroup", lambda total: total >= 10000), ("some lag", LAG, "consumergroup", lambda total: total > 0), ("replicas", UNDER_REPLICATED, "topic", lambda total: total > 0)]
    found = steps.alert_steps(scraped(rows), rules, steps.Grid(START, at(180), "60 seconds"), lookback="100 seconds").collect()
    assert sorted((r.rule, r.name, (r.step - START).seconds, r.total) for r in found) == [
        ("lag", "g", 0, 11000.0), ("lag", "g", 60, 11000.0), ("replicas", "a", 60, 2.0), ("replicas", "a", 120, 2.0),
        ("some lag", "g", 0, 11000.0), ("some lag", "g", 60, 11000.0), ("some lag", "g", 120, 1.0), ("some lag", "g", 180, 1.0),
    ]


def test_bounds_of_the_grid_reach_the_scan(spark, scraped, tmp_path):  # noqa: F811
    path = f"{tmp_path}/m"
    scraped(offsets([(0, 1), (60, 2)])).write.parquet(path)
    frame = steps.latest_steps(spark.read.schema(METRIC_SCHEMA).parquet(path), steps.Grid(START, at(60)))
    plan = spark._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert len(pushed) == 1 and "GreaterThan(ts" in pushed[0] and "LessThanOrEqual(ts" in pushed[0]
    assert plan.count("rangepartitioning") >= 1 and OFFSET
