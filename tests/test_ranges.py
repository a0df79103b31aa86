"""Ranges for parallel reads of a table: disjoint and complete."""

import datetime
import decimal
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from fleetlake.session import scratch
from fleetlake.sinks.table import KeyedTable
from fleetlake.sources import jdbc

VALUES = {
    "double": st.floats(allow_nan=True, allow_infinity=True),
    "long": st.integers(-(2**62), 2**62),
    "timestamp_ntz": st.datetimes(datetime.datetime(1900, 1, 1), datetime.datetime(2100, 1, 1)),
    "date": st.dates(datetime.date(1900, 1, 1), datetime.date(2100, 1, 1)),
    "decimal(12,3)": st.decimals(-10**6, 10**6, places=3),
}


@pytest.mark.parametrize("kind", VALUES)
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(data=st.data())
def test_every_row_is_in_one_range(spark, kind, data):
    values = data.draw(st.lists(st.none() | VALUES[kind], min_size=1, max_size=12))
    marks = data.draw(st.lists(st.sampled_from(values) | VALUES[kind], max_size=5))
    rows = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    hits = sum(F.coalesce(F.expr(f"({p})").cast("int"), F.lit(0)) for p in jdbc.range_predicates("x", marks))
    assert [row[0] for row in rows.select(hits).collect()] == [1] * len(values)


def test_conditions():
    assert jdbc.range_predicates("d", [3, 1, 3, None, math.nan, math.inf]) == ["d < 1 OR d IS NULL", "d >= 1 AND d < 3", "d >= 3"]
    assert jdbc.range_predicates("d", []) == ["d IS NOT NULL OR d IS NULL"]
    assert jdbc.range_predicates("t", [datetime.datetime(2024, 1, 2, 3)])[1] == "t >= TIMESTAMP '2024-01-02 03:00:00'"
    assert jdbc.range_predicates("t", [datetime.date(2024, 1, 2), datetime.date(2024, 2, 1)])[2] == "t >= DATE '2024-02-01'"
    assert jdbc.range_predicates("t", [decimal.Decimal("1.50")])[1] == "t >= 1.50"
    for value in ("a", True, b"a"):
        with pytest.raises(TypeError):
            jdbc.range_predicates("t", [value])


def test_what_the_database_is_asked(spark, monkeypatch):
    asked = {}

    class Answer:
        def first(self):
            return {"marks": [10, 20, 20]}

    def query(spark, url, sql, **options):
        asked["sql"] = sql
        return Answer()

    def read(self, url, table, predicates, properties):
        asked.update(table=table, predicates=predicates, properties=properties)
        return "frame"

    monkeypatch.setattr(jdbc, "read_jdbc_query", query)
    monkeypatch.setattr(DataFrameReader, "jdbc", read)
    assert jdbc.read_jdbc_ranges(spark, "jdbc:postgresql://h/db", "lake", "ts", 4, percent=1, user="u") == "frame"
    assert asked["sql"] == "SELECT percentile_disc(ARRAY[0.25, 0.5, 0.75]) WITHIN GROUP (ORDER BY ts) AS marks FROM lake TABLESAMPLE SYSTEM (1)"
    assert asked["predicates"] == ["ts < 10 OR ts IS NULL", "ts >= 10 AND ts < 20", "ts >= 20"]
    assert asked["table"] == "lake" and asked["properties"] == {"user": "u"}


def test_table_in_ranges(spark, samples):
    table = KeyedTable(spark, scratch(spark, "ranges")).ensure()
    table.append(samples([("m", str(n), "train", n, float(n) if n % 5 else None) for n in range(200)]))
    counts = {r.range: r["count"] for r in jdbc.read_table_ranges(table, "col_0", 4).groupBy("range").count().collect()}
    assert sum(counts.values()) == 200 and set(counts) == {0, 1, 2, 3} and max(counts.values()) <= 85
    moments = jdbc.read_table_ranges(table, "send_timestamp", 3)
    assert moments.count() == moments.select("timestamp").distinct().count() == 200
    assert jdbc.read_table_ranges(table, "col_0", 1).count() == 200
    empty = KeyedTable(spark, scratch(spark, "ranges")).ensure()
    assert jdbc.read_table_ranges(empty, "col_0", 4).count() == 0
