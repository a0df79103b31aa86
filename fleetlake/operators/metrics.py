"""Metric queries: newest value per series, sums by label, counter rates, alerts."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.sources.metrics import LAG, OFFSET, UNDER_REPLICATED

SERIES = ["metric", "topic", "part", "consumergroup"]


def instant(df, as_of, lookback="5 minutes"):
    """Samples that count at the moment ``as_of``: at most ``lookback`` (an interval) older, none newer.

    ``as_of`` (a datetime or text) is a literal of the column's own type, so both bounds reach the scan.
    """
    at = F.lit(str(as_of)).cast(dict(df.dtypes)["ts"])
    return df.filter((F.col("ts") <= at) & (F.col("ts") > at - F.expr(f"interval {lookback}")))


def latest_per_series(df, as_of, lookback="5 minutes", series=tuple(SERIES), order=("ts",)):
    """The newest sample of every series at ``as_of``: its ``ts`` and ``value``; see ``instant``.

    A series without a sample within ``lookback`` is stale and gives no row.
    """
    df = instant(df, as_of, lookback)
    if tuple(order) == ("ts",):
        # Two fixed-size buffers: a hash aggregation that sorts nothing.
        return df.groupBy(*series).agg(F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts"))
    newest = F.max_by(F.struct("ts", "value"), F.struct(*order)).alias("_newest")
    return df.groupBy(*series).agg(newest).select(*series, "_newest.ts", "_newest.value")


def sum_by(df, labels, metric=None, *, as_of, **newest):
    """``sum by (labels)`` of the newest values of a metric."""
    if metric is not None:
        df = df.filter(F.col("metric") == metric)
    return latest_per_series(df, as_of, **newest).groupBy(*labels).agg(F.sum("value").alias("total"))


def lag_by_group(df, **newest):
    """Messages not yet read, per consumer group."""
    return sum_by(df, ["consumergroup"], LAG, **newest)


def lag_by_group_topic(df, **newest):
    """Messages not yet read, per consumer group and topic."""
    return sum_by(df, ["consumergroup", "topic"], LAG, **newest)


def under_replicated(df, **newest):
    """Under-replicated partitions per topic."""
    return sum_by(df, ["topic"], UNDER_REPLICATED, **newest)


def latest_gauges(df, metrics, as_of, **newest):
    """The newest values of the named gauges."""
    return latest_per_series(df.filter(F.col("metric").isin(*metrics)), as_of, **newest)


def growth(now, before):
    """Growth of a counter between two samples; a fall means it restarted at zero."""
    return F.when(now >= before, now - before).when(now < before, now)


def counter_rate(df, labels=("topic", "part"), window="5 minutes", metric=OFFSET, order=("ts",)):
    """Growth per second of every counter series in every window.

    Restarts are added back. A series with one sample in a window, or with all of
    them at the same time, has no rate there. The growth is divided by the time between
    first and last sample; it is not extrapolated to the window's ends.

    Samples have to be ordered, which is done in ranges of (series, window, ``order``) of equal size: a
    range ends wherever it is full, also within a burst, and its growth is chained to the range before by the
    values at their ends. ``order`` begins with ``ts``; further columns part samples of one moment.
    """
    if order[0] != "ts":
        raise ValueError("samples are ordered by time first")
    if metric is not None:
        df = df.filter(F.col("metric") == metric)
    group = [*labels, "window_start"]
    rows = df.withColumn("window_start", F.window("ts", window)["start"]).select(*group, "value", *order)
    ranged = rows.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id())
    before = F.lag("value").over(Window.partitionBy(*group, "_range").orderBy(*order))
    steps = ranged.withColumn("_grown", growth(F.col("value"), before)).withColumn("_at", F.struct(*order))
    parts = steps.groupBy(*group, "_range").agg(
        F.sum("_grown").alias("_grown"), F.min("ts").alias("_from"), F.max("ts").alias("_to"),
        F.min_by("value", "_at").alias("_first"), F.max_by("value", "_at").alias("_last"),
    )
    before = F.lag("_last").over(Window.partitionBy(*group).orderBy("_range"))
    chained = parts.withColumn("_gap", growth(F.col("_first"), before))
    added = F.coalesce("_grown", F.lit(0.0)) + F.coalesce("_gap", F.lit(0.0))
    totals = chained.groupBy(*group).agg(
        F.sum(added).alias("_grown"), F.min("_from").alias("_from"), F.max("_to").alias("_to")
    )
    micros = F.unix_micros(F.col("_to").cast("timestamp")) - F.unix_micros(F.col("_from").cast("timestamp"))
    return totals.filter(F.col("_to") > F.col("_from")).select(
        *group, (F.col("_grown") / (micros / F.lit(1e6))).alias("rate")
    )


def topic_rate(df, **rate):
    """Counter growth per second of all partitions of a topic together."""
    return counter_rate(df, **rate).groupBy("topic", "window_start").agg(F.sum("rate").alias("rate"))


def alert_rows(df, rules, as_of, **newest):
    """Alerts of several rules in one pass: ``rule``, ``name`` and the ``total`` that fired.

    A rule is ``(rule, metric, label, condition)``: the newest values of ``metric`` are summed
    by ``label``, and ``condition`` says of that total whether it fires, e.g.
    ``("lag", LAG, "consumergroup", lambda total: total >= 10000)``. A metric may have several rules.
    """
    values = latest_per_series(df.filter(F.col("metric").isin(*[metric for _, metric, _, _ in rules])), as_of, **newest)
    return fired(values, rules)


def fired(values, rules, by=()):
    """The alerts of ``rules`` among newest values, apart for each value of the columns ``by``."""
    asked, fires = [], F
    for title, metric, label, condition in rules:
        mine = F.struct(F.lit(title).alias("rule"), F.col(label).cast("string").alias("name"))
        asked.append(F.when(F.col("metric") == metric, mine))
        fires = fires.when(F.col("rule") == title, condition(F.col("total")))
    each = values.select(*by, "value", F.explode(F.array_compact(F.array(*asked))).alias("_asked"))
    totals = each.groupBy("_asked.rule", "_asked.name", *by).agg(F.sum("value").alias("total"))
    return totals.filter(fires)
