"""Metric queries at every step of a time grid: newest values, rates over sliding windows, alerts.

A sample knows for which steps it counts: from its own time on until the next sample of its series, or until it is
stale. So a step's value is not searched for; every sample hands itself to its steps, and what is handed out is as
large as the answer. Samples have to be ordered for that, which is done in ranges of (series, time) of equal
size, also within a series that holds most of them. The last sample of a range does not know its successor and
counts until it is stale; of several samples handed to a step the newest is taken, so where ranges end changes nothing.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.operators.metrics import SERIES, fired, growth
from fleetlake.session import scratch
from fleetlake.sources.metrics import LAG, OFFSET


def micros(interval):
    """The length of an interval as a number of microseconds."""
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {interval}"))


class Grid:
    """Steps from ``start`` (a datetime or text) to ``end``, both included if ``step`` divides the time between them."""

    def __init__(self, start, end, step="1 minute"):
        self.start, self.end, self.step = start, end, step

    def within(self, df, before):
        """Samples that can count at some step: those up to the interval ``before`` older than the first. The bounds reach the scan."""
        kind = dict(df.dtypes)["ts"]
        first, last = [F.lit(str(moment)).cast(kind) for moment in (self.start, self.end)]
        return df.filter((F.col("ts") > first - F.expr(f"interval {before}")) & (F.col("ts") <= last))

    def handed_out(self, df, since, until):
        """A row for each step at or after ``since`` and before ``until`` (microseconds), numbered ``_step``."""
        first = F.unix_micros(F.lit(str(self.start)).cast("timestamp"))
        last = F.unix_micros(F.lit(str(self.end)).cast("timestamp"))
        marks = df.withColumns({
            "_since": F.greatest(since, first) - first, "_until": F.least(until, last + 1) - first, "_width": micros(self.step),
        })
        numbers = "if(_until > 0 AND (_since + _width - 1) div _width < (_until + _width - 1) div _width, " \
            "sequence((_since + _width - 1) div _width, (_until + _width - 1) div _width - 1), NULL)"
        return marks.withColumn("_step", F.explode(F.expr(numbers))).drop("_since", "_until", "_width")

    def moment(self, kind):
        """The time of step ``_step`` as a column ``step``."""
        first = F.unix_micros(F.lit(str(self.start)).cast("timestamp"))
        return F.timestamp_micros(first + F.col("_step") * micros(self.step)).cast(kind).alias("step")


def _ranged(df, series, order):
    """Samples in ranges of equal size; see the module's text. ``order`` begins with ``ts``."""
    if order[0] != "ts":
        raise ValueError("samples are ordered by time first")
    rows = df.select(*series, "value", *order).repartitionByRange(*series, *order).withColumn("_range", F.spark_partition_id())
    return rows.withColumns({"_us": F.unix_micros(F.col("ts").cast("timestamp")), "_at": F.struct(*order)})


def latest_steps(df, grid, lookback="5 minutes", series=tuple(SERIES), order=("ts",)):
    """The newest sample of every series at every step, ``step``, ``ts`` and ``value``, if it is at most ``lookback`` old.

    A series without such a sample gives no row for the step.
    """
    series = list(series)
    following = F.lead("_us").over(Window.partitionBy(*series, "_range").orderBy(*order))
    rows = _ranged(grid.within(df, lookback), series, order).withColumn("_next", following)
    handed = grid.handed_out(rows, F.col("_us"), F.least(F.coalesce("_next", F.col("_us") + micros(lookback)), F.col("_us") + micros(lookback)))
    newest = F.max_by(F.struct("ts", "value"), "_at").alias("_newest")
    found = handed.groupBy(*series, "_step").agg(newest)
    return found.select(*series, grid.moment(dict(df.dtypes)["ts"]), "_newest.ts", "_newest.value")


def sum_by_steps(df, labels, grid, metric=None, **newest):
    """``sum by (labels)`` of a metric at every step."""
    if metric is not None:
        df = df.filter(F.col("metric") == metric)
    return latest_steps(df, grid, **newest).groupBy(*labels, "step").agg(F.sum("value").alias("total"))


def lag_by_group_steps(df, grid, **newest):
    """Messages not yet read, per consumer group, at every step."""
    return sum_by_steps(df, ["consumergroup"], grid, LAG, **newest)


def alert_steps(df, rules, grid, **newest):
    """Alerts that fire at each step; rules as in ``alert_rows``."""
    wanted = df.filter(F.col("metric").isin(*[metric for _, metric, _, _ in rules]))
    return fired(latest_steps(wanted, grid, **newest), rules, ["step"])


def _running_totals(df, series, order):
    """Samples with ``_total``, the growth of their counter since its first sample, restarts added back.

    Totals are summed within a range first; the ranges' own totals, one number for each series and range, are then chained by
    the values at their ends. The ordered samples are written once, so that both look at the same ranges.
    """
    mine = Window.partitionBy(*series, "_range").orderBy(*order)
    rows = _ranged(df, series, order)
    grown = F.coalesce(growth(F.col("value"), F.lag("value").over(mine)), F.lit(0.0))
    rows = rows.withColumns({"_grown": grown, "_prev": F.lag("_us").over(mine), "_next": F.lead("_us").over(mine)})
    rows = rows.withColumn("_total", F.sum("_grown").over(mine.rowsBetween(Window.unboundedPreceding, 0))).drop("_grown")
    path = scratch(df.sparkSession, "ordered-samples")
    rows.write.parquet(path)
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    parts = rows.groupBy(*series, "_range").agg(
        F.max_by("_total", "_at").alias("_whole"), F.min_by("value", "_at").alias("_first"), F.max_by("value", "_at").alias("_last")
    )
    chain = Window.partitionBy(*series).orderBy("_range")
    gap = F.coalesce(growth(F.col("_first"), F.lag("_last").over(chain)), F.lit(0.0))
    parts = parts.withColumn("_gap", gap).withColumn("_through", F.sum(F.col("_gap") + F.col("_whole")).over(chain))
    parts = parts.select(*[F.col(name).alias(f"_p_{name}") for name in [*series, "_range"]], (F.col("_through") - F.col("_whole")).alias("_base"))
    same = [rows[name].eqNullSafe(parts[f"_p_{name}"]) for name in [*series, "_range"]]
    joined = rows.join(parts, same, "left").withColumn("_total", F.col("_total") + F.col("_base"))
    return joined.drop("_base", *[name for name in parts.columns if name.startswith("_p_")])


def counter_rate_steps(df, grid, labels=("topic", "part"), window="5 minutes", metric=OFFSET, order=("ts",)):
    """Growth per second of every counter series over the ``window`` before each step: the rate of a sliding range.

    The window holds the samples after ``step - window`` up to the step itself. The rate is the difference of the running
    totals of its last and its first sample over the time between them, not extrapolated to the window's ends; a window without two
    samples at different times has none. No sample is copied per window it lies in: it is handed to the steps whose last sample it
    is, and to those whose first it is.
    """
    labels = list(labels)
    if metric is not None:
        df = df.filter(F.col("metric") == metric)
    rows = _running_totals(grid.within(df, window), labels, order)
    width, at = micros(window), F.col("_us")
    ends = F.least(F.coalesce("_next", at + width), at + width)
    begins = F.greatest(at, F.coalesce(F.col("_prev") + width, at))
    kept = [*labels, "_at", "_us", "_total"]
    last = grid.handed_out(rows.select(*kept, "_next"), at, ends).select(*kept, "_step", F.lit(True).alias("_is_last"))
    first = grid.handed_out(rows.select(*kept, "_prev"), begins, at + width).select(*kept, "_step", F.lit(False).alias("_is_last"))
    point = F.struct("_us", "_total")
    found = last.unionAll(first).groupBy(*labels, "_step").agg(
        F.max_by(F.when(F.col("_is_last"), point), F.when(F.col("_is_last"), F.col("_at"))).alias("_to"),
        F.min_by(F.when(~F.col("_is_last"), point), F.when(~F.col("_is_last"), F.col("_at"))).alias("_from"),
    )
    return found.filter(F.col("_to._us") > F.col("_from._us")).select(
        *labels, grid.moment(dict(df.dtypes)["ts"]),
        ((F.col("_to._total") - F.col("_from._total")) / ((F.col("_to._us") - F.col("_from._us")) / F.lit(1e6))).alias("rate"),
    )
