"""Row filters of the telemetry pipelines."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.schema import KEY


def _moment(value):
    """A column as it is; a datetime or text as a timestamp in the session zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp")


def cutoff(as_of, days=1):
    """The earliest moment that still counts as recent."""
    return _moment(as_of) - F.make_dt_interval(days=F.lit(days))


def recent(df, as_of, days=1, column="send_timestamp"):
    """Rows sent at or after ``as_of - days``; an unreadable send time is dropped.

    A text column is parsed, a timestamp column is compared as it is so that the
    predicate reaches the scan.
    """
    sent = F.col(column)
    if dict(df.dtypes)[column] == "string":
        sent = F.try_to_timestamp(sent)
    return df.filter(sent >= cutoff(as_of, days))


def only_split(df, split="train"):
    """Rows of one split."""
    return df.filter(F.col("usage") == split)


def _has_key(key):
    return reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in key])


def with_reason(df, key=tuple(KEY)):
    """All rows with ``reason``: which of ``key`` are missing, NULL where none is."""
    missing = F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in key])
    return df.withColumn("reason", F.when(~_has_key(key), missing))


def split_valid(df, key=tuple(KEY)):
    """Rows with a complete key, and the others with a ``reason`` naming what is missing."""
    missing = F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in key])
    return df.filter(_has_key(key)), df.filter(~_has_key(key)).withColumn("reason", missing)


def guard_empty(df):
    """True when there is nothing to do; stops at the first row found."""
    return df.isEmpty()


def match_labels(df, equals=None, regex=None):
    """Label matchers of a metric query: exact values, and fully anchored patterns."""
    for name, value in (equals or {}).items():
        df = df.filter(F.col(name) == value)
    for name, pattern in (regex or {}).items():
        df = df.filter(F.col(name).rlike(f"^(?:{pattern})$"))
    return df
