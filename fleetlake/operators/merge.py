"""Insert-if-absent: which incoming rows are new, which are ignored, which conflict."""

from functools import reduce

from pyspark.sql import functions as F

from fleetlake.schema import KEY
from fleetlake.session import ROW_OVERHEAD, broadcast_limit


class DuplicateKeyError(ValueError):
    """A strict insert met a key that exists already, or twice in the input."""


def not_in_target(incoming, target, key=tuple(KEY)):
    """Incoming rows whose key the target does not hold. Only the target's keys are read.

    A key with very many incoming rows is split by Spark's adaptive skew join, which needs the
    target to be a plain scan; a target that is itself computed is written first.
    """
    return incoming.join(target.select(*key), list(key), "left_anti")


def ignored_rows(incoming, target, key=tuple(KEY)):
    """Incoming rows whose key the target holds already; on skew see ``not_in_target``."""
    return incoming.join(target.select(*key), list(key), "left_semi")


def conflicts(incoming, target, key=tuple(KEY)):
    """Keys a strict insert cannot take: ``n`` incoming rows each, ``in_target`` or not.

    Both sides are counted in one grouping, so a key with very many rows is
    reduced before the shuffle.
    """
    both = incoming.select(*key, F.lit(1).alias("_in"), F.lit(0).alias("_held")).unionAll(
        target.select(*key, F.lit(0), F.lit(1))
    )
    counted = both.groupBy(*key).agg(F.sum("_in").alias("n"), (F.max("_held") == 1).alias("in_target"))
    return counted.filter((F.col("n") > 1) | ((F.col("n") > 0) & F.col("in_target")))


class KeyProfile:
    """Number, text size and range of the keys of a frame, measured in one narrow pass."""

    def __init__(self, df, key=tuple(KEY)):
        self.key = key
        size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(name), F.lit(0)) for name in key])
        row = df.agg(
            F.count("*").alias("rows"),
            F.coalesce(F.sum(size), F.lit(0)).alias("bytes"),
            *[f(name).alias(f"{label}_{name}") for name in key for label, f in (("lo", F.min), ("hi", F.max))],
        ).first()
        self.rows = row["rows"]
        self.bytes = row["bytes"] + self.rows * ROW_OVERHEAD
        self.ranges = {name: (row[f"lo_{name}"], row[f"hi_{name}"]) for name in key}

    def within(self, target):
        """Target rows that can share a key with the frame: all others lie outside its ranges.

        Exact, and answered by Parquet statistics where ticks arrive in rough order.
        """
        return reduce(lambda df, item: df.filter(F.col(item[0]).between(*item[1])), self.ranges.items(), target)


def new_rows(fresh, target, key=tuple(KEY), profile=None):
    """The rows an insert-if-absent adds out of ``fresh``, which holds every key once.

    Without ``profile`` both sides are shuffled by key. A ``profile`` of the fresh keys bounds
    the target scan, and if all those keys are small enough to broadcast, the target
    is not shuffled at all: the matching keys are looked up where they are stored.
    """
    if profile is None:
        return not_in_target(fresh, target, key)
    if profile.rows == 0:
        return fresh
    near = profile.within(target.select(*key))
    if profile.bytes <= broadcast_limit(fresh.sparkSession):
        near = near.join(F.broadcast(fresh.select(*key)), list(key), "left_semi")
    return not_in_target(fresh, near, key)
