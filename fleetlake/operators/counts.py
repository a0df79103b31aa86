"""Row counts along a pipeline, and rates."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from fleetlake.schema import KEY


def stage_counts(df, stages, key=tuple(KEY)):
    """Rows after each stage and distinct keys after the last, in one pass.

    ``stages`` maps a name to the condition it adds; conditions accumulate.
    """
    passed, counts = F.lit(True), []
    for name, condition in stages.items():
        passed = passed & condition if condition is not None else passed
        counts.append((name, F.count_if(passed)))
    counts.append(("distinct_keys", F.count_distinct(F.when(passed, F.struct(*key)))))
    names = [name for name, _ in counts]
    wide = df.agg(*[count.alias(name) for name, count in counts])
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n")) for n in names]))
    )


def counted(df):
    """``df`` and an observation whose ``rows`` is known once an action on it has run.

    The count is taken along the way of the write itself, so nothing is read twice.
    """
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def throughput(rows, seconds):
    """Rows per second of a write, given what an ``Observation`` counted."""
    return rows / seconds if seconds > 0 else float("inf")


def load_rate(df, by="timestamp", seconds=86400):
    """Rows and rows per second for each value of ``by``, a label for ``seconds`` of data."""
    n = F.count("*")
    return df.groupBy(by).agg(n.alias("n"), (n / F.lit(float(seconds))).alias("rows_per_s"))
