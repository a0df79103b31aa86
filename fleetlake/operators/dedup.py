"""First-wins deduplication."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.schema import ARRIVAL, KEY


def first_wins(df, key=tuple(KEY), order=tuple(ARRIVAL)):
    """The first row of every key by ``order``; NULL keys are one key.

    ``row_number = 1`` is planned with a group limit before the shuffle, so each task
    sends at most one row per key and a key with very many copies is no hot spot.
    """
    first = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") == 1).drop("_nth")
