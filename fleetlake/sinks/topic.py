"""Samples to topic messages."""

from pyspark.sql import functions as F

from fleetlake.functions.shape import encode_json
from fleetlake.schema import COLUMNS


def envelope(df, topic="telemetry", partitions=14, offset=None, columns=tuple(COLUMNS), start=0):
    """Encode samples and add what a broker would: topic, partition, offset and times.

    A key always gets the same partition. ``offset`` names a column in arrival order;
    without it row ids are used, which grow within each task. Offsets begin at ``start``, which has
    to lie above those of earlier writes: ``topic.next_offset()``.
    """
    order = (F.monotonically_increasing_id() if offset is None else F.col(offset).cast("long")) + F.lit(start)
    numbered = df.withColumn("_offset", order)
    return encode_json(numbered, columns, keep=["_offset"]).select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("key"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("_offset").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
