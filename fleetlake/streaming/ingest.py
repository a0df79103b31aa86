"""Streaming ingest: topic stream to keyed table, batch by batch."""

import json

from pyspark import StorageLevel
from pyspark.sql import functions as F

from fleetlake.operators.filters import split_valid
from fleetlake.schema import ARRIVAL, KEY

# Groups of tasks that deduplicate a stream apart first.
SALTS = 16


def write_stream(df, checkpoint, each_batch, available_now=True, interval=None):
    """Run ``each_batch(batch_df, batch_id)`` on every micro-batch, in append mode.

    The checkpoint is what makes the query resumable: it records which messages a batch
    holds before the batch runs and that it is done after. ``available_now`` stops
    when the source is used up, otherwise ``interval`` (e.g. ``"10 seconds"``) paces it.
    """
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(each_batch)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def query_id(spark, checkpoint):
    """The id a query keeps for as long as its checkpoint lives."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def merge_batch(batch_df, batch_id, table, writer, quarantine=None, counts=None, order=tuple(ARRIVAL)):
    """Merge one micro-batch into ``table``.

    Rows without a complete key go below the folder ``quarantine``. The folder ``counts``
    gets the number of rows. All three are written under the writer and batch id, so a
    repeated batch replaces its own output. When a batch has more than one use it is kept
    meanwhile, on disk if need be; losing an executor only means reading its part again.
    """
    shared = bool(quarantine or counts)
    batch = batch_df.persist(StorageLevel.MEMORY_AND_DISK) if shared else batch_df
    place = f"writer={writer}/batch_id={batch_id}"
    try:
        valid, bad = split_valid(batch, KEY)
        table.insert_if_absent(valid, batch_id, order, writer=writer)
        if quarantine:
            bad.write.mode("overwrite").parquet(f"{quarantine}/{place}")
        if counts:
            row = batch.agg(F.lit(batch_id).cast("long").alias("batch"), F.count("*").alias("n"))
            row.write.mode("overwrite").parquet(f"{counts}/{place}")
    finally:
        if shared:
            batch.unpersist()


def merge_stream(df, table, checkpoint, quarantine=None, counts=None, order=tuple(ARRIVAL), **trigger):
    """Insert a stream of samples into ``table``, each key once."""

    def merge(batch_df, batch_id):
        writer = query_id(df.sparkSession, checkpoint)
        merge_batch(batch_df, batch_id, table, writer, quarantine, counts, order)

    return write_stream(df, checkpoint, merge, **trigger)


def append_stream(df, path, checkpoint, available_now=True):
    """Append a stream to Parquet files, each row exactly once."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).format("parquet")
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def dedup_stream(df, event_time, delay, key=tuple(KEY)):
    """Keep one row per key among rows at most ``delay`` apart, with bounded state.

    Rows are first reduced per key and one of ``SALTS`` groups of reading tasks, then per key, so a key
    with very many rows is not sent to one task as a whole and the state holds at most SALTS + 1 rows
    of a key. ``event_time`` must be a timestamp with zone; a zone-less one is cast first.
    """
    timed = df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, delay)
    spread = timed.withColumn("_task", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    return spread.dropDuplicatesWithinWatermark([*key, "_task"]).drop("_task").dropDuplicatesWithinWatermark(list(key))
