"""The pipelines end to end. Each takes frames or sources and writes one target.

Every job is a chain of lazy steps with one write. ``as_of`` is always given by the
caller, so running a job again gives the same result.
"""

import time

from pyspark.sql import functions as F

from fleetlake.functions.decode import decode_lenient, decode_strict, parse_send_timestamp
from fleetlake.functions.shape import fill_missing, rename_features, stamp_send_time
from fleetlake.operators.counts import counted, throughput
from fleetlake.operators.dedup import first_wins
from fleetlake.operators.features import mutual_information, pca_loadings, top_k
from fleetlake.operators.filters import cutoff, guard_empty, only_split, recent, with_reason
from fleetlake.operators.neighbours import neighbour_information
from fleetlake.schema import ARRIVAL, FEATURE_NAMES, KEY
from fleetlake.session import scratch
from fleetlake.sinks.export import export, export_path
from fleetlake.sinks.topic import envelope
from fleetlake.sources.files import FILE_ORDER, numbered, staged
from fleetlake.streaming.ingest import merge_stream


def set_aside(samples, quarantine, wanted=None):
    """The good samples, once the bad ones are in the folder ``quarantine`` (replacing an earlier run's).

    Bad is what lacks a part of the key or a readable send time; ``reason`` names it. The samples are decoded once: what is bad, and
    what is good and meets the condition ``wanted``, is staged, and both are taken from there, so a message that arrives
    meanwhile is in neither. Without a folder all are handed on, and the table refuses a row that has no key: the job
    fails, and no row is lost without a trace.
    """
    parsed = parse_send_timestamp(samples)
    if not quarantine:
        return parsed if wanted is None else parsed.filter(wanted)
    marked = with_reason(parsed, [*KEY, "send_timestamp"])
    path = scratch(samples.sparkSession, "decoded")
    (marked if wanted is None else marked.filter(F.col("reason").isNotNull() | wanted)).write.parquet(path)
    staged = samples.sparkSession.read.schema(marked.schema).parquet(path)
    staged.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(quarantine)
    return staged.filter(F.col("reason").isNull()).drop("reason")


def recent_samples(messages, as_of, days=1, selective=False, quarantine=None):
    """Topic messages to recent samples with their arrival order; see ``set_aside`` for bad ones.

    ``selective`` looks at the send time alone first and parses only recent messages, and those without a
    send time, in full. That pays when the topic reaches back much further than ``days``.
    """
    if selective:
        sent = F.try_to_timestamp(F.from_json(F.col("value").cast("string"), "send_timestamp string")["send_timestamp"])
        late = sent >= cutoff(as_of, days)
        messages = messages.filter(sent.isNull() | late if quarantine else late)
    return set_aside(decode_strict(messages, keep=ARRIVAL), quarantine, F.col("send_timestamp") >= cutoff(as_of, days))


def backfill_append(messages, table, as_of, days=1, selective=False, quarantine=None):
    """Recent messages, first of each key, appended to a table that has none of the keys."""
    table.ensure().append(first_wins(recent_samples(messages, as_of, days, selective, quarantine)))
    return table


def backfill_merge(messages, table, as_of, days=1, selective=False, quarantine=None, measure=True):
    """Recent messages merged into a table that may hold some of the keys; ``measure`` as in the table."""
    rows = recent_samples(messages, as_of, days, selective, quarantine)
    table.ensure().insert_if_absent(rows, measure=measure)
    return table


def stream_ingest(messages, table, checkpoint, quarantine=None, counts=None, as_of=None, days=None, **trigger):
    """A message stream merged into a table; recency is only checked when ``days`` is given."""
    samples = decode_strict(messages, keep=ARRIVAL)
    if days is not None:
        samples = recent(samples, as_of, days)
    table.ensure()
    return merge_stream(parse_send_timestamp(samples), table, checkpoint, quarantine, counts, **trigger)


def consume_merge(messages, table, checkpoint, quarantine=None, counts=None, **trigger):
    """A message stream decoded leniently and merged into a table."""
    samples = parse_send_timestamp(decode_lenient(messages, keep=ARRIVAL))
    table.ensure()
    return merge_stream(samples, table, checkpoint, quarantine, counts, **trigger)


def export_split(stored, base, as_of, days=1, split="train", fmt="csv"):
    """Recent samples of one split out of a table, to a directory of their own.

    ``as_of`` is a datetime. Both filters reach the scan, be it files or a database.
    """
    return export(only_split(recent(stored, as_of, days), split), export_path(base, as_of), fmt)


def publish_split(stored, publication, as_of, days=1, split="train", **publish):
    """The same, published whole under the name of the split and ``as_of``; a run that is repeated writes nothing again."""
    return publication.publish(only_split(recent(stored, as_of, days), split), f"{split}-{as_of}-{days}", **publish)


def csv_to_topic(samples, topic, as_of, writer=None, batch=0, **envelope_options):
    """Samples read from files, stamped, encoded and sent to a topic in reading order, after what it holds.

    With a ``writer``, ``topic`` is a ``SentTopic``: the job may be run again, and other writers may be at work.
    """
    rows = stamp_send_time(samples, as_of)
    if set(FILE_ORDER) <= set(samples.columns):
        rows, envelope_options = numbered(rows), {"offset": "arrival", **envelope_options}
    if writer:
        topic.send(envelope(rows, **envelope_options), writer, batch)
    else:
        topic.write(envelope(rows, start=topic.next_offset(), **envelope_options))
    return topic


def csv_to_table(samples, table, as_of, quarantine=None, corrupt=None):
    """Samples read from files straight into a table; a key that is taken stops the job.

    Bad samples are set aside; with ``corrupt`` also lines that the reader kept in the column of that name
    because some text in them is no number. Nothing is written when nothing is left. The files are read once, into a
    staging folder, from which all of that is taken.
    """
    samples = staged(stamp_send_time(samples, as_of).drop(*FILE_ORDER))
    if corrupt and quarantine:
        broken = samples.filter(F.col(corrupt).isNotNull())
        broken.write.mode("overwrite").parquet(f"{quarantine}/lines")
        samples, quarantine = samples.filter(F.col(corrupt).isNull()).drop(corrupt), f"{quarantine}/keys"
    good = set_aside(samples, quarantine)
    if not guard_empty(good):
        table.ensure().insert_strict(good)
    return table.ensure()


def timed_load(samples, load):
    """``load(samples)`` and the rows per second that it wrote, counted on the way."""
    rows, seen = counted(samples)
    began = time.monotonic()
    load(rows)
    return throughput(seen.get["rows"], time.monotonic() - began)


def rank_features(samples, method="information", label="label", bins=10, k=10):
    """The ``k`` most telling metrics, by mutual information with the label, from bins or from nearest ``neighbours``, or by
    ``component`` (their share in the first principal component)."""
    named = rename_features(fill_missing(samples))
    if method == "information":
        return top_k(mutual_information(named, FEATURE_NAMES, label, bins), "mi", k, tie=["feature"])
    if method == "neighbours":
        return top_k(neighbour_information(named, FEATURE_NAMES, label), "mi", k, tie=["feature"])
    if method == "component":
        return top_k(pca_loadings(named, FEATURE_NAMES), "importance", k, tie=["feature"])
    raise ValueError(f"unknown method: {method!r}")
