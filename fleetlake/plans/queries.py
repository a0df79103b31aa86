"""The registered queries: every operator over the driver's whole tables.

Each takes a session and a folder of tables and returns a frame. Queries about sinks
and streams write below the session's shared scratch folder and read that back.
"""

from pyspark.sql import functions as F

from fleetlake.functions import catalog, decode, shape
from fleetlake.operators import counts, features, filters, merge, metrics
from fleetlake.operators import steps as grids
from fleetlake.operators.dedup import first_wins
from fleetlake.operators.neighbours import neighbour_information as near_information
from fleetlake.plans import adapter, jobs
from fleetlake.schema import ARRIVAL, FEATURES, KEY, message_fields
from fleetlake.session import scratch
from fleetlake.sinks import export as exports
from fleetlake.sinks.published import Publication
from fleetlake.sinks.runs import RunTable
from fleetlake.sinks.sends import SentTopic
from fleetlake.sinks.table import KeyedTable
from fleetlake.sources import files, jdbc
from fleetlake.sources import metrics as metric_source
from fleetlake.sources.topic import FileTopic
from fleetlake.streaming import ingest

REGISTERED = {}

# Days that count as recent.
DAYS = 7

# How long a metric sample counts when the newest values are asked for.
LOOKBACK = "6 hours"

# Files of a topic that is read in chunks, and files in a chunk; both are multiplied for each further ``MANY`` messages, so that
# there are as many chunks and no file is written or read by a task that grows with the topic.
FILES, CHUNK, MANY = 8, 2, 400_000


def query(run):
    REGISTERED[run.__name__] = run
    return run


def _keys():
    """The key; ``timestamp`` and ``usage`` are called ``tick`` and ``split`` in results."""
    return [F.col("machine"), F.col("timestamp").alias("tick"), F.col("usage").alias("split")]


def _sent(name="send_ts"):
    return F.col("send_timestamp").cast("timestamp_ntz").alias(name)


def _stored(table):
    return table.read().select(*_keys(), _sent(), "col_0")


def _table(spark, name):
    return KeyedTable(spark, scratch(spark, name)).ensure()


def _topic(spark, name):
    return FileTopic(spark, scratch(spark, name))


def _filled_topic(spark, messages):
    topic = _topic(spark, "topic")
    topic.write(messages)
    return topic


def _checkpoint(spark):
    return scratch(spark, "checkpoint")


def _samples(spark, sf_dir):
    """Samples with parsed send times and their event id as arrival order."""
    return shape.conform(
        decode.parse_send_timestamp(adapter.samples(spark, sf_dir, keep=["event_id", "event_type"])),
        keep=["event_id", "event_type"],
    )


def _earlier_table(spark, sf_dir, name):
    """A table holding the first sample of each key of the earlier load."""
    table = _table(spark, name)
    table.append(first_wins(adapter.earlier(_samples(spark, sf_dir)), order=["event_id"]))
    return table


def _kind():
    return (
        F.when(F.col("partition") == -2, "damaged").when(F.col("partition") == -1, "document").otherwise("sample")
    ).alias("kind")


def _source_id():
    return F.when(F.col("partition") == -2, -1 - F.col("offset")).otherwise(F.col("offset")).alias("src_id")


# Sources


@query
def scan_topic_batch(spark, sf_dir):
    topic = _filled_topic(spark, adapter.messages(spark, sf_dir))
    return topic.read().select("topic", "offset", F.col("key").cast("string").alias("msg_key"))


@query
def stream_topic_scan(spark, sf_dir):
    topic, out = _filled_topic(spark, adapter.messages(spark, sf_dir)), scratch(spark, "scanned")
    rows = topic.read_stream().select("topic", "offset", F.col("key").cast("string").alias("msg_key"))
    ingest.append_stream(rows, out, _checkpoint(spark)).awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query
def stream_resume(spark, sf_dir):
    topic, out, checkpoint = _topic(spark, "topic"), scratch(spark, "resumed"), _checkpoint(spark)
    for segment in adapter.segments(spark, sf_dir):
        topic.write(segment)
        samples = decode.decode_strict(topic.read_group(), message_fields(*KEY), keep=["offset"])
        samples = samples.select(*_keys(), F.col("offset").alias("event_id"))
        ingest.append_stream(samples, out, checkpoint).awaitTermination()
    return spark.read.schema(samples.schema).parquet(out)


def _machine_files(spark, sf_dir, split):
    path = scratch(spark, f"csv-{split}")
    files.write_machine_csv(filters.only_split(adapter.samples(spark, sf_dir), split), path, apart=True)
    return path


def _train_files(spark, sf_dir):
    return files.read_train_csv(spark, _machine_files(spark, sf_dir, "train"), pattern="*/machine=machine-*", many=True)


def _test_files(spark, sf_dir):
    return files.read_test_csv(spark, _machine_files(spark, sf_dir, "test"), "machine=machine-*", pattern="*/{machine}", many=True)


@query
def scan_csv_train(spark, sf_dir):
    rows = _train_files(spark, sf_dir)
    return files.staged(rows.select("machine", F.col("timestamp").alias("tick"), F.col("label").cast("int").alias("label"), "col_0"))


@query
def scan_csv_test(spark, sf_dir):
    rows = _test_files(spark, sf_dir)
    return files.staged(rows.select("machine", F.col("timestamp").alias("tick"), "label", "col_0"))


@query
def scan_table_query(spark, sf_dir):
    table = _table(spark, "queried")
    table.append(_samples(spark, sf_dir))
    return jdbc.read_table_query(
        table,
        "SELECT machine, `timestamp` AS tick, usage AS split, col_0 FROM {samples} WHERE usage = 'train' AND col_0 >= 10",
    )


@query
def scan_table(spark, sf_dir):
    table = _table(spark, "scanned")
    table.append(_samples(spark, sf_dir))
    return _stored(table)


@query
def scan_table_ranges(spark, sf_dir):
    """A table read in ranges of its send time (S6, S7): every row in one range only."""
    table = _table(spark, "ranged")
    table.append(_samples(spark, sf_dir))
    return jdbc.read_table_ranges(table, "send_timestamp", 8).select(*_keys(), _sent(), "col_0")


@query
def scan_table_pushdown(spark, sf_dir):
    table = _table(spark, "pushed")
    table.append(_samples(spark, sf_dir))
    since = adapter.latest_time(spark, sf_dir).cast("timestamp") - F.make_dt_interval(days=F.lit(DAYS))
    return jdbc.recent_in_db(table.read(), since, "train").select(*_keys(), _sent(), "col_0")


@query
def scan_metric_samples(spark, sf_dir):
    path = scratch(spark, "metrics")
    samples = adapter.metric_samples(spark, sf_dir).drop("event_id")
    samples.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(path)
    return metric_source.metric_samples(spark, path).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# Sinks


@query
def sink_append(spark, sf_dir):
    table, rows = _table(spark, "appended"), _samples(spark, sf_dir)
    for split in ("train", "test"):
        table.append(filters.only_split(rows, split))
    return _stored(table)


@query
def merge_insert_if_absent(spark, sf_dir):
    table = _earlier_table(spark, sf_dir, "merged")
    table.insert_if_absent(_samples(spark, sf_dir), order=["event_id"])
    return _stored(table)


@query
def merge_into_empty(spark, sf_dir):
    table = _table(spark, "filled")
    table.insert_if_absent(_samples(spark, sf_dir), order=["event_id"], measure=False)
    return _stored(table)


@query
def merge_twice(spark, sf_dir):
    table, rows = _table(spark, "repeated"), _samples(spark, sf_dir)
    for _ in range(2):
        table.insert_if_absent(rows, order=["event_id"])
    return _stored(table)


def _run_table(spark, name, **options):
    return RunTable(spark, scratch(spark, name), **options).ensure()


@query
def merge_bucketed(spark, sf_dir):
    """The earlier load, then the whole topic, into a target of bucketed runs."""
    table, rows = _run_table(spark, "runs"), _samples(spark, sf_dir)
    table.append(first_wins(adapter.earlier(rows), order=["event_id"]))
    table.insert_if_absent(rows, order=["event_id"])
    return _stored(table)


@query
def merge_compacted(spark, sf_dir):
    """The earlier load, each kind of event as a batch, one of them twice; compacted and expired on the way."""
    table, rows = _run_table(spark, "runs", fanout=2), _samples(spark, sf_dir)
    table.append(first_wins(adapter.earlier(rows), order=["event_id"]))
    for batch_id, kind in enumerate(["click", "purchase", "click", "signup", "error", "view"]):
        table.insert_if_absent(rows.filter(F.col("event_type") == kind), max(batch_id - 2, 0) if kind == "click" else batch_id, ["event_id"], writer="kinds")
        table.compact()
    table.expire()
    return _stored(table)


@query
def stream_merge_runs(spark, sf_dir):
    """The topic as it fills up, streamed into a target of bucketed runs, which is compacted between two starts."""
    table, topic, checkpoint = _run_table(spark, "streamed", fanout=2), _topic(spark, "topic"), _checkpoint(spark)
    for segment in adapter.segments(spark, sf_dir):
        topic.write(segment)
        jobs.stream_ingest(topic.read_stream(), table, checkpoint).awaitTermination()
        table.compact()
    return _stored(table)


@query
def sink_insert_strict_conflicts(spark, sf_dir):
    target = _earlier_table(spark, sf_dir, "target").read()
    found = merge.conflicts(adapter.samples(spark, sf_dir), target)
    return found.select(*_keys(), "n", "in_target")


@query
def ensure_table_idempotent(spark, sf_dir):
    table = _earlier_table(spark, sf_dir, "ensured").ensure()
    return table.ensure().read().agg(F.count("*").alias("n"))


@query
def sink_topic_envelope(spark, sf_dir):
    topic = _filled_topic(spark, adapter.messages(spark, sf_dir))
    value = F.get_json_object(F.col("value").cast("string"), "$.send_timestamp").alias("send_text")
    return topic.read().select("topic", "offset", F.col("key").cast("string").alias("msg_key"), value)


@query
def sink_topic_sent_once(spark, sf_dir):
    """Two writers' sends, each repeated."""
    topic = SentTopic(spark, scratch(spark, "sent"))
    for _ in range(2):
        for writer, messages in zip(("early", "late"), adapter.segments(spark, sf_dir)):
            topic.send(messages, writer)
    value = F.get_json_object(F.col("value").cast("string"), "$.send_timestamp").alias("send_text")
    return topic.read().select("topic", "offset", F.col("key").cast("string").alias("msg_key"), value)


def _exported(spark, sf_dir, fmt):
    train = filters.only_split(_samples(spark, sf_dir)).select(*shape.COLUMNS)
    path = exports.export(train, scratch(spark, f"export-{fmt}"), fmt)
    return exports.read_export(spark, path, fmt).select(*_keys(), _sent(), "label", "col_0")


def _published(spark, sf_dir, fmt):
    """The earlier load's export, then that of all train samples, which is the one that is read."""
    publication = Publication(spark, scratch(spark, f"published-{fmt}"), fmt)
    whole = filters.only_split(_samples(spark, sf_dir))
    publication.publish(adapter.earlier(whole), "earlier", max_rows=2000)
    publication.publish(whole, "all", max_rows=2000)
    publication.expire()
    return publication.read().select(*_keys(), _sent(), "label", "col_0")


@query
def export_published(spark, sf_dir):
    return _published(spark, sf_dir, "parquet")


@query
def export_published_csv(spark, sf_dir):
    return _published(spark, sf_dir, "csv")


@query
def export_csv_roundtrip(spark, sf_dir):
    return _exported(spark, sf_dir, "csv")


@query
def export_parquet_roundtrip(spark, sf_dir):
    return _exported(spark, sf_dir, "parquet")


@query
def preview_topn(spark, sf_dir):
    return exports.preview(adapter.samples(spark, sf_dir), 10, order=[*KEY, "event_id"]).select(*_keys(), "event_id")


# Decoding and shaping


@query
def decode_strict(spark, sf_dir):
    fields = message_fields(*KEY, "label", "col_0")
    rows = decode.decode_strict(adapter.all_messages(spark, sf_dir), fields, keep=ARRIVAL)
    return rows.select(_kind(), _source_id(), *_keys(), "label", "col_0")


@query
def decode_lenient(spark, sf_dir):
    rows = decode.decode_lenient(adapter.all_messages(spark, sf_dir), keep=ARRIVAL)
    return rows.select(_kind(), _source_id(), *_keys(), "label", "col_0")


@query
def parse_timestamp(spark, sf_dir):
    texts = F.array(F.date_format("ts", shape.SEND_FORMAT), F.col("event_type"))
    rows = adapter.events(spark, sf_dir).select("event_id", F.posexplode(texts).alias("place", "send_timestamp"))
    return decode.parse_send_timestamp(rows).select("event_id", "place", _sent("ts"))


@query
def select_prefix(spark, sf_dir):
    return shape.select_prefix(adapter.samples(spark, sf_dir), "col_", keep=["event_id"])


@query
def conform_columns(spark, sf_dir):
    rows = adapter.samples(spark, sf_dir).drop("col_1")
    rows = rows.select(*reversed(rows.columns))
    fixed = shape.conform(decode.parse_send_timestamp(rows), keep=["event_id"])
    return fixed.select("event_id", _sent(), *_keys(), "label", "col_0", "col_1", "col_2")


@query
def sniff_number(spark, sf_dir):
    texts = F.array(
        F.struct(F.lit("k").alias("field"), F.get_json_object("props", "$.k").alias("text")),
        F.struct(F.lit("value").alias("field"), F.format_string("%.2f", "value").alias("text")),
        F.struct(F.lit("type").alias("field"), F.col("event_type").alias("text")),
    )
    rows = adapter.events(spark, sf_dir).select("event_id", F.inline(texts))
    return shape.sniff_number(rows, "text", keep=["event_id", "field"])


@query
def parse_fields(spark, sf_dir):
    rows = adapter.samples(spark, sf_dir)
    texts = rows.select(
        "event_id",
        *[F.col(name).cast("string").alias(name) for name in (*KEY, *FEATURES)],
        F.col("label").cast("int").cast("string").alias("label"),
    )
    return shape.parse_fields(texts, keep=["event_id"]).select("event_id", *_keys(), "label", "col_0", "col_37")


@query
def tag_split(spark, sf_dir):
    rows = shape.tag_split(adapter.samples(spark, sf_dir), "train")
    return rows.select("event_id", F.col("usage").alias("split"), "label")


@query
def stamp_send_time(spark, sf_dir):
    rows = shape.stamp_send_time(adapter.samples(spark, sf_dir), "2024-02-01 12:00:00.5")
    return rows.select("event_id", F.col("send_timestamp").alias("send_text"))


@query
def encode_decode_roundtrip(spark, sf_dir):
    fields = message_fields("send_timestamp", "col_0", "col_1", "col_37")
    rows = decode.decode_strict(adapter.messages(spark, sf_dir), fields, keep=["offset"])
    return rows.select(
        F.col("offset").alias("event_id"), F.col("send_timestamp").alias("send_text"), "col_0", "col_1", "col_37"
    )


@query
def rename_features(spark, sf_dir):
    rows = shape.rename_features(adapter.samples(spark, sf_dir))
    return rows.select("event_id", *shape.NAME_OF.values())


@query
def feature_group_select(spark, sf_dir):
    return shape.select_group(adapter.samples(spark, sf_dir), "disk_io", keep=["event_id"])


@query
def feature_catalog_stats(spark, sf_dir):
    stats = catalog.catalog_stats(adapter.samples(spark, sf_dir))
    return stats.withColumn("mean", F.round("mean", 6))


@query
def fill_missing(spark, sf_dir):
    rows = adapter.samples(spark, sf_dir, keep=["event_id", "event_type"])
    holed = rows.withColumn(
        "col_0",
        F.when(F.col("event_type") == "error", F.lit(None))
        .when(F.col("event_type") == "view", F.lit(float("nan")))
        .otherwise(F.col("col_0")),
    )
    return shape.fill_missing(holed).select("event_id", "col_0")


# Filters


@query
def filter_recent(spark, sf_dir):
    rows = decode.decode_strict(adapter.messages(spark, sf_dir), message_fields("send_timestamp"), keep=["offset"])
    kept = filters.recent(rows, adapter.latest_time(spark, sf_dir), DAYS)
    return kept.select(F.col("offset").alias("event_id"))


@query
def filter_split(spark, sf_dir):
    return filters.only_split(adapter.samples(spark, sf_dir)).select("event_id", F.col("usage").alias("split"))


@query
def quarantine_rows(spark, sf_dir):
    rows = decode.decode_strict(adapter.all_messages(spark, sf_dir), message_fields(*KEY), keep=ARRIVAL)
    return filters.split_valid(rows)[1].select(_kind(), _source_id(), "reason")


@query
def empty_input(spark, sf_dir):
    later = adapter.latest_time(spark, sf_dir) + F.make_dt_interval(days=F.lit(2))
    rows = first_wins(jobs.recent_samples(adapter.messages(spark, sf_dir), later, 1))
    return rows.agg(F.count("*").alias("n"))


@query
def metric_label_match(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.LAG])
    found = filters.match_labels(
        samples, equals={"metric": metric_source.LAG, "consumergroup": "g1"}, regex={"topic": "click|view"}
    )
    return found.select("event_id", "topic", "part", "consumergroup", "value")


# Conflict joins, deduplication, counts


@query
def conflict_anti_join(spark, sf_dir):
    target = _earlier_table(spark, sf_dir, "target").read()
    rows = merge.not_in_target(adapter.samples(spark, sf_dir), target)
    return rows.select(*_keys(), "event_id")


@query
def conflict_semi_join(spark, sf_dir):
    target = _earlier_table(spark, sf_dir, "target").read()
    rows = merge.ignored_rows(adapter.samples(spark, sf_dir), target)
    return rows.select(*_keys(), "event_id")


@query
def dedup_first_wins(spark, sf_dir):
    fields = message_fields(*KEY, "col_0")
    rows = first_wins(decode.decode_strict(adapter.messages(spark, sf_dir), fields, keep=ARRIVAL))
    return rows.select(*_keys(), F.col("offset").alias("event_id"), "col_0")


@query
def stage_counts(spark, sf_dir):
    rows = decode.parse_send_timestamp(adapter.samples(spark, sf_dir))
    since = filters.cutoff(adapter.latest_time(spark, sf_dir), DAYS)
    return counts.stage_counts(
        rows, {"loaded": None, "recent": F.col("send_timestamp") >= since, "train": F.col("usage") == "train"}
    )


@query
def load_rate_by_day(spark, sf_dir):
    rates = counts.load_rate(adapter.samples(spark, sf_dir))
    return rates.select(F.col("timestamp").alias("tick"), "n", F.round("rows_per_s", 9).alias("rows_per_s"))


# Streaming merges


@query
def stream_merge(spark, sf_dir):
    table, topic, checkpoint = _table(spark, "streamed"), _topic(spark, "topic"), _checkpoint(spark)
    for segment in adapter.segments(spark, sf_dir):
        topic.write(segment)
        jobs.stream_ingest(topic.read_stream(), table, checkpoint).awaitTermination()
    return _stored(table)


@query
def stream_merge_chunked(spark, sf_dir):
    table, topic = _table(spark, "chunked"), _topic(spark, "topic")
    messages = adapter.messages(spark, sf_dir)
    times = 1 + messages.count() // MANY
    topic.write(messages, FILES * times)
    jobs.consume_merge(topic.read_group(max_files=CHUNK * times), table, _checkpoint(spark)).awaitTermination()
    return table.read().select(*_keys())


@query
def stream_dedup_watermark(spark, sf_dir):
    topic, out = _filled_topic(spark, adapter.messages(spark, sf_dir)), scratch(spark, "distinct")
    fields = message_fields(*KEY, "send_timestamp")
    samples = decode.parse_send_timestamp(decode.decode_strict(topic.read_stream(), fields))
    keys = ingest.dedup_stream(samples, "send_timestamp", "31 days").select(*_keys())
    ingest.append_stream(keys, out, _checkpoint(spark)).awaitTermination()
    return spark.read.schema(keys.schema).parquet(out)


@query
def stream_batch_counts(spark, sf_dir):
    table, topic, checkpoint = _table(spark, "counted"), _topic(spark, "topic"), _checkpoint(spark)
    counted = scratch(spark, "counts")
    for segment in adapter.segments(spark, sf_dir):
        topic.write(segment)
        jobs.stream_ingest(topic.read_stream(), table, checkpoint, counts=counted).awaitTermination()
    return spark.read.schema("batch long, n long").parquet(f"{counted}/*/*")


@query
def stream_quarantine(spark, sf_dir):
    table, bad = _table(spark, "cleaned"), scratch(spark, "quarantine")
    topic = _filled_topic(spark, adapter.all_messages(spark, sf_dir))
    jobs.stream_ingest(topic.read_stream(), table, _checkpoint(spark), quarantine=bad).awaitTermination()
    rows = spark.read.schema("partition int, offset long, reason string").parquet(f"{bad}/*/*")
    return rows.select(_kind(), _source_id(), "reason")


# Metric queries


def _newest(spark, sf_dir):
    """The moment of the newest event, and how far to look back from there."""
    moment = adapter.events(spark, sf_dir).agg(F.max("ts")).first()[0]
    return {"as_of": moment, "lookback": LOOKBACK, "order": ["ts", "event_id"]}


@query
def latest_by_series(spark, sf_dir):
    return metrics.latest_per_series(adapter.metric_samples(spark, sf_dir), **_newest(spark, sf_dir))


@query
def latest_gauges(spark, sf_dir):
    wanted = [metric_source.BROKERS, metric_source.MEMBERS]
    samples = adapter.metric_samples(spark, sf_dir, wanted)
    return metrics.latest_gauges(samples, wanted, series=["metric", "consumergroup"], **_newest(spark, sf_dir))


@query
def lag_by_group(spark, sf_dir):
    return metrics.lag_by_group(adapter.metric_samples(spark, sf_dir, [metric_source.LAG]), **_newest(spark, sf_dir))


@query
def lag_by_group_topic(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.LAG])
    return metrics.lag_by_group_topic(samples, **_newest(spark, sf_dir))


@query
def under_replicated_by_topic(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.UNDER_REPLICATED])
    return metrics.under_replicated(samples, **_newest(spark, sf_dir))


@query
def counter_rate(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.OFFSET])
    rates = metrics.counter_rate(samples, window="6 hours", order=["ts", "event_id"])
    return rates.withColumn("rate", F.round("rate", 9))


@query
def topic_rate(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.OFFSET])
    rates = metrics.topic_rate(samples, window="6 hours", order=["ts", "event_id"])
    return rates.withColumn("rate", F.round("rate", 9))


@query
def alert_rows(spark, sf_dir):
    rules = [
        ("lag", metric_source.LAG, "consumergroup", lambda total: total >= 500),
        ("high lag", metric_source.LAG, "consumergroup", lambda total: total >= 1500),
        ("under_replicated", metric_source.UNDER_REPLICATED, "topic", lambda total: total > 0),
    ]
    samples = adapter.metric_samples(spark, sf_dir, sorted({metric for _, metric, _, _ in rules}))
    return metrics.alert_rows(samples, rules, **_newest(spark, sf_dir))


# The same over a grid of steps

# A step of the grid, and the sliding window of a rate.
STEP, WINDOW = "2 hours", "5 hours"


def _grid(spark, sf_dir):
    """Steps from the first event to the last."""
    first, last = adapter.events(spark, sf_dir).agg(F.min("ts"), F.max("ts")).first()
    return grids.Grid(first, last, STEP)


_NEWEST = {"lookback": LOOKBACK, "order": ["ts", "event_id"]}


@query
def latest_by_series_steps(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.UNDER_REPLICATED, metric_source.MEMBERS])
    return grids.latest_steps(samples, _grid(spark, sf_dir), **_NEWEST)


@query
def lag_by_group_steps(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.LAG])
    return grids.lag_by_group_steps(samples, _grid(spark, sf_dir), **_NEWEST)


@query
def alert_steps(spark, sf_dir):
    rules = [
        ("lag", metric_source.LAG, "consumergroup", lambda total: total >= 3000),
        ("high lag", metric_source.LAG, "consumergroup", lambda total: total >= 4000),
        ("under_replicated", metric_source.UNDER_REPLICATED, "topic", lambda total: total > 0),
    ]
    samples = adapter.metric_samples(spark, sf_dir, sorted({metric for _, metric, _, _ in rules}))
    return grids.alert_steps(samples, rules, _grid(spark, sf_dir), **_NEWEST)


@query
def counter_rate_steps(spark, sf_dir):
    samples = adapter.metric_samples(spark, sf_dir, [metric_source.OFFSET])
    rates = grids.counter_rate_steps(samples, _grid(spark, sf_dir), window=WINDOW, order=["ts", "event_id"])
    return rates.withColumn("rate", F.round("rate", 9))


# Feature analysis


def _embeddings(spark, sf_dir):
    """(names of the dimensions, a column for each); vectors of unequal length are refused."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    low, high = rows.agg(F.min(F.size("embedding")), F.max(F.size("embedding"))).first()
    if low != high:
        raise ValueError(f"embeddings of {low} to {high} dimensions")
    names = [f"d{i}" for i in range(high)]
    return names, rows.selectExpr("label", *[f"get(embedding, {i}) AS {name}" for i, name in enumerate(names)])


@query
def pca_loadings(spark, sf_dir):
    names, rows = _embeddings(spark, sf_dir)
    loadings = features.top_k(features.pca_loadings(rows, names, k=10), "importance", 10, tie=["feature"])
    return loadings.withColumn("importance", F.round("importance", 6))


@query
def mutual_information(spark, sf_dir):
    names, rows = _embeddings(spark, sf_dir)
    return features.mutual_information(rows, names, bins=4).withColumn("mi", F.round("mi", 9))


@query
def neighbour_information(spark, sf_dir):
    names, rows = _embeddings(spark, sf_dir)
    return near_information(rows, names).withColumn("mi", F.round("mi", 9))


@query
def topk_features(spark, sf_dir):
    means = adapter.samples(spark, sf_dir).groupBy("machine").agg(F.avg("col_0").alias("mean"))
    return features.top_k(means, "mean", 10, tie=["machine"]).withColumn("mean", F.round("mean", 6))


# Files


@query
def file_order(spark, sf_dir):
    path = scratch(spark, "ordered")
    rows = adapter.samples(spark, sf_dir, keep=["event_id", "event_type"])
    (
        rows.select("machine", "timestamp", "event_id", "event_type")
        .repartitionByRange("event_id")
        .sortWithinPartitions("event_type", "event_id")
        .write.partitionBy("event_type")
        .option("header", True)
        .csv(path)
    )
    lines = files.read_csv(spark, path, "machine string, timestamp string, event_id long", "event_type=*")
    kept = first_wins(files.file_order(lines), ["machine", "timestamp"], files.FILE_ORDER)
    return kept.select("machine", F.col("timestamp").alias("tick"), "event_id")


@query
def scan_csv_by_name(spark, sf_dir):
    path = _machine_files(spark, sf_dir, "test")
    rows = files.read_csv_by_name(spark, path, "*/machine=machine-*")
    return files.staged(rows.select("machine", F.col("timestamp").alias("tick"), "label", "col_0", "col_37"))


@query
def union_splits(spark, sf_dir):
    rows = files.union_splits(_train_files(spark, sf_dir), _test_files(spark, sf_dir))
    return files.staged(rows.select("machine", F.col("timestamp").alias("tick"), F.col("usage").alias("split"), "label", "col_0"))


# Whole pipelines


@query
def job_backfill_append(spark, sf_dir):
    latest = adapter.latest_time(spark, sf_dir)
    topic = _filled_topic(spark, adapter.messages(spark, sf_dir))
    return _stored(jobs.backfill_append(topic.read(), _table(spark, "backfill"), latest, DAYS, selective=True))


@query
def job_backfill_merge(spark, sf_dir):
    table, bad = _earlier_table(spark, sf_dir, "backfill"), scratch(spark, "quarantine")
    topic = _filled_topic(spark, adapter.all_messages(spark, sf_dir))
    jobs.backfill_merge(topic.read(), table, adapter.latest_time(spark, sf_dir), DAYS, True, bad)
    return _stored(table)


@query
def job_backfill_quarantine(spark, sf_dir):
    table, bad = _table(spark, "backfill"), scratch(spark, "quarantine")
    topic = _filled_topic(spark, adapter.all_messages(spark, sf_dir))
    jobs.backfill_append(topic.read(), table, adapter.latest_time(spark, sf_dir), DAYS, True, bad)
    return spark.read.parquet(bad).select(_kind(), _source_id(), "reason")


@query
def job_stream_ingest(spark, sf_dir):
    table, topic = _table(spark, "ingested"), _filled_topic(spark, adapter.all_messages(spark, sf_dir))
    jobs.stream_ingest(topic.read_stream(), table, _checkpoint(spark)).awaitTermination()
    return _stored(table)


@query
def job_consume_merge(spark, sf_dir):
    table, topic = _table(spark, "consumed"), _filled_topic(spark, adapter.all_messages(spark, sf_dir))
    jobs.consume_merge(topic.read_group(), table, _checkpoint(spark)).awaitTermination()
    return table.read().select(*_keys(), _sent(), "label")


def _job_export(spark, sf_dir, fmt):
    table = _table(spark, "lake")
    table.append(_samples(spark, sf_dir))
    latest = adapter.events(spark, sf_dir).agg(F.max("ts")).first()[0]
    path = jobs.export_split(table.read(), scratch(spark, "exports"), latest, DAYS, fmt=fmt)
    return exports.read_export(spark, path, fmt).select(*_keys(), _sent(), "col_0")


@query
def job_export_train(spark, sf_dir):
    return _job_export(spark, sf_dir, "parquet")


@query
def job_export_train_csv(spark, sf_dir):
    return _job_export(spark, sf_dir, "csv")


def _ordered_files(spark, sf_dir, split, kinds=None):
    """Sample files whose lines, taken by path and place, are in event order within a machine.

    Files are cut by range, so a machine's files are of unlike size.
    """
    path = scratch(spark, f"csv-{split}")
    rows = filters.only_split(adapter.samples(spark, sf_dir, keep=["event_id", "event_type"]), split)
    if kinds:
        rows = rows.filter(F.col("event_type").isin(*kinds))
    rows = shape.conform(rows, files.CSV_SCHEMA, keep=["machine", "event_id"]).repartitionByRange("machine", "event_id")
    files.write_folders(rows, path, order=["event_id"], apart=True)
    return path


@query
def job_csv_to_topic(spark, sf_dir):
    topic = _topic(spark, "topic")
    for kinds in (adapter.EARLIER, None):
        path = _ordered_files(spark, sf_dir, "train", kinds)
        rows = files.read_train_csv(spark, path, pattern="*/machine=machine-*", many=True)
        jobs.csv_to_topic(rows, topic, "2024-02-01 00:00:00")
    rows = decode.decode_strict(topic.read(), message_fields(*KEY, "label", "col_0"), keep=ARRIVAL)
    return first_wins(rows).select(*_keys(), "label", "col_0")


@query
def job_csv_to_table(spark, sf_dir):
    """All train files, whose keys are repeated, stop at their conflicts; the first of each key load."""
    table = _table(spark, "direct")
    rows = files.staged(files.read_train_csv(spark, _ordered_files(spark, sf_dir, "train"), pattern="*/machine=machine-*", many=True))
    try:
        jobs.csv_to_table(rows, table, "2024-02-01 00:00:00")
    except merge.DuplicateKeyError:
        jobs.csv_to_table(first_wins(rows, order=files.FILE_ORDER), table, "2024-02-01 00:00:00")
    return _stored(table)


@query
def job_csv_conflicts(spark, sf_dir):
    """What a second load of the same files would stop at."""
    table = _table(spark, "direct")
    rows = files.staged(files.read_train_csv(spark, _ordered_files(spark, sf_dir, "train"), pattern="*/machine=machine-*", many=True))
    jobs.csv_to_table(first_wins(rows, order=files.FILE_ORDER), table, "2024-02-01 00:00:00")
    return merge.conflicts(rows, table.read()).select(*_keys(), "n", "in_target")


@query
def job_csv_quarantine(spark, sf_dir):
    """Lines with text that is no number are set aside; the metric of every error event is damaged."""
    path, bad = scratch(spark, "csv-damaged"), scratch(spark, "quarantine")
    rows = adapter.samples(spark, sf_dir, keep=["event_id", "event_type"])
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("bad-"), "event_id")).otherwise(F.col("col_0").cast("string"))
    wide = rows.withColumns({"label": F.col("label").cast("int"), "col_0": text}).select("machine", *files.CSV_SCHEMA.names)
    files.write_machine_files(wide, path, apart=True)
    read = files.read_test_csv(spark, path, "machine=machine-*", pattern="*/{machine}", corrupt="_line")
    jobs.csv_to_table(read.dropDuplicates([*KEY, "_line"]), _table(spark, "direct"), "2024-02-01 00:00:00", bad, "_line")
    return spark.read.parquet(f"{bad}/lines").select("machine", F.col("timestamp").alias("tick"), F.split("_line", ",")[2].alias("text"))


@query
def machine_of_any_folder(spark, sf_dir):
    """Test files whose folders are named after regions, without the usual prefix."""
    path = scratch(spark, "csv-named")
    rows = filters.only_split(adapter.samples(spark, sf_dir), "test").withColumn("machine", F.concat(F.lit("db "), F.substring("machine", 9, 99)))
    files.write_machine_csv(rows, path, apart=True)
    read = files.read_test_csv(spark, path, "machine=*", pattern="*/{machine}", many=True)
    return files.staged(read.select("machine", F.col("timestamp").alias("tick"), "label", "col_0"))


@query
def scan_csv_headers(spark, sf_dir):
    """Two folders of files with different headers; a column that is not declared is sniffed."""
    rows, paths = adapter.samples(spark, sf_dir, keep=["event_type"]).withColumn("label", F.col("label").cast("int")), []
    for split, columns in (("train", ["timestamp", "col_1", "event_type"]), ("test", ["label", "timestamp", "col_0"])):
        paths.append(scratch(spark, f"csv-{split}"))
        named = filters.only_split(rows, split).select("machine", *columns)
        files.write_machine_files(named, paths[-1], apart=True)
    read = files.read_csv_folders(spark, paths, "*/machine=machine-*")
    read = files.sniff_unknown(read, [*KEY, "label", *FEATURES])
    return files.staged(read.select("machine", F.col("timestamp").alias("tick"), "label", "col_0", "col_1", F.col("event_type.kind").alias("kind"), F.col("event_type.text").alias("text")))


@query
def job_load_rate(spark, sf_dir):
    """Whether a counted and timed load stored what it counted: A3 and F7 in one job."""
    table = _table(spark, "timed")
    rate = jobs.timed_load(_samples(spark, sf_dir), table.append)
    return _stored(table).where(F.lit(rate > 0))


@query
def job_feature_rank(spark, sf_dir):
    information = jobs.rank_features(adapter.samples(spark, sf_dir))
    return information.withColumn("mi", F.round("mi", 9))


@query
def job_feature_rank_neighbours(spark, sf_dir):
    information = jobs.rank_features(adapter.samples(spark, sf_dir), "neighbours")
    return information.withColumn("mi", F.round("mi", 9))


@query
def job_feature_rank_component(spark, sf_dir):
    ranked = jobs.rank_features(adapter.samples(spark, sf_dir), "component")
    return ranked.withColumn("importance", F.round("importance", 6))


@query
def stream_recent(spark, sf_dir):
    """A stream that is limited to recent messages (T8)."""
    table, topic = _table(spark, "recent"), _filled_topic(spark, adapter.messages(spark, sf_dir))
    since = adapter.events(spark, sf_dir).agg(F.max("ts")).first()[0]
    jobs.stream_ingest(topic.read_stream(), table, _checkpoint(spark), as_of=since, days=DAYS).awaitTermination()
    return _stored(table)
