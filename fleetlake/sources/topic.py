"""Message topics: a broker through Spark's connector, or the same envelope kept in files."""

from pyspark.sql import functions as F

from fleetlake.schema import ENVELOPE_SCHEMA
from fleetlake.session import exists


class BrokerTopic:
    """A topic of a message broker, read and written with Spark's ``kafka`` source.

    ``options`` are connector options, e.g. ``kafka.security.protocol``. A task reads one
    topic partition; ``minPartitions`` splits a partition that holds most of the data.
    """

    def __init__(self, spark, servers, topic, **options):
        self.spark, self.topic = spark, topic
        self.options = {"kafka.bootstrap.servers": servers, **options}

    def batch_options(self, start="earliest", end="latest"):
        return {**self.options, "subscribe": self.topic, "startingOffsets": start, "endingOffsets": end}

    def stream_options(self, start="latest", max_messages=None):
        limit = {"maxOffsetsPerTrigger": str(max_messages)} if max_messages else {}
        return {**self.options, "subscribe": self.topic, "startingOffsets": start, **limit}

    def write_options(self):
        return {**self.options, "topic": self.topic, "kafka.acks": "all"}

    def read(self, start="earliest", end="latest"):
        return self.spark.read.format("kafka").options(**self.batch_options(start, end)).load()

    def read_stream(self, start="latest", max_messages=None):
        return self.spark.readStream.format("kafka").options(**self.stream_options(start, max_messages)).load()

    def read_group(self, max_messages=None):
        """From the first message on; the checkpoint of the query remembers the position."""
        return self.read_stream("earliest", max_messages)

    def next_offset(self):
        """The broker numbers what it is sent itself."""
        return 0

    def write(self, df):
        """Append messages with columns ``key`` and ``value``."""
        df.select("key", "value").write.format("kafka").options(**self.write_options()).save()


class FileTopic:
    """A topic whose envelopes are Parquet files in one folder.

    A stream takes whole files, oldest write first. All files of one ``write`` fall into
    one micro-batch unless ``max_files`` splits them; then, as with several broker
    partitions, messages of different files have no order among each other.
    """

    def __init__(self, spark, path):
        self.spark, self.path = spark, path

    def read(self):
        return self.spark.read.schema(ENVELOPE_SCHEMA).parquet(self.path)

    def read_stream(self, max_files=None):
        reader = self.spark.readStream.schema(ENVELOPE_SCHEMA)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path)

    read_group = read_stream

    def next_offset(self):
        """An offset above all that the topic holds."""
        if not exists(self.spark, self.path):
            return 0
        last = self.read().agg(F.max("offset")).first()[0]
        return 0 if last is None else last + 1

    def write(self, df, files=None):
        """Append envelopes; ``files`` spreads them evenly over that many files, whatever their keys."""
        df = df.select(*ENVELOPE_SCHEMA.names)
        if files:
            df = df.repartition(files, "offset")
        df.write.mode("append").parquet(self.path)
