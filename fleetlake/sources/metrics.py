"""Scraped samples of broker metrics."""

from pyspark.sql import types as T

# Metric names.
LAG = "kafka_consumergroup_lag"
OFFSET = "kafka_topic_partition_current_offset"
UNDER_REPLICATED = "kafka_topic_partition_under_replicated_partition"
BROKERS = "kafka_brokers"
MEMBERS = "kafka_consumergroup_members"

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("metric", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("consumergroup", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)


def metric_samples(spark, path, metrics=None):
    """Stored samples; ``metrics`` limits the scan to the named ones."""
    samples = spark.read.schema(METRIC_SCHEMA).parquet(path)
    return samples.filter(samples.metric.isin(*metrics)) if metrics else samples
