import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fleetlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        zone="UTC",
        master="local[4]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__sources__parallelPartitionDiscovery__parallelism="4",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """A function from payload texts (or bytes) to envelopes with increasing offsets."""
    from pyspark.sql import functions as F

    from fleetlake.schema import ENVELOPE_SCHEMA

    def build(payloads, start=0):
        rows = [
            (b"k", text.encode() if isinstance(text, str) else text, "telemetry", 0, start + i, None, 0)
            for i, text in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, ENVELOPE_SCHEMA).withColumn("timestamp", F.current_timestamp())

    return build


@pytest.fixture
def samples(spark):
    """A function from (machine, tick, split, offset, col_0) to samples with arrival order."""
    from pyspark.sql import functions as F

    def build(rows):
        schema = "machine string, timestamp string, usage string, offset long, col_0 double"
        return spark.createDataFrame(rows, schema).select(
            "*",
            F.lit(0).alias("partition"),
            F.lit(0.0).alias("label"),
            F.timestamp_seconds(F.lit(1700000000) + F.col("offset")).alias("send_timestamp"),
        )

    return build
