"""Training-set exports and previews."""

from pyspark.sql import functions as F

from fleetlake.schema import TABLE_SCHEMA


# Keeps all six digits of a second; the writer's default would cut three.
CSV_TIMES = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def export_path(base, as_of):
    """The directory of one export run; ``as_of`` is a datetime."""
    return f"{base}/export_{as_of:%Y%m%d_%H%M%S}"


def export(df, path, fmt="csv", rebalance=False, max_rows=None):
    """Write a directory of CSV (with header) or Parquet files, replacing what is there.

    ``rebalance`` evens out file sizes with one more shuffle; worth it when a filter
    left little of many scan tasks. No file has more than ``max_rows`` rows.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown export format: {fmt!r}")
    writer = (df.hint("rebalance") if rebalance else df).write.mode("overwrite")
    if max_rows:
        writer = writer.option("maxRecordsPerFile", max_rows)
    if fmt == "csv":
        writer.option("header", True).option("timestampFormat", CSV_TIMES).csv(path)
    else:
        writer.parquet(path)
    return path


def read_export(spark, path, fmt="csv", schema=TABLE_SCHEMA):
    """An export read back: its directory, or a list of its files."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("timestampFormat", CSV_TIMES).csv(path)
    return reader.parquet(*path if isinstance(path, list) else [path])


def preview(df, n=10, order=()):
    """The first ``n`` rows, by ``order`` where given so that they are always the same."""
    return (df.orderBy(*[F.col(name) for name in order]) if order else df).limit(n)
