"""Helpers the operators share: stored intermediate tables, words of a text, groups in a stream, components."""

import functools

import pyarrow as pa
from pyspark.sql import functions as F

from fleetlake.session import scratch


def stored(frame, purpose):
    """The frame written once to the shared scratch folder and read again.

    This cuts the lineage: a lost executor costs a read of the files, never the work before them.
    """
    path = scratch(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs, *more):
    """doc_id as long, text as UTF-8 bytes, and the other columns named; anything else is left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)


@functools.cache
def word_table():
    """For bytes.translate: A-Z become a-z, other ASCII that is no letter or digit becomes a space."""
    keep = bytearray(b" " * 128 + bytes(range(128, 256)))
    for byte in b"0123456789abcdefghijklmnopqrstuvwxyz":
        keep[byte] = byte
    for byte in range(65, 91):
        keep[byte] = byte + 32
    return bytes(keep)


def alnum_words(text):
    """Lower-case words of a text in bytes: runs of ASCII letters, digits and any character beyond ASCII."""
    return text.translate(word_table()).split() if text else []


def space_words(text):
    """Lower-case words of a text in bytes, cut at ASCII white space."""
    return text.lower().split() if text else []


class Memo(dict):
    """A dictionary that fills itself from a function and starts anew at its bound, so a worker's memory stays bounded."""

    def __init__(self, make, bound=400_000):
        super().__init__()
        self.make, self.bound = make, bound

    def __missing__(self, key):
        if len(self) >= self.bound:
            self.clear()
        value = self[key] = self.make(key)
        return value


def map_batches(frame, function, schema):
    """mapInArrow for a function that takes a dict of Python lists and returns a dict of columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    spark_schema = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        for batch in batches:
            made = function({name: column.to_pylist() for name, column in zip(batch.schema.names, batch.columns)})
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[field.name], type=field.type) for field in arrow], schema=arrow
            )

    return frame.mapInArrow(run, spark_schema)


def sorted_groups(batches, key):
    """(key, pandas frame) for each run of equal keys in batches that come sorted by key."""
    import pandas as pd

    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(frame):
            continue
        keys = frame[key].to_numpy()
        starts = [0, *((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist()]
        for start, end in zip(starts, starts[1:]):
            yield keys[start], frame.iloc[start:end]
        rest = frame.iloc[starts[-1]:]
    if rest is not None and len(rest):
        yield rest[key].iloc[0], rest


def components(edges):
    """Connected components of undirected ``edges`` (a, b): one row (id, component) per node, the smallest id reachable.

    Alternates large-star and small-star steps, which need a number of rounds logarithmic in the
    longest path. Each step is a minimum per node, combined before the shuffle, and a join that
    adaptive execution splits where one node has many neighbours. Every round is stored.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")),
        )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = stored(small, "edges")
        now = edges.agg(F.count("u"), F.bit_xor(F.xxhash64("u", "v")), F.count_distinct("v")).first()
        if now == state:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = now
