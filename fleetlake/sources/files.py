"""Sample files: CSV with a header, one directory per machine."""

import os
import re
from functools import reduce
from itertools import groupby
from operator import itemgetter

from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.shape import conform, machine_from_path, parse_fields, sniffed_number, tag_split
from fleetlake.schema import CSV_SCHEMA
from fleetlake.session import ROW_OVERHEAD, broadcast_limit, drop_scratch, few_listing_tasks, local_path, packed_files, scratch

TRAIN_PATTERN = "machine-*/*_train.csv"
TEST_PATTERN = "{machine}/*_test.csv"

# Characters of a parser's buffer, which is allotted anew for every file; longer lines fill it several times.
BUFFER = 64 * 1024

# Bytes of a file that is taken whole, as one row that is cut into lines, where very many files are read.
SMALL = 1 << 20

# Fixed value: what Spark's reader takes for blank in a line that holds nothing else.
BLANKS = "".join(map(chr, range(33)))

# Names of compressed files, which Spark's reader unpacks.
PACKED = r"\.(gz|gzip|bz2|deflate|snappy|lz4|zst|zstd|xz|lzo)$"

# How Spark's partition layout names a missing value, and the characters that it escapes.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def read_csv(spark, path, schema=CSV_SCHEMA, pattern=None, mode="PERMISSIVE", corrupt=None, many=False):
    """CSV files below ``path`` whose place matches ``pattern``.

    Columns are taken by place, and a header with other names is an error. PERMISSIVE turns
    unreadable text into NULL (and keeps the line in the column ``corrupt`` when named),
    FAILFAST raises. Files of which there are very ``many`` are read by ``_small_files``,
    but where broken lines are asked for: Spark's reader judges a line by the columns that are used.
    """
    reader, place = _reader(spark).option("mode", mode), f"{path}/{pattern}" if pattern else path
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    with few_listing_tasks(spark):
        if many and not corrupt and mode == "PERMISSIVE":
            return _small_files(spark, place, schema)
        return reader.schema(schema).csv(place)


def _small_files(spark, place, schema):
    """The same rows of very many files, and ``_metadata`` as a column, with a file's path and the start of its range.

    To open a file as text costs Spark's reader more than a thousand short lines do. So files of up to ``SMALL`` bytes are taken whole,
    cut into lines where the reader cuts them, and parsed by the same parser; what is larger or compressed is left to the reader.
    """
    found = spark.read.format("binaryFile").load(place)
    small = (F.col("length") <= SMALL) & ~F.lower("path").rlike(PACKED)
    text = F.expr("cast(if(startswith(content, X'EFBBBF'), substring(content, 4), content) AS string)")
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    meta = F.struct(F.col("_metadata.file_path").alias("file_path"), F.lit(0).cast("long").alias("file_block_start"))
    # An outer generator: for others the optimizer makes a filter, which would cut every file a second time.
    cut = found.where(small).select(meta.alias("_metadata"), F.posexplode_outer(lines).alias("_place", "_line"))

    # A header that is not spelled just as the schema is parsed, and asked for one name more, which has to be missing.
    names = F.from_csv("_line", ", ".join(f"_{i} string" for i in range(len(schema) + 1)))
    same = (lambda name: name) if spark.conf.get("spark.sql.caseSensitive") == "true" else F.lower
    read = F.transform(F.array(*[names[f"_{i}"] for i in range(len(schema) + 1)]), same)
    fits = read.eqNullSafe(F.array(*[same(F.lit(name)) for name in schema.names], F.lit(None).cast("string")))
    refused = F.raise_error(F.concat(F.lit("the CSV header does not conform to the schema: "), F.col("_metadata.file_path")))
    wanted = F.when(F.col("_line").isNull(), False).when(F.col("_place") > 0, True)
    wanted = wanted.when(F.col("_line") == ",".join(schema.names), False).when(fits, False).otherwise(refused.cast("boolean"))

    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    rows = cut.where(wanted).select("_metadata", F.from_csv("_line", ddl).alias("_fields")).select("_metadata", "_fields.*")
    with packed_files(spark):
        if not found.where(~small).limit(1).count():
            return rows
    reader = _reader(spark).schema(schema)
    meta = F.struct(*[F.col(f"_metadata.{name}").alias(name) for name in ("file_path", "file_block_start")])
    large = (F.col("_metadata.file_size") > SMALL) | F.lower("_metadata.file_path").rlike(PACKED)
    return rows.unionByName(reader.csv(place).where(large).select(meta.alias("_metadata"), *schema.names))


def _reader(spark):
    return spark.read.options(header=True, enforceSchema=False, inputBufferSize=BUFFER)


def read_csv_by_name(spark, path, pattern=None):
    """CSV files whose header decides what a column is.

    Known columns are typed, unreadable text in them becomes NULL; unknown columns are kept as
    text for ``sniff_number``, or typed by it with ``sniff_unknown``. All files must have the header of the first;
    see ``read_csv_folders`` for others.
    """
    with few_listing_tasks(spark):
        rows = _reader(spark).csv(f"{path}/{pattern}" if pattern else path)
    return machine_from_path(rows).transform(parse_fields)


def sniff_unknown(df, known):
    """Columns beyond ``known`` as structs of ``kind`` (float, int or string), ``num`` and ``text``."""
    sniffed = {}
    for name in [name for name in df.columns if name not in known]:
        kind, num = sniffed_number(F.col(name))
        sniffed[name] = F.struct(kind.alias("kind"), num.alias("num"), F.col(name).alias("text"))
    return df.withColumns(sniffed) if sniffed else df


def read_csv_folders(spark, paths, pattern=None):
    """Files of several folders, each with a header of its own, matched by column name; a missing column is NULL.

    Only the headers are read while the frame is built, one per folder.
    """
    return union_splits(*[read_csv_by_name(spark, path, pattern) for path in paths])


def read_train_csv(spark, base, pattern=TRAIN_PATTERN, **options):
    """The train samples of all machines, with their reading order (see ``file_order``)."""
    return tag_split(machine_from_path(file_order(read_csv(spark, base, pattern=pattern, **options))), "train").drop("_metadata")


def read_test_csv(spark, base, machine, pattern=TEST_PATTERN, **options):
    """The test samples of one machine, or of several with a wildcard."""
    rows = read_csv(spark, base, pattern=pattern.format(machine=machine), **options)
    return tag_split(machine_from_path(rows), "test").drop("_metadata")


def file_order(df):
    """Reading order of file rows: files by path, rows by their place in the file.

    Gives ``_path``, ``_block`` and ``_row``. No global numbering is needed: a scan task
    reads a file range front to back, and row ids grow within a task.
    """
    return df.withColumns(
        {
            "_path": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


FILE_ORDER = ["_path", "_block", "_row"]

# File ranges as ``numbered`` keeps them: the first row's id, how many numbers it takes, the task that held it.
RANGES = "_path string, _block long, _first long, _width long, _part int"


def staged(df):
    """The rows of a frame that reads files, which are read once, into a staging folder."""
    spark, path = df.sparkSession, scratch(df.sparkSession, "read-files")
    with packed_files(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df, name="arrival", start=0):
    """Rows of ``file_order`` numbered from ``start`` in reading order; its columns go.

    A row's place in the file range that its task read is the distance to the range's first row, and a range takes as many numbers as
    lie between its first and last row. So numbers are unique and in order, with gaps where rows were filtered out. The files
    are read once, into a staging folder. Only the ranges, a few numbers for each, are put in order and added up, in tasks that hold
    some of them each and then over those tasks; they are handed to the rows' tasks if they measure below the session's broadcast
    threshold, and merged in by range otherwise.
    """
    spark = df.sparkSession
    df = staged(df)
    row = F.col("_row")
    ranges = df.groupBy("_path", "_block").agg(F.min(row).alias("_first"), (F.max(row) - F.min(row) + 1).alias("_width"))
    path = scratch(spark, "file-ranges")
    ranges.repartitionByRange("_path", "_block").withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.schema(RANGES).parquet(path)
    parts = ranges.groupBy("_part").agg(F.sum("_width").alias("_sum"))
    parts = parts.select("_part", _sum_before("_sum", Window.orderBy("_part")).alias("_earlier"))
    before = F.col("_earlier") + _sum_before("_width", Window.partitionBy("_part").orderBy("_path", "_block"))
    placed = ranges.join(F.broadcast(parts), "_part").select("_path", "_block", "_first", before.alias("_before"))
    size = ranges.agg(F.sum(F.octet_length("_path") + F.lit(ROW_OVERHEAD))).first()[0] or 0
    placed = F.broadcast(placed) if size <= broadcast_limit(spark) else placed.hint("merge")
    number = F.lit(start) + F.col("_before") + F.col("_row") - F.col("_first")
    return df.join(placed, ["_path", "_block"]).withColumn(name, number).drop("_first", "_before", *FILE_ORDER)


def _sum_before(name, window):
    """The sum of a column over all earlier rows of a window."""
    return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def union_splits(*frames):
    """All rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_machine_csv(df, path, apart=False):
    """Write raw sample files below one directory per machine (``machine=<name>``)."""
    write_machine_files(conform(df, CSV_SCHEMA, keep=["machine"]), path, apart)


def write_machine_files(df, path, apart=False):
    """Write whatever columns a frame has besides ``machine`` below one directory per machine, replacing what was there.

    Range partitions are cut by row count: a task gets some whole machines, and so few files are
    opened, while a machine with very many rows is cut into several tasks, by tick and, where
    one tick has very many, at random. ``apart`` as in ``write_folders``.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn("_cut", F.rand(seed=1)).repartitionByRange(tasks, "machine", "timestamp", "_cut")
    write_folders(cut.drop("_cut"), path, apart=apart)


def write_folders(df, path, order=(), by="machine", apart=False):
    """CSV files with a header in one directory per value of ``by``, as Spark's partition layout names it, replacing what was there.

    Every task writes one file for each value that it holds, with the rows by ``order``, whose columns are not written; files are
    numbered as the partitions of ``df``. Hadoop's local file system starts a process for the mode of each folder and file that it
    creates, which takes far longer than its rows. So on a mounted file system the tasks themselves write the lines that Spark
    formats; a file gets its name when it is whole, and the same name if its task is repeated. Elsewhere Spark's writer does it.

    A file system makes the folders within one folder one after the other, whoever asks. For very many values, ``apart`` gives each task
    a folder of its own (``task=<partition>``) that holds its values' folders; they are read by a pattern that begins with ``*/``.
    """
    names = [name for name in df.columns if name not in (by, *order)]
    place, spark = local_path(df.sparkSession, path), df.sparkSession
    if place is None:
        folders = {"task": F.format_string("%08d", F.spark_partition_id())} if apart else {}
        rows = df.withColumns(folders) if apart else df
        rows = rows.sortWithinPartitions(by, *order).select(*folders, by, *names)
        rows.write.mode("overwrite").option("header", True).partitionBy(*folders, by).csv(path)
        return
    drop_scratch(spark, path)
    os.makedirs(place)
    header = spark.range(1).select(F.to_csv(F.struct(*[F.lit(name).alias(name) for name in names]))).first()[0]
    folder = F.coalesce(F.nullif(F.col(by).cast("string"), F.lit("")), F.lit(NO_VALUE))
    lines = (
        df.withColumn("_folder", folder)
        .sortWithinPartitions("_folder", *order)
        .select("_folder", F.to_csv(F.struct(*[F.col(name) for name in names])))
    )

    def save(batches):
        task = TaskContext.get()
        base = f"{place}/task={task.partitionId():08d}" if apart else place
        rows = (row for batch in batches for row in zip(*[column.to_pylist() for column in batch.columns]))
        for value, group in groupby(rows, itemgetter(0)):
            target = f"{base}/{by}={ESCAPED.sub(lambda found: f'%{ord(found[0]):02X}', value)}"
            os.makedirs(target, exist_ok=True)
            hidden = f"{target}/.{task.taskAttemptId()}.csv"
            with open(hidden, "w", encoding="utf-8", newline="") as out:
                out.write(f"{header}\n")
                out.writelines(f"{line}\n" for _, line in group)
            os.replace(hidden, f"{target}/part-{task.partitionId():08d}.csv")
        yield from ()

    lines.mapInArrow(save, "done long").write.format("noop").mode("overwrite").save()
