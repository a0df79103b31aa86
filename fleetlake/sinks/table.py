"""Target tables keyed by machine, tick and split."""

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.shape import conform
from fleetlake.operators.dedup import first_wins
from fleetlake.operators.merge import DuplicateKeyError, KeyProfile, conflicts, new_rows
from fleetlake.schema import ARRIVAL, KEY, TABLE_SCHEMA
from fleetlake.session import claim, drop_scratch, list_folder, scratch
from fleetlake.sources.jdbc import read_jdbc_table

# The writer of jobs that run once.
LOADS = "loads"


class ConcurrentLoadError(RuntimeError):
    """Another load has claimed the same batch."""


class KeyedTable:
    """A Parquet table that never holds a key twice, one directory per writer and batch.

    A writer is a name whose batches are numbered: all one-off loads together, or one stream,
    which is named by the id in its checkpoint. Writing batch N looks at everything but that
    writer's batches from N on, and replaces directory N. So a batch that is run again after a
    failure gives the same rows, adds none, and cannot touch those of another writer.
    Only one batch may be written at a time: files cannot enforce a key. Two loads that pick the same
    number do not replace each other: the number is claimed by a file that only one of them can create.
    A row without a complete key fails the batch, which then writes nothing.
    """

    def __init__(self, spark, path, schema=TABLE_SCHEMA, key=tuple(KEY)):
        self.spark, self.path, self.schema, self.key = spark, path, schema, key

    def _folder(self, writer, batch_id):
        return f"{self.path}/writer={writer}/batch_id={batch_id}"

    def ensure(self):
        """Create the table if it does not exist; an existing one is left alone."""
        self.spark.createDataFrame([], self.schema).write.mode("ignore").parquet(self._folder(LOADS, -1))
        return self

    def read(self, before=None):
        """All rows, or with ``before=(writer, batch)`` all but that writer's batches from there on."""
        places = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType())]
        stored = T.StructType([*self.schema.fields, *places])
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(self.path)
        if before is not None:
            writer, batch_id = before
            rows = rows.filter((F.col("writer") != writer) | (F.col("batch_id") < batch_id))
        return rows.select(*self.schema.names)

    def next_batch(self, writer=LOADS):
        """A batch number above all that the writer has used."""
        names = list_folder(self.spark, f"{self.path}/writer={writer}")
        return max([int(name.split("=")[1]) for name in names if "=" in name], default=-1) + 1

    def release(self, batch_id, writer=LOADS):
        """Give up the claim on a batch that failed, so that the next load may take its number."""
        drop_scratch(self.spark, f"{self.path}/_claims/{writer}-{batch_id}")

    def _write(self, df, batch_id, writer):
        for name in self.key:
            refused = F.raise_error(F.lit(f"a row without {name} cannot be stored"))
            df = df.withColumn(name, F.when(F.col(name).isNull(), refused).otherwise(F.col(name)))
        df.write.mode("overwrite").parquet(self._folder(writer, batch_id))
        return batch_id

    def append(self, df, batch_id=None, writer=LOADS):
        """Add rows as they are; the caller vouches for the key."""
        with self._claimed(batch_id, writer) as batch:
            return self._write(conform(df, self.schema), batch, writer)

    @contextmanager
    def _claimed(self, batch_id, writer):
        """The batch's number; a new one is claimed, and given up again if the batch fails."""
        if batch_id is not None:
            yield batch_id
            return
        batch = self.next_batch(writer)
        if not claim(self.spark, f"{self.path}/_claims/{writer}-{batch}"):
            raise ConcurrentLoadError(f"batch {batch} of {writer} is claimed by a load at work, or by one whose driver was lost: see release")
        try:
            yield batch
        except BaseException:
            self.release(batch, writer)
            raise

    def insert_if_absent(self, df, batch_id=None, order=tuple(ARRIVAL), measure=True, writer=LOADS):
        """Add the first row of every key that is not in the table yet.

        With ``measure`` the deduplicated rows are first written to a staging folder. The input
        is then read only once (a topic that is still being filled would give more
        rows the second time), and the size and range of its keys decide how the
        table is searched. Turn it off when the input is about as large as the table.
        """
        with self._claimed(batch_id, writer) as batch:
            fresh = first_wins(conform(df, self.schema, keep=order), self.key, order).select(*self.schema.names)
            held = self.read(before=(writer, batch))
            if not measure:
                return self._write(new_rows(fresh, held, self.key), batch, writer)
            with self._staged(fresh) as staged:
                added = new_rows(staged, held, self.key, KeyProfile(staged, self.key))
                return self._write(added, batch, writer)

    @contextmanager
    def _staged(self, rows):
        """The rows as a table of their own for as long as they are needed."""
        staging = scratch(self.spark, "staging")
        try:
            rows.write.parquet(staging)
            yield self.spark.read.schema(self.schema).parquet(staging)
        finally:
            drop_scratch(self.spark, staging)

    def insert_strict(self, df, batch_id=None, writer=LOADS):
        """Add all rows, or none if any key is taken or repeated.

        The rows are staged, so those that are checked are those that are written.
        """
        with self._claimed(batch_id, writer) as batch, self._staged(conform(df, self.schema)) as staged:
            first = conflicts(staged, self.read(before=(writer, batch)), self.key).first()
            if first is not None:
                raise DuplicateKeyError(f"key exists already or is repeated: {first.asDict()}")
            return self._write(staged, batch, writer)


# Column types in the database.
DATABASE_TYPES = {"timestamp": "TIMESTAMPTZ", "string": "TEXT", "int": "INT", "double": "FLOAT"}


class JdbcTable:
    """The same table in PostgreSQL, where the primary key guards it.

    Executors write a staging table in parallel; one statement then moves the rows
    over, so no row passes through the driver and a failed run leaves nothing behind.
    """

    def __init__(self, spark, url, table, batch_size=500, schema=TABLE_SCHEMA, key=tuple(KEY), **options):
        self.spark, self.url, self.table = spark, url, table
        self.schema, self.key = schema, key
        self.options = {"batchsize": str(batch_size), **options}

    def create_sql(self):
        columns = [f"{f.name} {DATABASE_TYPES[f.dataType.simpleString()]}" for f in self.schema.fields]
        return f"CREATE TABLE IF NOT EXISTS {self.table} ({', '.join(columns)}, PRIMARY KEY ({', '.join(self.key)}))"

    def staging_sql(self, staging):
        return [f"CREATE TABLE IF NOT EXISTS {staging} (LIKE {self.table})", f"TRUNCATE {staging}"]

    def copy_sql(self, staging):
        columns = ", ".join(self.schema.names)
        return f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {staging}"

    def merge_sql(self, staging):
        return f"{self.copy_sql(staging)} ON CONFLICT ({', '.join(self.key)}) DO NOTHING"

    def _execute(self, *statements):
        properties = self.spark._jvm.java.util.Properties()
        for name, value in self.options.items():
            properties.setProperty(name, value)
        if "driver" in self.options:
            registry = self.spark._jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry
            registry.register(self.options["driver"])
        connection = self.spark._jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.execute(sql)
            connection.commit()
        finally:
            connection.close()

    def ensure(self):
        self._execute(self.create_sql())
        return self

    def read(self, predicates=None):
        return read_jdbc_table(self.spark, self.url, self.table, predicates, **self.options)

    def _append(self, rows, table):
        rows.write.format("jdbc").options(url=self.url, dbtable=table, **self.options).mode("append").save()

    def append(self, df, batch_id=None, writer=LOADS):
        """Add rows as they are; the database refuses a key that is taken."""
        self._append(conform(df, self.schema), self.table)

    def _through_staging(self, rows, move):
        """Write rows to a staging table of this run alone, ``move`` them over, and drop it whatever happens."""
        staging = f"{self.table}_staging_{uuid.uuid4().hex[:16]}"
        try:
            self._execute(*self.staging_sql(staging))
            self._append(rows, staging)
            self._execute(move(staging))
        finally:
            self._execute(f"DROP TABLE IF EXISTS {staging}")

    def insert_strict(self, df, batch_id=None, writer=LOADS):
        """Add all rows in one statement, or none: the database refuses it if a key is taken or repeated."""
        self._through_staging(conform(df, self.schema), self.copy_sql)

    def insert_if_absent(self, df, batch_id=None, order=tuple(ARRIVAL), measure=True, writer=LOADS):
        """Add the first row of every key that is not in the table yet; safe to run again."""
        rows = first_wins(conform(df, self.schema, keep=order), self.key, order).select(*self.schema.names)
        self._through_staging(rows, self.merge_sql)
