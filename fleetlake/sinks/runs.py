"""A keyed target of bucketed runs under numbered snapshots, for large batches and long streams."""

import json
import uuid
from functools import reduce

from pyspark.sql import functions as F

from fleetlake.functions.shape import conform
from fleetlake.operators.counts import counted
from fleetlake.operators.dedup import first_wins
from fleetlake.operators.merge import DuplicateKeyError, conflicts, not_in_target
from fleetlake.schema import ARRIVAL, KEY, TABLE_SCHEMA
from fleetlake.session import drop_scratch, exists, list_folder, put_new, read_text, scratch
from fleetlake.sinks.table import LOADS, ConcurrentLoadError

# Runs of one size class that are merged into a run of the next class.
FANOUT = 8

# How often a commit is tried again because another one came first.
TRIES = 10


class RunTable:
    """A Parquet table that never holds a key twice, as immutable runs of rows bucketed and sorted by key.

    A snapshot is a small numbered file that names the runs that make up the table and, for every
    writer, the last batch it has written. A batch writes its rows as a run of their own and then puts the next
    snapshot in place, which only one writer can do; another one that comes second looks at the runs that
    were added meanwhile and tries again. So writers may be at work at the same time, a failed batch leaves nothing that
    a reader sees, a batch that is run again after its commit adds nothing, and a reader keeps the snapshot it began with.

    All runs have the same buckets of the key's hash, so an incoming batch is dealt into those buckets once and
    compared with each run where the run lies: the target is neither shuffled nor broadcast, however large
    the batch is. ``compact`` merges ``fanout`` runs of one size class into one of the next, so a table of n batches has at most
    fanout - 1 runs in each of log n classes, and every row is rewritten once a class. ``expire`` removes old snapshots
    and the runs that only they name.

    Buckets are fixed when the table is made: choose them so that a bucket of the full table fits a task. Runs are known to the session's
    catalog as external tables, since only catalog tables can be bucketed; their files alone are the table.
    """

    def __init__(self, spark, path, schema=TABLE_SCHEMA, key=tuple(KEY), buckets=None, fanout=FANOUT):
        self.spark, self.path, self.schema, self.key, self.fanout = spark, path, schema, list(key), fanout
        self._asked = buckets

    # Snapshots

    def snapshots(self):
        """Numbers of the snapshots that are kept, in order."""
        return sorted(int(name.removesuffix(".json")) for name in list_folder(self.spark, f"{self.path}/_snapshots") if name.endswith(".json"))

    def snapshot(self, number=None):
        """What the newest, or another, snapshot says: ``number``, ``buckets``, ``runs`` and ``writers``."""
        number = self.snapshots()[-1] if number is None else number
        try:
            return json.loads(read_text(self.spark, f"{self.path}/_snapshots/{number}.json"))
        except json.JSONDecodeError:
            raise ConcurrentLoadError(f"snapshot {number} is being written, or its writer was lost: see discard") from None

    def discard(self, number):
        """Remove a snapshot whose writer was lost before it was written in full."""
        drop_scratch(self.spark, f"{self.path}/_snapshots/{number}.json")

    def _commit(self, before, **changes):
        """Put the snapshot after ``before`` in place; False if another writer did so first."""
        after = {**before, **changes, "number": before["number"] + 1}
        return put_new(self.spark, f"{self.path}/_snapshots/{after['number']}.json", json.dumps(after))

    def ensure(self):
        """Create the table if it does not exist; an existing one is left alone."""
        if not exists(self.spark, f"{self.path}/_snapshots"):
            buckets = self._asked or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            put_new(self.spark, f"{self.path}/_snapshots/0.json", json.dumps({"number": 0, "buckets": buckets, "runs": [], "writers": {}}))
        return self

    # Runs

    def _place(self, name):
        return f"{self.path}/runs/{name}"

    def _bucketed(self, run, buckets):
        """A run as a bucketed table; its name in the catalog is that of its folder, which is unique."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        keys = ", ".join(f"`{name}`" for name in self.key)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {run['name']} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
            f"INTO {buckets} BUCKETS LOCATION '{self._place(run['name'])}'"
        )
        return self.spark.table(run["name"])

    def _dealt(self, df, buckets):
        return df.select(*self.schema.names).repartition(buckets, *self.key)

    def _written(self, df, buckets, level):
        """Write rows that are dealt into buckets as a run of their own."""
        run = {"name": f"run_{uuid.uuid4().hex}", "level": level}
        for name in self.key:
            refused = F.raise_error(F.lit(f"a row without {name} cannot be stored"))
            df = df.withColumn(name, F.when(F.col(name).isNull(), refused).otherwise(F.col(name)))
        rows, seen = counted(df)
        writer = rows.write.bucketBy(buckets, *self.key).sortBy(*self.key).format("parquet")
        writer.option("path", self._place(run["name"])).saveAsTable(run["name"])
        return {**run, "rows": seen.get["rows"]}

    def _forget(self, run):
        self.spark.sql(f"DROP TABLE IF EXISTS {run['name']}")
        drop_scratch(self.spark, self._place(run["name"]))

    def read(self, number=None):
        """All rows of the newest, or another, snapshot."""
        return self._rows(self.snapshot(number)["runs"])

    def _rows(self, runs):
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._place(run["name"]) for run in runs])

    def unseen(self, dealt, runs, buckets):
        """Rows of a dealt batch whose key no run holds. Only the batch has been shuffled."""
        return reduce(lambda rows, run: not_in_target(rows, self._bucketed(run, buckets).hint("merge"), self.key), runs, dealt)

    # Batches

    def _load(self, staged, batch_id, writer, absent):
        """Commit the rows of ``staged`` as one batch; with ``absent`` those whose key is taken are left out."""
        known = []
        rows = None
        for _ in range(TRIES):
            state = self.snapshot()
            if batch_id is not None and batch_id <= state["writers"].get(writer, -1):
                return state["writers"][writer]
            number = state["writers"].get(writer, -1) + 1 if batch_id is None else batch_id
            added = [run for run in state["runs"] if run["name"] not in known]
            if rows is None or added:
                old, rows = rows, self._fresh(staged, state, absent)
                if old:
                    self._forget(old)
                known = [run["name"] for run in state["runs"]]
            runs = state["runs"] + ([rows] if rows["rows"] else [])
            if self._commit(state, runs=runs, writers={**state["writers"], writer: number}):
                if not rows["rows"]:
                    self._forget(rows)
                return number
        self._forget(rows)
        raise ConcurrentLoadError(f"other writers came first {TRIES} times")

    def _fresh(self, staged, state, absent):
        dealt = self._dealt(staged, state["buckets"])
        return self._written(self.unseen(dealt, state["runs"], state["buckets"]) if absent else dealt, state["buckets"], 0)

    def _stage(self, rows):
        """The rows as a table of their own: a topic that is being filled is read only once."""
        path = scratch(self.spark, "staging")
        rows.write.parquet(path)
        return path, self.spark.read.schema(self.schema).parquet(path)

    def insert_if_absent(self, df, batch_id=None, order=tuple(ARRIVAL), measure=True, writer=LOADS):
        """Add the first row of every key that is not in the table yet; a batch that was committed before adds nothing."""
        path, staged = self._stage(first_wins(conform(df, self.schema, keep=order), self.key, order).select(*self.schema.names))
        try:
            return self._load(staged, batch_id, writer, True)
        finally:
            drop_scratch(self.spark, path)

    def append(self, df, batch_id=None, writer=LOADS):
        """Add rows as they are; the caller vouches for the key."""
        path, staged = self._stage(conform(df, self.schema))
        try:
            return self._load(staged, batch_id, writer, False)
        finally:
            drop_scratch(self.spark, path)

    def insert_strict(self, df, batch_id=None, writer=LOADS):
        """Add all rows, or none if any key is taken or repeated; against the snapshot that the commit follows."""
        path, staged = self._stage(conform(df, self.schema))
        try:
            state = self.snapshot()
            if batch_id is not None and batch_id <= state["writers"].get(writer, -1):
                return state["writers"][writer]
            first = conflicts(staged, self._rows(state["runs"]), self.key).first()
            if first is not None:
                raise DuplicateKeyError(f"key exists already or is repeated: {first.asDict()}")
            rows = self._fresh(staged, state, False)
            number = state["writers"].get(writer, -1) + 1 if batch_id is None else batch_id
            if self._commit(state, runs=state["runs"] + [rows], writers={**state["writers"], writer: number}):
                return number
            self._forget(rows)
            raise ConcurrentLoadError("another writer came first; the check has to be made again")
        finally:
            drop_scratch(self.spark, path)

    # Upkeep

    def compact(self):
        """Merge runs as long as some class has ``fanout`` of them; returns the number of runs left.

        Readers of older snapshots are not disturbed, and batches that are committed meanwhile stay.
        """
        while True:
            state = self.snapshot()
            classes = {}
            for run in state["runs"]:
                classes.setdefault(run["level"], []).append(run)
            full = [level for level, runs in sorted(classes.items()) if len(runs) >= self.fanout]
            if not full:
                return len(state["runs"])
            merged = classes[full[0]]
            made = self._written(self._dealt(self._rows(merged), state["buckets"]), state["buckets"], full[0] + 1)
            gone = {run["name"] for run in merged}
            for _ in range(TRIES):
                if self._commit(state, runs=[run for run in state["runs"] if run["name"] not in gone] + [made]):
                    break
                state = self.snapshot()
                if not gone <= {run["name"] for run in state["runs"]}:
                    self._forget(made)  # another compaction has merged them
                    break
            else:
                self._forget(made)
                raise ConcurrentLoadError(f"other writers came first {TRIES} times")

    def expire(self, keep=1):
        """Remove all but the newest ``keep`` snapshots, and the runs that only removed ones name."""
        numbers = self.snapshots()
        old, kept = numbers[:-keep], numbers[-keep:]
        needed = {run["name"] for number in kept for run in self.snapshot(number)["runs"]}
        for number in old:
            for run in self.snapshot(number)["runs"]:
                if run["name"] not in needed:
                    self._forget(run)
                    needed.add(run["name"])
            self.discard(number)
