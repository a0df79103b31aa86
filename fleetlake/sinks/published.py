"""Exports that readers see whole or not at all."""

import json
import uuid

from fleetlake.functions.shape import conform
from fleetlake.operators.counts import counted
from fleetlake.schema import TABLE_SCHEMA
from fleetlake.session import drop_scratch, exists, file_sizes, list_folder, put_new, read_text
from fleetlake.sinks.export import export, read_export

# Times a number is tried again because another export took it first.
TRIES = 10

# Files of an export that hold no rows.
MARKERS = ("_", ".")


class ExportDamagedError(Exception):
    """Files of a published export are missing or have another size than at its publication."""


class Publication:
    """Exports of one data set under numbered manifests.

    An export is written to a folder of its own first. Its manifest, which names the rows written and every file with its
    size, is put in place last, by creating a file that must not exist: until then, and for ever if the
    export fails, readers go on with the manifest before. Exports may run at the same time; each gets a number of its own and the
    highest is the one that is read. A run that is published already is not written again, so a job may be repeated.

    The manifest lists the files, so its size grows with rows / ``max_rows``; rows themselves never reach the driver.
    """

    def __init__(self, spark, path, fmt="parquet", schema=TABLE_SCHEMA):
        self.spark, self.path, self.fmt, self.schema = spark, path, fmt, schema

    def numbers(self):
        """Numbers of the manifests that are kept, in order; also one that is still being written."""
        folder = f"{self.path}/_manifests"
        names = list_folder(self.spark, folder) if exists(self.spark, folder) else []
        return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] not in MARKERS)

    def _manifest(self, number):
        """A manifest, or None if it is gone, still being written, or its writer was lost meanwhile."""
        place = f"{self.path}/_manifests/{number}.json"
        try:
            return json.loads(read_text(self.spark, place)) if exists(self.spark, place) else None
        except json.JSONDecodeError:
            return None

    def manifests(self):
        """All manifests that can be read, newest first."""
        return filter(None, (self._manifest(number) for number in reversed(self.numbers())))

    def manifest(self, number=None):
        """The newest, or another, manifest: ``number``, ``run``, ``format``, ``folder``, ``rows`` and ``files``."""
        found = next(self.manifests(), None) if number is None else self._manifest(number)
        if found is None:
            raise FileNotFoundError(f"nothing is published in {self.path}" if number is None else f"no manifest {number} in {self.path}")
        return found

    def publish(self, df, run=None, max_rows=1_000_000, rebalance=False):
        """Write ``df`` in files of at most ``max_rows`` rows and publish it; the manifest is returned.

        ``run`` names what is exported, such as a day: a run that has a manifest is left as it is. Of two writers of one
        run at the same time both are published, the later one is read.
        """
        if run is not None:
            done = next((found for found in self.manifests() if found["run"] == run), None)
            if done:
                return done
        folder = f"data/export-{uuid.uuid4().hex}"
        rows, seen = counted(conform(df, self.schema))
        export(rows, f"{self.path}/{folder}", self.fmt, rebalance, max_rows)
        sizes = {name: size for name, size in file_sizes(self.spark, f"{self.path}/{folder}").items() if name[0] not in MARKERS}
        manifest = {"run": run, "format": self.fmt, "folder": folder, "rows": seen.get["rows"], "files": sizes}
        for _ in range(TRIES):
            number = max(self.numbers(), default=0) + 1
            manifest = {**manifest, "number": number}
            if put_new(self.spark, f"{self.path}/_manifests/{number}.json", json.dumps(manifest)):
                return manifest
        raise RuntimeError(f"no number of {TRIES} was free in {self.path}")

    def read(self, number=None):
        """The rows of the newest, or another, published export, once its files are seen to be whole."""
        manifest = self.manifest(number)
        folder = f"{self.path}/{manifest['folder']}"
        sizes = file_sizes(self.spark, folder) if exists(self.spark, folder) else {}
        damaged = sorted(name for name, size in manifest["files"].items() if sizes.get(name) != size)
        if damaged:
            raise ExportDamagedError(f"{len(damaged)} of {len(manifest['files'])} files in {folder}, first {damaged[0]}")
        if not manifest["files"]:
            return self.spark.createDataFrame([], self.schema)
        return read_export(self.spark, [f"{folder}/{name}" for name in manifest["files"]], manifest["format"], self.schema)

    def expire(self, keep=1):
        """Remove all but the ``keep`` newest exports. Folders of failed exports stay; another writer may be at work in them."""
        if keep < 1:
            raise ValueError("at least one export is kept")
        for manifest in list(self.manifests())[keep:]:
            drop_scratch(self.spark, f"{self.path}/_manifests/{manifest['number']}.json")
            drop_scratch(self.spark, f"{self.path}/{manifest['folder']}")
