"""Sends to a topic that can be repeated: offset ranges are reserved before messages are written."""

import json
import time
import uuid

from pyspark.sql import functions as F

from fleetlake.schema import ENVELOPE_SCHEMA
from fleetlake.session import drop_scratch, exists, list_folder, move, put_new, read_text, scratch
from fleetlake.sinks.table import ConcurrentLoadError
from fleetlake.sources.topic import FileTopic

# Seconds to wait for a writer that has created an entry of the log and not written it yet.
PATIENCE = 5


class SentTopic(FileTopic):
    """A file topic that takes each batch of a writer once, and gives no two messages of a partition one offset.

    A send is staged, which fixes its messages and how many offsets they span. Then it reserves the range
    behind all earlier ones: a numbered file, which only one writer can create; who comes second reads it and
    takes the next number. Messages are written with their final offsets apart from the topic, one attempt is
    named as the one that counts, and its files are moved into the topic under names made from the number.
    A send that was lost at any point is taken up there when it is repeated: files that were moved are not moved
    again, so streams meet each message once too. A repeated batch has to hold what it held before; one
    that spans more offsets than its range is refused. A writer sends its batches in ascending order; batches
    below its newest are known to be done. Readers are those of ``FileTopic``. Do not mix with ``write``.
    """

    def _log(self, name=""):
        return f"{self.path}/_sends/{name}"

    def _newest(self):
        """The newest reservation: its ``number``, the ``end`` of its range, and each writer's last send."""
        if not exists(self.spark, self._log()):
            return {"number": -1, "end": self.next_offset(), "sends": {}}
        number = max(int(name.removesuffix(".json")) for name in list_folder(self.spark, self._log()) if name.endswith(".json"))
        return json.loads(self._text(f"{number}.json"))

    def _text(self, name):
        began = time.monotonic()
        while not (text := read_text(self.spark, self._log(name))):
            if time.monotonic() - began < PATIENCE:
                time.sleep(0.05)
                continue
            raise ConcurrentLoadError(f"{self._log(name)} is being written, or its writer was lost: remove it and send again")
        return text

    def next_offset(self):
        if exists(self.spark, self._log()):
            return self._newest()["end"]
        return super().next_offset()

    def _reserve(self, writer, batch, width):
        """The range of a send: the one it has, or the one behind all others."""
        while True:
            newest = self._newest()
            last = newest["sends"].get(writer)
            if last and last["batch"] >= batch:
                return last
            number, start = newest["number"] + 1, newest["end"]
            send = {"batch": batch, "number": number, "start": start, "width": width}
            after = {"number": number, "end": start + width, "sends": {**newest["sends"], writer: send}}
            if put_new(self.spark, self._log(f"{number}.json"), json.dumps(after)):
                return send

    def _staged(self, df):
        """The messages, written once, and how many offsets they span."""
        path = scratch(self.spark, "send")
        df.select(*ENVELOPE_SCHEMA.names).write.parquet(path)
        staged = self.spark.read.schema(ENVELOPE_SCHEMA).parquet(path)
        least, most, numbered, n = staged.agg(F.min("offset"), F.max("offset"), F.count("offset"), F.count("*")).first()
        if numbered < n or (n and least < 0):
            raise ValueError("offsets of a send are counted from 0")
        return path, staged, most + 1 if n else 0

    def send(self, df, writer, batch=0):
        """Add the messages ``df``, whose offsets count from 0, as this writer's batch; False if they are there already."""
        last = self._newest()["sends"].get(writer)
        if last and (last["batch"] > batch or (last["batch"] == batch and exists(self.spark, self._log(f"{last['number']}.done")))):
            return False
        if not (last and last["batch"] == batch and exists(self.spark, self._log(f"{last['number']}.files"))):
            path, staged, width = self._staged(df)
            last = self._reserve(writer, batch, width)
            if last["batch"] != batch:
                return False
            if width > last["width"]:
                raise ValueError(f"batch {batch} of {writer} spans {width} offsets, when it was first sent {last['width']}")
            pending = f"{self.path}/_pending/{last['number']}-{uuid.uuid4().hex}"
            staged.withColumn("offset", F.col("offset") + F.lit(last["start"])).write.parquet(pending)
            drop_scratch(self.spark, path)
            put_new(self.spark, self._log(f"{last['number']}.files"), pending)
        self._publish(last["number"])
        return True

    def _publish(self, number):
        """Move what is left of the attempt that counts into the topic."""
        pending = self._text(f"{number}.files")
        for name in sorted(list_folder(self.spark, pending)):
            if name.endswith(".parquet"):
                move(self.spark, f"{pending}/{name}", f"{self.path}/send-{number}-{name}")
        put_new(self.spark, self._log(f"{number}.done"), "done")
