"""Sends that are repeated, lost on the way, or made by several writers at once."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import jobs
from fleetlake.session import scratch
from fleetlake.sinks import sends
from fleetlake.sources import files
from fleetlake.streaming.ingest import append_stream


@pytest.fixture
def topic(spark):
    return sends.SentTopic(spark, scratch(spark, "sent"))


def held(topic):
    return sorted((r.offset, r.value.decode()) for r in topic.read().collect())


def test_a_repeated_send_adds_nothing(topic, messages):
    assert topic.next_offset() == 0
    assert topic.send(messages(["a", "b"]), "w") and not topic.send(messages(["a", "b"]), "w")
    assert topic.send(messages(["c"]), "w", 1) and topic.send(messages(["d"]), "v")
    assert not topic.send(messages(["a", "b"]), "w") and not topic.send(messages(["c"]), "w", 1) and not topic.send(messages(["d"]), "v")
    assert held(topic) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")] and topic.next_offset() == 4
    # Another object for the same folder knows it as well, and an empty batch takes no offset.
    again = sends.SentTopic(topic.spark, topic.path)
    assert again.send(messages(["x"]).limit(0), "u") and not again.send(messages(["x"]).limit(0), "u")
    assert len(held(topic)) == 4 and again.next_offset() == 4


@pytest.mark.parametrize("lost", ["before the messages", "before the attempt is named", "while files are moved", "before it is marked done"])
def test_a_lost_send_is_taken_up(topic, messages, monkeypatch, lost, spark):
    sent = messages([f"m{i}" for i in range(12)]).repartition(4)
    topic.send(messages(["first"]), "other")
    move, put_new, moved = sends.move, sends.put_new, []

    def failing_move(spark, path, target):
        if lost == "while files are moved" and len(moved) == 2:
            raise OSError("lost")
        moved.append(target)
        move(spark, path, target)

    def failing_put(spark, path, text):
        if (lost == "before the attempt is named" and path.endswith(".files")) or (lost == "before it is marked done" and path.endswith(".done")):
            raise OSError("lost")
        made = put_new(spark, path, text)
        if lost == "before the messages":
            raise OSError("lost")
        return made

    monkeypatch.setattr(sends, "move", failing_move)
    monkeypatch.setattr(sends, "put_new", failing_put)
    with pytest.raises(OSError):
        topic.send(sent, "w")
    monkeypatch.setattr(sends, "move", move)
    monkeypatch.setattr(sends, "put_new", put_new)
    out, checkpoint = scratch(spark, "read"), scratch(spark, "checkpoint")

    def drain():
        append_stream(topic.read_stream().select("offset", "value"), out, checkpoint).awaitTermination()

    drain()
    # Meanwhile another writer goes on, behind the range that is reserved.
    assert topic.send(messages(["last"]), "other", 1)
    assert topic.send(sent.repartition(2), "w") and not topic.send(sent, "w")
    drain()
    wanted = sorted([(0, "first"), (13, "last"), *((i + 1, f"m{i}") for i in range(12))])
    assert held(topic) == wanted
    assert sorted((r.offset, r.value.decode()) for r in spark.read.parquet(out).collect()) == wanted


def test_writers_at_once_share_no_offset(topic, messages):
    frames = {f"w{i}": messages([f"{i}-{k}" for k in range(i + 1)]) for i in range(5)}
    with ThreadPoolExecutor(5) as pool:
        assert all(pool.map(lambda w: topic.send(frames[w], w), frames))
    rows = held(topic)
    assert [o for o, _ in rows] == list(range(15)) and len({v for _, v in rows}) == 15
    by_writer = {}
    for offset, value in rows:
        by_writer.setdefault(value.split("-")[0], []).append((int(value.split("-")[1]), offset))
    assert all([k for k, _ in sorted(v)] == list(range(len(v))) and sorted(v) == sorted(v, key=lambda x: x[1]) for v in by_writer.values())


def test_what_cannot_be_sent_is_refused(topic, messages, monkeypatch):
    with pytest.raises(ValueError, match="counted from 0"):
        topic.send(messages(["a"], start=-1), "w")
    with pytest.raises(ValueError, match="counted from 0"):
        topic.send(messages(["a"]).withColumn("offset", F.lit(None).cast("long")), "w")
    put_new = sends.put_new
    monkeypatch.setattr(sends, "put_new", lambda s, p, t: put_new(s, p, t) if p.endswith(".json") else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        topic.send(messages(["a"]), "w")
    monkeypatch.setattr(sends, "put_new", put_new)
    with pytest.raises(ValueError, match="spans 2 offsets, when it was first sent 1"):
        topic.send(messages(["a", "b"]), "w")
    put_new(topic.spark, f"{topic.path}/_sends/1.json", "")
    with pytest.raises(sends.ConcurrentLoadError):
        topic.next_offset()


def test_a_job_that_runs_again_sends_its_files_once(spark, topic, tmp_path):
    folder = tmp_path / "machine-1"
    folder.mkdir()
    columns = ",".join(f"col_{i}" for i in range(38))
    lines = [f"{i},0,{','.join(['0.5'] * 38)}" for i in range(7)]
    (folder / "machine-1_train.csv").write_text("\n".join([f"timestamp,label,{columns}", *lines]))
    read = files.read_train_csv(spark, str(tmp_path))
    for _ in range(2):
        jobs.csv_to_topic(read, topic, "2024-02-01 00:00:00", writer="backfill")
    assert sorted(r.offset for r in topic.read().collect()) == list(range(read.count())) and read.count() > 0
