"""The target of bucketed runs: plans, merges, replays, compaction, writers at work at once."""

import pytest
from hypothesis import given

from fleetlake.functions.shape import conform
from fleetlake.operators.merge import DuplicateKeyError
from fleetlake.session import list_folder, put_new, scratch
from fleetlake.sinks.runs import RunTable
from fleetlake.sinks.table import ConcurrentLoadError
from tests.test_merge import FEW, ROWS, firsts, numbered, stored


@pytest.fixture
def runs(spark):
    return lambda **options: RunTable(spark, scratch(spark, "runs"), **{"buckets": 3, **options}).ensure()


def executed(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_large_batch_is_shuffled_once_and_the_target_not_at_all(spark, samples, runs):
    table = runs()
    for day in range(2):
        table.append(samples([("m", f"{day}-{i}", "train", i, 0.0) for i in range(50)]))
    state = table.snapshot()
    assert len(state["runs"]) == 2
    incoming = samples([("m", f"1-{i}", "train", i, 1.0) for i in range(80)])
    new = table.unseen(table._dealt(conform(incoming, table.schema), 3), state["runs"], 3)
    plan = executed(new).split("Initial Plan")[0]
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" not in plan
    assert plan.count("Bucketed: true") == 2
    assert new.count() == 30


@FEW
@given(old=ROWS, new=ROWS, more=ROWS)
def test_merge_equals_brute_force(spark, samples, runs, old, new, more):
    table = runs(fanout=2)
    batches = [numbered(rows, 100 * i) for i, rows in enumerate((old, new, more))]
    for batch in batches:
        table.insert_if_absent(samples(batch))
        table.compact()
    assert stored(table) == firsts(*batches)


def test_replays_compaction_and_readers(spark, samples, runs):
    table = runs(fanout=3)
    batches = [numbered([("m", str(3 * n + i), "train") for i in range(4)], 10 * n) for n in range(13)]
    early = None
    for n, batch in enumerate(batches):
        assert table.insert_if_absent(samples(batch), n, writer="w") == n
        assert table.insert_if_absent(samples(batch), n, writer="w") == n  # adds nothing
        if n == 1:
            early = table.read()
        table.compact()
    state = table.snapshot()
    assert state["writers"] == {"w": 12} and len(state["runs"]) <= 2 * 3
    assert stored(table) == firsts(*batches) and sum(run["rows"] for run in state["runs"]) == len(stored(table))
    assert early.count() == len(firsts(*batches[:2]))  # a reader keeps what it began with
    assert table.insert_if_absent(samples(numbered([("late", "1", "test")])), 3, writer="w") == 12
    assert ("late", "1", "test") not in stored(table)
    table.insert_if_absent(samples(numbered([("m", "0", "train")])), 0, writer="other")
    table.expire()
    assert stored(table) == firsts(*batches) and len(table.snapshots()) == 1
    left = list_folder(spark, f"{table.path}/runs")
    assert sorted(left) == sorted(run["name"] for run in table.snapshot()["runs"])


def test_a_table_outlives_its_session_catalog(spark, samples, runs):
    table = runs()
    table.append(samples(numbered([("m", "1", "train")])))
    for run in table.snapshot()["runs"]:
        spark.sql(f"DROP TABLE {run['name']}")
    again = RunTable(spark, table.path)
    again.insert_if_absent(samples([("m", "1", "train", 5, 9.0), ("m", "2", "train", 6, 7.0)]))
    assert stored(again) == {("m", "1", "train"): 0.0, ("m", "2", "train"): 7.0}


def test_the_second_of_two_writers_looks_again(spark, samples, runs, monkeypatch):
    table = runs()
    other = RunTable(spark, table.path)
    fresh, once = table._fresh, []

    def overtaken(*args):
        made = fresh(*args)
        if not once:
            once.append(other.insert_if_absent(samples([("m", "1", "train", 0, 1.0)]), writer="first"))
        return made

    monkeypatch.setattr(table, "_fresh", overtaken)
    table.insert_if_absent(samples([("m", "1", "train", 0, 2.0), ("m", "2", "train", 1, 2.0)]), writer="second")
    assert stored(table) == {("m", "1", "train"): 1.0, ("m", "2", "train"): 2.0}
    assert table.snapshot()["writers"] == {"first": 0, "second": 0} and len(list_folder(spark, f"{table.path}/runs")) == 2


def test_a_batch_that_comes_during_compaction_stays(spark, samples, runs, monkeypatch):
    table = runs(fanout=2)
    for i in range(2):
        table.append(samples(numbered([("m", str(i), "train")])))
    written, once = table._written, []

    def overtaken(*args):
        made = written(*args)
        if not once:
            once.append(RunTable(spark, table.path).append(samples(numbered([("late", "1", "test")]))))
        return made

    monkeypatch.setattr(table, "_written", overtaken)
    assert table.compact() == 2
    assert set(stored(table)) == {("m", "0", "train"), ("m", "1", "train"), ("late", "1", "test")}


def test_strict_insert_and_refused_rows(spark, samples, runs):
    table = runs()
    table.insert_strict(samples(numbered([("m", "1", "train")])))
    for bad in ([("m", "1", "train")], [("m", "2", "train")] * 2):
        with pytest.raises(DuplicateKeyError):
            table.insert_strict(samples(numbered(bad)))
    with pytest.raises(Exception, match="cannot be stored"):
        table.append(samples(numbered([(None, "1", "train")])))
    assert stored(table) == {("m", "1", "train"): 0.0} and len(table.snapshot()["runs"]) == 1


def test_a_snapshot_that_is_not_whole_stops_readers_and_writers(spark, samples, runs):
    table = runs()
    table.append(samples(numbered([("m", "1", "train")])))
    assert put_new(spark, f"{table.path}/_snapshots/2.json", '{"number": 2, "ru') and not put_new(spark, f"{table.path}/_snapshots/2.json", "")
    with pytest.raises(ConcurrentLoadError):
        table.append(samples(numbered([("m", "2", "train")])))
    table.discard(2)
    table.append(samples(numbered([("m", "2", "train")])))
    assert len(stored(table)) == 2 and table.ensure().read(1).count() == 1
