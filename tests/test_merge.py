import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlake.operators.dedup import first_wins
from fleetlake.operators.merge import DuplicateKeyError, KeyProfile, conflicts, ignored_rows, new_rows, not_in_target
from fleetlake.schema import KEY, TABLE_SCHEMA
from fleetlake.session import broadcast_limit, scratch
from fleetlake.sinks.table import ConcurrentLoadError, KeyedTable

ROWS = st.lists(
    st.tuples(st.sampled_from(["m1", "m2"]), st.sampled_from(["1", "2", "3"]), st.sampled_from(["train", "test"])),
    max_size=12,
)
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def numbered(keys, start=0):
    return [(*key, start + i, float(start + i)) for i, key in enumerate(keys)]


def firsts(*batches):
    kept = {}
    for batch in batches:
        for machine, tick, split, _, value in batch:
            kept.setdefault((machine, tick, split), value)
    return kept


def stored(table):
    rows = table.read().collect()
    found = {(row.machine, row.timestamp, row.usage): row.col_0 for row in rows}
    assert len(found) == len(rows)
    return found


@pytest.fixture
def table(spark):
    return lambda: KeyedTable(spark, scratch(spark, "table")).ensure()


@FEW
@given(old=ROWS, new=ROWS)
def test_merge_equals_brute_force(spark, samples, table, old, new):
    old, new = numbered(old), numbered(new, 100)
    for measure in (True, False):
        target = table()
        for batch in (old, new, new):
            target.insert_if_absent(samples(batch), measure=measure)
        assert stored(target) == firsts(old, new)


@FEW
@given(old=ROWS, new=ROWS)
def test_conflict_tests_equal_brute_force(spark, samples, old, new):
    old, new = numbered(old), numbered(new, 100)
    target, held = first_wins(samples(old)), set(firsts(old))
    incoming = samples(new)
    keys = [row[:3] for row in new]
    assert sorted(r.offset for r in not_in_target(incoming, target).collect()) == [r[3] for r in new if r[:3] not in held]
    assert sorted(r.offset for r in ignored_rows(incoming, target).collect()) == [r[3] for r in new if r[:3] in held]
    found = {tuple(r[name] for name in KEY): (r.n, r.in_target) for r in conflicts(incoming, target).collect()}
    assert found == {k: (keys.count(k), k in held) for k in set(keys) if keys.count(k) > 1 or k in held}


def test_profile_and_both_ways_to_search(spark, samples, monkeypatch):
    target = samples([("m1", str(i), "train", i, 0.0) for i in range(50)])
    fresh = samples([("m1", str(i), "train", i, 1.0) for i in range(45, 60)])
    profile = KeyProfile(fresh)
    assert profile.rows == 15 and profile.ranges["timestamp"] == ("45", "59") and profile.bytes > 15 * 9
    expected = [str(i) for i in range(50, 60)]
    small = new_rows(fresh, target, profile=profile)
    assert sorted(r.timestamp for r in small.collect()) == expected
    monkeypatch.setattr("fleetlake.operators.merge.broadcast_limit", lambda spark: 0)
    large = new_rows(fresh, target, profile=profile)
    assert sorted(r.timestamp for r in large.collect()) == expected
    none = KeyProfile(fresh.filter("false"))
    assert new_rows(fresh.filter("false"), target, profile=none).isEmpty()


def test_broadcast_limit_follows_the_session(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "-1")
        assert broadcast_limit(spark) == 0
        spark.conf.set(name, "5m")
        assert broadcast_limit(spark) == 5 * 1024 * 1024
    finally:
        spark.conf.set(name, before)


def test_first_wins_order_and_null_keys(samples):
    rows = samples([("m", "1", "train", 5, 5.0), ("m", "1", "train", 2, 2.0), (None, "1", "train", 9, 9.0), (None, "1", "train", 8, 8.0)])
    assert sorted(r.col_0 for r in first_wins(rows).collect()) == [2.0, 8.0]


def test_replayed_batch_adds_nothing(samples, table):
    target = table()
    target.insert_if_absent(samples(numbered([("m", "1", "train")])), batch_id=0)
    batch = samples(numbered([("m", "1", "train"), ("m", "2", "train")], 10))
    for _ in range(2):
        target.insert_if_absent(batch, batch_id=1)
        assert stored(target) == {("m", "1", "train"): 0.0, ("m", "2", "train"): 11.0}


def test_replay_of_an_emptied_batch_replaces_it(samples, table):
    target = table()
    target.append(samples(numbered([("m", "1", "train")])), batch_id=0)
    target.append(samples([]), batch_id=0)
    assert stored(target) == {}


def test_strict_insert(samples, table):
    target = table()
    target.insert_strict(samples(numbered([("m", "1", "train"), ("m", "2", "train")])))
    for keys in ([("m", "2", "train"), ("m", "3", "train")], [("m", "4", "train")] * 2):
        with pytest.raises(DuplicateKeyError):
            target.insert_strict(samples(numbered(keys, 10)))
    assert len(stored(target)) == 2


def test_ensure_keeps_rows_and_types(spark, samples, table):
    target = table()
    assert target.read().schema == TABLE_SCHEMA and target.read().isEmpty() and target.next_batch() == 0
    target.append(samples(numbered([("m", "1", "train")])))
    assert stored(target.ensure()) == {("m", "1", "train"): 0.0} and target.next_batch() == 1


def test_staging_is_removed(spark, samples, table, monkeypatch):
    import os

    named = []
    monkeypatch.setattr("fleetlake.sinks.table.scratch", lambda spark, p: named.append(scratch(spark, p)) or named[-1])
    table().insert_if_absent(samples(numbered([("m", "1", "train")])))
    assert named and not os.path.exists(named[0])


def test_scratch_uses_the_shared_folder(spark, tmp_path):
    class Session:
        _jvm, _jsc = spark._jvm, spark._jsc

        class sparkContext:
            applicationId, master = "app-1", "spark://host:7077"

        class conf:
            value = str(tmp_path)

            @classmethod
            def get(cls, name, default=None):
                return cls.value if name == "spark.checkpoint.dir" else default

    assert scratch(Session, "x").startswith(f"{tmp_path}/fleetlake/app-1/x-")
    Session.conf.value = None
    Session.sparkContext.applicationId = "app-2"
    with pytest.raises(ValueError):
        scratch(Session, "x")


def test_rows_without_a_key_are_refused(spark, samples):
    table = KeyedTable(spark, scratch(spark, "table")).ensure()
    for load in (table.append, table.insert_if_absent, table.insert_strict):
        with pytest.raises(Exception, match="a row without timestamp cannot be stored"):
            load(samples([("m", None, "train", 1, 1.0)]))
    assert table.read().isEmpty()
    table.append(samples([("m", "1", "train", 1, 1.0)]))
    assert table.read().count() == 1


def test_two_loads_cannot_take_one_number(spark, samples):
    table = KeyedTable(spark, scratch(spark, "table")).ensure()
    with table._claimed(None, "loads") as batch:
        with pytest.raises(ConcurrentLoadError):
            table.append(samples([("m", "1", "train", 1, 1.0)]))
    table.release(batch)
    table.append(samples([("m", "1", "train", 1, 1.0)]))
    assert table.read().count() == 1
