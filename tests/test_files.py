import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.decode import decode_strict
from fleetlake.operators.dedup import first_wins
from fleetlake.plans import jobs
from fleetlake.schema import CSV_SCHEMA, FEATURES
from fleetlake.session import scratch
from fleetlake.sinks.export import export, export_path, read_export
from fleetlake.sinks.table import KeyedTable
from fleetlake.sources import files
from fleetlake.sources.topic import FileTopic

HEADER = ",".join(CSV_SCHEMA.names)


def line(tick, label, value):
    return ",".join([tick, str(label), *[str(value)] * 38])


@pytest.fixture
def data(tmp_path):
    def put(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([HEADER, *lines]) + "\n")

    put("machine-1-1/a_train.csv", line("1", 1, 0.5), line("2", 0, 0.25))
    put("machine-1-2/b_train.csv", line("1", 0, 1.5))
    put("machine-1-1/a_test.csv", line("1", 1, 9.0))
    put("machine-1-2/b_test.csv", line("1", 0, 8.0))
    put("other/c_train.csv", line("1", 0, 7.0))
    return tmp_path


def test_train_files_of_all_machines(spark, data):
    rows = files.read_train_csv(spark, data).collect()
    found = sorted((r.machine, r.timestamp, r.usage, r.label, r.col_0, r.col_37) for r in rows)
    assert found == [
        ("machine-1-1", "1", "train", 0.0, 0.5, 0.5),
        ("machine-1-1", "2", "train", 0.0, 0.25, 0.25),
        ("machine-1-2", "1", "train", 0.0, 1.5, 1.5),
    ]


def test_test_files_of_one_machine(spark, data):
    rows = files.read_test_csv(spark, data, "machine-1-1").collect()
    assert [(r.machine, r.usage, r.label, r.col_0) for r in rows] == [("machine-1-1", "test", 1, 9.0)]
    assert files.read_test_csv(spark, data, "machine-*").count() == 2


def test_bad_text_and_short_rows(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("\n".join([HEADER, line("1", 0, "bad"), "2,1", line("3", 0, 1.0)]) + "\n")
    rows = files.read_csv(spark, str(path), corrupt="_line").collect()
    assert [(r.timestamp, r.col_0) for r in rows] == [("1", None), ("2", None), ("3", 1.0)]
    assert rows[0]._line.startswith("1,0,bad") and rows[2]._line is None
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        files.read_csv(spark, str(path), mode="FAILFAST").collect()


def test_header_is_checked(spark, tmp_path):
    path = tmp_path / "x.csv"
    names = CSV_SCHEMA.names
    path.write_text("\n".join([",".join([names[1], names[0], *names[2:]]), line("1", 0, 1.0)]) + "\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(path)).collect()


def test_columns_by_name(spark, tmp_path):
    path = tmp_path / "machine-3" / "x_train.csv"
    path.parent.mkdir()
    path.write_text("col_1,extra,label,timestamp,col_0\n2.5,1e3,1,007,bad\n")
    row = files.read_csv_by_name(spark, str(tmp_path), files.TRAIN_PATTERN).first()
    assert row.asDict() == {"machine": "machine-3", "timestamp": "007", "label": 1, "col_0": None, "col_1": 2.5, "extra": "1e3"}


def test_file_order_decides_the_first(spark, tmp_path):
    for name, values in (("b.csv", [3.0, 4.0]), ("a.csv", [1.0, 2.0])):
        (tmp_path / name).write_text("\n".join([HEADER, *[line("1", 0, v) for v in values]]) + "\n")
    rows = files.file_order(files.read_csv(spark, str(tmp_path), pattern="*.csv"))
    assert [r.col_0 for r in first_wins(rows, ["timestamp"], files.FILE_ORDER).collect()] == [1.0]


def test_rows_are_numbered_by_path_and_line(spark, tmp_path):
    for name, n in (("a", 1), ("b", 199), ("c", 40)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.csv").write_text("\n".join([HEADER, *[line(name, i, i) for i in range(n)]]) + "\n")
    rows = files.numbered(files.read_train_csv(spark, tmp_path, pattern="*/*.csv"), start=5).collect()
    assert [(r.timestamp, int(r.col_0)) for r in sorted(rows, key=lambda r: r.arrival)] == [(n, i) for n, k in (("a", 1), ("b", 199), ("c", 40)) for i in range(k)]
    assert sorted(r.arrival for r in rows) == list(range(5, 245))


def test_a_second_load_comes_after_the_first(spark, data, tmp_path):
    topic = FileTopic(spark, scratch(spark, "topic"))
    for value in (1.0, 2.0):
        (tmp_path / "machine-1-1" / "a_train.csv").write_text("\n".join([HEADER, line("1", 0, value)]) + "\n")
        jobs.csv_to_topic(files.read_train_csv(spark, tmp_path, pattern="machine-1-1/*_train.csv"), topic, "2024-02-01 00:00:00")
    kept = first_wins(decode_strict(topic.read(), keep=["partition", "offset"])).collect()
    assert [r.col_0 for r in kept] == [1.0]


def test_machines_without_the_prefix(spark, tmp_path):
    for name in ("server7", "db-2", "a b+c%"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x_test.csv").write_text("\n".join([HEADER, line("1", 0, 1.0)]) + "\n")
    assert sorted(r.machine for r in files.read_test_csv(spark, tmp_path, "*").collect()) == ["a b+c%", "db-2", "server7"]


def test_machine_files_roundtrip(spark, samples):
    path = scratch(spark, "csv")
    rows = samples([(f"machine-{i % 3}", str(i), "train", i, i / 7) for i in range(30)])
    files.write_machine_csv(rows, path)
    assert sorted(n for n in os.listdir(path) if n.startswith("machine")) == [f"machine=machine-{i}" for i in range(3)]
    back = files.read_train_csv(spark, path, pattern="machine=machine-*").collect()
    assert sorted((r.machine, int(r.timestamp), r.col_0) for r in back) == sorted((f"machine-{i % 3}", i, i / 7) for i in range(30))


def test_union_splits(spark, data):
    both = files.union_splits(files.read_train_csv(spark, data), files.read_test_csv(spark, data, "machine-*"))
    assert {r.usage: r["count"] for r in both.groupBy("usage").count().collect()} == {"train": 3, "test": 2}


def test_csv_to_topic(spark, data):
    topic = jobs.csv_to_topic(files.read_train_csv(spark, data), FileTopic(spark, scratch(spark, "topic")), "2024-02-01 00:00:00")
    row = topic.read().filter(F.col("key") == F.lit("machine-1-2-train").cast("binary")).first()
    body = json.loads(bytes(row.value))
    assert (body["machine"], body["timestamp"], body["usage"], body["label"]) == ("machine-1-2", "1", "train", 0.0)
    assert body["send_timestamp"] == "2024-02-01T00:00:00.000000" and [body[n] for n in FEATURES] == [1.5] * 38
    assert decode_strict(topic.read()).count() == 3


def test_csv_to_table_refuses_a_second_load(spark, data):
    table = KeyedTable(spark, scratch(spark, "table"))
    rows = files.read_train_csv(spark, data)
    jobs.csv_to_table(rows, table, "2024-02-01 00:00:00")
    assert table.read().count() == 3
    with pytest.raises(ValueError):
        jobs.csv_to_table(rows, table, "2024-02-01 00:00:00")


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_export_roundtrip(spark, data, fmt):
    table = KeyedTable(spark, scratch(spark, "table"))
    jobs.csv_to_table(files.read_train_csv(spark, data), table, "2024-02-01 00:00:00.123456")
    rows = table.read()
    as_of = datetime.datetime(2024, 2, 2, 0, 0, 0)
    base = scratch(spark, "exports")
    path = jobs.export_split(rows, base, as_of, fmt=fmt)
    assert path == f"{base}/export_20240202_000000" == export_path(base, as_of)
    back = read_export(spark, path, fmt)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    jobs.export_split(rows, base, as_of, fmt=fmt)
    assert read_export(spark, path, fmt).count() == 3
    assert read_export(spark, jobs.export_split(rows, base, as_of.replace(day=4), fmt=fmt), fmt).isEmpty()


def test_export_refuses_other_formats(spark, tmp_path):
    with pytest.raises(ValueError):
        export(spark.range(1), str(tmp_path / "x"), "orc")


def test_numbers_stay_apart_after_a_filter(spark, tmp_path):
    for machine in range(4):
        (tmp_path / f"machine-{machine}").mkdir()
        lines = [f"{i},0," + ",".join(["0.5"] * 38) for i in range(30)]
        (tmp_path / f"machine-{machine}" / f"machine-{machine}_train.csv").write_text("\n".join([",".join(files.CSV_SCHEMA.names), *lines]))
    rows = files.read_train_csv(spark, str(tmp_path)).filter("timestamp % 3 <> 1 and not (machine = 'machine-1' and timestamp < 20)")
    found = files.numbered(rows, start=100).orderBy("arrival").collect()
    wanted = [(f"machine-{m}", str(i)) for m in range(4) for i in range(30) if i % 3 != 1 and not (m == 1 and i < 20)]
    assert [(r.machine, r.timestamp) for r in found] == wanted
    assert len({r.arrival for r in found}) == len(wanted) and found[0].arrival == 100
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert files.numbered(rows, start=100).orderBy("arrival").collect() == found
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_message_is_set_aside_or_handed_on_never_lost(spark, messages, tmp_path):
    from fleetlake.plans import jobs

    good = '{"send_timestamp": "2024-01-02T00:00:00", "machine": "m", "timestamp": "1", "usage": "train", "label": 0.0}'
    old, bad = good.replace("2024-01-02", "2023-01-02"), good.replace('"machine": "m", ', "")
    frame = messages([good, old, bad, "no json", good.replace("T00:00:00", "Tx")])
    kept = jobs.recent_samples(frame, "2024-01-02 12:00:00", 1, quarantine=f"{tmp_path}/bad").collect()
    aside = {r.offset: r.reason for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert [r.offset for r in kept] == [0] and "reason" not in kept[0].asDict()
    assert aside == {2: "machine", 3: "machine,timestamp,usage,send_timestamp", 4: "send_timestamp"}


def test_few_files_and_listing_tasks_for_many_machines(spark, samples):
    """Before, each task wrote its own file for each machine, and each folder was listed by a task of its own."""
    from fleetlake.plans import queries

    n = 300
    events = spark.range(n * 4).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts", f"id % {n} AS user_id",
        "element_at(array('error', 'view', 'click', 'purchase'), int(id % 4) + 1) AS event_type", "0.5D AS value", "'{\"k\": 1}' AS props",
    )
    base = scratch(spark, "tables")
    events.write.parquet(f"{base}/events.parquet")
    seen = []
    real = files.read_test_csv
    try:
        files.read_test_csv = lambda spark, path, *a, **k: seen.append(path) or real(spark, path, *a, **k)
        assert queries.job_csv_quarantine(spark, base).count() == n
    finally:
        files.read_test_csv = real
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = [name for _, _, names in os.walk(seen[0].replace("file:", "")) for name in names if name.startswith("part-")]
    assert n <= len(found) <= n + 2 * tasks


def test_folders_are_named_and_lines_formatted_as_by_spark(spark):
    names = ["plain", "a b+c%", "q'\"#:=?*[x]^{}\\", "", None, "é世"]
    texts = ["x", "a,b", 'say "y"', "", None, " z "]
    rows = spark.createDataFrame([(m, t, i, i / 7) for i, m in enumerate(names) for t in texts], "machine string, `timestamp` string, n int, v double")
    ours, theirs = scratch(spark, "ours"), scratch(spark, "theirs")
    for _ in range(2):
        files.write_folders(rows.repartition(3, "timestamp"), ours, order=["n"])
    rows.drop("n").write.option("header", True).partitionBy("machine").csv(theirs)

    def held(path):
        found = {}
        for folder, _, names in os.walk(path.replace("file:", "")):
            for name in names:
                if name.startswith("part-"):
                    with open(f"{folder}/{name}", encoding="utf-8", newline="") as file:
                        header, *lines = file.read().split("\n")
                    assert header == "timestamp,v"
                    found.setdefault(os.path.basename(folder), []).extend(lines)
        return {name: sorted(lines) for name, lines in found.items()}

    def without_ends(found):
        return {name: [line for line in lines if line] for name, lines in found.items()}

    assert without_ends(held(ours)) == without_ends(held(theirs))


def test_settings_for_reading_are_put_back(spark, data):
    names = ["spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism"]
    before = [spark.conf.get(name) for name in names]
    assert files.staged(files.read_train_csv(spark, data)).count() == 3
    assert [spark.conf.get(name) for name in names] == before


def test_a_load_reads_its_files_once(spark, tmp_path):
    """Before, the files were read for the first row, for staging, and for what follows."""
    (tmp_path / "machine-1").mkdir()
    (tmp_path / "machine-1" / "x_train.csv").write_text("\n".join([HEADER, *[line(str(i), 0, 1.0) for i in range(50)]]) + "\n")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    rows = files.read_train_csv(spark, tmp_path)
    rows = rows.withColumn("timestamp", counted.asNondeterministic()("timestamp"))
    jobs.csv_to_table(first_wins(rows, order=files.FILE_ORDER), KeyedTable(spark, scratch(spark, "table")), "2024-02-01 00:00:00")
    assert seen.value == 50


def test_numbers_without_all_ranges_in_one_task(spark, tmp_path):
    """Before, one window without partitions put all file ranges in order in one task."""
    for machine in range(12):
        (tmp_path / f"machine-{machine:02d}").mkdir()
        (tmp_path / f"machine-{machine:02d}" / "x_train.csv").write_text("\n".join([HEADER, *[line(str(i), 0, 1.0) for i in range(machine % 3 + 1)]]) + "\n")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = files.numbered(files.read_train_csv(spark, tmp_path), start=7)
        assert "windowspecdefinition(_path" not in rows._jdf.queryExecution().optimizedPlan().toString()
        found = rows.orderBy("arrival").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.arrival for r in found] == list(range(7, 31))
    assert [(r.machine, r.timestamp) for r in found] == [(f"machine-{m:02d}", str(i)) for m in range(12) for i in range(m % 3 + 1)]


def test_many_small_files_are_read_as_by_spark(spark, tmp_path, monkeypatch):
    """Small files whole, larger and compressed ones by Spark's reader: the same rows, order and errors."""
    import gzip

    def put(name, *lines, end="\n", header=HEADER, before=b""):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        text = before + end.join([header, *lines]).encode()
        (tmp_path / name).write_bytes(gzip.compress(text) if name.endswith(".gz") else text)

    put("a/machine-1/x.csv", line("1", 0, 0.5), "", "  ", line("2", 1, "bad"), "3,1", line('" 4,""x"', 0, "NaN"), line("5", 0, 1) + ",9,9")
    put("a/machine-1/y.csv", line("6", 0, 2.5), line("", "", ""), ",", end="\r\n")
    put("a/machine 2+%/x.csv", line("ü", 0, 0.25), '"open,1', before=b"\xef\xbb\xbf")
    put("b/machine-3/x.csv", header="\n" + ",".join(f'"{name.upper()}"' for name in CSV_SCHEMA.names))
    put("b/machine-3/empty.csv", header="")
    put("b/machine-4/x.csv.gz", line("7", 0, 7.0))
    put("b/machine-5/x.csv", *[line(str(i), 0, i / 7) for i in range(2000)])
    monkeypatch.setattr(files, "SMALL", 100_000)

    def held(many):
        train = files.read_train_csv(spark, tmp_path, pattern="*/machine*", many=many)
        test = files.read_test_csv(spark, tmp_path, "machine*", pattern="*/{machine}", many=many)
        ordered = [row[:-3] for row in sorted(train.select(*[n for n in train.columns if n not in files.FILE_ORDER], *files.FILE_ORDER).collect(), key=lambda row: row[-3:])]
        return train.columns, test.columns, str(ordered), sorted(map(str, test.collect()))

    assert held(True) == held(False)
    for many in (False, True):
        with pytest.raises(Exception, match="MALFORMED|malformed"):
            files.read_train_csv(spark, tmp_path, pattern="*/machine*", mode="FAILFAST", many=many).collect()
    assert files.read_train_csv(spark, tmp_path, pattern="*/machine-1", many=True).filter("col_0 = 2.5").select("machine").first() == ("machine-1",)
    names = CSV_SCHEMA.names
    for header, checked in (([names[1], names[0], *names[2:]], (False, True)), ([*names, "more"], (True,)), (names[:-1], (True,))):
        put("c/machine-6/x.csv", line("1", 0, 1.0), header=",".join(header))
        for many in checked:
            with pytest.raises(Exception, match="header"):
                files.read_train_csv(spark, tmp_path, pattern="c/machine*", many=many).collect()


def test_tasks_have_folders_of_their_own(spark, samples):
    """Before, all tasks made their folders in one folder, which a file system does one after the other."""
    path = scratch(spark, "csv")
    rows = samples([(f"machine-{i % 9}", str(i), "train", i, i / 7) for i in range(90)])
    files.write_machine_csv(rows, path, apart=True)
    assert all(name.startswith("task=") for name in os.listdir(path))
    back = files.read_train_csv(spark, path, pattern="*/machine=machine-*", many=True).collect()
    assert sorted((r.machine, int(r.timestamp), r.col_0) for r in back) == sorted((f"machine-{i % 9}", i, i / 7) for i in range(90))
