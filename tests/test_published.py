import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import jobs
from fleetlake.session import drop_scratch, put_new, scratch
from fleetlake.sinks.published import ExportDamagedError, Publication


def values(publication, number=None):
    return sorted(r.col_0 for r in publication.read(number).collect())


@pytest.fixture
def rows(samples):
    return lambda *numbers: samples([("m", str(n), "train", n, float(n)) for n in numbers])


@pytest.fixture(params=["csv", "parquet"])
def publication(spark, request):
    return Publication(spark, scratch(spark, "published"), request.param)


def test_the_newest_is_read_and_older_ones_stay(publication, rows):
    first, second = publication.publish(rows(1, 2)), publication.publish(rows(3))
    assert (first["rows"], second["rows"], second["number"]) == (2, 1, 2)
    assert values(publication) == [3.0] and values(publication, 1) == [1.0, 2.0]
    publication.expire()
    assert publication.numbers() == [2] and values(publication) == [3.0]
    with pytest.raises(FileNotFoundError):
        publication.manifest(1)
    assert publication.publish(rows(4))["number"] == 3


def test_a_failed_export_leaves_the_old_one(publication, rows):
    publication.publish(rows(1, 2))
    broken = rows(3, 4).withColumn("col_0", F.when(F.col("col_0") > 3, F.raise_error(F.lit("lost"))).otherwise(F.col("col_0")))
    with pytest.raises(Exception, match="lost"):
        publication.publish(broken)
    assert publication.numbers() == [1] and values(publication) == [1.0, 2.0]


def test_a_manifest_that_is_being_written_is_not_read(spark, publication, rows):
    publication.publish(rows(1))
    put_new(spark, f"{publication.path}/_manifests/2.json", '{"number": 2, "fol')
    assert values(publication) == [1.0]
    assert publication.publish(rows(5))["number"] == 3 and values(publication) == [5.0]


def test_another_writer_took_the_number(spark, publication, rows, monkeypatch):
    publication.publish(rows(1))
    seen = iter([[], [1]])
    monkeypatch.setattr(publication, "numbers", lambda: next(seen))
    assert publication.publish(rows(2))["number"] == 2
    monkeypatch.undo()
    assert values(publication) == [2.0] and values(publication, 1) == [1.0]


def test_a_run_is_published_once(publication, rows):
    first = publication.publish(rows(1), "monday")
    publication.publish(rows(2), "tuesday")
    assert publication.publish(rows(9), "monday") == first
    assert values(publication) == [2.0]


def test_files_of_bounded_rows_and_damage(spark, publication, rows):
    manifest = publication.publish(rows(*range(25)).coalesce(1), max_rows=10)
    assert len(manifest["files"]) == 3 and manifest["rows"] == 25 and len(values(publication)) == 25
    drop_scratch(spark, f"{publication.path}/{manifest['folder']}/{next(iter(manifest['files']))}")
    with pytest.raises(ExportDamagedError):
        publication.read()


def test_empty_export_and_nothing_published(publication, rows):
    with pytest.raises(FileNotFoundError):
        publication.read()
    assert publication.publish(rows(1).where("col_0 > 5"))["rows"] == 0
    assert values(publication) == []


def test_job(publication, rows):
    stored = rows(1, 2).unionByName(rows(3).withColumn("usage", F.lit("test")))
    as_of = datetime.datetime(2023, 11, 15)
    manifest = jobs.publish_split(stored, publication, as_of, days=30)
    assert jobs.publish_split(stored, publication, as_of, days=30) == manifest
    assert manifest["rows"] == 2 and values(publication) == [1.0, 2.0]
