import numpy as np
import pytest

from fleetlake.operators.neighbours import digamma, neighbour_information
from fleetlake.plans import jobs
from fleetlake.schema import FEATURE_NAMES, FEATURES


def psi(n):
    return -0.57721566490153286 + sum(1.0 / i for i in range(1, int(n)))


def brute_information(x, y, k):
    """All distances, row by row."""
    mine = np.array([np.sum(y == label) > 1 for label in y])
    x, y = x[mine], y[mine]
    terms = []
    for i in range(len(x)):
        far = np.abs(x - x[i])
        same = np.sort(far[(y == y[i]) & (np.arange(len(x)) != i)])
        used = min(k, len(same))
        r = same[used - 1]
        m = np.sum(far < r) if r > 0 else np.sum(far == 0)
        terms.append(psi(used) - psi(len(same) + 1) - psi(m))
    return max(0.0, psi(len(x)) + np.mean(terms))


@pytest.fixture(params=[False, True], ids=["one range", "many ranges"])
def ranges(spark, request):
    """Runs a test with small ranges too, so that neighbours lie across their ends."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"} if request.param else {}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def found(spark, x, y, k):
    rows = [(float(a), None if b is None else int(b)) for a, b in zip(x, y)]
    return neighbour_information(spark.createDataFrame(rows, "a double, label int"), ["a"], k=k).first().mi


def test_digamma(spark):
    rows = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 1000)], "n long")
    values = [row[0] for row in rows.select(digamma(rows["n"])).collect()]
    assert values == pytest.approx([psi(n) for n in (1, 2, 3, 10, 1000)], abs=1e-11)


@pytest.mark.parametrize("k", [1, 3, 5])
def test_equals_all_distances(spark, ranges, k):
    draw = np.random.default_rng(k)
    y = draw.integers(0, 3, size=160)
    x = draw.normal(size=160) + y
    assert found(spark, x, y, k) == pytest.approx(brute_information(x, y, k), abs=1e-9)


def test_equal_values(spark, ranges):
    draw = np.random.default_rng(11)
    y = draw.integers(0, 2, size=200)
    x = draw.integers(0, 40, size=200) / 8 + y * (draw.random(200) < 0.5)
    x[:70] = 0.0
    assert found(spark, x, y, 3) == pytest.approx(brute_information(x, y, 3), abs=1e-9)


def test_rare_labels(spark, ranges):
    x = np.array([1.0, 2.0, 4.0, 8.0, 8.5, 9.0, 20.0, 3.0, 3.5])
    y = np.array([0, 0, 0, 0, 1, 1, 2, 3, 3])
    assert found(spark, x, y, 3) == pytest.approx(brute_information(x, y, 3), abs=1e-9)


def test_rows_without_label_or_value(spark):
    rows = [(1.0, 0), (None, 0), (float("nan"), 1), (5.0, 1), (float("inf"), 1), (7.0, None), (2.0, 0)]
    filled = [(1.0, 0), (0.0, 0), (0.0, 1), (5.0, 1), (1e300, 1), (2.0, 0)]
    mi = neighbour_information(spark.createDataFrame(rows, "a double, label int"), ["a"]).first().mi
    assert mi == pytest.approx(brute_information(*[np.array(c) for c in zip(*filled)], 3), abs=1e-9)


def test_nothing_to_measure(spark):
    empty = spark.createDataFrame([], "a double, label int")
    assert neighbour_information(empty, ["a"]).collect() == []
    alone = spark.createDataFrame([(1.0, 0), (2.0, 1)], "a double, label int")
    assert neighbour_information(alone, ["a"]).collect() == []


def test_rank_by_neighbours(spark):
    draw = np.random.default_rng(3)
    y = draw.integers(0, 2, size=80)
    rows = [(float(b), float(draw.normal() + 50 * b), *map(float, draw.normal(size=37))) for b in y]
    frame = spark.createDataFrame(rows, ", ".join(["label double", *[f"{n} double" for n in FEATURES]]))
    assert jobs.rank_features(frame, "neighbours", k=3).first().feature == FEATURE_NAMES[0]
