import numpy as np
import pytest

from fleetlake.operators.features import mutual_information, pca_loadings, top_k
from fleetlake.plans import jobs
from fleetlake.schema import FEATURE_NAMES, FEATURES

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def values():
    draw = np.random.default_rng(7)
    base = draw.normal(size=(300, 4)) @ draw.normal(size=(4, 4))
    return base, (base[:, 0] > 0).astype(int) + (base[:, 2] > 1)


@pytest.fixture
def frame(spark, values):
    base, label = values
    rows = [(*map(float, row), int(y)) for row, y in zip(base, label)]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, label int")


def test_loadings_equal_numpy(frame, values):
    found = {r.feature: r.importance for r in pca_loadings(frame, NAMES).collect()}
    _, vectors = np.linalg.eigh(np.cov(values[0].T))
    assert [found[n] for n in NAMES] == pytest.approx(list(np.abs(vectors[:, -1])), abs=1e-9)


def test_missing_counts_as_zero(spark):
    holed = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, float("nan"))], "a double, b double")
    filled = spark.createDataFrame([(1.0, 2.0), (0.0, 1.0), (3.0, 0.0)], "a double, b double")
    assert pca_loadings(holed, ["a", "b"]).collect() == pca_loadings(filled, ["a", "b"]).collect()


def brute_information(x, y, bins):
    low, high = x.min(), x.max()
    codes = np.clip(np.floor((x - low) / ((high - low) / bins)).astype(int), 0, bins - 1)
    total = 0.0
    for code in set(codes):
        for label in set(y):
            joint = np.mean((codes == code) & (y == label))
            if joint:
                total += joint * np.log(joint / (np.mean(codes == code) * np.mean(y == label)))
    return total


@pytest.mark.parametrize("bins", [2, 10])
def test_information_equals_numpy(frame, values, bins):
    found = {r.feature: r.mi for r in mutual_information(frame, NAMES, bins=bins).collect()}
    base, label = values
    assert [found[n] for n in NAMES] == pytest.approx([brute_information(base[:, i], label, bins) for i in range(4)])


def test_information_of_constants_and_given_ranges(spark):
    rows = spark.createDataFrame([(5.0, 0.0, 0), (5.0, 1.0, 1), (5.0, 9.0, 1), (5.0, 9.0, None)], "a double, b double, label int")
    found = {r.feature: r.mi for r in mutual_information(rows, ["a", "b"], bins=2, ranges=[(0, 10), (0, 1)]).collect()}
    assert found["a"] == pytest.approx(0.0)
    assert found["b"] == pytest.approx(np.log(3) - 2 / 3 * np.log(2))


def test_top_k(spark):
    rows = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("a", 3.0)], "feature string, score double")
    assert [r.feature for r in top_k(rows, "score", 2, ["feature"]).collect()] == ["a", "y"]


def test_rank_features(spark):
    draw = np.random.default_rng(3)
    rows = []
    for _ in range(80):
        y = int(draw.integers(2))
        rows.append((float(y), *[float(v) for v in draw.normal(size=38)]))
    rows = [(r[0], r[1] + 50 * r[0], *r[2:]) for r in rows]
    frame = spark.createDataFrame(rows, ", ".join(["label double", *[f"{n} double" for n in FEATURES]]))
    information, loadings = jobs.rank_features(frame, k=3), jobs.rank_features(frame, "component", k=3)
    assert information.first().feature == loadings.first().feature == FEATURE_NAMES[0]
    assert information.count() == loadings.count() == 3


def test_infinite_values_fall_into_the_outer_bins(spark):
    rows = [(float(v), int(v > 0)) for v in (-1, 0, 1, 2)] + [(float("inf"), 1), (float("-inf"), 0)]
    found = mutual_information(spark.createDataFrame(rows, "a double, label int"), ["a"], bins=3).first().mi
    same = [(v if abs(v) < 9 else (2.0 if v > 0 else -1.0), y) for v, y in rows]
    assert found == pytest.approx(mutual_information(spark.createDataFrame(same, "a double, label int"), ["a"], bins=3).first().mi)
