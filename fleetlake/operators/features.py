"""Feature analysis: principal component loadings and mutual information."""

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.functions.shape import fill_missing
from fleetlake.schema import FEATURES


def top_k(df, score, k=10, tie=()):
    """The ``k`` rows with the highest score."""
    return order_desc(df, score, tie).limit(k)


def order_desc(df, score, tie=()):
    """Rows by falling score, equal scores by ``tie``."""
    return df.orderBy(F.desc(score), *tie)


def pca_loadings(df, features=tuple(FEATURES), k=10, names=None):
    """Absolute share of every feature in the first of ``k`` principal components.

    Missing values count as 0. Executors reduce the rows to one covariance matrix of
    the features' number squared; the result has one row per feature.
    """
    features = list(features)
    k = min(k, len(features))
    filled = fill_missing(df.selectExpr(*_doubles(features)), features)
    vectors = filled.select(array_to_vector(F.array(*features)).alias("x"))
    components = PCA(k=k, inputCol="x", outputCol="y").fit(vectors).pc.toArray()
    rows = [(name, float(abs(share))) for name, share in zip(names or features, components[:, 0])]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def _doubles(features):
    return [f"cast(`{name}` AS double) AS `{name}`" for name in features]


def feature_ranges(df, features):
    """(lowest, highest) finite value of each feature: one pass, one row."""
    finite = {name: f"CASE WHEN abs(`{name}`) < double('infinity') THEN `{name}` END" for name in features}
    both = ", ".join(f"struct(min({x}) AS low, max({x}) AS high)" for x in finite.values())
    return [tuple(pair) for pair in df.selectExpr(f"array({both}) AS ranges").first()["ranges"]]


def mutual_information(df, features=tuple(FEATURES), label="label", bins=10, ranges=None, names=None):
    """Mutual information, in nats, of each feature's bins with the label.

    Every feature is cut into ``bins`` intervals of equal width over ``ranges`` (by default
    its lowest and highest finite value; infinite ones fall into the outer bins); probabilities are plain
    shares of the rows. Missing values count as 0, rows without a label are left out. Counts are combined before
    the shuffle: at most features x bins x labels of them leave a task.
    """
    features = list(features)
    names = list(names or features)
    labelled = df.filter(F.col(label).isNotNull())
    rows = fill_missing(labelled.selectExpr(f"`{label}` AS _label", *_doubles(features)), features)
    ranges = ranges or feature_ranges(rows, features)

    def bin_of(name, low, high):
        if low is None or high <= low:
            return "0"
        width = (float(high) - float(low)) / bins
        place = f"least(greatest(floor((`{name}` - {float(low)!r}D) / {width!r}D), 0), {bins - 1})"
        ends = f"WHEN `{name}` = double('infinity') THEN {bins - 1} WHEN `{name}` = double('-infinity') THEN 0"
        return f"cast(CASE {ends} ELSE {place} END AS int)"

    codes = ", ".join(bin_of(name, *span) for name, span in zip(features, ranges))
    cells = rows.selectExpr("_label", f"posexplode(array({codes})) AS (_feature, _bin)")
    joint = cells.groupBy("_feature", "_bin", "_label").agg(F.count("*").alias("n"))
    shares = (
        joint.withColumn("_all", F.sum("n").over(Window.partitionBy("_feature")))
        .withColumn("_in_bin", F.sum("n").over(Window.partitionBy("_feature", "_bin")))
        .withColumn("_of_label", F.sum("n").over(Window.partitionBy("_feature", "_label")))
    )
    gain = F.log(F.col("n").cast("double") * F.col("_all") / (F.col("_in_bin").cast("double") * F.col("_of_label")))
    information = shares.groupBy("_feature").agg((F.sum(F.col("n") * gain) / F.max("_all")).alias("mi"))
    return information.select(F.get(F.lit(names), F.col("_feature")).alias("feature"), "mi")
