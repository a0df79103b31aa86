"""Mutual information of a continuous feature with a label by nearest neighbours (Ross 2014): no bins, no pairs.

Equal values are counted together first, so a value that a third of all rows hold is one row. What is left has to be
ordered twice, in ranges of equal size: by label, where a value's k nearest others stand among the k before and
the k after it, and without labels, where running counts tell how many values lie within a distance. Values at the ends of
ranges look across by a second pass over those few alone; running counts go on where the range before ended.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.functions.shape import fill_missing
from fleetlake.schema import FEATURES
from fleetlake.session import scratch

# What an infinite value counts as; distances between two of them stay finite.
FARTHEST = "1E300D"


def digamma(n):
    """The digamma function of a column of positive whole numbers, to about twelve digits."""
    x = n.cast("double") + 10.0
    far = F.log(x) - 0.5 / x - 1 / (12.0 * x**2) + 1 / (120.0 * x**4) - 1 / (252.0 * x**6) + 1 / (240.0 * x**8)
    return far - sum((1 / (n.cast("double") + i) for i in range(1, 10)), 1 / n.cast("double"))


def value_counts(df, features, label):
    """Rows per ``_feature`` (its place in ``features``), ``_label`` and value ``_x``."""
    doubles = [f"cast(`{name}` AS double) AS `{name}`" for name in features]
    rows = fill_missing(df.filter(F.col(label).isNotNull()).selectExpr(f"`{label}` AS _label", *doubles), features)
    finite = ", ".join(f"greatest(least(`{name}`, {FARTHEST}), -{FARTHEST})" for name in features)
    cells = rows.selectExpr("_label", f"posexplode(array({finite})) AS (_feature, _x)")
    return cells.groupBy("_feature", "_label", "_x").agg(F.count("*").alias("n"))


def _span(k):
    """The open interval around ``_x`` that reaches to its k-th nearest other value, from the values around it.

    It is empty (both ends are ``_x``) if k others equal ``_x``, and NULL if there is no other. Where a neighbour lies at an end, the
    end is its very value, so rounding of a difference does not let it in.
    """
    others = "array_sort(transform(array_compact(concat(_before, _after)), p -> struct(abs(p._x - _x) AS d, p._x AS x, p.n AS n)))"
    walk = (
        f"aggregate(_others, struct(n - 1 AS seen, 0D AS r), "
        f"(a, p) -> if(a.seen >= {k}, a, struct(a.seen + p.n AS seen, p.d AS r)))"
    )
    low = "coalesce(array_max(transform(filter(_others, p -> p.d = _walk.r AND p.x < _x), p -> p.x)), _x - _walk.r)"
    high = "coalesce(array_min(transform(filter(_others, p -> p.d = _walk.r AND p.x > _x), p -> p.x)), _x + _walk.r)"
    span = f"CASE WHEN _walk.seen > 0 THEN if(_walk.r = 0, struct(_x AS low, _x AS high), struct({low} AS low, {high} AS high)) END"
    return {"_others": F.expr(others)}, {"_walk": F.expr(walk)}, {"_span": F.expr(span)}


def neighbour_spans(cells, k):
    """``cells`` with ``_span``, see ``_span``, among the values of the same feature and label."""
    group = ["_feature", "_label"]
    rows = cells.repartitionByRange(*group, "_x").withColumn("_range", F.spark_partition_id())
    point, steps = F.struct("_x", "n"), range(1, k + 1)
    here = Window.partitionBy(*group, "_range").orderBy("_x")
    rows = rows.withColumns({
        "_before": F.array(*[F.lag(point, i).over(here) for i in steps]),
        "_after": F.array(*[F.lead(point, i).over(here) for i in steps]),
    })
    # Values with fewer than k others of their range on a side; at most 2k of a range and group.
    edge = F.get("_before", F.lit(k - 1)).isNull() | F.get("_after", F.lit(k - 1)).isNull()
    rows = rows.withColumn("_edge", edge)
    for columns in _span(k):
        rows = rows.withColumns(columns)
    rows = rows.select(
        *group, "_x", "n",
        F.when(F.col("_edge"), F.lit(-1)).otherwise(F.col("_range")).alias("_range"),
        F.when(~F.col("_edge"), F.col("_span")).alias("_inner"),
        *[F.when(F.col("_edge"), F.col(side)).alias(side) for side in ("_before", "_after")],
    )
    across = Window.partitionBy(*group, "_range").orderBy("_x")
    rows = rows.withColumns({
        side: F.array(*[F.coalesce(F.get(side, F.lit(i - 1)), step(point, i).over(across)) for i in steps])
        for side, step in (("_before", F.lag), ("_after", F.lead))
    })
    for columns in _span(k):
        rows = rows.withColumns(columns)
    return rows.select(*group, "_x", "n", F.coalesce("_inner", "_span").alias("_span")).filter("_span IS NOT NULL")


def counts_within(spans):
    """``m`` for every row: the rows of its feature, whatever their label, inside its ``_span``; itself included.

    An empty span holds the rows equal to ``_x``.
    """
    session = spans.sparkSession
    # At one place: what asks for values below it, the values, what asks for values up to it.
    asked = spans.selectExpr(
        "_feature", "_label", "_x", "n",
        "inline(array(struct(_x AS _at, 1 AS _turn, n AS _weight, 0 AS _sign), "
        "struct(_span.low AS _at, if(_span.low = _span.high, 0, 2) AS _turn, 0L AS _weight, -1 AS _sign), "
        "struct(_span.high AS _at, if(_span.low = _span.high, 2, 0) AS _turn, 0L AS _weight, 1 AS _sign)))",
    )
    placed = asked.repartitionByRange("_feature", "_at", "_turn", "_label", "_x").withColumn("_range", F.spark_partition_id())
    path = scratch(session, "placed-values")  # written once, so that both uses look at the same ranges
    placed.write.parquet(path)
    placed = session.read.schema(placed.schema).parquet(path)
    ranges = placed.groupBy("_feature", "_range").agg(F.sum("_weight").alias("_all"))
    earlier = Window.partitionBy("_feature").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # What lies in earlier ranges comes as the first value of a range.
    start = ranges.select("_feature", "_range", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_weight"), F.lit(-1).alias("_turn"))
    running = Window.partitionBy("_feature", "_range").orderBy(F.col("_turn") >= 0, "_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    whole = placed.unionByName(start, allowMissingColumns=True).withColumn("_below", F.sum("_weight").over(running))
    asking = whole.filter("_sign <> 0")
    return asking.groupBy("_feature", "_label", "_x").agg(
        F.sum(F.col("_sign") * F.col("_below")).alias("m"), F.max("n").alias("n")
    )


def neighbour_information(df, features=tuple(FEATURES), label="label", k=3, names=None):
    """Mutual information, in nats, of each feature with the label, by the ``k`` nearest rows of the same label; at least 0.

    Missing values count as 0, infinite ones as 1e300 with their sign. Rows without a label are left out, and those of a label that has
    one row only; a label with at most ``k`` rows uses all its others. Distances are taken as they are: no noise parts equal
    values. A row's neighbours within its distance are those strictly nearer, itself and its equals. A table without rows gives none.
    """
    features = list(features)
    names = list(names or features)
    counted = counts_within(neighbour_spans(value_counts(df, features, label), k))
    labels = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("c")).filter("c > 1")
    c = F.col("c")
    of_labels = F.sum(c * (digamma(F.least(F.lit(k), c - 1)) - digamma(c))) / F.sum(c)
    shared = labels.select((digamma(F.sum(c)) + of_labels).alias("shared")).scalar()
    means = counted.groupBy("_feature").agg((F.sum(F.col("n") * digamma(F.col("m"))) / F.sum("n")).alias("mean"))
    return means.select(
        F.get(F.lit(names), F.col("_feature")).alias("feature"), F.greatest(F.lit(0.0), shared - F.col("mean")).alias("mi")
    )
