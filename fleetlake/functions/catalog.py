"""The feature dictionary as a table, and statistics of metrics against it."""

from pyspark.sql import functions as F

from fleetlake.schema import COLUMN_OF, FEATURE_NAMES, FEATURES, GROUPS, TIERS


def feature_catalog(spark):
    """One row per metric: column, feature, feature_group, influence, tier, methods (38 rows)."""
    group_of = {name: (group, influence) for group, (influence, names) in GROUPS.items() for name in names}
    tier_of = {name: (tier, methods) for tier, (methods, names) in TIERS.items() for name in names}
    rows = [
        (COLUMN_OF[name], name, *group_of.get(name, (None, None)), *tier_of.get(name, (None, None)))
        for name in FEATURE_NAMES
    ]
    return spark.createDataFrame(
        rows,
        "column string, feature string, feature_group string, influence string, tier int, methods string",
    )


def catalog_stats(df, features=tuple(FEATURES)):
    """Rows and mean value per feature group and tier.

    Each metric is first reduced to one count and sum over the wide rows, so nothing
    is multiplied by the number of metrics; only those 38 results meet the catalog,
    whose size is fixed.
    """
    sums = ", ".join(f"struct('{name}' AS column, count({name}) AS n, sum({name}) AS total)" for name in features)
    totals = df.selectExpr(f"array({sums}) AS sums").selectExpr("inline(sums)")
    return (
        totals.join(F.broadcast(feature_catalog(df.sparkSession)), "column")
        .groupBy("feature_group", "influence", "tier")
        .agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"))
    )
