"""The driver's tables seen as telemetry, for the registered queries and the bench.

Every event becomes one sample: machine = user, tick = day, split = kind of event. All
functions keep every row of the table.
"""

from pyspark.sql import functions as F

from fleetlake.functions.shape import SEND_FORMAT, conform
from fleetlake.schema import COLUMNS, ENVELOPE_SCHEMA, FEATURES
from fleetlake.sinks.topic import envelope
from fleetlake.sources.metrics import BROKERS, LAG, MEMBERS, OFFSET, UNDER_REPLICATED

# Events that count as train samples.
TRAIN = ["click", "view", "signup"]

# Kinds of event that an earlier load is taken to have brought in.
EARLIER = ["error", "view"]


def events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def spread(df, by):
    """``df`` dealt out by a hash of ``by``, at every size: the driver's tables may be a single file."""
    return df.repartition(by)


def latest_time(spark, sf_dir):
    """The time of the newest event, as a scalar subquery: nothing is run here."""
    return events(spark, sf_dir).select(F.max("ts")).scalar()


def samples(spark, sf_dir, keep=("event_id",)):
    """All events as samples; the send time is ISO text."""
    train = ", ".join(f"'{name}'" for name in TRAIN)
    derived = {
        "send_timestamp": f'date_format(ts, "{SEND_FORMAT}")',
        "machine": "concat('machine-', user_id)",
        "timestamp": "date_format(ts, 'yyyy-MM-dd')",
        "usage": f"if(event_type IN ({train}), 'train', 'test')",
        "label": "if(event_type = 'error', 1D, 0D)",
        "col_0": "value",
        "col_1": "try_cast(get_json_object(props, '$.k') AS double)",
        **{f"col_{i}": f"cast(event_id * {i + 1} % 97 AS double) / 97D" for i in range(2, len(FEATURES))},
    }
    wide = [f"{derived[name]} AS `{name}`" for name in COLUMNS]
    return spread(events(spark, sf_dir), "event_id").selectExpr(*keep, *wide)


def messages(spark, sf_dir):
    """All samples as topic messages; the offset is the event id."""
    return envelope(samples(spark, sf_dir), offset="event_id")


def earlier(df):
    """The samples an earlier load brought in: those of two kinds of event."""
    return df.filter(F.col("event_type").isin(*EARLIER))


def segments(spark, sf_dir):
    """The topic as it fills up: first the earlier load's messages, then all the others."""
    whole = samples(spark, sf_dir, keep=["event_id", "event_type"])
    old = F.col("event_type").isin(*EARLIER)
    return envelope(whole.filter(old), offset="event_id"), envelope(whole.filter(~old), offset="event_id")


def damaged_messages(spark, sf_dir):
    """A damaged message for every event, and every document as a message that is no JSON.

    The kind of event decides the damage. Offsets: -1 - event_id, and for
    documents the id as partition -1.
    """
    whole = samples(spark, sf_dir, keep=["event_id", "event_type"])
    text = F.expr(f"to_json(struct({', '.join(COLUMNS)}))")
    opened = F.rtrim(F.expr("to_json(struct(machine))"), F.lit("}"))
    body = (
        F.when(F.col("event_type") == "click", F.rtrim(text, F.lit("}")))
        .when(F.col("event_type") == "view", F.concat(opened, F.lit(',"label":1}')))
        .when(F.col("event_type") == "purchase", F.concat(opened, F.lit(',"label":"x","col_0":0.25}')))
        .when(F.col("event_type") == "signup", F.concat(opened, F.lit(',"label":" 1 ","col_0":NaN}')))
        .otherwise(F.concat(opened, F.lit(',"timestamp":123}')))
    )
    broken = whole.select(
        F.lit(-2).alias("partition"), (-1 - F.col("event_id")).alias("offset"), body.cast("binary").alias("value")
    )
    documents = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")
    prose = documents.select(
        F.lit(-1).alias("partition"), F.col("doc_id").alias("offset"), F.col("text").cast("binary").alias("value")
    )
    return broken.unionAll(prose)


def all_messages(spark, sf_dir):
    """Good and damaged messages together."""
    return messages(spark, sf_dir).unionAll(conform(damaged_messages(spark, sf_dir), ENVELOPE_SCHEMA))


def metric_samples(spark, sf_dir, metrics=(LAG, OFFSET, UNDER_REPLICATED, BROKERS, MEMBERS)):
    """The named metrics scraped at every event; the counter starts again after 5000 messages."""
    topic, part, group = "event_type", "cast(user_id % 3 AS int)", "concat('g', user_id % 2)"
    scraped = {
        LAG: (topic, part, group, "event_id % 500"),
        OFFSET: (topic, part, "NULL", "event_id % 5000"),
        UNDER_REPLICATED: (topic, part, "NULL", "int(event_id % 11 = 0)"),
        BROKERS: ("NULL", "NULL", "NULL", "3"),
        MEMBERS: ("NULL", "NULL", group, "user_id % 5"),
    }
    structs = [
        f"struct('{name}' AS metric, cast({t} AS string) AS topic, cast({p} AS int) AS part, "
        f"cast({g} AS string) AS consumergroup, cast({v} AS double) AS value)"
        for name, (t, p, g, v) in scraped.items()
        if name in metrics
    ]
    return events(spark, sf_dir).selectExpr("ts", "event_id", f"inline(array({', '.join(structs)}))")
