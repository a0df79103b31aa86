"""From message bytes to typed samples, strictly or leniently.

Both decoders are narrow: one ``from_json`` per message inside the scan stage. The parsed
object is unpacked by ``inline``, a generator, because later filters on its fields are
not copied below a generator: each copy would parse the message once more.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.schema import FEATURES, KEY, MESSAGE_SCHEMA

CORRUPT = "_corrupt_record"


def value_as_string(df, column="value"):
    """The message payload as text."""
    return df.withColumn(column, F.col(column).cast("string"))


def decode_strict(df, schema=MESSAGE_SCHEMA, keep=(), corrupt=False):
    """Every message becomes one row of ``schema``; what does not fit becomes NULL.

    ``keep`` names envelope columns to carry along, a smaller ``schema`` saves parsing. With
    ``corrupt`` the text of a message that is no JSON object, or has a field of another
    type, is returned in ``_corrupt_record``.
    """
    fields = schema
    if corrupt:
        fields = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    data = F.from_json(F.col("value").cast("string"), fields)
    return df.select(*keep, F.inline(F.array(data)))


# An integer literal with optional blanks around it.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"

# A metric whose value is in quotes.
QUOTED_METRIC = r'"col_[0-9]+"\s*:\s*"'

# Closes the array a lenient message is wrapped in; its presence proves that nothing
# followed the message's own object.
END = "end of message"


def _lenient_label(label):
    """The label as an int, or NULL where a message with this label is dropped.

    The JSON token type decides: an absent label is 0, a number is cut towards zero,
    true and false are 1 and 0, text counts only as an integer literal.
    """
    other_text = (F.schema_of_variant(label) == "STRING") & ~label.cast("string").rlike(INTEGER_TEXT)
    return (
        F.when(label.isNull(), F.lit(0))
        .when(other_text, F.lit(None).cast("int"))
        .otherwise(F.try_variant_get(label, "$", "int"))
    )


def decode_lenient(df, features=tuple(FEATURES), keep=()):
    """Messages that are exactly one JSON object with a usable label; all others are dropped.

    Fields that are absent are NULL. Metrics may be quoted numbers; only messages that have
    such are parsed as text and cast, which takes three times as long. One parse gives
    everything: the label is read as a variant because its token type matters.
    """
    text = F.col("value").cast("string")
    names = ["send_timestamp", *KEY]

    def parse(metric_type):
        fields = ", ".join(
            [f"`{name}` string" for name in names]
            + ["`label` variant"]
            + [f"`{name}` {metric_type}" for name in features]
            + [f"`{END}` boolean"]
        )
        wrapped = f"""concat('[', cast(value AS string), ',{{"{END}":true}}]')"""
        return f"from_json({wrapped}, 'array<struct<{fields}>>', map('allowSingleQuotes', 'false'))"

    # The text of an unquoted NaN comes with quotes.
    fields = (
        [f"'{name}', part.`{name}`" for name in (*names, "label")]
        + [f"'{name}', try_cast(trim(BOTH '\"' FROM part.`{name}`) AS double)" for name in features]
        + [f"'{END}', part.`{END}`"]
    )
    cast = f"transform({parse('string')}, part -> if(part IS NULL, NULL, named_struct({', '.join(fields)})))"
    parts = (
        F.when(~F.is_valid_utf8(text), F.lit(None))
        .when(text.rlike(QUOTED_METRIC), F.expr(cast))
        .otherwise(F.expr(parse("double")))
    )
    whole = df.select(*keep, parts.alias("parts"))
    message, end = F.get("parts", F.lit(0)), F.get("parts", F.lit(1))[END]
    proper = F.when((F.size("parts") == 2) & end & message.isNotNull(), F.array(message))
    rows = whole.select(*keep, F.inline(proper))
    rows = rows.select(*keep, *names, _lenient_label(F.col("label")).alias("label"), *features)
    return rows.filter(F.col("label").isNotNull())


def parse_send_timestamp(df, column="send_timestamp"):
    """ISO text to a timestamp in the session zone; other text becomes NULL."""
    return df.withColumn(column, F.try_to_timestamp(F.col(column)))
