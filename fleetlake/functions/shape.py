"""Column shaping: typing, tagging, renaming, conforming and encoding of samples."""

from pyspark.sql import functions as F

from fleetlake.functions.decode import INTEGER_TEXT
from fleetlake.schema import COLUMNS, FEATURES, KEY, NAME_OF, TABLE_SCHEMA, group_columns

# Fixed value: the form of a send time in a message.
SEND_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# A floating-point literal with optional blanks around it.
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

# A file of one machine lies in a directory named after it, or in the same
# directory as the writer's partition layout spells it.
MACHINE_IN_PATH = r"/(?:machine=)?([^/]+)/[^/]+$"


def select_prefix(df, prefix="col_", keep=()):
    """``keep`` and every column whose name starts with ``prefix``."""
    return df.select(*keep, *[name for name in df.columns if name.startswith(prefix)])


def conform(df, schema=TABLE_SCHEMA, keep=()):
    """Exactly the columns of ``schema``, in order and type; a missing one is NULL."""
    have = set(df.columns)
    fixed = [
        f"try_cast({f'`{f.name}`' if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ]
    return df.selectExpr(*keep, *fixed)


def to_str(column):
    """Bytes or any value as text; bytes that are no UTF-8 are left out."""
    return F.replace(F.make_valid_utf8(F.col(column).cast("string")), F.lit("�"), F.lit(""))


def sniffed_number(text):
    """(kind, num) of a text column, guessed per value.

    Text with ``.``, ``e`` or ``E`` may be a float, other text an int; what does not
    read as that number stays a string.
    """
    looks_float = text.rlike("[.eE]")
    kind = (
        F.when(looks_float & text.rlike(FLOAT_TEXT), "float")
        .when(~looks_float & text.rlike(INTEGER_TEXT), "int")
        .when(text.isNotNull(), "string")
    )
    return kind, F.when(kind.isin("float", "int"), F.trim(text).try_cast("double"))


def sniff_number(df, column="text", keep=()):
    """Guess the type of an undeclared text column per value: ``kind`` and ``num``."""
    kind, num = sniffed_number(F.col(column))
    return df.select(*keep, kind.alias("kind"), num.alias("num"))


def parse_fields(df, features=tuple(FEATURES), keep=()):
    """Type a frame of text columns: key fields text, label int, metrics double."""
    metrics = [f"try_cast(`{name}` AS double) AS `{name}`" for name in features if name in df.columns]
    label = ["try_cast(label AS int) AS label"] if "label" in df.columns else []
    declared = {*KEY, "label", *features, *keep}
    return df.withColumns({name: to_str(name) for name in KEY if name in df.columns}).selectExpr(
        *keep,
        *[f"`{name}`" for name in KEY if name in df.columns],
        *label,
        *metrics,
        *[f"`{name}`" for name in df.columns if name not in declared],
    )


def tag_split(df, split):
    """Set ``usage``; samples of the train split are normal by definition, so label 0."""
    tagged = df.withColumn("usage", F.lit(split))
    return tagged.withColumn("label", F.lit(0.0)) if split == "train" else tagged


def machine_from_path(df):
    """``machine``: the name, whatever it is, of the directory of the file a row was read from; NULL if there is none."""
    path = F.try_url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return df.withColumn("machine", F.nullif(F.regexp_extract(path, MACHINE_IN_PATH, 1), F.lit("")))


def stamp_send_time(df, as_of=None):
    """Ingestion time as ISO text; ``as_of`` (text or datetime in the session zone) fixes it."""
    moment = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    return df.withColumn("send_timestamp", F.date_format(moment, SEND_FORMAT))


def message_key(machine="machine", usage="usage"):
    """The key that keeps all samples of one machine and split in one partition."""
    return F.concat_ws("-", machine, usage)


def encode_json(df, columns=tuple(COLUMNS), keep=()):
    """Rows to ``key`` and ``value`` bytes.

    Times must already be text: the JSON writer cuts timestamps to milliseconds.
    Fields that are NULL are written as null, so each message names all its fields.
    """
    names = ", ".join(f"`{name}`" for name in columns)
    body = F.expr(f"to_json(struct({names}), map('ignoreNullFields', 'false'))")
    return df.select(*keep, message_key().cast("binary").alias("key"), body.cast("binary").alias("value"))


def rename_features(df):
    """``col_i`` to the metric's name."""
    return df.withColumnsRenamed({name: NAME_OF[name] for name in df.columns if name in NAME_OF})


def select_group(df, group, keep=tuple(KEY)):
    """The columns of one feature group."""
    return df.select(*keep, *group_columns(group))


def fill_missing(df, features=tuple(FEATURES), value=0.0):
    """NULL and NaN metrics become ``value``."""
    return df.fillna(value, subset=list(features))
