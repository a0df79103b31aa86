"""The telemetry sample: its columns, key, types and feature dictionary."""

from pyspark.sql import types as T

# 38 metrics per sample, named by position.
FEATURES = [f"col_{i}" for i in range(38)]

# One sample per machine, tick and split. ``timestamp`` is a tick label, never a time.
KEY = ["machine", "timestamp", "usage"]

COLUMNS = ["send_timestamp", *KEY, "label", *FEATURES]


def _sample(send_type, label_type):
    return T.StructType(
        [T.StructField("send_timestamp", send_type)]
        + [T.StructField(name, T.StringType()) for name in KEY]
        + [T.StructField("label", label_type)]
        + [T.StructField(name, T.DoubleType()) for name in FEATURES]
    )


# A sample as it travels in a message: the send time is still ISO text.
MESSAGE_SCHEMA = _sample(T.StringType(), T.DoubleType())


def message_fields(*names):
    """The part of the message schema with these fields; parsing only them is much cheaper."""
    return T.StructType([MESSAGE_SCHEMA[name] for name in names])


# A sample as it is stored.
TABLE_SCHEMA = _sample(T.TimestampType(), T.IntegerType())

# The columns of a raw sample file.
CSV_SCHEMA = T.StructType(
    [T.StructField("timestamp", T.StringType()), T.StructField("label", T.IntegerType())]
    + [T.StructField(name, T.DoubleType()) for name in FEATURES]
)

# The envelope in which a message broker hands out a message.
ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Arrival order of a message; a key always travels in one partition.
ARRIVAL = ["partition", "offset"]

# The meaning of col_0 ... col_37, in order.
FEATURE_NAMES = [
    "cpu_r", "load_1", "load_5", "load_15",
    "mem_shmem", "mem_u", "mem_u_e", "total_mem",
    "disk_q", "disk_r", "disk_rb", "disk_svc", "disk_u", "disk_w", "disk_wa", "disk_wb",
    "si", "so",
    "eth1_fi", "eth1_fo", "eth1_pi", "eth1_po",
    "tcp_tw", "tcp_use", "active_opens", "curr_estab",
    "in_errs", "in_segs", "listen_overflows", "out_rsts", "out_segs",
    "passive_opens", "retransegs", "tcp_timeouts",
    "udp_in_dg", "udp_out_dg", "udp_rcv_buf_errs", "udp_snd_buf_errs",
]

# Feature groups with their stated influence on anomalies.
GROUPS = {
    "cpu_load": ("very high", ["cpu_r", "load_1", "load_5", "load_15"]),
    "memory": ("high", ["mem_shmem", "mem_u", "mem_u_e", "total_mem", "si", "so"]),
    "disk_io": ("high", ["disk_q", "disk_r", "disk_rb", "disk_svc", "disk_u", "disk_w", "disk_wa", "disk_wb"]),
    "network": ("medium", ["eth1_fi", "eth1_fo", "eth1_pi", "eth1_po"]),
    "tcp": ("high", ["tcp_tw", "tcp_use", "active_opens", "curr_estab", "passive_opens", "retransegs", "tcp_timeouts"]),
    "udp": ("medium", ["udp_in_dg", "udp_out_dg", "udp_rcv_buf_errs", "udp_snd_buf_errs"]),
}

# Informativeness tiers (1 is the most informative) with the suggested methods.
TIERS = {
    1: ("PCA / AE", ["cpu_r", "load_1", "load_5", "load_15"]),
    2: ("PCA / AE", ["mem_u", "mem_shmem", "si", "so"]),
    3: ("PCA / AE", ["disk_q", "disk_svc", "disk_u"]),
    4: ("AE / MI", ["tcp_timeouts", "retransegs", "active_opens"]),
    5: ("AE", ["udp_rcv_buf_errs", "udp_snd_buf_errs"]),
}

COLUMN_OF = dict(zip(FEATURE_NAMES, FEATURES))
NAME_OF = dict(zip(FEATURES, FEATURE_NAMES))


def group_columns(group):
    """The ``col_i`` names of one feature group."""
    return [COLUMN_OF[name] for name in GROUPS[group][1]]
