"""Chat formatting in Spark expressions only.

Method. The turns of a conversation are collected as structs and sorted; adjacent turns of one role are
merged with an array aggregation; the messages are concatenated. A message is

    <|im_start|>ROLE line-end TEXT <|im_end|> line-end

Texts of turns merged into one message are parted by <|turn|>, so the turns can be read back. In roles
and texts a backslash is doubled and ``<|`` becomes ``<\\|`` first, hence no control string can stand in
them; a line end in a role becomes <|line|>. ``unescaped`` reverses all of it. The loss mask covers the
texts of assistant messages, from behind the role's line end up to <|im_end|>.

Scale. One shuffle by conversation; a conversation is one row, as its formatted text is. Turns are merged
with an aggregation whose state is the message under way, so the work is linear in the turns.

Rows: a null text or role is empty. A null conv_id is a conversation of its own. Turns are ordered by
turn (null first); ties by role, then text. Repeated rows are turns of their own. An empty table gives
an empty result. Only conv_id, turn, role and text are read.
"""

from pyspark.sql import functions as F

START, END, TURN, LINE = "<|im_start|>", "<|im_end|>", "<|turn|>", "<|line|>"
LEARNT = "assistant"


def replaced(column, old, new):
    return F.replace(column, F.lit(old), F.lit(new))


def escaped(text):
    """The text without control strings, reversibly."""
    return replaced(replaced(text, "\\", "\\\\"), "<|", "<\\|")


def unescaped(text):
    return replaced(replaced(text, "<\\|", "<|"), "\\\\", "\\")


def written_role(role):
    return replaced(escaped(role), "\n", LINE)


def read_role(role):
    return unescaped(replaced(role, LINE, "\n"))


def formatted(conversations):
    """One row per conversation: conv_id, and the whole formatted text."""
    turn = F.struct(
        F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    size = F.size("turns")
    # Each turn with its neighbours' roles: a message begins and ends where they differ.
    role, none = F.transform("turns", lambda t: t["role"]), F.array(F.lit(None).cast("string"))
    beside = F.arrays_zip(
        F.col("turns").alias("now"), F.concat(none, role).alias("before"), F.concat(F.slice(role, 2, size), none).alias("after")
    )

    def part(x):
        now = x["now"]
        opening = F.when(now["role"].eqNullSafe(x["before"]), F.lit(TURN)).otherwise(
            F.concat(F.lit(START), written_role(now["role"]), F.lit("\n"))
        )
        closing = F.when(now["role"].eqNullSafe(x["after"]), F.lit("")).otherwise(F.lit(END + "\n"))
        return F.concat(opening, escaped(now["text"]), closing)

    return turns.select("conv_id", F.array_join(F.transform(F.slice(beside, 1, size), part), "").alias("formatted"))


def quoted(text):
    return "\\Q" + text + "\\E"


def messages(text):
    """A formatted text as an array of (role, body): the body is as written, between role and end mark."""
    parts = F.slice(F.split(text, quoted(START)), 2, F.length(text))

    def read(part):
        at = F.instr(part, "\n")
        return F.struct(
            read_role(F.substring(part, F.lit(1), at - 1)).alias("role"),
            F.substring(part, at + 1, F.length(part) - at - len(END) - 1).alias("body"),
        )

    return F.transform(parts, read)


def turns(text):
    """A formatted text as an array of (role, text), a row of the table each."""
    return F.flatten(F.transform(
        messages(text),
        lambda m: F.transform(F.split(m["body"], quoted(TURN)), lambda t: F.struct(m["role"].alias("role"), unescaped(t).alias("text"))),
    ))


def loss_spans(text):
    """(start, length) in code points of what the loss mask covers: the bodies of assistant messages.

    Where each message starts is a running sum over the messages' lengths.
    """
    parts = F.slice(F.split(text, quoted(START)), 2, F.length(text))
    empty = F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state, part):
        head = F.instr(part, "\n")
        body = state["at"] + len(START) + head
        learnt = read_role(F.substring(part, F.lit(1), head - 1)) == LEARNT
        span = F.array(F.struct(body.cast("int").alias("start"), (F.length(part) - head - len(END) - 1).cast("int").alias("length")))
        return F.struct(
            (state["at"] + len(START) + F.length(part)).cast("int").alias("at"),
            F.when(learnt, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(parts, empty, step, lambda state: state["spans"])


def learnt(text):
    """All text under the loss mask, unescaped, nothing between."""
    spans = F.transform(loss_spans(text), lambda s: F.substring(text, s["start"] + 1, s["length"]))
    return F.array_join(F.transform(spans, lambda body: unescaped(replaced(body, TURN, ""))), "")


def digests(frame):
    """What a formatted text holds, read back from it; ``frame`` has conv_id and formatted."""
    text = F.col("formatted")
    said = frame.select("conv_id", text, turns(text).alias("turns"), learnt(text).alias("learnt"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return said.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"), F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length(text).cast("long").alias("formatted_chars"),
    )
