"""A training-corpus pipeline: each stage takes what its predecessor kept and returns a DataFrame.

All stages but the last return the columns of ``documents``. A row with a null doc_id cannot be named, so the
near-duplicate and decontamination stages keep it; a null text is kept by every filter and packed as
an empty document.
"""

import public_tokenizers
from pyspark.sql import functions as F

from fleetlake.llm import decontam, lines, minhash, packing, toxicity
from fleetlake.llm.common import stored, table


def drop_toxic(spark, docs, sf_dir):
    """Documents with a toxicity score of at least 0.3 go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def cut_repeated_lines(spark, docs, sf_dir):
    """Passages that occurred before are cut; a document that held nothing else goes; n_chars is counted anew."""
    had = F.col("text").isNull() | (F.col("text") == "")
    cut = lines.without_repeats(docs.withColumn("__empty", had))
    cut = cut.where("__empty or text <> ''").drop("__empty")
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    gone = minhash.classes(docs, percent=80).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    left = docs.join(gone.hint("merge"), docs["doc_id"] == gone["__gone"], "left_anti")
    return left.where("doc_id is not null").dropDuplicates(["doc_id"]).union(left.where("doc_id is null"))


def drop_contaminated(spark, docs, sf_dir):
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter one, go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark, docs, sf_dir):
    """What is left, in token sequences of 4096."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: SQL can express neither trained scores nor tokens; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
