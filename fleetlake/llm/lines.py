"""Repeated passages by content-defined chunks of lines, in Spark expressions only.

Method. A text is cut into lines that are not blank; blank lines belong to the line before them and are not
compared. Each line is hashed. A rolling hash over the hashes of two neighbouring lines decides whether a chunk
ends after the second, so a boundary depends on the lines around it alone and moves with them: a passage copied
into another text is cut at the same places there. Such chunks miss the ends of a copied passage, and its chunks
of one line say little alone. So content also bounds chunks that overlap: from each line on, and back from each
line, the fewest lines that hold more than ``PASSAGE`` words. Whatever run of more words than that two places
share, these chunks of it cover all its lines. Chunks of several lines, and single lines of more than ``PASSAGE``
words, that occur more than once in the corpus, in other documents or in the same, are found by hash. The first
occurrence by (doc_id, line) stays, the lines of the others go once they are compared, byte by byte, with lines they
repeat; a line whose bytes differ stays. Single lines outside such runs stay, however often they occur.

Scale. What is stored and shuffled to find repeats is a hash and a range of lines per chunk, combined per task
first, so a passage in a third of all texts costs a row per task. Texts are shuffled once, to the lines they lose
and those that others lose for theirs; for the comparison such lines alone are, combined per task. A text of n words
costs n steps; hashing reads a line once for each of its chunks, up to twice the words of a passage if each line is
a word. Joins with what grows with the corpus are merge joins at every size.

Rows: a null text stays null and an empty one empty; neither has lines. A null doc_id takes no part
and its row is returned as it is. Rows that repeat a document lose the same lines. A text that
loses all its lines is empty. An empty table gives an empty result. Only doc_id and text are
read; other columns are passed on whatever their names.
"""

from pyspark.sql import functions as F

from fleetlake.llm.common import stored

PASSAGE, DIVISOR = 50, 2


def line_hash(line):
    """32 bits of a line's MD5, a hash that other engines have as well."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def cut_lines(text):
    """The lines of a text that are not blank, each with the blank lines behind it; blank lines at the very start are one more."""
    return F.split(text, r"\n(?=[^\n]*\S)")


def _range(start, end):
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))


def with_chunks(frame, divisor=DIVISOR):
    """``frame`` with ``lines``, those of ``text``, and ``chunks``, the first and last line of each chunk to compare.

    A chunk ends after line i where (hash of line i + 31 * hash of line i - 1), shifted by 3 bits, is a
    multiple of the divisor (the line before the first has hash 0). For chunks that overlap, an array holds
    the line of each word; what lies ``PASSAGE`` words on is looked up there, so a text of n words costs n steps.
    The steps are columns of their own, so each is computed once.
    """
    frame = frame.withColumn("lines", F.transform(cut_lines("text"), lambda x: F.substring_index(x, "\n", 1)))
    frame = frame.withColumn("hashes", F.transform("lines", line_hash))
    last = F.size("lines") - 1

    def ended(i):
        rolled = F.shiftright(F.get("hashes", i) + 31 * F.coalesce(F.get("hashes", i - 1), F.lit(0).cast("long")), 3)
        return (rolled % divisor == 0) | (i == last)

    frame = frame.withColumn("ends", F.filter(F.sequence(F.lit(0), last), ended))
    cut = F.transform("ends", lambda e, k: _range(F.coalesce(F.get("ends", k - 1) + 1, F.lit(0)), e))
    several = F.filter(cut, lambda c: c["start"] < c["end"])

    frame = frame.withColumn("of_word", F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.regexp_count(x, F.lit(r"\S+"))))))

    def other(k, j):
        return ~F.get("of_word", k).eqNullSafe(F.get("of_word", j))

    # Words that begin a line, or are PASSAGE words before one that ends a line.
    places = F.filter(
        F.sequence(F.lit(0), F.size("of_word") - 1 - PASSAGE), lambda k: other(k, k - 1) | other(k + PASSAGE, k + PASSAGE + 1)
    )
    overlapping = F.transform(places, lambda k: _range(F.get("of_word", k), F.get("of_word", k + PASSAGE)))
    frame = frame.withColumn("overlapping", F.when(F.size("of_word") > PASSAGE, overlapping))
    chunks = F.array_union(several, F.coalesce("overlapping", F.filter(several, lambda c: F.lit(False))))
    return frame.withColumn("chunks", chunks).drop("hashes", "ends", "of_word", "overlapping")


def passage_key(chunk):
    """64 bits of a chunk's text."""
    return F.xxhash64(chunk)


def repeats(docs, divisor):
    """(doc_id, drop, want): per document its lines in chunks that occurred before, each with a line it repeats, and those lines where they stand."""
    whole = docs.select("doc_id", "text").where("doc_id is not null and text <> ''")
    # The outer form: for the inner one Spark would test the size first, below the columns that hold the steps.
    places = with_chunks(whole, divisor).select("doc_id", "lines", F.explode_outer("chunks").alias("place"))
    places = places.where("place is not null").select("doc_id", "lines", "place.start", "place.end")
    chunk = F.array_join(F.slice("lines", F.col("start") + 1, F.col("end") - F.col("start") + 1), "\n")
    places = stored(places.select("doc_id", "start", "end", passage_key(chunk).alias("key")), "chunks")
    place = F.struct("doc_id", "start")
    first = places.groupBy("key").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").drop("last")
    later = places.join(first.hint("merge"), "key").where(place != F.col("first"))
    later = later.select("doc_id", "start", "first", F.explode(F.sequence("start", "end")).alias("line"))
    of = F.struct(F.col("first.doc_id").alias("doc"), (F.col("line") - F.col("start") + F.col("first.start")).alias("line"))
    found = stored(later.groupBy("doc_id", "line").agg(F.min(of).alias("of")), "repeated-lines")
    want = found.select("of").distinct().select(F.col("of.doc").alias("doc_id"), F.col("of.line").alias("want"))
    both = found.select("doc_id", F.struct("line", "of").alias("drop")).unionByName(want, allowMissingColumns=True)
    return both.groupBy("doc_id").agg(F.collect_set("drop").alias("drop"), F.collect_set("want").alias("want"))


def unlike(marked):
    """(_id, _stay): lines whose bytes are not those of the line they are to repeat; no row, or hashes met by chance."""
    text = cut_lines("text")
    lines = marked.where("size(_drop) > 0 or size(_want) > 0").withColumn("_lines", F.transform(text, lambda x: F.substring_index(x, "\n", 1)))
    own = F.transform("_drop", lambda d: F.struct(
        d["of"].alias("of"), F.get("_lines", d["line"]).alias("bytes"), F.lit(False).alias("source"), d["line"].alias("line")))
    source = F.transform("_want", lambda w: F.struct(
        F.struct(F.col("_id").alias("doc"), w.alias("line")).alias("of"), F.get("_lines", w).alias("bytes"), F.lit(True).alias("source"), w.alias("line")))
    lines = lines.select("_id", F.explode(F.concat(own, source)).alias("l")).select("_id", "l.*")
    alone = stored(lines.groupBy("of", "bytes").agg(F.max("source").alias("like")).where("not like").drop("like"), "unlike")
    if alone.isEmpty():
        return None
    stay = lines.where("not source").join(alone.hint("merge"), ["of", "bytes"], "left_semi")
    return stay.groupBy("_id").agg(F.collect_set("line").alias("_stay"))


def without_repeats(docs, divisor=DIVISOR):
    """The rows of ``docs``, with repeated passages cut out of ``text``; see the module's docstring."""
    gone = repeats(docs, divisor).select(F.col("doc_id").alias("_of"), F.col("drop").alias("_drop"), F.col("want").alias("_want"))
    inner = docs.select(docs["doc_id"].alias("_id"), docs["text"], F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("_rest"))
    marked = stored(inner.join(gone.hint("merge"), F.col("_id") == F.col("_of"), "left").drop("_of"), "marked")
    drop, stay = F.transform("_drop", lambda d: d["line"]), unlike(marked)
    if stay is not None:
        marked = marked.join(stay.withColumnRenamed("_id", "_of").hint("merge"), F.col("_id") == F.col("_of"), "left")
        drop = F.when(F.col("_stay").isNull(), drop).otherwise(F.array_except(drop, "_stay"))
    # Only texts that lose something are cut into lines again.
    cut = marked.withColumn("_lines", F.when((F.size("_drop") > 0) & (F.col("text") != ""), cut_lines("text")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), drop)
    kept = F.when(F.col("_lines").isNotNull(), F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n"))
    both = cut.select("_rest", F.coalesce(kept, "text").alias("text"))
    return both.select([F.col("text") if c == "text" else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns])
