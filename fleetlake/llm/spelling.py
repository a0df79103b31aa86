"""Spelling variants: words one edit apart, found by a variable-length gram index.

Method. A word stands between two marks and is covered by grams of 2 to ``LONGEST`` code points. The gram
dictionary is pruned by frequency: a gram goes on to longer ones only while it is more frequent than ``SHARE`` of
all grams, and of its continuations the rarest are merged back into it as long as they stay below that together. At each
place a word takes the longest gram that the dictionary has there, or the gram of 2, unless one before it
holds that gram. One edit of the word, whatever the other word, leaves all but a number of its grams in place: ``affected``
computes that bound for every word from the grams that the edit could cut, lengthen or cover. So of a word's bound + 1 rarest grams, at
least one stands in each near word, at the same place or moved by the edit: only those lists are
merged, by gram, length and place. Candidates are verified by their edit distance.

The bound is below the number of grams for every word of ``SHORTEST`` code points or more: grams that touch a mark have 3
code points at most, so no edit reaches the first and the last gram both. Therefore no word needs another way.

Scale. Words are counted per task before the shuffle. The dictionary is bounded by 1 / ``SHARE`` and the alphabet, whatever
the input, and is the only thing broadcast. Lists are short because a word enters those of its rarest grams
alone and lists are told apart by place and length; the join is a shuffle that adaptive execution splits. Nothing is
enumerated within a document, and copies of a document only add to counts.

Words, forms: a word's form is its near word of largest count, ties the smallest in code-point order, if it is at least ``RATIO``
times as frequent; so counts double along a chain of forms, and its end is found in a number of pointer-doubling rounds logarithmic in
the logarithm of the largest count.

Rows: a null or empty text has no words. A null doc_id is written as nothing where words are damaged (see
``damaged_words``). Repeated rows count each. An empty table gives an empty result. Only doc_id and text are read.
"""

import re
import zlib
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.llm.common import map_batches, stored

#: Words from this many code points and this many occurrences on take part.
SHORTEST, LEAST = 5, 3
LONGEST = 4
#: Share of all grams above which a gram is too frequent to stay unextended.
SHARE = 1 / 4000
RATIO = 2
#: A code point edited into a word, and the marks around it; none is part of a word.
OPEN, CLOSE = "\x02", "\x03"

# Fixed pattern: what counts as a word.
WORD = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {code: code + 32 for code in range(65, 91)}

#: Counts that a task keeps before it sends them on.
HELD = 300_000


def damaged_words(docs, one_in=97):
    """(word, n): the words of all texts with A-Z lower-cased, one in ``one_in`` of (document, word) without one of its code points.

    Whether and where is decided by the checksum of ``<doc_id>:<word>``; ``one_in`` of None damages none.
    """

    def count(batches):
        import pyarrow as pa

        def send(found):
            return pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array(list(found.values()), pa.int64())], ["word", "n"])

        total = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                words = Counter(WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower()))
                if one_in is not None:
                    for word in [word for word in words if zlib.crc32(word.encode(), begun) % one_in == 0]:
                        at = zlib.crc32(word.encode(), begun) % len(word)
                        n = words.pop(word)
                        cut = word[:at] + word[at + 1:]
                        total[cut] += n
                for word, n in words.items():
                    total[word] += n
                if len(total) > HELD:
                    yield send(total)
                    total.clear()
        yield send(total)

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(words):
    """(gram, n): in how many places of marked words each gram of 2 to LONGEST code points stands."""

    def count(batches):
        import pyarrow as pa

        total = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                text = OPEN + word + CLOSE
                for size in range(2, LONGEST + 1):
                    total.update(text[i:i + size] for i in range(len(text) - size + 1))
            if len(total) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], ["gram", "n"])
                total.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], ["gram", "n"])

    counted = words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    touching = F.col("gram").contains(OPEN) | F.col("gram").contains(CLOSE)
    return counted.where(~touching | (F.char_length("gram") <= 3))


def dictionary(words, share=SHARE):
    """The pruned gram dictionary, with counts: {gram: n}.

    It holds all grams of 2 that occur. At each further length only grams whose beginning is above the
    threshold go on, and of those the rarest are left out whose counts add up to no more than it. So at most
    1 / share beginnings of a length go on, each by the alphabet's number of letters at most.
    """
    counts = stored(gram_counts(words), "grams")
    threshold = F.lit((counts.where("char_length(gram) = 2").agg(F.sum("n")).first()[0] or 0) * share)
    rarest = Window.partitionBy("start").orderBy("n", "gram").rowsBetween(Window.unboundedPreceding, 0)
    level = counts.where("char_length(gram) = 2")
    kept = [level]
    for size in range(3, LONGEST + 1):
        frequent = level.where(F.col("n") > threshold).select(F.col("gram").alias("start"))
        longer = counts.where(F.char_length("gram") == size).withColumn("start", F.left("gram", F.lit(size - 1)))
        level = longer.join(frequent, "start").withColumn("_sum", F.sum("n").over(rarest)).where(F.col("_sum") > threshold).select("gram", "n")
        kept.append(level)
    everything = kept[0]
    for level in kept[1:]:
        everything = everything.unionAll(level)
    return {row.gram: row.n for row in everything.toLocalIterator()}


class Grams:
    """Decomposition of words by a gram dictionary, and the bound of what one edit affects."""

    def __init__(self, counts):
        self.counts = counts
        self.starts = {gram[:k] for gram in counts for k in range(1, len(gram))}
        self.ends = {gram[k:] for gram in counts for k in range(1, len(gram))}

    def cover(self, text):
        """(start, end) of each gram that a marked word takes, in order."""
        spans, reached, size = [], 0, len(text)
        counts = self.counts
        for start in range(size - 1):
            end = start + 2
            for longer in range(min(start + LONGEST, size), end, -1):
                if text[start:longer] in counts:
                    end = longer
                    break
            if end > reached:
                spans.append((start, end))
                reached = end
        return spans

    def affected(self, text, spans):
        """How many of the grams one edit can take from their place, at most.

        An edit keeps ``text[:a]`` and ``text[b:]``. A gram before ``a`` stays unless one that starts no
        later could now reach over ``a``, because what lies between begins a gram of the dictionary. A gram from ``b`` on
        stays unless one that reaches over ``b`` could now cover it.
        """
        worst, size = 0, len(text)
        starts, ends = self.starts, self.ends
        for b in range(1, size):
            over = b
            for end in range(min(b + LONGEST - 1, size), b, -1):
                if text[b:end] in ends:
                    over = end
                    break
            for a in (b - 1, b):
                if a < 1:
                    continue
                safe_before = a
                for start in range(max(a - LONGEST + 1, 0), a):
                    if text[start:a] in starts:
                        safe_before = start
                        break
                lost = 0
                for start, end in spans:
                    if not (end <= a and start < safe_before or start >= b and end > over):
                        lost += 1
                worst = max(worst, lost)
        return worst

    def keys(self, word):
        """(gram, place) of the word's rarest grams, one more than an edit can affect."""
        text = OPEN + word + CLOSE
        spans = self.cover(text)
        bound = self.affected(text, spans)
        if bound >= len(spans):
            raise ValueError(f"an edit could affect all grams of {word!r}: is it of {SHORTEST} code points or more?")
        ranked = sorted((self.counts.get(text[start:end], 0), text[start:end], start) for start, end in spans)
        return [(gram, start) for _, gram, start in ranked[:bound + 1]]


def postings(words, grams):
    """(gram, place, size, word, n): the lists that have to be merged."""
    told = words.sparkSession.sparkContext.broadcast(grams)

    def index(columns):
        out = {"gram": [], "place": [], "size": [], "word": [], "n": []}
        for word, n in zip(columns["word"], columns["n"]):
            for gram, place in told.value.keys(word):
                out["gram"].append(gram)
                out["place"].append(place)
                out["size"].append(len(word))
                out["word"].append(word)
                out["n"].append(n)
        return out

    return map_batches(words.select("word", "n"), index, "gram string, place int, size int, word string, n long")


def near_pairs(words, share=SHARE):
    """(word, near, near_n) of all words exactly one edit apart, in both directions.

    ``words``: (word, n), each word once and of SHORTEST code points or more.
    """
    lists = stored(postings(words, Grams(dictionary(words, share))), "gram-lists")
    # A near word of the same length has the gram at the same place; one that is a code point longer there or one further.
    asked = lists.withColumn("_to", F.explode(F.array(*[
        F.struct(F.lit(more).alias("more"), F.lit(move).alias("move")) for more, move in ((0, 0), (1, 0), (1, 1))
    ]))).select(
        "gram", (F.col("place") + F.col("_to.move")).cast("int").alias("place"), (F.col("size") + F.col("_to.more")).cast("int").alias("size"),
        (F.col("_to.more") == 1).alias("longer"), F.col("word").alias("a"), F.col("n").alias("a_n"),
    )
    met = asked.join(lists.select("gram", "place", "size", F.col("word").alias("b"), F.col("n").alias("b_n")), ["gram", "place", "size"])
    met = met.where(F.col("longer") | (F.col("a") < F.col("b")))
    pairs = met.where(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n").distinct()
    pairs = stored(pairs, "near-words")
    return pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select("b", "a", "a_n")
    )


def roots(forms):
    """(word, root): where following ``forms`` (word, form, form_n) ends, by pointer doubling.

    Counts at least double along a chain, so it has no more steps than the largest count has bits.
    """
    most = forms.agg(F.max("form_n")).first()[0]
    reached = forms.select("word", F.col("form").alias("root"))
    for _ in range((most or 0).bit_length().bit_length()):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        reached = reached.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        reached = stored(reached, "roots")
    return reached


def variants(words, share=SHARE, ratio=RATIO):
    """Each word with its form and root: word, form, root, n, n_near, form_n; ``words`` as in ``near_pairs``."""
    pairs = near_pairs(words, share)
    best = F.min(F.struct((-F.col("near_n")).alias("fewer"), F.col("near").alias("form"))).alias("_best")
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best)
    found = words.join(near, "word", "left").withColumn("_better", -F.col("_best.fewer") >= ratio * F.col("n")).select(
        "word", F.when(F.col("_better"), F.col("_best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("_better"), -F.col("_best.fewer")).cast("long").alias("form_n"),
    )
    found = stored(found, "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def grouped(docs, one_in=97, least=LEAST):
    """Spelling variants among the words of all documents; see ``damaged_words`` for ``one_in``."""
    words = damaged_words(docs, one_in).where((F.col("n") >= least) & (F.char_length("word") >= SHORTEST))
    return variants(stored(words, "words"))
