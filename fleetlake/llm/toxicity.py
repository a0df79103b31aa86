"""Toxic documents and sentences by multiple-instance learning.

Method. A document is a bag of sentences. A sentence's probability is logistic in the words it holds, and a
document is toxic unless none of its sentences is (noisy-or): 1 - product of (1 - p). Labels are known
per document only; the likelihood of those trains the sentence model, so a sentence can be scored by
itself afterwards and the offending ones be pointed out (``offending``).

Words count as themselves and by their beginnings of ``BEGINNINGS`` letters, so inflected forms share a weight.

Training rows. Only labelled rows whose crc32 of the doc_id's text is not 2 modulo 4 (``held_out``). The
classifier is fitted on at most ``SAMPLE`` documents and ``SAMPLE_BYTES`` bytes of them, the smallest by a
hash of the id; that bound holds whatever the size of the input. Of the ``SAMPLE`` first of each label a document
that does not fit is left out and the next one tried. The first ``LEAST`` documents of either label come before all others, within half of the bytes each; if none of
a label fits there, its shortest is taken whole, so both labels are there. At most ``FEATURES`` words and beginnings,
those that tell the labels apart best in the sample, get a weight; weights are held small by a
quadratic penalty. Scoring is one pass over whole texts without a shuffle.

Rows: a null or empty text, or one without words, has no sentence and scores 0. A null doc_id is scored and
counts as not held out. Repeated rows are scored each; a document labelled twice is toxic if either label says
so, and null labels are none. Without a label of either kind every score is 0. An empty table gives an
empty result. Of the documents only doc_id and text are read, of the labels only doc_id and toxic.
"""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetlake.llm.common import Memo, alnum_words, map_batches, stored, texts

SAMPLE, SAMPLE_BYTES, FEATURES, LEAST = 20_000, 40_000_000, 4096, 100
BEGINNINGS = range(3, 9)
THRESHOLD = 0.3
_ENDS = re.compile(rb"[.!?\n]+|\xe3\x80\x82|\xef\xbc[\x81\x9f]")


def held_out(doc_id):
    """Whether a document's label may not be learnt from: crc32 of its id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sentences(text):
    """The sentences of a text in bytes that hold a word, each as (start, end)."""
    start = 0
    for end in _ENDS.finditer(text):
        if start < end.start():
            yield start, end.start()
        start = end.end()
    if start < len(text):
        yield start, len(text)


def sentence_words(text):
    """Lists of the words of each sentence that has any."""
    return [words for words in (alnum_words(part) for part in _ENDS.split(text or b"")) if words]


def features_of(word):
    """The numbers of a word and of its beginnings."""
    letters = word.decode()
    return [zlib.crc32(b"=" + word), *(zlib.crc32(b"^" + letters[:n].encode()) for n in BEGINNINGS if len(letters) > n)]


class Model:
    """Weights by feature number and a bias; picklable and bounded by FEATURES."""

    def __init__(self, weights, bias):
        self.weights, self.bias = weights, bias

    def scorer(self):
        weights, bias = self.weights, self.bias
        memo = Memo(lambda word: sum([weights.get(number, 0.0) for number in features_of(word)]))
        return lambda words: bias + sum(map(memo.__getitem__, words))


def probability(margins):
    """Noisy-or of sentence margins: 1 - product of (1 - logistic(margin))."""
    return float(-np.expm1(-np.logaddexp(0, margins).sum())) if len(margins) else 0.0


def fitting(rows, sample, sample_bytes):
    """The ids of ``rows``, in the order of their turns, that make the sample; see the module's docstring."""
    taken, held = {}, 0
    for toxic in (True, False):
        own, used = [r for r in rows if (r["toxic"] > 0) == toxic], 0
        for r in own[:min(LEAST, sample // 2)]:
            if used + r["bytes"] <= sample_bytes // 2:
                taken[r["doc_id"]] = None
                used += r["bytes"]
        if own and not used:
            fits = [r for r in own if r["bytes"] <= sample_bytes // 2]
            r = fits[0] if fits else min(own, key=lambda r: r["bytes"])
            taken[r["doc_id"]] = None
            used = r["bytes"]
        held += used
    for r in rows:
        if r["doc_id"] not in taken and len(taken) < sample and held + r["bytes"] <= sample_bytes:
            taken[r["doc_id"]] = None
            held += r["bytes"]
    return list(taken)


def sampled(docs, labels, sample=SAMPLE, sample_bytes=SAMPLE_BYTES):
    """The training sample: (doc_id, toxic, text), at most ``sample`` rows with ``sample_bytes`` of text."""
    known = labels.where("toxic is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("turn", F.xxhash64("doc_id"))
    kinds = [known.where(kind).orderBy("turn", "doc_id").limit(sample) for kind in ("toxic > 0", "toxic <= 0")]
    chosen = kinds[0].union(kinds[1])  # at most twice `sample` rows of three numbers
    rows = texts(docs).where("text is not null").join(F.broadcast(chosen), "doc_id")
    rows = rows.dropDuplicates(["doc_id"]).withColumn("bytes", F.octet_length("text"))
    rows = stored(rows, "toxic-sample")
    sizes = rows.select("doc_id", "toxic", "bytes", "turn").orderBy("turn", "doc_id").collect()  # rows of four numbers
    fits = docs.sparkSession.createDataFrame([(i,) for i in fitting(sizes, sample, sample_bytes)], "doc_id long")
    return rows.join(F.broadcast(fits), "doc_id", "left_semi").select("doc_id", "toxic", "text")


def feature_counts(sample):
    """(number, df, bad) of each feature: in how many documents it is, and in how many toxic ones. A task adds up its own first."""

    def count(batches):
        import pyarrow as pa

        found = {}

        def send():
            columns = [pa.array(list(found), pa.int64()), *(pa.array([each[k] for each in found.values()], pa.int64()) for k in (0, 1))]
            return pa.RecordBatch.from_arrays(columns, ["number", "df", "bad"])

        features = Memo(features_of, 100_000)
        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = {word for sentence in sentence_words(text) for word in sentence}
                for number in {number for word in words for number in features[word]}:
                    each = found.setdefault(number, [0, 0])
                    each[0] += 1
                    each[1] += toxic > 0
            if len(found) > 300_000:
                yield send()
                found.clear()
        yield send()

    counted = sample.select("toxic", "text").mapInArrow(count, "number long, df long, bad long")
    return counted.groupBy("number").agg(F.sum("df").alias("df"), F.sum("bad").alias("bad"))


def told_apart(counts, n_docs, n_toxic, features, least_gap):
    """The numbers of the features that tell the labels apart best."""
    rate = n_toxic / n_docs
    spread = F.sqrt(F.col("df") * rate * (1 - rate) * (1 - F.col("df") / (n_docs + 1)) + 1)
    gap = F.abs(F.col("bad") - F.col("df") * rate) / spread
    best = counts.where("df >= 2").withColumn("gap", gap).where(F.col("gap") >= least_gap).orderBy(F.desc("gap"), "number").limit(features)
    return np.array([row.number for row in best.select("number").collect()], np.int64)


def indexed(sample, numbers):
    """Per document, in order of its id: toxic, its sentences without a chosen feature, how many each other sentence holds, and which."""
    told = sample.sparkSession.sparkContext.broadcast({int(number): place for place, number in enumerate(numbers)})

    def index(columns):
        places = told.value
        held = Memo(lambda word: [places[number] for number in features_of(word) if number in places], 100_000)
        out = {"doc_id": columns["doc_id"], "toxic": columns["toxic"], "plain": [], "sizes": [], "held": []}
        for text in columns["text"]:
            sentences = [[place for word in words for place in held[word]] for words in sentence_words(text)]
            some = [found for found in sentences if found]
            out["plain"].append(len(sentences) - len(some))
            out["sizes"].append(np.array([len(found) for found in some], "<i4").tobytes())
            out["held"].append(np.array([place for found in some for place in found], "<i4").tobytes())
        return out

    return map_batches(sample, index, "doc_id long, toxic int, plain long, sizes binary, held binary").orderBy("doc_id")


#: Entries of a sum at a time.
SLICE = 1_000_000


def summed(keys, values, size):
    """For each key the sum of its values; ``values`` is a function of a slice, so no array of all of them is made."""
    found = np.zeros(size)
    for start in range(0, len(keys), SLICE):
        part = slice(start, start + SLICE)
        found += np.bincount(keys[part], weights=values(part), minlength=size)
    return found


def fit(sample, features=FEATURES, rounds=300, penalty=1e-4, least_gap=2.5):
    """The model that fits document labels best under the noisy-or, by Adam steps.

    Words are cut and features counted in tasks; of the sample only the places of chosen features reach the driver.
    """
    n_docs, n_toxic = sample.agg(F.count("*"), F.count_if(F.col("toxic") > 0)).first()
    if not n_toxic or n_toxic == n_docs:
        return Model({}, -60.0)
    numbers = told_apart(feature_counts(sample), n_docs, n_toxic, features, least_gap)
    rows = indexed(sample, numbers).toPandas()
    labels, plain = rows["toxic"].to_numpy(np.float64) > 0, rows["plain"].to_numpy(np.float64)
    sizes = np.frombuffer(b"".join(rows["sizes"]), "<i4")
    held = np.frombuffer(b"".join(rows["held"]), "<i4")
    owner = np.repeat(np.arange(n_docs, dtype=np.int32), [len(each) // 4 for each in rows["sizes"]])
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del rows
    weights, bias = np.zeros(len(numbers)), -7.0
    first, second = np.zeros(len(numbers) + 1), np.zeros(len(numbers) + 1)
    for step in range(1, rounds + 1):
        margin = bias + summed(row, lambda part: weights[held[part]], len(sizes))
        clean = -np.bincount(owner, weights=np.logaddexp(0, margin), minlength=n_docs) - plain * np.logaddexp(0, bias)
        safe = np.clip(clean, -500, -1e-6)
        slope = np.where(labels, -1 / np.expm1(-safe), 1.0)  # of the loss by each sentence's softplus
        pull = slope[owner] / (1 + np.exp(-np.clip(margin, -500, 500)))
        slopes = np.append(
            summed(held, lambda part: pull[row[part]], len(numbers)) / n_docs + penalty * weights,
            (pull.sum() + (slope * plain).sum() / (1 + np.exp(-bias))) / n_docs,
        )
        first, second = 0.9 * first + 0.1 * slopes, 0.99 * second + 0.01 * slopes**2
        move = 0.15 / (1 + step / 100) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        weights = weights - move[:-1]
        bias -= move[-1]
    return Model({int(number): float(w) for number, w in zip(numbers, weights) if w}, float(bias))


def train(docs, labels):
    """The model of the labelled rows that may be learnt from."""
    return fit(stored(sampled(docs, labels), "toxic-fit"))


def scored(docs, model):
    """The rows' doc_id, and the score of each whole text."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def score(columns):
        margin = told.value.scorer()
        return {
            "doc_id": columns["doc_id"],
            "score": [probability([margin(words) for words in sentence_words(text)]) for text in columns["text"]],
        }

    return map_batches(texts(docs), score, "doc_id long, score double")


def offending(docs, model, least=0.1):
    """Sentences with a probability of at least ``least``: doc_id, place in bytes, the sentence, probability."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    def locate(columns):
        margin = told.value.scorer()
        out = {name: [] for name in ("doc_id", "start", "sentence", "probability")}
        for doc_id, text in zip(columns["doc_id"], columns["text"]):
            for start, end in sentences(text or b""):
                words = alnum_words(text[start:end])
                p = probability([margin(words)]) if words else 0.0
                if p >= least:
                    for name, value in zip(out, (doc_id, start, text[start:end].decode().strip(), p)):
                        out[name].append(value)
        return out

    return map_batches(texts(docs), locate, "doc_id long, start long, sentence string, probability double")


def judged(docs, model, threshold=THRESHOLD):
    """Per document: doc_id, held_out, score, predicted."""
    found = scored(docs, model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def without_toxic(docs, model, threshold=THRESHOLD):
    """The rows of ``docs`` whose text scores below the threshold, their columns as they are."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(column):
        import pandas as pd

        margin = told.value.scorer()
        return pd.Series([probability([margin(words) for words in sentence_words(text)]) for text in column], dtype="float64")

    return docs.where(score(docs["text"].cast("binary")) < threshold)
