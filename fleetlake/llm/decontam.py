"""Test-set passages in training documents, by a distributed positional inverted index.

Method. Documents are indexed in segments of about ``SEGMENT_WORDS`` words; a segment holds whole documents,
one after the other with a gap between. Its rows are (segment, term, n, postings): the places of a
term, as variable-length differences. The row of the empty term is the segment's directory of documents. A
phrase is looked for from its rarest term in the segment: that term's places, less its offset in the
phrase, are intersected with the other terms' lists, rarest next, each adjusted by its own offset.
``hits`` gives exact phrase matches, ``proximity`` documents in which all terms lie near each other.

Scale. A document lies in one segment, so no posting list of a frequent term ever meets in one task, and
hits need no second shuffle. The index is a stored table, hash-partitioned by segment when it is
searched. The test set is sent to the tasks in blocks of at most ``BLOCK_WORDS`` words. With one
block only the block's vocabulary is indexed; with more, every term is indexed once and each block
searches that index.

Rows: a null or empty text has no words and no hits. Each row is a document by itself, so a null or
repeated doc_id gives a row for each. Items that are null, have no words or no item_id are never
found; repeated items are one. Ties cannot change a result. An empty table gives an empty result; an
empty test set gives no hits. Only doc_id and text, item_id and text are read.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from fleetlake.llm.common import alnum_words, sorted_groups, stored, texts

WINDOW = 10
SEGMENT_WORDS, BLOCK_WORDS = 500_000, 2_000_000
INDEX = "segment long, term binary, n long, postings binary"


def varints(values):
    """Numbers as 7-bit groups, the lowest first, the high bit set on all but the last; and each one's length."""
    values = values.astype(np.uint64)
    sizes = 1 + sum((values >= np.uint64(1 << (7 * k))).astype(np.int64) for k in range(1, 6))
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for k in range(6):
        has = sizes > k
        low = (values[has] >> np.uint64(7 * k)) & np.uint64(127)
        out[ends[has] - sizes[has] + k] = low + np.where(sizes[has] > k + 1, 128, 0).astype(np.uint64)
    return out, sizes


def numbers(data):
    """The inverse of ``varints``."""
    data = np.frombuffer(data, np.uint8)
    if not len(data):
        return np.empty(0, np.int64)
    starts = np.concatenate([[0], np.flatnonzero(data < 128)[:-1] + 1])
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), starts)


class Numbering(dict):
    """Numbers terms in the order they come."""

    def __missing__(self, term):
        self[term] = len(self)
        return len(self) - 1


def segment_rows(segment, ids, bodies, vocabulary):
    """One segment's record batch: the directory row, then a row per term."""
    words, sizes = [], []
    for body in bodies:
        found = alnum_words(body)
        sizes.append(len(found))
        words += found
    if vocabulary is None:
        numbering = Numbering()
        codes = np.fromiter(map(numbering.__getitem__, words), np.int64, len(words))
        terms = list(numbering)
    else:
        codes = np.fromiter((vocabulary.get(word, -1) for word in words), np.int64, len(words))
        terms = None
    sizes = np.array(sizes, np.int64)
    gaps = np.repeat(np.arange(len(sizes)), sizes)  # a free place after each document
    places = np.arange(len(words)) + gaps
    if vocabulary is not None:
        used = codes >= 0
        codes, places = codes[used], places[used]
    order = np.argsort(codes, kind="stable")
    codes, places = codes[order], places[order]
    new = np.flatnonzero(np.diff(codes, prepend=-1))
    steps = np.diff(places, prepend=0)
    steps[new] = places[new]
    data, lengths = varints(steps)
    counts = np.diff(np.append(new, len(codes)))
    if vocabulary is None:
        named = [terms[k] for k in codes[new].tolist()]
    else:
        names = list(vocabulary)
        named = [names[k] for k in codes[new].tolist()]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    bounds = ends[np.append(new, len(codes))].tolist()
    whole = data.tobytes()
    directory = pa.array([None if i is None else int(i) for i in ids], pa.int64())
    table = b"".join((
        np.array([len(ids)], np.int64).tobytes(), directory.fill_null(0).to_numpy(False).astype(np.int64).tobytes(),
        directory.is_null().to_numpy(False).astype(np.uint8).tobytes(), sizes.tobytes(),
    ))
    return pa.RecordBatch.from_arrays([
        pa.array([segment] * (len(named) + 1), pa.int64()),
        pa.array([b"", *named], pa.binary()),
        pa.array([len(ids), *counts.tolist()], pa.int64()),
        pa.array([table, *(whole[a:b] for a, b in zip(bounds, bounds[1:]))], pa.binary()),
    ], names=["segment", "term", "n", "postings"])


def index(docs, vocabulary=None, segment_words=SEGMENT_WORDS):
    """The index of all texts; ``vocabulary`` (a dict that numbers terms) limits it to those terms."""
    told = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def build(batches):
        number, ids, bodies, held = 0, [], [], 0
        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                bodies.append(body)
                held += len(body or b"") // 5 + 1  # about a word in five bytes
                if held >= segment_words:
                    yield segment_rows((TaskContext.get().partitionId() << 32) + number, ids, bodies, told.value)
                    number, ids, bodies, held = number + 1, [], [], 0
        if ids:
            yield segment_rows((TaskContext.get().partitionId() << 32) + number, ids, bodies, told.value)

    return texts(docs).mapInArrow(build, INDEX)


def windows(words, size=WINDOW):
    """The runs of ``size`` words; all words where there are fewer, none where there are none."""
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


class Phrases:
    """A block of test items: its vocabulary, its distinct windows as term numbers, and the items of each window."""

    def __init__(self, items, size=WINDOW):
        self.vocabulary, found = Numbering(), {}
        for item_id, words in items:
            for window in windows(words, size):
                found.setdefault(tuple(self.vocabulary[word] for word in window), set()).add(item_id)
        self.vocabulary = dict(self.vocabulary)
        self.lengths = np.array([len(window) for window in found], np.int64)
        self.terms = np.full((len(found), size), -1, np.int64)
        for row, window in enumerate(found):
            self.terms[row, :len(window)] = window
        self.items = list(found.values())


def phrase_blocks(items, block_words=BLOCK_WORDS, size=WINDOW):
    """The test set in blocks of bounded size, read from Spark a partition at a time."""
    block, held = [], 0
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for row in rows.where("item_id is not null and text is not null").toLocalIterator():
        words = alnum_words(bytes(row["text"]))
        block.append((row["item_id"], words))
        held += len(words)
        if held >= block_words:
            yield Phrases(block, size)
            block, held = [], 0
    yield Phrases(block, size)


class Segment:
    """A segment's lists, read from its rows: places of all wanted terms in one array, by term number."""

    def __init__(self, rows, vocabulary):
        terms, lists, counts = rows["term"].tolist(), rows["postings"].tolist(), rows["n"].tolist()
        head = terms.index(b"")
        table = lists[head]
        n = int(np.frombuffer(table[:8], np.int64)[0])
        ids = np.frombuffer(table[8:8 + 8 * n], np.int64).tolist()
        null = np.frombuffer(table[8 + 8 * n:8 + 9 * n], np.uint8).tolist()
        self.ids = [None if x else i for i, x in zip(ids, null)]
        self.sizes = np.frombuffer(table[8 + 9 * n:], np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.end = int((self.sizes + 1).sum())
        wanted = sorted((vocabulary[bytes(t)], k) for k, t in enumerate(terms) if k != head and bytes(t) in vocabulary)
        steps = numbers(b"".join([lists[k] for _, k in wanted]))
        each = np.array([counts[k] for _, k in wanted], np.int64)
        first = np.cumsum(each) - each
        total = np.cumsum(steps)
        self.places = total - np.repeat(total[first] - steps[first], each) if len(each) else steps
        self.counts = np.zeros(len(vocabulary) + 1, np.int64)  # the last one is for no term
        self.first = np.zeros(len(vocabulary) + 1, np.int64)
        codes = np.array([code for code, _ in wanted], np.int64)
        self.counts[codes], self.first[codes] = each, first
        self.keys = np.repeat(codes, each) * self.end + self.places

    def has(self, term, place):
        """Whether each term stands at each place."""
        key = term * self.end + place
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (place >= 0) & (place < self.end) & (self.keys[at] == key)

    def document(self, place):
        return np.searchsorted(self.starts, place, side="right") - 1

    def spread(self, rows, terms):
        """Every place of one term per row: (row of each place, place)."""
        n = self.counts[terms]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[terms], n)
        return np.repeat(rows, n), self.places[at]

    def phrases(self, phrases):
        """(phrase, place of its first word) of all exact matches."""
        rarity = np.where(phrases.terms >= 0, self.counts[phrases.terms], np.iinfo(np.int64).max)
        rows = np.flatnonzero((rarity > 0).all(axis=1))
        order = np.argsort(rarity[rows], axis=1, kind="stable")
        terms = phrases.terms[rows]
        here = np.arange(len(rows))
        row, place = self.spread(here, terms[here, order[:, 0]])
        place = place - order[row, 0]
        for k in range(1, terms.shape[1]):
            if not len(row):
                break
            offset = order[row, k]
            term = terms[row, offset]
            good = (term < 0) | self.has(term, place + offset)
            row, place = row[good], place[good]
        return rows[row], place


def searched(rows, phrases, function, schema):
    """``function(segment, phrases)`` over each segment of an index; it returns a dict of columns beside ``segment``."""
    told = rows.sparkSession.sparkContext.broadcast(phrases)

    def run(batches):
        import pandas as pd

        for key, group in sorted_groups(batches, "segment"):
            yield pd.DataFrame({"segment": key, **function(Segment(group, told.value.vocabulary), told.value)})

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "segment").sortWithinPartitions("segment").mapInPandas(run, schema)


def _hits(segment, phrases):
    row, place = segment.phrases(phrases)
    size = phrases.lengths[row]
    change = np.zeros(segment.end + 1, np.int64)
    np.add.at(change, place, 1)
    np.add.at(change, place + size, -1)
    covered = np.flatnonzero(np.cumsum(change) > 0)
    owner = segment.document(covered)
    items = [set() for _ in segment.ids]
    for doc, phrase in set(zip(segment.document(place).tolist(), row.tolist())):
        items[doc] |= phrases.items[phrase]
    bounds = np.searchsorted(owner, np.arange(len(segment.ids) + 1))
    inside = (covered - segment.starts[owner]) if len(covered) else covered
    # Runs of covered words, so that blocks of a large test set can be merged.
    spans = []
    for doc in range(len(segment.ids)):
        own = inside[bounds[doc]:bounds[doc + 1]]
        cut = np.flatnonzero(np.diff(own) > 1)
        firsts, lasts = (own[np.append(0, cut + 1)], own[np.append(cut, len(own) - 1)]) if len(own) else (own, own)
        spans.append([x for pair in zip(firsts.tolist(), lasts.tolist()) for x in pair])
    return {
        "document": np.arange(len(segment.ids)), "doc_id": np.array(segment.ids, dtype=object), "n_words": segment.sizes,
        "spans": spans, "items": [sorted(x) for x in items],
    }


def hits(docs, items, size=WINDOW, block_words=BLOCK_WORDS):
    """Per document: doc_id, n_words, spans (first and last place of each run of hit words), items found."""
    blocks = phrase_blocks(items, block_words, size)
    block, following = next(blocks), next(blocks, None)
    built = stored(index(docs, block.vocabulary if following is None else None), "positional-index")
    schema = "segment long, document long, doc_id long, n_words long, spans array<long>, items array<string>"

    if following is None:
        return searched(built, block, _hits, schema).drop("segment", "document")
    parts = [searched(built, part, _hits, schema) for part in (block, following, *blocks)]
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)

    def merged(columns):
        import pandas as pd

        out = []
        for spans in columns:
            runs = sorted(zip(spans[::2], spans[1::2]))
            flat = []
            for first, last in runs:
                if flat and first <= flat[-1] + 1:
                    flat[-1] = max(flat[-1], last)
                else:
                    flat += [first, last]
            out.append(flat)
        return pd.Series(out)

    whole = found.groupBy("segment", "document").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    union = F.pandas_udf(merged, "array<long>")
    return whole.select("doc_id", "n_words", union("spans").alias("spans"), "items")


def proximity(docs, items, within=30):
    """Documents in which all words of an item lie within ``within`` words of its rarest: doc_id, item_id, place of that word."""
    parts = []
    for phrases in phrase_blocks(items, size=1):
        bags = {}
        for row, owners in enumerate(phrases.items):
            for item in owners:
                bags.setdefault(item, []).append(int(phrases.terms[row, 0]))
        phrases.bags = bags

        def near(segment, phrases):
            out = {"doc_id": [], "item_id": [], "place": []}
            for item, terms in phrases.bags.items():
                terms = sorted(terms, key=lambda t: segment.counts[t])
                if not segment.counts[terms[0]]:
                    continue
                lists = [segment.places[segment.first[t]:segment.first[t] + segment.counts[t]] for t in terms]
                place = lists[0]
                doc = segment.document(place)
                low = np.maximum(place - within, segment.starts[doc])
                high = np.minimum(place + within, segment.starts[doc] + segment.sizes[doc] - 1)
                for other in lists[1:]:
                    good = np.searchsorted(other, low) < np.searchsorted(other, high, side="right")
                    place, doc, low, high = place[good], doc[good], low[good], high[good]
                for p, d in zip(place.tolist(), doc.tolist()):
                    for name, value in zip(out, (segment.ids[d], item, p - int(segment.starts[d]))):
                        out[name].append(value)
            return {name: np.array(values, dtype=object) for name, values in out.items()}

        built = stored(index(docs, phrases.vocabulary), "positional-index")
        parts.append(searched(built, phrases, near, "segment long, doc_id long, item_id string, place long").drop("segment"))
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def contaminated(docs, items):
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hits(docs, items)
    pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size("spans"), 1) - 1), lambda i: F.get("spans", 2 * i + 1) - F.get("spans", 2 * i) + 1)
    n_hit = F.when(F.size("spans") > 0, F.aggregate(pairs, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0).cast("long"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def without_contaminated(docs, items):
    """The rows of ``docs`` that hold no passage of the test set, their columns as they are."""
    bad = contaminated(docs, items).where("contaminated and doc_id is not null").select(F.col("doc_id").alias("_bad")).distinct()
    bad = stored(bad, "contaminated")
    return docs.join(bad, docs["doc_id"] == bad["_bad"], "left_anti")
