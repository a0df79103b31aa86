"""Packing token sequences of a fixed capacity by linear grouping, then best fit.

Method (linear grouping scheme). Lengths above ``capacity / LARGE_PER_BIN`` are large. Sorted by length they
are cut into ``GROUPS`` groups of equal cardinality, and every length counts as its group's largest. For
these few sizes the linear programme over bin configurations is solved by column generation: a
knapsack prices the next configuration, a small simplex picks the basis. Each configuration is
used as often as the whole part of its value; the groups' actual documents take its places, the
longest first, so bins are no fuller than planned. Large ones that are left and all small
ones then go in by best fit, longest first, into the fullest bin that still holds them.

Scale. Lengths are at most the capacity, so the whole plan is made on a histogram of that many
counts: best fit moves all bins of one fill at once, never one document. The plan's size depends
on the capacity alone, whatever the number of documents (``Plan`` asserts it before it is sent
out). Spark counts the lengths, numbers the pieces of each length within salted buckets, and looks up
piece k of length L in the plan's run of places for L.

Tokens. ``tokenizer_path`` names a file for the tokenizers library. White-space separated parts are
tokenized once per worker and looked up after that (the tokenizer splits at white space before
anything else); texts are whole, and only documents above the capacity are cut.

Rows: a null or empty text is the end token alone. A null doc_id is packed as any other and comes first in
its order. Rows that repeat a doc_id are packed each. Ties in length are ordered by a hash, doc_id and
piece. An empty table gives an empty result. Only doc_id and text are read.
"""

import functools
import zlib

import numpy as np
from pyspark.sql import functions as F

from fleetlake.llm.common import map_batches, stored, texts

CAPACITY, END = 4096, 1
GROUPS, LARGE_PER_BIN = 24, 4
#: Buckets in which the pieces of one length are numbered.
SALTS = 512


#: For bytes.translate: ASCII that is no letter, digit or white space becomes a full stop.
_MARKS = bytes(46 if byte < 128 and not (chr(byte).isalnum() or chr(byte) in " \t\n\r\x0b\x0c") else byte for byte in range(256))
_ASCII = bytes(range(128))


def _letter(char):
    return char.isalpha() and char.lower().isalpha()


def plain(text):
    """Whether no two neighbours are marks, which the tokenizer would take together; beyond ASCII only letters count."""
    return b".." not in text.translate(_MARKS) and all(map(_letter, set(text.translate(None, _ASCII).decode())))


class Encoder:
    """Ids of texts as bytes: those of their space-separated parts, each encoded once.

    A sentence mark that stands alone is a word of its own to the tokenizer, so it is cut off first.
    Parts of letters alone are encoded many at once, and told apart by the ids that end a word.
    """

    BOUND = 800_000

    def __init__(self, path):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ending = {number for piece, number in self.tokenizer.get_vocab().items() if piece.endswith("</w>")}
        self.ending = np.array([number in ending for number in range(self.tokenizer.get_vocab_size())])
        self.parts = {}

    def encode(self, many):
        found = self.tokenizer.encode_batch_fast(many, add_special_tokens=False)
        return [np.array(encoding.ids, "<u4").tobytes() for encoding in found]

    def learn_words(self, words):
        """Encode words of letters, some thousand in one text."""
        for start in range(0, len(words), 2000):
            run = words[start:start + 2000]
            (whole,) = self.encode([b" ".join(run).decode()])
            ends = 4 * np.flatnonzero(self.ending[np.frombuffer(whole, "<u4")]) + 4
            if len(ends) != len(run):  # some word is more than one to the tokenizer
                self.parts.update(zip(run, self.encode([word.decode() for word in run])))
                continue
            at = 0
            for word, end in zip(run, ends.tolist()):
                self.parts[word] = whole[at:end]
                at = end

    def learn(self, parts):
        """Encode those parts that are not known yet."""
        new = parts.difference(self.parts)
        if len(self.parts) + len(new) > self.BOUND:
            self.parts, new = {}, parts
        letters = [part for part in new if (text := part.decode()).isalpha() and text.lower().isalpha()]
        self.learn_words(letters)
        others = list(new.difference(letters))
        self.parts.update(zip(others, self.encode([part.decode() for part in others])))

    def cut(self, text):
        """The parts of a text; each is encoded as it would be in the text."""
        text = (text or b"").replace(b"\n", b" ")
        if b"<|" not in text:
            text = text.lower()  # ASCII alone, as the tokenizer does itself
            if plain(text):
                for mark in (b".", b",", b";", b":", b"!", b"?"):
                    text = text.replace(mark, b" " + mark)
        return text.split(b" ")

    def __call__(self, many):
        """Ids of each text, four bytes an id, the end id last."""
        cut = [self.cut(text) for text in many]
        self.learn(set().union(*cut))
        end = np.array([END], "<u4").tobytes()
        return [b"".join(map(self.parts.__getitem__, parts)) + end for parts in cut]


@functools.cache
def encoder(path):
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def runs_of(many, size=1_000_000):
    """Slices of a list of texts with about ``size`` bytes each."""
    start, held = 0, 0
    for i, text in enumerate(many):
        held += len(text or b"")
        if held >= size:
            yield slice(start, i + 1)
            start, held = i + 1, 0
    yield slice(start, len(many))


def pieces(docs, tokenizer_path, capacity=CAPACITY):
    """(doc_id, piece, start, length, ids_crc32): each document's ids and the end id, cut at the capacity."""
    def cut(columns):
        encode = encoder(tokenizer_path)
        out = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for run in runs_of(columns["text"]):
            for doc_id, ids in zip(columns["doc_id"][run], encode(columns["text"][run])):
                for piece, start in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[start * 4:(start + capacity) * 4]
                    for name, value in zip(out, (doc_id, piece, start, len(part) // 4, zlib.crc32(part))):
                        out[name].append(value)
        return out

    return map_batches(texts(docs), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(values, sizes, capacity):
    """The best value of sizes, any number of each, within the capacity; how often each is taken."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(int(sizes.min()), capacity + 1):
        fits = sizes <= room
        gain = np.where(fits, values + best[room - np.where(fits, sizes, 0)], -1)
        k = int(gain.argmax())
        best[room], last[room] = (gain[k], k) if gain[k] > best[room - 1] + 1e-12 else (best[room - 1], -1)
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            taken[last[room]] += 1
            room -= int(sizes[last[room]])
    return float(values @ taken), taken


def configurations(sizes, counts, capacity, rounds=400):
    """How often to use which configuration: the basis of the linear programme that covers ``counts``."""
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    amounts = counts / (capacity // sizes)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(k))
        value, column = knapsack(np.maximum(prices, 0), sizes, capacity)
        if value <= 1 + 1e-7:
            break
        direction = np.linalg.solve(basis, column.astype(float))
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratios.argmin())
        amounts = amounts - ratios[out] * direction
        amounts[out] = ratios[out]
        basis[:, out] = column
        amounts = np.maximum(amounts, 0)
    return [(np.rint(basis[:, j]).astype(np.int64), int(amounts[j] + 1e-6)) for j in range(k)]


class Plan:
    """Runs of places: ``count`` items of ``length`` from the ``rank``-th on, one to each of ``count`` sequences."""

    def __init__(self, capacity):
        self.capacity, self.sequences = capacity, 0
        self.runs = []  # length, rank of the first, count, first sequence, offset
        self.taken = np.zeros(capacity + 1, np.int64)
        self.bins = [[] for _ in range(capacity + 1)]  # by room left: [first sequence, count]

    def place(self, length, first, count, room):
        """Put the next ``count`` items of a length into bins that have ``room`` left."""
        self.runs.append((length, int(self.taken[length]), count, first, self.capacity - room))
        self.taken[length] += count

    def open(self, count):
        self.sequences += count
        return self.sequences - count

    def best_fit(self, length, count):
        """Items of one length into the fullest bins that hold them, whole runs of bins at a time."""
        room = length
        while count:
            while room <= self.capacity and not self.bins[room]:
                room += 1
            if room > self.capacity:
                per = self.capacity // length
                whole, rest = divmod(count, per)
                for bins, items in ((whole, per), (1, rest)):
                    if bins and items:
                        first = self.open(bins)
                        for i in range(items):
                            self.place(length, first, bins, self.capacity - i * length)
                        self.bins[self.capacity - items * length].append([first, bins])
                return
            run = self.bins[room][-1]
            used = min(count, run[1])
            self.place(length, run[0], used, room)
            self.bins[room - length].append([run[0], used])
            run[0] += used
            run[1] -= used
            if not run[1]:
                self.bins[room].pop()
            count -= used

    def substitute(self, configuration, times, groups):
        """``times`` bins of a configuration, filled with the longest documents left in its groups."""
        runs = [[self.open(times), times, self.capacity]]
        for g, often in enumerate(configuration):
            for _ in range(int(often)):
                cut = []
                for first, count, room in runs:
                    while count:
                        while groups[g] and not groups[g][0][1]:
                            groups[g].pop(0)
                        if not groups[g]:
                            cut.append([first, count, room])
                            break
                        length, left = groups[g][0]
                        used = min(count, left)
                        self.place(length, first, used, room)
                        groups[g][0][1] -= used
                        cut.append([first, used, room - length])
                        first, count = first + used, count - used
                runs = cut
        for first, count, room in runs:
            self.bins[room].append([first, count])


def grouped(lengths, counts, groups):
    """Lengths in falling order cut into groups of equal cardinality: lists of [length, count]."""
    size = -(-int(counts.sum()) // groups)
    out, free = [[]], size
    for length, count in zip(lengths.tolist(), counts.tolist()):
        while count:
            if not free:
                out.append([])
                free = size
            used = min(count, free)
            out[-1].append([length, used])
            count, free = count - used, free - used
    return out


def plan(histogram, capacity=CAPACITY, groups=GROUPS):
    """The places of all pieces from the number of pieces of each length."""
    made = Plan(capacity)
    for length in [length for length in histogram if length == capacity]:
        made.best_fit(length, histogram[length])
    large = np.array(sorted((n for n in histogram if capacity // LARGE_PER_BIN < n < capacity), reverse=True), np.int64)
    rest = {n: c for n, c in histogram.items() if n < capacity}
    if len(large):
        counts = np.array([histogram[n] for n in large.tolist()], np.int64)
        parts = grouped(large, counts, groups)
        merged = {}
        for part in parts:  # one length may fill several groups: they are one size
            merged.setdefault(part[0][0], []).extend(part)
        sizes = np.array(list(merged), np.int64)
        wanted = np.array([sum(c for _, c in part) for part in merged.values()], float)
        parts = [[list(x) for x in part] for part in merged.values()]
        for configuration, times in configurations(sizes, wanted, capacity):
            if times and configuration.any():
                made.substitute(configuration, times, parts)
        rest.update({n: histogram[n] - int(made.taken[n]) for n in large.tolist()})
    for length in sorted(rest, reverse=True):
        if rest[length]:
            made.best_fit(length, rest[length])
    assert len(made.runs) <= 64 * (capacity + GROUPS * GROUPS), "a plan is bounded by the capacity"
    return made


def pack(cut, capacity=CAPACITY):
    """Pieces with ``sequence_id`` and ``offset`` added; ``cut`` comes from ``pieces``, stored."""
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    sizes = stored(salted.groupBy("length", "salt").agg(F.count("length").alias("n")), "lengths")
    # At most the capacity's number of rows.
    counts = {row["length"]: row["n"] for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    made = plan(counts, capacity)
    runs = np.array(sorted(made.runs), np.int64).reshape(-1, 5)
    # Rank of a bucket's first piece: at most SALTS rows of a length in one window.
    before = sizes.selectExpr("length", "salt", "sum(n) over (partition by length order by salt) - n as before")
    within = salted.selectExpr("*", "row_number() over (partition by length, salt order by doc_id, piece) - 1 as within")
    ranked = within.join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))
    told = cut.sparkSession.sparkContext.broadcast(runs)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def look_up(columns):
        table = told.value
        n = len(columns["rank"])
        lengths, ranks = np.array(columns["length"], np.int64), np.array(columns["rank"], np.int64)
        wide = np.int64(1) << np.int64(48)  # length * 2^48 + rank keeps the order of (length, rank)
        at = np.searchsorted(table[:, 0] * wide + table[:, 1], lengths * wide + ranks, side="right") - 1 if n else []
        run = table[at] if n else table[:0]
        out = {name: columns[name] for name in names}
        out["sequence_id"] = run[:, 3] + ranks - run[:, 1]
        out["offset"] = run[:, 4]
        return out

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return map_batches(ranked.select(*names, "rank"), look_up, schema)


def packed(docs, tokenizer_path, capacity=CAPACITY):
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(stored(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
