"""Token ids in binary files: canonical Huffman codes of limited length, decoded by table in independent blocks.

Method. Texts are encoded with a public tokenizer and end with an end id. The ids are counted over all documents;
package-merge turns the counts into the best code lengths of at most ``limit`` bits, and canonical numbering turns the
lengths into codes, so the lengths alone are stored. A chunk is a row of the file table: some whole documents in
order, their ids as one bit string, and checkpoints, the bit where each block of ``BLOCK`` ids begins. A
decoder looks at the next ``limit`` bits, which name the id and its length in a table. Blocks need nothing
of each other, so all blocks of a chunk are decoded at once, one id of each per step, and ``read_slice`` decodes
only the blocks that it needs.

Files. ``<path>/codebook``: id, bits. ``<path>/chunks``: part, chunk, first (ids before it in its part), doc_ids,
doc_tokens, n_tokens, checkpoints, payload. Parts follow each other in doc_id order, and chunks within a part; the sum of the
parts before gives every position in the whole stream.

Scale. Tokens are stored once at two or four bytes an id, then dealt in ranges of doc_id and sorted within them; rows
that repeat a doc_id are cut apart by text and place. Counts are added up per task before the
shuffle; the code book is as large as the vocabulary at most, and of the parts one number each is read. Tasks hold a chunk of
``CHUNK`` ids, or one longer document.

Rows: a null or empty text is the end id alone. A null doc_id comes first in the order. Repeated doc_ids are
kept each, the shorter first, then by checksum; rows equal in all three may stand in any order, which gives
the same result. An empty table gives an empty code book and no chunks. A special token's string in a text is encoded as
the library does it by default. Only doc_id and text are read.
"""

import functools
import re
import unicodedata
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.llm.common import map_batches, stored, texts

END = 0
BLOCK, CHUNK = 256, 1 << 18
#: Code lengths reach this many bits, or one more than a vocabulary needs.
LIMIT = 18

# Fixed pattern: how byte-level vocabularies cut a text, for texts of the characters that ``simple`` lets through.
PIECES = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


@functools.cache
def simple(char):
    """Whether a character is a letter, digit, mark or space to every version of the tables, and so to both cutters."""
    if char < "\x80":
        return char not in "\x0b\x0c\x1c\x1d\x1e\x1f\x7f" and (char >= " " or char in "\t\n\r")
    return char < "ɐ" and char.isalpha() or char < "←" and unicodedata.category(char)[0] in "PS"


# Arrow's patterns. Texts that ``PIECES`` may cut otherwise than the library; texts with white space other than line feeds within
# words and single spaces between them; the letters that start a part, and what follows them.
ODD = f"[^{re.escape(''.join(filter(simple, map(chr, range(ord('←'))))))}]|<\\|"
UNEVEN = "[\t\r\xa0]|  | \n|\n |\\A | \\z"
LETTERS = "".join(filter(str.isalpha, map(chr, range(ord("ɐ")))))
WORD = f"^(?P<word>[{LETTERS}]*)(?P<rest>(?s:[^{LETTERS}].*)?)$"


class Encoder:
    """Ids of texts as bytes.

    A byte-level vocabulary's cutter never joins what stands on both sides of a single space between other
    characters. So a text is cut there first, and each distinct part of some texts into its leading letters, a word, and the
    rest. The ids of words, with the space before them, are remembered per worker, in Arrow arrays; a rest is made of pieces,
    which are remembered as well. Texts with other white space are cut into pieces as a whole.
    """

    #: Words that a worker remembers, and pieces; it starts anew beyond. Code points cut at a time. Words encoded at a time.
    WORDS, BOUND, SLICE, RUN = 1_000_000, 400_000, 8_000_000, 5000

    def __init__(self, path):
        import pyarrow as pa
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.kind = "<u2" if size <= 1 << 16 else "<u4"
        self.words, self.word_ids, self.pieces = pa.array([], pa.large_string()), pa.array([], pa.large_binary()), {}
        cutter = self.tokenizer.pre_tokenizer
        self.bytewise = type(cutter).__name__ == "ByteLevel" and not cutter.add_prefix_space and self.tokenizer.normalizer is None
        # How the vocabulary spells a space; no id but a piece's first begins with it.
        self.opening = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def whole(self, many):
        found = self.tokenizer.encode_batch_fast(many, add_special_tokens=False)
        return [np.array(encoding.ids, self.kind).tobytes() for encoding in found]

    def spaced(self, text, n):
        """Ids of ``n`` words, each with a space before it, in one text: their bytes, and where each begins and the last ends."""
        (ids,) = self.whole([text])
        starts = np.flatnonzero(self.opening[np.frombuffer(ids, self.kind)])
        if len(starts) == n:
            return ids, np.append(np.dtype(self.kind).itemsize * starts, len(ids))
        each = self.whole([" " + word for word in text[1:].split(" ")])
        return b"".join(each), np.cumsum([0, *map(len, each)])

    def learn(self, pieces):
        """Encode those pieces that are not known yet."""
        new = pieces.difference(self.pieces)
        if len(self.pieces) + len(new) > self.BOUND:
            self.pieces, new = {}, pieces
        words = [piece for piece in new if piece[0] == " " and piece[1:].isalpha()]
        others = list(new.difference(words))
        for start in range(0, len(words), self.RUN):
            run = words[start:start + self.RUN]
            ids, bounds = self.spaced("".join(run), len(run))
            bounds = bounds.tolist()
            self.pieces.update(zip(run, (ids[a:b] for a, b in zip(bounds, bounds[1:]))))
        for start in range(0, len(others), self.RUN):
            run = others[start:start + self.RUN]
            self.pieces.update(zip(run, self.whole(run)))

    def cut(self, many):
        """Ids of texts of ``simple`` characters by way of their pieces."""
        cut = [PIECES.findall(text) for text in many]
        self.learn(set().union(*cut))
        return [b"".join(map(self.pieces.__getitem__, pieces)) for pieces in cut]

    def some(self, many):
        """Ids of each text, for texts that may be in parts at once."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pa.array(many, pa.large_string())
        odd, uneven = (pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False) for pattern in (ODD, UNEVEN))
        kinds = np.where(odd | (not self.bytewise), 2, uneven)
        found = [b""] * len(many)
        for kind, encode in enumerate((self.by_parts, self.cut, self.whole)):
            places = np.flatnonzero(kinds == kind).tolist()
            for place, ids in zip(places, encode([many[place] for place in places])):
                found[place] = ids
        return found

    def of_words(self, words):
        """Ids of distinct words, each with a space before it."""
        import pyarrow as pa
        import pyarrow.compute as pc

        at = pc.index_in(words, value_set=self.words)
        unknown = at.is_null()
        new, known, known_ids = words.filter(unknown), self.words, self.word_ids
        if len(new):
            found = [known_ids]
            for start in range(0, len(new), self.RUN):
                run = new.slice(start, self.RUN)
                ids, bounds = self.spaced(" " + " ".join(run.to_numpy(zero_copy_only=False)), len(run))
                buffers = [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)]
                found.append(pa.Array.from_buffers(pa.large_binary(), len(run), buffers))
            known, known_ids = pa.concat_arrays([known, new]), pa.concat_arrays(found)
            places = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            places[unknown.to_numpy(zero_copy_only=False)] = np.arange(len(self.words), len(known))
            at = pa.array(places)
        ids = known_ids.take(at)
        self.words, self.word_ids = (known, known_ids) if len(known) <= self.WORDS else (words, ids)  # what these texts need stays
        return ids

    def by_parts(self, many):
        """Ids of texts in which a single space stands between two other characters that are not white space, wherever one stands."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not many:
            return []
        cut = [text.partition(" ") for text in many]
        firsts = self.cut([first for first, _, _ in cut])
        lists = pc.split_pattern(pa.array([more if space else None for _, space, more in cut], pa.large_string()), " ")
        parts = lists.values.dictionary_encode()
        words, rests = (field.cast(pa.large_string()) for field in pc.extract_regex(parts.dictionary, WORD).flatten())
        bare = pc.equal(words, "")
        none, space, nothing = (pa.scalar(value, pa.large_string()) for value in (None, " ", ""))
        words = pc.if_else(bare, none, words).dictionary_encode()
        rests = pc.binary_join_element_wise(pc.if_else(bare, space, nothing), rests, nothing).dictionary_encode()
        word_ids = self.of_words(words.dictionary).take(words.indices)
        rest_ids = pa.array(self.cut(rests.dictionary.to_pylist()), pa.large_binary()).take(rests.indices)
        ids = pc.binary_join_element_wise(
            word_ids, rest_ids, pa.scalar(b"", pa.large_binary()), null_handling="replace", null_replacement=b""
        )
        joined = ids.take(parts.indices)
        if not len(joined):
            return firsts
        _, offsets, data = joined.buffers()
        bounds = np.frombuffer(offsets, np.int64)[lists.offsets.to_numpy()].tolist()
        data = memoryview(data)
        return [first + data[a:b] for first, a, b in zip(firsts, bounds, bounds[1:])]

    def __call__(self, many):
        """Ids of each text."""
        found, waiting, held = [], [], 0
        for text in many:
            waiting.append(text)
            held += len(text)
            if held > self.SLICE:
                found += self.some(waiting)
                waiting, held = [], 0
        return found + self.some(waiting)


@functools.cache
def encoder(path):
    """One encoder for all tasks of a worker."""
    return Encoder(path)


def encoded(docs, tokenizer_path, end=END):
    """doc_id, n ids, their checksum, and the ids in little-endian unsigned integers as wide as the vocabulary needs."""

    def encode(columns):
        tokens = encoder(tokenizer_path)
        last = np.array([end], tokens.kind).tobytes()
        ids = [each + last for each in tokens(text.decode() if text else "" for text in columns["text"])]
        width = np.dtype(tokens.kind).itemsize
        crc = [zlib.crc32(np.frombuffer(each, tokens.kind).astype("<u4")) for each in ids]
        return {"doc_id": columns["doc_id"], "n": [len(each) // width for each in ids], "crc": crc, "ids": ids}

    return map_batches(texts(docs), encode, "doc_id long, n long, crc long, ids binary")


def id_counts(tokens, kind):
    """How often each id occurs: (id, n). A task sends every id once."""

    def count(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), kind))
            if len(found) > len(total):
                total, found = found, total
            total[:len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts, limit):
    """Lengths, for each of the ``counts`` above zero, of the best prefix code without a code longer than ``limit``.

    Package-merge: at every level the counts are merged with the packages (pairs) of the level below. The
    cheapest 2n - 2 items of the last level hold each symbol as often as its code has bits.
    """
    n = len(counts)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit in codes of {limit} bits")
    if n == 1:
        return np.ones(1, np.int64)
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.int64)[order]
    levels, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        items = np.concatenate([weights, packages])
        merged = np.argsort(items, kind="stable")
        levels.append(merged < n)
        items = items[merged]
        packages = items[:len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        lengths[:symbols] += 1
        take = 2 * (take - symbols)
    found = np.empty(n, np.int64)
    found[order] = lengths
    return found


class Codebook:
    """Canonical codes of the ids that occur: shorter codes first, equal lengths by id."""

    def __init__(self, ids, bits):
        self.ids, self.bits = np.asarray(ids, np.int64), np.asarray(bits, np.int64)
        self.limit = int(self.bits.max(initial=1))
        order = np.lexsort((self.ids, self.bits))
        steps = np.left_shift(1, self.limit - self.bits[order])
        firsts = np.cumsum(steps) - steps
        self.table_id = np.zeros(1 << self.limit, np.uint32)
        self.table_bits = np.ones(1 << self.limit, np.int64)
        self.table_id[:steps.sum()] = np.repeat(self.ids[order], steps)
        self.table_bits[:steps.sum()] = np.repeat(self.bits[order], steps)
        size = int(self.ids.max(initial=0)) + 1
        self.code, self.length = np.zeros(size, np.uint32), np.zeros(size, np.int64)
        self.code[self.ids[order]] = firsts >> (self.limit - self.bits[order])
        self.length[self.ids] = self.bits

    @classmethod
    def of_counts(cls, ids, counts, limit=LIMIT):
        limit = max(limit, (max(len(ids), 1) - 1).bit_length() + 1)
        if limit > 25:
            raise ValueError("a code and its place in a byte have to fit in 32 bits")
        return cls(ids, code_lengths(counts, limit) if len(ids) else [])

    def encode(self, ids):
        """(payload, checkpoints) of an array of ids."""
        lengths = self.length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        # Codes lie in cells of 32 bits and reach into the next one at most; none is longer than a cell, so every cell begins one.
        words = self.code[ids].astype(np.uint64) << (64 - (starts & 31) - lengths).astype(np.uint64)
        firsts = np.flatnonzero(np.diff(starts >> 5, prepend=-1))
        sums = np.append(np.add.reduceat(words, firsts), np.uint64(0))  # codes share no bit, so adding them is the same as setting their bits
        cells = sums >> np.uint64(32)
        cells[1:] |= sums[:-1] & np.uint64(0xFFFFFFFF)
        return cells.astype(">u4").tobytes()[:int(ends[-1]) + 7 >> 3], starts[::BLOCK]

    def decode(self, payload, checkpoints):
        """The ids of whole blocks, each from its checkpoint on; what follows the last id of a chunk is noise."""
        data = np.frombuffer(payload + bytes(BLOCK * self.limit // 8 + 8), np.uint8).astype(np.uint32)
        windows = data[:-3] << np.uint32(24) | data[1:-2] << np.uint32(16) | data[2:-1] << np.uint32(8) | data[3:]
        at, shift = np.array(checkpoints, np.int64), np.uint32(32 - self.limit)
        found = np.empty((BLOCK, len(at)), np.uint32)
        for k in range(BLOCK):
            ahead = windows[at >> 3] << (at & 7).astype(np.uint32) >> shift
            found[k] = self.table_id[ahead]
            at += self.table_bits[ahead]
            np.minimum(at, 8 * len(payload), out=at)
        return found.T.ravel()


CHUNKS = (
    "part int, chunk int, first long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, "
    "checkpoints array<long>, payload binary"
)


def write(docs, path, tokenizer_path, end=END, limit=LIMIT):
    """Encode all documents, in ascending doc_id order, into the files below ``path``."""
    spark = docs.sparkSession
    kind = encoder(tokenizer_path).kind
    tokens = stored(encoded(docs, tokenizer_path, end), "tokens")
    counts = id_counts(tokens, kind).toPandas().sort_values("id")  # at most one row for each id of the vocabulary
    book = Codebook.of_counts(counts["id"].to_numpy(), counts["n"].to_numpy(), limit)
    pairs = list(zip(book.ids.tolist(), book.bits.tolist()))
    spark.createDataFrame(pairs, "id long, bits long").coalesce(1).write.parquet(f"{path}/codebook")
    told = spark.sparkContext.broadcast(book)

    def chunks(batches):
        import pyarrow as pa

        part, number, first = TaskContext.get().partitionId(), 0, 0
        doc_ids, parts = [], []

        def emit():
            nonlocal number, first
            ids = np.concatenate(parts)
            payload, checkpoints = told.value.encode(ids)
            row = [part, number, first, list(doc_ids), [len(p) for p in parts], len(ids), checkpoints.tolist(), payload]
            number, first = number + 1, first + len(ids)
            doc_ids.clear(), parts.clear()
            types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            names = [field.split()[0] for field in CHUNKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, types)], names)

        held = 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0), batch.column(1)):
                doc_ids.append(doc_id.as_py())
                parts.append(np.frombuffer(ids.as_py(), kind))
                held += len(parts[-1])
                if held >= CHUNK:
                    yield emit()
                    held = 0
        if parts:
            yield emit()

    order = ["doc_id", "n", "crc", "_cut"]
    rows = tokens.withColumn("_cut", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
    ranged.mapInArrow(chunks, CHUNKS).write.parquet(f"{path}/chunks")
    return path


def codebook(spark, path):
    """The code book of the files below ``path``: as many rows as ids that occur."""
    rows = spark.read.parquet(f"{path}/codebook").toPandas()
    return Codebook(rows["id"].to_numpy(), rows["bits"].to_numpy())


def placed_chunks(spark, path):
    """All chunks with ``start``, the ids before them in the whole stream."""
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks")
    sizes = chunks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # one row for each task that wrote
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).alias("_base"))
    joined = chunks.join(bases, chunks["part"] == bases["_part"])
    return joined.withColumn("start", F.col("_base") + F.col("first")).drop("_part", "_base")


def _documents(spark, path, columns, schema):
    """For each stored document ``columns(ids)``, beside its doc_id, start and n_tokens."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    told, arrow = spark.sparkContext.broadcast(codebook(spark, path)), to_arrow_schema(_parse_datatype_string(schema))

    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = told.value.decode(row["payload"], row["checkpoints"])
                sizes = np.array(row["doc_tokens"], np.int64)
                ends = np.cumsum(sizes)
                each = [columns(ids[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
                made = [row["doc_ids"], row["start"] + ends - sizes, sizes, each]
                yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(made, arrow)], schema=arrow)

    needed = placed_chunks(spark, path).select("start", "doc_ids", "doc_tokens", "checkpoints", "payload")
    return needed.mapInArrow(read, schema)


def read(spark, path):
    """Every document's ids, read back: doc_id, start, n_tokens, ids."""
    return _documents(spark, path, lambda ids: ids.tolist(), "doc_id long, start long, n_tokens long, ids array<long>")


def digests(spark, path):
    """The same with the checksum of the ids as little-endian unsigned 32-bit integers in their place."""
    return _documents(
        spark, path, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def read_slice(spark, path, start, length):
    """The ids from place ``start`` on, ``length`` of them or as many as there are: (place, ids), a row for each chunk that holds some.

    Of a chunk only the blocks between the two ends are decoded.
    """
    told = spark.sparkContext.broadcast(codebook(spark, path))
    end = start + length

    def cut(columns):
        out = {"place": [], "ids": []}
        for at, n, checkpoints, payload in zip(*[columns[name] for name in ("start", "n_tokens", "checkpoints", "payload")]):
            a, b = max(start - at, 0), min(end - at, n)
            ids = told.value.decode(payload, checkpoints[a // BLOCK:(b + BLOCK - 1) // BLOCK])
            skip = a // BLOCK * BLOCK
            out["place"].append(at + a)
            out["ids"].append(ids[a - skip:b - skip].tolist())
        return out

    chunks = placed_chunks(spark, path).where((F.col("start") < end) & (F.col("start") + F.col("n_tokens") > start))
    return map_batches(chunks.select("start", "n_tokens", "checkpoints", "payload"), cut, "place long, ids array<long>")
