"""Token files: round trips, code lengths, order, single blocks, and rows of every kind."""

import functools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.llm import tokenfile
from fleetlake.llm.queries import REGISTERED
from fleetlake.session import scratch

SF = "/root/testdata/sf0.001"
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def loaded(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def library(text, path=BYTES, end=0):
    return loaded(path).encode(text or "", add_special_tokens=False).ids + [end]


def test_query_equals_the_library(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in REGISTERED["op12_token_files"](spark, SF).collect()}
    start = 0
    assert len(found) == len(rows)
    for row in rows:
        ids = np.array(library(row.text), "<u4")
        assert found[row.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


WORDS = st.sampled_from(["don't", "I'LL we've", " ", "\n", "\t", "  \n x", "été", "_a_", "42", "x²", "中文", "😀", "—", "<|endoftext|>", "'s", "à́", " ", "ªº", "\x1f", "ß."])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(WORDS, st.text(max_size=4)), max_size=8))
def test_encoder_equals_the_library(parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    (ids,) = tokenfile.encoder(BYTES)([text])
    assert np.frombuffer(ids, "<u2").tolist() == library(text)[:-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(WORDS, st.text("abé.,'-1 ", max_size=6)), max_size=8).map(" ".join), max_size=12))
def test_encoder_with_small_bounds_equals_the_library(many):
    many = ["".join(text).encode("utf-8", "replace").decode() for text in many]
    tokens = small_encoder()
    assert [np.frombuffer(ids, "<u2").tolist() for ids in tokens(iter(many))] == [library(text)[:-1] for text in many]


@functools.cache
def small_encoder():
    tokens = tokenfile.Encoder(BYTES)
    tokens.WORDS, tokens.BOUND, tokens.SLICE, tokens.RUN = 5, 5, 20, 2
    return tokens


def test_a_word_goes_to_the_library_once_whatever_follows_it():
    tokens, given_to_library = tokenfile.Encoder(BYTES), []
    whole = tokens.whole
    tokens.whole = lambda many: given_to_library.extend(many) or whole(many)
    text = "so zebrafish zebrafish, zebrafish$$$ zebrafish-2 (zebrafish zebrafish.\nSo zebrafish's"
    for _ in range(2):
        (ids,) = tokens([text])
        assert np.frombuffer(ids, "<u2").tolist() == library(text)[:-1]
    assert " ".join(given_to_library).split().count("zebrafish") == 2  # one of them without a space before it


def test_patterns_agree_with_the_table_of_characters():
    import pyarrow as pa
    import pyarrow.compute as pc

    chars = [chr(i) for i in [*range(0xD800), *range(0xE000, 0x11000)]]
    column = pa.array(chars, pa.large_string())
    assert pc.match_substring_regex(column, tokenfile.ODD).to_pylist() == [not tokenfile.simple(char) for char in chars]
    words = pc.extract_regex(column, tokenfile.WORD).field("word").to_pylist()
    assert [bool(word) for word in words] == [char in tokenfile.LETTERS for char in chars]
    assert [char for char in chars if tokenfile.simple(char) and char.isalpha()] == list(filter(tokenfile.simple, tokenfile.LETTERS))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**6), min_size=1, max_size=40), st.integers(6, 12))
def test_code_lengths_are_limited_complete_and_best(counts, limit):
    lengths = tokenfile.code_lengths(counts, limit)
    assert lengths.max() <= limit
    assert sum(2.0 ** -int(n) for n in lengths) == (0.5 if len(counts) == 1 else 1.0)
    import heapq

    heap, cost = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    limited = int((lengths * np.array(counts)).sum())
    free = tokenfile.code_lengths(counts, 40)
    assert limited >= cost or len(counts) == 1
    assert len(counts) == 1 or int((free * np.array(counts)).sum()) == cost


def test_limit_below_the_alphabet_is_refused():
    with pytest.raises(ValueError):
        tokenfile.code_lengths([1] * 9, 3)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 300), min_size=1, max_size=3000), st.integers(0, 2**31))
def test_bits_come_back(ids, seed):
    ids = np.array(ids)
    used = np.unique(ids)
    book = tokenfile.Codebook.of_counts(used, np.random.default_rng(seed).integers(1, 10**9, len(used)))
    payload, checkpoints = book.encode(ids)
    assert (book.decode(payload, checkpoints)[:len(ids)] == ids).all()
    again = tokenfile.Codebook(book.ids, book.bits)
    for block in range(len(checkpoints)):  # each block alone
        part = ids[block * tokenfile.BLOCK:(block + 1) * tokenfile.BLOCK]
        assert (again.decode(payload, checkpoints[block:block + 1])[:len(part)] == part).all()


LONG = " ".join(f"word{i % 997}x{i % 89}" for i in range(120_000))
ROWS = [(5, "b"), (3, None), (4, ""), (None, "first"), (3, "a a a"), (9, LONG), (7, "twice"), (7, "twice"), (8, "<|endoftext|> 中 \x00\n"), (-2, "minus")]


def test_bits_of_the_longest_codes():
    ids = np.arange(26)
    book = tokenfile.Codebook(ids, np.minimum(ids + 1, 25))  # codes of 1 to 25 bits
    many = np.random.default_rng(3).integers(0, 26, 5000)
    payload, checkpoints = book.encode(many)
    bits = "".join(f"{book.code[i]:0{book.length[i]}b}" for i in many)
    assert payload == int(bits.ljust(-len(bits) // 8 * -8, "0"), 2).to_bytes(-(-len(bits) // 8))
    assert (book.decode(payload, checkpoints)[:len(many)] == many).all()


def test_rows_of_every_kind(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("start", F.lit(1)).repartition(5)
    path = tokenfile.write(docs, scratch(spark, "tokens"), BYTES)
    found = sorted(tokenfile.read(spark, path).collect(), key=lambda r: r.start)
    wanted = sorted(((i, library(t)) for i, t in ROWS), key=lambda row: (row[0] is not None, row[0] or 0, len(row[1])))
    assert [(r.doc_id, r.ids) for r in found] == wanted
    stream = [i for _, ids in wanted for i in ids]
    assert [r.start for r in found] == [sum(len(ids) for _, ids in wanted[:k]) for k in range(len(wanted))]
    assert len(stream) > tokenfile.CHUNK
    for start, length in ((0, 7), (300, 1000), (len(stream) - 5, 100), (tokenfile.CHUNK - 10, 20), (len(stream), 3)):
        cut = sorted(tokenfile.read_slice(spark, path, start, length).collect())
        assert [i for _, ids in cut for i in ids] == stream[start:start + length]


def test_another_vocabulary(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.createDataFrame([(1, "Some Words, here"), (2, "x")], "doc_id long, text string")
    found = tokenfile.read(spark, tokenfile.write(docs, scratch(spark, "tokens"), path, end=1)).collect()
    assert {r.doc_id: r.ids for r in found} == {1: library("Some Words, here", path, 1), 2: library("x", path, 1)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = tokenfile.write(docs, scratch(spark, "tokens"), BYTES)
    assert tokenfile.digests(spark, path).collect() == [] and tokenfile.read_slice(spark, path, 0, 5).collect() == []
