"""Spelling variants: the gram bound by brute force, near words, forms, roots, and rows of every kind."""

import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.llm import spelling
from fleetlake.llm.spelling import CLOSE, OPEN

LETTERS = "abcé"
WORDS = st.text(LETTERS, min_size=5, max_size=10)


def edited(word):
    """All words one edit away."""
    found = set()
    for i in range(len(word) + 1):
        found |= {word[:i] + c + word[i:] for c in LETTERS}
        if i < len(word):
            found |= {word[:i] + word[i + 1:]} | {word[:i] + c + word[i + 1:] for c in LETTERS}
    return {w for w in found if w != word and len(w) >= 5}


@settings(max_examples=60, deadline=None)
@given(
    WORDS, st.lists(st.text(LETTERS, min_size=2, max_size=4), max_size=60),
    st.lists(st.text(LETTERS, min_size=1, max_size=2).map(lambda t: OPEN + t), max_size=8), st.lists(st.text(LETTERS, min_size=1, max_size=2).map(lambda t: t + CLOSE), max_size=8),
)
def test_every_near_word_is_met_whatever_the_dictionary(word, inner, first, last):
    grams = spelling.Grams({gram: 1 + zlib.crc32(gram.encode()) % 50 for gram in inner + first + last})
    mine = grams.keys(word)
    for other in edited(word):
        short, long_ = sorted((word, other), key=len)
        held = set(grams.keys(long_))
        shift = (0, 1) if len(short) < len(long_) else (0,)
        assert any((gram, place + move) in held for gram, place in (mine if short == word else grams.keys(short)) for move in shift)


def test_cover_takes_the_longest_grams_and_none_within_another():
    grams = spelling.Grams({"abc": 1, "bcd": 1, "cdef": 1})
    assert grams.cover(OPEN + "abcdef" + CLOSE) == [(0, 2), (1, 4), (2, 5), (3, 7), (6, 8)]


def test_dictionary_extends_frequent_grams_alone(spark):
    words = spark.createDataFrame([("aaaab" + c, 1) for c in "abcdefghij"] + [("xyzxyz", 1)], "word string, n long")
    found = spelling.dictionary(words, share=0.05)
    everything = {row.gram: row.n for row in spelling.gram_counts(words).collect()}
    pairs = {gram: n for gram, n in everything.items() if len(gram) == 2}
    limit = sum(pairs.values()) * 0.05
    assert pairs.items() <= found.items()
    for gram in found:
        assert len(gram) == 2 or everything[gram[:-1]] > limit and (len(gram) == 3 or gram[:-1] in found)
    assert any(len(gram) == 4 for gram in found)
    for start in {gram[:-1] for gram in found if len(gram) > 2}:  # what was merged back is rare in all
        assert sum(n for gram, n in everything.items() if gram[:-1] == start and gram not in found) <= limit


TEXTS = {
    1: "house house House HOUSE hoose mouse mouse mouse", 2: None, 3: "", 4: "--- 12 ab", 5: "élève eleve élève élève eleve eleve",
    6: "houses houses houses " * 3 + "house " * 40 + "housed " * 5, 7: "x" * 30_000 + " hoose hoose", 8: "schön " * 4 + "schon " * 9 + "Schœn",
}


def brute_counts(rows, one_in):
    counts = Counter()
    for doc_id, text in rows:
        for word in spelling.WORD.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            if one_in:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if h % one_in == 0:
                    word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(counts):
    def one_edit(a, b):
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, out = {}, {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def test_rows_of_every_kind(spark):
    rows = [*TEXTS.items(), (None, "house housed housed"), (6, TEXTS[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1)).withColumn("n", F.lit("x")).repartition(4)
    for one_in in (97, 3, None):
        found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.grouped(docs, one_in).collect()}
        assert found == brute(brute_counts(rows, one_in))
    assert spelling.grouped(docs.limit(0)).collect() == []


def test_roots_of_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}", 2 ** (i + 1)) for i in range(40)]
    found = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string, form_n long")).collect()}
    assert found == {f"w{i}": "w40" for i in range(40)}
