"""Ranked search: trees against brute force, pruning, blocks of items, and rows of every kind."""

import math
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.llm import fptree
from tests.llm import brute

VECTOR = st.tuples(st.integers(75, 300), st.dictionaries(st.integers(0, 12), st.integers(1, 5), max_size=6))


def planted(vectors, k):
    return fptree.Tree([
        (i, m, np.array(list(tf), np.int64), np.array(list(tf.values()), np.int32)) for i, (m, tf) in enumerate(vectors) if tf
    ], k)


def by_hand(vectors, weights, k):
    scores = [(-sum(weights.get(t, 0) * (10**9 * f // (1000 * f + 12 * m)) for t, f in tf.items()), i) for i, (m, tf) in enumerate(vectors)]
    return sorted(row for row in scores if row[0] < 0)[:k]


@settings(max_examples=150, deadline=None)
@given(st.lists(VECTOR, min_size=1, max_size=60), st.dictionaries(st.integers(0, 12), st.integers(0, 9), min_size=1), st.integers(1, 6), st.sampled_from([1, 3, 32]))
def test_tree_finds_what_brute_force_finds(vectors, weights, k, leaf):
    vectors = vectors + vectors[:20]
    item = fptree.Item(np.array(list(weights), np.int64), np.array(list(weights.values()), np.int64))
    best, before = fptree.Best(k), fptree.LEAF
    fptree.LEAF = leaf
    try:
        tree = planted(vectors, k) if any(tf for _, tf in vectors) else None
        if tree:
            tree.search(item, best)
    finally:
        fptree.LEAF = before
    assert [row for row in best.cut() if row[0] < 0] == by_hand(vectors, weights, k)


def test_branches_are_left_out():
    rng = np.random.default_rng(3)
    vectors = [(int(rng.integers(75, 200)), {int(t): int(rng.integers(1, 4)) for t in 400 - np.unique(rng.geometric(0.01, 30).clip(1, 400))}) for _ in range(3000)]
    tree, scored = planted(vectors, 5), []
    whole = tree.scored
    tree.scored = lambda item, docs: scored.append(len(docs)) or whole(item, docs)
    weights = {0: 9000, 3: 7000, 50: 3000, 390: 20, 399: 10}
    best = fptree.Best(5)
    tree.search(fptree.Item(np.array(list(weights)), np.array(list(weights.values()))), best)
    assert best.cut() == by_hand(vectors, weights, 5)
    assert sum(scored) < 0.5 * len(vectors)


def ranking(docs, items, k):
    docs = [(i, Counter(brute.alnum_words(t))) for i, t in docs]
    docs = [(i, tf) for i, tf in docs if tf]
    total, n = sum(sum(tf.values()) for _, tf in docs), len(docs)
    df = Counter(t for _, tf in docs for t in tf)
    asked = {}
    for item_id, text in items:
        asked.setdefault(item_id, Counter()).update(brute.alnum_words(text))
    found = {}
    for item_id, terms in asked.items():
        scores = []
        for i, tf in docs:
            m = 75 + 25 * sum(tf.values()) * n // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t, c in terms.items() if t in tf)
            if s > 0 and i is not None:
                scores.append((-s, i))
        for rank, (s, i) in enumerate(sorted(scores)[:k], 1):
            found.setdefault((item_id, rank), []).append((i, -s))
    return found


DOCS = [(1, "alpha beta gamma"), (2, "Alpha ALPHA beta"), (2, "Alpha ALPHA beta"), (3, None), (4, ""), (None, "alpha delta"), (5, " .,"), (6, "été Été delta"), (7, "alpha beta gamma"), (8, "delta " * 30_000 + "alpha"), (-9, "Été 42")]
ITEMS = [(1, "alpha, Beta"), (1, "gamma"), (2, None), (3, "delta été zeta"), (4, "zeta"), (None, "42 beta beta"), (2**60 + 1, "gamma 42")]


def test_rows_of_every_kind(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumn("n", F.lit("x")).withColumn("item", F.lit(1)).repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("rank", F.lit("x")).withColumn("term", F.lit(0))
    for block_bytes in (fptree.BLOCK_BYTES, 100):
        rows = fptree.ranked(docs, items, k=4, block_bytes=block_bytes).collect()
        found = {}
        for r in rows:
            found.setdefault((r.item_id, r["rank"]), []).append((r.doc_id, r.score))
        assert found == ranking(DOCS, ITEMS, 4)


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for a, b in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("text = ''"), items)):
        assert fptree.ranked(a, b).collect() == []
