"""Ranked lexical search by branch and bound over trees of documents.

Method. A document is the vector of its terms that some item asks for, ordered by the terms' frequency, rarest
first. Documents of a task are gathered into trees: those whose vectors begin alike share a path. Each node knows, for the terms of the
documents below it, the largest tf, and the smallest m (the length factor). A term's part of a score grows with tf and falls
with m, so an item's weights with those two bound every score below the node. Per item the tree is searched depth first, the child of
the highest bound first; a child whose bound is below the item's k-th best score so far is left out with all below it. Nodes of at most
``LEAF`` documents are scored in full. With the rarest terms first, an item's documents lie below few children,
and all others are bounded by its frequent terms alone, which weigh little. Nodes are made when they are first visited. Documents
equal in vector and length have equal scores and stand in the tree once, with their k smallest ids.

Scores are 64-bit integers: see ``Item``. The weight of a term needs its document frequency, so texts are read once for vectors
and statistics, and the stored vectors are searched.

Scale. Items are asked in blocks of at most ``BLOCK_BYTES`` of terms, measured before a block is collected and sent to the
tasks (an item larger than that is a block of its own). Each block reads all documents once, without a shuffle. A tree holds at most
``CELLS`` entries or one document. A task sends k rows for each item, and those are ranked per item, which Spark does with a
limit per task before the shuffle.

Rows: a null or empty text has no terms; it counts nowhere. A document with a null doc_id counts in the statistics but is not ranked, since a
result could not name it. Rows that repeat a doc_id are documents of their own. Rows of one item_id are one item together; an
item without terms has no results. Ties go to the smaller doc_id. Empty tables give an empty result. Other
columns are not read.
"""

import math
from collections import Counter

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetlake.llm.common import alnum_words, map_batches, stored, texts

LEAF = 32
#: Entries of a tree; a document counts as this many beside its own.
CELLS, DOCUMENT = 1_000_000, 20
BLOCK_BYTES = 16_000_000
#: What a term of an item takes beside its letters.
OVERHEAD = 64
NOTHING = -(1 << 62)


def asked_terms(items):
    """(item_id, term, times) of all items, terms as UTF-8 bytes."""

    def count(columns):
        out = {"item_id": [], "term": [], "times": []}
        for item_id, text in zip(columns["item_id"], columns["text"]):
            for term, times in Counter(alnum_words(text)).items():
                out["item_id"].append(item_id)
                out["term"].append(term)
                out["times"].append(times)
        return out

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    counted = map_batches(rows, count, "item_id long, term binary, times long")
    return counted.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def in_blocks(asked, block_bytes=BLOCK_BYTES):
    """The asked terms with a block number per item, and the number of blocks; each is small enough or a single item."""
    sizes = stored(asked.groupBy("item_id").agg(F.sum(F.octet_length("term") + OVERHEAD).alias("bytes")), "item-sizes")
    blocks = -(-(sizes.agg(F.sum("bytes")).first()[0] or 0) // block_bytes)
    number = F.pmod(F.xxhash64("item_id"), F.lit(max(blocks, 1)))
    while blocks > 1:
        filled = sizes.groupBy(number.alias("block")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        if filled.where((F.col("bytes") > 2 * block_bytes) & (F.col("n") > 1)).isEmpty():
            break
        blocks *= 2
        number = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    return asked.withColumn("block", number), blocks


def vectors(docs, terms):
    """Documents with terms: doc_id, n, and those of ``terms`` they hold by number, with their tf, as arrays of 32-bit integers."""
    told = docs.sparkSession.sparkContext.broadcast({term: number for number, term in enumerate(terms)})

    def count(columns):
        numbers = told.value
        out = {"doc_id": [], "n": [], "terms": [], "tfs": []}
        for doc_id, text in zip(columns["doc_id"], columns["text"]):
            words = alnum_words(text)
            if words:
                found = Counter(filter(numbers.__contains__, words))
                out["doc_id"].append(doc_id)
                out["n"].append(len(words))
                out["terms"].append(np.array([numbers[word] for word in found], "<i4").tobytes())
                out["tfs"].append(np.array(list(found.values()), "<i4").tobytes())
        return out

    return map_batches(texts(docs), count, "doc_id long, n long, terms binary, tfs binary")


def frequencies(rows, size):
    """(documents, their terms in all, documents per term) of vectors over ``size`` terms."""

    def count(batches):
        import pyarrow as pa

        found = np.zeros(size + 2, np.int64)
        for batch in batches:
            for terms in batch.column(1):
                found[:size] += np.bincount(np.frombuffer(terms.as_buffer(), "<i4"), minlength=size)
            found[size] += batch.num_rows
            found[size + 1] += sum(batch.column(0).to_pylist())
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(found[used])], ["term", "n"])

    counted = rows.select("n", "terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(size + 2, np.int64)
    for row in counted.collect():  # at most one for each term of the block
        found[row.term] = row.n
    return int(found[size]), int(found[size + 1]), found[:size]


def parts(tf, m):
    """What terms give for a weight of 1."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Item:
    """An item's terms by frequency rank, in order, each with its weight times its repeats."""

    def __init__(self, ranks, weights):
        order = np.argsort(ranks)
        self.ranks, self.weights = ranks[order], weights[order]

    def among(self, sorted_ranks):
        """Where the item's terms stand in sorted ranks: (places, weight at each place)."""
        low, high = np.searchsorted(sorted_ranks, self.ranks), np.searchsorted(sorted_ranks, self.ranks, "right")
        sizes = high - low
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - low, sizes)
        return places, np.repeat(self.weights, sizes)

    def scores(self, ranks):
        """The weight of each of ``ranks``, 0 for terms that are not asked for."""
        if not len(self.ranks):
            return np.zeros(len(ranks), np.int64)
        place = np.minimum(np.searchsorted(self.ranks, ranks), len(self.ranks) - 1)
        return np.where(self.ranks[place] == ranks, self.weights[place], 0)


class Node:
    """The children of the documents ``start`` to ``end``, which agree in their first ``depth`` terms.

    ``rank``, ``child`` and ``tf`` list, sorted by rank, the largest tf of each term below each child.
    """

    def __init__(self, tree, start, end, depth):
        docs = np.arange(start, end)
        here = np.minimum(tree.first[docs] + depth, len(tree.ranks) - 1)
        following = np.where(tree.size[docs] > depth, tree.ranks[here], -1)
        cuts = np.flatnonzero(np.append(True, following[1:] != following[:-1]))
        self.starts, self.ends, self.depth = start + cuts, start + np.append(cuts[1:], end - start), depth + 1
        self.ended = following[cuts] < 0
        self.m = np.minimum.reduceat(tree.m[start:end], cuts)
        a, b = tree.first[start], tree.first[end - 1] + tree.size[end - 1]
        child = np.repeat(np.searchsorted(cuts, docs - start, "right") - 1, tree.size[docs])
        order = np.lexsort((child, tree.ranks[a:b]))
        rank, child, tf = tree.ranks[a:b][order], child[order], tree.tf[a:b][order]
        runs = np.flatnonzero(np.append(True, (rank[1:] != rank[:-1]) | (child[1:] != child[:-1]))) if len(rank) else np.zeros(0, np.int64)
        self.rank, self.child = rank[runs], child[runs]
        self.tf = np.maximum.reduceat(tf, runs) if len(runs) else tf

    def bounds(self, item):
        """No document below child c can score more than the c-th of these."""
        places, weights = item.among(self.rank)
        child = self.child[places]
        found = np.zeros(len(self.starts), np.int64)
        np.add.at(found, child, weights * parts(self.tf[places], self.m[child]))
        return found


class Tree:
    """Documents (doc_id, m, ranks, tf), sorted by their vectors of ascending ranks; equal ones together."""

    def __init__(self, documents, k):
        same = {}
        for doc_id, m, ranks, tf in documents:
            order = np.argsort(ranks)
            same.setdefault((ranks[order].astype(">i4").tobytes(), tf[order].astype("<i4").tobytes(), m), []).append(doc_id)
        vectors = sorted(same)
        self.ids = [sorted(same[vector])[:k] for vector in vectors]
        self.m = np.array([m for _, _, m in vectors], np.int64)
        self.size = np.array([len(ranks) // 4 for ranks, _, _ in vectors], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.ranks = np.frombuffer(b"".join(ranks for ranks, _, _ in vectors), ">i4").astype(np.int64)
        self.tf = np.frombuffer(b"".join(tf for _, tf, _ in vectors), "<i4").astype(np.int64)
        self.nodes = {}

    def node(self, start, end, depth):
        key = start, end, depth
        if key not in self.nodes:
            self.nodes[key] = Node(self, start, end, depth)
        return self.nodes[key]

    def scored(self, item, docs):
        """Exact scores of documents by place."""
        sizes = self.size[docs]
        ends = np.cumsum(sizes)
        entries = np.arange(ends[-1]) + np.repeat(self.first[docs] - ends + sizes, sizes)
        weights = item.scores(self.ranks[entries])
        owner = np.repeat(np.arange(len(docs)), sizes)
        asked = np.flatnonzero(weights)
        found = np.zeros(len(docs), np.int64)
        np.add.at(found, owner[asked], weights[asked] * parts(self.tf[entries[asked]], self.m[docs[owner[asked]]]))
        return found

    def search(self, item, best):
        """Add the documents of this tree to the item's ``best``; branches that cannot are left out."""
        waiting = [(0, len(self.ids), 0, None)]
        while waiting:
            start, end, depth, bound = waiting.pop()
            if bound is not None and bound < best.least:
                continue
            if end - start <= LEAF:
                self.add(item, np.arange(start, end), best)
                continue
            node = self.node(start, end, depth)
            bounds = node.bounds(item)
            for c in np.argsort(bounds, kind="stable")[np.sort(bounds).searchsorted(max(best.least, 1)):].tolist():
                if node.ended[c]:
                    self.add(item, np.arange(node.starts[c], node.ends[c]), best)
                else:
                    waiting.append((int(node.starts[c]), int(node.ends[c]), node.depth, int(bounds[c])))

    def add(self, item, docs, best):
        scores = self.scored(item, docs)
        for place in np.flatnonzero(scores >= max(best.least, 1)).tolist():
            for doc_id in self.ids[docs[place]]:
                best.add(int(scores[place]), doc_id)


class Best:
    """The k best (score, doc_id) so far; ``least`` is what another has to reach to be one of them."""

    def __init__(self, k):
        self.k, self.rows, self.least = k, [], NOTHING

    def add(self, score, doc_id):
        self.rows.append((-score, doc_id))
        if len(self.rows) >= 2 * self.k:
            self.cut()

    def cut(self):
        self.rows = sorted(self.rows)[:self.k]
        if len(self.rows) == self.k:
            self.least = -self.rows[-1][0]
        return self.rows


def searched(rows, items, ranks, documents, terms_in_all, k):
    """(item, doc_id, score): the k best of each task for every item of a list of ``Item``."""
    told = rows.sparkSession.sparkContext.broadcast((items, ranks))

    def search(batches):
        import pyarrow as pa

        asked, rank_of = told.value
        found = [Best(k) for _ in asked]

        def plant(gathered):
            tree = Tree(gathered, k)
            for item, best in zip(asked, found):
                tree.search(item, best)
                best.cut()

        gathered, cells = [], 0
        for batch in batches:
            for doc_id, n, terms, tfs in zip(*[column.to_pylist() for column in batch.columns]):
                ranks_here = rank_of[np.frombuffer(terms, "<i4")]
                gathered.append((doc_id, 75 + 25 * n * documents // terms_in_all, ranks_here, np.frombuffer(tfs, "<i4")))
                cells += len(ranks_here) + DOCUMENT
                if cells > CELLS:
                    plant(gathered)
                    gathered, cells = [], 0
        if gathered:
            plant(gathered)
        made = [(i, doc_id, -score) for i, best in enumerate(found) for score, doc_id in best.cut()]
        columns = list(zip(*made)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    wanted = rows.where("doc_id is not null and octet_length(terms) > 0").select("doc_id", "n", "terms", "tfs")
    return wanted.mapInArrow(search, "item long, doc_id long, score long")


def ranked(docs, items, k=20, block_bytes=BLOCK_BYTES):
    """Each item's k best documents with a score above 0: item_id, rank from 1, doc_id, score."""
    spark = docs.sparkSession
    asked, blocks = in_blocks(stored(asked_terms(items), "asked-terms"), block_bytes)
    found = []
    for block in range(blocks):
        mine = asked.where(F.col("block") == block).select(F.col("item_id").cast("string").alias("item_id"), "term", "times").toPandas()
        if not len(mine):
            continue
        terms, numbers = np.unique(mine["term"].to_numpy(), return_inverse=True)
        rows = stored(vectors(docs, terms.tolist()), "term-vectors")
        documents, in_all, df = frequencies(rows, len(terms))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)
        ranks = np.empty(len(terms), np.int64)
        ranks[np.lexsort((terms, df))] = np.arange(len(terms))
        item_ids, of_item = np.unique(mine["item_id"].fillna("").to_numpy(object), return_inverse=True)
        order = np.argsort(of_item, kind="stable")
        cuts = np.flatnonzero(np.diff(of_item[order])) + 1
        times = mine["times"].to_numpy()
        made = [Item(ranks[numbers[rows_of]], weights[numbers[rows_of]] * times[rows_of]) for rows_of in np.split(order, cuts)]
        ids = spark.createDataFrame([(i, int(item_id) if item_id else None) for i, item_id in enumerate(item_ids)], "item long, item_id long")
        hits = searched(rows, made, ranks, documents, in_all, k) if documents else spark.createDataFrame([], "item long, doc_id long, score long")
        best = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        top = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.append(stored(top.join(ids, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
    result = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in found:
        result = result.unionAll(part)
    return result
