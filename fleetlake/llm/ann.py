"""Nearest neighbours by inner product from randomly rotated one-bit codes, reranked within error bounds.

Method. Vectors are partitioned into cells around centres. A vector's difference to its centre is rotated by
a random orthogonal matrix and stored as the signs of the result, packed into bits, with two
correction scalars: the difference's length, and its inner product with its own code. The rotated query is
quantised to no bits at all; bits and scalars give an unbiased estimate of the inner product, and
the scalars a bound on its error that holds with high probability. A block of vectors is estimated for a block of
queries at once. A vector is reranked on its original components, in double precision, if its upper bound reaches the
k-th best exact value among the most promising ones of its block; no other rerank is cut.

Index. Centres are fitted on at most ``SAMPLE`` vectors, the smallest by a hash of the id; every vector is
indexed. How many cells a query probes is calibrated on ``PROBED`` sample queries: the fewest that hold at
least ``RECALL`` of their true neighbours in the sample. Tests measure the recall against brute force.

Scale. Equal vectors are one entry with their k + 1 smallest ids: no query can return more of them, so a
vector that a third of all rows share is no hot cell and nothing is lost. Cells are cut into blocks of at most
about ``BLOCK`` entries and the queries that probe a cell into blocks of ``QUERIES``; a task compares one
block of each. Best lists per block are merged by Spark's limit per group, which runs before
its shuffle.

Every twentieth row is a query and a query probes a share of the cells that the data's own spread sets, so where vectors
lie evenly in all directions, comparisons grow as rows times queries; only their cost is kept low.

Rows: vectors that are null, of another length than most (of equally frequent lengths the smallest), all zero, or with a null or
non-finite component take no part, as do null ids. Of several vectors of one id the smallest in byte order counts. Ties go to the smaller vec_id. An empty table gives an empty result.
Only vec_id and embedding are read.
"""

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.llm.common import sorted_groups, stored

SAMPLE, PROBED, RECALL = 20_000, 200, 0.985
BLOCK, QUERIES = 4096, 1024
#: Standard deviations that an upper bound lies above its estimate.
ERRORS = 3.0
SEED = 7
#: A block is reranked by a matrix product if more than one pair in this many has to be.
DENSE = 30


def rotation(size):
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED)).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def inner(vectors, query):
    """Inner products in double precision; the order of additions is the same for every row."""
    return (vectors * query).sum(axis=1)


def fit_centres(sample, count, rounds=12):
    """Centres by Lloyd's rounds from evenly spaced sample vectors."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(rounds):
        owner = (sample @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, sample)
        n = np.bincount(owner, minlength=count)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Index:
    """Centres, rotation and the number of probed cells; its size is bounded by the sample's."""

    def __init__(self, sample, k):
        self.size = sample.shape[1]
        self.centres = fit_centres(sample, max(1, int(len(sample) ** 0.5) // 2))
        self.turn = rotation(self.size)
        self.probes = self._calibrated(sample, k)

    def cells(self, vectors):
        return (vectors @ self.centres.T - (self.centres**2).sum(axis=1) / 2).argmax(axis=1)

    def ranked_cells(self, query):
        """All cells, the likeliest first, for an inner product."""
        return np.argsort(-inner(self.centres, query), kind="stable")

    def _calibrated(self, sample, k):
        own = self.cells(sample)
        needed = []
        for at in np.linspace(0, len(sample) - 1, min(PROBED, len(sample))).astype(int):
            near = inner(sample, sample[at])
            near[at] = -np.inf
            best = np.argsort(-near, kind="stable")[:min(k, len(sample) - 1)]
            place = np.empty(len(self.centres), np.int64)
            place[self.ranked_cells(sample[at])] = np.arange(len(self.centres))
            needed += (place[own[best]] + 1).tolist()
        return int(np.quantile(needed, RECALL, method="higher")) if needed else 1

    def encode(self, vectors, cells):
        """Packed signs, the lengths of the differences, and each difference's inner product with its code."""
        apart = vectors - self.centres[cells]
        length = np.sqrt((apart**2).sum(axis=1))
        unit = (apart / np.where(length > 0, length, 1)[:, None]) @ self.turn
        signs = unit > 0
        own = (unit * np.where(signs, 1, -1)).sum(axis=1) / np.sqrt(self.size)
        return np.packbits(signs, axis=1), length, np.where(length > 0, own, 1)

    def signs(self, codes):
        """The codes' bits as 1 and -1."""
        return np.unpackbits(codes, axis=1, count=self.size).astype(np.float32) * 2 - 1

    def bounds(self, signs, length, own, queries, centre):
        """Upper bounds of the inner products of encoded vectors of one cell (rows) with queries (columns)."""
        turned = (queries @ self.turn).astype(np.float32)
        estimate = (signs @ turned.T) / (np.sqrt(self.size) * own).astype(np.float32)[:, None]
        spread = ERRORS * np.sqrt(np.maximum(0, 1 - own**2)) / own / np.sqrt(max(1, self.size - 1))
        error = spread.astype(np.float32)[:, None] * np.linalg.norm(queries, axis=1).astype(np.float32)
        return (queries @ centre).astype(np.float32) + length.astype(np.float32)[:, None] * (estimate + error)


def usable(embeddings):
    """(vec_id, vector) of the rows that take part."""
    vector = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    some = F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & some)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    usual = sizes["size"] if sizes else 0
    return rows.where(F.size("vector") == usual), usual


def packed_vector(rows):
    """Doubles as bytes; -0.0 is 0.0, so equal vectors have equal bytes."""
    def run(batches):
        import pandas as pd

        for batch in batches:
            made = [(np.asarray(v, "<f8") + 0.0).tobytes() for v in batch["vector"]]
            yield pd.DataFrame({"vec_id": batch["vec_id"], "vector": pd.Series(made, dtype=object)})

    return rows.mapInPandas(run, "vec_id long, vector binary")


def nearest(embeddings, queries, k=20):
    """The k nearest other vectors of each query: query_id, rank, vec_id, score.

    ``queries`` is a column expression over vec_id that tells the queries.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = embeddings.sparkSession
    rows, size = usable(embeddings)
    if not size:
        return spark.createDataFrame([], schema)
    rows = stored(packed_vector(rows).groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    few = W.partitionBy("vector").orderBy("vec_id")
    ids = rows.withColumn("place", F.row_number().over(few)).where(F.col("place") <= k + 1)
    entries = stored(ids.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    # At most SAMPLE vectors reach the driver.
    sample = entries.orderBy(F.xxhash64("vector"), "vector").limit(SAMPLE).select("vector").toPandas()
    told = spark.sparkContext.broadcast(Index(np.stack([np.frombuffer(v, "<f8") for v in sample["vector"]]), k))

    def assign(batches):
        import pandas as pd

        for batch in batches:
            vectors = np.stack([np.frombuffer(v, "<f8") for v in batch["vector"]]) if len(batch) else np.empty((0, size))
            cells = told.value.cells(vectors)
            codes, length, own = told.value.encode(vectors, cells)
            yield pd.DataFrame({
                "cell": cells, "vector": batch["vector"], "ids": batch["ids"], "code": [c.tobytes() for c in codes], "length": length, "own": own,
            })

    def probe(batches):
        import pandas as pd

        for batch in batches:
            cells = [told.value.ranked_cells(np.frombuffer(v, "<f8"))[:told.value.probes] for v in batch["vector"]]
            yield pd.DataFrame({"query_id": batch["vec_id"], "query": batch["vector"], "cells": cells})

    coded = stored(entries.mapInPandas(assign, "cell int, vector binary, ids array<long>, code binary, length double, own double"), "codes")
    asked = rows.where(queries).mapInPandas(probe, "query_id long, query binary, cells array<int>")
    asked = stored(asked.select("query_id", "query", F.explode("cells").alias("cell")), "probes")
    blocks = coded.groupBy("cell").agg(F.ceil(F.count("length") / BLOCK).alias("blocks"))
    groups = asked.groupBy("cell").agg(F.ceil(F.count("query_id") / QUERIES).alias("groups"))
    plan = blocks.join(groups, "cell")
    left = coded.join(plan, "cell").withColumn("block", F.pmod(F.xxhash64("vector"), F.col("blocks")))
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    right = asked.join(plan, "cell").withColumn("group", F.pmod(F.xxhash64("query_id"), F.col("groups")))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    key = F.xxhash64("cell", "block", "group").alias("key")
    none = lambda kind: F.lit(None).cast(kind)
    left = left.select(key, "cell", "vector", "ids", "code", "length", "own", none("long").alias("query_id"))
    right = right.select(
        key, "cell", F.col("query").alias("vector"), none("array<long>").alias("ids"), none("binary").alias("code"),
        none("double").alias("length"), none("double").alias("own"), "query_id",
    )

    def compare(batches):
        import pandas as pd

        found = told.value
        out = []
        for _, group in sorted_groups(batches, "key"):
            asks = group[group["query_id"].notna()]
            held = group[group["query_id"].isna()]
            if not len(asks) or not len(held):
                continue
            centre = found.centres[int(group["cell"].iloc[0])]
            vectors = np.stack([np.frombuffer(v, "<f8") for v in held["vector"]])
            signs = found.signs(np.stack([np.frombuffer(c, np.uint8) for c in held["code"]]))
            length, own = held["length"].to_numpy(float), held["own"].to_numpy(float)
            query_ids = asks["query_id"].astype("int64").tolist()
            wanted = np.stack([np.frombuffer(v, "<f8") for v in asks["vector"]])
            for start in range(0, len(wanted), QUERIES):
                some = slice(start, start + QUERIES)
                upper = found.bounds(signs, length, own, wanted[some], centre)
                out += best_of(upper, vectors, held["ids"].tolist(), wanted[some], query_ids[some], k)
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])
                out = []
        yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    near = left.union(right).repartition(n, "key").sortWithinPartitions("key").mapInPandas(compare, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def pair_products(vectors, queries, rows, columns):
    """Inner products of pairs of rows, some at a time."""
    found = np.empty(len(rows))
    for start in range(0, len(rows), 50_000):
        part = slice(start, start + 50_000)
        found[part] = inner(vectors[rows[part]], queries[columns[part]])
    return found


def best_of(upper, vectors, ids, queries, query_ids, k):
    """The k best (query, id, score) of a block for each query.

    The exact products of those with the highest upper bounds set what a query's k-th best is at least; every
    vector whose bound reaches that is reranked.
    """
    n, m = upper.shape
    holder = {i: row for row, each in enumerate(ids) for i in each}
    alone = {c: holder[q] for c, q in enumerate(query_ids) if q in holder and len(ids[holder[q]]) == 1}
    least = np.full(m, -np.inf)
    if n > k:
        top = np.argpartition(-np.ascontiguousarray(upper.T), k, axis=1)[:, :k + 1].T
        columns = np.tile(np.arange(m), (k + 1, 1))
        exact = pair_products(vectors, queries, top.ravel(), columns.ravel()).reshape(top.shape)
        for c, row in alone.items():  # a query is no candidate of its own
            exact[top[:, c] == row, c] = -np.inf
        least = np.partition(exact, 1, axis=0)[1]
    reach = upper >= least
    if reach.sum() * DENSE > reach.size:  # many: as one matrix product, the order of whose additions is its own
        near = vectors @ queries.T
        reach &= near >= least - 1e-9 * (1 + np.abs(near).max(initial=0))
    rows, columns = np.nonzero(reach)
    scores = pair_products(vectors, queries, rows, columns)
    good = scores >= least[columns]
    rows, columns, scores = rows[good], columns[good], scores[good]
    order = np.lexsort((-scores, columns))
    rows, columns, scores = rows[order].tolist(), columns[order], scores[order].tolist()
    found, cuts = [], np.searchsorted(columns, np.arange(m + 1)).tolist()
    for c, query_id in enumerate(query_ids):
        best = [(-scores[at], i) for at in range(cuts[c], cuts[c + 1]) for i in ids[rows[at]] if i != query_id]
        found += [(query_id, i, -score) for score, i in sorted(best)[:k]]
    return found
