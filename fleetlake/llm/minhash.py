"""Near-duplicate documents by b-bit MinHash, confirmed on full shingle sets.

Method. A document is the set of its distinct 5-word shingles (64-bit hashes of word hashes).
``PERMUTATIONS`` minima are taken; groups of ``ROWS`` of them are the bands that generate candidates,
and the low ``BITS`` bits of each are packed into the signature. Equal bits of two signatures are
counted with XOR and bit counts; ``similarity`` corrects the count for bits that agree by chance.
A candidate whose estimate is below the threshold by more than five standard errors goes; any other
is confirmed on both full sets.

Linear work on large groups. Equal sets are one representative each, so copies cost a row. Then each
representative is compared with the best of its buckets' smallest members, one pair each, and
components are formed: most of a group of thousands of near copies is one component after that. Only
buckets whose members still lie in different components are looked at again, in pairs of blocks of bounded
size that hold the texts; a task tests pairs across components, the likeliest first, and sends only the links that
join two of them. So every candidate pair is confirmed, refuted, or inside one component already, and no task
sends more links than it has members.

Rows: a null or empty text, or one without words, has an empty set and no link. A null doc_id takes no
part; its component is null and it counts as kept. Rows that repeat a document are one in
every comparison and give a row each. An empty table gives an empty result. Other columns, whatever
their names, are not read.
"""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fleetlake.llm.common import Memo, components, map_batches, sorted_groups, space_words, stored, texts

WIDTH, BANDS, ROWS, BITS = 5, 24, 4, 2
PERMUTATIONS = BANDS * ROWS
#: Members of a bucket that one task compares with as many others at once.
BLOCK = 1024
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_SCALE = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _RANDOM.integers(0, 2**63, PERMUTATIONS, dtype=np.uint64)
_PLACE = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x):
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes():
    return Memo(xxhash.xxh3_64_intdigest)


def shingle_set(words, hashes, width=WIDTH):
    """The sorted distinct hashes of runs of ``width`` words; the whole sequence where there are fewer."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(width, n)
    runs = sum((codes[i:n - size + 1 + i] * _PLACE[i] for i in range(1, size)), codes[:n - size + 1] * _PLACE[0])
    return np.unique(mix(runs + np.uint64(size)))


def minima(shingles):
    """The smallest of each permutation's 32-bit hashes over a set."""
    least = np.full(PERMUTATIONS, 2**32 - 1, np.uint64)
    for start in range(0, len(shingles), 4096):
        hashed = (shingles[start:start + 4096, None] * _SCALE + _SHIFT) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def bands(least):
    """One 64-bit key per band, its number included."""
    groups = least.reshape(BANDS, ROWS)
    return mix((groups * _PLACE[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _PLACE[8])


def packed(least):
    """The low bits of the minima in 64-bit words."""
    low = (least & np.uint64(2**BITS - 1)).reshape(-1, 64 // BITS)
    return (low << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


_LOWEST = int("01" * (64 // BITS), 2)


def similarity(agreeing):
    """Estimated Jaccard similarity from agreeing positions: chance agreement is 2^-BITS of the rest."""
    chance = 2.0**-BITS
    return (agreeing / PERMUTATIONS - chance) / (1 - chance)


def least_agreement(threshold, errors=5.0):
    """Agreeing positions below which a pair is no candidate: ``errors`` standard errors under the threshold."""
    expected = 2.0**-BITS + (1 - 2.0**-BITS) * threshold
    return int(PERMUTATIONS * expected - errors * (PERMUTATIONS * expected * (1 - expected)) ** 0.5)


def sketches(docs):
    """Per document: its set's size and fingerprint, band keys and packed signature."""
    hashes = word_hashes()

    def sketch(columns):
        out = {"doc_id": columns["doc_id"], "n_shingles": [], "fingerprint": [], "bands": [], "signature": []}
        for text in columns["text"]:
            found = shingle_set(space_words(text), hashes)
            out["n_shingles"].append(len(found))
            if not len(found):
                for name in ("fingerprint", "bands", "signature"):
                    out[name].append(None)
                continue
            out["fingerprint"].append(xxhash.xxh3_128_digest(found.tobytes()))
            least = minima(found)
            out["bands"].append(bands(least).view(np.int64))
            out["signature"].append(packed(least).view(np.int64))
        return out

    schema = "doc_id long, n_shingles long, fingerprint binary, bands array<long>, signature array<long>"
    return map_batches(texts(docs), sketch, schema)


def agreement(a, b):
    """Agreeing positions of two packed signatures, as a column."""
    words = PERMUTATIONS * BITS // 64
    differing = []
    for i in range(words):
        x = a[i].bitwiseXOR(b[i])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(a[i].bitwiseXOR(b[i]), shift))
        differing.append(F.bit_count(x.bitwiseAND(F.lit(_LOWEST))))
    return F.lit(PERMUTATIONS) - sum(differing[1:], differing[0])


def confirmed(pairs, bodies, percent):
    """Pairs (a, b) with ``linked``: 100 * intersection >= percent * union, on the full sets of both texts."""
    hashes = word_hashes()

    def judge(columns):
        linked, last = [], (None, None)
        for a, b in zip(columns["text_a"], columns["text_b"]):
            if last[0] != b:
                last = (b, shingle_set(space_words(b), hashes))
            mine = shingle_set(space_words(a), hashes)
            both = len(np.intersect1d(mine, last[1], assume_unique=True))
            linked.append(100 * both >= percent * (len(mine) + len(last[1]) - both))
        return {"a": columns["a"], "b": columns["b"], "linked": linked}

    texts_a = bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    texts_b = bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.hint("merge").join(texts_a, "a").hint("merge").join(texts_b, "b")
    return map_batches(both.select("a", "b", "text_a", "text_b"), judge, "a long, b long, linked boolean")


def across(members, bodies, percent):
    """Links (a, b) between members of a bucket that lie in different components.

    ``members``: (band, place, id, component, signature, bands). A large bucket is cut into blocks by a hash of
    the id, and each pair of blocks is compared by itself, with its texts. A pair is tested in the first
    band it shares, the likeliest first, and only while it joins two components that no earlier link of the task has
    joined: whatever is not tested is below the estimate's bound, tested elsewhere, or connected already.
    """
    cut = least_agreement(percent / 100)
    sizes = members.groupBy("band").agg(F.ceil(F.count("id") / BLOCK).alias("blocks"))
    rows = members.join(sizes, "band").join(bodies.select(F.col("doc_id").alias("id"), "text").hint("merge"), "id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first, second = F.least("block", "other"), F.greatest("block", "other")
    rows = rows.select(
        F.xxhash64("band", first, second).alias("key"), (F.col("block") == first).alias("left"), (F.col("block") == second).alias("right"),
        "place", "id", "component", "signature", "bands", "text",
    )

    def compare(batches):
        import pandas as pd

        hashes, links = word_hashes(), []
        for _, group in sorted_groups(batches, "key"):
            links += joined(group, hashes, cut, percent)
            if len(links) >= 50_000:
                yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")
                links = []
        yield pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    n = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return rows.repartition(int(n), "key").sortWithinPartitions("key").mapInPandas(compare, "a long, b long")


def joined(group, hashes, cut, percent):
    """Links that join components within one pair of blocks."""
    ids, place = group["id"].to_numpy(), int(group["place"].iloc[0])
    codes, keys = np.stack(group["signature"].to_numpy()).view(np.uint64), np.stack(group["bands"].to_numpy())
    texts, mine = group["text"].tolist(), np.flatnonzero(group["left"].to_numpy())
    theirs, parts = np.flatnonzero(group["right"].to_numpy()), group["component"].to_numpy()
    sets, parent = Memo(lambda i: shingle_set(space_words(texts[i]), hashes), 4096), {}

    def root(part):
        while (above := parent.get(part, part)) != part:
            part = above
        return part

    pairs = []
    for i in mine.tolist():
        open_ = theirs[parts[theirs] != parts[i]]
        x = codes[i] ^ codes[open_]
        for shift in range(1, BITS):
            x |= (codes[i] ^ codes[open_]) >> np.uint64(shift)
        agreeing = PERMUTATIONS - np.bitwise_count(x & np.uint64(_LOWEST)).sum(axis=1, dtype=np.int64)
        open_, agreeing = open_[agreeing >= cut], agreeing[agreeing >= cut]
        here = (keys[open_] == keys[i]).argmax(axis=1) == place
        pairs.append(np.stack([agreeing[here], np.full(here.sum(), i), open_[here]], axis=1))
    pairs = np.concatenate(pairs)
    links = []
    for _, i, j in pairs[np.argsort(-pairs[:, 0], kind="stable")].tolist():
        a, b = root(parts[i]), root(parts[j])
        if a == b:
            continue
        n, m = len(sets[i]), len(sets[j])
        if 100 * min(n, m) < percent * max(n, m):
            continue
        both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        if 100 * both >= percent * (n + m - both):
            parent[max(a, b)] = min(a, b)
            links.append((max(ids[i], ids[j]), min(ids[i], ids[j])))
    return links


def classes(docs, percent=85):
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Documents are linked when 100 * |A and B| >= percent * |A or B| for their sets.
    """
    cut = least_agreement(percent / 100)
    sketch = stored(sketches(docs), "sketches")
    usable = sketch.where("n_shingles > 0 and doc_id is not null")
    owners = stored(usable.groupBy("fingerprint").agg(F.min("doc_id").alias("id")), "owners")
    reps = usable.join(owners.select("fingerprint", F.col("id").alias("doc_id")), ["fingerprint", "doc_id"]).dropDuplicates(["doc_id"])
    reps = stored(reps.select(F.col("doc_id").alias("id"), "bands", "signature"), "representatives")
    buckets = reps.select("id", F.posexplode("bands").alias("place", "band"))
    shared = buckets.groupBy("band").agg(F.min("id").alias("centre"), F.count("id").alias("n")).where("n > 1")
    members = stored(buckets.join(shared.select("band", "centre").hint("merge"), "band"), "buckets")
    codes = reps.select("id", "signature")
    star = members.where("id <> centre").select("id", "centre").distinct()
    star = star.join(codes, "id").join(codes.select(F.col("id").alias("centre"), F.col("signature").alias("other")), "centre")
    star = star.withColumn("agreeing", agreement(F.col("signature"), F.col("other"))).where(F.col("agreeing") >= cut)
    pairs = star.groupBy(F.col("id").alias("a")).agg(F.max_by("centre", F.struct("agreeing", -F.col("centre"))).alias("b"))
    wanted = members.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    bodies = texts(docs).join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    bodies = stored(bodies, "bodies")
    judged = stored(confirmed(pairs, bodies, percent), "judged")
    links = judged.where("linked").select("a", "b")
    labels = stored(components(links), "labels")
    placed = members.select("band", "place", "id").join(labels, "id", "left")
    placed = placed.select("band", "place", "id", F.coalesce("component", "id").alias("component"))
    mixed = placed.groupBy("band").agg((F.min("component") < F.max("component")).alias("mixed")).where("mixed")
    open_ = placed.join(mixed.select("band").hint("merge"), "band", "left_semi").join(reps.hint("merge"), "id")
    more = stored(across(open_.select(*placed.columns, "signature", "bands"), bodies, percent), "links")
    if not more.isEmpty():
        labels = stored(components(links.union(more)), "labels")
    whole = sketch.join(owners, "fingerprint", "left").join(labels, "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return whole.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )
