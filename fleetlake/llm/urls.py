"""URL verdicts by rules, and where no rule fits by the ratio of two character language models.

Method. A rule is a host and a path prefix; it fits its host and all subdomains, and the longest rule that
fits decides. URLs that rules accept or reject train one model each over host and path: Markov models of
variable order up to ``ORDER``, each order smoothed with the next lower by Witten-Bell weights, the lowest
with a uniform one. A URL's score is the log-likelihood difference per symbol. Where the models part best is
calibrated on a quarter of the ruled URLs, by a hash of the URL, that the counts have not seen: the bin of
``BINS`` at which the mean of both error rates is least.

Scale. Counts of all n-grams come from one grouping that combines before its shuffle; lower orders are
summed from the highest. URLs are cut into n-grams that are joined with the table of their log ratios,
both sides shuffled, and summed per distinct URL. Only the bins reach the driver.

Rows: a null url, or one without "://", has an empty host and path, no rule and the score 0; an empty
host and path likewise. Repeated rows are judged each. Rules of equal length that both fit cannot differ (they
are the same text). Without URLs of both kinds every score is 0. An empty table gives an empty result.
Only page_id and url are read.
"""

import string

from pyspark.sql import functions as F

from fleetlake.llm.common import stored

ORDER, ALPHABET, BINS = 4, 256, 2000
_BEGIN, _STOP = "\x02", "\x03"


def parsed(url):
    """(host, path) of a URL, empty where it has none."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    host = F.translate(host, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def ruled(host, path, rules):
    """(rule, verdict) of the longest rule that fits, both null if none; ``rules`` holds (host, path, verdict)."""
    rule = verdict = None
    for rule_host, rule_path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        text = F.lit(rule_host + rule_path)
        rule, verdict = (F.when(fits, text), F.when(fits, F.lit(says))) if rule is None else (rule.when(fits, text), verdict.when(fits, F.lit(says)))
    return (F.lit(None).cast("string"),) * 2 if rule is None else (rule, verdict)


def grams(text):
    """The runs of ORDER + 1 symbols of a text between begin marks and a stop mark, one per symbol."""
    symbols = F.concat(F.array(*[F.lit(_BEGIN)] * ORDER), F.split(text, ""), F.array(F.lit(_STOP)))
    return F.transform(
        F.sequence(F.lit(ORDER), F.size(symbols) - 1),
        lambda i: F.concat(*[F.get(symbols, (i - ORDER + k).cast("int")) for k in range(ORDER + 1)]),
    )


def log_ratios(counts, wanted):
    """(gram, ratio): log of accepted over rejected probability of each wanted gram's last symbol.

    ``counts``: (gram, accepted, rejected) of the highest order.
    """
    table = wanted.withColumns({"pa": F.lit(1 / ALPHABET), "pr": F.lit(1 / ALPHABET)})
    for order in range(ORDER + 1):
        key = F.substring("gram", ORDER + 1 - order, order + 1)
        context = F.substring("gram", ORDER + 1 - order, order)
        seen = counts.groupBy(key.alias("key"), context.alias("context")).agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
        around = seen.groupBy("context").agg(
            F.sum("a").alias("all_a"), F.sum("r").alias("all_r"), F.count_if(F.col("a") > 0).alias("kinds_a"), F.count_if(F.col("r") > 0).alias("kinds_r")
        )
        table = table.withColumns({"key": key, "context": context})
        table = table.join(seen.select("key", "a", "r"), "key", "left").join(around, "context", "left").fillna(
            0, ["a", "r", "all_a", "all_r", "kinds_a", "kinds_r"]
        )
        smooth = lambda n, kinds, whole, lower: F.when(whole + kinds > 0, (n + kinds * lower) / (whole + kinds)).otherwise(lower)
        table = table.select(
            "gram", smooth(F.col("a"), F.col("kinds_a"), F.col("all_a"), F.col("pa")).alias("pa"),
            smooth(F.col("r"), F.col("kinds_r"), F.col("all_r"), F.col("pr")).alias("pr"),
        )
    return table.select("gram", F.log(F.col("pa") / F.col("pr")).alias("ratio"))


def scores(texts):
    """(id, verdict, n, held, score) of each distinct text; ``texts`` has text, verdict (null if none) and n."""
    ids = stored(texts.select(F.md5(F.col("text").cast("binary")).alias("id"), "text", "verdict", "n"), "urls")
    held = F.pmod(F.xxhash64("id"), F.lit(4)) == 0
    cut = stored(ids.where("text <> ''").select("id", "verdict", "n", held.alias("held"), F.explode(grams(F.col("text"))).alias("gram")), "url-grams")
    learnt = cut.where("verdict is not null and not held")
    counts = stored(learnt.groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("accepted"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("rejected"),
    ), "url-counts")
    whole = counts.agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).first()
    if not whole["a"] or not whole["r"]:
        return ids.select("id", "verdict", "n", held.alias("held"), F.lit(0.0).alias("score"))
    ratios = stored(log_ratios(counts, cut.select("gram").distinct()), "url-ratios")
    summed = cut.join(ratios, "gram").groupBy("id").agg((F.sum("ratio") / F.count("ratio")).alias("score"))
    return ids.select("id", "verdict", "n", held.alias("held")).join(summed, "id", "left").fillna(0.0, ["score"])


def calibrated(found):
    """The score from which a URL is accepted, in the middle between two bins."""
    known = found.where("held and verdict is not null")
    spread = known.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    if spread["low"] is None or spread["low"] == spread["high"]:
        return 0.0
    low, step = spread["low"], (spread["high"] - spread["low"]) / BINS
    bins = known.groupBy(F.least(F.floor((F.col("score") - low) / step), F.lit(BINS - 1)).cast("int").alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("r"),
    ).collect()  # at most BINS rows
    accepted, rejected = {row["bin"]: row["a"] for row in bins}, {row["bin"]: row["r"] for row in bins}
    all_a, all_r = max(1, sum(accepted.values())), max(1, sum(rejected.values()))
    below_a, below_r, best = 0, 0, {}
    for edge in range(BINS + 1):
        best.setdefault(below_a / all_a + (all_r - below_r) / all_r, []).append(edge)
        below_a, below_r = below_a + accepted.get(edge, 0), below_r + rejected.get(edge, 0)
    edges = best[min(best)]
    return low + step * (edges[0] + edges[-1]) / 2


def verdicts(pages, rules):
    """One row per page: page_id, host, path, rule, verdict, and the method's score."""
    host, path = parsed(F.col("url"))
    rows = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict, "text": F.concat("host", "path")})
    texts = rows.groupBy("text").agg(F.first("verdict").alias("verdict"), F.count("host").alias("n"))
    found = stored(scores(texts), "url-scores")
    edge = calibrated(found)
    rows = rows.withColumn("id", F.md5(F.col("text").cast("binary"))).join(found.select("id", "score"), "id", "left")
    method = F.when(F.col("score") >= edge, F.lit("allow")).otherwise(F.lit("block"))
    return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "score")
