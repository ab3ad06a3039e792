"""URL filter: rules first, then the ratio of two character language models.

Urls that a rule allows train the model of accepted urls, urls that a rule
blocks the model of rejected ones. Each model is a variable-order Markov model:
the probability of a character mixes the orders 0 to ``ORDER``, each with the
weight that the count of its context gives it, and leaves out contexts seen
fewer than ``LEAST`` times. A url's score is the difference of both
log-likelihoods per character. The cut-off is calibrated on a fifth of the ruled
urls that the counts leave out: the score that separates them best.

Counts cover all other ruled urls. They are exact, keyed by order, context and
next character, and stay a table that grows with the input. Urls are scored in
blocks of about ``BLOCK`` bytes of different urls: a block asks once for each
n-gram it holds, joins the counts and scores its urls with the answers, so no
model is ever sent whole to a task or to the driver.

Cases: a null url and one without ``://`` have an empty host and path, fit no
rule and are judged by the method as the text they are (null: the empty text);
repeated rows are judged alike and counted each; without urls of both kinds
there is no model, and what no rule judges is allowed with the score 0; an
empty table gives an empty result; further columns are ignored. A very long url
is judged whole, in its block: it takes some hundred bytes of memory a character.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import Written, ascii_lower, columns

# an n-gram of up to ORDER + 1 bytes and its order make one exact key of 64 bits
ORDER = 5
LEAST = 3
# bytes of different urls that are scored together
BLOCK = 1 << 16
# positions whose keys are held at a time
PIECE = 1 << 17
# pseudo-counts that the next shorter context has beside a context's own counts
PRIOR = 4.0
HELD_OUT = 5
# scores are compared in steps of this size when the cut-off is chosen
STEP = 1 / 256
SPAN = 16.0

Rule = tuple[str, str]  # (verdict, host and path like "example.com/en/")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(found)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits: its host or a subdomain of it, and the start of its path."""
    ordered = sorted((rule for _, rule in rules), key=lambda r: (-len(r), r))
    fits = []
    for rule in ordered:
        name, slash, rest = rule.partition("/")
        own = (host == name) | F.endswith(host, F.lit(f".{name}"))
        fits.append(F.when(own & F.startswith(path, F.lit(slash + rest)), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def positions(urls: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every character (byte) of every url and its end: per order the keys of context and n-gram.

    Yields, for at most PIECE positions at a time, the index of each position's url
    and two arrays (orders x positions). A key holds the order, whether it is an
    n-gram, and the bytes themselves: different ones never share a key.
    """
    coded = [u.encode("utf-8", "surrogatepass") for u in urls]
    lead = bytes([1]) * ORDER
    data = np.frombuffer(b"".join(lead + u + b"\x02" for u in coded), np.uint8)
    lengths = np.array([len(u) + 1 for u in coded], np.int64)
    owners = np.repeat(np.arange(len(coded)), lengths)
    # a url's places in the joined bytes begin behind its own lead
    places = np.arange(len(owners)) + ORDER * (owners + 1)
    for first in range(0, len(owners), PIECE):
        owner, at = owners[first : first + PIECE], places[first : first + PIECE]
        last = data[at].astype(np.int64)
        context = np.zeros(len(at), np.int64)
        contexts, grams = [], []
        for order in range(ORDER + 1):
            if order:
                context = context | (data[at - order].astype(np.int64) << (8 * (order - 1)))
            contexts.append(context | (order << 49))
            grams.append((context << 8) | last | (order << 49) | (1 << 48))
        yield owner, np.array(contexts), np.array(grams)


def count(labelled: DataFrame) -> DataFrame:
    """Per key of ``labelled`` (url, rejected 0 or 1): how often accepted and rejected urls hold it."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weight, rejected = batch["weight"].to_numpy(np.int64), batch["rejected"].to_numpy(np.int64)
            for owner, contexts, grams in positions(batch["url"].tolist()):
                keys, at = np.unique(np.concatenate([contexts, grams]), return_inverse=True)
                found = {"key": keys}
                for label, name in enumerate(("accepted", "rejected")):
                    n = np.where(rejected == label, weight, 0)[owner]
                    # sums of whole numbers, exact up to 2^53 in a piece
                    n = np.bincount(at.ravel(), np.tile(n, 2 * (ORDER + 1)), len(keys))
                    found[name] = n.astype(np.int64)
                yield pd.DataFrame(found)

    # equal urls are counted before they are cut up
    urls = labelled.groupBy("url", "rejected").agg(F.count("*").alias("weight"))
    found = urls.mapInPandas(tally, "key bigint, accepted bigint, rejected bigint")
    return found.groupBy("key").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))


def _found(table: np.ndarray, n: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The count of each key; ``table`` is sorted, keys outside it count nothing."""
    if not len(table):
        return np.zeros(keys.shape, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, n[at], 0)


def log_likelihoods(table: np.ndarray, n: np.ndarray, contexts: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Log-probability of each position under the model with the counts ``n`` of the keys ``table``."""
    p = np.full(contexts.shape[1], 1 / 256)
    for order in range(ORDER + 1):
        seen, found = _found(table, n, contexts[order]), _found(table, n, grams[order])
        p = np.where(seen >= (LEAST if order else 1), (found + PRIOR * p) / (seen + PRIOR), p)
    return np.log(p)


def _block_scores(urls: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """The scores of a block's urls by the counts of all keys that they hold."""
    # one order, so that a second run adds up alike
    texts = urls["url"].sort_values().tolist()
    counts = counts.sort_values("key")
    table, accepted, rejected = (counts[c].to_numpy(np.int64) for c in ("key", "accepted", "rejected"))
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    # the key of the empty context counts all positions of a label
    known = len(table) and table[0] == 0 and accepted[0] and rejected[0]
    for owner, contexts, grams in positions(texts):
        n += np.bincount(owner, minlength=len(texts))
        if known:
            gain = log_likelihoods(table, accepted, contexts, grams) - log_likelihoods(table, rejected, contexts, grams)
            total += np.bincount(owner, gain, minlength=len(texts))
    return pd.DataFrame({"url": texts, "score": total / n})


def scores(urls: DataFrame, counts: DataFrame, tables: Written) -> DataFrame:
    """Per different url of ``urls`` (not null): accepted minus rejected log-likelihood per character; 0 without a model."""
    different = tables.put("different", urls.select("url").distinct())
    size = different.agg(F.sum(F.octet_length("url") + 1)).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = different.withColumn("block", F.pmod(F.xxhash64("url"), F.lit(blocks)))
    dealt = tables.put("dealt", dealt.repartition(parts, "block").sortWithinPartitions("block"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, part in batch.groupby("block"):
                for _, contexts, grams in positions(part["url"].tolist()):
                    keys = np.unique(np.concatenate([contexts, grams]))
                    yield pd.DataFrame({"block": np.full(len(keys), block), "key": keys})

    asked = dealt.mapInPandas(ask, "block bigint, key bigint").distinct()
    answers = asked.join(counts, "key").select("block", "key", "accepted", "rejected")
    met = dealt.groupBy("block").cogroup(answers.groupBy("block"))
    return tables.put("scores", met.applyInPandas(_block_scores, "url string, score double"))


def cut_off(histogram: pd.DataFrame) -> float:
    """The score that separates accepted from rejected urls best; 0 without urls of both kinds."""
    table = histogram.pivot_table(index="bin", columns="rejected", values="n", aggfunc="sum").fillna(0)
    if set(table.columns) != {0, 1}:
        return 0.0
    table = table.sort_index()
    accepted_below = table[0].cumsum() / table[0].sum()
    rejected_below = table[1].cumsum() / table[1].sum()
    gain = (rejected_below - accepted_below).to_numpy()
    # the middle between each bin's upper end and the next bin's lower end
    lower = (table.index.to_numpy() + 1) * STEP
    upper = np.append(table.index.to_numpy()[1:] * STEP, lower[-1])
    middle = (lower + upper) / 2
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    # of equally good ones the one nearest to 0
    return float(middle[best[np.argmin(np.abs(middle[best]))]])


def judge(pages: DataFrame, rules: Sequence[Rule], id_column: str = "page_id") -> DataFrame:
    """Per url: host, path, rule, verdict, score and the cut-off of the scores."""
    spark = pages.sparkSession
    pages = columns(pages, ((id_column, "bigint"), ("url", "string")))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = pages.select(id_column, "url", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    rejected = F.col("rule").isin(blocked).cast("int")
    labelled = ruled.filter(F.col("rule").isNotNull()).select("url", rejected.alias("rejected"))
    held_out = F.crc32(F.col("url").cast("binary")) % HELD_OUT == 0

    tables = Written(spark)
    counts = tables.put("counts", count(labelled.filter(~held_out)))
    text = F.coalesce("url", F.lit(""))
    scored = scores(split.select(text.alias("url")), counts, tables)
    tables.drop("different", "dealt", "counts")

    bounded = F.least(F.greatest(F.col("score"), F.lit(-SPAN)), F.lit(SPAN))
    calibration = labelled.filter(held_out).groupBy("url", "rejected").agg(F.count("*").alias("n"))
    calibration = calibration.join(scored, "url").select("rejected", "n", F.floor(bounded / STEP).alias("bin"))
    # one row for each step of the bounded score at most
    limit = cut_off(calibration.groupBy("rejected", "bin").agg(F.sum("n").alias("n")).toPandas())

    scored = scored.withColumnRenamed("url", "__url")
    judged = ruled.join(scored, text == F.col("__url"))
    by_rule = F.when(F.col("rule").isin(blocked), "block").otherwise("allow")
    by_score = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return judged.select(
        id_column,
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_score).alias("verdict"),
        "score",
        F.lit(limit).alias("cut_off"),
    )
