"""Toxic spans by a linear-chain conditional random field over words.

Documents are labelled, not words, so word labels are derived first: a lexicon
holds the words and word beginnings that stand in toxic documents far more often
than in others, and such words are labelled toxic in toxic documents. A chain of
two states (clean, toxic) is trained on these sequences. Its features are the
level of a word in the lexicon and the pair of neighbouring states.

Words outside the lexicon all have the same weights, so a run of them is one
power of a fixed matrix, and forward-backward visits the lexicon's words alone;
its marginals are those of the whole sequence. A document's score is a logistic
regression on the log-odds that any word is toxic, the expected number of toxic
words, and the length. Labels come only from rows with ``is_held_out`` false;
ids, languages, sources and labels are never inputs of a score.

The fit uses at most ``FIT_DOCUMENTS`` labelled documents, half of them for each
label (a rare label leaves its places to the other one), taken in the order of a hash of their ids, and a lexicon of at most
``LEXICON`` entries; the labels are weighted back to their shares among all
labelled documents. Only labels of documents that exist are looked at.

Cases: a null text counts as empty and scores like any text without words; a
null id is never held out and never labelled; several labels of an id count as
their maximum, null labels are ignored; of several texts of an id the fit uses
one; a text costs time by its length and memory by its words; without labels of both kinds every score
is 0; repeated rows score alike; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import columns, documents, stored

FIT_DOCUMENTS = 20_000
SEQUENCES = 3_000
LEXICON = 20_000
FOLDS = 5
PREFIXES = (4, 5, 6)
# evidence for a lexicon entry: toxic documents with it, standard errors, ratio of the rates
LEAST, ERRORS, RATIO = 4, 4.5, 4.0
LEVELS = 4
# entries a task counts before it hands them on
HELD = 300_000

_WORD = re.compile(r"\w+")


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def entries(word: str) -> list[str]:
    """What the lexicon can know of a word: itself and its beginnings."""
    return [word + "$", *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


@dataclass
class Chain:
    """Weights: the toxic state's for each level, and those of pairs that hold a toxic state."""

    lexicon: dict[str, int]
    level: list[float] = field(default_factory=lambda: [-4.0, *([2.0] * LEVELS)])
    enter: float = -2.0
    leave: float = 0.0
    stay: float = 0.0
    doc: list[float] = field(default_factory=lambda: [-3.0, 1.0, 1.0, 0.0])
    known: dict[str, int] = field(default_factory=dict, repr=False)
    powers: dict[int, tuple] = field(default_factory=dict, repr=False)

    def level_of(self, word: str) -> int:
        """0 outside of the lexicon; kept for words seen before."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > HELD:
                self.known.clear()
            found = self.known[word] = max(self.lexicon.get(e, 0) for e in entries(word.lower()))
        return found

    def evidence(self, text: str) -> tuple[list[tuple[int, int]], int]:
        """(place, level) of the lexicon's words, and the number of words."""
        words = _WORD.findall(text)
        known, places = self.known, []
        for place, word in enumerate(words):
            level = known.get(word)
            if level is None:
                level = self.level_of(word)
            if level:
                places.append((place, level))
        return places, len(words)

    def gap(self, n: int) -> tuple[float, float, float, float]:
        """The matrix of n words outside of the lexicon."""
        found = self.powers.get(n)
        if found is None:
            w = math.exp(self.level[0])
            step = np.array([[1.0, math.exp(self.enter) * w], [math.exp(self.leave), math.exp(self.stay) * w]])
            if len(self.powers) > 10_000:
                self.powers.clear()
            power = np.linalg.matrix_power(step, n)
            found = self.powers[n] = tuple(power.reshape(-1).tolist())
        return found

    def marginals(self, places: list[tuple[int, int]], n: int) -> tuple[float, list[float]]:
        """Log-odds of any toxic word (from the lexicon's words on) and each one's marginal."""
        enter, leave, stay = math.exp(self.enter), math.exp(self.leave), math.exp(self.stay)
        forward, scales, a, b, last = [], [], 1.0, 0.0, -1
        for place, level in places:
            p, q, r, s = self.gap(place - last - 1)
            a, b = a * p + b * r, a * q + b * s
            w = math.exp(self.level[level])
            a, b = a + b * leave, (a * enter + b * stay) * w
            scale = a + b
            a, b, last = a / scale, b / scale, place
            forward.append((a, b))
            scales.append(math.log(scale))
        p, q, r, s = self.gap(n - last - 1)
        total = sum(scales) + math.log(a * (p + q) + b * (r + s))
        y, z = p + q, r + s
        found = []
        for i in range(len(places) - 1, -1, -1):
            a, b = forward[i]
            found.append(b * z / (a * y + b * z))
            w = math.exp(self.level[places[i][1]])
            y, z = y + enter * w * z, leave * y + stay * w * z
            before = places[i - 1][0] if i else -1
            p, q, r, s = self.gap(places[i][0] - before - 1)
            y, z = p * y + q * z, r * y + s * z
            scale = y + z
            y, z = y / scale, z / scale
        # the path without a toxic word has the weight 1
        return math.log(max(math.expm1(max(total, 0.0)) if total < 700 else math.exp(700), 1e-9)), found[::-1]

    def inputs(self, text: str) -> tuple[list[float], list[tuple[int, int]], list[float]]:
        places, n = self.evidence(text)
        odds, found = self.marginals(places, n)
        none = self.marginals([], n)[0]
        return [1.0, min(odds - none, 50.0), math.log1p(sum(found)), math.log1p(n)], places, found

    def score(self, text: str) -> float:
        x = sum(w * v for w, v in zip(self.doc, self.inputs(text)[0], strict=True))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, x))))

    def spans(self, text: str) -> list[tuple[int, int, float]]:
        """Offending code points: start, end and marginal of words that are rather toxic than not."""
        _, places, found = self.inputs(text)
        toxic = {place: p for (place, _), p in zip(places, found, strict=True) if p >= 0.5}
        words = _WORD.finditer(text) if toxic else ()
        return [(m.start(), m.end(), toxic[i]) for i, m in enumerate(words) if i in toxic]


def _of_each_label(rows: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """At most ``limit`` rows, the first ones in ``order``: half for each label, and what one leaves free for the other."""
    half = limit // 2
    taken = {r.toxic: min(half, r.n) for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = (
        rows.filter(F.col("toxic") == k).orderBy(*order).limit(limit - taken.get(1 - k, 0)) for k in (0, 1)
    )
    return clean.unionByName(toxic)


def labelled_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of every document of ``docs`` with a label that is not held out, once for each id."""
    labels = columns(labels, (("doc_id", "bigint"), ("toxic", "int")))
    labels = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    labels = labels.filter(~is_held_out(F.col("doc_id")))
    labels = labels.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    return labels.join(documents(docs).select("doc_id"), "doc_id", "left_semi")


def labelled_documents(docs: DataFrame, marked: DataFrame, limit: int = FIT_DOCUMENTS) -> DataFrame:
    """(doc_id, text, toxic) of the bounded sample of ``marked``, in hash order for each label; one text for each id."""
    chosen = _of_each_label(marked, limit, [F.xxhash64("doc_id"), F.col("doc_id")])
    # at most ``limit`` rows of two numbers
    found = documents(docs).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("toxic").alias("toxic"))


def lexicon_of(labelled: DataFrame) -> dict[str, int]:
    """Levels of the words and word beginnings that toxic documents have too often."""

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = (Counter(), Counter())

        def handed_on():
            found = [(e, int(label), n) for label in (0, 1) for e, n in counts[label].items()]
            counts[0].clear()
            counts[1].clear()
            return pd.DataFrame(found, columns=["entry", "toxic", "n"])

        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                words = set(_WORD.findall((text or "").lower()))
                counts[label].update({e for w in words for e in entries(w)})
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield handed_on()
        yield handed_on()

    counted = labelled.select("text", "toxic").mapInPandas(tally, "entry string, toxic int, n bigint")
    clean, toxic = F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)), F.sum(F.col("n") * F.col("toxic"))
    counted = counted.groupBy("entry").agg(clean.alias("clean"), toxic.alias("bad"))
    n_clean, n_toxic = labelled.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") == 1)).first()
    if not n_clean or not n_toxic:
        return {}
    ratio = ((F.col("bad") + 0.5) / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    expected = (F.col("bad") + F.col("clean")) * (n_toxic / (n_toxic + n_clean))
    errors = (F.col("bad") - expected) / F.sqrt(expected)
    kept = counted.select("entry", "bad", ratio.alias("ratio"), errors.alias("errors"))
    kept = kept.filter((F.col("bad") >= LEAST) & (F.col("errors") >= ERRORS) & (F.col("ratio") >= RATIO))
    rows = kept.orderBy(F.desc("errors"), "entry").limit(LEXICON).collect()
    return {r.entry: min(LEVELS, max(1, int(math.log(r.ratio / RATIO, 3)) + 1)) for r in rows}


def _log_likelihood(values: np.ndarray, chain: Chain, sequences) -> float:
    """Of the derived word labels: every lexicon word of a toxic document is toxic, no other word."""
    chain.level = values[: LEVELS + 1].tolist()
    chain.enter, chain.leave, chain.stay = values[LEVELS + 1 :].tolist()
    chain.powers.clear()
    total = 0.0
    for (places, n, toxic), weight in sequences.items():
        gold, last, before = 0.0, -1, False
        for place, level in places if toxic else ():
            near = before and place == last + 1
            gold += chain.level[level] + (chain.stay if near else chain.enter + (chain.leave if before else 0.0))
            last, before = place, True
        if before and last < n - 1:
            gold += chain.leave
        a, b, at = 1.0, 0.0, -1
        scale_sum = 0.0
        enter, leave, stay = math.exp(chain.enter), math.exp(chain.leave), math.exp(chain.stay)
        for place, level in places:
            p, q, r, s = chain.gap(place - at - 1)
            a, b = a * p + b * r, a * q + b * s
            w = math.exp(chain.level[level])
            a, b = a + b * leave, (a * enter + b * stay) * w
            scale_sum += math.log(a + b)
            a, b, at = a / (a + b), b / (a + b), place
        p, q, r, s = chain.gap(n - at - 1)
        total += weight * (gold - scale_sum - math.log(a * (p + q) + b * (r + s)))
    return total / sum(sequences.values()) - 0.002 * float(values @ values)


def _climb(chain: Chain, sequences, steps: int = 25) -> None:
    """Ascent along each weight in turn with a step that grows on success and halves on failure."""
    values = np.array([*chain.level, chain.enter, chain.leave, chain.stay])
    stride = np.full(len(values), 0.8)
    best = _log_likelihood(values, chain, sequences)
    for _ in range(steps):
        for i in range(len(values)):
            for sign in (1, -1):
                tried = values.copy()
                tried[i] = min(8.0, max(-12.0, tried[i] + sign * stride[i]))
                found = _log_likelihood(tried, chain, sequences)
                if found > best:
                    values, best = tried, found
                    stride[i] *= sign * 1.3
                    break
            else:
                stride[i] /= 2
        if np.abs(stride).max() < 0.02:
            break
    _log_likelihood(values, chain, sequences)


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> list[float]:
    """Weights of a ridge-penalised logistic regression by Newton's method; a row counts as often as ``counts`` says."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x, w = x / scale, np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (counts * p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (counts * (y - p)) - 0.05 * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return (w / scale).tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Chain | None:
    """The chain trained on a bounded sample of labelled documents; None without both labels."""
    marked = stored(labelled_ids(docs, labels), "labelled")
    totals = {r.toxic: r.n for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if set(totals) != {0, 1}:
        return None
    labelled = labelled_documents(docs, marked).persist()
    try:
        lexicon = lexicon_of(labelled)
        shared = Chain(lexicon)

        def sequences(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = [shared.evidence(t or "") for t in batch["text"]]
                yield pd.DataFrame(
                    {
                        "id": batch["doc_id"],
                        "toxic": batch["toxic"],
                        "places": [[p for p, _ in f[0]] for f in found],
                        "levels": [[v for _, v in f[0]] for f in found],
                        "n": [f[1] for f in found],
                    }
                )

        schema = "id bigint, toxic int, places array<int>, levels array<int>, n int"
        found = labelled.mapInPandas(sequences, schema)
        rows = _of_each_label(found, SEQUENCES, [F.xxhash64("id", F.lit(1)), F.col("id")]).collect()
    finally:
        labelled.unpersist()
    chain = Chain(lexicon)
    known = [(tuple(zip(r.places, r.levels, strict=True)), r.n, r.toxic) for r in rows]
    # labels count in the proportion that they have among all labelled documents
    taken = Counter(t for *_, t in known)
    rate = {t: totals[t] / taken[t] * len(known) / sum(totals.values()) for t in taken}
    _climb(chain, {key: times * rate[key[2]] for key, times in Counter(known).items()})
    chain.known, chain.powers = {}, {}
    x = []
    for places, n, _ in known:
        odds, marginal = chain.marginals(list(places), n)
        x.append([1.0, min(odds - chain.marginals([], n)[0], 50.0), math.log1p(sum(marginal)), math.log1p(n)])
    marks = [t for *_, t in known]
    chain.doc = _logistic(np.array(x), np.array(marks, float), np.array([rate[t] for t in marks]))
    chain.powers = {}
    return chain


def scorer(chain: Chain | None):
    """A column function: text to its score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: chain.score(t or "") if chain else 0.0).astype(float)

    return score


def span_finder(chain: Chain):
    """A column function: text to its offending spans (start, end, marginal)."""

    @F.pandas_udf("array<struct<start: int, end: int, marginal: double>>")
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: [{"start": a, "end": b, "marginal": p} for a, b, p in chain.spans(t or "")])

    return spans


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    score = scorer(fit(docs, labels))
    scored = documents(docs).select("doc_id", score(F.coalesce("text", F.lit(""))).alias("score"))
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not predicted toxic."""
    score = scorer(fit(docs, labels))
    return docs.filter(score(F.coalesce(F.col("text").cast("string"), F.lit(""))) < 0.5)
