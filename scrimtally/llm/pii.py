"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns (``base_spans``) find e-mail addresses, IP addresses, card and
phone numbers, leftmost and without overlap for each kind; matches that fail
their check are dropped. Where numbers stand side by side a pattern runs over
several of them and drops them all. The field works on such runs: a run's groups
of digits are its tokens, a segment is up to ``MOST`` successive groups, and
features of the whole segment (digits, separators, checksum, neighbours) score
it as a type. Dynamic programming over the run chooses boundaries and types
jointly; segments that touch no base span are added. Base spans always stay.

The field is trained on the base spans of at most ``FIT_RUNS`` different runs of up
to ``FIT_LENGTH`` characters, taken in the order of a hash, from all runs in which
no pattern dropped an overlong match. Equal runs between equal characters are one,
so copies cannot fill the sample. Addresses with an ``@`` are base spans alone and
cut a run.

Cases: a null text counts as empty and has no spans; offsets are code points;
repeated rows repeat their result; an empty table gives an empty result (and an
untrained field, which adds nothing); further columns are ignored; a very long
text or run of digits takes time and memory in proportion to its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import documents

KINDS = ("email", "ip", "card", "phone")
MOST = 19
FIT_RUNS = 4_000
FIT_LENGTH = 200
# code points around a run that its features can see
MARGIN = 1

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match takes whole groups of digits: none starts or ends within one
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# every number pattern matches within such a run
_RUN = re.compile(r"[0-9+][0-9 ().+-]{3,}")
_DIGITS = re.compile(r"[0-9]+")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            found.append((start, 0, floor))
        at = text.find("@", max(at + 1, floor))
    return found


def _numbers(run: str, offset: int) -> tuple[list[Span], bool]:
    """Base spans of a run, and whether a pattern dropped a match with too many digits."""
    found, overlong = [], False
    if "." in run:
        for m in _IP.finditer(run):
            if all(len(p) <= 3 and int(p or "0") <= 255 for p in (g.lstrip("0") for g in m[0].split("."))):
                found.append((offset + m.start(), 1, offset + m.end()))
    for m in _CARD.finditer(run):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((offset + m.start(), 2, offset + m.end()))
        overlong |= len(digits) > 19
    if "+" in run:
        for m in _PHONE.finditer(run):
            digits = sum(c.isdigit() for c in m[0])
            if 10 <= digits <= 15:
                found.append((offset + m.start(), 3, offset + m.end()))
            overlong |= digits > 15
    return found, overlong


def runs(text: str) -> list[tuple[int, str]]:
    return [(m.start(), m[0]) for m in _RUN.finditer(text)]


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) by start, then kind."""
    found = _emails(text) if "@" in text else []
    for offset, run in runs(text):
        found += _numbers(run, offset)[0]
    return sorted(found)


# the field

TYPES = (1, 2, 3)
NAMES = (
    "bias", "plus", "checksum", "octets", "under 10", "10 to 12", "13", "14 to 16", "17 to 19", "over 19",
    "letter before", "letter behind", "brackets", "long separator", "cut at a dot or dash", "one group",
    "equal groups",
)
WIDTH = len(NAMES)


def _features(run: str, groups: list[tuple[int, int]], i: int, j: int, around: str) -> tuple[int, ...]:
    """Whole-span features of the groups i to j; ``around`` is the character on each side of the run."""
    start, end = groups[i][0], groups[j][1]
    pieces = [run[a:b] for a, b in groups[i : j + 1]]
    gaps = [run[a[1] : b[0]] for a, b in zip(groups[i:j], groups[i + 1 : j + 1], strict=True)]
    digits = "".join(pieces)
    n = len(digits)
    before = run[start - 1] if start else around[0]
    behind = run[end] if end < len(run) else around[1]
    octets = len(pieces) == 4 and all(g == "." for g in gaps) and all(len(p) <= 3 and int(p) <= 255 for p in pieces)
    size = 4 if n < 10 else 5 if n < 13 else 6 if n == 13 else 7 if n < 17 else 8 if n < 20 else 9
    inside = (i > 0 and len(run[groups[i - 1][1] : start]) == 1 and before in ".-") or (
        j + 1 < len(groups) and groups[j + 1][0] - end == 1 and behind in ".-"
    )
    flags = {
        0: True,
        1: before == "+",
        2: 14 <= n <= 19 and luhn(digits),
        3: octets,
        size: True,
        10: before.isalpha() or before == "_",
        11: behind.isalpha() or behind == "_",
        12: any("(" in g or ")" in g for g in gaps),
        13: any(len(g) > 1 and not ("(" in g or ")" in g) for g in gaps),
        14: bool(inside),
        15: len(pieces) == 1,
        16: len(pieces) > 1 and len({len(p) for p in pieces}) == 1,
    }
    return tuple(k for k, on in flags.items() if on)


def _fits(kind: int, pieces: int, gaps: list[str], n: int, plus: bool) -> bool:
    """What a type's segments look like at all; boundaries and types are for the field to choose."""
    if kind == 1:
        return pieces == 4 and all(g == "." for g in gaps)
    if kind == 2:
        return 13 <= n <= 19 and all(g in (" ", "-") for g in gaps)
    return 7 <= n <= 15 and all(len(g) <= 3 and "+" not in g for g in gaps) and (plus or pieces > 1)


def lattice(run: str, around: str) -> tuple[int, list[tuple[int, int, int, tuple[int, ...], int, int]]]:
    """Number of groups, and the segments: first group, last group, kind, features, start, end."""
    groups = [m.span() for m in _DIGITS.finditer(run)]
    found = []
    for i in range(len(groups)):
        n, gaps = 0, []
        plus = groups[i][0] > 0 and run[groups[i][0] - 1] == "+"
        for j in range(i, min(len(groups), i + MOST)):
            n += groups[j][1] - groups[j][0]
            if j > i:
                gaps.append(run[groups[j - 1][1] : groups[j][0]])
            if n > 19:
                break
            for kind in TYPES:
                if _fits(kind, j - i + 1, gaps, n, plus):
                    start = groups[i][0] - (kind == 3 and plus)
                    found.append((i, j, kind, _features(run, groups, i, j, around), start, groups[j][1]))
    return len(groups), found


def segment_scores(weights: np.ndarray, segments) -> list[float]:
    return [float(sum(weights[(kind - 1) * WIDTH + f] for f in features)) for _, _, kind, features, *_ in segments]


def best_segments(weights: np.ndarray, n: int, segments) -> list[int]:
    """Indices of the best set of segments that do not overlap; groups outside score 0."""
    scores = segment_scores(weights, segments)
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    for k, segment in enumerate(segments):
        ending[segment[1] + 1].append(k)
    best, back = [0.0] * (n + 1), [-1] * (n + 1)
    for at in range(1, n + 1):
        best[at], back[at] = best[at - 1], -1
        for k in ending[at]:
            value = best[segments[k][0]] + scores[k]
            if value > best[at]:
                best[at], back[at] = value, k
    chosen, at = [], n
    while at > 0:
        k = back[at]
        if k >= 0:
            chosen.append(k)
        at = segments[k][0] if k >= 0 else at - 1
    return chosen[::-1]


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _expected(weights: np.ndarray, n: int, segments) -> tuple[float, list[float]]:
    """Log of the sum over all segmentations, and each segment's marginal."""
    scores = segment_scores(weights, segments)
    ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
    ending: list[list[int]] = [[] for _ in range(n + 1)]
    starting: list[list[int]] = [[] for _ in range(n + 1)]
    for k, segment in enumerate(segments):
        ending[segment[1] + 1].append(k)
        starting[segment[0]].append(k)
    for at in range(1, n + 1):
        ahead[at] = ahead[at - 1]
        for k in ending[at]:
            ahead[at] = _log_add(ahead[at], ahead[segments[k][0]] + scores[k])
    for at in range(n - 1, -1, -1):
        behind[at] = behind[at + 1]
        for k in starting[at]:
            behind[at] = _log_add(behind[at], behind[segments[k][1] + 1] + scores[k])
    total = ahead[n]
    return total, [
        math.exp(ahead[s[0]] + score + behind[s[1] + 1] - total) for s, score in zip(segments, scores, strict=True)
    ]


def train(examples: list[tuple[str, str, list[Span]]], steps: int = 60) -> np.ndarray:
    """Weights for runs with their base spans: (run, characters around it, spans within it)."""
    shapes: Counter = Counter()
    for run, around, gold in examples:
        n, segments = lattice(run, around)
        spans = set(gold)
        kept = tuple(k for k, s in enumerate(segments) if (s[4], s[2], s[5]) in spans)
        # overlapping base spans of two kinds are no segmentation
        if segments and not any(
            segments[a][0] <= segments[b][1] and segments[b][0] <= segments[a][1] for a in kept for b in kept if a < b
        ):
            shapes[n, tuple(s[:4] for s in segments), kept] += 1
    weights = np.zeros(len(TYPES) * WIDTH)
    if not shapes:
        weights[::WIDTH] = -1.0
        return weights
    mass = np.zeros_like(weights)
    for _ in range(steps):
        gradient = -0.01 * weights
        for (n, segments, kept), count in shapes.items():
            _, marginals = _expected(weights, n, segments)
            weight = math.log1p(count)
            for k, (_, _, kind, features) in enumerate(segments):
                gap = (k in kept) - marginals[k]
                if abs(gap) > 1e-4:
                    gradient[[(kind - 1) * WIDTH + f for f in features]] += weight * gap
        mass += gradient**2
        weights = weights + 0.5 * gradient / (np.sqrt(mass) + 1e-9)
    return weights


def fit(docs: DataFrame) -> np.ndarray:
    """Train the field on a bounded sample of the runs of all documents."""

    def collect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                for offset, run in runs(text or ""):
                    found, overlong = _numbers(run, 0)
                    if not overlong and len(run) <= FIT_LENGTH:
                        around = text[max(0, offset - 1) : offset][-1:] or " "
                        around += text[offset + len(run) : offset + len(run) + 1] or " "
                        rows.append((run, around, [list(s) for s in found]))
            yield pd.DataFrame(rows, columns=["run", "around", "spans"])

    found = documents(docs).select("text").mapInPandas(collect, "run string, around string, spans array<array<int>>")
    found = found.dropDuplicates(["run", "around"])
    rows = found.orderBy(F.xxhash64("run", "around"), "run", "around").limit(FIT_RUNS).collect()
    return train([(r.run, r.around, [tuple(s) for s in r.spans]) for r in rows])


def all_spans(text: str, weights: np.ndarray, base: list[Span] | None = None) -> list[Span]:
    """Base spans and the field's own, by start, then kind."""
    base = base_spans(text) if base is None else base
    added = []
    for offset, run in runs(text):
        if sum(c.isdigit() for c in run) < 4:
            continue
        around = (text[offset - 1 : offset] if offset else " ") + (text[offset + len(run) : offset + len(run) + 1] or " ")
        n, segments = lattice(run, around)
        for k in best_segments(weights, n, segments) if segments else ():
            start, end = offset + segments[k][4], offset + segments[k][5]
            if not any(start < e and s < end for s, _, e in base):
                added.append((start, segments[k][2], end))
    return sorted(base + added) if added else base


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, of the first kind."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


SPANS = "array<struct<start: int, kind: string, end: int>>"


def span_finder(weights: np.ndarray):
    """A column function: text to its spans (start, kind, end)."""

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(
                lambda t: [{"start": a, "kind": KINDS[k], "end": b} for a, k, b in all_spans(t or "", weights)]
            )

    return find


def find_spans(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and all spans."""
    return documents(docs).select("doc_id", span_finder(fit(docs))(F.coalesce("text", F.lit(""))).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans as text."""
    weights = fit(docs)

    @F.pandas_udf("n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text or "")
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                spans = all_spans(text or "", weights, base)
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            names = [*(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pd.DataFrame(rows, columns=names)

    return documents(docs).select("doc_id", digest(F.coalesce("text", F.lit(""))).alias("r")).select("doc_id", "r.*")


def mask_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span in ``text`` masked and ``n_chars``, if there, counted anew."""
    weights = fit(docs)

    @F.pandas_udf("string")
    def mask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: None if t is None else masked(t, all_spans(t, weights)))

    out = docs.withColumn("text", mask(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(changed))
    return out
