import hashlib
import random
import re
import time

from scrimtally.llm import pii as op

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain(text):
    """The patterns as they are written, over the whole text."""
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
            check = sum(map(int, digits[-1::-2])) + sum(doubled[int(d)] for d in digits[-2::-2])
            good = (
                kind == 0
                or kind == 1 and all(int(p) <= 255 for p in m[0].split("."))
                or kind == 2 and 14 <= len(digits) <= 19 and check % 10 == 0
                or kind == 3 and 10 <= len(digits) <= 15
            )
            if good:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_are_those_of_the_patterns():
    r = random.Random(5)
    pieces = ["a", "Z", "@", ".", "-", "+", "(", ")", " ", "1", "42", "255", "300", "4111111111111111", "é", "_", "%", "a@b", ".com", "\n", "٣", "+1 (017) 555-7713", "1.2.3.4", "007", "a@b.c_d@e.f"]
    for _ in range(6000):
        text = "".join(r.choice(pieces) for _ in range(r.randrange(1, 14)))
        assert op.base_spans(text) == plain(text), text


def test_long_runs_of_digits():
    cases = ["1" * 200_000 + ".1", ".1" * 100_000, "0" * 6_000 + ".0.0.7", "1.2.3." + "9" * 5_000 + ".4.5.6.7"]
    began = time.monotonic()
    found = [[s for s in op.base_spans(text) if s[1] == 1] for text in cases]
    assert time.monotonic() - began < 5
    assert found[0] == [] and found[2] == [(0, 1, 6_006)]
    assert len(found[1]) == 25_000 and found[1][:2] == [(1, 1, 8), (9, 1, 16)]
    assert found[3] == [(5_007, 1, 5_014)]


def test_copies_of_a_run_do_not_move_the_field(spark):
    texts = [f"call {run} now" for run in examples(20)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    copies = spark.createDataFrame([(i, " 3.0.3727. ") for i in range(op.FIT_RUNS + 1)], "doc_id bigint, text string")
    one = op.fit(table.union(copies.limit(1)))
    many = op.fit(table.union(copies))
    assert (abs(one - many) < 1e-9).all()


def examples(n=400):
    r = random.Random(2)
    out = []
    for _ in range(n):
        base = "".join(str(r.randrange(10)) for _ in range(15))
        card = next(base + str(d) for d in range(10) if op.luhn(base + str(d)))
        wrong = base + str((int(card[-1]) + 3) % 10)
        phone = f"+1 ({r.randrange(1000):03d}) 555-{r.randrange(10000):04d}"
        ip = ".".join(str(r.randrange(256)) for _ in range(4))
        out += [card, wrong, phone, ip, f"{r.randrange(999)}.{r.randrange(300, 900)}.1.2", str(r.randrange(10**6, 10**9))]
    return out


def trained():
    return op.train([(run, "  ", op._numbers(run, 0)[0]) for run in examples()])


def test_the_field_finds_what_the_patterns_run_over():
    weights = trained()
    cards = (c for c in examples() if len(c) == 16 and op.luhn(c))
    a, b = next(cards), next(cards)
    text = f"call {a} {b} or +1 (407) 555-7710 {a} now"
    assert op.base_spans(text) == []
    got = op.written(op.all_spans(text, weights)).split(",")
    p = text.index("+1")
    assert got == [f"card:5:{5 + 16}", f"card:22:{22 + 16}", f"phone:{p}:{p + 17}", f"card:{p + 18}:{p + 34}"]
    assert op.masked(text, op.all_spans(text, weights)) == "call [CARD] [CARD] or [PHONE] [CARD] now"
    assert op.all_spans("in 2004 there were 1500 of 12345678 and 3.14.15", weights) == []
    assert op.masked("abc", []) == "abc"


def test_dynamic_programming_equals_enumeration():
    import itertools
    import math

    import numpy as np

    weights = np.random.default_rng(1).normal(size=len(op.TYPES) * op.WIDTH)
    n, segments = op.lattice("+12 34 5678 1234.5.6.7 8901-23", "  ")
    segments = segments[:12]
    scores = op.segment_scores(weights, segments)
    sets = [
        s
        for k in range(4)
        for s in itertools.combinations(range(len(segments)), k)
        if all(segments[a][1] < segments[b][0] or segments[b][1] < segments[a][0] for a, b in itertools.combinations(s, 2))
    ]
    values = [sum(scores[k] for k in s) for s in sets]
    assert math.isclose(sum(scores[k] for k in op.best_segments(weights, n, segments)), max(values))
    total, marginals = op._expected(weights, n, [s[:4] for s in segments])
    assert math.isclose(total, math.log(sum(map(math.exp, values))))
    for k in range(len(segments)):
        want = sum(math.exp(v - total) for s, v in zip(sets, values) if k in s)
        assert math.isclose(marginals[k], want, abs_tol=1e-9)


def test_documents(docs):
    pairs = [(i, f"é text {e} more") for i, e in enumerate(examples(30))]
    pairs += [(900, "a.b@c.d.e x 1.2.3.4"), (901, None), (902, ""), (None, "1.2.3.4"), (900, "a.b@c.d.e x 1.2.3.4"), (903, "n" * 200_000 + "@x.y")]
    rows = op.digests(docs(pairs)).collect()
    assert len(rows) == len(pairs)
    texts = dict(pairs)
    for r in rows:
        base = plain(texts[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
        assert r.base_sha256 == hashlib.sha256(op.written(base).encode()).hexdigest()
        assert set(filter(None, op.written(base).split(","))) <= set(r.spans.split(","))
    masked = op.mask_documents(docs(pairs))
    assert masked.columns == docs(pairs).columns
    row = masked.filter("doc_id = 900").first()
    assert row.text == "[EMAIL] x [IP]" and row.n_chars == 14
    assert masked.filter("doc_id = 901").first().text is None
    assert op.digests(docs([])).count() == 0 and op.find_spans(docs(pairs)).filter("size(spans) > 0").count() > 90
