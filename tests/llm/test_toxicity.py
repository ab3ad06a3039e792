import itertools
import math
import random
import zlib

import numpy as np
import pytest

from scrimtally.llm import toxicity as op

LABELS = "doc_id bigint, quality int, toxic int"


def corpus(n=400):
    r = random.Random(3)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randrange(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(5, 80))]
        toxic = int(i % 5 == 1)
        for _ in range(r.randrange(1, 5) if toxic else 0):
            text.insert(r.randrange(len(text)), r.choice(["zork", "zorkling", "Zorkian", "quux"]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_held_out_documents(spark, docs):
    pairs, labels = corpus()
    pairs += [(5000, "zork you quux"), (5001, "abc def"), (5002, None), (5003, ""), (None, "zork zork"), (5000, "zork you quux")]
    data, marks = docs(pairs), spark.createDataFrame(labels + [(1, 1, None), (None, 0, 1), (7777, 0, 1)], LABELS)
    rows = op.score_documents(data, marks).collect()
    assert len(rows) == len(pairs) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    truth = {i: t for i, _, t in labels}
    for r in rows:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    checked = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in checked) >= 0.97 * len(checked)
    found = {r.doc_id: r.predicted for r in rows}
    assert found[5000] == 1 and found[None] == 1 and found[5001] == found[5002] == found[5003] == 0
    kept = op.keep_clean(data, marks)
    assert kept.columns == data.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, p in found.items() if not p}


def test_labels_of_the_held_out_fold_do_not_matter(spark, docs):
    pairs, labels = corpus(200)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    a, b = (op.score_documents(docs(pairs), spark.createDataFrame(x, LABELS)).collect() for x in (labels, turned))
    assert sorted(a) == sorted(b)


def test_without_a_model(spark, docs):
    clean = spark.createDataFrame([(i, 0, 0) for i in range(9)], LABELS)
    assert {r.score for r in op.score_documents(docs([(1, "x"), (2, None)]), clean).collect()} == {0.0}
    assert op.score_documents(docs([]), clean.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_marginals_equal_enumeration(seed):
    r = np.random.default_rng(seed)
    chain = op.Chain({}, level=r.normal(size=op.LEVELS + 1).tolist(), enter=r.normal(), leave=r.normal(), stay=r.normal())
    n = 7
    levels = [int(x) for x in r.integers(0, op.LEVELS + 1, n)]
    places = [(i, v) for i, v in enumerate(levels) if v]

    def score(states):
        total = sum(chain.level[v] for v, s in zip(levels, states) if s)
        for a, b in zip((0, *states), states):
            total += chain.stay if a and b else chain.enter if b else chain.leave if a else 0.0
        return total

    weight = {s: math.exp(score(s)) for s in itertools.product((0, 1), repeat=n)}
    total = sum(weight.values())
    odds, found = chain.marginals(places, n)
    assert math.isclose(odds, math.log(total - 1), rel_tol=1e-9)
    for (i, _), p in zip(places, found):
        assert math.isclose(p, sum(w for s, w in weight.items() if s[i]) / total, rel_tol=1e-9)


def test_spans():
    chain = op.Chain({"zork*": 4, "zork$": 4}, level=[-6.0, 0.0, 1.0, 2.0, 6.0])
    text = "é all fine, Zorkian said; zork!"
    assert [(text[a:b], p > 0.9) for a, b, p in chain.spans(text)] == [("Zorkian", True), ("zork", True)]
    assert chain.spans("") == [] and chain.spans("nothing here") == []


def test_sample_of_the_fit(spark, docs):
    pairs, labels = corpus(300)
    data = docs([*pairs, *pairs[:40], (1, "another text of an id")])
    marks = spark.createDataFrame(labels, LABELS)
    foreign = spark.range(10_000, 210_000).selectExpr("id AS doc_id", "0 AS quality", "0 AS toxic")
    plain = op.labelled_documents(data, op.labelled_ids(data, marks), 60).collect()
    mixed = op.labelled_documents(data, op.labelled_ids(data, marks.unionByName(foreign)), 60).collect()
    assert sorted(plain) == sorted(mixed) and len({r.doc_id for r in plain}) == len(plain) == 60
    assert sum(r.toxic for r in plain) == 30
    scores = [sorted(op.score_documents(docs(pairs), m).collect()) for m in (marks, marks.unionByName(foreign))]
    assert scores[0] == scores[1]
