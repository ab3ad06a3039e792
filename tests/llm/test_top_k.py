import math
import random

import pytest
from pyspark.sql import functions as F

from scrimtally.llm import top_k

SCHEMA = "vec_id bigint, embedding array<double>, label int, rank int, score string"


def brute(rows, k, is_query):
    usable = [
        (n, i, [math.floor(256 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, i, v in usable:
        if is_query(i):
            found = sorted(
                (-sum(a * b for a, b in zip(v, w)), j) for m, j, w in usable if m != n and len(w) == len(v)
            )
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, bins=8):
    data = spark.createDataFrame([(i, v, 0, 1, "x") for i, v in rows], SCHEMA).repartition(3)
    found = top_k.top_k(data, 5, F.col("vec_id") % 50 == 0, bins=bins)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_against_all_pairs_with_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(top_k, "CANDIDATE_BLOCK", 60)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 4)
    r = random.Random(1)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, r.gauss(0, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 6) for i in range(120)] + [(50, [1.0] * 6)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 50 == 0)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (50, [1.0, 2.0, 3.0]), (1, [3.0, 1.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]),
        (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [1e6, 1.0]), (7, [3.0, 1.0]), (100, []), (8, []),
    ]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 50 == 0)
    assert run(spark, []) == [] and run(spark, [(1, [1.0])]) == []


def test_scores_beyond_the_limit_are_an_error():
    import numpy as np

    big = np.array([[2**62]], dtype=np.int64)
    with pytest.raises(OverflowError):
        top_k._product(big, big)
