import math
from collections import Counter

import numpy as np

from scrimtally.llm import url_filter as op
from scrimtally.llm.base import Written
from scrimtally.llm.queries import RULES

SCHEMA = "page_id bigint, url string, html string, host int, score string"


def judged(spark, urls):
    data = spark.createDataFrame([(i, u, "", 1, "x") for i, u in enumerate(urls)], SCHEMA)
    return {r.page_id: r for r in op.judge(data, RULES).collect()}


def test_hosts_paths_and_rules(spark):
    cases = [
        ("http://a.Example.COM/en/x?q#f", "a.example.com", "/en/x", "example.com/en/", "block"),
        ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://m.www.example.com/en/", "m.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("https://example.com/de/1", "example.com", "/de/1", "com/", "allow"),
        ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
        ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net/es", "x.net", "/es", None, None),
        ("http://x.com?a=/", "x.com", "", None, None),
        ("http://x.com#a://b/", "x.com", "", None, None),
        ("a://b://c.net/fr/", "b:", "//c.net/fr/", None, None),
        ("http://É.com/Ä\n/b", "É.com", "/Ä\n/b", "com/", "allow"),
        ("no scheme.com/en/", "", "", None, None),
        (None, "", "", None, None),
        ("", "", "", None, None),
        ("://", "", "", None, None),
    ]
    rows = judged(spark, [c[0] for c in cases])
    for i, (url, host, path, rule, verdict) in enumerate(cases):
        got = rows[i]
        assert (got.host, got.path, got.rule) == (host, path, rule), url
        assert got.verdict == verdict or verdict is None and got.verdict in ("allow", "block")
    assert judged(spark, []) == {}
    only = judged(spark, ["http://a.com/x", "http://b.org/y"])
    assert only[1].verdict == "allow" and only[1].score == 0


def exact_tables(labelled):
    counts = Counter()
    for url, label in labelled:
        s = "\x01" * op.ORDER + url + "\x02"
        for j in range(op.ORDER, len(s)):
            for n in range(op.ORDER + 1):
                counts[label, 0, n, s[j - n : j]] += 1
                counts[label, 1, n, s[j - n : j + 1]] += 1
    return counts


def exact_score(counts, url):
    s, gain = "\x01" * op.ORDER + url + "\x02", 0.0
    for j in range(op.ORDER, len(s)):
        for label, sign in ((0, 1), (1, -1)):
            p = 1 / 256
            for n in range(op.ORDER + 1):
                seen = counts[label, 0, n, s[j - n : j]]
                if seen >= (op.LEAST if n else 1):
                    p = (counts[label, 1, n, s[j - n : j + 1]] + op.PRIOR * p) / (seen + op.PRIOR)
            gain += sign * math.log(p)
    return gain / (len(url) + 1)


def test_scores_are_those_of_the_plain_model(spark):
    urls = [f"http://shop{i % 7}.example.net/es/{i}" for i in range(120)] + [f"https://news{i % 5}.site.com/a/{i}" for i in range(120)]
    labelled = [(u, int("net/es" in u)) for u in urls]
    counts = op.count(spark.createDataFrame(labelled, "url string, rejected int").repartition(3))
    exact = exact_tables(labelled)
    asked = urls[:5] + urls[-5:] + ["", "http://other.org/es/1", "ftp://x", "http://long.net/" + "es/7" * 40000]
    table = spark.createDataFrame([(u,) for u in asked + asked], "url string")
    rows = {r.url: r.score for r in op.scores(table, counts, Written(spark)).collect()}
    assert set(rows) == set(asked)
    assert max(abs(rows[u] - exact_score(exact, u)) for u in asked) < 1e-9


def test_counts_are_exact(spark):
    labelled = [("http://a.net/", 1)] * 3 + [("http://a.net/b", 1), ("http://a.com/", 0), ("", 0)]
    rows = op.count(spark.createDataFrame(labelled, "url string, rejected int").repartition(4)).collect()
    exact = exact_tables(labelled)
    # contexts and n-grams of all orders, each by its own key
    different = {(kind, n, text) for _, kind, n, text in exact}
    assert len(rows) == len({r.key for r in rows}) == len(different)
    assert sorted((r.accepted, r.rejected) for r in rows) == sorted(
        (exact[0, *k], exact[1, *k]) for k in different
    )


def test_pieces_cut_no_url_apart(monkeypatch):
    urls = ["http://a.net/" * 5, "", "é", "x\x01y"]
    whole = [np.concatenate(a, axis=-1) for a in zip(*op.positions(urls), strict=True)]
    monkeypatch.setattr(op, "PIECE", 7)
    cut = [np.concatenate(a, axis=-1) for a in zip(*op.positions(urls), strict=True)]
    assert all((a == b).all() for a, b in zip(whole, cut, strict=True))
    assert np.bincount(cut[0]).tolist() == [len(u.encode()) + 1 for u in urls]


def test_blocks_do_not_change_scores(spark, monkeypatch):
    urls = [f"http://shop{i % 7}.example.net/es/{i}" for i in range(200)] + [f"https://n{i % 5}.site.com/a/{i}" for i in range(200)]
    whole = judged(spark, urls + [None] * 300)
    monkeypatch.setattr(op, "BLOCK", 500)
    cut = judged(spark, urls + [None] * 300)
    assert {i: (r.verdict, round(r.score, 9)) for i, r in whole.items()} == {
        i: (r.verdict, round(r.score, 9)) for i, r in cut.items()
    }
    assert len(whole) == 700


def test_verdicts_of_the_method(spark):
    urls = [f"http://cheap-pills{i % 7}.example.net/es/{i}" for i in range(300)]
    urls += [f"https://daily-news{i % 5}.site.com/a/{i}" for i in range(300)]
    asked = ["http://cheap-pills3.example.org/es/5", "https://daily-news2.site.org/a/9", None]
    rows = judged(spark, urls + asked)
    assert rows[600].verdict == "block" and rows[601].verdict == "allow"
    assert rows[600].score < rows[600].cut_off <= rows[601].score
    assert judged(spark, list(reversed(urls + asked)))[2].verdict == "block"
