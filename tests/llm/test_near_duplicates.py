import random
from collections import Counter

import numpy as np
import pytest

from scrimtally.llm import near_duplicates as op
from scrimtally.llm.components import components


def plain_sets(pairs):
    out = []
    for _, text in pairs:
        w = (text or "").encode().lower().split()
        out.append({tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set())
    return out


def plain(pairs):
    """Components over all pairs, by their smallest id."""
    sets, root = plain_sets(pairs), list(range(len(pairs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            m = len(a & b)
            if m and 100 * m >= 75 * (len(a) + len(b) - m):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    lowest = {}
    for i, (doc_id, _) in enumerate(pairs):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    return Counter((d, len(s), lowest.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(pairs, sets)))


def found(docs, pairs):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in op.near_duplicates(docs(pairs)).collect())


def corpus():
    r = random.Random(4)
    words = [f"w{i}" for i in range(500)]

    def text(n):
        return [r.choice(words) for _ in range(n)]

    def edited(t, edits):
        t = list(t)
        for _ in range(edits):
            t[r.randrange(len(t))] = r.choice(words)
        return t

    pairs = [(i, " ".join(text(r.randrange(1, 120)))) for i in range(150)]
    for base in range(6):
        t = text(150)
        pairs += [(1000 + 100 * base + k, " ".join(edited(t, r.randrange(0, 5)))) for k in range(20)]
    hot = text(80)
    pairs += [(5000 + k, " ".join(edited(hot, r.randrange(0, 3)))) for k in range(150)]
    # a chain: each is near the next one only
    chain = text(160)
    for k in range(12):
        pairs.append((7000 - k, " ".join(chain)))
        chain = chain[8:] + text(8)
    return pairs


def test_components_are_those_of_all_pairs(docs):
    pairs = corpus()
    pairs += [(9000, None), (9001, ""), (9002, " \n\t"), (9003, "one two"), (9004, "ONE  two"), (9005, "one two é"), (9003, "one two")]
    pairs += [(None, "one\x0btwo"), (9006, "x y z"), (9007, "Ä b c d e f"), (9008, "ä b c d e f"), (None, "alone with no id")]
    assert found(docs, pairs) == plain(pairs)


def test_large_regions_miss_nothing(docs, monkeypatch):
    # every region is a large one, so splitting alone would leave pairs out
    monkeypatch.setattr(op, "REGION", 1)
    r = random.Random(8)
    words = [f"w{i}" for i in range(800)]
    shared, pairs = [r.choice(words) for _ in range(150)], []
    for base in range(12):
        own = shared[:100] + [r.choice(words) for _ in range(40 + base)]
        for k in range(8):
            copy = list(own)
            for _ in range(k % 4):
                copy[r.randrange(len(copy))] = r.choice(words)
            pairs.append((100 * base + k, " ".join(copy)))
    assert found(docs, pairs) == plain(pairs)


def test_kept_rows(docs):
    pairs = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "other words"), (4, None), (None, None), (1, "a b c d e f")]
    data = docs(pairs)
    rows = {(r.doc_id, r.kept) for r in op.near_duplicates(data).collect()}
    assert rows == {(3, False), (1, True), (2, True), (4, True), (None, True)}
    kept = op.keep_one(data)
    assert kept.columns == data.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, 1, 2, 4, None])
    assert op.near_duplicates(docs([])).count() == 0 and op.keep_one(docs([])).count() == 0


def test_shingle_hashes():
    texts = ["a b c d e f", "A  b\tc d e f", "a b c d e", "a b", "", None, "é b c d e f g", "x " * 5000]
    sets = plain_sets(enumerate(texts))
    assert [len(op.shingles(t)) for t in texts] == [len(s) for s in sets]
    assert np.array_equal(op.shingles(texts[0]), op.shingles(texts[1]))
    assert set(op.shingles("a b c d e")) < set(op.shingles("a b c d e f"))
    assert len(set(map(len, op.labels(op.shingles("a b c"))))) == 1


def test_similarity_of_labels():
    a, b = "w ".join(map(str, range(400))), "w ".join(map(str, range(60, 400)))
    x, y = op.shingles(a), op.shingles(b)
    share = np.mean([p[:4] == q[:4] for p, q in zip(op.labels(x), op.labels(y))])
    assert abs(share - len(np.intersect1d(x, y)) / len(np.union1d(x, y))) < 0.3


@pytest.mark.parametrize("n", [0, 1, 40])
def test_chains_are_one_component(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(1000, 1000 + k) for k in range(1, n)] + [(5, 5)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {(i, 0) for i in range(n + 1)} if n else set()
    assert got == want | ({(1000 + k, 1000) for k in range(n)} if n > 1 else set())


def test_kept_documents_of_null_and_repeated_ids(docs):
    a, b, c = "a b c d e f g h", "i j k l m n", "o p q r s t"
    pairs = [(3, a), (7, a), (7, b), (None, a), (None, b + " x y z 1 2 3 4 5"), (None, c), (None, c), (None, None), (None, " ")]
    # one component of one id, and one without ids, each of two texts
    pairs += [(9, "u v w x y z u v"), (9, "U v w x y z u v"), (None, "1 2 3 4 5 6"), (None, "1  2 3 4 5 6")]
    kept = Counter((r.doc_id, (r.text or "").lower().replace("  ", " ")) for r in op.keep_one(docs(pairs)).collect())
    want = [(3, a), (7, b), (None, b + " x y z 1 2 3 4 5"), (None, c), (None, ""), (None, " ")]
    assert kept == Counter([*want, (9, "u v w x y z u v"), (None, "1 2 3 4 5 6")])


@pytest.mark.parametrize("reach", [1, 3])
def test_neighbours_across_partitions(spark, tmp_path, monkeypatch, reach):
    from scrimtally.llm.base import Written

    monkeypatch.setattr(op, "REGION", reach + 1)
    r = random.Random(reach)
    rows = []
    for i in range(300):
        label = bytes([r.randrange(4)] * 12 + [r.randrange(3) for _ in range(12)])
        rows.append((r.randrange(3), label, i.to_bytes(2, "big"), r.randrange(90, 130), bytes([r.randrange(5)])))
    rows.sort(key=lambda x: x[:3])
    want = set()
    for i, a in enumerate(rows):
        for b in rows[i + 1 : i + 1 + reach]:
            if a[0] == b[0] and a[1][:12] == b[1][:12] and a[4] != b[4] and 100 * min(a[3], b[3]) >= 75 * max(a[3], b[3]):
                want.add((min(a[2], b[2]), max(a[2], b[2])))
    data = spark.createDataFrame(rows, "tree int, label binary, set_key binary, n bigint, root binary")
    got = op._second_pairs(data, Written(spark)).collect()
    assert {(bytes(x.a), bytes(x.b)) for x in got} == want and len(got) == len(want)
