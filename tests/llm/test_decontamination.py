import random
import re
from collections import Counter

from scrimtally.llm import decontamination as D

BENCH = "item_id bigint, text string, doc_id string"
DOCS = "doc_id bigint, text string, item_id string"


def words(text):
    return [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]


def grams(w, k):
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def plain(docs, items):
    found = set()
    for d, text, _ in docs:
        w = words(text)
        for i, item, _ in items:
            asked = words(item)
            k, m = min(5, len(asked)), len(asked)
            for at in range(len(w) - m + 1) if m else ():
                a, b = grams(w[at : at + m], k), grams(asked, k)
                both = sum((a & b).values())
                if 100 * both >= 75 * (sum(a.values()) + sum(b.values()) - both):
                    found.add((d, i))
    return found


def test_equals_every_window_against_every_item(spark):
    rng = random.Random(3)
    vocabulary = [f"w{n}" for n in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=40)), "x") for i in range(4)]
    items += [(7, "Short item", "x"), (8, "", "x"), (9, None, "x"), (None, items[0][1], "x"), (2, items[2][1], "x")]
    docs = [(n, " ".join(rng.choices(vocabulary, k=120)), "y") for n in range(6)]
    near = items[1][1].split()
    near[20] = "other"
    docs += [
        (10, docs[0][1] + "\n" + items[0][1].upper() + "\t" + docs[1][1], "y"),
        (11, docs[2][1] + " " + " ".join(near) + " " + docs[3][1], "y"),
        (12, items[2][1], "y"),
        (12, items[2][1], "y"),
        (13, " ".join(items[3][1].split()[:20]), "y"),
        (14, "a short\vITEM here", "y"),
        (15, "", "y"),
        (16, None, "y"),
        (None, items[3][1], "y"),
    ]
    found = D.passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH))
    expected = plain(docs, items)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    assert {(10, 0), (10, None), (11, 1), (12, 2), (14, 7), (None, 3)} <= expected


def test_clean_texts_of_null_and_repeated_ids_stay(spark):
    item = " ".join(f"w{n}" for n in range(20))
    docs = [(None, item, "y"), (None, "clean words", "y"), (None, None, "y"), (4, "x " + item, "y"), (4, "clean", "y")]
    docs, items = spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item, "x")], BENCH)
    kept = D.keep_clean(docs, items)
    assert kept.columns == docs.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(left, key=str) == [(4, "clean"), (None, "clean words"), (None, None)]


def test_shorter_texts_are_judged_as_a_whole(spark):
    rng = random.Random(5)
    item = rng.choices([f"w{n}" for n in range(400)], k=41)
    docs = [(1, item[1:]), (2, item[:-1]), (3, item[:32]), (4, item[:31]), (5, item[:4]), (6, item[3:36]), (7, ["x", *item[:35]])]
    docs = [(i, " ".join(w), "y") for i, w in docs]
    items = [(1, " ".join(item), "x"), (2, " ".join(item[:38]), "x"), (3, "a b c d", "x")]
    expected = set()
    for d, text, _ in docs:
        for i, asked, _ in items:
            w, v = words(text), words(asked)
            k, m = min(5, len(v)), min(len(v), len(w))
            for at in range(len(w) - m + 1):
                a, b = grams(w[at : at + m], k), grams(v, k)
                both = sum((a & b).values())
                if 100 * both >= 75 * (sum(a.values()) + sum(b.values()) - both):
                    expected.add((d, i))
    assert {(1, 1), (2, 1), (3, 1), (7, 1)} <= expected and (4, 1) not in expected
    found = D.passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert {r.similarity for r in found if (r.doc_id, r.item_id) in ((1, 1), (2, 1))} == {36 / 37}


def test_items_that_share_an_id_are_judged_one_by_one(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(400)], k=40)) for _ in range(12)]
    items = [(None if n % 2 else 5, text, "x") for n, text in enumerate(texts)]
    docs = [(n, f"x y {text} z", "y") for n, text in enumerate(texts)]
    found = D.passages(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(n, None if n % 2 else 5) for n in range(12)}
