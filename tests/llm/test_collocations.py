import random
import re
from collections import Counter

import pytest

from scrimtally.llm.collocations import collocations, tokens

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def plain(pairs, least, most, inside, reported):
    """The definition, phrase by phrase."""
    counts, sizes = {}, Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, most + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    rows = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in often.items():
            around = [
                b for q, b in often.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if any(100 * b >= inside * a for b in around):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:reported], 1):
            rows.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(rows)


@pytest.fixture(scope="module")
def texts(spark):
    def make(pairs):
        rows = [(i, t, lang, 1, 2, 3) for i, (lang, t) in enumerate(pairs)]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, rank int, block int, slot int"
        )

    return make


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["a", "B", "c", "é", "ß", "x\x00y", " ", "<s>"]
    ends = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]
    text = lambda: "".join(draw.choice(words) + draw.choice(ends) for _ in range(draw.randrange(30)))
    langs = ["en", "de", None, "und", ""]
    return [(draw.choice(langs), draw.choice([None, "", text(), text(), text()])) for _ in range(n)]


@pytest.mark.parametrize(("least", "most", "inside", "reported"), [(3, 3, 50, 2000), (2, 4, 80, 5)])
def test_equals_the_definition(texts, least, most, inside, reported):
    pairs = corpus(least, 60)
    df = collocations(texts(pairs).repartition(3), least, most, inside, reported, block_words=100)
    rows = found(df)
    assert rows == plain(pairs, least, most, inside, reported) and len(rows) > 10


def test_ties_repeats_and_pieces(texts):
    pairs = [("en", "New York city. new\tyork, York new")] * 10 + [("en", "b a c"), ("en", "a b c")] * 10
    rows = found(collocations(texts(pairs)))
    assert rows == plain(pairs, 10, 3, 50, 2000)
    # "new york" stands within "new york city" in half of its occurrences
    assert [r[2] for r in rows if "york" in r[2]] == ["new york city", "york new"]


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    from scrimtally.llm.collocations import _score

    a, left, right = 10**14 + 7, 3 * 10**14 + 1, 10**14 + 9
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert df.select(_score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (left * right)


def test_empty_null_and_long(texts):
    assert found(collocations(texts([]))) == []
    assert found(collocations(texts([(None, None), ("en", ""), ("en", " .\n")]))) == []
    pairs = [(None, "to be or not " * 30_000), ("und", "to be")]
    assert found(collocations(texts(pairs))) == plain(pairs, 10, 3, 50, 2000)


def test_breaks_and_words():
    assert tokens("A\tb.\x0cÄ") == [b"a", b"b", b"\xff", b"\xff", "Ä".encode()]
    assert tokens(None) == []
