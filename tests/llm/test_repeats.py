import hashlib
import random
from collections import Counter

from scrimtally.llm import repeats as op


def plain(pairs):
    data = [(t or "").encode() for _, t in pairs]
    seen = Counter(d[i : i + 400] for d in data for i in range(len(d) - 399))
    out = Counter()
    for (doc_id, _), d in zip(pairs, data):
        mark = bytearray(len(d))
        for i in range(len(d) - 399):
            if seen[d[i : i + 400]] > 1:
                mark[i : i + 400] = b"\x01" * 400
        runs = sum(1 for i, m in enumerate(mark) if m and (i == 0 or not mark[i - 1]))
        kept = bytes(c for c, m in zip(d, mark) if not m)
        out[doc_id, len(d), sum(mark), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def corpus(seed):
    r = random.Random(seed)

    def text(n):
        return "".join(r.choice("abcdefgé ") for _ in range(n))

    a, b, c = text(2500), text(399), text(401)
    pairs = [(i, text(r.randrange(0, 1500))) for i in range(25)]
    pairs += [(100, a), (101, a), (102, a[:1200] + "X" + a[1201:]), (103, text(300) + a[700:1150] + text(200))]
    pairs += [(104, b + "1" + text(20)), (105, b + "2" + text(30)), (106, "3" + c), (107, text(50) + "4" + c + "5")]
    pairs += [(108, "z" * 1000), (109, text(10) + "z" * 399), (110, text(500) + a[:600] + text(40) + a[:600])]
    for k in range(12):
        t = list(a)
        for _ in range(k % 5):
            t[r.randrange(len(t))] = "#"
        pairs.append((200 + k, "".join(t)))
    return pairs


def test_bytes_are_those_of_all_strings(docs):
    for seed in (1, 2):
        pairs = corpus(seed) + [(300, None), (301, ""), (None, "y" * 399), (302, "q" * 401), (303, "rep " * 200), (303, "rep " * 200)]
        got = Counter(tuple(r) for r in op.removed_repeats(docs(pairs)).collect())
        assert got == plain(pairs)
    assert op.removed_repeats(docs([])).count() == 0
    whole = {r.doc_id: bytes(r.kept) for r in op.kept_bytes(docs([(1, "é" * 300), (2, "é" * 300), (3, "c")])).collect()}
    assert whole == {1: b"", 2: b"", 3: b"c"}
