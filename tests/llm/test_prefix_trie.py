import hashlib
import random
import zlib

import pytest

from scrimtally.llm.prefix_trie import SpillingQueue, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, key string"


@pytest.fixture(scope="module")
def chats(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)

    return make


def plain(rows):
    """Every prefix of every rebuilt conversation, all pairs of prefixes."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    saved = {n: (len(m) - 1) * len(n[-1][1].encode().split()) if n else 0 for n, m in members.items()}
    inner = {n[:-1] for n in members if n}
    found = []
    for n, m in members.items():
        below = [x for x in members if x[: len(n)] == n]
        ends = ",".join(str(c) for c in sorted(m) if built[c] == n)
        found.append((
            min(m), len(n), min(members[n[:-1]]) if n else None, len(m),
            sum(1 for x in below if len(x) == len(n) + 1), sum(1 for x in below if x not in inner),
            sum(saved[x] for x in below), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def found(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def crowd(seed, convs, longest=7):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(4 * convs), convs):
        for turn in range(draw.randrange(1, longest)):
            text = draw.choice(["hello there", "a b  c", "", None, "x\x1cy z"])
            rows.append((c, draw.choice([turn, turn, None]), draw.choice(["user", "assistant", None]), text))
    return rows


@pytest.mark.parametrize("shard", [2, 5, 4096])
def test_equals_all_pairs(chats, shard):
    rows = crowd(shard, 120)
    rows += [(c, t, "user", "same words") for c in range(600, 660) for t in range(6)]
    assert found(prefix_trie(chats(rows), shard)) == plain(rows)


def test_hot_first_turn_and_copies(chats):
    rows = [(c, t, "user", "hi you" if t == 0 else f"turn {t if c % 3 else c}") for c in range(1000, 1300) for t in range(4)]
    assert found(prefix_trie(chats(rows), 8)) == plain(rows)


def test_nulls_repeats_negative_and_turnless(chats):
    rows = [(None, 0, "user", "gone"), (-3, 0, "user", "below"), (-20, 0, None, None), (5, None, "user", "a"), (5, None, "user", "a")]
    # too short for its head, and its base is absent
    short = next(c for c in range(101, 120) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows += [(short, 0, "user", "only"), (77, 0, "user", "word " * 100_000)]
    result = found(prefix_trie(chats(rows)))
    assert result == plain(rows)
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in result)


def test_long_conversation(chats):
    rows = [(c, t, "user", f"t {t // 2}") for c in (200, 201) for t in range(400)]
    assert found(prefix_trie(chats(rows), 2)) == plain(rows)


def test_empty(chats):
    df = prefix_trie(chats([]))
    assert df.collect() == [] and len(df.columns) == 8


def test_queue_spills_and_merges():
    draw = random.Random(1)
    entries = [((draw.randrange(50), b"k"), (i,)) for i in range(5000)]
    queue = SpillingQueue(limit=64)
    for key, value in entries:
        queue.push(key, value)
    assert len(queue.runs) > 50 and len(queue.heap) <= 64
    for key in sorted({k for k, _ in entries}):
        assert sorted(queue.pop(key)) == sorted(v for k, v in entries if k == key)
    assert not queue.heap and not queue.runs
