import zlib
from collections import Counter

from scrimtally.llm import sharding


def test_every_document_has_one_place(docs):
    pairs = [(i, "x" * (i * 37 % 500)) for i in range(3000)] + [(None, None), (5, "again"), (5, "again"), (7, "")]
    rows = sharding.assign(docs(pairs), 24).collect()
    assert len(rows) == len(pairs)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        (i or -1, len(t or "") + 8, zlib.crc32((t or "").encode())) for i, t in pairs
    )
    size, places = Counter(), {}
    for r in rows:
        size[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert set(size) == set(range(24))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 24
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert len({(r.virtual_slot, r.shard) for r in rows}) == len({r.virtual_slot for r in rows})


def test_empty_and_utf8(docs):
    assert sharding.assign(docs([]), 24).count() == 0
    assert sharding.assign(docs([(1, "é😀")]), 24).first().size == 14


def test_map_versions(spark, tmp_path):
    sizes = [(s, 100 + s % 7) for s in range(1000)]
    first = sharding.SlotMap.packed(sizes, 10)
    grown = first.edited(sizes, shards=11)
    moved = [s for s, _ in sizes if first.shard_of[s] != grown.shard_of[s]]
    assert grown.version == 1 and 60 < len(moved) < 110
    assert {grown.shard_of[s] for s in moved} == {10}
    heavier = [(s, n + 200 * (first.shard_of[s] == 3)) for s, n in sizes]
    edited = first.edited(heavier)
    load = Counter()
    for s, n in heavier:
        load[edited.shard_of[s]] += n
    assert max(load.values()) - min(load.values()) <= 600
    for m in (first, grown):
        m.save(spark, str(tmp_path / "map"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "map"), 0).shard_of == first.shard_of
    assert sharding.SlotMap.load(spark, str(tmp_path / "map"), 1).shard_of == grown.shard_of
    wide = sharding.SlotMap({0: 0, 1: 1}, 24)
    wide.save(spark, str(tmp_path / "wide"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "wide"), 0).shards == 24


def test_equal_rows_spread(docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK", 700)
    pairs = [(i, "y" * (1000 + i % 9)) for i in range(6000)] + [(None, "x" * 2000)] * 3000
    rows = sharding.assign(docs(pairs), 24).collect()
    assert len(rows) == len(pairs)
    size, places = Counter(), {}
    for r in rows:
        size[r.shard] += r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 24
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert sum(r.doc_id is None for r in rows) == 3000
