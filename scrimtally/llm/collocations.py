"""Collocations by SETM: set-oriented mining of frequent word sequences.

Texts become pieces (split at punctuation and line ends) and pieces become words.
The occurrence relation R1 (position, word) is written once, in blocks: a block
holds whole pieces in order, its positions are consecutive within a piece and
leave a gap between pieces. Then, length by length:

1. Group-count. A block hands in each of its distinct groups once, with its
   number of occurrences; Spark adds them up per group. Groups below ``LEAST``
   occurrences go, and a frequent group is named by its smallest (block, slot).
2. Semi-join. Each block gets the names of its frequent groups back; occurrences
   of other groups leave the relation.
3. Merge-join. Two occurrences of length k at adjacent positions of one piece
   overlap in k - 1 words, so they are one occurrence of length k + 1; as the
   block is in order, this is one pass over neighbours. The result is the written,
   sorted relation R(k+1); its groups are pairs of names, never hashes.

Scores need no look at the texts: a group carries the counts of all its prefixes
and suffixes, which its two halves know.

All group tables are exact and shuffled by their key; a group meets as one row
for each block, so the most frequent phrase costs one row for every ``BLOCK``
words of the corpus. Only blocks pass through Python; no task holds more than a
few of them, and nothing reaches the driver.

Cases: a null text or an empty one has no words; a null lang counts as ``und``
(and with rows that say ``und``); repeated rows and equal texts count as often as
they are given; equal scores are ordered by count and then by the phrase's bytes;
an empty table gives an empty result; further columns, named like results or
not, are ignored. A very long text makes a block of its own, so a task's memory
grows with the longest text (about 20 bytes a word), never with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import Written, columns

LEAST = 10
MOST_WORDS = 3
INSIDE_PERCENT = 50
REPORTED = 2000
PARTS = 32
# words of a block
BLOCK = 1 << 21
# positions of a row of the written relation
CELLS = 1 << 16
# (block, slot) in one number: a text of 2 GB has fewer than 2^30 words
SLOT_BITS = 30
# blocks of one partition of the input
PART_BITS = 13

_BREAK = b"\xff"  # no byte of UTF-8
_FOLD = bytearray(range(256))
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FOLD[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_c] = _BREAK[0]
_FOLD[9] = 32
_FOLD = bytes(_FOLD)


class _Slots(dict):
    """Words of one language to slots, numbered as they come by a counter for the block."""

    def __init__(self, names: list):
        super().__init__({_BREAK: -1})
        self.names = names

    def __missing__(self, word: bytes) -> int:
        self[word] = slot = len(self.names)
        self.names.append(word)
        return slot


def tokens(text: str | None) -> list[bytes]:
    """The text's words in order, with a break at each end of a piece."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD)
    return data.replace(_BREAK, b" " + _BREAK + b" ").split()


class _Block:
    """Words of some texts as slots; a slot stands for a language and a word."""

    def __init__(self):
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.slots: dict[str, _Slots] = {}
        self.cells: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, text: str | None) -> None:
        found = tokens(text)
        if not found:
            return
        slots = self.slots.setdefault(lang, _Slots(self.words))
        cells = np.fromiter(map(slots.__getitem__, found), np.int32, len(found))
        self.langs.extend([lang] * (len(self.words) - len(self.langs)))
        self.cells += [cells, np.full(1, -1, np.int32)]
        self.size += len(cells)

    def rows(self, block: int) -> pa.RecordBatch:
        cells = np.concatenate(self.cells)
        counts = np.bincount(cells[cells >= 0], minlength=len(self.words))
        words = pa.array(self.words, pa.binary()).cast(pa.string())
        return _rows(block, cells, {"lang": pa.array(self.langs, pa.string()), "word": words}, counts)


def _rows(block: int, cells: np.ndarray, groups: dict[str, pa.Array], counts: np.ndarray) -> pa.RecordBatch:
    """A block as rows: its cells, ``CELLS`` a row, at slots -1, -2 and so on; then one row for each slot from 0 up."""
    ends = np.append(np.arange(0, len(cells), CELLS), len(cells)) if len(cells) else np.zeros(1, np.int64)
    held = len(ends) - 1
    size = held + len(counts)
    offsets = np.concatenate([ends, np.full(len(counts), len(cells))]).astype(np.int32)
    lists = pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(cells, pa.int32()), mask=pa.array(np.arange(size) >= held)
    )
    out = {
        "block": pa.array(np.full(size, block, np.int64)),
        "slot": pa.array(np.concatenate([-1 - np.arange(held), np.arange(len(counts))]).astype(np.int32)),
    }
    for name, values in groups.items():
        out[name] = pa.concat_arrays([pa.nulls(held, values.type), values])
    out["n"] = pa.array(np.concatenate([np.zeros(held, np.int32), counts.astype(np.int32)]))
    return pa.RecordBatch.from_pydict(out | {"cells": lists})


def occurrences(docs: DataFrame, block_words: int = BLOCK) -> DataFrame:
    """R1: per block its cells (a slot for each position, -1 between pieces) and its words with counts.

    See ``_rows``: a row has either cells or a group with its count.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << PART_BITS
        held = _Block()
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                held.add(lang, text.as_py())
                if held.size >= block_words:
                    yield held.rows(block)
                    block, held = block + 1, _Block()
        if held.words:
            yield held.rows(block)

    texts = columns(docs, (("lang", "string"), ("text", "string"))).fillna("und", ["lang"])
    return texts.mapInArrow(build, "block bigint, slot int, lang string, word string, n int, cells array<int>")


def _frequent(groups: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The rows (keys, block, slot, n) of frequent groups, with ``total`` and the group's name ``gid``."""
    uid = F.shiftleft("block", SLOT_BITS) + F.col("slot")
    whole = Window.partitionBy(*keys)
    rows = groups.filter("slot >= 0").select(*keys, "n", uid.alias("uid"))
    rows = rows.withColumns({"total": F.sum("n").over(whole), "gid": F.min("uid").over(whole)})
    return rows.filter(F.col("total") >= least).drop("n")


def _extended(blocks: DataFrame, frequent: DataFrame, last: bool) -> DataFrame:
    """R(k+1) of R(k): per block its cells (none if it is the last one) and its distinct pairs of names (low, high)."""

    def extend(held: pa.Table, names: pa.Table) -> pa.Table:
        parts = held.sort_by([("slot", "descending")])["cells"].combine_chunks()
        at = np.append(parts.flatten().to_numpy(), np.int32(-1))
        slots, gids = names["slot"].to_numpy(), names["gid"].to_numpy()
        gid = np.unique(gids)
        # the semi-join: slots of frequent groups, by the place of their name
        place = np.full(max(at.max(), slots.max(initial=0)) + 1, -1, np.int64)
        place[slots] = np.searchsorted(gid, gids)
        group = np.where(at >= 0, place[at], -1)
        # the merge-join: neighbours in order
        met = np.flatnonzero((group[:-1] >= 0) & (group[1:] >= 0))
        pair, slot, counts = np.unique(
            group[met] * len(gid) + group[met + 1], return_inverse=True, return_counts=True
        )
        grown = np.full(0 if last else len(at), -1, np.int32)
        if not last:
            grown[met] = slot
        size = max(len(gid), 1)
        pairs = {"low": pa.array(gid[pair // size]), "high": pa.array(gid[pair % size])}
        block = (held if len(held) else names)["block"][0].as_py()
        return pa.Table.from_batches([_rows(block, grown, pairs, counts)])

    names = frequent.select(
        F.shiftright("uid", SLOT_BITS).alias("block"),
        F.col("uid").bitwiseAND(F.lit((1 << SLOT_BITS) - 1)).cast("int").alias("slot"),
        "gid",
    )
    cells = blocks.filter("slot < 0").select("block", "slot", "cells")
    relation = cells.groupBy("block").cogroup(names.groupBy("block"))
    schema = "block bigint, slot int, low bigint, high bigint, n int, cells array<int>"
    return relation.applyInArrow(extend, schema)


def _sequences(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """The frequent sequences of one word more: their words and the counts of their prefixes and suffixes."""
    first = shorter.select(F.col("gid").alias("low"), "lang", "words", "prefixes")
    last = shorter.select(
        F.col("gid").alias("high"), F.element_at("words", -1).alias("word"), F.col("suffixes").alias("ends")
    )
    one = F.array(F.col("total"))
    return (
        pairs.join(first, "low")
        .join(last, "high")
        .select(
            "gid",
            "low",
            "high",
            "lang",
            F.concat("words", F.array("word")).alias("words"),
            F.concat("prefixes", one).alias("prefixes"),
            F.concat("ends", one).alias("suffixes"),
            "total",
        )
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact: counts below 10^15 keep every product in 38 digits."""
    wide = [c.cast("decimal(15,0)") for c in (a, left, right)]
    above = wide[0] * wide[0] * F.lit(1_000_000).cast("decimal(8,0)")
    return F.call_function("div", above, wide[1] * wide[2])


def frequent_sequences(
    docs: DataFrame, least: int = LEAST, most_words: int = MOST_WORDS, block_words: int = BLOCK
) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) and, by length, the frequent sequences (gid, low, high, lang, words, prefixes, suffixes, total)."""
    written = Written(docs.sparkSession)
    blocks = written.put("occurrences-1", occurrences(docs, block_words))
    sizes = blocks.filter("slot >= 0").groupBy("lang").agg(F.sum("n").alias("n"))
    sizes = written.put("sizes", sizes)
    rows = written.put("frequent-1", _frequent(blocks, ["lang", "word"], least))
    one = F.array("total")
    words = rows.filter("uid = gid").select(
        "gid", "lang", F.array("word").alias("words"), one.alias("prefixes"), one.alias("suffixes"), "total"
    )
    found = [written.put("sequences-1", words)]
    for k in range(2, most_words + 1):
        last = k == most_words
        blocks = _extended(blocks, rows, last)
        blocks = blocks if last else written.put(f"occurrences-{k}", blocks)
        rows = _frequent(blocks, ["low", "high"], least)
        rows = rows if last else written.put(f"frequent-{k}", rows)
        pairs = rows.filter("uid = gid").select("gid", "low", "high", "total")
        found.append(written.put(f"sequences-{k}", _sequences(pairs, found[-1])))
        written.drop(f"occurrences-{k - 1}", f"frequent-{k - 1}")
    return sizes, found


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    inside_percent: int = INSIDE_PERCENT,
    reported: int = REPORTED,
    block_words: int = BLOCK,
) -> DataFrame:
    """Per lang its best phrases: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its weakest cut. A phrase that stands inside a
    longer frequent one in ``inside_percent`` or more of its occurrences goes: a
    longer one holds a phrase at most as often as the phrase with one word more
    does, so only those are looked at.
    """
    sizes, found = frequent_sequences(docs, least, most_words, block_words)
    scored = []
    for k in range(1, most_words):
        a = F.col("total")
        cuts = [
            F.struct(
                _score(a, F.col("prefixes")[i], F.col("suffixes")[k - 1 - i]).alias("score"),
                F.lit(i).alias("cut"),
                F.col("prefixes")[i].alias("l"),
                F.col("suffixes")[k - 1 - i].alias("r"),
            )
            for i in range(k)
        ]
        rows = found[k]
        if k + 1 < most_words:
            longer = found[k + 1]
            around = longer.select(F.col("low").alias("gid"), "total").union(longer.select("high", "total"))
            around = around.groupBy("gid").agg(F.max("total").alias("around"))
            rows = rows.join(around, "gid", "left").filter(
                F.col("around").isNull() | (100 * F.col("around") < inside_percent * a)
            )
        best = F.least(*cuts) if k > 1 else cuts[0]
        rows = rows.withColumn("best", best)
        scored.append(
            rows.select("lang", F.concat_ws(" ", "words").alias("phrase"), a.alias("a"), "best.l", "best.r", "best.score")
        )
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    # the best of each part of a lang first, so the task of a lang reads PARTS times as many rows as it reports at most
    order = (F.desc("score"), F.desc("a"), "phrase")
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    rank = lambda *keys: F.row_number().over(Window.partitionBy("lang", *keys).orderBy(*order)).cast("bigint")
    every = every.withColumn("part", part).withColumn("rank", rank("part")).filter(F.col("rank") <= reported)
    every = every.withColumn("rank", rank()).filter(F.col("rank") <= reported)
    return every.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
