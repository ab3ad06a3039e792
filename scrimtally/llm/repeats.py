"""Removal of every byte covered by a 400-byte string that also starts elsewhere.

Suffixes are sorted into buckets and buckets are refined by what stands at later
offsets, but only as far as the question needs it, and only at anchors:

1. Initial buckets. Every start of a 400-byte string has one anchor, the smallest
   hashed 16-gram among the places where a ``GRAM``-byte string still ends within
   it; equal strings have equal anchors. Anchors with equal ``GRAM`` bytes are a
   bucket; a start whose anchor is alone in its bucket is not repeated.
2. Refinement. A bucket is split by the whole context of its anchors: the offsets
   of the first and last start and all bytes up to the end of the last string.
   Members of a class of two or more are repeated at every start.
3. Last offsets. Where a bucket holds several classes, one member of each class
   hands in its strings at every start; equal ones are counted. A lone member is
   covered from its first to its last repeated start (these are closer than 400
   bytes, so all between them is covered).

Keys are 64-bit polynomial hashes, mixed; a string is compared by its hash only.
Buckets are counted, never gathered: copies of a context are added up before the
shuffle, and no task holds a bucket.

Cases: a null text counts as empty; texts under 400 bytes lose nothing by
themselves; a text that repeats itself loses both places; repeated rows remove
each other; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import documents, passing, stored
from scrimtally.llm.near_duplicates import _BYTE, _mixed, _power_tables

LENGTH = 400
GRAM = 256
WINDOW = LENGTH - GRAM + 1
ORDER = 16


class Hashes:
    """Hashes of all substrings of a text."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE[data] * up[:-1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: np.ndarray | int = 0) -> np.ndarray:
        with np.errstate(over="ignore"):
            keys = (self.total[end] - self.total[start]) * self.down[start]
            return _mixed(_mixed(keys) + np.asarray(salt).astype(np.uint64))


def anchors(data: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all starts: places, and the first and last start of each."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    places = np.arange(n + WINDOW - 1)
    # the place in the low half makes the leftmost of equal grams the smallest
    low = (hashes.of(places, places + ORDER) & np.uint64(0xFFFFFFFF00000000)) | places.astype(np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[WINDOW - width : WINDOW - width + n])
    anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], n) - 1
    return anchor[first], first, last


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _anchored(texts: DataFrame) -> DataFrame:
    """(key, place, first, last, gram, context) of every anchor of every text."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, size = [], 0
            for key, text in zip(batch["key"], batch["text"], strict=True):
                data = _bytes(text)
                if len(data) < LENGTH:
                    continue
                hashes = Hashes(data)
                place, first, last = anchors(data, hashes)
                shape = (place - first) * 1024 + (last - place + 512)
                parts.append(
                    pd.DataFrame(
                        {
                            "key": np.full(len(place), key, np.int64),
                            "place": place.astype(np.int32),
                            "first": first.astype(np.int32),
                            "last": last.astype(np.int32),
                            "gram": hashes.of(place, place + GRAM).view(np.int64),
                            "context": hashes.of(first, last + LENGTH, shape).view(np.int64),
                        }
                    )
                )
                size += len(place)
                if size > 50_000:
                    yield pd.concat(parts, ignore_index=True)
                    parts, size = [], 0
            if parts:
                yield pd.concat(parts, ignore_index=True)

    schema = "key bigint, place int, first int, last int, gram bigint, context bigint"
    return texts.select("key", "text").mapInPandas(build, schema)


def _tests(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(string, key, place, start, alone): every string of the given anchors."""

    def joined(parts) -> pd.DataFrame:
        names = ("string", "key", "place", "start", "alone")
        return pd.DataFrame({n: np.concatenate(c) for n, c in zip(names, zip(*parts, strict=True), strict=True)})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts, size = [], 0
            for row in batch.itertuples():
                hashes = Hashes(_bytes(row.text))
                values = np.array([list(m) for m in row.members], np.int64)
                length = values[:, 2] - values[:, 1] + 1
                owner = np.repeat(np.arange(len(values)), length)
                start = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length) + values[owner, 1]
                string = hashes.of(start, start + LENGTH).view(np.int64)
                alone = values[owner, 3] == 1
                parts.append((string, np.full(len(owner), row.key, np.int64), values[owner, 0], start, alone))
                size += len(owner)
                if size > 200_000:
                    yield joined(parts)
                    parts, size = [], 0
            if parts:
                yield joined(parts)

    grouped = members.groupBy("key").agg(F.collect_list(F.array("place", "first", "last", F.least("n", F.lit(2)).cast("int"))).alias("members"))
    grouped = stored(grouped, "members")
    met = passing(texts, "key", grouped).join(grouped, "key").select("key", "text", "members")
    return met.mapInPandas(build, "string bigint, key bigint, place int, start int, alone boolean")


def covered(texts: DataFrame) -> DataFrame:
    """(key, first, last): starts whose strings, and all between them, are covered."""
    found = stored(_anchored(texts), "anchors")
    buckets = found.groupBy("gram").agg(F.count("*").alias("total")).filter("total > 1").select("gram")
    # the same plan at every size
    found = stored(found.join(stored(buckets, "buckets").hint("merge"), "gram"), "shared")
    member = F.struct("key", "place", "first", "last")
    classes = found.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(member).alias("member"))
    classes = stored(classes, "classes")
    several = classes.groupBy("gram").agg(F.count("*").alias("classes"))
    classes = stored(classes.join(several, "gram"), "classes")
    repeated = classes.filter("n > 1").select("gram", "context")
    whole = found.join(repeated, ["gram", "context"]).select("key", "first", "last")
    open_classes = classes.filter("classes > 1").select("n", "member.*")
    tests = _tests(texts, open_classes)
    same = F.count("*").over(Window.partitionBy("string"))
    hits = tests.withColumn("same", same).filter("same > 1 AND alone")
    single = hits.groupBy("key", "place").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    return whole.union(single.select("key", "first", "last"))


def spans(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs [start, end) of covered starts."""
    order = np.argsort(first, kind="stable")
    start, end = first[order], np.maximum.accumulate(last[order] + LENGTH)
    new = np.append(True, start[1:] > end[:-1])
    at = np.flatnonzero(new)
    return start[at], end[np.append(at[1:], len(start)) - 1]


def _result(doc_id, text: str | None, runs) -> tuple:
    data = (text or "").encode("utf-8", "surrogatepass")
    kept, at, removed, count = [], 0, 0, 0
    if runs is not None and len(runs):
        values = np.array([list(r) for r in runs], np.int64)
        for start, end in zip(*(x.tolist() for x in spans(values[:, 0], values[:, 1])), strict=True):
            kept.append(data[at:start])
            removed, count, at = removed + end - start, count + 1, end
    kept.append(data[at:])
    return doc_id, len(data), removed, count, b"".join(kept)


def _cut(rows: DataFrame, has_runs: bool, schema: str, shape) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            runs = batch["runs"] if has_runs else [None] * len(batch)
            found = [shape(*_result(i, t, r)) for i, t, r in zip(batch["doc_id"], batch["text"], runs, strict=True)]
            out = pd.DataFrame(found, columns=names)
            yield out.assign(doc_id=batch["doc_id"].to_numpy())

    return rows.mapInPandas(build, schema)


def _each(docs: DataFrame, schema: str, shape) -> DataFrame:
    texts = documents(docs).withColumn("key", F.xxhash64("doc_id", "text"))
    runs = covered(texts).distinct().groupBy("key").agg(F.collect_list(F.array("first", "last")).alias("runs"))
    runs = stored(runs, "runs")
    near = passing(texts, "key", runs)
    bucket = F.pmod(F.col("key"), F.lit(1 << 19)).cast("int")
    used = runs.select(bucket.alias("bucket")).distinct()
    # at most 2^19 integers
    rest = texts.withColumn("bucket", bucket).join(F.broadcast(used), "bucket", "left_anti")
    with_runs = near.join(runs, "key", "left").select("doc_id", "text", "runs")
    return _cut(with_runs, True, schema, shape).union(_cut(rest.select("doc_id", "text"), False, schema, shape))


def removed_repeats(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return _each(docs, schema, lambda i, n, r, s, kept: (i, n, r, s, hashlib.sha256(kept).hexdigest()))


def kept_bytes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and the bytes that stay (a cut may fall within a character)."""
    return _each(docs, "doc_id bigint, kept binary", lambda i, n, r, s, kept: (i, kept))
