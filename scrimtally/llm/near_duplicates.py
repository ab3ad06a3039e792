"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document is its set of distinct 5-word shingles (64-bit hashes). Equal sets
are one class, and only classes are compared. A class has ``TREES`` labels of
``DEPTH`` independent minimum hashes. Each tree is the sorted order of its
labels; classes next to each other that share a prefix of at least ``LEAST``
values form a region, the candidates. Three rounds link them:

1. Every class is compared with one class of its regions, the smallest key. In a
   group of many copies that is a star, whatever the group's size.
2. In regions that still hold several components a class meets the classes next
   to it in the sorted order, those with the longest common prefixes, a fixed
   number on each side. Regions of up to ``REGION`` classes are so compared whole.
3. Neighbours can keep a similar pair apart. Classes of larger regions that hold
   several components even now meet over their rarest shingles, which misses no pair.

Each candidate is confirmed on the full sets; links make components. At the
similarity 0.75 a pair shares a region of some tree with probability
1 - (1 - 0.75^3)^20 > 0.99998, at 0.8 it is above 0.9999995.

Cases: a null or empty text and one without words have no set and are linked
with nothing; a text with fewer than five words is one shingle; repeated rows
and equal texts are one class; a null id takes part, and a component without any
id has a null id; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import Written, documents, passing, stored
from scrimtally.llm.components import components

SHINGLE = 5
PERCENT = 75
TREES = 20
DEPTH = 6
LEAST = 3
REGION = 4
# bytes of a value of a label
UNIT = 4

_random = np.random.Generator(np.random.PCG64(20))
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MULTIPLY = _random.integers(0, 2**64, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)
_ADD = _random.integers(0, 2**64, TREES * DEPTH, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if len(_powers["up"]) < n:
        size = max(1 << 16, 2 * n)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[name] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; a lower-cased word ends at ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = np.frombuffer(b" ".join(words), np.uint8)
    with np.errstate(over="ignore"):
        up, down = _power_tables(len(joined) + 1)
        total = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(_BYTE[joined] * up[:-1], out=total[1:])
        ends = np.append(np.flatnonzero(joined == 32), len(joined))
        starts = np.append(0, ends[:-1] + 1)
        last = ends[size - 1 :] if len(words) >= size else ends[-1:]
        first = starts[: len(last)]
        # shingles of different lengths never share a hash by a mere shift
        keys = (total[last] - total[first]) * down[first] + (last - first).astype(np.uint64)
        return np.unique(_mixed(keys))


def labels(hashes: np.ndarray) -> list[bytes]:
    """One label for each tree: DEPTH minimum hashes of four bytes, in the order of bytes."""
    smallest = np.full(TREES * DEPTH, 2**32 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 2048):
            values = (hashes[at : at + 2048, None] * _MULTIPLY + _ADD) >> np.uint64(32)
            np.minimum(smallest, values.min(axis=0), out=smallest)
    packed = smallest.astype(">u4").tobytes()
    width = DEPTH * UNIT
    return [packed[i : i + width] for i in range(0, len(packed), width)]


def _signed(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_key, n, and for documents with words set_key and labels."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                found = shingles(text)
                key = hashlib.sha256(found.tobytes()).digest()[:16] if len(found) else None
                rows.append((len(found), key, labels(found) if len(found) else None))
            out = pd.DataFrame(rows, columns=["n", "set_key", "labels"])
            yield pd.concat([batch[["doc_id", "text_key"]].reset_index(drop=True), out], axis=1)

    keyed = documents(docs).withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInPandas(sign, "doc_id bigint, text_key bigint, n bigint, set_key binary, labels array<binary>")


def _crowd(classes: DataFrame) -> DataFrame:
    """The rows (tree, label, set_key, n) whose neighbour in the tree's order may share LEAST values."""
    rows = classes.select("set_key", "n", F.posexplode("labels").alias("tree", "label"))
    parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = rows.repartitionByRange(parts, "tree", "label", "set_key")
    order = order.sortWithinPartitions("tree", "label", "set_key").select("tree", "label", "set_key", "n")
    width = LEAST * UNIT

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # a region may go on in the partition before or behind: rows at the edges stay
        held, near_before = None, True
        for batch in batches:
            if not len(batch):
                continue
            if held is not None:
                batch = pd.concat([held, batch], ignore_index=True)
            regions = [(t, bytes(x[:width])) for t, x in zip(batch["tree"], batch["label"], strict=True)]
            same = np.array([a == b for a, b in zip(regions, regions[1:], strict=False)], bool)
            near = np.append(near_before, same) | np.append(same, False)
            # the last row waits for the one behind it
            yield batch.iloc[:-1][near[:-1]]
            held, near_before = batch.iloc[-1:], bool(near[-1])
        if held is not None:
            yield held

    return order.mapInPandas(scan, "tree int, label binary, set_key binary, n bigint")


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(set_key, hashes) of the classes in ``needed`` (set_key, text_key), from their texts again."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingles(t) for t in batch["text"]]
            yield pd.DataFrame({"set_key": batch["set_key"], "hashes": [f.view(np.int64) for f in found]})

    keyed = documents(docs).select("text", F.xxhash64("text").alias("text_key"))
    texts = passing(keyed, "text_key", needed).join(needed, "text_key").dropDuplicates(["set_key"])
    return texts.mapInPandas(build, "set_key binary, hashes array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are at least as similar as asked for."""
    of_a = sets.select(F.col("set_key").alias("a"), F.col("hashes").alias("ha"))
    of_b = sets.select(F.col("set_key").alias("b"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    met = pairs.join(of_a, "a").join(of_b, "b")
    met = met.select("a", "b", both.alias("both"), (F.size("ha") + F.size("hb")).alias("sum"))
    return met.filter(100 * F.col("both") >= PERCENT * (F.col("sum") - F.col("both"))).select("a", "b")


def _sizes_allow(n: str, m: str):
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def _first_pairs(crowd: DataFrame) -> DataFrame:
    """Each class with the smallest class of any of its regions."""
    region = ("tree", "prefix")
    first = crowd.groupBy(*region).agg(F.min(F.struct("set_key", "n")).alias("first"))
    met = crowd.join(first, [*region]).filter(F.col("set_key") != F.col("first.set_key"))
    met = met.filter(_sizes_allow("n", "first.n"))
    return met.groupBy(F.col("set_key").alias("a")).agg(F.min("first.set_key").alias("b"))


def _mixed_regions(crowd: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``crowd`` in regions that hold several components, with their root and the region's size."""
    roots = known.select(F.col("node").alias("set_key"), "root")
    rows = crowd.join(roots, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))
    sizes = rows.groupBy("tree", "prefix").agg(
        F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    # regions within one component have nothing left to compare
    sizes = sizes.filter("low <> high").select("tree", "prefix", "size")
    return rows.join(sizes, ["tree", "prefix"])


def _neighbours(order: DataFrame, reach: int) -> DataFrame:
    """Pairs (a, b) of rows of ``order`` at most ``reach`` places apart in a partition, and its rows at both edges.

    A pair shares a region and has different roots and sizes that can be similar.
    Edge rows carry the columns of ``order`` and no pair.
    """
    width = LEAST * UNIT

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, seen = None, 0
        for batch in batches:
            if not len(batch):
                continue
            head = batch.iloc[: max(0, reach - seen)]
            if len(head):
                yield head.assign(a=None, b=None)
            fresh = 0 if held is None else len(held)
            batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
            tree, n = batch["tree"].to_numpy(), batch["n"].to_numpy()
            prefix = batch["label"].map(lambda x: bytes(x[:width])).to_numpy()
            key, root = batch["set_key"].map(bytes).to_numpy(), batch["root"].map(bytes).to_numpy()
            for k in range(1, min(reach, len(batch) - 1) + 1):
                near = (tree[:-k] == tree[k:]) & (prefix[:-k] == prefix[k:]) & (root[:-k] != root[k:])
                near &= 100 * np.minimum(n[:-k], n[k:]) >= PERCENT * np.maximum(n[:-k], n[k:])
                near[: max(0, fresh - k)] = False
                first, second = key[:-k][near], key[k:][near]
                pairs = pd.DataFrame({"a": np.minimum(first, second), "b": np.maximum(first, second)})
                yield pairs.assign(tree=0, label=None, set_key=None, n=0, root=None)
            seen += len(batch) - fresh
            held = batch.iloc[-reach:]
        if held is not None:
            # rows among the first ones have been handed on
            tail = held.iloc[max(0, len(held) - max(0, seen - reach)) :]
            yield tail.assign(a=None, b=None)

    return order.mapInPandas(scan, "a binary, b binary, tree int, label binary, set_key binary, n bigint, root binary")


def _second_pairs(mixed: DataFrame, tables: Written) -> DataFrame:
    """Pairs of classes of different components that are neighbours in a tree's order.

    Neighbours have the longest common prefixes, so the depth adapts itself to each
    region. A class meets at most REGION - 1 classes on each side, whatever the
    region's size; regions of up to REGION classes are compared as a whole.
    """
    reach = max(1, REGION - 1)
    parts = int(mixed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = mixed.select("tree", "label", "set_key", "n", "root")
    ranges = order.repartitionByRange(parts, "tree", "label", "set_key")
    ranges = ranges.sortWithinPartitions("tree", "label", "set_key")
    met = tables.put("neighbours", _neighbours(ranges, reach))
    # neighbours in two partitions: at most 2 * reach rows of each partition
    edges = met.filter("a IS NULL").select(*order.columns).coalesce(1)
    across = _neighbours(edges.sortWithinPartitions("tree", "label", "set_key"), reach)
    pairs = met.filter("a IS NOT NULL").select("a", "b")
    return pairs.unionByName(across.filter("a IS NOT NULL").select("a", "b")).distinct()


def _dense(mixed: DataFrame, known: DataFrame) -> DataFrame:
    """(set_key, root) of the classes in regions of more than REGION classes that still hold several components."""
    rows = mixed.filter(F.col("size") > REGION).select("tree", "prefix", "set_key", "n")
    rows = _mixed_regions(rows, known)
    return rows.select("set_key", "root").distinct()


def _third_pairs(dense: DataFrame, sets: DataFrame) -> DataFrame:
    """Every pair of different components of ``dense`` that can be similar: none is missed.

    Two similar sets share one of their rarest shingles (as many as may differ,
    and one), and the first shared one leaves enough behind it in both. The
    component with most rows of a shingle meets the others, not itself.
    """
    rows = sets.join(dense, "set_key").withColumn("n", F.size("hashes"))
    rows = rows.select("set_key", "root", "n", F.explode("hashes").alias("h"))
    # shingles of one class alone are its rarest ones: they take the first places and are left behind
    often = rows.groupBy("h").agg(F.count("*").alias("often")).filter("often > 1")
    of_set = Window.partitionBy("set_key")
    place = F.row_number().over(of_set.orderBy("often", "h")) + F.col("n") - F.count("*").over(of_set)
    rows = rows.join(often, "h").withColumn("place", place)
    rows = rows.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
    rows = stored(rows.select("h", "set_key", "root", "n", "place"), "rare")
    most = rows.groupBy("h", "root").agg(F.count("*").alias("rows")).groupBy("h")
    most = most.agg(F.max_by("root", "rows").alias("most"), F.count("*").alias("roots")).filter("roots > 1")
    rows = stored(rows.join(most.select("h", "most"), "h"), "rare")
    left = rows.filter("root <> most").drop("most")
    right = rows.select("h", *[F.col(c).alias(f"{c}_b") for c in ("set_key", "root", "n", "place")])
    enough = (1 + F.least(F.expr("n - place"), F.expr("n_b - place_b"))) * (100 + PERCENT)
    met = left.join(right, "h").filter((F.col("root") != F.col("root_b")) & (enough >= PERCENT * F.expr("n + n_b")))
    met = met.filter(_sizes_allow("n", "n_b"))
    return met.select(F.least("set_key", "set_key_b").alias("a"), F.greatest("set_key", "set_key_b").alias("b")).distinct()


def _judged(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, set_key, and text_key and root (of its component)."""
    tables = Written(docs.sparkSession)
    labelled = tables.put("labelled", _signed(docs))
    signed = tables.put("signed", labelled.drop("labels"))
    classes = signed.filter(F.col("set_key").isNotNull()).groupBy("set_key")
    classes = classes.agg(
        F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.first("n").alias("n")
    )
    classes = tables.put("classes", classes)
    signatures = labelled.filter(F.col("set_key").isNotNull()).groupBy("set_key")
    signatures = signatures.agg(F.first("n").alias("n"), F.first("labels").alias("labels"))
    prefix = F.substring("label", 1, LEAST * UNIT)
    crowd = tables.put("crowd", _crowd(signatures)).withColumn("prefix", prefix)
    tables.drop("labelled")
    needed = tables.put(
        "needed",
        classes.select("set_key", "text_key").join(crowd.select("set_key").distinct(), "set_key", "left_semi"),
    )
    sets = tables.put("sets", _sets(docs, needed))
    links = tables.put("first", confirmed(_first_pairs(crowd), sets))
    known = components(links)
    mixed = tables.put("mixed", _mixed_regions(crowd, known))
    more = tables.put("second", confirmed(_second_pairs(mixed, tables), sets))
    if more.limit(1).count():
        links = links.union(more)
        known = components(links)
    dense = tables.put("dense", _dense(mixed, known))
    if dense.limit(1).count():
        more = tables.put("third", confirmed(_third_pairs(dense, sets), sets))
        if more.limit(1).count():
            known = components(links.union(more))
    tables.drop("crowd", "needed", "sets", "first", "mixed", "neighbours", "second", "dense")
    ids = classes.select("set_key", "first_id").join(known.withColumnRenamed("node", "set_key"), "set_key", "left")
    ids = ids.select("set_key", "first_id", F.coalesce("root", "set_key").alias("root"))
    lowest = ids.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = ids.join(lowest, "root").select("set_key", "component_id", "root")
    rows = signed.select("doc_id", F.col("n").alias("n_shingles"), "set_key", "text_key").join(ids, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "set_key",
        "text_key",
        "root",
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, set_key."""
    return _judged(docs).drop("text_key", "root")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, of one document of each component: one with its smallest id.

    A document is an id and a text, so neither a repeated id nor the null id takes
    other texts with it. Of different texts with the smallest id one stays. A
    document given in several rows stays in all of them, if it has an id: a null id
    names no document, so of its rows with one text one stays. Documents without
    words all stay.
    """
    rows = _judged(docs).filter(F.col("set_key").isNotNull())
    rows = rows.groupBy("doc_id", "text_key").agg(F.first("kept").alias("kept"), F.first("root").alias("root"))
    rows = stored(rows, "judged")
    chosen = rows.filter("kept").groupBy("root").agg(F.min("text_key").alias("__key"), F.first("doc_id").alias("__id"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("text_key") == F.col("__key"))
    found = rows.join(chosen, same, "left_anti").select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    # the same plan at every size
    found = stored(found, "dropped").hint("merge")
    doc_id, text = docs["doc_id"].cast("bigint"), docs["text"].cast("string")
    left = docs.join(found, doc_id.eqNullSafe(found["__id"]) & (F.xxhash64(text) == found["__key"]), "left_anti")
    words = F.coalesce(F.translate("text", " \t\n\x0b\x0c\r", ""), F.lit("")) != ""
    nameless = left.filter(F.col("doc_id").isNull() & words)
    place = F.row_number().over(Window.partitionBy("text").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])))
    nameless = nameless.withColumn("__place", place).filter("__place = 1").drop("__place")
    return left.filter(F.col("doc_id").isNotNull() | ~words).unionByName(nameless)
