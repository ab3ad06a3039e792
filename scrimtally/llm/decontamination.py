"""Documents that hold passages of a benchmark, by SimHash over item-sized windows.

Only DataFrame functions are used. Words end at ASCII white space and A-Z are
lower-cased; a shingle is five successive words, or a whole item of fewer words.
For an item of m words every window of m words of a document, or the whole text
of a shorter one, is judged by the weighted Jaccard similarity of both multisets
of shingles (weight: how often a shingle occurs), which must reach 0.75:

1. Positions of a document whose shingle occurs in any item are its anchors. A
   window can only reach the similarity if 6/7 of its shingles are anchors
   (more of a shorter text), so all other windows go before they are
   fingerprinted. This loses nothing.
2. Windows of equal content are fingerprinted once: 64-bit SimHash over their
   shingles. Fingerprints are cut into RADIUS + 1 blocks; of two fingerprints
   within the radius at least one block is equal, so joining on (size, block,
   value) finds every item of that size within the radius.
3. Candidates are verified on the shingles themselves.

At similarity 0.75 two fingerprints differ by 11 bits with a deviation of 3, so
the radius of 23 is four deviations away.

Cases: null and empty texts, texts shorter than a shingle, and items without
words, match nothing; repeated rows and items give one row for each pair of ids;
items of one id or without an id are judged one by one; empty tables give an empty
result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimtally.llm.base import UPPER, columns, documents, passing, stored

SHINGLE = 5
PERCENT = 75
BITS = 64
RADIUS = 23
# bits of the constant that tells shingles of no item apart before they are exploded
MAP = 1 << 19
SPACES = "\t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    # one plain character to split at takes no regular expression
    even = F.translate(text, UPPER + SPACES, UPPER.lower() + " " * len(SPACES))
    return F.array_remove(F.split(even, " "), "")


def shingles_of(words: Column, size: int) -> Column:
    """Hashes of the shingles in order; none where there are fewer words."""
    # each word is hashed once; hashes of shifted copies are folded together
    n = F.greatest(F.size(words) - (size - 1), F.lit(0))
    hashed = F.transform(words, lambda w: F.xxhash64(w))
    folded = F.slice(hashed, 1, n) if size > 1 else hashed
    for k in range(1, size):
        folded = F.zip_with(folded, F.slice(hashed, k + 1, n), lambda a, b: F.xxhash64(a, b))
    return folded


def _bitmap(values: DataFrame, key: str) -> Column:
    """A constant of MAP bits as longs: one bit for each hash in ``values``; at most MAP / 64 rows are collected."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(key).bitwiseAND(F.lit(63)).cast("int"))
    slot = F.pmod(F.shiftright(key, 6), F.lit(MAP // 64)).cast("int")
    rows = values.groupBy(slot.alias("slot")).agg(F.bit_or(bit).alias("bits")).collect()
    found = {r.slot: r.bits for r in rows}
    text = "[" + ",".join(str(found.get(i, 0)) for i in range(MAP // 64)) + "]"
    return F.from_json(F.lit(text), "array<bigint>")


def _may_hold(bitmap: Column, h: Column) -> Column:
    word = F.get(bitmap, F.pmod(F.shiftright(h, 6), F.lit(MAP // 64)).cast("int"))
    return F.getbit(word, h.bitwiseAND(F.lit(63)).cast("int")) == 1


def _least_shared(n: Column, m: Column) -> Column:
    """Of n shingles against m: how many must be shared for the similarity."""
    return F.ceil((n + m) * PERCENT / (100 + PERCENT)).cast("int")


def simhash(rows: DataFrame, keys: list[str], shingles: str) -> DataFrame:
    """One 64-bit fingerprint for each key: the sign of the sum of its shingles' bits."""
    exploded = rows.select(*keys, F.explode(shingles).alias("h"))
    bit = [F.shiftrightunsigned("h", b).bitwiseAND(F.lit(1)) for b in range(BITS)]
    sums = exploded.groupBy(*keys).agg(
        F.count("*").alias("n"), *[F.sum(bit[b]).alias(f"b{b}") for b in range(BITS)]
    )
    on = [F.when(2 * F.col(f"b{b}") > F.col("n"), F.shiftleft(F.lit(1).cast("bigint"), b)).otherwise(0) for b in range(BITS)]
    return sums.select(*keys, reduce(lambda x, y: x.bitwiseOR(y), on).alias("fingerprint"))


def blocks(fingerprint: Column, count: int = RADIUS + 1) -> Column:
    """(number, value) of each of the blocks that a fingerprint is cut into."""
    edges = [BITS * b // count for b in range(count + 1)]
    cut = [
        F.struct(
            F.lit(b).alias("block"),
            F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"),
        )
        for b, (low, high) in enumerate(zip(edges, edges[1:], strict=False))
    ]
    return F.explode(F.array(*cut))


def shared_weight(a: Column, b: Column) -> Column:
    """Size of the intersection of two multisets."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))

    def times(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x))

    each = F.transform(F.array_intersect(a, b), lambda x: F.least(times(a, x), times(b, x)))
    counted = F.aggregate(each, F.lit(0), lambda total, n: total + n)
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def _windows(texts: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """(key, doc_id, m, start, window, shingles) of the windows that enough anchors allow."""
    known = stored(items.select(F.explode("shingles").alias("h")).distinct(), "grams")
    # words as a column of their own: inlined, every use would split the text again
    bitmap = _bitmap(known, "h")
    hashed = texts.select("key", words_of(F.col("text")).alias("words"))
    hashed = hashed.select("key", shingles_of(F.col("words"), size).alias("all"))
    placed = F.transform("all", lambda h, at: F.struct(at.alias("at"), h.alias("h")))
    placed = F.filter(placed, lambda x: _may_hold(bitmap, x["h"]))
    placed = hashed.select("key", F.size("all").alias("n"), placed.alias("placed"))
    # the plain explode puts a test of its size before the shingling, which then runs twice
    placed = placed.select("key", "n", F.explode_outer("placed").alias("x")).filter("x IS NOT NULL")
    anchors = placed.select("key", "n", "x.at", "x.h").join(known, "h")
    anchors = anchors.groupBy("key", "n").agg(F.array_sort(F.collect_set("at")).alias("anchors"))
    # distinct lengths of the items
    lengths = sorted(r.m for r in items.select("m").distinct().collect())
    if not lengths:
        lengths = [0]
    spots = anchors.select("key", "n", "anchors", F.posexplode("anchors").alias("i", "at"))
    spots = spots.withColumn("m", F.explode(F.array(*[F.lit(m) for m in lengths])))
    # a text shorter than an item is one window as a whole
    whole = F.col("m") - (size - 1)
    spots = spots.withColumn("w", F.least(whole, F.col("n"))).withColumn("c", _least_shared(F.col("w"), whole))
    last = F.try_element_at("anchors", F.col("i") + F.col("c"))
    before = F.when(F.col("i") > 0, F.try_element_at("anchors", F.greatest(F.col("i"), F.lit(1)))).otherwise(-1)
    spots = spots.withColumn("last", last).filter(F.col("last").isNotNull() & (F.col("last") <= F.col("at") + F.col("w") - 1))
    # the anchor is the first one of its windows: they start behind the anchor before it
    low = F.greatest(before + 1, F.col("last") - F.col("w") + 1, F.lit(0))
    high = F.least(F.col("at"), F.col("n") - F.col("w"))
    spots = spots.withColumn("low", low).withColumn("high", high).filter("low <= high")
    starts = spots.select("key", "m", F.explode(F.sequence("low", "high")).alias("start"))
    chosen = starts.groupBy("key").agg(F.collect_list(F.struct("m", "start")).alias("chosen"))
    # only texts with a window left are read as a whole and moved
    chosen = stored(chosen, "chosen")
    held = passing(texts, "key", chosen).join(chosen, "key").dropDuplicates(["key", "doc_id"])
    met = held.select("key", "doc_id", "chosen", words_of(F.col("text")).alias("words"))
    met = met.select("key", "doc_id", "chosen", shingles_of(F.col("words"), size).alias("all"))
    cut = F.transform(
        "chosen",
        lambda x: F.struct(
            x["m"].alias("m"), x["start"].alias("start"), F.slice("all", x["start"] + 1, x["m"] - (size - 1)).alias("s")
        ),
    )
    found = met.select("key", "doc_id", F.explode(cut).alias("x"))
    return found.select(
        "key", "doc_id", "x.m", "x.start", F.xxhash64("x.s").alias("window"), F.col("x.s").alias("shingles")
    )


def _found(texts: DataFrame, items: DataFrame, size: int) -> DataFrame:
    """(key, doc_id, item_id, start, m, similarity) for the items of one shingle size."""
    windows = stored(_windows(texts, items, size), "windows")
    distinct = windows.groupBy("m", "window").agg(F.first("shingles").alias("shingles"))
    distinct = stored(distinct, "distinct")
    of_windows = simhash(distinct, ["m", "window"], "shingles")
    # items are told apart by their words: ids may repeat or be null
    asked = items.groupBy("m", "item").agg(F.first("shingles").alias("of_item"))
    of_items = simhash(asked, ["m", "item"], "of_item").withColumnRenamed("fingerprint", "wanted")
    left = of_windows.select("m", "window", "fingerprint", blocks(F.col("fingerprint")).alias("b"))
    right = of_items.select("m", "item", "wanted", blocks(F.col("wanted")).alias("b"))
    left = left.select("m", "window", "fingerprint", "b.block", "b.value")
    right = right.select("m", "item", "wanted", "b.block", "b.value")
    near = left.join(right, ["m", "block", "value"])
    near = near.filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("wanted"))) <= RADIUS)
    near = near.select("m", "window", "item").distinct()
    met = near.join(distinct, ["m", "window"]).join(asked, ["m", "item"])
    met = met.withColumn("shared", shared_weight(F.col("shingles"), F.col("of_item")))
    total = F.size("shingles") + F.size("of_item") - F.col("shared")
    good = met.filter(100 * F.col("shared") >= PERCENT * total)
    good = good.select("m", "window", "item", (F.col("shared") / total).alias("similarity"))
    good = good.join(items.select("m", "item", "item_id").distinct(), ["m", "item"])
    return windows.select("key", "doc_id", "m", "start", "window").join(good, ["m", "window"]).select(
        "key", "doc_id", "item_id", "start", "m", "similarity"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return documents(docs).filter("text IS NOT NULL").withColumn("key", F.xxhash64("doc_id", "text"))


def _passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, doc_id, item_id, start, m, similarity) of all windows found; key is that of the id and the text."""
    items = columns(benchmark, (("item_id", "bigint"), ("text", "string"))).distinct()
    items = items.select("item_id", words_of(F.col("text")).alias("words"))
    items = items.withColumn("m", F.size("words")).filter("m > 0")
    items = stored(items.withColumn("k", F.least(F.col("m"), F.lit(SHINGLE))), "items")
    texts, found = _keyed(docs), None
    # five, and the sizes of shorter items
    for size in sorted({SHINGLE, *[r.k for r in items.select("k").distinct().collect()]}):
        own = items.filter(F.col("k") == size).select(
            "item_id", "m", F.xxhash64("words").alias("item"), shingles_of(F.col("words"), size).alias("shingles")
        )
        part = _found(texts, stored(own, "shingles"), size)
        found = part if found is None else found.unionByName(part)
    return found


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document and item that it holds: doc_id, item_id, similarity, windows, first_word."""
    return _passages(docs, benchmark).groupBy("doc_id", "item_id").agg(
        F.max("similarity").alias("similarity"),
        F.countDistinct("start", "m").alias("windows"),
        F.min("start").alias("first_word"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that hold no passage.

    A row is judged by its id and its text: other texts with the same or with a null id stay.
    """
    found = _passages(docs, benchmark).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    # the same plan at every size
    found = stored(found, "contaminated").hint("merge")
    doc_id, text = docs["doc_id"].cast("bigint"), docs["text"].cast("string")
    key = F.xxhash64(doc_id, text)
    return docs.join(found, doc_id.eqNullSafe(found["__id"]) & (key == found["__key"]), "left_anti")
