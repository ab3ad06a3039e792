"""Shards by fixed virtual slots.

Records hash into a fixed number of virtual slots; bytes are summed per slot; a
versioned map says which shard holds which slot. A record's virtual slot (the one
of its n-th repetition, where rows are equal) never changes, so a rebalance edits the map and moves whole slots, never single rows.
Shard sizes are near equal in bytes: the map packs the largest slots first, and
an edit moves slots from the fullest shard to the emptiest one.

Only the slot table (``SLOTS`` rows at most) reaches the driver. A record's
position within its shard is the number of records in the shard's earlier
virtual slots plus its rank in its own slot, so no task holds a shard.

Cases: a null text counts 0 bytes plus the overhead and has the CRC of no bytes;
a null id hashes like any other value; repeated rows spread over the virtual
slots by their number among equal rows; of a long text only its size and checksum
are moved; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import documents, stored

SLOTS = 4096
# equal rows that one task numbers at a time
BLOCK = 1 << 16
OVERHEAD = 8


def record_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint")


def slot_sizes(records: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot; counted before the shuffle, so hot slots cost nothing."""
    return records.groupBy("virtual_slot").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows")
    )


class SlotMap:
    """A version of the slot-to-shard map."""

    def __init__(self, shard_of: dict[int, int], shards: int, version: int = 0):
        self.shard_of, self.shards, self.version = shard_of, shards, version

    @classmethod
    def packed(cls, sizes: Iterable[tuple[int, int]], shards: int) -> SlotMap:
        """The first version: slots by falling size, each to the shard with the fewest bytes."""
        load = [(0, shard) for shard in range(shards)]
        shard_of = {}
        for slot, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
            filled, shard = heapq.heappop(load)
            shard_of[slot] = shard
            heapq.heappush(load, (filled + size, shard))
        return cls(shard_of, shards)

    def edited(
        self, sizes: Iterable[tuple[int, int]], shards: int | None = None, tolerance: float = 0.01
    ) -> SlotMap:
        """The next version for new sizes or more shards; moves as little as it can.

        Slots go one by one from the fullest shard to the emptiest, as long as
        the two differ by more than ``tolerance`` of the mean and a slot fits
        into half of the gap. New slots go to the emptiest shard first.
        """
        shards = shards or self.shards
        if shards < self.shards:
            raise ValueError("a map only grows")
        size_of = dict(sizes)
        shard_of = dict(self.shard_of)
        load = [0] * shards
        held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
        for slot, size in sorted(size_of.items(), key=lambda x: (-x[1], x[0])):
            shard = shard_of.setdefault(slot, min(range(shards), key=lambda s: (load[s], s)))
            load[shard] += size
            held[shard].append((size, slot))
        gap = tolerance * sum(load) / shards
        while True:
            full = max(range(shards), key=lambda s: (load[s], -s))
            empty = min(range(shards), key=lambda s: (load[s], s))
            fits = [x for x in held[full] if 0 < 2 * x[0] <= load[full] - load[empty]]
            if load[full] - load[empty] <= gap or not fits:
                return SlotMap(shard_of, shards, self.version + 1)
            size, slot = max(fits)
            held[full].remove((size, slot))
            held[empty].append((size, slot))
            load[full] -= size
            load[empty] += size
            shard_of[slot] = empty

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(slot, shard, self.version, self.shards) for slot, shard in sorted(self.shard_of.items())]
        return spark.createDataFrame(rows, "virtual_slot int, shard int, map_version int, shards int")

    def save(self, spark: SparkSession, path: str) -> None:
        """Keep this version below ``path``; earlier versions stay."""
        self.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={self.version}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int) -> SlotMap:
        rows = spark.read.parquet(f"{path}/version={version}").collect()
        shard_of = {r.virtual_slot: r.shard for r in rows}
        return cls(shard_of, rows[0].shards if rows else 1, version)


def slotted(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Documents with size, checksum and virtual slot.

    Equal rows are counted first and numbered then, in blocks that are dealt to
    the tasks; the first one's slot depends on the record alone, the others' on
    the record and their number.
    """
    text = F.coalesce("text", F.lit(""))
    records = documents(docs).select(
        "doc_id",
        record_size(F.col("text")).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("doc_id", "text").alias("record"),
    )
    counted = records.groupBy("doc_id", "size", "text_crc32", "record").agg(F.count("*").alias("times"))
    single = counted.filter("times = 1").withColumn("number", F.lit(0).cast("bigint"))
    blocks = F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1, F.lit(BLOCK).cast("bigint"))
    several = counted.filter("times > 1").withColumn("start", F.explode(blocks))
    several = several.repartition("record", "start")
    end = F.least(F.col("start") + BLOCK, F.col("times")) - 1
    several = several.withColumn("number", F.explode(F.sequence("start", end))).drop("start")
    slot = F.when(F.col("number") == 0, F.pmod("record", F.lit(slots)))
    slot = slot.otherwise(F.pmod(F.xxhash64("record", "number"), F.lit(slots))).cast("int")
    return single.unionByName(several).select("doc_id", "size", "text_crc32", slot.alias("virtual_slot"))


def collected_sizes(records: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows): at most one row for each virtual slot."""
    return [(r.virtual_slot, r.bytes, r.rows) for r in slot_sizes(records).collect()]


def assign(docs: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """Every document with its shard and its position there (law ``bytes``)."""
    spark = docs.sparkSession
    records = stored(slotted(docs, slots), "sharding")
    sizes = collected_sizes(records)
    slot_map = SlotMap.packed([(slot, size) for slot, size, _ in sizes], shards)
    before, taken = [], [0] * shards
    for slot, _, rows in sorted(sizes):
        shard = slot_map.shard_of[slot]
        before.append((slot, shard, taken[shard], slot_map.version))
        taken[shard] += rows
    placed = spark.createDataFrame(
        before, "virtual_slot int, shard int, first bigint, map_version int"
    )
    # one row for each virtual slot: a fixed bound
    ranked = records.withColumn(
        "rank",
        F.row_number().over(
            Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
        ),
    )
    return ranked.join(F.broadcast(placed), "virtual_slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )
