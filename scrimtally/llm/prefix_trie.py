"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node is a distinct sequence of first turns. It is named by a chain of SHA-256
digests (128 bits) over role and text, so a node knows its parent's name, and
equal prefixes meet by a plain aggregation with a map-side combine.

Totals flow from children to parents. In time-forward processing the nodes are
sorted by reverse level order, every node takes the messages addressed to it from
a priority queue, and puts one for its parent into it; the queue spills. That is
done within shards, and then across the shards' roots:

* Round r takes the nodes with more than SHARD^(r-1) and at most SHARD^r members.
  Along a path these are neighbours, so they form subtrees, the shards of the
  round. A shard has at most SHARD nodes on a level, however hot its first turn.
* The totals of a shard's root are messages to its parent, which belongs to a
  later round. They are added up per parent before that round reads them.

The number of rounds is the logarithm of the number of conversations to the base
SHARD: four for 60 billion. Each round writes its totals; a lost executor repeats
a part of one round. The queue's spill file has no name and belongs to one task.

A node's list of ends may be long (copies of one conversation), but it is hashed
as a stream: sorted runs of ids become pieces of text, and only those meet.

Cases: a null role or text counts as empty; a null turn comes first, equal turns
are ordered by role and text, repeated rows are turns of their own; rows without
a conv_id belong to no conversation and take no part; for a negative conv_id the
remainder is the one from 0 up; a conversation that is left without turns is a
member of the root; equal conversations end at one node; an empty table gives an
empty result; further columns are ignored. Texts are hashed one at a time, so
memory grows with the longest text, and a conversation may have any number of turns.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import columns, stored

SHARD = 512
BASE = 20
HEAD = 4
QUEUE = 100_000
ROOT = b"\0" * 16


class SpillingQueue:
    """A priority queue of (key, value) pairs that holds ``limit`` of them; sorted runs go to an unnamed file."""

    def __init__(self, limit: int = QUEUE):
        self.limit, self.heap, self.runs, self.file = limit, [], [], None

    def push(self, key: tuple, value: tuple) -> None:
        heapq.heappush(self.heap, (key, value))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        start = self.file.seek(0, 2)
        for entry in sorted(self.heap):
            pickle.dump(entry, self.file)
        self.heap = []
        self._advance(start, self.file.tell())

    def _advance(self, at: int, end: int) -> None:
        """Keep the run's next entry in memory."""
        if at < end:
            self.file.seek(at)
            entry = pickle.load(self.file)
            heapq.heappush(self.runs, (entry, self.file.tell(), end))

    def pop(self, key: tuple) -> Iterator[tuple]:
        """The values of all entries with this key, which must be the smallest one."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[1]
        while self.runs and self.runs[0][0][0] == key:
            entry, at, end = heapq.heappop(self.runs)
            self._advance(at, end)
            yield entry[1]


def head_size(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % HEAD


def _child(parent: bytes, role: str, text: str) -> bytes:
    parts = [x.encode("utf-8", "surrogatepass") for x in (role, text)]
    return hashlib.sha256(parent + len(parts[0]).to_bytes(8, "big") + parts[0] + parts[1]).digest()[:16]


def _words(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass").split())


class _Walk:
    """Rebuilds conversations from rows sorted by base, conversation and turn; one row of a path at a time."""

    def __init__(self):
        self.conv = self.base = None
        self.heads: list[tuple[str, str]] = []
        self.out: list[tuple] = []

    def row(self, base: int, conv: int, role: str, text: str) -> None:
        if conv != self.conv:
            self.close()
            self._open(base, conv)
        self.seen += 1
        if conv == base and self.seen < HEAD:
            self.heads.append((role, text))
        if conv == base or self.seen > self.skipped:
            self._step(role, text)

    def _open(self, base: int, conv: int) -> None:
        if base != self.base:
            self.base, self.heads = base, []
        self.conv, self.seen, self.depth, self.key = conv, 0, 0, ROOT
        self.last, self.skipped = None, head_size(conv)
        if conv != base:
            for role, text in self.heads[: self.skipped]:
                self._step(role, text)

    def _step(self, role: str, text: str) -> None:
        if self.last:
            self.out.append((*self.last, False))
        parent, self.key = self.key, _child(self.key, role, text)
        self.depth += 1
        self.last = (self.conv, self.depth, self.key, parent, _words(text))

    def close(self) -> None:
        """The conversation ends at its last turn, or at the root."""
        if self.conv is not None:
            self.out.append((*(self.last or (self.conv, 0, ROOT, None, 0)), True))
            self.conv = None


def paths(chats: DataFrame) -> DataFrame:
    """(conv_id, depth, key, parent, words, ends): the nodes on the path of every rebuilt conversation.

    The root is left out but where a conversation ends there.
    """
    types = (("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))
    rows = columns(chats, types).filter("conv_id IS NOT NULL").fillna("", ["role", "text"])
    rows = rows.withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(BASE)))
    rows = rows.repartition("base").sortWithinPartitions("base", "conv_id", "turn", "role", "text")
    names = ["conv_id", "depth", "key", "parent", "words", "ends"]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = _Walk()
        for batch in batches:
            for row in zip(batch["base"], batch["conv_id"], batch["role"], batch["text"], strict=True):
                walk.row(*row)
            yield pd.DataFrame(walk.out, columns=names)
            walk.out = []
        walk.close()
        yield pd.DataFrame(walk.out, columns=names)

    schema = "conv_id bigint, depth bigint, key binary, parent binary, words bigint, ends boolean"
    return rows.select("base", "conv_id", "role", "text").mapInPandas(build, schema)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id): the ids in order, joined by commas."""
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ends.repartitionByRange(parts, "key", "conv_id").sortWithinPartitions("key", "conv_id")

    def joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys = batch["key"].map(bytes)
            ids = batch["conv_id"].groupby((keys != keys.shift()).cumsum().to_numpy())
            first = ids.head(1).index
            yield pd.DataFrame({
                "key": batch["key"].loc[first].to_list(),
                "first": batch["conv_id"].loc[first].to_list(),
                "ids": ids.agg(lambda x: ",".join(map(str, x))).to_list(),
            })

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = digest = None
        for batch in batches:
            out = []
            for name, ids in zip(batch["key"], batch["ids"], strict=True):
                if bytes(name) != key:
                    if digest:
                        out.append((key, digest.hexdigest()))
                    key, digest = bytes(name), hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        if digest:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "ends_sha256"])

    runs = order.select("key", "conv_id").mapInPandas(joined, "key binary, first bigint, ids string")
    return runs.repartition("key").sortWithinPartitions("key", "first").mapInPandas(hashed, "key binary, ends_sha256 string")


def _round(nodes: DataFrame) -> DataFrame:
    """(key, parent, top, n_children, n_leaves, saved_tokens) of the nodes of whole shards.

    ``nodes`` has shard, depth, key, parent, own (its own saved tokens) and what
    earlier rounds send to it: n_children, n_leaves, saved_tokens.
    """
    names = ["key", "parent", "top", "n_children", "n_leaves", "saved_tokens"]

    def forward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, queue = None, SpillingQueue()
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, queue = row.shard, SpillingQueue()
                children, leaves, saved = row.n_children, row.n_leaves, row.saved_tokens + row.own
                for more in queue.pop((-row.depth, row.key)):
                    children, leaves, saved = children + 1, leaves + more[0], saved + more[1]
                leaves = leaves if children else 1
                top = row.key == row.shard
                if not top:
                    queue.push((1 - row.depth, row.parent), (leaves, saved))
                out.append((row.key, row.parent, top, children, leaves, saved))
            yield pd.DataFrame(out, columns=names)

    order = nodes.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "key")
    rows = order.select("shard", "depth", "key", "parent", "own", "n_children", "n_leaves", "saved_tokens")
    schema = "key binary, parent binary, top boolean, n_children bigint, n_leaves bigint, saved_tokens bigint"
    return rows.mapInPandas(forward, schema)


def _sharded(steps: DataFrame, nodes: DataFrame, shard: int) -> DataFrame:
    """``nodes`` with their round and the name of their shard's root."""
    total = nodes.agg(F.max("n_convs")).first()[0]
    rounds, most = F.lit(1), shard
    while most < total:
        rounds, most = rounds + (F.col("n_convs") > most).cast("int"), most * shard
    nodes = nodes.withColumn("round", rounds)
    known = nodes.select("key", "round", F.col("conv_id").alias("first_conv"))
    on_path = steps.filter("depth > 0").select("conv_id", "depth", "key").join(known, "key")
    segment = Window.partitionBy("conv_id", "round").orderBy("depth")
    top = on_path.withColumn("shard", F.first("key").over(segment)).filter("conv_id = first_conv")
    found = nodes.join(top.select("key", "shard"), "key", "left")
    # the root's round holds it and all nodes that start below it
    last = nodes.filter("depth = 0").select("round").first()[0]
    below_root = (F.col("round") == last) | (F.col("depth") == 0)
    return found.withColumn("shard", F.when(below_root, F.lit(ROOT)).otherwise(F.col("shard")))


def prefix_trie(chats: DataFrame, shard: int = SHARD) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    steps = stored(paths(chats), "paths")
    ends = steps.filter("ends").select("key", "conv_id")
    nodes = steps.filter("depth > 0").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"),
        F.first("depth").alias("depth"),
        F.first("parent").alias("parent"),
        F.first("words").alias("words"),
        F.count("*").alias("n_convs"),
    )
    # every conversation ends once
    root = ends.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("key"),
        "conv_id",
        F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("bigint").alias("words"),
        "n_convs",
    )
    nodes = stored(nodes.unionByName(root), "nodes")
    if not nodes.limit(1).count():
        return nodes.select(
            "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), "n_convs", F.col("n_convs").alias("n_children"),
            F.col("n_convs").alias("n_leaves"), F.col("n_convs").alias("saved_tokens"), F.lit("").alias("ends_sha256"),
        )
    own = ((F.col("n_convs") - 1) * F.col("words")).alias("own")
    shards = stored(_sharded(steps, nodes, shard).select("key", "depth", "parent", "round", "shard", own), "shards")
    sums = ["n_children", "n_leaves", "saved_tokens"]
    totals = sent = None
    for number in sorted(r["round"] for r in shards.select("round").distinct().collect()):
        rows = shards.filter(F.col("round") == number)
        if sent is None:
            rows = rows.withColumns({s: F.lit(0).cast("bigint") for s in sums})
        else:
            known = sent.groupBy("parent").agg(F.count("*").alias("n_children"), *[F.sum(s).alias(s) for s in sums[1:]])
            rows = rows.join(known.withColumnRenamed("parent", "key"), "key", "left").fillna(0, sums)
        done = stored(_round(rows), "totals")
        totals = done if totals is None else totals.unionByName(done)
        sent = totals.filter("top AND parent IS NOT NULL").select("parent", *sums[1:])
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals.select("key", *sums), "key")
        .join(above, "parent", "left")
        .join(end_digests(ends), "key", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            *sums,
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
