"""Exact top-k search by distributed histogram selection.

Every pass scores all queries against all candidates, block by block. The first
passes only keep a histogram of each query's scores: Spark sums the histograms
of all blocks, the bin that holds the k-th best score becomes the query's next
range, and the passes end when a bin is a single integer. The last pass keeps
the scores from the k-th value on; ties go to smaller ids.

A block needs to report no bin below its own k-th best score, because the k-th
best score of all cannot be lower; so a block sends at most k bins a query and,
in the last pass, at most k scores a query, however many copies a vector has.

Queries (a stated set) meet candidates in blocks of bounded size on the key
(query block, candidate block). Both are packed once and written.

Cases: vectors that are null, or hold a null or a non-finite component, and rows
without an id take no part; a vector is compared with those of its own length;
repeated rows are candidates each, and a query leaves out only its own row;
fewer candidates than k give fewer rows; an empty table gives an empty result;
further columns are ignored. Scores beyond 2^53 are summed with exact integers;
a score of 2^61 or more is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scrimtally.llm.base import stored

CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 1024
BINS = 512
LIMIT = 2**61


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * component) as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _packed(rows: DataFrame, block_rows: int, n: int, name: str) -> DataFrame:
    """Rows (rid, vec_id, v) as numbered blocks of one vector length."""
    blocks = max(1, math.ceil(n / block_rows))

    def pack(batches):
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len), sort=True):
                for at in range(0, len(part), block_rows):
                    piece = part.iloc[at : at + block_rows]
                    matrix = np.array(piece["v"].tolist(), dtype=np.int64).reshape(len(piece), dim)
                    yield pd.DataFrame(
                        {
                            "dim": [dim],
                            "rids": [piece["rid"].to_numpy(np.int64).tobytes()],
                            "ids": [piece["vec_id"].to_numpy(np.int64).tobytes()],
                            "matrix": [matrix.tobytes()],
                        }
                    )

    packed = rows.repartition(blocks).mapInPandas(pack, "dim int, rids binary, ids binary, matrix binary")
    return stored(packed.withColumn("block", F.monotonically_increasing_id()), name)


def _product(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    reach = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if reach < 2**53:
        # every partial sum is an integer that a double holds exactly
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    if reach < LIMIT:
        return queries @ candidates.T
    exact = queries.astype(object) @ candidates.astype(object).T
    if exact.size and max(abs(int(x)) for x in exact.flat) >= LIMIT:
        raise OverflowError("a score is too large")
    return exact.astype(np.int64)


def _block_scores(left: pd.DataFrame, right: pd.DataFrame):
    """Scores of a block of queries against a block of candidates in the order of their ids.

    Returns the block of queries, its row ids, the candidates' row ids and ids,
    the scores, and a mask that is False for a query's own row.
    """
    q, c = left.iloc[0], right.iloc[0]
    q_rid, c_rid, c_id = (np.frombuffer(x, np.int64) for x in (q["rids"], c["rids"], c["ids"]))
    order = np.lexsort((c_rid, c_id))
    q_mat = np.frombuffer(q["matrix"], np.int64).reshape(len(q_rid), q["dim"])
    c_mat = np.frombuffer(c["matrix"], np.int64).reshape(len(c_rid), c["dim"])[order]
    c_rid, c_id = c_rid[order], c_id[order]
    scores = _product(q_mat, c_mat)
    return q, q_rid, c_rid, c_id, scores, q_rid[:, None] != c_rid[None, :]


def _best(scores: np.ndarray, other: np.ndarray, low: int, k: int) -> np.ndarray:
    """Places of the k best scores of one query from ``low`` on; ties by place."""
    at = np.flatnonzero(other & (scores >= low))
    if len(at) > k:
        kth = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= kth]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _lows(q: pd.Series, q_rid: np.ndarray, start: int) -> np.ndarray:
    """The lower end of each query's range; ``start`` in the first pass."""
    if "lows" not in q or q["lows"] is None:
        return np.full(len(q_rid), start, np.int64)
    known = dict(zip(q["range_rids"], q["lows"], strict=True))
    return np.array([known.get(rid, start) for rid in q_rid.tolist()], np.int64)


def _histograms(left: DataFrame, right: DataFrame, start: int, width: int, bins: int, k: int):
    """(qb, rid, bin, count) over all blocks; bin ``bins`` holds what lies above the range."""

    def count(left_block, right_block):
        if not len(left_block) or not len(right_block):
            return pd.DataFrame({"qb": [], "rid": [], "bin": [], "n": []}).astype("int64")
        q, q_rid, _, _, scores, other = _block_scores(left_block, right_block)
        lows, rows = _lows(q, q_rid, start), []
        for i, rid in enumerate(q_rid.tolist()):
            low = int(lows[i])
            top = scores[i][_best(scores[i], other[i], low, k)]
            found, n = np.unique(np.minimum((top - low) // width, bins), return_counts=True)
            rows += [(q["qb"], rid, b, c) for b, c in zip(found.tolist(), n.tolist(), strict=True)]
        return pd.DataFrame(rows, columns=["qb", "rid", "bin", "n"]).astype("int64")

    found = _met(left, right, count, "qb bigint, rid bigint, bin bigint, n bigint")
    return found.groupBy("qb", "rid", "bin").agg(F.sum("n").alias("n"))


def _met(left: DataFrame, right: DataFrame, function, schema: str) -> DataFrame:
    both = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
    return both.applyInPandas(function, schema)


def _kth_bin(histogram: DataFrame, start: int, width: int, k: int) -> DataFrame:
    """Per block of queries: each query's range from the bin that holds its k-th best score.

    A query with fewer than k candidates keeps the whole range.
    """
    from_top = Window.partitionBy("rid").orderBy(F.desc("bin"))
    reached = histogram.withColumn("above", F.sum("n").over(from_top))
    kth = reached.groupBy("qb", "rid").agg(F.max(F.when(F.col("above") >= k, F.col("bin"))).alias("bin"))
    return kth.select("qb", "rid", "bin", F.lit(width).alias("width"), F.lit(start).alias("start"))


def _ranged(left: DataFrame, kth: DataFrame, before: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Queries with their new ranges; also the ranges themselves, written."""
    low = F.coalesce("low", F.col("start")) if before is not None else F.col("start")
    known = kth if before is None else kth.join(before.select("rid", "low"), "rid", "left")
    new = known.select(
        "qb", "rid", F.when(F.col("bin").isNull(), F.col("start")).otherwise(low + F.col("bin") * F.col("width")).alias("low")
    )
    new = stored(new, "ranges")
    # one entry for each query of a block
    entries = F.array_sort(F.collect_list(F.struct("rid", "low")))
    packed = new.groupBy("qb").agg(entries.alias("e"))
    packed = packed.select("qb", F.col("e.rid").alias("range_rids"), F.col("e.low").alias("lows"))
    return left.join(packed, "qb", "left"), new


def _from_kth(left: DataFrame, right: DataFrame, start: int, k: int) -> DataFrame:
    """The scores of each block from the query's k-th value on, k a query at most."""
    schema = "query_id bigint, rid bigint, vec_id bigint, crid bigint, score bigint"
    names = [x.split()[0] for x in schema.split(", ")]

    def keep(left_block, right_block):
        rows = []
        if len(left_block) and len(right_block):
            q, q_rid, c_rid, c_id, scores, other = _block_scores(left_block, right_block)
            lows, q_id = _lows(q, q_rid, start), np.frombuffer(q["ids"], np.int64)
            for i in range(len(q_rid)):
                for at in _best(scores[i], other[i], int(lows[i]), k):
                    rows.append((q_id[i], q_rid[i], c_id[at], c_rid[at], scores[i][at]))
        return pd.DataFrame(rows, columns=names).astype("int64")

    return _met(left, right, keep, schema)


def top_k(
    vectors: DataFrame,
    k: int,
    is_query: Column,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    bins: int = BINS,
) -> DataFrame:
    """The k best candidates of each query: query_id, rank, vec_id, score."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), vector.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.select(
        F.monotonically_increasing_id().alias("rid"), "vec_id", quantised(F.col("v"), scale).alias("v")
    )
    base = stored(rows, "vectors")
    asked = base.filter(F.coalesce(is_query, F.lit(False)))
    square = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    n, n_asked, longest = base.agg(
        F.count("*"), F.count_if(F.coalesce(is_query, F.lit(False))), F.max(square)
    ).first()
    candidates = _packed(base, CANDIDATE_BLOCK, n, "candidates")
    queries = _packed(asked, QUERY_BLOCK, n_asked, "queries")
    pairs = queries.select(F.col("block").alias("qb"), "dim").join(
        candidates.select(F.col("block").alias("cb"), "dim"), "dim"
    )
    left = queries.withColumnRenamed("block", "qb").join(pairs.drop("dim"), "qb")
    right = candidates.withColumnRenamed("block", "cb").join(pairs.drop("dim"), "cb")

    # |score| <= the longest vector's square, by Cauchy and Schwarz
    start = -min(int(longest or 0) + 1, LIMIT)
    width = 1
    while width * bins < 1 - 2 * start:
        width *= bins
    ranged, ranges = left, None
    while True:
        histogram = _histograms(ranged, right, start, width, bins, k)
        ranged, ranges = _ranged(left, _kth_bin(histogram, start, width, k), ranges)
        if width == 1:
            break
        width //= bins
    kept = _from_kth(ranged, right, start, k)
    best = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id", "crid")
    return (
        kept.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
