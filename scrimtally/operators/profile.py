"""Table profiles: counts, nulls, exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import Window as W

# accuracy of sketches: their ranks are off by one in this many at most
ACCURACY = 10_000
# values that a sketch reports inside a bracket
GRID = 1000
# a column of so many values is one bracket; a larger table gets one more pass
SMALL, LARGE = 20_000, 100_000_000


def value_counts(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """Rows per value, most frequent first."""
    src = df.filter(F.col(column).isNotNull()) if dropna else df
    return (
        src.groupBy(column)
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), F.col(column).asc_nulls_last())
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, most first; one pass over the table."""
    columns = list(columns or df.columns)
    kinds = dict(df.dtypes)
    counters = []
    for c in columns:
        missing = F.col(c).isNull()
        if kinds[c] in ("double", "float"):
            missing = missing | F.isnan(c)
        counters.append(F.count_if(missing).alias(c))
    return (
        df.agg(*counters)
        .unpivot([], columns, "column", "nulls")
        .orderBy(F.desc("nulls"), "column")
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, filled and missing values."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    positions = F.create_map(
        *[F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)]
    )
    total = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    return (
        total.unpivot(["_rows"], df.columns, "column", "filled")
        .select(
            F.element_at(positions, F.col("column")).alias("position"),
            "column",
            F.element_at(types, F.col("column")).alias("type"),
            F.col("_rows").alias("rows"),
            "filled",
            (F.col("_rows") - F.col("filled")).alias("nulls"),
        )
        .orderBy("position")
    )


def distinct_counts(
    df: DataFrame, columns: Sequence[str], approximate: bool = False, rsd: float = 0.02
) -> DataFrame:
    """Distinct values per column, exact by default.

    Each column is de-duplicated on its own, which spreads one large column
    over all tasks and keeps small ones in the map-side combine.
    """
    if approximate:
        aggs = [F.approx_count_distinct(c, rsd).alias(c) for c in columns]
    else:
        aggs = [F.count_distinct(c).alias(c) for c in columns]
    return df.agg(*aggs)


def _clean(column: str) -> Column:
    """The column as double, without NaN."""
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def _moments(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict:
    """First pass: counts, moments, and for every probability two values around its quantile."""
    margin = 3.0 / ACCURACY
    around = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    aggs: list[Column] = []
    for c in columns:
        v = _clean(c)
        aggs += [
            F.count(v).alias(f"n_{c}"),
            F.avg(v).alias(f"mean_{c}"),
            F.stddev_samp(v).alias(f"std_{c}"),
            F.min(v).alias(f"min_{c}"),
            F.max(v).alias(f"max_{c}"),
            F.percentile_approx(v, around, ACCURACY).alias(f"around_{c}"),
        ]
    return df.agg(*aggs).first().asDict()


class _Bracket:
    """Ranks of one column that are looked for between two values of it."""

    def __init__(self, column: str, ranks: list[int], low: float, high: float):
        self.column, self.ranks, self.low, self.high = column, ranks, low, high

    def below(self) -> Column:
        return F.count_if(_clean(self.column) < self.low)

    def inside(self) -> Column:
        v = _clean(self.column)
        return F.when(v.between(self.low, self.high), v)


def _narrowed(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Second pass, for large tables: a sketch of what is inside a bracket cuts it to a few thousandths."""
    grid = [i / GRID for i in range(GRID + 1)]
    aggs = []
    for i, b in enumerate(brackets):
        inside = b.inside()
        aggs += [
            b.below().alias(f"below_{i}"),
            F.count(inside).alias(f"inside_{i}"),
            F.percentile_approx(inside, grid, ACCURACY).alias(f"grid_{i}"),
        ]
    found = df.agg(*aggs).first().asDict()
    for i, b in enumerate(brackets):
        size, values = found[f"inside_{i}"], found[f"grid_{i}"]
        first, last = ((r - found[f"below_{i}"]) / size * GRID for r in (b.ranks[0], b.ranks[-1]))
        # one step for the sketch's error, one for rounding
        b.low = values[max(math.floor(first) - 2, 0)]
        b.high = values[min(math.ceil(last) + 2, GRID)]


def _selected(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    """Last pass: the values inside each bracket with their counts, and how many rows lie below it."""
    rows = Observation()
    counted = df.observe(rows, *[b.below().alias(f"below_{i}") for i, b in enumerate(brackets)])
    inside = [F.struct(F.lit(i).alias("bracket"), b.inside().alias("v")) for i, b in enumerate(brackets)]
    any_inside = reduce(lambda x, y: x | y, [b.inside().isNotNull() for b in brackets])
    values = (
        counted.filter(any_inside)
        .select(F.explode(F.filter(F.array(*inside), lambda x: x["v"].isNotNull())).alias("x"))
        .groupBy("x.bracket", "x.v")
        .agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(W.partitionBy("bracket").orderBy("v")))
        .persist()
    )
    try:
        values.count()
        below = rows.get
        places = [
            F.struct(F.lit(i).alias("bracket"), F.lit(r).cast("bigint").alias("rank"),
                     F.lit(r - below[f"below_{i}"]).cast("bigint").alias("place"))
            for i, b in enumerate(brackets) for r in b.ranks
        ]
        wanted = F.filter(F.array(*places), lambda x: (x["bracket"] == F.col("bracket"))
                          & (x["place"] >= F.col("upto") - F.col("n")) & (x["place"] < F.col("upto")))
        hits = values.select("v", F.explode(wanted).alias("x")).select("v", "x.bracket", "x.rank").collect()
        return {(brackets[h["bracket"]].column, h["rank"]): h["v"] for h in hits}
    finally:
        values.unpersist()


def _order_statistics(
    df: DataFrame, wanted: dict[str, list[list[int]]], stats: dict
) -> dict[tuple[str, int], float]:
    """Values at the wanted 0-based ranks of each column, exactly, in two passes at most.

    A sketch's error is bounded, so the values around a quantile that the first
    pass has found enclose its ranks. Tables of up to ``SMALL`` values are
    enclosed by their ends; in larger ones a second pass narrows the brackets.
    What the last pass sorts is a few millionths of the table.
    """
    brackets = []
    for c, groups in wanted.items():
        for i, ranks in enumerate(groups):
            small = stats[f"n_{c}"] <= SMALL
            low, high = (stats[f"min_{c}"], stats[f"max_{c}"]) if small else stats[f"around_{c}"][2 * i : 2 * i + 2]
            brackets.append(_Bracket(c, ranks, low, high))
    if not brackets:
        return {}
    if max(stats[f"n_{c}"] for c in wanted) > LARGE:
        _narrowed(df, brackets)
    found = _selected(df, brackets)
    lost = {(b.column, r) for b in brackets for r in b.ranks} - set(found)
    if lost:
        raise RuntimeError(f"a quantile lies outside of its bracket: {sorted(lost)}")
    return found


def _interpolate(low: float, high: float, part: float) -> float:
    return low if low == high or part == 0 else low + (high - low) * part


def describe(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """count, mean, std, min, exact quantiles (linear interpolation) and max per column.

    Runs its scans when called, three at most (two up to ``LARGE`` values),
    whatever the values are; the driver sees a few numbers per column only.
    """
    narrow = df.select(*columns)
    stats = _moments(narrow, columns, probs)
    wanted: dict[str, list[list[int]]] = {}
    for c in columns:
        n = stats[f"n_{c}"]
        places = [(n - 1) * p for p in probs] if n else []
        wanted[c] = [sorted({math.floor(k), math.ceil(k)}) for k in places]
    values = _order_statistics(narrow, wanted, stats)

    rows = []
    for c in columns:
        n = stats[f"n_{c}"]
        quantiles = []
        for p in probs:
            if not n:
                quantiles.append(None)
                continue
            k = (n - 1) * p
            low, high = values[(c, math.floor(k))], values[(c, math.ceil(k))]
            quantiles.append(_interpolate(low, high, k - math.floor(k)))
        rows.append(
            (c, n, stats[f"mean_{c}"], stats[f"std_{c}"], stats[f"min_{c}"], *quantiles,
             stats[f"max_{c}"])
        )
    names = ", ".join(f"p{round(p * 100):d} double" for p in probs)
    return df.sparkSession.createDataFrame(
        rows,
        f"metric string, count bigint, mean double, std double, min double, {names}, max double",
    )
