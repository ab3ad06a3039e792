"""Exploratory aggregates over the common table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import result_label, share_of_wins
from ..functions.columns import count_wins


def match_sizes(df: DataFrame) -> DataFrame:
    """Rows per match."""
    return df.groupBy(*S.MATCH_KEY).agg(F.count("*").alias("participants"))


# 2^20 words of 64 bits: a filter of at most 2^20 rows, whatever the number of keys
FILTER_LOG2 = 20


def possibly_in(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys``, and a few others: those whose hash meets the hash of such a key.

    The hashes of ``keys`` set bits in words that are broadcast, so the rows stay where they
    are. It only saves shuffling rows; a join that decides exactly has to follow. More keys
    than bits let more rows through.
    """
    hashed = F.xxhash64(*on)
    word, bit = F.shiftrightunsigned(hashed, 64 - FILTER_LOG2), hashed.bitwiseAND(F.lit(63)).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    words = (
        keys.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(one).alias("_bits"))
    )
    met = (word == F.col("_word")) & (F.getbit("_bits", bit) == 1)
    return df.join(F.broadcast(words), met, "left_semi")


def complete_matches(df: DataFrame, group_size: int = 10) -> DataFrame:
    """Rows of matches with exactly ``group_size`` rows; null match keys drop out.

    The sizes are counted with a map-side combine. Most rows of other matches are
    dropped in place by hash, so wide rows that are not wanted are not shuffled. The
    join that drops the rest is one whose large partitions the engine splits, so there
    is no list of ids with too many rows and no limit on their number.
    """
    keyed = df.filter(F.col("data_source").isNotNull() & F.col("match_id").isNotNull())
    complete = match_sizes(keyed).filter(F.col("participants") == group_size).select(*S.MATCH_KEY)
    return possibly_in(keyed, complete, S.MATCH_KEY).join(complete, S.MATCH_KEY, "left_semi")


def standard_positions(df: DataFrame, positions: Sequence[str] = S.STANDARD_POSITIONS) -> DataFrame:
    return df.filter(F.col("team_position").isin(*positions))


def participants_histogram(df: DataFrame) -> DataFrame:
    """How many matches have how many rows, per source."""
    return (
        match_sizes(df)
        .groupBy("data_source", "participants")
        .agg(F.count("*").alias("matches"))
        .orderBy(F.col("data_source").asc_nulls_last(), "participants")
    )


def _averages(*names: str) -> list[Column]:
    return [F.avg(n).alias(f"avg_{n}") for n in names]


_RATES = ("kda", "damage_per_min", "gold_per_min", "vision_per_min")


def _overview(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count_distinct("match_id").alias("matches"),
        F.count_distinct("puuid").alias("players"),
        F.count_distinct("champion_name").alias("champions"),
        F.avg("game_duration_min").alias("avg_game_duration_min"),
    )


def source_overview(df: DataFrame) -> DataFrame:
    """Volume of every source."""
    return _overview(df, ["data_source"]).orderBy(F.desc("rows"), "data_source")


def source_overview_approx(df: DataFrame, rsd: float = 0.02) -> DataFrame:
    """The same with sketched distinct counts: one exchange of a few sketches."""
    return df.groupBy("data_source").agg(
        F.count("*").alias("rows"),
        *[
            F.approx_count_distinct(c, rsd).alias(out)
            for c, out in (("match_id", "matches"), ("puuid", "players"), ("champion_name", "champions"))
        ],
        F.avg("game_duration_min").alias("avg_game_duration_min"),
    )


# 2^12 registers; the relative standard deviation of an estimate is about 1.04 / sqrt(2^12)
SKETCH_LOG2 = 12
SKETCH_RSD = 0.0163


def distinct_sketches(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and one HyperLogLog sketch per column for each key: a few kilobytes that can be stored and merged.

    Texts, integers and binary columns; nulls do not count.
    """
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"), *[F.hll_sketch_agg(c, SKETCH_LOG2).alias(c) for c in columns]
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys from stored ones; the table they came from is not read."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), *[F.hll_union_agg(c).alias(c) for c in columns]
    )


def sketched_counts(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Estimated distinct values in place of the sketches."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})


def tier_overview(df: DataFrame) -> DataFrame:
    return _overview(df, ["source_tier"]).orderBy(F.desc("matches"), "source_tier")


def complete_volume(df: DataFrame) -> DataFrame:
    """Rows and matches per source of complete matches."""
    return (
        df.groupBy("data_source")
        .agg(F.count("*").alias("rows"), F.count_distinct("match_id").alias("full_matches"))
        .orderBy(F.desc("rows"), "data_source")
    )


def role_stats(df: DataFrame) -> DataFrame:
    """Average measures per source and position."""
    return (
        df.groupBy("data_source", "team_position")
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct("match_id").alias("matches"),
            *_averages(*_RATES),
        )
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("data_source", "team_position")])
    )


def role_stats_single(df: DataFrame) -> DataFrame:
    """Average measures per position of one source, strongest damage first."""
    return (
        df.groupBy("team_position")
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct("match_id").alias("matches"),
            F.count_distinct("puuid").alias("players"),
            *_averages(*_RATES),
        )
        .orderBy(F.desc_nulls_last("avg_damage_per_min"), "team_position")
    )


_RESULT_MEASURES = (*_RATES, "kills", "deaths", "assists")


def result_stats(df: DataFrame) -> DataFrame:
    """Winners against losers per source; rows without an outcome read as losses."""
    return (
        df.groupBy("data_source", "win")
        .agg(F.count("*").alias("rows"), *_averages(*_RESULT_MEASURES))
        .withColumn("result", result_label("win"))
        .orderBy(F.col("data_source").asc_nulls_last(), F.col("win").asc_nulls_last())
    )


def result_stats_single(df: DataFrame) -> DataFrame:
    """Winners against losers of one source; rows without an outcome drop out."""
    return (
        df.filter(F.col("win").isNotNull())
        .groupBy("win")
        .agg(F.count("*").alias("rows"), *_averages(*_RESULT_MEASURES))
        .withColumn("result", result_label("win", keep_null=True))
        .orderBy("win")
    )


def champion_stats(df: DataFrame) -> DataFrame:
    """Games (distinct matches), wins, win rate and averages per source and champion."""
    return (
        df.groupBy("data_source", "champion_name")
        .agg(
            F.count_distinct("match_id").alias("games"),
            count_wins("win").alias("wins"),
            share_of_wins("win").alias("winrate"),
            *_averages(*_RATES),
        )
        .orderBy(
            F.col("data_source").asc_nulls_last(),
            F.desc("games"),
            F.col("champion_name").asc_nulls_last(),
        )
    )


def champion_filtered(
    df: DataFrame, min_games: Mapping[str, int] | None = None
) -> DataFrame:
    """Champions with enough games for their source; sources without a threshold drop out."""
    limits = S.MIN_GAMES_BY_SOURCE if min_games is None else min_games
    limit = F.try_element_at(
        F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("data_source")
    )
    return (
        champion_stats(df)
        .filter(F.col("games") >= limit)
        .orderBy(
            "data_source", F.desc_nulls_last("winrate"), F.desc("games"),
            F.col("champion_name").asc_nulls_last(),
        )
    )


def champion_stats_single(df: DataFrame, min_games: int = 10) -> DataFrame:
    """One source: the mean outcome skips rows without one."""
    won = F.col("win").cast("int")
    return (
        df.filter(F.col("champion_name").isNotNull())
        .groupBy("champion_name")
        .agg(
            F.count_distinct("match_id").alias("games"),
            F.coalesce(F.sum(won), F.lit(0)).alias("wins"),
            F.avg(won.cast("double")).alias("winrate"),
            *_averages(*_RATES),
        )
        .filter(F.col("games") >= min_games)
        .orderBy(F.desc_nulls_last("winrate"), F.desc("games"), "champion_name")
    )


def popular_champions(df: DataFrame, top: int = 20) -> DataFrame:
    """The most played champions of one source."""
    return (
        champion_stats_single(df, 0)
        .select("champion_name", "games")
        .orderBy(F.desc("games"), "champion_name")
        .limit(top)
    )


def champion_stats_percent(df: DataFrame) -> DataFrame:
    """Games as filled rows and the win rate in percent."""
    return (
        df.filter(F.col("champion_name").isNotNull())
        .groupBy("champion_name")
        .agg(
            F.count("match_id").alias("games"),
            (F.avg(F.col("win").cast("int").cast("double")) * 100).alias("winrate"),
            *_averages("kda", "damage_per_min", "gold_per_min"),
        )
        .orderBy(F.desc("games"), "champion_name")
    )


def tier_stats(df: DataFrame) -> DataFrame:
    """Volume, averages and win rate per tier."""
    return df.groupBy("source_tier").agg(
        F.count_distinct("match_id").alias("matches"),
        F.count_distinct("puuid").alias("players"),
        *_averages("kda", "damage_per_min", "gold_per_min"),
        F.avg(F.col("win").cast("int").cast("double")).alias("winrate"),
    ).orderBy(F.col("source_tier").asc_nulls_last())


def tier_role_stats(df: DataFrame) -> DataFrame:
    return (
        df.groupBy("source_tier", "team_position")
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct("match_id").alias("matches"),
            *_averages(*_RATES),
        )
        .orderBy(*[F.col(c).asc_nulls_last() for c in ("source_tier", "team_position")])
    )


def matches_per(df: DataFrame, key: Column | str, name: str) -> DataFrame:
    """Distinct matches per value of a key (tier, source, patch), most first."""
    key = F.col(key) if isinstance(key, str) else key
    return (
        df.select(key.alias(name), "match_id")
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count_distinct("match_id").alias("matches"))
        .orderBy(F.desc("matches"), name)
    )


def popular_by_source(df: DataFrame, top: int = 15) -> DataFrame:
    """Most played champions of every source; names break ties.

    The window runs over aggregated rows, cut to ``top`` per partition before
    the shuffle on the source.
    """
    order = W.partitionBy("data_source").orderBy(
        F.desc("games"), F.col("champion_name").asc_nulls_last()
    )
    return (
        champion_stats(df)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= top)
        .drop("_rank")
        .orderBy("data_source", F.desc("games"), "champion_name")
    )


def role_source_pivot(stats: DataFrame, metric: str, sources: Sequence[str]) -> DataFrame:
    """One metric of ``role_stats`` as a table of positions by sources."""
    return (
        stats.groupBy("team_position")
        .pivot("data_source", list(sources))
        .agg(F.first(metric, ignorenulls=True))
        .orderBy("team_position")
    )
