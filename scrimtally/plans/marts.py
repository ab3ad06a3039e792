"""Statistical marts over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import RU, Labels, duration_bucket, ratio, verdict, wilson_bounds
from ..functions.columns import count_wins

# Rows or games below which a win rate is not listed.
MIN_PURCHASES = 10
MIN_GAMES = 5


def with_interval(df: DataFrame, labels: Labels | None = None) -> DataFrame:
    """Add win rate, Wilson bounds and, with labels, the verdict to wins and games."""
    low, high = wilson_bounds("winrate", "games")
    out = df.withColumn("winrate", ratio("wins", "games")).withColumns(
        {"wilson_low": low, "wilson_high": high}
    )
    return out.withColumn("verdict", verdict("wilson_low", "wilson_high", labels)) if labels else out


def item_stats(
    bridge: DataFrame,
    fact: DataFrame,
    dim_item: DataFrame,
    min_purchases: int = MIN_PURCHASES,
) -> DataFrame:
    """Purchases, win rate and Wilson lower bound per source and item.

    Facts are counted per participant key before the join, so every bridge row
    meets at most one row. A key on many fact rows gives the same totals as
    the row-by-row join without its product of rows, and a hot key of the
    bridge can be split over tasks. Names join after the items are aggregated.
    """
    outcome = fact.groupBy(*S.PARTICIPANT_KEY).agg(
        F.count("*").alias("copies"), count_wins("win").alias("won")
    )
    per_item = (
        bridge.join(outcome, S.PARTICIPANT_KEY)
        .groupBy("data_source", "item_id")
        .agg(F.sum("copies").alias("purchases"), F.sum("won").alias("won"))
    )
    named = per_item.join(dim_item.select("item_id", "item_name", "gold_total"), "item_id", "left")
    low, _ = wilson_bounds("winrate", "purchases")
    return (
        named.filter(F.col("purchases") >= min_purchases)
        .select(
            "data_source",
            F.coalesce("item_name", F.col("item_id").cast("string")).alias("item_name"),
            "item_id",
            "gold_total",
            "purchases",
            ratio("won", "purchases").alias("winrate"),
        )
        .withColumn("wilson_low", low)
        .orderBy(F.desc("purchases"), "data_source", "item_id")
    )


def champion_games(fact: DataFrame, dim_champion: DataFrame, keys: Sequence[str], *extra: Column):
    """Distinct matches and wins per group of champion facts.

    The join repeats facts of an id with two names, as the dimension does.
    """
    names = dim_champion.select("champion_id", "champion_name", "primary_class")
    return (
        fact.join(names, "champion_id")
        .groupBy(*keys)
        .agg(
            F.count_distinct("match_id").alias("games"), count_wins("win").alias("wins"), *extra
        )
    )


def champion_strength(
    fact: DataFrame, dim_champion: DataFrame, min_games: int = MIN_GAMES, labels: Labels = RU
) -> DataFrame:
    """Which champions win significantly more or less than half of their games?"""
    narrow = fact.select("data_source", "match_id", "champion_id", "win")
    games = champion_games(
        narrow, dim_champion, ["data_source", "champion_name", "primary_class"]
    ).filter(F.col("games") >= min_games)
    return with_interval(games, labels).orderBy(
        "data_source", F.desc_nulls_last("wilson_low"), "champion_name", "primary_class"
    )


def per_champion_rows(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and wins per champion id and further keys, ready to be named."""
    return fact.groupBy("champion_id", *keys).agg(
        F.count("*").alias("games"), count_wins("win").alias("wins")
    )


def named(per_id: DataFrame, dim_champion: DataFrame) -> DataFrame:
    """Add name and class to rows that are already aggregated per champion id."""
    return per_id.join(
        dim_champion.select("champion_id", "champion_name", "primary_class"), "champion_id"
    )


def champion_by_duration(
    fact: DataFrame, dim_champion: DataFrame, dim_match: DataFrame, labels: Labels = RU
) -> DataFrame:
    """Rows and win rate per champion and duration of the match.

    Facts shrink to champion ids and buckets before they meet the dimension.
    """
    buckets = dim_match.select(
        *S.MATCH_KEY, duration_bucket("game_duration_min", labels).alias("duration_bucket")
    )
    narrow = fact.select(*S.MATCH_KEY, "champion_id", "win")
    counted = per_champion_rows(
        narrow.join(buckets, S.MATCH_KEY), ["data_source", "duration_bucket"]
    )
    keys = ["data_source", "champion_name", "primary_class", "duration_bucket"]
    return (
        named(counted, dim_champion)
        .groupBy(*keys)
        .agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"))
        .select(*keys, "games", ratio("wins", "games").alias("winrate"))
        .orderBy(*[F.col(k).asc_nulls_last() for k in keys])
    )
