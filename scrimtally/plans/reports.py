"""Parameterised reports over the star tables.

Every report takes a mapping of star tables and typed parameters and returns a
DataFrame. Tables may be lazy frames or read from files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import (
    RU,
    Labels,
    display_name,
    patch_of,
    patch_sort_key,
    ratio,
    result_label,
    share_of_wins,
)
from ..functions.columns import count_wins
from . import marts

Tables = Mapping[str, DataFrame]

# Defaults of the report parameters.
MIN_GOLD = 2000
RANKING_GAMES = 30
PLAYER_GAMES = 20
SCALING_GAMES = 15
HEADLINE_SCALING_GAMES = 20
PATCH_MATCHES = 50
PATCH_GAMES = 30
FAVOURITE_GAMES = 3
TOP_PLAYERS = 50
EXTREMES = 12


def _of(t: Tables, table: str, source: str) -> DataFrame:
    return t[table].filter(F.col("data_source") == source)


# ---- overview ---------------------------------------------------------------


def kpis(t: Tables, source: str) -> DataFrame:
    """Rows, matches, players, champions and mean duration of one source."""
    minutes = _of(t, "dim_match", source).select(F.avg("game_duration_min")).scalar()
    return (
        _of(t, "fact_participant", source)
        .agg(
            F.count("*").alias("rows"),
            F.count_distinct("match_id").alias("matches"),
            F.count_distinct("puuid").alias("players"),
            F.count_distinct("champion_id").alias("champions"),
        )
        .withColumn("avg_duration_min", minutes)
    )


def top_champion(t: Tables, source: str, labels: Labels = RU) -> DataFrame:
    """The significantly strong champion with the best lower bound."""
    return (
        _of(t, "champion_strength", source)
        .filter(F.col("verdict") == labels.strong)
        .orderBy(F.desc("wilson_low"), "champion_name", "primary_class")
        .limit(1)
        .select("champion_name", "wilson_low", "games")
    )


def top_item(t: Tables, source: str, min_gold: int = MIN_GOLD) -> DataFrame:
    """The item with the best lower bound among the dear ones."""
    return (
        _of(t, "item_stats", source)
        .filter(F.col("gold_total") >= min_gold)
        .orderBy(F.desc("wilson_low"), "item_id")
        .limit(1)
        .select("item_name", "wilson_low", "purchases")
    )


def best_scaler(t: Tables, source: str, min_games: int = HEADLINE_SCALING_GAMES) -> DataFrame:
    """The champion that gains most from short to long matches, from the duration mart."""
    bucket = F.col("duration_bucket")

    def largest(prefix: str, value: str) -> Column:
        return F.max(F.when(bucket.startswith(prefix), F.col(value)))

    pivot = (
        _of(t, "champion_by_duration", source)
        .groupBy("champion_name")
        .agg(
            largest("1.", "winrate").alias("short"),
            largest("3.", "winrate").alias("long"),
            largest("1.", "games").alias("games_short"),
            largest("3.", "games").alias("games_long"),
        )
    )
    enough = (F.col("games_short") >= min_games) & (F.col("games_long") >= min_games)
    return (
        pivot.filter(enough)
        .select("champion_name", (F.col("long") - F.col("short")).alias("delta"))
        .orderBy(F.desc("delta"), "champion_name")
        .limit(1)
    )


def winners_vs_losers(t: Tables, source: str, labels: Labels = RU) -> DataFrame:
    averages = ("kda", "gold_per_min", "damage_per_min")
    return (
        _of(t, "fact_participant", source)
        .groupBy("win")
        .agg(*[F.avg(c).alias(f"avg_{c}") for c in averages])
        .orderBy(F.col("win").asc_nulls_last())
        .select(result_label("win", labels).alias("result"), *[f"avg_{c}" for c in averages])
    )


# ---- champions --------------------------------------------------------------


def champion_ranking(
    t: Tables,
    source: str,
    position: str | None = None,
    min_games: int = RANKING_GAMES,
    rank_by: str = "wilson",
    labels: Labels = RU,
) -> DataFrame:
    """Champions of a source, optionally of one position, by lower bound or raw win rate."""
    order = {"wilson": "wilson_low", "raw": "winrate"}[rank_by]
    facts = _of(t, "fact_participant", source)
    if position is not None:
        facts = facts.filter(F.col("role_key") == position)
    games = marts.champion_games(
        facts.select("match_id", "champion_id", "win", "kda"),
        t["dim_champion"],
        ["champion_name", "primary_class"],
        F.avg("kda").alias("avg_kda"),
    ).filter(F.col("games") >= min_games)
    return (
        marts.with_interval(games, labels.marked())
        .select(
            "champion_name", "primary_class", "games", "winrate",
            "wilson_low", "wilson_high", "avg_kda", "verdict",
        )
        .orderBy(F.desc_nulls_last(order), "champion_name", "primary_class")
    )


def strongest(ranking: DataFrame, labels: Labels = RU) -> DataFrame:
    """Significantly strong champions of a ranking."""
    return ranking.filter(F.col("verdict").contains(labels.strong))


def anomalies(ranking: DataFrame, labels: Labels = RU) -> DataFrame:
    """Champions of a ranking whose interval does not cover one half."""
    v = F.col("verdict")
    return ranking.filter(v.contains(labels.strong) | v.contains(labels.weak))


# ---- items ------------------------------------------------------------------


def item_popularity(t: Tables, source: str, min_gold: int = MIN_GOLD) -> DataFrame:
    """Purchases against win rate of the dear items, most bought first."""
    return (
        _of(t, "item_stats", source)
        .filter(F.col("gold_total") >= min_gold)
        .select("item_name", "purchases", "winrate", "wilson_low", "gold_total")
        .orderBy(F.desc("purchases"), "item_name", "gold_total")
    )


def best_item(popularity: DataFrame) -> DataFrame:
    """The item of a popularity report with the best lower bound."""
    return popularity.orderBy(F.desc_nulls_last("wilson_low"), "item_name", "gold_total").limit(1)


def items_by_winrate(popularity: DataFrame) -> DataFrame:
    return popularity.orderBy(F.desc_nulls_last("winrate"), "item_name", "gold_total")


# ---- players ----------------------------------------------------------------

_PLAYER_AVERAGES = {
    "avg_kda": "kda",
    "dmg_pm": "damage_per_min",
    "gold_pm": "gold_per_min",
    "cs_pm": "cs_per_min",
    "vis_pm": "vision_per_min",
    "k": "kills",
    "d": "deaths",
    "a": "assists",
}


def player_profiles(t: Tables, source: str, min_games: int = PLAYER_GAMES) -> DataFrame:
    """Games, win rate and averages of players with enough games.

    Facts shrink to players before the join; the dimension holds every
    (source, player) once.
    """
    per_player = (
        _of(t, "fact_participant", source)
        .filter(F.col("puuid").isNotNull())
        .groupBy("data_source", "puuid")
        .agg(
            F.count("*").alias("games"),
            share_of_wins("win").alias("winrate"),
            *[F.avg(c).alias(name) for name, c in _PLAYER_AVERAGES.items()],
        )
        .filter(F.col("games") >= min_games)
    )
    players = _of(t, "dim_player", source).select(
        "data_source", "puuid", "source_tier", F.col("riot_id_game_name").alias("name")
    )
    return (
        per_player.join(players, ["data_source", "puuid"])
        .select("name", "puuid", "source_tier", "games", "winrate", *_PLAYER_AVERAGES)
        .orderBy(F.desc("games"), "puuid")
    )


def player_labels(profiles: DataFrame) -> DataFrame:
    """Profiles with the name to show: the chosen name, else the start of the id."""
    return profiles.withColumn("label", display_name("name", "puuid"))


def top_players(t: Tables, source: str, n: int = TOP_PLAYERS, min_games: int = PLAYER_GAMES) -> DataFrame:
    """The players with most games, without their ids."""
    return (
        player_profiles(t, source, min_games)
        .orderBy(F.desc("games"), "puuid")
        .limit(n)
        .drop("puuid")
    )


def _of_player(t: Tables, source: str, puuid: str) -> DataFrame:
    return _of(t, "fact_participant", source).filter(F.col("puuid") == puuid)


def player_champions(t: Tables, source: str, puuid: str) -> DataFrame:
    """Champions of one player, most played first."""
    per_id = (
        _of_player(t, source, puuid)
        .groupBy("champion_id")
        .agg(
            F.count("*").alias("games"),
            count_wins("win").alias("wins"),
            F.sum("kda").alias("kda"),
            F.count("kda").alias("kda_rows"),
        )
    )
    return (
        marts.named(per_id, t["dim_champion"])
        .groupBy("champion_name")
        .agg(*[F.sum(c).alias(c) for c in ("games", "wins", "kda", "kda_rows")])
        .select(
            "champion_name",
            "games",
            ratio("wins", "games").alias("winrate"),
            ratio("kda", "kda_rows", on_zero="null").alias("avg_kda"),
        )
        .orderBy(F.desc("games"), "champion_name")
    )


def favourite_champion(champions: DataFrame, min_games: int = FAVOURITE_GAMES) -> DataFrame:
    """The most successful champion of a player among those played often enough."""
    return (
        champions.filter(F.col("games") >= min_games)
        .orderBy(F.desc("winrate"), F.desc("games"), "champion_name")
        .limit(1)
    )


def player_roles(t: Tables, source: str, puuid: str) -> DataFrame:
    """Roles of one player, most played first."""
    per_key = (
        _of_player(t, source, puuid)
        .groupBy("role_key")
        .agg(F.count("*").alias("games"), count_wins("win").alias("wins"))
    )
    return (
        per_key.join(t["dim_role"], "role_key")
        .groupBy(F.col("role_name_ru").alias("role"))
        .agg(F.sum("games").alias("games"), F.sum("wins").alias("wins"))
        .select("role", "games", ratio("wins", "games").alias("winrate"))
        .orderBy(F.desc("games"), "role")
    )


# ---- duration and patches ---------------------------------------------------


def _two_sided(
    rows: DataFrame,
    keys: list[str],
    side: str,
    first: object,
    second: object,
    names: tuple[str, str],
    min_games: int,
) -> DataFrame:
    """Win rates of two sides of each group, their difference and both sizes."""
    a, b = names

    def total(value: str, which: object) -> Column:
        return F.sum(F.when(F.col(side) == which, F.col(value)))

    sums = rows.groupBy(*keys).agg(
        total("games", first).alias(f"g_{a}"),
        total("games", second).alias(f"g_{b}"),
        total("wins", first).alias(f"w_{a}"),
        total("wins", second).alias(f"w_{b}"),
    )
    enough = (F.col(f"g_{a}") >= min_games) & (F.col(f"g_{b}") >= min_games)
    rate_a, rate_b = ratio(f"w_{a}", f"g_{a}"), ratio(f"w_{b}", f"g_{b}")
    return (
        sums.filter(enough)
        .select(
            *keys,
            rate_a.alias(f"wr_{a}"),
            rate_b.alias(f"wr_{b}"),
            (rate_b - rate_a).alias("delta"),
            f"g_{a}",
            f"g_{b}",
        )
        .orderBy(F.desc("delta"), *keys)
    )


def scaling(t: Tables, source: str, min_games: int = SCALING_GAMES) -> DataFrame:
    """Win rate in long minus win rate in short matches per champion.

    Medium matches are dropped before the join; a missing duration counts as long.
    """
    minutes = F.col("game_duration_min")
    side = F.when(minutes < 25, "short").when(minutes < 32, "mid").otherwise("long")
    matches = (
        _of(t, "dim_match", source)
        .select(*S.MATCH_KEY, side.alias("side"))
        .filter(F.col("side") != "mid")
    )
    facts = _of(t, "fact_participant", source).select(*S.MATCH_KEY, "champion_id", "win")
    counted = marts.per_champion_rows(facts.join(matches, S.MATCH_KEY), ["side"])
    rows = marts.named(counted, t["dim_champion"])
    return _two_sided(
        rows, ["champion_name"], "side", "short", "long", ("short", "long"), min_games
    )


def extremes(deltas: DataFrame, k: int = EXTREMES) -> DataFrame:
    """The k largest and the k smallest differences; fewer than 2k rows repeat."""
    names = [c for c in ("champion_name", "primary_class") if c in deltas.columns]
    top = deltas.orderBy(F.desc("delta"), *names).limit(k)
    bottom = deltas.orderBy(F.asc("delta"), *[F.desc(c) for c in names]).limit(k)
    return top.unionByName(bottom)


def best_and_worst(deltas: DataFrame) -> DataFrame:
    """Name and difference of the first and of the last row of a comparison."""
    # of equal differences the first name leads and the last name trails
    names = deltas.groupBy("delta").agg(
        F.min("champion_name").alias("lead"), F.max("champion_name").alias("trail")
    )
    return names.agg(
        F.max_by("lead", "delta").alias("best_name"),
        F.max("delta").alias("best_delta"),
        F.min_by("trail", "delta").alias("worst_name"),
        F.min("delta").alias("worst_delta"),
    )


def patches(t: Tables, source: str, min_matches: int = PATCH_MATCHES) -> DataFrame:
    """Patches of a source with enough matches, in numeric order."""
    return (
        _of(t, "dim_match", source)
        .filter(F.col("game_version").isNotNull())
        .groupBy(patch_of("game_version").alias("patch"))
        .agg(F.count("*").alias("matches"))
        .filter((F.col("matches") >= min_matches) & ~F.col("patch").isin("", "."))
        .orderBy(patch_sort_key("patch"), "patch")
    )


def latest_patches(t: Tables, source: str, min_matches: int = PATCH_MATCHES) -> tuple[str, str] | None:
    """The last two patches of a source, older first; None if there are fewer."""
    last = (
        patches(t, source, min_matches)
        .orderBy(patch_sort_key("patch").desc_nulls_last(), F.desc("patch"))
        .limit(2)
        .collect()
    )
    return (last[1]["patch"], last[0]["patch"]) if len(last) == 2 else None


def patch_shift(
    t: Tables, source: str, a: str, b: str, min_games: int = PATCH_GAMES
) -> DataFrame:
    """Win rate on patch ``b`` minus win rate on patch ``a`` per champion."""
    matches = (
        _of(t, "dim_match", source)
        .select(*S.MATCH_KEY, patch_of("game_version").alias("patch"))
        .filter(F.col("patch").isin(a, b))
    )
    facts = _of(t, "fact_participant", source).select(*S.MATCH_KEY, "champion_id", "win")
    counted = marts.per_champion_rows(facts.join(matches, S.MATCH_KEY), ["patch"])
    rows = marts.named(counted, t["dim_champion"])
    return _two_sided(
        rows, ["champion_name", "primary_class"], "patch", a, b, ("a", "b"), min_games
    )


def latest_patch_shift(
    t: Tables, source: str, min_matches: int = PATCH_MATCHES, min_games: int = PATCH_GAMES
) -> DataFrame | None:
    """The shift between the last two patches, or None if there are fewer than two."""
    pair = latest_patches(t, source, min_matches)
    return patch_shift(t, source, *pair, min_games) if pair else None


# ---- joins with named dimensions --------------------------------------------


def class_winrate(t: Tables, source: str) -> DataFrame:
    """Games, win rate and averages per champion class."""
    names = t["dim_champion"].select("champion_id", "primary_class")
    return (
        _of(t, "fact_participant", source)
        .select("match_id", "champion_id", "win", "kda", "damage_per_min")
        .join(names, "champion_id")
        .groupBy(F.col("primary_class").alias("champion_class"))
        .agg(
            F.count_distinct("match_id").alias("games"),
            share_of_wins("win").alias("winrate"),
            F.avg("kda").alias("avg_kda"),
            F.avg("damage_per_min").alias("avg_damage_per_min"),
        )
        .orderBy(F.desc("winrate"), "champion_class")
    )


def role_named_stats(t: Tables, source: str, labels: Labels = RU) -> DataFrame:
    """Averages per named role, without the undefined one."""
    measures = ("gold_per_min", "damage_per_min", "vision_per_min")
    per_key = (
        _of(t, "fact_participant", source)
        .groupBy("role_key")
        .agg(
            F.count("*").alias("rows"),
            *[F.sum(m).alias(f"sum_{m}") for m in measures],
            *[F.count(m).alias(f"n_{m}") for m in measures],
        )
    )
    roles = t["dim_role"].filter(F.col("role_name_ru") != labels.role_default)
    return (
        per_key.join(roles, "role_key")
        .groupBy(F.col("role_name_ru").alias("role"))
        .agg(
            F.sum("rows").alias("rows"),
            *[
                ratio(F.sum(f"sum_{m}"), F.sum(f"n_{m}"), on_zero="null").alias(f"avg_{m}")
                for m in measures
            ],
        )
        .orderBy(F.desc_nulls_last("avg_gold_per_min"), "role")
    )
