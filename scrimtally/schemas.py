"""Declared schemas of documents, tables and logs."""

from __future__ import annotations

from pyspark.sql import types as T

_SHORT = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "ts": T.TimestampNTZType(),
}


def _struct(spec: str) -> T.StructType:
    """``"a int, b string"`` to a nullable StructType."""
    fields = []
    for part in spec.replace("\n", " ").split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _SHORT[kind]))
    return T.StructType(fields)


ITEM_SLOTS = [f"item{i}" for i in range(7)]

# ---- nested documents -------------------------------------------------------

CHALLENGES = _struct("kda double, killParticipation double")

PARTICIPANT = T.StructType(
    _struct(
        """participantId bigint, puuid string, summonerId string, summonerName string,
        riotIdGameName string, riotIdTagline string, summonerLevel int, championId bigint,
        championName string, teamId int, win boolean, teamPosition string,
        individualPosition string, lane string, role string, kills int, deaths int,
        assists int, goldEarned bigint, goldSpent bigint,
        totalDamageDealtToChampions bigint, totalDamageTaken bigint,
        damageSelfMitigated bigint, totalMinionsKilled int, neutralMinionsKilled int,
        visionScore int, wardsPlaced int, wardsKilled int, detectorWardsPlaced int,
        dragonKills int, baronKills int, turretKills int, doubleKills int,
        tripleKills int, quadraKills int, pentaKills int"""
    ).fields
    + [T.StructField("challenges", CHALLENGES)]
    + [T.StructField(slot, T.LongType()) for slot in ITEM_SLOTS]
)

MATCH_INFO = T.StructType(
    _struct(
        """gameCreation bigint, gameStartTimestamp bigint, gameEndTimestamp bigint,
        gameDuration bigint, gameMode string, gameType string, gameVersion string,
        mapId int, platformId string, queueId int"""
    ).fields
    + [T.StructField("participants", T.ArrayType(PARTICIPANT))]
)

MATCH_DOCUMENT = T.StructType(
    [
        T.StructField("metadata", _struct("matchId string")),
        T.StructField("info", MATCH_INFO),
    ]
)

RAW_MATCHES = _struct("match_id string, _raw_json string")

LEAGUE_DOCUMENT = T.StructType(
    _struct("leagueId string, name string").fields
    + [
        T.StructField(
            "entries",
            T.ArrayType(
                _struct(
                    """summonerId string, puuid string, leaguePoints int, rank string,
                    wins int, losses int, veteran boolean, inactive boolean,
                    freshBlood boolean, hotStreak boolean"""
                )
            ),
        )
    ]
)

_TAGS = T.StructField("tags", T.ArrayType(T.StringType()))

CHAMPION_DOCUMENT = T.StructType(
    [
        T.StructField(
            "data",
            T.MapType(
                T.StringType(),
                T.StructType(_struct("key string, name string, title string").fields + [_TAGS]),
            ),
        )
    ]
)

ITEM_DOCUMENT = T.StructType(
    [
        T.StructField(
            "data",
            T.MapType(
                T.StringType(),
                T.StructType(
                    [
                        T.StructField("name", T.StringType()),
                        T.StructField("gold", _struct("total bigint, purchasable boolean")),
                        _TAGS,
                    ]
                ),
            ),
        )
    ]
)

# ---- flat tables ------------------------------------------------------------

CHAMPIONS_REF = _struct("champion_id bigint, champion_name string, title string, tags string")
ITEMS_REF = _struct(
    "item_id bigint, item_name string, gold_total bigint, purchasable boolean, tags string"
)

DOWNLOAD_LOG = _struct(
    """match_id string, source_puuid string, source_tier string, status string,
    error string, collected_at_utc string"""
)

# The common table: one row per participant of a match, every source alike.
COMMON = T.StructType(
    _struct(
        """data_source string, match_id string, source_tier string, game_start_utc ts,
        game_duration_sec bigint, game_duration_min double, game_mode string,
        game_type string, game_version string, map_id int, platform_id string,
        queue_id int, participant_id bigint, puuid string, summoner_id string,
        summoner_name string, summoner_level int, champion_id bigint,
        champion_name string, team_id int, win boolean, team_position string,
        individual_position string, lane string, role string, kills int, deaths int,
        assists int, kda double, gold_earned bigint, gold_spent bigint,
        gold_per_min double, total_damage_dealt_to_champions bigint,
        damage_per_min double, riot_id_game_name string, total_minions_killed int,
        cs_per_min double, total_damage_taken bigint, vision_score int,
        vision_per_min double, wards_placed int, wards_killed int, dragon_kills int,
        baron_kills int"""
    ).fields
    + [T.StructField(slot, T.LongType()) for slot in ITEM_SLOTS]
)

# Columns of the second, tabular source under its own names.
TABULAR_COLUMNS = """game_id game_start_utc game_duration game_mode game_type game_version
    map_id platform_id queue_id participant_id puuid summoner_id summoner_name
    summoner_level champion_id champion_name team_id win team_position
    individual_position lane role kills deaths assists gold_earned gold_spent
    total_damage_dealt_to_champions total_damage_taken vision_score wards_placed
    wards_killed dragon_kills baron_kills""".split() + ITEM_SLOTS
TABULAR_RENAMES = {"game_id": "match_id", "game_duration": "game_duration_sec"}

MATCH_KEY = ["data_source", "match_id"]
PARTICIPANT_KEY = ["data_source", "match_id", "participant_id"]
STANDARD_POSITIONS = ["TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY"]
RANKED_QUEUE = 420

FACT_COLUMNS = """data_source match_id participant_id champion_id puuid role_key team_id win
    kills deaths assists kda gold_earned gold_per_min total_damage_dealt_to_champions
    damage_per_min vision_score vision_per_min total_minions_killed cs_per_min""".split()

STAR_TABLES = """fact_participant dim_champion dim_match dim_player dim_role
    fact_participant_item dim_item item_stats champion_strength
    champion_by_duration""".split()

# Games a champion needs per source before its win rate is listed.
MIN_GAMES_BY_SOURCE = {"kaggle": 30, "riot_api": 10}
