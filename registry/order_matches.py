"""Orders read as matches: the given tables in the common schema.

An order is a match, its line items are the participants, the order status is
the source. The Spark form and the SQL form are written separately, so that
each checks the other. Orders have 1 to 13 lines; a match is complete with
``GROUP_SIZE`` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimtally.functions import add_metrics, clean_role
from scrimtally.schemas import FACT_COLUMNS, ITEM_SLOTS
from scrimtally.session import scratch_dir
from scrimtally.sources import write_parquet

GROUP_SIZE = 4
SOURCES = ["F", "O", "P"]
ROLES = ["TOP", "JUNGLE", "MIDDLE", "BOTTOM", "UTILITY", "", "Invalid"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _unless(condition: Column, value: Column) -> Column:
    """Null where the condition holds."""
    return F.when(~condition, value)


def _item(slot: int) -> Column:
    part = F.col("l_partkey")
    code = (part * (slot + 1) + F.col("l_suppkey")) % 40
    return _unless((part + slot) % 6 == 0, code)


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as participants, roles and measures still raw."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    lines = table(spark, sf_dir, "lineitem").drop("l_shipdate", "l_tax", "l_returnflag")
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    order, part, supp = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    line = F.col("l_linenumber")
    champion = part % 30
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), line)
    month = F.month("o_orderdate").cast("string")
    return j.select(
        F.col("o_orderstatus").alias("data_source"),
        order.cast("string").alias("match_id"),
        F.col("o_orderpriority").alias("source_tier"),
        F.col("o_orderdate").alias("game_start_utc"),
        _unless(order % 211 == 0, 900 + (order * 7) % 1500).alias("game_duration_sec"),
        F.lit("CLASSIC").alias("game_mode"),
        F.lit("MATCHED").alias("game_type"),
        _unless(order % 307 == 0, F.concat(F.lit("16."), month, F.lit(".1.2"))).alias("game_version"),
        F.lit(11).alias("map_id"),
        F.lit("X1").alias("platform_id"),
        F.when(F.col("o_custkey") % 10 == 0, 450).otherwise(420).alias("queue_id"),
        (part * 16 + line).alias("participant_id"),
        _unless(part % 101 == 0, _text("player-", "l_suppkey")).alias("puuid"),
        _text("summoner-", "l_suppkey").alias("summoner_id"),
        _text("Summoner ", "l_suppkey").alias("summoner_name"),
        F.when(supp % 3 == 0, " ").otherwise(_text("Name", "l_suppkey")).alias("riot_id_game_name"),
        (supp % 400).cast("int").alias("summoner_level"),
        champion.alias("champion_id"),
        # one champion is spelled in two ways
        F.when((champion == 7) & (supp % 5 == 0), "CHAMPION 7")
        .otherwise(F.concat(F.lit("Champion "), champion.cast("string")))
        .alias("champion_name"),
        F.when(F.col("l_linestatus") == "O", 100).otherwise(200).alias("team_id"),
        _unless(part % 331 == 0, F.col("l_quantity") > 25).alias("win"),
        _unless(part % 23 == 0, role).alias("team_position"),
        F.when(supp % 4 == 0, "TOP").when(supp % 4 == 1, "Invalid").alias("individual_position"),
        F.lit("NONE").alias("lane"),
        F.lit("SOLO").alias("role"),
        _unless(part % 97 == 0, (part % 13).cast("int")).alias("kills"),
        (supp % 9).cast("int").alias("deaths"),
        ((part + supp) % 17).cast("int").alias("assists"),
        F.floor("l_extendedprice").alias("gold_earned"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("gold_spent"),
        ((part % 5000) * 7 + 100).alias("total_damage_dealt_to_champions"),
        ((supp % 700) * 31).alias("total_damage_taken"),
        ((supp * 3) % 60).cast("int").alias("vision_score"),
        F.when(F.col("o_orderstatus") == "P", ((part * 11) % 250).cast("int")).alias("total_minions_killed"),
        (part % 20).cast("int").alias("wards_placed"),
        (supp % 10).cast("int").alias("wards_killed"),
        (line % 3).cast("int").alias("dragon_kills"),
        (line % 2).cast("int").alias("baron_kills"),
        *[_item(i).alias(slot) for i, slot in enumerate(ITEM_SLOTS)],
    )


def derived_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Participants with clean roles and derived measures."""
    raw = participants(spark, sf_dir)
    return add_metrics(raw.withColumn("team_position", clean_role("team_position")))


_stored: dict[tuple[str, str], DataFrame] = {}


def store_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the common table of the given tables, laid out by source."""
    key = (spark.sparkContext.applicationId, sf_dir)
    _stored[key] = write_parquet(
        derived_common(spark, sf_dir),
        f"{scratch_dir(spark, 'common')}/all_matches_common.parquet",
        partition_by=["data_source"],
    )
    return _stored[key]


def common(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored common table; written once per application and input folder.

    Aggregates, the quality gate and the star read the stored table, as they
    do outside of this registry.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    return _stored[key] if key in _stored else store_common(spark, sf_dir)


def champions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as champion reference: ids 1 to 25, so some champions are unknown to it."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(F.substring("p_brand", 7, 10).cast("bigint").alias("champion_id"))
        .agg(
            F.min("p_brand").alias("champion_name"),
            F.max("p_name").alias("title"),
            F.concat_ws(",", F.min("p_type"), F.max("p_type")).alias("tags"),
        )
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by remainder as item reference: ids 0 to 34, so some items are unknown to it."""
    return (
        table(spark, sf_dir, "part")
        .withColumn("item_id", F.col("p_partkey") % 35)
        .groupBy("item_id")
        .agg(
            F.min("p_name").alias("item_name"),
            (F.floor(F.max("p_retailprice")) * (F.col("item_id") % 4)).alias("gold_total"),
            F.min("p_type").alias("tags"),
        )
    )


# ---- the same in SQL --------------------------------------------------------

_ITEMS_SQL = ",\n  ".join(
    f"CASE WHEN (l_partkey + {i}) % 6 <> 0 THEN (l_partkey * {i + 1} + l_suppkey) % 40 END AS item{i}"
    for i in range(7)
)

PARTICIPANTS_SQL = f"""
SELECT o_orderstatus AS data_source, CAST(l_orderkey AS VARCHAR) AS match_id,
  o_orderpriority AS source_tier, o_orderdate AS game_start_utc,
  CASE WHEN l_orderkey % 211 <> 0 THEN 900 + (l_orderkey * 7) % 1500 END AS game_duration_sec,
  'CLASSIC' AS game_mode, 'MATCHED' AS game_type,
  CASE WHEN l_orderkey % 307 <> 0
       THEN '16.' || CAST(EXTRACT(MONTH FROM o_orderdate) AS VARCHAR) || '.1.2' END AS game_version,
  11 AS map_id, 'X1' AS platform_id,
  CASE WHEN o_custkey % 10 = 0 THEN 450 ELSE 420 END AS queue_id,
  l_partkey * 16 + l_linenumber AS participant_id,
  CASE WHEN l_partkey % 101 <> 0 THEN 'player-' || CAST(l_suppkey AS VARCHAR) END AS puuid,
  'summoner-' || CAST(l_suppkey AS VARCHAR) AS summoner_id,
  'Summoner ' || CAST(l_suppkey AS VARCHAR) AS summoner_name,
  CASE WHEN l_suppkey % 3 = 0 THEN ' ' ELSE 'Name' || CAST(l_suppkey AS VARCHAR) END AS riot_id_game_name,
  CAST(l_suppkey % 400 AS INTEGER) AS summoner_level,
  l_partkey % 30 AS champion_id,
  CASE WHEN l_partkey % 30 = 7 AND l_suppkey % 5 = 0 THEN 'CHAMPION 7'
       ELSE 'Champion ' || CAST(l_partkey % 30 AS VARCHAR) END AS champion_name,
  CASE WHEN l_linestatus = 'O' THEN 100 ELSE 200 END AS team_id,
  CASE WHEN l_partkey % 331 <> 0 THEN l_quantity > 25 END AS win,
  CASE WHEN l_partkey % 23 <> 0 THEN
    CASE l_linenumber WHEN 1 THEN 'TOP' WHEN 2 THEN 'JUNGLE' WHEN 3 THEN 'MIDDLE' WHEN 4 THEN 'BOTTOM'
      WHEN 5 THEN 'UTILITY' WHEN 6 THEN '' ELSE 'Invalid' END END AS raw_position,
  CASE l_suppkey % 4 WHEN 0 THEN 'TOP' WHEN 1 THEN 'Invalid' END AS individual_position,
  'NONE' AS lane, 'SOLO' AS role,
  CASE WHEN l_partkey % 97 <> 0 THEN CAST(l_partkey % 13 AS INTEGER) END AS kills,
  CAST(l_suppkey % 9 AS INTEGER) AS deaths,
  CAST((l_partkey + l_suppkey) % 17 AS INTEGER) AS assists,
  CAST(FLOOR(l_extendedprice) AS BIGINT) AS gold_earned,
  CAST(FLOOR(l_extendedprice * (1 - l_discount)) AS BIGINT) AS gold_spent,
  (l_partkey % 5000) * 7 + 100 AS total_damage_dealt_to_champions,
  (l_suppkey % 700) * 31 AS total_damage_taken,
  CAST((l_suppkey * 3) % 60 AS INTEGER) AS vision_score,
  CASE WHEN o_orderstatus = 'P' THEN CAST((l_partkey * 11) % 250 AS INTEGER) END AS total_minions_killed,
  CAST(l_partkey % 20 AS INTEGER) AS wards_placed, CAST(l_suppkey % 10 AS INTEGER) AS wards_killed,
  l_linenumber % 3 AS dragon_kills, l_linenumber % 2 AS baron_kills,
  {_ITEMS_SQL}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""



def _largest(names: str) -> str:
    return ", ".join(f"MAX({n}) AS {n}" for n in names.split())


def verdict_sql(above: str, across: str, below: str) -> str:
    """Fixed rule: does the interval lie above, across or below one half?"""
    return f"CASE WHEN wilson_low > 0.5 THEN '{above}' WHEN wilson_high < 0.5 THEN '{below}' ELSE '{across}' END"


# Names of positions.
_ROLE_NAMES = """('TOP', 'Топ'), ('JUNGLE', 'Лес'), ('MIDDLE', 'Мид'), ('BOTTOM', 'Бот / керри'), ('UTILITY', 'Саппорт')"""

_CTES = {
    "raw_rows": PARTICIPANTS_SQL,
    "timed": """
SELECT *, CAST(game_duration_sec AS DOUBLE) / 60 AS game_duration_min,
  CASE WHEN raw_position IS NULL OR raw_position IN ('', 'Invalid') THEN 'UNDEFINED'
       ELSE raw_position END AS team_position
FROM raw_rows""",
    "common": """
SELECT *,
  CAST(kills + assists AS DOUBLE) / CASE WHEN deaths < 1 THEN 1 ELSE deaths END AS kda,
  total_damage_dealt_to_champions / game_duration_min AS damage_per_min,
  gold_earned / game_duration_min AS gold_per_min,
  vision_score / game_duration_min AS vision_per_min,
  total_minions_killed / game_duration_min AS cs_per_min
FROM timed""",
    "complete": f"""
SELECT * EXCLUDE (size) FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY data_source, match_id) AS size FROM common
  WHERE data_source IS NOT NULL AND match_id IS NOT NULL)
WHERE size = {GROUP_SIZE}""",
    "champions_ref": """
SELECT *, split_part(tags, ',', 1) AS primary_class FROM (
  SELECT CAST(SUBSTRING(p_brand, 7) AS BIGINT) AS champion_id, MIN(p_brand) AS champion_name,
    MAX(p_name) AS title, MIN(p_type) || ',' || MAX(p_type) AS tags
  FROM part GROUP BY 1)""",
    "items_ref": """
SELECT p_partkey % 35 AS item_id, MIN(p_name) AS item_name,
  CAST(FLOOR(MAX(p_retailprice)) AS BIGINT) * (p_partkey % 35 % 4) AS gold_total, MIN(p_type) AS tags
FROM part GROUP BY p_partkey % 35""",
    "dim_champion": """
SELECT champion_id, champion_name,
  (SELECT k.title FROM champions_ref k WHERE k.champion_id = spelled.champion_id) AS title,
  ifnull((SELECT k.primary_class FROM champions_ref k WHERE k.champion_id = spelled.champion_id), 'Unknown') AS primary_class
FROM (SELECT champion_id, champion_name FROM complete GROUP BY ALL) AS spelled
WHERE champion_id IS NOT NULL""",
    "dim_match": f"""
SELECT data_source, match_id, {_largest("game_start_utc game_duration_min game_version queue_id source_tier")}
FROM complete GROUP BY ALL""",
    "dim_player": f"""
SELECT data_source, puuid, {_largest("source_tier summoner_name riot_id_game_name")}, COUNT(puuid) AS appearances
FROM complete GROUP BY ALL HAVING COUNT(puuid) > 0""",
    "dim_role": f"""
SELECT position AS role_key, ifnull(shown, 'Не определена') AS role_name_ru
FROM (SELECT team_position AS position FROM complete GROUP BY ALL) LEFT JOIN (VALUES {_ROLE_NAMES}) AS roles(code, shown)
  ON code = position""",
    "fact": f"SELECT {', '.join('team_position AS role_key' if c == 'role_key' else c for c in FACT_COLUMNS)} FROM complete",
    "bridge": "\nUNION ALL\n".join(
        f"SELECT data_source, match_id, participant_id, item{i} AS item_id FROM complete "
        f"WHERE item{i} IS NOT NULL AND item{i} <> 0"
        for i in range(7)
    ),
    "dim_item": """
SELECT u.item_id, r.item_name, r.gold_total, r.tags
FROM (SELECT DISTINCT item_id FROM bridge) u LEFT JOIN items_ref r ON u.item_id = r.item_id""",
}

# bounds of the interval for w wins in n games: centre less or plus half of its width
_CENTRE = "({w} + 0.5 * 3.8416) / ({n} + 3.8416)"
_HALF = "1.96 * sqrt({w} * ({n} - {w}) / {n} + 3.8416 / 4) / ({n} + 3.8416)"
WILSON_LOW = f"({_CENTRE} - {_HALF})"
WILSON_HIGH = f"({_CENTRE} + {_HALF})"

_CTES |= {
    "item_stats": f"""
WITH outcome AS (
  SELECT data_source, match_id, participant_id, COUNT(*) AS times, COUNT(*) FILTER (WHERE win) AS won
  FROM fact GROUP BY ALL),
bought AS (
  SELECT data_source, item_id, CAST(SUM(times) AS BIGINT) AS purchases, SUM(won)::DOUBLE AS won
  FROM bridge JOIN outcome USING (data_source, match_id, participant_id) GROUP BY ALL)
SELECT data_source, COALESCE(item_name, CAST(bought.item_id AS VARCHAR)) AS item_name, bought.item_id, gold_total,
  purchases, won / purchases AS winrate, {WILSON_LOW.format(w='won', n='purchases')} AS wilson_low
FROM bought LEFT JOIN dim_item ON dim_item.item_id = bought.item_id
WHERE purchases >= 10""",
    "champion_strength": f"""
WITH record AS (
  SELECT data_source, champion_name, primary_class, COUNT(DISTINCT match_id) AS games, COUNT(*) FILTER (WHERE win) AS wins
  FROM fact JOIN dim_champion USING (champion_id) GROUP BY ALL),
bounds AS (
  SELECT *, wins::DOUBLE / games AS winrate, {WILSON_LOW.format(w='wins::DOUBLE', n='games')} AS wilson_low,
    {WILSON_HIGH.format(w='wins::DOUBLE', n='games')} AS wilson_high
  FROM record WHERE games >= 5)
SELECT *, {verdict_sql("значимо сильный", "в норме", "значимо слабый")} AS verdict FROM bounds""",
    "champion_by_duration": """
WITH lengths AS (
  SELECT data_source, match_id, game_duration_min AS minutes FROM dim_match),
tally AS (
  SELECT data_source, champion_id, COUNT(*) FILTER (WHERE minutes < 25) AS n1,
    COUNT(*) FILTER (WHERE minutes >= 25 AND minutes < 32) AS n2, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE win AND minutes < 25) AS won1,
    COUNT(*) FILTER (WHERE win AND minutes >= 25 AND minutes < 32) AS won2, COUNT(*) FILTER (WHERE win) AS won
  FROM fact JOIN lengths USING (data_source, match_id) GROUP BY ALL),
-- what is neither short nor medium is long, a missing duration too; the names are fixed values
parts AS (
  SELECT data_source, champion_id, '1. Короткие (<25м)' AS duration_bucket, n1 AS n, won1 AS won FROM tally
  UNION ALL SELECT data_source, champion_id, '2. Средние (25-32м)', n2, won2 FROM tally
  UNION ALL SELECT data_source, champion_id, '3. Длинные (>32м)', n - n1 - n2, won - won1 - won2 FROM tally)
SELECT data_source, champion_name, primary_class, duration_bucket, CAST(SUM(n) AS BIGINT) AS games,
  SUM(won)::DOUBLE / SUM(n) AS winrate
FROM parts JOIN dim_champion USING (champion_id) WHERE n > 0 GROUP BY ALL""",
}
_NEEDS = {
    "raw_rows": [], "timed": ["raw_rows"], "common": ["timed"], "complete": ["common"],
    "champions_ref": [], "items_ref": [], "dim_champion": ["complete", "champions_ref"],
    "dim_match": ["complete"], "dim_player": ["complete"], "dim_role": ["complete"],
    "fact": ["complete"], "bridge": ["complete"], "dim_item": ["bridge", "items_ref"],
    "item_stats": ["bridge", "fact", "dim_item"], "champion_strength": ["fact", "dim_champion"],
    "champion_by_duration": ["fact", "dim_champion", "dim_match"],
}


def with_tables(body: str, *names: str) -> str:
    """A query with the named derived tables, and those they need, in front."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for dep in _NEEDS[name]:
            visit(dep)
        if name not in needed:
            needed.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in needed) + "\n" + body
