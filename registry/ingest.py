"""Documents, normalisation, merges, sinks and the incremental ingest.

Raw JSON documents are made by Spark from the given tables, a fixed number of
participants or entries per row, so that no document grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrimtally import schemas as S
from scrimtally.functions import epoch_seconds, load_stamp, normalize_id, to_long, to_utc
from scrimtally.operators import flatten as D
from scrimtally.operators import normalize as N
from scrimtally.operators import upsert as U
from scrimtally.session import scratch_dir
from scrimtally.sources import CODEC, append_log, read_csv, resolve_source, write_parquet, write_table
from scrimtally.streaming import incremental_ingest, ingested_log, ingested_matches

from .common import Registry, r, rs
from .order_matches import common, participants, table, with_tables

STAMP = "2026-01-01T00:00:00+00:00"


# ---- documents --------------------------------------------------------------


def _player(number: int, key: str, win: Column) -> Column:
    k, part = F.col(key), F.col("l_partkey")
    role = F.when(part % 5 == 0, "").when(part % 5 == 1, "Invalid").when(part % 5 < 4, "TOP")
    challenges = F.struct(
        (k % 10 / F.lit(4.0)).alias("kda"), (k % 8 / F.lit(8.0)).alias("killParticipation")
    )
    return F.struct(
        F.lit(number).alias("participantId"),
        F.concat(F.lit(f"{key}-"), k.cast("string")).alias("puuid"),
        F.concat(F.lit("name "), k.cast("string")).alias("riotIdGameName"),
        ((k + number) % 30).alias("championId"),
        F.concat(F.lit("Champion "), ((k + number) % 30).cast("string")).alias("championName"),
        F.lit(100 * number).alias("teamId"),
        win.alias("win"),
        role.alias("teamPosition"),
        (k % 13).alias("kills"),
        (k % 4).alias("deaths"),
        (k % 9).alias("assists"),
        (part * 10).alias("goldEarned"),
        (part * 20 + k).alias("totalDamageDealtToChampions"),
        (k % 50).alias("visionScore"),
        (part % 200).alias("totalMinionsKilled"),
        (part % 60).alias("neutralMinionsKilled"),
        F.when(part % 3 != 0, challenges).alias("challenges"),
        *[((part + i) % 7).alias(f"item{i}") for i in range(7)],
    )


# tasks a core for documents that are parsed where they are made
TASKS_PER_CORE = 8


def match_documents(spark: SparkSession, sf: str, spread: bool = False, tasks: int | None = None) -> DataFrame:
    """One match per line item: its customer against its supplier.

    Some texts are cut off, go on behind the document, hold two documents or use single
    quotes; some hold a value of another type, some spell numbers in other ways.

    ``spread`` deals the narrow rows over several tasks a core before texts are made. The
    partitions of the join are merged by their bytes to about one a core, and uneven ones:
    a row has few bytes, but its document takes long to make and parse. ``tasks`` deals
    them over so many tasks in turn.
    """
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"
    )
    j = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if spread:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
        j = j.repartition(parts, "l_orderkey", "l_partkey", "l_linenumber")
    if tasks:
        j = j.repartition(tasks)
    part, won = F.col("l_partkey"), F.col("l_quantity") > 25
    match_id = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_linenumber")])
    start = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    doc = F.to_json(
        F.struct(
            F.struct(match_id.alias("matchId")).alias("metadata"),
            F.struct(
                start.alias("gameStartTimestamp"),
                (part % 1500 + 600).alias("gameDuration"),
                F.lit("CLASSIC").alias("gameMode"),
                F.concat(F.lit("16."), F.month("o_orderdate").cast("string"), F.lit(".3")).alias("gameVersion"),
                F.lit(11).alias("mapId"),
                F.when(F.col("o_custkey") % 10 == 0, 450).otherwise(420).alias("queueId"),
                F.array(_player(1, "o_custkey", won), _player(2, "l_suppkey", ~won)).alias("participants"),
            ).alias("info"),
        )
    )
    whole = F.col("doc")
    swap = lambda old, new: F.replace(whole, F.lit(old), F.lit(new))
    text = (
        F.when(part % 97 == 0, F.expr("substring(doc, 1, length(doc) - 3)"))
        .when(part % 83 == 0, F.concat(whole, F.lit(" and more")))
        .when(part % 79 == 0, F.concat(whole, whole))
        .when(part % 73 == 0, swap('"', "'"))
        .when(part % 89 == 0, swap('"mapId":11', '"mapId":"eleven"'))
        .when(part % 7 == 0, swap('"mapId":11', '"mapId":11.0,"platformId":7'))
        .when(part % 7 == 1, swap('"teamId":100', '"teamId":"100"'))
        .otherwise(whole)
    )
    return j.select(match_id.alias("match_id"), doc.alias("doc"), "l_partkey").select(
        "match_id", text.alias("_raw_json")
    )


BROKEN = " OR ".join(f"l_partkey % {n} = 0" for n in (97, 83, 79, 73))


def _player_sql(number: int, key: str, win: str) -> str:
    items = ", ".join(f"(l_partkey + {i}) % 7 AS item{i}" for i in range(7))
    return f"""SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS match_id,
  o_orderdate AS game_start_utc, l_partkey % 1500 + 600 AS game_duration_sec,
  '16.' || CAST(EXTRACT(MONTH FROM o_orderdate) AS VARCHAR) || '.3' AS game_version,
  CASE WHEN l_partkey % 89 <> 0 THEN 11 END AS map_id,
  CASE WHEN o_custkey % 10 = 0 THEN 450 ELSE 420 END AS queue_id, CAST({number} AS BIGINT) AS participant_id,
  '{key}-' || CAST({key} AS VARCHAR) AS puuid, 'name ' || CAST({key} AS VARCHAR) AS riot_id_game_name,
  ({key} + {number}) % 30 AS champion_id, 'Champion ' || CAST(({key} + {number}) % 30 AS VARCHAR) AS champion_name,
  {100 * number} AS team_id, {win} AS win,
  CASE l_partkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'Invalid' WHEN 2 THEN 'TOP' WHEN 3 THEN 'TOP' END AS team_position,
  CAST({key} % 13 AS INTEGER) AS kills, CAST({key} % 4 AS INTEGER) AS deaths, CAST({key} % 9 AS INTEGER) AS assists,
  l_partkey * 10 AS gold_earned, l_partkey * 20 + {key} AS total_damage_dealt_to_champions,
  CAST({key} % 50 AS INTEGER) AS vision_score, CAST(l_partkey % 200 AS INTEGER) AS total_minions_killed,
  CASE WHEN l_partkey % 3 <> 0 THEN {key} % 10 / 4.0 END AS kda_challenge,
  CASE WHEN l_partkey % 3 <> 0 THEN {key} % 8 / 8.0 END AS kill_participation, {items}
  , CAST(epoch_ms(o_orderdate) AS BIGINT) AS game_start_timestamp, 'CLASSIC' AS game_mode,
  CASE WHEN l_partkey % 7 = 0 AND l_partkey % 89 <> 0 THEN '7' END AS platform_id,
  CAST(l_partkey % 60 AS INTEGER) AS neutral_minions_killed
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT ({BROKEN})"""


FLAT_SQL = f"""WITH flat AS (
{_player_sql(1, 'o_custkey', 'l_quantity > 25')}
UNION ALL
{_player_sql(2, 'l_suppkey', 'NOT l_quantity > 25')})
"""


def _flat_list() -> str:
    """All columns of a flat match; those that the documents lack are null."""
    made = """match_id game_duration_sec game_version map_id queue_id participant_id puuid
        riot_id_game_name champion_id champion_name team_id win team_position kills deaths assists
        gold_earned total_damage_dealt_to_champions vision_score total_minions_killed
        game_start_timestamp game_mode platform_id neutral_minions_killed""".split() + S.ITEM_SLOTS
    given = {c: c for c in made}
    given |= {c: r(c, c) for c in ("kda_challenge", "kill_participation")}
    given |= {"source_tier": "'master' AS source_tier", "collected_at_utc": f"'{STAMP}' AS collected_at_utc"}
    kinds = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    fields = {f.name: f.dataType.simpleString() for f in [*S.MATCH_INFO.fields, *S.PARTICIPANT.fields]}
    renamed = {"gameDuration": "game_duration_sec"}
    names = {"source_puuid": "string"} | {renamed.get(n, D.snake_case(n)): k for n, k in fields.items() if k in kinds}
    missing = [f"CAST(NULL AS {kinds[k]}) AS {n}" for n, k in names.items() if n not in given]
    return ", ".join([*given.values(), *missing])


def league_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One ladder of four entries per customer; some entries lack ids."""
    key = F.col("c_custkey")

    def entry(i: int) -> Column:
        account = F.concat(F.lit("acc-"), ((key * 4 + i) % 1000).cast("string"))
        return F.struct(
            F.when((key + i) % 7 != 0, account).alias("summonerId"),
            F.when((key + i) % 3 != 0, F.concat(F.lit("p-"), (key * 4 + i).cast("string"))).alias("puuid"),
            (key % 100 + i).alias("leaguePoints"),
            F.lit("I").alias("rank"),
            (key % 40).alias("wins"),
            (key % 25 * i).alias("losses"),
            ((key + i) % 2 == 0).alias("veteran"),
        )

    doc = F.to_json(
        F.struct(
            F.concat(F.lit("league-"), key.cast("string")).alias("leagueId"),
            F.col("c_name").alias("name"),
            F.array(*[entry(i) for i in range(4)]).alias("entries"),
        )
    )
    return table(spark, sf, "customer").select(doc.alias("_raw_json"))


def ladder(spark: SparkSession, sf: str) -> DataFrame:
    return D.flatten_league(league_documents(spark, sf), "Master", offset=1, limit=2, stamp=STAMP)


def _entry_sql(i: int) -> str:
    return f"""SELECT 'master' AS source_tier, 'RANKED_SOLO_5x5' AS queue_type,
  'league-' || CAST(c_custkey AS VARCHAR) AS league_id, c_name AS league_name,
  CASE WHEN (c_custkey + {i}) % 7 <> 0 THEN 'acc-' || CAST((c_custkey * 4 + {i}) % 1000 AS VARCHAR) END AS summoner_id,
  CASE WHEN (c_custkey + {i}) % 3 <> 0 THEN 'p-' || CAST(c_custkey * 4 + {i} AS VARCHAR) END AS puuid,
  CAST(c_custkey % 100 + {i} AS INTEGER) AS league_points, 'I' AS rank, CAST(c_custkey % 40 AS INTEGER) AS wins,
  CAST(c_custkey % 25 * {i} AS INTEGER) AS losses, (c_custkey + {i}) % 2 = 0 AS veteran
FROM customer"""


LADDER_SQL = f"WITH ladder AS ({_entry_sql(1)} UNION ALL {_entry_sql(2)})\n"
LADDER = "source_tier queue_type league_id league_name summoner_id puuid league_points rank wins losses veteran".split()


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Accounts by number, from the suppliers."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("acc-"), key.cast("string")).alias("summoner_id"),
        F.concat(F.lit("found-"), key.cast("string")).alias("puuid"),
        (key % 50).cast("int").alias("profile_icon_id"),
        (key % 300).cast("int").alias("summoner_level"),
    )


def champion_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One champion map of two entries per part; the second has no tags."""
    key = F.col("p_partkey")
    full = F.struct(
        (key * 2).cast("string").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("title"),
        F.array("p_type", "p_name").alias("tags"),
    )
    bare = F.struct(
        (key * 2 + 1).cast("string").alias("key"), F.col("p_name").alias("name"), F.col("p_brand").alias("title"),
        F.lit(None).cast("array<string>").alias("tags"),
    )
    doc = F.struct(F.create_map(F.lit("First"), full, F.lit("Second"), bare).alias("data"))
    return table(spark, sf, "part").select(F.to_json(doc).alias("_raw_json"))


def item_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One item map of two entries per part; the second has neither price nor tags."""
    key = F.col("p_partkey")
    full = F.struct(
        F.col("p_name").alias("name"),
        F.struct(F.floor("p_retailprice").alias("total"), (key % 2 == 0).alias("purchasable")).alias("gold"),
        F.array("p_type", "p_brand").alias("tags"),
    )
    bare = F.struct(
        F.col("p_name").alias("name"),
        F.lit(None).cast("struct<total:bigint,purchasable:boolean>").alias("gold"),
        F.lit(None).cast("array<string>").alias("tags"),
    )
    doc = F.struct(
        F.create_map((key * 2).cast("string"), full, (key * 2 + 1).cast("string"), bare).alias("data")
    )
    return table(spark, sf, "part").select(F.to_json(doc).alias("_raw_json"))


def version_documents(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("o_orderdate")
    versions = F.array(
        F.concat_ws(".", F.lit("16"), F.month(day).cast("string"), F.lit("1")), F.lit("15.24.1"), F.lit("15.23.1")
    )
    return table(spark, sf, "orders").select("o_orderkey", F.to_json(versions).alias("_raw_json"))


# ---- sources for normalisation ----------------------------------------------


def tabular(spark: SparkSession, sf: str) -> DataFrame:
    """The second source's columns; its ids arrive as integral doubles."""
    return (
        participants(spark, sf)
        .withColumn("game_id", F.col("match_id").cast("double"))
        .withColumnRenamed("game_duration_sec", "game_duration")
        .drop("match_id", "total_minions_killed")
    )


def collected(spark: SparkSession, sf: str) -> DataFrame:
    """The collected source: start time in epoch milliseconds, measures present."""
    return (
        common(spark, sf)
        .withColumn("game_start_timestamp", F.unix_millis(F.col("game_start_utc").cast("timestamp")))
        .drop("game_start_utc", "cs_per_min")
    )


NORMAL = """data_source match_id source_tier game_start_utc game_duration_sec game_duration_min
    game_version queue_id participant_id puuid champion_id champion_name team_id win team_position kda
    gold_per_min damage_per_min vision_per_min cs_per_min item0 item6""".split()
_MEASURES = "game_duration_min kda gold_per_min damage_per_min vision_per_min cs_per_min".split()


def _normal_sql(overrides: dict[str, str]) -> str:
    parts = []
    for c in NORMAL:
        expr = overrides.get(c, c)
        parts.append(r(expr, c) if c in _MEASURES else f"{expr} AS {c}")
    return ", ".join(parts)


_ROLE_FALLBACK = """CASE WHEN COALESCE(raw_position, individual_position) IS NULL
    OR COALESCE(raw_position, individual_position) IN ('', 'Invalid') THEN 'UNDEFINED'
  ELSE COALESCE(raw_position, individual_position) END"""
TABULAR_SQL = "SELECT " + _normal_sql(
    {
        "data_source": "'kaggle'",
        "source_tier": "'kaggle'",
        "team_position": _ROLE_FALLBACK,
        "cs_per_min": "CAST(NULL AS DOUBLE)",
    }
) + " FROM common WHERE queue_id = 420"
COLLECTED_SQL = "SELECT " + _normal_sql(
    {"data_source": "'riot_api'", "cs_per_min": "CAST(NULL AS DOUBLE)"}
) + " FROM common"
DOCUMENTS_SQL = FLAT_SQL + """, timed AS (SELECT *, CAST(game_duration_sec AS DOUBLE) / 60 AS minutes FROM flat WHERE queue_id = 420)
SELECT """ + _normal_sql(
    {
        "data_source": "'riot_full'",
        "source_tier": "'riot_full'",
        "team_position": "CASE WHEN team_position IS NULL OR team_position IN ('', 'Invalid') THEN 'UNDEFINED' ELSE team_position END",
        "game_duration_min": "minutes",
        "kda": "CAST(kills + assists AS DOUBLE) / CASE WHEN deaths < 1 THEN 1 ELSE deaths END",
        "gold_per_min": "gold_earned / minutes",
        "damage_per_min": "total_damage_dealt_to_champions / minutes",
        "vision_per_min": "vision_score / minutes",
        "cs_per_min": "total_minions_killed / minutes",
    }
) + " FROM timed"


# ---- merges -----------------------------------------------------------------

MERGE_KEYS = ["l_orderkey", "l_linenumber"]
MERGE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
MERGED = [*MERGE_KEYS, "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"]


def merge_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem")
    return lines.filter(F.col("l_returnflag") == "N"), lines.filter(F.col("l_returnflag") != "N")


def order_log(spark: SparkSession, sf: str) -> DataFrame:
    """A download log: one row per order, finished orders succeeded."""
    status = F.when(F.col("o_orderstatus") == "F", "success").otherwise("match_detail_error")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("match_id"), status.alias("status")
    )


def ingested(spark: SparkSession, sf: str) -> str:
    """Write the documents to files and take them in twice; the second run finds nothing new."""
    folder = scratch_dir(spark, "ingest")
    docs = match_documents(spark, sf, spread=True)
    for i in range(2):
        docs.write.mode("append").option("compression", CODEC).parquet(f"{folder}/in")
        incremental_ingest(
            spark, f"{folder}/in", f"{folder}/out", f"{folder}/stream", "master", stamp=STAMP
        )
    return folder


# files of a part of the documents, for each core; smaller parts have fewer
FILES_PER_CORE = 2
ROWS_PER_FILE = 10_000


def ingested_in_parts(spark: SparkSession, sf: str) -> str:
    """Three parts of the documents and then a fourth with some of them again, in one run of four micro-batches.

    Every part is written as the same number of files, which a batch takes in. Rows are dealt
    to the files in turn by tasks that hold many of them, so no file is left out as empty.
    """
    folder = scratch_dir(spark, "ingest")
    part = F.split_part("match_id", F.lit("-"), F.lit(1)).cast("bigint") % 3
    parts = (part == 0, part == 1, part == 2, part != 1)
    sizes = match_documents(spark, sf).agg(*[F.count_if(wanted) for wanted in parts]).first()
    files = FILES_PER_CORE * spark.sparkContext.defaultParallelism
    files = max(1, min(files, min(sizes) // ROWS_PER_FILE))
    docs = match_documents(spark, sf, tasks=files)
    for wanted in parts:
        docs.filter(wanted).write.mode("append").option("compression", CODEC).parquet(f"{folder}/in")
    incremental_ingest(
        spark, f"{folder}/in", f"{folder}/out", f"{folder}/stream", "master", files_per_batch=files, stamp=STAMP
    )
    return folder


# ---- sinks ------------------------------------------------------------------


def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    folder = scratch_dir(spark, "lines")
    return write_parquet(
        lines, f"{folder}/lineitem.parquet", partition_by=["l_returnflag"], cluster_by=["l_partkey"]
    )


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with quotes and line breaks through the CSV form."""
    docs = table(spark, sf, "documents")
    base = f"{scratch_dir(spark, 'docs')}/documents"
    write_table(docs, base, formats=["csv"])
    back = read_csv(spark, f"{base}.csv", docs.schema, multi_line=True)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_md5"))


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    base = f"{scratch_dir(spark, 'orders')}/orders"
    write_table(table(spark, sf, "orders"), base, formats=["parquet", "csv"])
    return resolve_source(spark, base)


def logged_twice(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'log')}/log"
    for _ in range(2):
        append_log(order_log(spark, sf), path)
    return spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("rows"))


def register(reg: Registry) -> None:
    add = reg.add
    # ---- documents ----------------------------------------------------------
    add(
        "flatten_matches",
        lambda s, d: D.flatten_matches(match_documents(s, d, spread=True), source_tier="master", stamp=STAMP),
        FLAT_SQL + f"SELECT {_flat_list()} FROM flat",
    )
    add(
        "document_status",
        lambda s, d: D.document_status_counts(match_documents(s, d, spread=True), "_raw_json", S.MATCH_DOCUMENT),
        f"""SELECT CASE WHEN {BROKEN} THEN 'malformed' WHEN l_partkey % 89 = 0 THEN 'mistyped' ELSE 'ok' END AS doc_status,
  COUNT(*) AS documents FROM lineitem GROUP BY 1""",
    )
    add(
        "flatten_league",
        lambda s, d: ladder(s, d).select(*LADDER),
        LADDER_SQL + f"SELECT {', '.join(LADDER)} FROM ladder",
    )
    add(
        "ladder_winrate",
        lambda s, d: D.ladder_winrate(ladder(s, d)).select("league_id", "league_points", "winrate"),
        LADDER_SQL
        + f"""SELECT league_id, league_points, {r('CAST(wins AS DOUBLE) / NULLIF(wins + losses, 0)', 'winrate')}
FROM ladder""",
    )
    add(
        "top_ladder_players",
        lambda s, d: D.top_ladder_players(ladder(s, d).filter(F.col("puuid").isNotNull()), 25).select(
            "league_id", "puuid", "league_points"
        ),
        LADDER_SQL
        + "SELECT league_id, puuid, league_points FROM ladder WHERE puuid IS NOT NULL ORDER BY league_points DESC, puuid LIMIT 25",
    )
    add(
        "fill_missing_ids",
        lambda s, d: D.fill_missing_ids(ladder(s, d), accounts(s, d)).select(
            "league_id", "league_points", "summoner_id", "puuid", "profile_icon_id", "summoner_level"
        ),
        LADDER_SQL
        + """SELECT l.league_id, l.league_points, l.summoner_id,
  COALESCE(l.puuid, 'found-' || CAST(s.s_suppkey AS VARCHAR)) AS puuid,
  CASE WHEN l.puuid IS NULL THEN CAST(s.s_suppkey % 50 AS INTEGER) END AS profile_icon_id,
  CASE WHEN l.puuid IS NULL THEN CAST(s.s_suppkey % 300 AS INTEGER) END AS summoner_level
FROM ladder l LEFT JOIN supplier s ON l.summoner_id = 'acc-' || CAST(s.s_suppkey AS VARCHAR)""",
    )
    add(
        "flatten_champions",
        lambda s, d: D.flatten_champions(champion_documents(s, d)),
        """SELECT p_partkey * 2 AS champion_id, p_name AS champion_name, p_brand AS title, p_type || ',' || p_name AS tags FROM part
UNION ALL SELECT p_partkey * 2 + 1, p_name, p_brand, '' FROM part""",
    )
    add(
        "flatten_items",
        lambda s, d: D.flatten_items(item_documents(s, d)),
        """SELECT p_partkey * 2 AS item_id, p_name AS item_name, CAST(FLOOR(p_retailprice) AS BIGINT) AS gold_total,
  p_partkey % 2 = 0 AS purchasable, p_type || ',' || p_brand AS tags FROM part
UNION ALL SELECT p_partkey * 2 + 1, p_name, NULL, NULL, '' FROM part""",
    )
    add(
        "latest_version",
        lambda s, d: D.latest_version(version_documents(s, d)).groupBy("version").agg(F.count("*").alias("documents")),
        """SELECT '16.' || CAST(EXTRACT(MONTH FROM o_orderdate) AS VARCHAR) || '.1' AS version, COUNT(*) AS documents
FROM orders GROUP BY 1""",
    )
    # ---- normalisation ------------------------------------------------------
    add(
        "normalize_tabular",
        lambda s, d: N.normalize_tabular(tabular(s, d)).select(*NORMAL),
        with_tables(TABULAR_SQL, "common"),
    )
    add(
        "normalize_collected",
        lambda s, d: N.normalize_collected(collected(s, d)).select(*NORMAL),
        with_tables(COLLECTED_SQL, "common"),
    )
    add("normalize_documents", lambda s, d: N.normalize_documents(match_documents(s, d, spread=True)).select(*NORMAL), DOCUMENTS_SQL)
    add(
        "union_normalized",
        lambda s, d: N.union_sources(
            [N.normalize_tabular(tabular(s, d)), N.normalize_collected(collected(s, d))]
        ).select(*NORMAL),
        with_tables(f"{TABULAR_SQL} UNION ALL {COLLECTED_SQL}", "common"),
    )
    add(
        "conform_orders",
        lambda s, d: N.conform(
            table(s, d, "orders").select(
                F.col("o_orderkey").cast("double").cast("string").alias("champion_id"),
                F.col("o_orderdate").cast("string").alias("game_start_utc"),
                F.when(F.col("o_custkey") % 5 == 0, "bad").otherwise(F.col("o_custkey").cast("string")).alias("kills"),
                F.col("o_totalprice").cast("string").alias("kda"),
                F.lit("dropped").alias("not_in_the_schema"),
            )
        ).select("champion_id", "game_start_utc", "kills", "kda", "lane"),
        f"""SELECT o_orderkey AS champion_id, o_orderdate AS game_start_utc,
  CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS INTEGER) END AS kills, {r('o_totalprice', 'kda')},
  CAST(NULL AS VARCHAR) AS lane FROM orders""",
    )
    add(
        "identifiers",
        lambda s, d: table(s, d, "orders").select(
            "o_orderkey",
            normalize_id(F.col("o_orderkey").cast("double")).alias("from_double"),
            normalize_id(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") + 0.5)).alias("from_fraction"),
            normalize_id(F.col("o_orderkey") * 1_000_000 + 0.5).alias("from_large"),
            normalize_id(F.col("o_orderkey") * 1e18).alias("from_huge"),
            normalize_id(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))).alias("from_text"),
            to_long(F.concat(F.col("o_orderkey").cast("string"), F.lit(".0"))).alias("to_long"),
        ),
        """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS from_double,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) || '.5' ELSE '' END AS from_fraction,
  CAST(o_orderkey * 1000000 AS VARCHAR) || '.5' AS from_large, CAST(CAST(o_orderkey * 1e18::DOUBLE AS HUGEINT) AS VARCHAR) AS from_huge,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END AS from_text, o_orderkey AS to_long FROM orders""",
    )
    add(
        "start_times",
        lambda s, d: N.start_text(
            table(s, d, "orders").select(
                "o_orderkey",
                F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("game_start_timestamp"),
                epoch_seconds(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("seconds"),
                to_utc(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("shifted"),
                load_stamp(STAMP).alias("collected_at_utc"),
            )
        ).drop("game_start_timestamp"),
        f"""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS game_start_utc,
  CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS seconds, o_orderdate - INTERVAL 2 HOUR AS shifted,
  '{STAMP}' AS collected_at_utc FROM orders""",
    )
    # ---- merges -------------------------------------------------------------
    order = ", ".join(f"{c} DESC" for c in MERGE_ORDER)
    merged = ", ".join(MERGED)
    add(
        "keyed_upsert",
        lambda s, d: U.upsert(*merge_sides(s, d), MERGE_KEYS, MERGE_ORDER).select(*MERGED),
        f"""SELECT {merged} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END DESC, {order}) AS rn FROM lineitem) WHERE rn = 1""",
    )
    add(
        "first_load",
        lambda s, d: U.upsert(None, table(s, d, "lineitem"), MERGE_KEYS, MERGE_ORDER).select(*MERGED),
        f"""SELECT {merged} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY {', '.join(MERGE_ORDER)}) AS rn FROM lineitem) WHERE rn = 1""",
    )
    add(
        "unseen_ids",
        lambda s, d: U.unseen_ids(
            table(s, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("match_id"), "l_suppkey"),
            order_log(s, d),
        ),
        """SELECT CAST(l_orderkey AS VARCHAR) AS match_id, MIN(l_suppkey) AS l_suppkey FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey""",
    )
    add(
        "distinct_ids",
        lambda s, d: U.distinct_ids(table(s, d, "lineitem"), "l_orderkey"),
        "SELECT DISTINCT l_orderkey FROM lineitem",
    )
    add(
        "incremental_ingest",
        lambda s, d: ingested_matches(s, f"{ingested(s, d)}/out").select(
            "match_id", "participant_id", "game_version", "source_tier"
        ),
        FLAT_SQL + "SELECT DISTINCT match_id, participant_id, game_version, 'master' AS source_tier FROM flat",
    )
    add(
        "ingest_log",
        lambda s, d: ingested_log(s, f"{ingested(s, d)}/out")
        .groupBy("batch_id", "status").agg(F.count("*").alias("documents")),
        f"""SELECT batch_id, status, COUNT(*) AS documents FROM (
  SELECT CAST(0 AS BIGINT) AS batch_id, CASE WHEN {BROKEN} THEN 'match_detail_error' ELSE 'success' END AS status
  FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem)
  UNION ALL
  SELECT 1, 'match_detail_error' FROM (SELECT DISTINCT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE {BROKEN}))
GROUP BY batch_id, status""",
    )
    add(
        "ingest_log_batches",
        lambda s, d: ingested_log(s, f"{ingested_in_parts(s, d)}/out")
        .groupBy("batch_id", "status").agg(F.count("*").alias("documents")),
        f"""WITH docs AS (
  SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_orderkey % 3 AS part, ({BROKEN}) AS broken FROM lineitem)
SELECT part AS batch_id, CASE WHEN broken THEN 'match_detail_error' ELSE 'success' END AS status, COUNT(*) AS documents
FROM docs GROUP BY ALL
UNION ALL
SELECT 3, 'match_detail_error', COUNT(*) FROM docs WHERE broken AND part <> 1""",
    )
    # ---- sinks --------------------------------------------------------------
    add("parquet_round_trip", parquet_round_trip, f"SELECT * EXCLUDE (l_quantity, l_extendedprice, l_discount, l_tax), {rs('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax')} FROM lineitem")
    add(
        "csv_round_trip",
        csv_round_trip,
        "SELECT doc_id, lang, source, n_chars, md5(text) AS text_md5 FROM documents",
    )
    add("resolved_source", resolved, f"SELECT * EXCLUDE (o_totalprice), {rs('o_totalprice')} FROM orders")
    add(
        "append_log",
        logged_twice,
        """SELECT CASE WHEN o_orderstatus = 'F' THEN 'success' ELSE 'match_detail_error' END AS status, COUNT(*) * 2 AS rows
FROM orders GROUP BY 1""",
    )
