"""Exploratory aggregates, profiles and the quality gate over the common table."""

from __future__ import annotations

from pyspark.sql import functions as F

from scrimtally import schemas as S
from scrimtally.functions import clean_role, patch_of, patch_prefix, ratio
from scrimtally.operators import aggregates as A
from scrimtally.operators import profile as P
from scrimtally.operators import quality as Q
from scrimtally.operators.normalize import started_between
from scrimtally.plans.stages import union_sources
from scrimtally.session import scratch_dir
from scrimtally.sources import write_parquet

from .common import Registry, avgs, r
from .order_matches import GROUP_SIZE, SOURCES, common, participants, store_common, with_tables
from .star import written_complete

RATES = ("kda", "damage_per_min", "gold_per_min", "vision_per_min")
RESULT = (*RATES, "kills", "deaths", "assists")
WINS = "CAST(SUM(CASE WHEN win THEN 1 ELSE 0 END) AS BIGINT) AS wins"
SHARE = r("AVG(CASE WHEN win THEN 1.0 ELSE 0.0 END)", "winrate")
MEAN_WIN = "AVG(CAST(CAST(win AS INTEGER) AS DOUBLE))"
# three sources of the test tables; the third has no threshold and drops out
MIN_GAMES = {"F": 100, "O": 10}
SINGLE = "O"
RULES = Q.Rules(group_size=GROUP_SIZE)


def complete(spark, sf):
    return A.complete_matches(common(spark, sf), GROUP_SIZE)


def sketched_overview(spark, sf):
    """Stored sketches per source and patch, merged per source.

    They lie within three deviations of the exact counts, and within one of
    sketches that were made of the whole source.
    """
    df = common(spark, sf)
    parts = A.distinct_sketches(df.withColumn("patch", patch_of("game_version")), ["data_source", "patch"], list(SKETCHED))
    stored = write_parquet(parts, f"{scratch_dir(spark, 'sketches')}/parts.parquet")
    merged = A.sketched_counts(A.merge_sketches(stored, ["data_source"], list(SKETCHED)), list(SKETCHED))
    whole = A.sketched_counts(A.distinct_sketches(df, ["data_source"], list(SKETCHED)), list(SKETCHED))
    exact = df.groupBy("data_source").agg(*[F.count_distinct(c).alias(f"exact_{c}") for c in SKETCHED])
    whole = whole.select("data_source", *[F.col(c).alias(f"whole_{c}") for c in SKETCHED])
    off = lambda c, other, rsd: F.abs(F.col(c) - F.col(other)) <= rsd * A.SKETCH_RSD * F.col(f"exact_{c}")
    return merged.join(exact, "data_source").join(whole, "data_source").select(
        "data_source",
        "rows",
        *[
            x
            for c, out in SKETCHED.items()
            for x in (off(c, f"exact_{c}", 3).alias(f"{out}_near"), off(c, f"whole_{c}", 1).alias(f"{out}_merged"))
        ],
    )


def one_source(spark, sf):
    return common(spark, sf).filter(F.col("data_source") == SINGLE)


OVERVIEW = f"""COUNT(*) AS rows, COUNT(DISTINCT match_id) AS matches, COUNT(DISTINCT puuid) AS players,
  COUNT(DISTINCT champion_name) AS champions, {r('AVG(game_duration_min)', 'avg_game_duration_min')}"""
CHAMPION_STATS = f"""SELECT data_source, champion_name, COUNT(DISTINCT match_id) AS games, {WINS}, {SHARE},
  {avgs(*RATES)} FROM complete GROUP BY data_source, champion_name"""


def _quality_sql() -> str:
    non_negative = [c for c in RULES.non_negative]
    zero = "SELECT '{0}' AS \"check\", n = 0 AS passed, 'ERROR' AS severity, CAST(n AS VARCHAR) || ' {1}' AS detail FROM ({2})"
    negative_list = ", ".join(
        f"CASE WHEN SUM(CASE WHEN {c} < 0 THEN 1 ELSE 0 END) > 0 THEN '{c}' END" for c in non_negative
    )
    blank_list = ", ".join(
        f"CASE WHEN SUM(CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) = '' THEN 1 ELSE 0 END) > 0 THEN '{c}' END"
        for c in RULES.filled
    )

    def listed(check: str, items: str, fine: str) -> str:
        return f"""SELECT '{check}' AS "check", names = '' AS passed, 'ERROR' AS severity,
  CASE WHEN names = '' THEN '{fine}' ELSE names END AS detail
FROM (SELECT CONCAT_WS(', ', {items}) AS names FROM common)"""

    def bad(condition: str) -> str:
        return f"SELECT COUNT(*) AS n FROM common WHERE {condition}"

    roles = ", ".join(f"'{x}'" for x in RULES.roles)
    parts = [
        """SELECT 'not_empty' AS "check", COUNT(*) > 0 AS passed, 'ERROR' AS severity,
  CAST(COUNT(*) AS VARCHAR) || ' rows' AS detail FROM common""",
        """SELECT 'schema_columns' AS "check", TRUE AS passed, 'ERROR' AS severity,
  'all critical columns present' AS detail""",
        zero.format(
            "unique_participant_key",
            "surplus rows",
            "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT data_source, match_id, participant_id FROM common)) AS n FROM common",
        ),
        listed("keys_not_null", blank_list, "no missing keys"),
        zero.format(
            "ten_participants_per_match",
            f"matches without {GROUP_SIZE} rows",
            f"SELECT COUNT(*) AS n FROM (SELECT match_id FROM common GROUP BY data_source, match_id HAVING COUNT(*) <> {GROUP_SIZE})",
        ),
        zero.format("team_id_values", "rows with another team_id", bad("team_id IS NULL OR team_id NOT IN (100, 200)")),
        zero.format("queue_is_ranked_solo", "rows of other queues", bad("queue_id IS NULL OR queue_id <> 420")),
        f"""SELECT 'win_balance[' || data_source || ']' AS "check", ABS(rate - 0.5) <= 0.01 AS passed,
  'ERROR' AS severity, 'winrate ' || CAST(ROUND(rate, 4) AS VARCHAR) AS detail
FROM (SELECT data_source, {MEAN_WIN} AS rate FROM common GROUP BY data_source)""",
        listed("non_negative_metrics", negative_list, "no negative values"),
        zero.format("kda_finite", "rows without a finite kda", bad("kda IS NULL OR isnan(kda) OR isinf(kda)")),
        f"""SELECT 'team_position_values' AS "check", bad = 0 AND share <= 0.05 AS passed, 'WARN' AS severity,
  CASE WHEN bad > 0 THEN CAST(bad AS VARCHAR) || ' rows with unexpected roles'
       ELSE 'undefined share ' || CAST(ROUND(share, 4) AS VARCHAR) END AS detail
FROM (SELECT SUM(CASE WHEN team_position NOT IN ({roles}) THEN 1 ELSE 0 END) AS bad,
  AVG(CASE WHEN team_position = 'UNDEFINED' THEN 1.0 ELSE 0.0 END) AS share FROM common)""",
    ]
    return with_tables("\nUNION ALL\n".join(parts), "common")


def _describe_sql(metrics) -> str:
    return "\nUNION ALL\n".join(
        f"""SELECT '{m}' AS metric, COUNT({m}) AS count, {r(f'AVG({m})', 'mean')}, {r(f'STDDEV_SAMP({m})', 'std')},
  {r(f'MIN({m})', 'min')}, {r(f'QUANTILE_CONT({m}, 0.25)', 'p25')}, {r(f'QUANTILE_CONT({m}, 0.5)', 'p50')},
  {r(f'QUANTILE_CONT({m}, 0.75)', 'p75')}, {r(f'MAX({m})', 'max')} FROM common"""
        for m in metrics
    )


# all columns of the common table here
NULL_COLUMNS = """data_source match_id source_tier game_start_utc game_duration_sec game_mode game_type game_version
    map_id platform_id queue_id participant_id puuid summoner_id summoner_name riot_id_game_name summoner_level
    champion_id champion_name team_id win team_position individual_position lane role kills deaths assists
    gold_earned gold_spent total_damage_dealt_to_champions total_damage_taken vision_score total_minions_killed
    wards_placed wards_killed dragon_kills baron_kills game_duration_min kda damage_per_min gold_per_min
    vision_per_min cs_per_min""".split() + S.ITEM_SLOTS
DESCRIBED = ["kda", "game_duration_min", "damage_per_min", "gold_per_min"]
PROFILED = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}
SKETCHED = {"match_id": "matches", "puuid": "players", "champion_name": "champions"}


def register(reg: Registry) -> None:
    add = reg.add
    stored = ["data_source", "match_id", "participant_id", "puuid", "team_position", "kda", "gold_per_min", "item6"]
    add(
        "common_table",
        lambda s, d: store_common(s, d).select(*stored),
        with_tables(
            f"""SELECT data_source, match_id, participant_id, puuid, team_position, {r('kda', 'kda')},
  {r('gold_per_min', 'gold_per_min')}, item6 FROM common""",
            "common",
        ),
    )
    # ---- completeness -------------------------------------------------------
    slim = ["data_source", "match_id", "participant_id", "champion_name", "team_position", "win", "kda"]
    slim_sql = f"data_source, match_id, participant_id, champion_name, team_position, win, {r('kda', 'kda')}"
    add(
        "complete_matches",
        lambda s, d: complete(s, d).select(*slim),
        with_tables(f"SELECT {slim_sql} FROM complete", "complete"),
    )
    add(
        "complete_position_matches",
        lambda s, d: A.standard_positions(complete(s, d)).select(*slim),
        with_tables(
            f"SELECT {slim_sql} FROM complete WHERE team_position IN ('TOP', 'JUNGLE', 'MIDDLE', 'BOTTOM', 'UTILITY')",
            "complete",
        ),
    )
    add(
        "complete_volume",
        lambda s, d: A.complete_volume(written_complete(s, d)),
        with_tables(
            "SELECT data_source, COUNT(*) AS rows, COUNT(DISTINCT match_id) AS full_matches FROM complete GROUP BY data_source",
            "complete",
        ),
    )
    add(
        "match_quality",
        lambda s, d: A.participants_histogram(common(s, d)),
        with_tables(
            """SELECT data_source, participants, COUNT(*) AS matches FROM (
  SELECT data_source, match_id, COUNT(*) AS participants FROM common GROUP BY data_source, match_id)
GROUP BY data_source, participants""",
            "common",
        ),
    )
    # ---- overviews ----------------------------------------------------------
    for name, source, cte in (("source_overview", common, "common"), ("source_overview_complete", complete, "complete")):
        add(
            name,
            lambda s, d, source=source: A.source_overview(source(s, d)),
            with_tables(f"SELECT data_source, {OVERVIEW} FROM {cte} GROUP BY data_source", cte),
        )
    add("source_overview_approx", lambda s, d: A.source_overview_approx(common(s, d)))
    add(
        "tier_overview",
        lambda s, d: A.tier_overview(one_source(s, d)),
        with_tables(f"SELECT source_tier, {OVERVIEW} FROM common WHERE data_source = 'O' GROUP BY source_tier", "common"),
    )
    add(
        "tier_stats",
        lambda s, d: A.tier_stats(one_source(s, d)),
        with_tables(
            f"""SELECT source_tier, COUNT(DISTINCT match_id) AS matches, COUNT(DISTINCT puuid) AS players,
  {avgs('kda', 'damage_per_min', 'gold_per_min')}, {r(MEAN_WIN, 'winrate')}
FROM common WHERE data_source = 'O' GROUP BY source_tier""",
            "common",
        ),
    )
    # ---- roles and results --------------------------------------------------
    role_sql = f"""SELECT {{keys}}, COUNT(*) AS rows, COUNT(DISTINCT match_id) AS matches, {{extra}}{avgs(*RATES)}
FROM {{table}} GROUP BY {{keys}}"""
    positions = "complete WHERE team_position IN ('TOP', 'JUNGLE', 'MIDDLE', 'BOTTOM', 'UTILITY')"
    add(
        "role_stats",
        lambda s, d: A.role_stats(A.standard_positions(written_complete(s, d))),
        with_tables(role_sql.format(keys="data_source, team_position", extra="", table=positions), "complete"),
    )
    add(
        "role_stats_single",
        lambda s, d: A.role_stats_single(one_source(s, d)),
        with_tables(
            role_sql.format(
                keys="team_position", extra="COUNT(DISTINCT puuid) AS players, ", table="common WHERE data_source = 'O'"
            ),
            "common",
        ),
    )
    add(
        "tier_role_stats",
        lambda s, d: A.tier_role_stats(one_source(s, d)),
        with_tables(
            role_sql.format(keys="source_tier, team_position", extra="", table="common WHERE data_source = 'O'"), "common"
        ),
    )
    for metric in ("damage_per_min", "gold_per_min", "vision_per_min"):
        add(
            f"role_source_pivot_{metric}",
            lambda s, d, m=metric: A.role_source_pivot(
                A.role_stats(A.standard_positions(written_complete(s, d))), f"avg_{m}", SOURCES
            ),
            with_tables(
                "SELECT team_position, "
                + ", ".join(r(f"AVG(CASE WHEN data_source = '{x}' THEN {metric} END)", f'"{x}"') for x in SOURCES)
                + f" FROM {positions} GROUP BY team_position",
                "complete",
            ),
        )
    add(
        "result_stats",
        lambda s, d: A.result_stats(written_complete(s, d)),
        with_tables(
            f"""SELECT data_source, win, CASE WHEN win THEN 'win' ELSE 'loss' END AS result, COUNT(*) AS rows,
  {avgs(*RESULT)} FROM complete GROUP BY data_source, win""",
            "complete",
        ),
    )
    add(
        "result_stats_single",
        lambda s, d: A.result_stats_single(one_source(s, d)),
        with_tables(
            f"""SELECT win, CASE WHEN win THEN 'win' ELSE 'loss' END AS result, COUNT(*) AS rows, {avgs(*RESULT)}
FROM common WHERE data_source = 'O' AND win IS NOT NULL GROUP BY win""",
            "common",
        ),
    )
    # ---- champions ----------------------------------------------------------
    add("champion_stats", lambda s, d: A.champion_stats(written_complete(s, d)), with_tables(CHAMPION_STATS, "complete"))
    add(
        "champion_filtered",
        lambda s, d: A.champion_filtered(written_complete(s, d), MIN_GAMES),
        with_tables(
            f"""SELECT * FROM ({CHAMPION_STATS})
WHERE (data_source = 'F' AND games >= 100) OR (data_source = 'O' AND games >= 10)""",
            "complete",
        ),
    )
    add(
        "champion_stats_single",
        lambda s, d: A.champion_stats_single(one_source(s, d)),
        with_tables(
            f"""SELECT champion_name, COUNT(DISTINCT match_id) AS games,
  CAST(COALESCE(SUM(CAST(win AS INTEGER)), 0) AS BIGINT) AS wins, {r(MEAN_WIN, 'winrate')}, {avgs(*RATES)}
FROM common WHERE data_source = 'O' GROUP BY champion_name HAVING COUNT(DISTINCT match_id) >= 10""",
            "common",
        ),
    )
    add(
        "champion_stats_percent",
        lambda s, d: A.champion_stats_percent(one_source(s, d)),
        with_tables(
            f"""SELECT champion_name, COUNT(match_id) AS games, {r(MEAN_WIN + ' * 100', 'winrate')},
  {avgs('kda', 'damage_per_min', 'gold_per_min')}
FROM common WHERE data_source = 'O' GROUP BY champion_name""",
            "common",
        ),
    )
    add(
        "popular_by_source",
        lambda s, d: A.popular_by_source(written_complete(s, d)),
        with_tables(
            f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY data_source ORDER BY games DESC, champion_name) AS rn
  FROM ({CHAMPION_STATS})) WHERE rn <= 15""",
            "complete",
        ),
    )
    add(
        "popular_champions",
        lambda s, d: A.popular_champions(one_source(s, d)),
        with_tables(
            """SELECT champion_name, COUNT(DISTINCT match_id) AS games FROM common WHERE data_source = 'O'
GROUP BY champion_name ORDER BY games DESC, champion_name LIMIT 20""",
            "common",
        ),
    )
    # ---- counts of matches --------------------------------------------------
    version = "split_part(game_version, '.', 1) || '.' || split_part(game_version, '.', 2)"
    for name, key, column, expr in (
        ("matches_per_tier", F.col, "source_tier", "source_tier"),
        ("matches_per_source", F.col, "data_source", "data_source"),
        ("matches_per_patch", lambda _: patch_prefix("game_version"), "patch", version),
    ):
        add(
            name,
            lambda s, d, key=key, column=column: A.matches_per(common(s, d), key(column), column),
            with_tables(
                f"SELECT {expr} AS {column}, COUNT(DISTINCT match_id) AS matches FROM common WHERE {expr} IS NOT NULL GROUP BY 1",
                "common",
            ),
        )
    add(
        "patch_of_version",
        lambda s, d: common(s, d).groupBy(patch_of("game_version").alias("patch")).agg(F.count("*").alias("rows")),
        with_tables(f"SELECT {version} AS patch, COUNT(*) AS rows FROM common GROUP BY 1", "common"),
    )
    add(
        "source_overview_sketched",
        sketched_overview,
        with_tables(
            "SELECT data_source, COUNT(*) AS rows, "
            + ", ".join(f"TRUE AS {out}_near, TRUE AS {out}_merged" for out in SKETCHED.values())
            + " FROM common GROUP BY data_source",
            "common",
        ),
    )
    # ---- profiles -----------------------------------------------------------
    add("describe_metrics", lambda s, d: P.describe(common(s, d), DESCRIBED), with_tables(_describe_sql(DESCRIBED), "common"))
    add(
        "null_counts",
        lambda s, d: P.null_counts(common(s, d)),
        with_tables(
            "\nUNION ALL\n".join(
                f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS nulls FROM common" for c in NULL_COLUMNS
            ),
            "common",
        ),
    )
    add(
        "table_profile",
        lambda s, d: P.table_profile(s.read.parquet(f"{d}/lineitem.parquet")),
        "\nUNION ALL\n".join(
            f"""SELECT CAST({i} AS INTEGER) AS position, '{c}' AS "column", '{kind}' AS type, COUNT(*) AS rows,
  COUNT({c}) AS filled, COUNT(*) - COUNT({c}) AS nulls FROM lineitem"""
            for i, (c, kind) in enumerate(PROFILED.items())
        ),
    )
    add(
        "value_counts",
        lambda s, d: P.value_counts(participants(s, d), "team_position", dropna=False),
        with_tables("SELECT raw_position AS team_position, COUNT(*) AS count FROM raw_rows GROUP BY 1", "raw_rows"),
    )
    add(
        "value_counts_filled",
        lambda s, d: P.value_counts(participants(s, d), "team_position"),
        with_tables(
            "SELECT raw_position AS team_position, COUNT(*) AS count FROM raw_rows WHERE raw_position IS NOT NULL GROUP BY 1",
            "raw_rows",
        ),
    )
    add(
        "distinct_counts",
        lambda s, d: P.distinct_counts(common(s, d), ["match_id", "puuid", "champion_name"]),
        with_tables(
            "SELECT COUNT(DISTINCT match_id) AS match_id, COUNT(DISTINCT puuid) AS puuid, COUNT(DISTINCT champion_name) AS champion_name FROM common",
            "common",
        ),
    )
    # ---- columns ------------------------------------------------------------
    measures = ("kda", "game_duration_min", "damage_per_min", "gold_per_min", "vision_per_min", "cs_per_min")
    add(
        "derived_metrics",
        lambda s, d: common(s, d).select("data_source", "match_id", "participant_id", *measures),
        with_tables(
            f"SELECT data_source, match_id, participant_id, {', '.join(r(m, m) for m in measures)} FROM common", "common"
        ),
    )
    add(
        "normalized_roles",
        lambda s, d: participants(s, d).select(
            "match_id",
            "participant_id",
            clean_role("team_position").alias("simple"),
            clean_role("team_position", "individual_position").alias("with_fallback"),
        ),
        with_tables(
            """SELECT match_id, participant_id,
  CASE WHEN raw_position IS NULL OR raw_position IN ('', 'Invalid') THEN 'UNDEFINED' ELSE raw_position END AS simple,
  CASE WHEN COALESCE(raw_position, individual_position) IS NULL
         OR COALESCE(raw_position, individual_position) IN ('', 'Invalid') THEN 'UNDEFINED'
       ELSE COALESCE(raw_position, individual_position) END AS with_fallback
FROM raw_rows""",
            "raw_rows",
        ),
    )
    add(
        "safe_ratio",
        lambda s, d: common(s, d).select(
            "match_id", "participant_id",
            ratio("kills", "deaths", on_zero="null").alias("kills_per_death"),
        ),
        with_tables(
            f"SELECT match_id, participant_id, {r('CAST(kills AS DOUBLE) / NULLIF(deaths, 0)', 'kills_per_death')} FROM common",
            "common",
        ),
    )
    add(
        "started_between",
        lambda s, d: started_between(common(s, d), "1996-03-01", "1998-06-30T00:00:00+00:00").select(
            "match_id", "participant_id", "game_start_utc"
        ),
        with_tables(
            """SELECT match_id, participant_id, game_start_utc FROM common
WHERE game_start_utc >= TIMESTAMP '1996-03-01' AND game_start_utc <= TIMESTAMP '1998-06-30'""",
            "common",
        ),
    )
    add(
        "union_sources",
        lambda s, d: union_sources(
            [
                common(s, d).filter(F.col("data_source") == x).select("data_source", "match_id", "participant_id", "win")
                for x in SOURCES
            ]
        ),
        with_tables("SELECT data_source, match_id, participant_id, win FROM common", "common"),
    )
    # ---- quality gate -------------------------------------------------------
    add("quality_report", lambda s, d: Q.run_checks(common(s, d), RULES), _quality_sql())
    add(
        "duplicate_participants",
        lambda s, d: Q.duplicate_participants(common(s, d)),
        with_tables(
            """SELECT data_source, match_id, participant_id, COUNT(*) AS copies FROM common
GROUP BY ALL HAVING COUNT(*) > 1""",
            "common",
        ),
    )
    add(
        "unexpected_roles",
        lambda s, d: Q.unexpected_roles(participants(s, d), RULES),
        with_tables(
            """SELECT raw_position AS team_position, COUNT(*) AS rows FROM raw_rows
WHERE raw_position IS NOT NULL AND raw_position NOT IN ('TOP', 'JUNGLE', 'MIDDLE', 'BOTTOM', 'UTILITY', 'UNDEFINED')
GROUP BY 1""",
            "raw_rows",
        ),
    )
