"""Star schema: a participant fact, an item bridge and their dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import RU, Labels, role_name, to_long
from ..operators.aggregates import complete_matches
from ..sources import LAYOUT, read_star, write_bucketed, write_csv, write_table
from . import marts

UNKNOWN_CLASS = "Unknown"


def champions_ref(raw: DataFrame) -> DataFrame:
    """Champion reference with the first tag as primary class."""
    return raw.select(
        F.col("champion_id").cast("bigint").alias("champion_id"),
        "champion_name",
        "title",
        "tags",
        F.split_part("tags", F.lit(","), F.lit(1)).alias("primary_class"),
    )


def items_ref(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("item_id").cast("bigint").alias("item_id"), "item_name", "gold_total", "tags"
    )


def dim_champion(complete: DataFrame, ref: DataFrame, canonical: bool = False) -> DataFrame:
    """Champions that occur in the facts, with title and class from the reference.

    Names come from the facts, so two spellings give two rows per id, and joins
    on the id alone repeat such facts. ``canonical=True`` gives one row per id,
    named by the reference where it knows the id.
    """
    used = complete.filter(F.col("champion_id").isNotNull()).select(
        to_long("champion_id").alias("champion_id"), "champion_name"
    )
    if canonical:
        used = used.groupBy("champion_id").agg(F.min("champion_name").alias("champion_name"))
    else:
        used = used.distinct()
    details = ref.select(
        "champion_id", "title", "primary_class", F.col("champion_name").alias("ref_name")
    )
    name = F.col("champion_name")
    return used.join(details, "champion_id", "left").select(
        "champion_id",
        (F.coalesce("ref_name", name) if canonical else name).alias("champion_name"),
        "title",
        F.coalesce("primary_class", F.lit(UNKNOWN_CLASS)).alias("primary_class"),
    )


def ambiguous_champions(dim: DataFrame) -> DataFrame:
    """Champion ids with more than one row in the dimension."""
    return dim.groupBy("champion_id").agg(F.count("*").alias("rows")).filter("rows > 1")


def _any_of(*columns: str):
    # Any non-null value will do; the largest one makes re-runs agree.
    return [F.max(c).alias(c) for c in columns]


def dim_match(complete: DataFrame) -> DataFrame:
    return complete.groupBy(*S.MATCH_KEY).agg(
        *_any_of("game_start_utc", "game_duration_min", "game_version", "queue_id", "source_tier")
    )


def dim_player(complete: DataFrame) -> DataFrame:
    return (
        complete.filter(F.col("puuid").isNotNull())
        .groupBy("data_source", "puuid")
        .agg(
            *_any_of("source_tier", "summoner_name", "riot_id_game_name"),
            F.count("*").alias("appearances"),
        )
    )


def dim_role(complete: DataFrame, labels: Labels = RU) -> DataFrame:
    roles = complete.select(F.col("team_position").alias("role_key")).distinct()
    return roles.withColumn("role_name_ru", role_name("role_key", labels))


def fact_participant(complete: DataFrame) -> DataFrame:
    return complete.withColumns(
        {"champion_id": to_long("champion_id"), "role_key": F.col("team_position")}
    ).select(*S.FACT_COLUMNS)


def fact_participant_item(
    complete: DataFrame, slots: Sequence[str] = S.ITEM_SLOTS
) -> DataFrame:
    """One row per filled item slot of a participant."""
    typed = complete.select(*S.PARTICIPANT_KEY, *[F.col(s).cast("bigint").alias(s) for s in slots])
    long = typed.unpivot(S.PARTICIPANT_KEY, list(slots), "slot", "item_id")
    return long.filter(F.col("item_id").isNotNull() & (F.col("item_id") != 0)).drop("slot")


def dim_item(bridge: DataFrame, ref: DataFrame) -> DataFrame:
    used = bridge.select("item_id").distinct()
    details = ref.select("item_id", "item_name", "gold_total", "tags")
    return used.join(details, "item_id", "left")


def integrity(fact: DataFrame, matches: DataFrame, group_size: int = 10) -> DataFrame:
    """Do the fact rows divided by the group size give the number of matches?"""
    rows = fact.agg(F.count("*").alias("fact_rows"))
    whole = F.floor(F.col("fact_rows") / group_size).cast("bigint")
    matches_in_dim = matches.select(F.count("*")).scalar()
    return rows.select(
        "fact_rows",
        whole.alias("fact_matches"),
        matches_in_dim.alias("dim_matches"),
        (whole == matches_in_dim).alias("ok"),
    )


def build_star(
    common: DataFrame,
    champions: DataFrame,
    items: DataFrame,
    group_size: int = 10,
    labels: Labels = RU,
) -> dict[str, DataFrame]:
    """All star tables as lazy frames. ``write_star`` is the form for large data."""
    return _star_of(
        complete_matches(common, group_size), champions_ref(champions), items_ref(items), labels
    )


def _star_of(
    complete: DataFrame, champions: DataFrame, items: DataFrame, labels: Labels
) -> dict[str, DataFrame]:
    star = {
        "fact_participant": fact_participant(complete),
        "dim_champion": dim_champion(complete, champions),
        "dim_match": dim_match(complete),
        "dim_player": dim_player(complete),
        "dim_role": dim_role(complete, labels),
        "fact_participant_item": fact_participant_item(complete),
    }
    star["dim_item"] = dim_item(star["fact_participant_item"], items)
    return {**star, **build_marts(star, labels)}


def build_marts(star: dict[str, DataFrame], labels: Labels = RU) -> dict[str, DataFrame]:
    fact, champion = star["fact_participant"], star["dim_champion"]
    return {
        "item_stats": marts.item_stats(star["fact_participant_item"], fact, star["dim_item"]),
        "champion_strength": marts.champion_strength(fact, champion, labels=labels),
        "champion_by_duration": marts.champion_by_duration(
            fact, champion, star["dim_match"], labels
        ),
    }


# Tables read through a source filter are laid out by source.
_BY_SOURCE = {"fact_participant", "dim_match", "dim_player", "fact_participant_item"}
# Tables that meet on the match are bucketed by it below that.
_BY_MATCH = {"fact_participant", "dim_match", "fact_participant_item"}
_COMPLETE = "_stage/complete_matches"


def write_star(
    spark: SparkSession,
    common: DataFrame,
    champions: DataFrame,
    items: DataFrame,
    folder: str,
    group_size: int = 10,
    labels: Labels = RU,
    formats: Sequence[str] = ("parquet",),
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Build the star step by step and return the written tables.

    The complete matches are found once and written to ``folder/_stage``; the
    fact, the bridge and the dimensions then read that table without a join,
    and the marts read the written star. Lost executors repeat tasks from
    files, and the planner knows the real size of every dimension, so that it
    broadcasts those below the session's threshold and shuffles all others.

    That table, the fact, the bridge and the matches share one layout: folders
    by source, ``buckets`` files by match id in each (by default as many as the
    session has shuffle partitions). Rows are shuffled into it once; what joins
    or groups on the match key later stays in place. A complete match has
    ``group_size`` rows, so no bucket holds a hot key.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    used = {
        *S.PARTICIPANT_KEY, *S.ITEM_SLOTS, "champion_name", "team_position", "summoner_name",
        "riot_id_game_name", "source_tier", "game_start_utc", "game_duration_min",
        "game_version", "queue_id", *S.FACT_COLUMNS,
    } - {"role_key"}
    narrow = common.select(*[c for c in common.columns if c in used])
    stage = write_bucketed(
        complete_matches(narrow, group_size), f"{folder}/{_COMPLETE}.parquet",
        ["match_id"], buckets, ["data_source"],
    )

    def save(name: str, df: DataFrame) -> DataFrame:
        parts = ["data_source"] if name in _BY_SOURCE else []
        if name in _BY_MATCH and "parquet" in formats:
            written = write_bucketed(df, f"{folder}/{name}.parquet", ["match_id"], buckets, parts, laid_out=True)
            if "csv" in formats:
                write_csv(written, f"{folder}/{name}.csv")
            return written
        return write_table(df, f"{folder}/{name}", formats, partition_by=parts)

    star: dict[str, DataFrame] = {}
    star["fact_participant"] = save("fact_participant", fact_participant(stage))
    star["fact_participant_item"] = save("fact_participant_item", fact_participant_item(stage))
    star["dim_champion"] = save("dim_champion", dim_champion(stage, champions_ref(champions)))
    star["dim_match"] = save("dim_match", dim_match(stage))
    star["dim_player"] = save("dim_player", dim_player(stage))
    star["dim_role"] = save("dim_role", dim_role(stage, labels))
    star["dim_item"] = save("dim_item", dim_item(star["fact_participant_item"], items_ref(items)))
    for name, mart in build_marts(star, labels).items():
        star[name] = save(name, mart)
    laid_out = [_COMPLETE, *sorted(_BY_MATCH if "parquet" in formats else ())]
    kinds = "name string, keys array<string>, buckets int, parts array<string>"
    layout = spark.createDataFrame([(n, ["match_id"], buckets, ["data_source"]) for n in laid_out], kinds)
    layout.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{LAYOUT}")
    return star


def read_complete(spark: SparkSession, folder: str) -> DataFrame:
    """The complete matches that ``write_star`` stored, for aggregates over whole matches."""
    return read_star(spark, folder, [_COMPLETE])[_COMPLETE]
